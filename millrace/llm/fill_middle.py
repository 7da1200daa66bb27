"""Fill-in-the-middle transformation by an event scan.

One Aho-Corasick automaton runs over a text and reports its events: the ASCII characters at which the class of units
changes (for words, white space; for lines, the line feed; for code points, which are all counted alike, none) and the
sentinels. Between two events a text is of one class, so the number of units in a gap is arithmetic: as many as its
code points, or one. The sparse events with running counts are all that is kept; the place of the r-th unit is found
by a binary search among them and a subtraction.

A text that holds a sentinel stays as it is, since its cut could not be undone. The scan of an output finds the three
sentinels again, and `restore` puts the text together from what is between them.

Defined results: a null text counts as empty; an empty text is plain; a null identifier draws as the empty string;
rows that repeat an identifier draw alike; an empty table gives an empty result; further columns are kept only if
named. Units: `chars` are code points, `words` are longest runs of white space (the six of ASCII) or of anything else,
`lines` end behind their line feed.
"""

from __future__ import annotations

import functools
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructType

from .common import table, text_batches
from .spm_codec import BATCH_ROWS, slices

PREFIX, SUFFIX, MIDDLE = SENTINELS = ("<P>", "<S>", "<M>")
#: By unit: the class-changing characters; whether a gap has as many units as code points; whether a run of them is one unit.
UNITS = {"chars": ("", True, False), "words": (" \t\n\r\v\f", False, True), "lines": ("\n", False, False)}


class Scan:
    """The events of one text: places `ends` with the number of units `ranks` up to each, and the sentinels met."""

    __slots__ = ("each", "ends", "ranks", "sentinels")

    def __init__(self, automaton, text: str, unit: str) -> None:
        _, self.each, runs = UNITS[unit]
        self.ends, self.ranks, self.sentinels = [0], [0], []
        open_run = False  # the last unit is a run of class-changing characters that may go on
        for last, found in automaton.iter(text):
            if found:
                self.sentinels.append((last + 1 - len(found), found))
                continue
            if last > self.ends[-1] and runs:  # a unit of its own before the run
                self.close(last)
                open_run = False
            if open_run:
                self.ends[-1] = last + 1
            else:
                self.ends.append(last + 1)
                self.ranks.append(self.ranks[-1] + 1)
            open_run = runs
        if len(text) > self.ends[-1]:
            self.close(len(text))

    def close(self, end: int) -> None:
        """A gap without events up to `end`: as many units as code points, or one."""
        self.ranks.append(self.ranks[-1] + (end - self.ends[-1] if self.each else 1))
        self.ends.append(end)

    @property
    def units(self) -> int:
        return self.ranks[-1]

    def place(self, rank: int) -> int:
        """Where the first `rank` units end."""
        k = bisect_left(self.ranks, rank)
        return self.ends[k] - (self.ranks[k] - rank if self.each else 0)


@functools.cache
def automaton(unit: str):
    import ahocorasick

    found = ahocorasick.Automaton()
    for c in UNITS[unit][0]:
        found.add_word(c, "")
    for s in SENTINELS:
        found.add_word(s, s)
    found.make_automaton()
    return found


def rebuilt(output: str, form: str) -> str:
    """The text from an output and its form."""
    if form == "plain":
        return output
    (a, _), (b, second), (c, third) = Scan(automaton("chars"), output, "chars").sentinels
    parts = {PREFIX: output[a + 3 : b]} if form == "psm" else {SUFFIX: output[a + 3 : b]}
    parts |= {second: output[b + 3 : c], third: output[c + 3 :]}
    return parts[PREFIX] + parts[MIDDLE] + parts[SUFFIX]


def draws(id_col: str, seed: int) -> list:
    """h1 to h4: the first four groups of eight digits of the SHA-256 of seed and identifier."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))).cast("binary"), 256)
    return [F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("long").alias(f"__h{k + 1}") for k in range(4)]


def fill_in_middle(docs: DataFrame, unit: str = "chars", seed: int = 1, plain_percent: int = 10, spm_percent: int = 20, text_col: str = "text", id_col: str = "doc_id", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The `keep` columns with (n, form, prefix_units, middle_units, output): every whole text cut into three and put in another order."""
    text_batches(docs.sparkSession)
    slim = docs.select(*keep, F.coalesce(F.col(text_col), F.lit("")).alias("__text"), *draws(id_col, seed))
    schema = StructType(list(slim.select(*keep).schema)).add("n", LongType()).add("form", StringType()).add("prefix_units", LongType()).add("middle_units", LongType()).add("output", StringType())
    w = len(keep)

    def transform(text: str, h1: int, h2: int, h3: int, h4: int) -> tuple:
        scan = Scan(automaton(unit), text, unit)
        n = scan.units
        if not text or scan.sentinels or h3 % 100 >= 100 - plain_percent:
            return n, "plain", None, None, text
        low, high = sorted((h1 % (n + 1), h2 % (n + 1)))
        a, b = scan.place(low), scan.place(high)
        prefix, middle, suffix = text[:a], text[a:b], text[b:]
        if h4 % 100 < spm_percent:
            return n, "spm", low, high - low, f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
        return n, "psm", low, high - low, f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x.slice(low, BATCH_ROWS) for x in batches for low in range(0, x.num_rows, BATCH_ROWS)):
            texts, *numbers = (batch.column(w + i).to_pylist() for i in range(5))
            for a, b in slices(texts):
                made = zip(*map(transform, texts[a:b], *(x[a:b] for x in numbers)), strict=True)
                columns = [pa.array(x, kind) for x, kind in zip(made, (pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()), strict=True)]
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(a, b - a) for i in range(w)), *columns], names=schema.fieldNames())

    return slim.mapInArrow(run, schema)


def restore(rows: DataFrame, keep: tuple[str, ...] = ("doc_id",), form_col: str = "form", output_col: str = "output") -> DataFrame:
    """The `keep` columns with (text): every text rebuilt from its output and form; a null output or form has a null text."""
    text_batches(rows.sparkSession)
    slim = rows.select(*keep, F.col(output_col).alias("__output"), F.col(form_col).alias("__form"))
    schema = StructType(list(slim.select(*keep).schema)).add("text", StringType())
    w = len(keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (x.slice(low, BATCH_ROWS) for x in batches for low in range(0, x.num_rows, BATCH_ROWS)):
            outputs, forms = batch.column(w).to_pylist(), batch.column(w + 1).to_pylist()
            for a, b in slices(outputs):
                texts = [None if o is None or f is None else rebuilt(o, f) for o, f in zip(outputs[a:b], forms[a:b], strict=True)]
                yield pa.RecordBatch.from_arrays([*(batch.column(i).slice(a, b - a) for i in range(w)), pa.array(texts, pa.string())], names=schema.fieldNames())

    return slim.mapInArrow(run, schema)


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    made = made.withColumn("output_sha256", sha("output"))
    kept = ("doc_id", "n", "form", "prefix_units", "middle_units", "output_sha256")
    back = restore(made, kept).withColumn("restored_sha256", sha("text"))
    return back.select("doc_id", "n", "form", F.col("prefix_units").alias("prefix_chars"), F.col("middle_units").alias("middle_chars"), "output_sha256", "restored_sha256")


ORACLE = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n, sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents),
h AS (SELECT *, CAST('0x' || substr(h, 1, 8) AS BIGINT) % (n + 1) AS c1, CAST('0x' || substr(h, 9, 8) AS BIGINT) % (n + 1) AS c2,
             CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM d),
f AS (SELECT *, least(c1, c2) AS a, greatest(c1, c2) AS b,
             CASE WHEN n = 0 OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM h),
p AS (SELECT *, substr(t, 1, a) AS pre, substr(t, a + 1, b - a) AS mid, substr(t, b + 1) AS suf FROM f)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN a END AS prefix_chars, CASE WHEN form <> 'plain' THEN b - a END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM p
"""
