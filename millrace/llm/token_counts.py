"""Token counts without token ids.

Every text becomes the frequencies of its pre-tokens (the units that the tokenizer's model cuts into pieces, one by
one), written once. The distinct pre-tokens of all texts are cut once each, the piece counts are joined to the
frequencies, and a document's tokens are the sum of frequency times pieces. No list of ids is ever made.

The vocabulary of pre-tokens is broadcast where it has at most `BROADCAST` entries. Where it is larger, only its most
frequent part is, chosen by the number of documents in powers of two, and what the others occur in is joined by a
shuffle; those are the rare ones, so no key of that shuffle is hot.

The library's normalizer, pre-tokenizer and model are what cuts, so counts equal its own. Where white space only
separates pre-tokens, texts are cut at it first and each distinct word is normalised and pre-tokenised once per cache.

Defined results: a null text counts as empty; empty texts and those of white space have 0 tokens; a row is counted for
itself, also when rows repeat or have no identifier; the strings of added tokens count as one token where they occur
in a text, as the library does by default; an empty table gives an empty result; further columns are ignored, also
when they carry the names of result columns. Added tokens that strip white space, match whole words only or match
after normalisation are refused.
"""

from __future__ import annotations

import functools
import itertools
import json
import re
import string
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from .common import remove, shared_path, table, text_batches, written
from .spm_codec import BATCH_ROWS, slices

LIMIT = 2048
BROADCAST = 200_000  # pre-tokens that may be broadcast
MAX_CACHED_WORDS = 200_000  # beyond, the words that were cut are forgotten; a slice of texts adds those of a million characters
LETTERS = "".join(c for c in map(chr, range(256)) if c.isalpha())
MARKS = "".join(c for c in string.punctuation if c != "'")
PROBES = ("a b", "a \n\t b", "x1 \t'tis 2", ". . 's\r\n?", "1 2 ab\n.c")


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class PreTokens:
    """Texts to frequencies of pre-tokens, and pre-tokens to numbers of pieces, for one tokenizer file's text."""

    def __init__(self, source: str) -> None:
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(source)
        added = json.loads(source).get("added_tokens") or []
        if any(x.get("normalized") or x.get("single_word") or x.get("lstrip") or x.get("rstrip") for x in added):
            raise ValueError("added tokens that strip, match words or match normalised text aren't supported")
        strings = sorted((x["content"] for x in added), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, strings))) if strings else None
        self.words: dict[str, tuple[str, ...]] = {}
        self.by_words = all(self.cut(p) == [x for w in p.split() for x in self.cut(w)] for p in PROBES)
        self.letters, self.suffixes = self.plain_letters() if self.by_words else {}, {"": ()}

    def plain_letters(self) -> dict[int, str]:
        """What letters become, if words of them stay whole with or without marks behind them: then those need no library.

        It is asked about every letter, every pair of letters and every letter with every mark; without that answer, none is.
        """
        found = {c: x[0] for c in LETTERS if len(x := self.cut(c)) == 1}
        pairs = list(itertools.product(found, repeat=2))
        marked = list(itertools.product(found, MARKS))
        whole = self.cut(" ".join(map("".join, pairs))) == [found[a] + found[b] for a, b in pairs]
        apart = self.cut(" ".join(map("".join, marked))) == [x for a, m in marked for x in (found[a], *self.cut(m))]
        return {ord(c): x for c, x in found.items()} if whole and apart else {}

    def cut(self, text: str) -> list[str]:
        """The pre-tokens of a text without added tokens."""
        t = self.tokenizer
        text = t.normalizer.normalize_str(text) if t.normalizer else text
        if not text:
            return []
        return [x for x, _ in t.pre_tokenizer.pre_tokenize_str(text)] if t.pre_tokenizer else [text]

    def learn(self, words: set[str]) -> None:
        """Cut words that are new: those of letters and marks by themselves, the others in one call, if they stay apart in it."""
        rest = []
        self.words[""] = ()
        letters, alphabet = self.letters, "".join(map(chr, self.letters))
        for w in words - {""}:
            stem = w.rstrip(MARKS) if letters else ""
            if stem and not stem.strip(alphabet):
                marks = w[len(stem) :]
                if marks not in self.suffixes:
                    if len(self.suffixes) > MAX_CACHED_WORDS:
                        self.suffixes = {"": ()}
                    self.suffixes[marks] = tuple(self.cut(marks))
                self.words[w] = (stem.translate(letters), *self.suffixes[marks])
            elif len(w.split()) != 1:  # white space of another kind inside
                self.words[w] = tuple(self.cut(w))
            else:
                rest.append(w)
        t = self.tokenizer
        together = " ".join(rest)
        whole = t.normalizer.normalize_str(together) if t.normalizer else together
        ends = list(itertools.accumulate(len(x) + 1 for x in whole.split(" ")))
        if len(ends) != len(rest) or not t.pre_tokenizer:  # normalising changed where words end
            self.words.update((w, tuple(self.cut(w))) for w in rest)
            return
        parts: list[list[str]] = [[] for _ in rest]
        k = 0
        for x, (begin, _) in t.pre_tokenizer.pre_tokenize_str(whole):
            while begin >= ends[k]:
                k += 1
            parts[k].append(x)
        self.words.update(zip(rest, map(tuple, parts), strict=True))

    def frequencies(self, texts: list[str]) -> Iterator[tuple[int, Counter]]:
        """(number of added tokens, frequency of each pre-token) of every text."""
        parts = [self.added.split(t) if self.added else [t] for t in texts]
        if not self.by_words:
            for ps in parts:
                yield len(ps) - 1, Counter(x for p in ps for x in self.cut(p))
            return
        # ASCII white space is a separator to the library too; any other stays inside a word for it to judge.
        words = [" ".join(ps).replace("\n", " ").replace("\t", " ").replace("\r", " ").split(" ") for ps in parts]
        if len(self.words) > MAX_CACHED_WORDS:
            self.words.clear()
        if new := set().union(*words).difference(self.words):
            self.learn(new)
        for ps, ws in zip(parts, words, strict=True):
            yield len(ps) - 1, Counter(itertools.chain.from_iterable(map(self.words.__getitem__, ws)))

    def pieces(self, pre_token: str) -> int:
        return len(self.tokenizer.model.tokenize(pre_token))


@functools.lru_cache(maxsize=2)
def pre_tokens(source: str) -> PreTokens:
    return PreTokens(source)


def frequencies(docs: DataFrame, source: str, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The `keep` columns with (n_bytes, n_added, parts: array of pre-token `p` and frequency `k`) of every whole text."""
    text_batches(docs.sparkSession)
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = docs.select(*keep, F.octet_length(text).cast("long").alias("n_bytes"), text.alias("__text"))
    names = [*keep, "n_bytes"]
    schema = StructType(list(slim.select(*names).schema)).add("n_added", LongType()).add("parts", ArrayType(StructType().add("p", StringType()).add("k", LongType())))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = pre_tokens(source)
        for batch in (x.slice(low, BATCH_ROWS) for x in batches for low in range(0, x.num_rows, BATCH_ROWS)):
            texts = batch.column(len(names)).to_pylist()
            for a, b in slices(texts):
                added, offsets, parts, counts = [], [0], [], []
                for n, found in cutter.frequencies(texts[a:b]):
                    added.append(n)
                    parts += found.keys()
                    counts += found.values()
                    offsets.append(len(parts))
                pairs = pa.StructArray.from_arrays([pa.array(parts, pa.string()), pa.array(counts, pa.int64())], ["p", "k"])
                out = [batch.column(i).slice(a, b - a) for i in range(len(names))]
                yield pa.RecordBatch.from_arrays([*out, pa.array(added, pa.int64()), pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pairs)], names=[*names, "n_added", "parts"])
        cutter.words.clear()  # the worker lives on between tasks

    return slim.mapInArrow(run, schema)


def pieces(distinct: DataFrame, source: str) -> DataFrame:
    """(p, docs, n): the number of pieces `n` of every pre-token."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = pre_tokens(source)
        for batch in batches:
            counts = [cutter.pieces(p) for p in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(counts, pa.int64())], names=["p", "docs", "n"])

    return distinct.select("p", "docs").mapInArrow(run, "p string, docs bigint, n bigint")


def frequent(vocabulary: DataFrame, most: int) -> int:
    """The least power of two such that at most `most` pre-tokens are in as many documents."""
    sizes = dict(vocabulary.groupBy(F.length(F.bin("docs")).alias("bits")).count().collect())
    held, bits = 0, 63
    while bits > 1 and held + sizes.get(bits - 1, 0) <= most:
        bits -= 1
        held += sizes.get(bits, 0)
    return 1 << (bits - 1)


def token_counts(docs: DataFrame, limit: int = LIMIT, tokenizer_file: str | None = None, text_col: str = "text", id_col: str = "doc_id", broadcast: int = BROADCAST) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit), one row per row of `docs`."""
    with open(tokenizer_file or default_tokenizer(), encoding="utf-8") as f:
        source = f.read()
    spark = docs.sparkSession
    folder = shared_path(spark, "token-counts")
    slim = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("__text"))
    counted = frequencies(slim, source, "__text", ("__id",)).withColumn("key", F.monotonically_increasing_id())
    rows = written(counted, "frequencies", folder, codec="zstd")
    distinct = rows.select(F.explode("parts.p").alias("p")).groupBy("p").agg(F.count(F.lit(1)).alias("docs"))
    vocabulary = written(pieces(distinct, source), "vocabulary", folder, codec="zstd")

    head, tail = vocabulary, None
    if vocabulary.count() > broadcast:
        least = frequent(vocabulary, broadcast)
        head, tail = vocabulary.where(F.col("docs") >= least), vocabulary.where(F.col("docs") < least)
    whole = ["key", F.col("__id"), "n_bytes", "n_added"]
    pairs = rows.select(*whole, F.inline_outer("parts")).join(F.broadcast(head.select("p", "n")), "p", "left")
    sums = pairs.groupBy("key").agg(F.max("__id").alias("id"), F.max("n_bytes").alias("n_bytes"), F.max("n_added").alias("n_added"), F.sum(F.coalesce(F.col("k") * F.col("n"), F.lit(0))).alias("n"))
    if tail is not None:
        rare = rows.select("key", F.inline("parts")).join(F.broadcast(head.select("p")), "p", "left_anti").join(tail.select("p", "n").hint("merge"), "p")
        rare = rare.groupBy("key").agg(F.sum(F.col("k") * F.col("n")).alias("n"))
        none = F.lit(None)
        both = sums.unionByName(rare.select("key", none.cast(sums.schema["id"].dataType).alias("id"), none.cast("long").alias("n_bytes"), none.cast("long").alias("n_added"), "n"))
        sums = both.groupBy("key").agg(F.max("id").alias("id"), F.max("n_bytes").alias("n_bytes"), F.max("n_added").alias("n_added"), F.sum("n").alias("n"))
    tokens = F.col("n") + F.col("n_added")
    found = written(sums.select(F.col("id").alias(id_col), "n_bytes", tokens.alias("n_tokens"), (tokens > limit).alias("over_limit")), "token-counts-found")
    remove(spark, folder)
    return found


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"))
