"""Language identification with interpolated Kneser-Ney character models.

For every language the n-grams up to `ORDER` characters of a bounded sample of labelled texts are counted in Spark and
turned into an interpolated Kneser-Ney model, stored as arrays sorted by n-gram hash: the probability of
every seen n-gram and the back-off weight of every seen context. A text is read whole; the language with the
lowest cross-entropy per character wins. Rejection is calibrated on labelled texts that the models were not counted
from: per language, the cross-entropy that `1 - REJECT` of those stay under. A text beyond it in its best
language is rejected as none of the languages; its prediction stays.

Defined results: texts that are null or have no letter are `und` with score 0; ties go to the first language in
alphabetical order; without any labelled text all are `und`; repeated rows are judged one by one; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import functools
import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_batches

ORDER = 4
DISCOUNT = 0.75
VOCABULARY = 512  # characters that share the last discount
REJECT = 0.005
BUILD = 0.6  # of a language's labelled texts that are counted at most
MIX = np.uint64(0x9E3779B97F4A7C15)
SLICE_CHARS = 1 << 19
SLOTS = 20  # log2 of the places in a worker's memory of scores
SHARPNESS = 12.0


@functools.lru_cache(maxsize=1)
def fold_table() -> np.ndarray:
    """Code of each code point below 65,536: letters in lower case, everything else a space."""
    fold = np.full(1 << 16, 32, np.uint16)
    for c in range(1 << 16):
        x = chr(c)
        if x.isalpha():
            low = x.lower()
            fold[c] = ord(low) if len(low) == 1 and ord(low) < 1 << 16 else c
    return fold


def folded(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(codes, start of each text): runs of other characters become one space, a space before and after each text."""
    raw = np.frombuffer(" ".join(["", *texts, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
    sizes = np.array([len(t) for t in texts], np.int64)
    begin = 1 + np.cumsum(sizes + 1) - sizes - 1
    codes = fold_table()[np.minimum(raw, 0xFFFF)]
    for at in np.flatnonzero(raw > 0xFFFF):  # letters beyond share one code
        codes[at] = 0xFFFF if chr(raw[at]).isalpha() else 32
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 32) | (codes[:-1] != 32)
    # The text's own first character stands behind a space in any case.
    place = np.cumsum(keep) - 1
    return codes[keep], np.append(place[np.minimum(begin, len(raw) - 1)] + (~keep[np.minimum(begin, len(raw) - 1)]), keep.sum())


def grams(codes: np.ndarray) -> np.ndarray:
    """The ORDER codes up to each place, 16 bits each; spaces before the first."""
    c = np.concatenate((np.full(ORDER - 1, 32, np.uint64), codes.astype(np.uint64)))
    n = len(codes)
    key = np.zeros(n, np.uint64)
    for k in range(ORDER):
        key = (key << np.uint64(16)) | c[k : k + n]
    return key


def text_grams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(n-grams, codes, start of each text): n-grams of each text's letters and the space behind it, as if only spaces stood before the text."""
    codes, begin = folded(texts)
    keys = grams(codes)
    for j in range(ORDER - 1):
        at = begin[:-1] + j
        at = at[at < begin[1:]]
        own = np.uint64((1 << (16 * (j + 1))) - 1)  # the codes that are the text's own
        spaces = sum(32 << (16 * k) for k in range(j + 1, ORDER))
        keys[at] = (keys[at] & own) | np.uint64(spaces)
    return keys, codes, begin


def summed(keys: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    unique, back = np.unique(keys, return_inverse=True)
    return unique, np.bincount(back, weights=values, minlength=len(unique))


def hashed(keys: np.ndarray) -> np.ndarray:
    return keys * MIX


class Sorted:
    """Values by key: hashes in order, beside the values."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        h = hashed(keys)
        order = np.argsort(h)
        self.h, self.v = h[order], values[order].astype(np.float32)

    def get(self, keys: np.ndarray, default: float) -> tuple[np.ndarray, np.ndarray]:
        h = hashed(keys)
        at = np.minimum(np.searchsorted(self.h, h), len(self.h) - 1)
        found = self.h[at] == h
        return np.where(found, self.v[at], np.float32(default)), found


class Model:
    """One language: per order the probabilities of seen n-grams and the back-off weights of their contexts."""

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        sixteen = np.uint64(16)
        levels = [(keys, counts.astype(np.float64))]
        for order in range(ORDER - 1, 0, -1):
            # Continuation counts: in how many distinct n-grams one order up the n-gram ends.
            mask = np.uint64((1 << (16 * order)) - 1)
            levels.append(summed(levels[-1][0] & mask, np.ones(len(levels[-1][0]))))
        levels.reverse()  # order 1 first
        self.floor = DISCOUNT * len(levels[0][0]) / levels[0][1].sum() / VOCABULARY
        below, self.grams, self.backoff = None, [], []
        for order, (k, c) in enumerate(levels, 1):
            context = k >> sixteen if order > 1 else np.zeros(len(k), np.uint64)
            names, back = np.unique(context, return_inverse=True)
            total, kinds = np.bincount(back, weights=c), np.bincount(back)
            weight = DISCOUNT * kinds / total
            lower = np.full(len(k), 1 / VOCABULARY) if below is None else below.get(k & np.uint64((1 << (16 * (order - 1))) - 1), self.floor)[0]
            below = Sorted(k, np.maximum(c - DISCOUNT, 0) / total[back] + weight[back] * lower)
            self.grams.append(below)
            self.backoff.append(Sorted(names, weight))

    def log_probability(self, keys: np.ndarray) -> np.ndarray:
        result = np.full(len(keys), self.floor, np.float64)
        for order in range(1, ORDER + 1):
            part = keys & np.uint64((1 << (16 * order)) - 1)
            p, found = self.grams[order - 1].get(part, 0)
            weight = self.backoff[order - 1].get(part >> np.uint64(16), 1.0)[0] if order > 1 else 1.0
            # An unseen n-gram takes the next lower order's estimate, weighted for the context.
            result = np.where(found, p, result * weight if order > 1 else result)
        return np.log(result)


class Identifier:
    def __init__(self, models: dict[str, Model], limits: dict[str, float] | None = None):
        self.langs = sorted(models)
        self.models = [models[x] for x in self.langs]
        self.limits = limits or {}
        self.memory()

    def memory(self) -> None:
        self.slot_key = np.zeros(1 << SLOTS, np.uint64)
        self.slot_row = np.zeros((1 << SLOTS, len(self.langs)), np.float32)

    def __getstate__(self) -> dict:
        return {"langs": self.langs, "models": self.models, "limits": self.limits}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self.memory()

    def scores(self, keys: np.ndarray) -> np.ndarray:
        """Log probabilities of n-grams in every language; those met before come from the worker's memory."""
        slot = (hashed(keys) >> np.uint64(64 - SLOTS)).astype(np.int64)
        miss = np.flatnonzero(self.slot_key[slot] != keys)
        out = self.slot_row[slot]
        if len(miss):
            unique, back = np.unique(keys[miss], return_inverse=True)
            rows = np.stack([m.log_probability(unique) for m in self.models], axis=1).astype(np.float32)
            out[miss] = rows[back]
            where = (hashed(unique) >> np.uint64(64 - SLOTS)).astype(np.int64)
            self.slot_key[where], self.slot_row[where] = unique, rows
            # Where two of them wanted one place, the last one's key and row are both there.
        return out

    def entropy(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(nats per character in each language, number of letters) of each text."""
        total, letters, count = np.zeros((len(texts), len(self.langs))), np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        pieces = [(i, t[a : a + SLICE_CHARS]) for i, t in enumerate(texts) for a in range(0, max(1, len(t)), SLICE_CHARS)]
        start, held = 0, 0
        for k, (_, t) in enumerate(pieces):
            held += len(t)
            if held >= SLICE_CHARS or k == len(pieces) - 1:
                part = pieces[start : k + 1]
                keys, codes, begin = text_grams([x for _, x in part])
                row = self.scores(keys)
                doc = np.array([i for i, _ in part])
                sums = np.concatenate((np.zeros((1, row.shape[1])), np.cumsum(row, axis=0, dtype=np.float64)))
                ends = np.concatenate(([0], np.cumsum(codes != 32)))
                np.add.at(total, doc, sums[begin[1:]] - sums[begin[:-1]])
                np.add.at(letters, doc, ends[begin[1:]] - ends[begin[:-1]])
                np.add.at(count, doc, begin[1:] - begin[:-1])
                start, held = k + 1, 0
        return -total / np.maximum(count, 1)[:, None], letters

    def identify(self, texts: list[str]) -> pd.DataFrame:
        if not self.langs:
            return pd.DataFrame({"lang_pred": ["und"] * len(texts), "score": 0.0, "entropy": 0.0, "rejected": True})
        entropy, letters = self.entropy(texts)
        best = entropy.argmin(axis=1) if len(texts) else np.zeros(0, np.int64)
        low = entropy[np.arange(len(texts)), best]
        weight = np.exp(-SHARPNESS * (entropy - low[:, None]))
        known = letters > 0
        limit = np.array([self.limits.get(x, np.inf) for x in self.langs])
        return pd.DataFrame({
            "lang_pred": np.where(known, np.array(self.langs, object)[best], "und"), "score": np.where(known, 1 / weight.sum(axis=1), 0.0),
            "entropy": np.where(known, low, 0.0), "rejected": ~known | (low > limit[best]),
        })


def count_grams(sample: DataFrame) -> DataFrame:
    """(lang, gram, n) of a table (lang, text)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), object)
            texts = np.array(batch.column(1).to_pylist(), object)
            for lang in sorted(set(langs)):
                keys, _, begin = text_grams(texts[langs == lang].tolist())
                keys, n = np.unique(keys[begin[0] :], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(keys)), pa.array(keys.view(np.int64)), pa.array(n)], names=["lang", "gram", "n"])

    return sample.mapInArrow(run, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, learn: Callable[[Column], Column], max_docs: int = 800, max_calibration: int = 4000, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Identifier:
    """Models of all languages of the rows that `learn` allows.

    By a hash of the text about `max_docs` of each, at most BUILD of them, are counted; up to `max_calibration` others calibrate.
    """
    rows = docs.select(F.col(id_col).alias("__id"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(F.col("lang").isNotNull() & F.col("text").isNotNull()).where(learn(F.col("__id")))
    totals = {r[0]: r[1] for r in rows.groupBy("lang").count().collect()}
    if not totals:
        return Identifier({})
    draw = F.pmod(F.xxhash64(F.col("text"), F.lit("lang")), F.lit(1 << 30)) / float(1 << 30)
    per_language = lambda f: F.create_map(*(x for lang, n in totals.items() for x in (F.lit(lang), F.lit(f(n)))))[F.col("lang")]
    built = lambda n: min(BUILD, max_docs / n) if n > 1 else 1.0
    sample = rows.where(draw < per_language(built)).select("lang", "text")
    others = rows.where((draw >= per_language(built)) & (draw < per_language(lambda n: built(n) + max_calibration / n))).select("lang", "text")
    counted = count_grams(sample).toPandas()
    models = {lang: Model(part["gram"].to_numpy().view(np.uint64), part["n"].to_numpy()) for lang, part in counted.groupby("lang")}
    plain = Identifier(models)
    state = pickle.dumps(plain)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        own = pickle.loads(state)
        for batch in batches:
            entropy, letters = own.entropy(batch["text"].tolist())
            at = np.array([own.langs.index(x) if x in own.langs else 0 for x in batch["lang"]], np.int64)
            yield pd.DataFrame({"lang": batch["lang"], "entropy": entropy[np.arange(len(at)), at] if len(at) else [], "letters": letters})

    measured = others.mapInPandas(measure, "lang string, entropy double, letters long").where("letters >= 40")
    limits = {r[0]: float(r[1]) for r in measured.groupBy("lang").agg(F.percentile("entropy", F.lit(1 - REJECT))).collect()}
    return Identifier(models, limits)


@functools.lru_cache(maxsize=2)
def loaded(state: bytes) -> Identifier:
    return pickle.loads(state)


def identify(docs: DataFrame, identifier: Identifier, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The `keep` columns with lang_pred, score, entropy (nats per character) and rejected."""
    state = pickle.dumps(identifier)
    text_batches(docs.sparkSession)

    @F.pandas_udf("lang_pred string, score double, entropy double, rejected boolean")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = loaded(state)
        for texts in batches:
            yield own.identify(texts.tolist())

    return docs.select(*keep, run(F.coalesce(F.col(text_col), F.lit(""))).alias("__r")).select(*keep, "__r.*")


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(3)) == 1


def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, train(docs, lambda c: ~held_out(c)))
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score", "entropy", "rejected")
