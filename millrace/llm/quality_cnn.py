"""Quality classifier: a byte-level convolutional network in numpy.

A text's UTF-8 bytes, with a channel that marks bytes repeated from close before, go through learned filters over
windows of `WIDTH` bytes. Rectified responses are averaged within chunks of 256 bytes that overlap by half
and cover the whole text, every chunk passes a dense layer, the chunks' outputs are max-pooled, and a logistic unit
combines them into one probability that the label is 1.

The network is fitted on the driver, on about `max_rows` labelled identifiers (half of them of each label where there are
that many), chosen by a hash of the identifier, one text each, and on at most `max_bytes` of text. Scoring reads every whole text, a few hundred kilobytes at a time.

Defined results: a null or empty text is one empty chunk and gets the score that the network gives to that; without
any label all scores are 0.5; repeated rows are scored one by one; an empty table gives an empty result; extra
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table, text_batches

WIDTH, FILTERS, HIDDEN, HALF, REACH = 5, 12, 16, 128, 24
BLOCK = 1 << 13
ROWS = 500  # texts taken out of an Arrow batch at a time
SLICE_BYTES = 1 << 17


def repeated(x: np.ndarray, out: np.ndarray) -> None:
    """Sets 1 where the four bytes from here also begin at one of the REACH places before."""
    for low in range(0, len(x), BLOCK):
        back = min(low, REACH)
        part = x[low - back : low + BLOCK + 3].astype(np.uint32)
        if len(part) < 5:
            return
        four = part[:-3] | part[1:-2] << 8 | part[2:-1] << 16 | part[3:] << 24
        found = np.zeros(len(four), bool)
        for d in range(1, min(REACH, len(four) - 1) + 1):
            found[d:] |= four[d:] == four[:-d]
        n = min(len(four) - back, BLOCK)
        out[low : low + n] = found[back : back + n]


class Batch:
    """The bytes of some texts with the bounds of their halves of chunks."""

    def __init__(self, texts: list[bytes]):
        gap = bytes(WIDTH - 1)
        self.x = np.frombuffer(b"".join(t + gap for t in texts), np.uint8)
        size = np.array([len(t) for t in texts], np.int64)
        begin = np.cumsum(size + WIDTH - 1) - size - WIDTH + 1
        halves = np.maximum(1, -(-size // HALF))
        self.first = np.cumsum(halves) - halves  # first half of each text
        doc = np.repeat(np.arange(len(texts)), halves)
        step = np.arange(len(doc)) - self.first[doc]
        self.start = begin[doc] + step * HALF
        self.count = np.clip(size[doc] - step * HALF, 0, HALF).astype(np.float32)
        last = step == halves[doc] - 1
        #: A chunk is a half and the next one of the same text; a text of one half has one chunk.
        self.chunk = np.flatnonzero(~last | (halves[doc] == 1))
        self.pair = np.where(last[self.chunk], -1, self.chunk + 1)
        self.chunk_doc = doc[self.chunk]
        self.doc_chunk = np.searchsorted(self.chunk_doc, np.arange(len(texts)))
        self.seen = np.zeros(len(self.x), np.uint8)
        for at, n in zip(begin, size, strict=True):
            repeated(self.x[at : at + n], self.seen[at : at + n])
        #: Places behind the texts, which belong to none.
        self.gaps = (begin + size)[:, None] + np.arange(WIDTH - 1)
        self.gaps = self.gaps.ravel()


class Network:
    """The parameters; `forward` gives the scores, `step` one step of training."""

    def __init__(self, seed: int = 5):
        r = np.random.default_rng(seed)
        self.p = {
            "filters": r.normal(0, 0.15, (WIDTH, 256, FILTERS)).astype(np.float32), "repeat": r.normal(0, 0.15, (1, FILTERS)).astype(np.float32), "bias": np.full(FILTERS, 0.1, np.float32),
            "dense": r.normal(0, 0.5, (FILTERS + 1, HIDDEN)).astype(np.float32), "dense_bias": np.full(HIDDEN, 0.05, np.float32), "out": r.normal(0, 0.3, HIDDEN).astype(np.float32), "out_bias": np.zeros(1, np.float32),
        }
        self.m, self.v = ({k: np.zeros_like(x) for k, x in self.p.items()} for _ in range(2))
        self.t = 0

    def responses(self, b: Batch, at: slice | np.ndarray) -> np.ndarray:
        """Rectified responses of the filters at some places."""
        if isinstance(at, slice):
            x = [b.x[at.start + k : at.stop + k] for k in range(WIDTH)]
        else:
            x = [b.x[at + k] for k in range(WIDTH)]
        z = np.take(self.p["filters"][0], x[0], axis=0)
        buffer = np.empty_like(z)
        for k in range(1, WIDTH):
            np.take(self.p["filters"][k], x[k], axis=0, out=buffer, mode="clip")
            z += buffer
        z += self.bases[b.seen[at]]
        return np.maximum(z, 0, out=z)

    def pooled(self, b: Batch) -> np.ndarray:
        """Means of the chunks: filters and the repetition channel."""
        self.bases = np.stack((self.p["bias"], self.p["bias"] + self.p["repeat"][0]))
        sums = np.zeros((len(b.start), FILTERS + 1), np.float32)
        bounds = np.append(b.start, len(b.x) - WIDTH + 1)
        i = 0
        while i < len(b.start):  # a block of halves at a time, which stays in the processor's cache
            j = max(i + 1, int(np.searchsorted(bounds, bounds[i] + BLOCK, side="right")) - 1)
            low, high = int(bounds[i]), int(bounds[j])
            if high > low:
                z = self.responses(b, slice(low, high))
                gaps = b.gaps[np.searchsorted(b.gaps, low) : np.searchsorted(b.gaps, high)]
                z[gaps - low] = 0
                at = np.minimum(bounds[i:j] - low, high - low - 1)
                full = b.count[i:j] > 0
                sums[i:j, :FILTERS] = np.add.reduceat(z, at, axis=0) * full[:, None]
                sums[i:j, FILTERS] = np.add.reduceat(b.seen[low:high], at, dtype=np.float32) * full
            i = j
        other = np.where(b.pair < 0, 0, b.pair)
        has = (b.pair >= 0)[:, None]
        self.weight = np.maximum(1, b.count[b.chunk] + b.count[other] * (b.pair >= 0))[:, None]
        return (sums[b.chunk] + sums[other] * has) / self.weight

    def forward(self, b: Batch) -> np.ndarray:
        self.c = self.pooled(b)
        self.h = np.maximum(0, self.c @ self.p["dense"] + self.p["dense_bias"])
        self.top = np.maximum.reduceat(self.h, b.doc_chunk, axis=0)
        return 1 / (1 + np.exp(-np.clip(self.top @ self.p["out"] + self.p["out_bias"], -30, 30)))

    def step(self, b: Batch, y: np.ndarray, weight: np.ndarray, rate: float) -> float:
        s = self.forward(b)
        loss = float(-(weight * (y * np.log(s + 1e-7) + (1 - y) * np.log(1 - s + 1e-7))).mean())
        g = {}
        d = (weight * (s - y) / len(y)).astype(np.float32)
        g["out"], g["out_bias"] = self.top.T @ d, d.sum(keepdims=True)
        d_top = d[:, None] * self.p["out"]
        # The gradient goes to the first chunk that has the maximum.
        d_h = np.zeros_like(self.h)
        is_top = (self.h == self.top[b.chunk_doc]) & (self.h > 0)
        rank = np.cumsum(is_top, axis=0)
        before = np.where((b.doc_chunk > 0)[:, None], rank[np.maximum(b.doc_chunk - 1, 0)], 0)
        d_h[is_top & (rank - before[b.chunk_doc] == 1)] = 1
        d_h *= d_top[b.chunk_doc]
        g["dense"], g["dense_bias"] = self.c.T @ d_h, d_h.sum(0)
        d_c = (d_h @ self.p["dense"].T)[:, :FILTERS] / self.weight
        d_half = np.zeros((len(b.start), FILTERS), np.float32)
        d_half[b.chunk] += d_c
        two = b.pair >= 0
        d_half[b.pair[two]] += d_c[two]
        # Only bytes of chunks that carry gradient count.
        used = np.flatnonzero(np.abs(d_half).sum(1) > 0)
        spots = np.concatenate([np.arange(s0, s0 + int(n)) for s0, n in zip(b.start[used], b.count[used], strict=True)]) if len(used) else np.zeros(0, np.int64)
        d_z = np.repeat(d_half[used], b.count[used].astype(np.int64), axis=0) * (self.responses(b, spots) > 0)
        g["bias"], g["repeat"] = d_z.sum(0), (b.seen[spots].astype(np.float32) @ d_z)[None]
        g["filters"] = np.stack([np.stack([np.bincount(b.x[spots + k], weights=d_z[:, f], minlength=256) for f in range(FILTERS)], axis=1) for k in range(WIDTH)]) if len(spots) else np.zeros_like(self.p["filters"])
        self.t += 1
        for k, x in g.items():
            x = x.astype(np.float32)
            self.m[k] = 0.9 * self.m[k] + 0.1 * x
            self.v[k] = 0.99 * self.v[k] + 0.01 * x * x
            self.p[k] = self.p[k] - rate * (self.m[k] / (1 - 0.9**self.t)) / (np.sqrt(self.v[k] / (1 - 0.99**self.t)) + 1e-8)
        return loss


def fit(texts: list[bytes], labels: np.ndarray, epochs: int = 8, size: int = 24, rate: float = 0.01, seed: int = 5) -> dict[str, np.ndarray] | None:
    """Parameters fitted to the texts; None without both labels."""
    if len(set(labels.tolist())) < 2:
        return None
    net, r = Network(seed), np.random.default_rng(seed)
    share = labels.mean()
    weight = np.where(labels == 1, 0.5 / share, 0.5 / (1 - share))
    epochs = max(epochs, -(-2400 // max(1, len(texts))))
    for epoch in range(epochs):
        order = r.permutation(len(texts))
        for s in range(0, len(order), size):
            part = order[s : s + size]
            net.step(Batch([texts[i] for i in part]), labels[part].astype(np.float64), weight[part], rate * (0.3 if epoch >= epochs - 2 else 1))
    return net.p


def score_texts(texts: list[bytes], parameters: dict[str, np.ndarray] | None) -> np.ndarray:
    """Scores of whole texts, some at a time."""
    if parameters is None:
        return np.full(len(texts), 0.5)
    net = Network()
    net.p = parameters
    out, held, start = [], 0, 0
    for i, t in enumerate(texts):
        held += len(t)
        if held >= SLICE_BYTES or i == len(texts) - 1:
            out.append(net.forward(Batch(texts[start : i + 1])))
            start, held = i + 1, 0
    return np.concatenate(out) if out else np.zeros(0)


def train(docs: DataFrame, labels: DataFrame, learn: Callable[[Column], Column], max_rows: int = 1600, max_bytes: int = 1 << 26, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality") -> dict[str, np.ndarray] | None:
    """Fit on rows of `docs` that `learn` allows and `labels` covers; `max_rows` and `max_bytes` bound what the driver reads, a text at a time."""
    known = labels.where(F.col(label_col).isin(0, 1)).select(F.col(id_col).alias("__id"), F.col(label_col).cast("int").alias("__label")).where(learn(F.col("__id"))).distinct()
    totals = {r[0]: r[1] for r in known.groupBy("__label").count().collect()}
    if len(totals) < 2:
        return None
    draw = F.pmod(F.xxhash64("__id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("__label") == 1, F.lit(min(1.0, max_rows / 2 / totals[1]))).otherwise(F.lit(min(1.0, max_rows / 2 / totals[0])))
    picked = known.where(draw < share)
    rows = docs.select(F.col(id_col).alias("__doc"), F.col(text_col).alias("__text")).join(F.broadcast(picked), F.col("__doc") == F.col("__id"))
    rows = rows.groupBy("__id").agg(F.max("__label"), F.max(F.coalesce("__text", F.lit(""))).alias("__text")).orderBy(F.xxhash64("__id"), "__id")
    texts, marks, held = [], [], 0
    for r in rows.toLocalIterator():
        held += len(r[2].encode())
        if held > max_bytes:
            break
        texts.append(r[2].encode())
        marks.append(r[1])
    return fit(texts, np.array(marks))


def score(docs: DataFrame, parameters: dict[str, np.ndarray] | None, text_col: str = "text", out: str = "score") -> DataFrame:
    """`docs` with the score in the column `out`, in place of a column of that name."""
    text_batches(docs.sparkSession)
    others = [c for c in docs.columns if c != out]
    return docs.select(*others, score_udf(parameters)(F.coalesce(F.col(text_col), F.lit(""))).alias(out))


def score_udf(parameters: dict[str, np.ndarray] | None):
    @F.arrow_udf("double")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            parts = (texts.slice(low, ROWS).cast(pa.binary()).to_pylist() for low in range(0, len(texts), ROWS))
            yield pa.array(np.concatenate([np.zeros(0), *(score_texts(x, parameters) for x in parts)]), pa.float64())

    return run


def held_out(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(4)) == 2


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    text_batches(spark)
    docs = table(spark, sf_dir, "documents")
    parameters = train(docs, table(spark, sf_dir, "labels"), lambda c: ~held_out(c))
    scored = docs.select("doc_id", score_udf(parameters)(F.coalesce("text", F.lit(""))).alias("score"))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
