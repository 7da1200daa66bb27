"""Vector codes: product quantisation with codebooks from Lloyd rounds by filtering.

Vectors become integers and are cut into parts. Every partition builds, in blocks of at most `BLOCK` vectors, one
kd-tree per part, whose nodes hold their points' bounding box and sum; the trees are written once and read again in each
round. A round walks down from the roots with all codebook entries: of a node's entries the one nearest to the
middle of its box is compared with each other one at the corner of the box that suits the other best, and those
that lose even there (or tie with a higher index) can't be the nearest of any point below, so they are eliminated.
Where one entry is left, it gets the whole subtree at once, by the cached sum and count. Only leaves that keep several
entries are looked at point by point. All arithmetic is on integers, so results don't depend on how rows are dealt.

The driver holds codebooks only, and one row per part, entry and position comes back from each round.

Defined results: rows whose vector is null or holds null or non-finite components are dropped; vec_ids that repeat are
coded each, and their vectors' components decide which comes first in the codebooks; a null vec_id comes last there;
fewer kept rows than entries make smaller codebooks; an empty table gives an empty result; further columns are
ignored, also when they carry the names of result columns. Vectors of unlike lengths, of a length that the parts don't
divide or with a component beyond 2^27 after scaling are refused with an error, since no code of theirs is defined.
"""

from __future__ import annotations

import contextlib
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from .common import near, remove, shared_path, table, written

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096
BLOCK, LEAF = 8192, 16  # vectors of a block, and most points of a leaf
LARGEST = 1 << 27
LABELS = 100_000  # labels whose sums may be broadcast
BUFFERS = ("places", "points", "low", "high", "sums")
#: Blocks are some MB each, so few of them go to a Python worker at once.
FEW = {"spark.sql.execution.arrow.maxRecordsPerBatch": "4"}


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    before = {k: spark.conf.get(k) for k in values}
    try:
        for k, v in values.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def whole_numbers(vector: Column, scale: int = SCALE) -> Column:
    """The components as integers floor(scale * x); null for vectors that are dropped."""
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x.cast("double")) | (F.abs(x.cast("double")) == float("inf")))
    return F.when(~odd, F.transform(vector, lambda x: F.floor(x.cast("double") * scale)))


def levels(n: int) -> int:
    """Levels below the root: halved so often, a node has at most LEAF points."""
    return max(0, (-(-n // LEAF) - 1).bit_length())


def edges(n: int, level: int) -> np.ndarray:
    """Where the nodes of a level begin, and n."""
    return (n * np.arange((1 << level) + 1, dtype=np.int64)) >> level


def build(points: np.ndarray) -> tuple[np.ndarray, ...]:
    """(places in tree order, points in that order, lowest, highest and sum of every node, level by level)."""
    n, depth = len(points), levels(len(points))
    order, nodes = np.arange(n), []
    for level in range(depth + 1):
        at = edges(n, level)
        held = points[order]
        low, high = np.minimum.reduceat(held, at[:-1]), np.maximum.reduceat(held, at[:-1])
        nodes.append((low, high, np.add.reduceat(held, at[:-1])))
        if level < depth:  # halve every node along the widest side of its box
            node = np.repeat(np.arange(1 << level), np.diff(at))
            order = order[np.lexsort((held[np.arange(n), np.argmax(high - low, axis=1)[node]], node))]
    low, high, sums = (np.concatenate(x) for x in zip(*nodes, strict=True))
    return order.astype(np.int32), points[order].astype(np.int32), low.astype(np.int32), high.astype(np.int32), sums


def assign(tree: tuple[np.ndarray, ...], entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(entry of every point in tree order, count and sum of every entry, points looked at one by one)."""
    _, points, low, high, sums = tree
    n, k = len(points), len(entries)
    codes, counts, totals, single = np.empty(n, np.int64), np.zeros(k, np.int64), np.zeros_like(entries), 0
    depth, index = levels(n), np.arange(k)
    nodes, alive = np.zeros(1, np.int64), np.ones((1, k), bool)
    for level in range(depth + 1):
        at, base = edges(n, level), (1 << level) - 1
        lo, hi = low[base + nodes].astype(np.int64), high[base + nodes].astype(np.int64)
        apart = np.where(alive, (((lo + hi)[:, None, :] - 2 * entries) ** 2).sum(2), np.iinfo(np.int64).max)
        best = apart.argmin(1)
        mine = entries[best][:, None, :]
        corner = np.where(entries > mine, hi[:, None, :], lo[:, None, :])  # of the box, what suits the other entry best
        lead = ((corner - entries) ** 2).sum(2) - ((corner - mine) ** 2).sum(2)
        alive &= ~((lead > 0) | ((lead == 0) & (index > best[:, None])))
        one = alive.sum(1) == 1
        for node, entry in zip(nodes[one], best[one], strict=True):
            codes[at[node] : at[node + 1]] = entry
        np.add.at(counts, best[one], np.diff(at)[nodes[one]])
        np.add.at(totals, best[one], sums[base + nodes[one]])
        nodes, alive = nodes[~one], alive[~one]
        if level < depth:
            nodes, alive = np.stack((2 * nodes, 2 * nodes + 1), 1).ravel(), np.repeat(alive, 2, axis=0)
    if len(nodes):
        at = edges(n, depth)
        sizes = np.diff(at)[nodes]
        which = np.repeat(at[nodes] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
        held = points[which].astype(np.int64)
        apart = np.where(np.repeat(alive, sizes, axis=0), ((held[:, None, :] - entries) ** 2).sum(2), np.iinfo(np.int64).max)
        codes[which] = best = apart.argmin(1)
        np.add.at(counts, best, 1)
        np.add.at(totals, best, held)
        single = len(which)
    return codes, counts, totals, single


def tree_blocks(vectors: DataFrame, parts: int, dim: int, block: int = BLOCK) -> DataFrame:
    """(vec_id and label arrays, trees as bytes): a row for at most `block` of the vectors (vec_id, label, v) of a partition."""
    schema = StructType([*(StructType().add(c, ArrayType(vectors.schema[c].dataType)).fields[0] for c in ("vec_id", "label"))])
    for c in BUFFERS:
        schema.add(c, "binary")

    def made(held: pa.Table) -> pa.RecordBatch:
        v = held.column("v").combine_chunks()
        if (np.diff(v.offsets.to_numpy()) != dim).any():
            raise ValueError(f"vectors have to have {dim} components")
        v = v.flatten().to_numpy().reshape(-1, parts, dim // parts)
        if np.abs(v).max() > LARGEST:
            raise ValueError(f"components have to be within {LARGEST} after scaling")
        trees = [np.stack(x).tobytes() for x in zip(*(build(v[:, p]) for p in range(parts)), strict=True)]
        lists = [pa.ListArray.from_arrays(pa.array([0, held.num_rows], pa.int32()), held.column(c).combine_chunks()) for c in ("vec_id", "label")]
        return pa.RecordBatch.from_arrays([*lists, *(pa.array([x], pa.binary()) for x in trees)], names=schema.fieldNames())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            while size + batch.num_rows >= block:
                taken = block - size
                yield made(pa.Table.from_batches([*held, batch.slice(0, taken)]))
                held, size, batch = [], 0, batch.slice(taken)  # noqa: PLW2901
            if batch.num_rows:
                held.append(batch)
                size += batch.num_rows
        if size:
            yield made(pa.Table.from_batches(held))

    return vectors.mapInArrow(run, schema)


def trees_of(batch: pa.RecordBatch, row: int, parts: int, dim: int) -> list[tuple[np.ndarray, ...]]:
    """The trees of a block's parts."""
    raw = [batch.column(c)[row].as_buffer() for c in BUFFERS]
    places = np.frombuffer(raw[0], np.int32).reshape(parts, -1)
    rest = [np.frombuffer(x, np.int64 if c == "sums" else np.int32).reshape(parts, -1, dim // parts) for c, x in zip(BUFFERS[1:], raw[1:], strict=True)]
    return [tuple(x[p] for x in (places, *rest)) for p in range(parts)]


def lloyd_round(blocks: DataFrame, codebooks: np.ndarray) -> np.ndarray:
    """The codebooks [part, entry, position] after one round: means of their parts rounded down; unused entries stay."""
    parts, entries, width = codebooks.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, totals = np.zeros((parts, entries), np.int64), np.zeros(codebooks.shape, np.int64)
        for batch in batches:
            for row in range(batch.num_rows):
                for p, tree in enumerate(trees_of(batch, row, parts, parts * width)):
                    _, n, s, _ = assign(tree, codebooks[p])
                    counts[p] += n
                    totals[p] += s
        at = np.nonzero(np.repeat(counts.ravel(), width))[0]
        columns = (at, np.repeat(counts.ravel(), width)[at], totals.ravel()[at])
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=["cell", "n", "s"])

    cells = blocks.select(*BUFFERS).mapInArrow(run, "cell bigint, n bigint, s bigint").groupBy("cell").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    new = codebooks.copy()
    for cell, n, s in cells.collect():
        new.flat[cell] = s // n
    return new


def codes_of(blocks: DataFrame, codebooks: np.ndarray) -> DataFrame:
    """(vec_id, label, code, error) of every vector under the codebooks."""
    parts, _, width = codebooks.shape
    schema = StructType([StructType().add(c, blocks.schema[c].dataType.elementType).fields[0] for c in ("vec_id", "label")]).add("code", StringType()).add("error", LongType())
    digits = np.array([f"{i:02x}" for i in range(256)], "S2")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in range(batch.num_rows):
                ids, labels = (batch.column(c)[row].values for c in ("vec_id", "label"))
                codes, error = np.empty((len(ids), parts), np.int64), np.zeros(len(ids), np.int64)
                for p, tree in enumerate(trees_of(batch, row, parts, parts * width)):
                    found, _, _, _ = assign(tree, codebooks[p])
                    codes[tree[0], p] = found
                    error[tree[0]] += ((tree[1].astype(np.int64) - codebooks[p][found]) ** 2).sum(1)
                text = digits[codes].view(f"S{2 * parts}").ravel().astype(f"U{2 * parts}").tolist()
                yield pa.RecordBatch.from_arrays([ids, labels, pa.array(text, pa.string()), pa.array(error)], names=schema.fieldNames())

    return blocks.mapInArrow(run, schema)


def compress(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE, block: int = BLOCK) -> tuple[DataFrame, np.ndarray]:
    """((vec_id, label, code, error) of every kept row, codebooks [part, entry, position])."""
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hexadecimal digits for a part, so 1 to 256 entries")
    spark, folder = df.sparkSession, shared_path(df.sparkSession, "vector-codes")
    vectors = df.select(F.col(id_col).alias("vec_id"), F.col(label_col).alias("label"), whole_numbers(F.col(vector_col), scale).alias("v")).where("v IS NOT NULL")
    first = [r.v for r in vectors.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()]
    dim = len(first[0]) if first else 0
    if dim % parts or len({len(v) for v in first}) > 1 or first and not dim:
        raise ValueError(f"vectors have to have one length, divisible by {parts}")
    codebooks = np.array(first, np.int64).reshape(len(first), parts, dim // parts).transpose(1, 0, 2).copy()
    if not first:
        return vectors.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), codebooks
    blocks = written(tree_blocks(vectors, parts, dim, block), "trees", folder)
    with settings(spark, FEW):
        for _ in range(rounds):
            codebooks = lloyd_round(blocks, codebooks)
        coded = written(codes_of(blocks, codebooks), "vector-codes-found")
    remove(spark, folder)
    return coded, codebooks


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, codebooks = compress(table(spark, sf_dir, "embeddings"))
    digest = hashlib.sha256(",".join(map(str, codebooks.ravel().tolist())).encode()).hexdigest()
    by_label = near(coded.groupBy(F.col("label").alias("of")).agg(F.sum("error").alias("label_error")), LABELS)
    found = coded.join(by_label, F.col("label").eqNullSafe(F.col("of")))
    return found.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def _oracle() -> str:
    """One assignment and one update in SQL for each round; the kd-trees are only a faster way to the same rows."""
    nearest = """
SELECT vec_id, part, any_value(v) AS v, arg_min(entry, d * 256 + entry) AS entry, min(d) AS d
FROM (SELECT p.vec_id, p.part, p.v, c.entry, CAST(list_sum(list_transform(range(1, len(p.v) + 1), lambda i: (p.v[i] - c.c[i]) * (p.v[i] - c.c[i]))) AS BIGINT) AS d FROM parts p JOIN cb{k} c USING (part)) AS x
GROUP BY vec_id, part"""
    steps = []
    for k in range(ROUNDS + 1):
        steps.append(f"a{k} AS MATERIALIZED ({nearest.format(k=k)})")
        if k < ROUNDS:
            means = f"SELECT part, entry, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS c FROM (SELECT part, entry, pos, CAST(sum(x) AS BIGINT) AS s, count(*) AS n FROM (SELECT part, entry, unnest(v) AS x, unnest(range(1, len(v) + 1)) AS pos FROM a{k}) AS u GROUP BY ALL) AS s GROUP BY ALL"
            steps.append(f"cb{k + 1} AS MATERIALIZED (SELECT c.part, c.entry, coalesce(m.c, c.c) AS c FROM cb{k} c LEFT JOIN ({means}) AS m USING (part, entry))")
    return f"""
WITH e AS (SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS MATERIALIZED (SELECT vec_id, p AS part, v[p * len(v) // {PARTS} + 1 : (p + 1) * len(v) // {PARTS}] AS v FROM e, range({PARTS}) AS r(p)),
cb0 AS MATERIALIZED (SELECT part, row_number() OVER (PARTITION BY part ORDER BY vec_id) - 1 AS entry, v AS c FROM parts WHERE vec_id IN (SELECT vec_id FROM e ORDER BY vec_id LIMIT {ENTRIES})),
{', '.join(steps)},
coded AS (SELECT vec_id, string_agg(printf('%02x', CAST(entry AS INTEGER)), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM a{ROUNDS} GROUP BY vec_id),
sums AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM coded JOIN e USING (vec_id) GROUP BY label)
SELECT vec_id, code, error, label_error, (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY part, entry)) FROM cb{ROUNDS}) AS codebooks_sha256
FROM coded JOIN e USING (vec_id) JOIN sums ON sums.label IS NOT DISTINCT FROM e.label
"""


ORACLE = _oracle()
