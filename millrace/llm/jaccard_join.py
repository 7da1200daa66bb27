"""Similarity join of texts by the Jaccard index of their word n-grams, size-aware (heavy and light sets).

1. Every text becomes the set of hashes of its n-grams; texts with equal sets are one class.
2. A set may link to another only if all but `slack` of its elements occur elsewhere. Elements below a share of the
   hash space that falls with the set's size are counted over all sets, in one exchange of hashes that aggregates
   before it; a set with more than `slack` elements that nobody else has goes.
3. Light sets (up to a boundary chosen by cost): every subset that a link needs at least is enumerated; sets that meet
   in a subset S after leaving out a and b elements are linked for certain if S is large enough for a + b, and
   linking each to the one that left out least keeps every component, so a subset common to thousands of sets costs
   thousands of rows and no verification.
4. Heavy sets: the inverted lists of their first elements, as many as a link can't miss, are scanned. The order is
   rarest first by counts of a fixed number of hash buckets, so elements that many sets have come last. First each set
   is checked against its list's hub; then pairs of one list that are still in different components and whose sizes,
   positions and parity sketches allow a link. A pair in one component needs no check. Sets too large for a small sketch
   are listed by a sixth more elements, and a pair of them has to meet in as many more than one.
The boundary is the size up to which the subsets of a set are fewer than the elements that its scan would cost. Pairs
are dropped only by bounds that no link can break: sizes, positions in the common order, and the bits in which two
parity sketches differ, which are at most the elements in which the sets differ: first a small sketch that travels with the
lists, then one as wide as the set needs. Those left are verified by whole sets, each component's closest pair first if
they are many.

No candidates are capped or dropped; links between classes are exact up to 64-bit hash collisions.

Defined results: words are runs of bytes other than space and tab to carriage return, A-Z in lower case; a text with
fewer words than n is one n-gram of all of them; null texts and texts without words have an empty set, which links
with nothing and has its own identifier as component; every row is a document of its own, also if several share an
identifier; a null identifier is never the smallest, and the component only where all of it are null; rows that repeat
are linked as equal texts; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import itertools
import uuid
from collections.abc import Iterator
from math import ceil, comb

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import located, near, remove, shared_path, table, text_batches, written
from .components import components

BASE, INVERSE = 0x2545F4914F6CDD1D, pow(0x2545F4914F6CDD1D, -1, 1 << 64)
CLOSEST_ROUNDS = 3
PIECE = 1 << 18  # bytes hashed at a time
SMALL_ROWS = 250_000  # rows of identifiers or places that may be broadcast
BUCKETS_LEAST, BUCKETS_MOST, IN_BUCKET, PACKED = 1 << 12, 1 << 17, 64, 256  # of the table that orders elements: its size follows theirs up to half a megabyte


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def powers(base: int, n: int) -> np.ndarray:
    p = np.full(n, base, np.uint64)
    p[:1] = 1
    return np.cumprod(p, dtype=np.uint64)


UP, DOWN = powers(BASE, PIECE + 1), powers(INVERSE, PIECE + 1)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IS_SPACE = np.zeros(256, bool)
IS_SPACE[[9, 10, 11, 12, 13, 32]] = True
BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64))


def word_hashes(text: bytes) -> np.ndarray:
    """64-bit hashes of a text's words in order."""
    x = LOWER[np.frombuffer(text, np.uint8)]
    space = IS_SPACE[x]
    edge = np.flatnonzero(np.diff(np.concatenate(([True], space, [True])).astype(np.int8)))
    begin, end = edge[::2], edge[1::2]
    out, i = np.empty(len(begin), np.uint64), 0
    while i < len(begin):
        j = max(i + 1, int(np.searchsorted(end, begin[i] + PIECE, side="right")))
        low, high = int(begin[i]), int(end[j - 1])
        if high - low > PIECE:  # one word beyond the piece: its hash is taken in parts
            parts = [word_hashes_long(x[a : min(a + PIECE, high)]) for a in range(low, high, PIECE)]
            out[i] = chained(np.array(parts, np.uint64))
        else:
            total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(BYTE_VALUE[x[low:high]] * UP[: high - low], dtype=np.uint64)))
            a, b = begin[i:j] - low, end[i:j] - low
            out[i:j] = mix((total[b] - total[a]) * DOWN[a] + (b - a).astype(np.uint64))
        i = j
    return out


def word_hashes_long(x: np.ndarray) -> np.uint64:
    return np.sum(BYTE_VALUE[x] * UP[: len(x)], dtype=np.uint64)


def chained(h: np.ndarray) -> np.uint64:
    value = np.array([len(h)], np.uint64)
    for x in h:
        value = mix(value * np.uint64(BASE) + x)
    return value[0]


def shingle_set(text: bytes, n: int) -> np.ndarray:
    """The sorted distinct hashes of a text's n-grams."""
    w = word_hashes(text)
    if len(w) < n:
        return np.array([mix(np.array([chained(w)], np.uint64))[0]], np.uint64) if len(w) else np.zeros(0, np.uint64)
    h = w[: len(w) - n + 1]
    for k in range(1, n):
        h = mix(h * np.uint64(BASE) + w[k : len(w) - n + 1 + k])
    return np.unique(h)


def slack(n: Column, percent: int) -> Column:
    """How many elements of a set of size n a link can miss at most."""
    return n - F.ceil(n * percent / 100.0 - 1e-9)


def sketch(elements: np.ndarray, bits: int = 512) -> np.ndarray:
    """Each bit the parity of the number of elements that fall on it."""
    counts = np.bincount((elements & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(counts.astype(np.uint8)).view(np.int64)


def wide_bits(n: int) -> int:
    """Bits of the sketch that tells sets of size n apart when a small one is full: a power of two, at least 2 n."""
    return max(512, 1 << max(0, 2 * n - 1).bit_length())


def share_of(n: int, percent: int) -> float:
    """The share of the hash space counted for a set of n elements: half as much again as a link can miss, so that sets go whose
    elements are shared by chance up to a third, and twice the deviation of a random share."""
    miss = (100 - percent) / 100
    return min(1.0, 1.5 * miss + 2 * (miss * (1 - miss) / max(n, 1)) ** 0.5)


def lists_of(arrays: list[np.ndarray]) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum([len(x) for x in arrays]))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(np.concatenate([*arrays, np.zeros(0, np.int64)]).view(np.int64)))


def shingle_rows(docs: DataFrame, keep: tuple[str, ...], text_col: str, n: int, percent: int, whole: bool) -> DataFrame:
    """The kept columns, n_shingles, set_hash, elements and, of whole sets, a small and a wide sketch.

    Not whole: only the elements that are counted. Those that decide about this set come first, `own` says how many;
    the others are there for larger sets, whose share is smaller than that of their smallest partners.
    """
    limit = lambda m: np.uint64(min((1 << 64) - 1, int(share_of(m, percent) * (1 << 64))))
    text_batches(docs.sparkSession)
    slim = docs.select(*keep, F.col(text_col).alias("__text"))
    more = ["sketch array<long>", "wide array<long>"] if whole else ["own int"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 500):
                part = batch.slice(low, 500)
                sizes, marks, kept, last, wide = [], [], [], [], []
                for t in part.column(len(keep)):
                    s = shingle_set((t.as_py() or "").encode("utf-8", "surrogatepass"), n)
                    sizes.append(len(s))
                    marks.append(int(np.sum(mix(s ^ np.uint64(0x9E3779B97F4A7C15)), dtype=np.uint64) + np.uint64(len(s))))
                    if whole:
                        kept.append(s)
                        last.append(sketch(s))
                        wide.append(sketch(s, wide_bits(len(s))))
                    else:
                        kept.append(s[: np.searchsorted(s, limit(len(s)), side="right")])
                        last.append(np.searchsorted(kept[-1], limit(ceil(len(s) * 100 / percent)), side="right"))
                columns = [*part.columns[:-1], pa.array(sizes, pa.int64()), pa.array(np.array(marks, np.uint64).view(np.int64)), lists_of(kept), *((lists_of(last), lists_of(wide)) if whole else (pa.array(np.array(last, np.int32)),))]
                yield pa.RecordBatch.from_arrays(columns, names=[*keep, "n_shingles", "set_hash", "elements", *(x.split()[0] for x in more)])

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in slim.select(*keep).schema)
    return slim.mapInArrow(run, f"{kinds}, n_shingles long, set_hash long, elements array<long>, {', '.join(more)}")


def light_limit(percent: int) -> int:
    """The largest set size whose subsets are no more than the elements its scan would cost (size, prefix and verification)."""
    n = 1
    while subsets(n + 1, percent) <= 4 * (n + 1):
        n += 1
    return n


def most_left_out(n: int, percent: int) -> int:
    """How many elements a set of size n can leave out in a link: percent * (n - a + a) <= 100 * (n - a)."""
    return n - ceil(n * percent / 100 - 1e-9)


def is_full(n: int | Column, percent: int) -> bool | Column:
    """Whether the small sketches of sets of size n can't tell them apart: linked ones may differ in about as many bits as any two do."""
    return 2 * n * (100 - percent) > 250 * (100 + percent)


def first_places(n: int, percent: int) -> int:
    """How many of a set's first elements are listed: one more than a link can miss, and where small sketches are full a sixth more."""
    miss = most_left_out(n, percent)
    return min(n, miss + 1 + (miss // 6 if is_full(n, percent) else 0))


def met_at_least(n: Column, percent: int) -> Column:
    """How many of the listed elements of a set of size n a link can't miss."""
    miss = slack(n, percent)
    return F.least(n, miss + 1 + F.when(is_full(n, percent), F.floor(miss / 6)).otherwise(F.lit(0))) - miss


def subsets(n: int, percent: int) -> int:
    return sum(comb(n, a) for a in range(most_left_out(n, percent) + 1))


def light_links(sets: DataFrame, limit: int, percent: int, folder: str) -> DataFrame:
    """(a, b): certain links among sets of at most `limit` elements that keep all their components."""

    def enumerate_subsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low in range(0, batch.num_rows, 2000):
                part = batch.slice(low, 2000)
                rows = []
                for rep, elements in zip(part.column(0).to_pylist(), part.column(1).to_pylist(), strict=True):
                    m = [int(x) for x in mix(np.array(elements, np.int64).view(np.uint64))]
                    whole = sum(m)
                    for a in range(most_left_out(len(m), percent) + 1):
                        rows += [((whole - sum(out)) % (1 << 64), len(m) - a, a, rep) for out in itertools.combinations(m, a)]
                key = np.array([r[0] for r in rows], np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(key), *(pa.array([r[k] for r in rows], t) for k, t in ((1, pa.int32()), (2, pa.int32()), (3, pa.int64())))], names=["key", "size", "left_out", "id"])

    rows = written(sets.where(F.col("n_shingles") <= limit).select("id", "elements").mapInArrow(enumerate_subsets, "key long, size int, left_out int, id long"), "subsets", folder)
    hubs = written(rows.groupBy("key", "size").agg(F.min(F.struct("left_out", "id")).alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1"), "subset-hubs", folder)
    certain = F.col("size") * 100 >= percent * (F.col("size") + F.col("left_out") + F.col("hub.left_out"))
    return rows.join(hubs, ["key", "size"]).where(certain & (F.col("id") != F.col("hub.id"))).select(F.col("hub.id").alias("a"), F.col("id").alias("b")).distinct()


def bits_apart(sa: Column, sb: Column) -> Column:
    return sum((F.bit_count(F.get(sa, k).bitwiseXOR(F.get(sb, k))) for k in range(8)), F.lit(0))


def sketches_allow(percent: int, na: Column, nb: Column, sa: Column, sb: Column) -> Column:
    """Whether the bits in which two sketches differ are no more than the elements in which linked sets can differ."""
    return bits_apart(sa, sb) * (100 + percent) <= (100 - percent) * (na + nb)


def wide_bits_apart(sa: Column, sb: Column) -> Column:
    """The bits in which two wide sketches differ; the wider one is folded, which a parity sketch allows."""
    pieces = lambda s, m: F.transform(F.sequence(F.lit(0), m - 1), lambda i: F.aggregate(F.sequence(F.lit(0), (F.size(s) / m).cast("int") - 1), F.lit(0).cast("bigint"), lambda x, k: x.bitwiseXOR(F.get(s, i + k * m))))
    fold = lambda s, m: F.when(F.size(s) == m, s).otherwise(pieces(s, m))
    m = F.least(F.size(sa), F.size(sb))
    return F.aggregate(F.zip_with(fold(sa, m), fold(sb, m), lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda n, x: n + x)


def plausible(pairs: DataFrame, sets: DataFrame, percent: int, folder: str) -> DataFrame:
    """The pairs (a, b, ...) whose wide sketches differ in no more bits than linked sets can in elements: few that don't link are left."""
    side = lambda x: sets.select(F.col("id").alias(x), F.col("n_shingles").alias(f"n_{x}"), F.col("wide").alias(f"wide_{x}"))
    left = side("a").join(near(pairs, SMALL_ROWS), "a")
    both = left.join(side("b").join(near(pairs.select("b").distinct(), SMALL_ROWS), "b", "left_semi"), "b")
    allowed = wide_bits_apart(F.col("wide_a"), F.col("wide_b")) * (100 + percent) <= (100 - percent) * (F.col("n_a") + F.col("n_b"))
    return written(both.where(allowed).select(*pairs.columns), f"candidates-{uuid.uuid4().hex}", folder)


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose whole sets have the similarity."""
    side = lambda x: sets.select(F.col("id").alias(x), F.col("elements").alias(f"elements_{x}"))
    # Only sets that pairs name are shuffled, and those of one side not even that while pairs are few.
    left = side("a").join(near(pairs.select("a", "b"), SMALL_ROWS), "a")
    right = side("b").join(near(pairs.select("b").distinct(), SMALL_ROWS), "b", "left_semi")
    common = F.size(F.array_intersect("elements_a", "elements_b"))
    return left.join(right, "b").where(common * 100 >= percent * (F.size("elements_a") + F.size("elements_b") - common)).select("a", "b")


def bucket_counts(sets: DataFrame) -> np.ndarray:
    """How many elements of all sets fall on each hash bucket; at most `BUCKETS_MOST` numbers."""
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    buckets = BUCKETS_LEAST
    while buckets < BUCKETS_MOST and buckets * IN_BUCKET < total:
        buckets *= 2

    def of_partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(buckets, np.int64)
        for batch in batches:
            found = pc.list_flatten(batch.column(0)).to_numpy(zero_copy_only=False).view(np.uint64) & np.uint64(buckets - 1)
            n += np.bincount(found.astype(np.int64), minlength=buckets)
        if n.any():
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(buckets // PACKED, dtype=np.int32)), lists_of(list(n.reshape(-1, PACKED)))], names=["pack", "n"])

    # A pack has as many rows as there are partitions.
    rows = sets.select("elements").mapInArrow(of_partition, "pack int, n array<long>")
    packed = rows.groupBy("pack").agg(F.aggregate(F.collect_list("n"), F.array_repeat(F.lit(0).cast("bigint"), PACKED), lambda x, y: F.zip_with(x, y, lambda a, b: a + b)).alias("n"))
    counts = np.zeros(buckets, np.int32)
    for r in packed.toLocalIterator():
        counts[r["pack"] * PACKED : (r["pack"] + 1) * PACKED] = np.minimum(np.array(r["n"], np.int64), (1 << 31) - 1)
    return counts


def heavy_lists(sets: DataFrame, limit: int, percent: int) -> DataFrame:
    """(element, id, n, at): the inverted lists of heavy sets, `at` the element's place in its set."""
    least = ceil((limit + 1) * percent / 100)  # light sets that can link with heavy ones take part
    heavy = sets.where(F.col("n_shingles") >= least).select("id", "elements")
    counts = sets.sparkSession.sparkContext.broadcast(bucket_counts(heavy.withColumn("n_shingles", F.size("elements"))))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = counts.value
        for batch in batches:
            column = batch.column(1)
            values, offsets = column.values.to_numpy(zero_copy_only=False).view(np.uint64), column.offsets.to_numpy()
            found, rows, sizes, places = [np.zeros(0, np.uint64)], [], [], []
            for k in range(batch.num_rows):
                s = values[offsets[k] : offsets[k + 1]]
                p = first_places(len(s), percent)
                order = np.lexsort((s, count[(s & np.uint64(len(count) - 1)).astype(np.int64)]))[:p]
                found.append(s[order])
                rows += [k] * p
                sizes += [len(s)] * p
                places += range(p)
            at = np.array(rows, np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(found).view(np.int64)), batch.column(0).take(pa.array(at)), pa.array(sizes, pa.int32()), pa.array(places, pa.int32())], names=["element", "id", "n", "at"])

    return heavy.mapInArrow(first, "element long, id long, n int, at int")


def may_link(percent: int, a: str, b: str) -> Column:
    """What sizes and the places of a common element allow."""
    (na, pa_), (nb, pb) = ((F.col(f"{x}.n"), F.col(f"{x}.at")) for x in (a, b))
    most = F.least(pa_, pb) + F.least(na - pa_, nb - pb)
    return (F.least(na, nb) * 100 >= F.greatest(na, nb) * percent) & (most * (100 + percent) >= percent * (na + nb))


def heavy_links(sets: DataFrame, lists: DataFrame, links: DataFrame, percent: int, folder: str) -> DataFrame:
    """All links, those given and those of heavy sets, as far as components need them."""
    # Both sides of each join by element come out of one exchange: so the groups ask for the same columns as the rows, none null.
    present = lambda df: df.where(" and ".join(f"{c} is not null" for c in df.columns))
    placed, one = present(lists).repartition("element"), F.struct("id", "n", "at")
    several = placed.groupBy("element").agg(F.min(one).alias("low"), F.max(one).alias("high")).where("low <> high").select("element")
    shared = written(placed.join(several, "element"), "shared", folder)
    # The set that has most of its elements in common with others is its lists' hub.
    known = shared.groupBy("id").agg(F.count(F.lit(1)).alias("known"))
    ranked = written(shared.join(written(known, "known", folder), "id").withColumn("u", F.col("n") - F.col("known")), "ranked", folder)
    placed = present(ranked.select("element", "id", "n", "at", "u")).repartition("element")
    hubs = placed.groupBy("element").agg(F.min(F.struct("u", "n", "id", "at")).alias("h"))
    first = placed.join(hubs, "element").select(F.struct("id", "n", "at", "u").alias("m"), "h").where((F.col("m.id") != F.col("h.id")) & (F.col("m.u") >= F.col("h.u")) & may_link(percent, "m", "h"))
    # Of two sets always the same one is the hub, so a pair comes in one order; hubs, which are few, are `b`.
    pairs = first.select(F.col("m.id").alias("a"), F.col("h.id").alias("b")).distinct()
    pairs = plausible(written(pairs, "pairs-hubs", folder), sets, percent, folder)
    links = written(links.unionByName(confirmed(pairs, sets, percent)), "links-hubs", folder)
    # Lists whose sets are all in one component are done.
    named = written(ranked.join(components(links), "id", "left").withColumn("component", F.coalesce("component", "id")), "lists", folder)
    placed, one = present(named.select("element", "id", "n", "at", "component")).repartition("element"), F.struct("component", "id", "n", "at")
    open_ = placed.groupBy("element").agg(F.min(one).alias("low"), F.max(one).alias("high")).where("low.component <> high.component").select("element")
    small = sets.select("id", F.when(~is_full(F.col("n_shingles"), percent), F.col("sketch")).alias("sketch"))
    rest = placed.join(open_, "element").join(small, "id")
    rest = written(rest.select("element", "id", "n", "at", "component", "sketch"), "lists-open", folder)
    x, y = rest.alias("x"), rest.alias("y")
    apart = (F.col("x.element") == F.col("y.element")) & (F.col("x.id") < F.col("y.id")) & (F.col("x.component") != F.col("y.component"))
    other = x.join(y, apart & may_link(percent, "x", "y") & F.coalesce(sketches_allow(percent, *map(F.col, ("x.n", "y.n", "x.sketch", "y.sketch"))), F.lit(True)))
    distance = F.coalesce(bits_apart(F.col("x.sketch"), F.col("y.sketch")) / (F.col("x.n") + F.col("y.n")), F.lit(1.0))
    enough = F.least(*(met_at_least(F.col(x), percent) for x in ("x.n", "y.n")))
    more = other.select(F.col("x.id").alias("a"), F.col("y.id").alias("b"), F.col("x.component").alias("ca"), F.col("y.component").alias("cb"), distance.alias("d"), enough.alias("enough"))
    # A pair meets in every listed element that both sets have, since all of its lists are open.
    met = more.groupBy(*more.columns).agg(F.count(F.lit(1)).alias("met")).where("met >= enough").drop("met", "enough")
    more = written(met, "pairs-rest", folder)
    # A group of k texts that are all alike leaves k * k pairs. Where there are many, rounds of looking at each component's
    # closest pair alone join most of them first; pairs that are in one component by then need no look.
    k = 0
    while k < CLOSEST_ROUNDS and more.count() > SMALL_ROWS:
        ends = more.select(F.explode(F.array("ca", "cb")).alias("c"), "d", "a", "b").groupBy("c").agg(F.min(F.struct("d", "a", "b")).alias("p"))
        ends = written(ends.select("p.a", "p.b").distinct(), f"pairs-closest-{k}", folder)
        links = written(links.unionByName(confirmed(plausible(ends, sets, percent, folder), sets, percent)), f"links-closest-{k}", folder)
        found = components(links)
        of = lambda end: found.select(F.col("id").alias(end), F.col("component").alias(f"c{end}"))  # noqa: B023, E731
        left = more.select("a", "b", "d").join(ends, ["a", "b"], "left_anti").join(of("a"), "a", "left").join(of("b"), "b", "left")
        left = left.withColumns({"ca": F.coalesce("ca", "a"), "cb": F.coalesce("cb", "b")}).where("ca <> cb")
        more = written(left.select("a", "b", "ca", "cb", "d"), f"pairs-left-{k}", folder)
        k += 1
    return links.unionByName(confirmed(plausible(more.select("a", "b"), sets, percent, folder), sets, percent))


def labelled(placed: DataFrame, n: int, percent: int, id_col: str, text_col: str) -> DataFrame:
    """(id, n_shingles, file, row, component, component_id) of every located row; `component` is null for empty sets."""
    spark, folder = placed.sparkSession, shared_path(placed.sparkSession, "jaccard")
    place = (F.col("__at_file").alias("file"), F.col("__at_row").alias("row"))
    rows = shingle_rows(placed.select(F.col(id_col).cast("bigint").alias("id"), *place, F.col(text_col).alias("__text")), ("id", "file", "row"), "__text", n, percent, whole=False)
    counted = written(rows.withColumn("key", F.monotonically_increasing_id()), "counted", folder)
    members = written(counted.drop("elements", "own"), "members")
    # Elements that one set alone has; `key` is null for elements that don't decide about their set.
    elements = counted.select("key", "own", F.posexplode("elements").alias("at", "element")).select("element", F.when(F.col("at") < F.col("own"), F.col("key")).alias("key"))
    alone = elements.groupBy("element").agg(F.count(F.lit(1)).alias("k"), F.min("key").alias("key")).where("k = 1 and key is not null").groupBy("key").agg(F.count(F.lit(1)).alias("alone"))
    full = members.where("n_shingles > 0")
    left = full.join(written(alone, "alone", folder), "key", "left").where(F.coalesce("alone", F.lit(0)) <= slack(F.col("n_shingles"), percent))
    left = written(left.groupBy("set_hash", "n_shingles").agg(F.min("key").alias("class"), F.min(F.struct("key", "file", "row")).alias("at")).select("set_hash", "n_shingles", "class", "at.file", "at.row"), "open-classes")
    remove(spark, folder)
    # Texts are found by a hash of their place; another text that has the same is told apart by its set.
    place_hash = lambda file, row: F.xxhash64(file, row).alias("place")
    chosen = near(left.select(place_hash("file", "row"), F.col("class").alias("id"), F.col("set_hash").alias("wanted")), SMALL_ROWS)
    texts = placed.select(place_hash("__at_file", "__at_row"), F.col(text_col).alias("__text")).join(chosen, "place").select("id", "wanted", "__text")
    sets = shingle_rows(texts, ("id", "wanted"), "__text", n, percent, whole=True).where("set_hash = wanted").drop("set_hash", "wanted")
    sets = written(sets, "sets", folder)
    limit = light_limit(percent)
    certain = light_links(sets, limit, percent, folder)
    links = written(heavy_links(sets, written(heavy_lists(sets, limit, percent), "prefixes", folder), certain, percent, folder), "links-all")
    remove(spark, folder)
    found = components(links)
    classes = full.groupBy("set_hash", "n_shingles").agg(F.min("key").alias("key"), F.min("id").alias("low"))
    open_ = left.join(found, F.col("class") == F.col("id")).select("set_hash", "n_shingles", "component")
    classes = written(classes.join(open_, ["set_hash", "n_shingles"], "left").withColumn("component", F.coalesce("component", "key")), "classes")
    lowest = classes.groupBy("component").agg(F.min("low").alias("component_id"))
    named = written(classes.join(lowest, "component").select("set_hash", "n_shingles", "component", "component_id"), "named")
    out = full.join(named, ["set_hash", "n_shingles"]).select("id", "n_shingles", "file", "row", "component", "component_id")
    empty = members.where("n_shingles = 0").select("id", "n_shingles", "file", "row", F.lit(None).cast("long").alias("component"), F.col("id").alias("component_id"))
    return out.unionByName(empty)


def jaccard_components(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id), one row per row of `docs`."""
    return labelled(located(docs.select(id_col, text_col)), n, percent, id_col, text_col).select(F.col("id").alias(id_col), "n_shingles", "component_id")


def keep_one(docs: DataFrame, n: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of `docs` that stay, by file and place: of each component the one with the smallest identifier (null last, then the first in file order); rows without words stay."""
    placed = located(docs)
    rows = written(labelled(placed, n, percent, id_col, text_col).where("component is not null"), "near-copies")
    stay = rows.groupBy("component").agg(F.min(F.struct(F.isnull("id").alias("none"), "id", "file", "row")).alias("stay"), F.count(F.lit(1)).alias("k")).where("k > 1").select("component", "stay")
    gone = rows.join(written(stay, "near-copies-stay"), "component").where((F.col("file") != F.col("stay.file")) | (F.col("row") != F.col("stay.row")))
    gone = near(written(gone.select(F.col("file").alias("__at_file"), F.col("row").alias("__at_row")), "near-copies-gone"), SMALL_ROWS)
    return placed.join(gone, ["__at_file", "__at_row"], "left_anti").select(*docs.columns)


def op10_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"), n=3, percent=90)


#: All pairs by brute force: right for small tables.
ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 3 THEN array_to_string(w, ' ') ELSE w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] END AS g FROM d, LATERAL (SELECT unnest(range(1, greatest(len(w) - 1, 2))) AS i) WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM o JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * o >= 90 * (a.n + b.n - o)),
e AS (SELECT x, y FROM l UNION SELECT y, x FROM l),
r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, least(d.doc_id, coalesce(min(r.y), d.doc_id)) AS component_id FROM d LEFT JOIN n ON n.doc_id = d.doc_id LEFT JOIN r ON r.x = d.doc_id GROUP BY d.doc_id
"""
