"""Temperature scaling, class centroids, decision boundaries and the final decision."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.io import scratch, small

FLOOR = 1e-8
GRID = [round(0.5 + 0.1 * k, 1) for k in range(46)]
THRESHOLD = 0.65
MOST_CLASSES = 10_000
BINS, LISTED = 4096, 4096  # of a selection by counting: bins of a range, and values of a group that are sorted together
BLOCK = 512  # classes that a row meets at once where there are many
MARGIN, QUANTILE, LEAST_RADIUS = 1.15, 0.95, 1e-6


def argmax(values: Column) -> Column:
    """Place of the largest value from 0, the first on ties."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """`body` of the value, which is computed once however often the body names it."""
    return F.get(F.transform(F.array(value), body), 0)


def total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, y: a + y)


def softmax(logits: Column) -> Column:
    shifted = let(logits, lambda z: let(F.array_max(z), lambda m: F.transform(z, lambda x: F.exp(x - m))))
    return let(shifted, lambda e: let(total(e), lambda s: F.transform(e, lambda x: x / s)))


def clipped_log(p: Column) -> Column:
    return F.transform(p, lambda x: F.log(F.greatest(F.least(x, F.lit(1.0)), F.lit(FLOOR))))


def temperature_scaled(p: Column, t: Column | float) -> Column:
    """Probabilities at another temperature."""
    t = t if isinstance(t, Column) else F.lit(float(t))
    return softmax(F.transform(clipped_log(p), lambda x: x / t))


def fit_temperature(rows: DataFrame, p: str = "p", truth: str = "truth", grid: list[float] = GRID) -> DataFrame:
    """(t, nll): the grid's temperature with the least mean negative log-likelihood, the smallest on ties.

    Logarithms are taken once a row; only what a temperature needs is unfolded over the grid, and summed per temperature
    before anything is shuffled.
    """
    once = rows.select(let(clipped_log(F.col(p)), lambda z: F.transform(F.array(F.array_max(z)), lambda m: F.struct(F.transform(z, lambda x: x - m).alias("z"), (F.get(z, F.col(truth)) - m).alias("own")))[0]).alias("r"))
    unfolded = once.select("r", F.explode(F.array(*map(F.lit, grid))).alias("t"))
    loss = F.log(total(F.transform("r.z", lambda x: F.exp(x / F.col("t"))))) - F.col("r.own") / F.col("t")
    means = unfolded.groupBy("t").agg(F.avg(F.least(loss, F.lit(-math.log(FLOOR)))).alias("nll"))
    return means.agg(F.min(F.struct(F.round("nll", 9).alias("nll"), "t")).alias("b")).select("b.t", "b.nll")


def centroids(rows: DataFrame, vector: str = "embedding", label: str = "label") -> DataFrame:
    """(label, centroid, n): the mean vector of every class."""
    parts = rows.select(label, F.posexplode(vector).alias("pos", "x"))
    means = parts.groupBy(label, "pos").agg(F.avg(F.col("x").cast("double")).alias("m"), F.count(F.lit(1)).alias("n"))
    return means.groupBy(label).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "m"))), lambda s: s["m"]).alias("centroid"), F.max("n").alias("n"))


def distance(a: Column, b: Column) -> Column:
    return F.sqrt(F.aggregate(F.zip_with(a, b, lambda x, y: (x.cast("double") - y) * (x.cast("double") - y)), F.lit(0.0), lambda s, d: s + d))


def exact_quantile(rows: DataFrame, value: str, quantile: float, *group: str) -> DataFrame:
    """(group, n, quantile): the linearly interpolated quantile of every group's values, exact at any size; null values don't count.

    Selection by counting: a group's values are counted in `BINS` bins between its least and greatest, and only the
    bin that holds the rank is looked at again, until it has at most `LISTED` values or one value alone. Nothing but
    counts by group and bin is shuffled, and no group's values meet in one task.
    """
    folder = scratch(rows.sparkSession, "quantile")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return df.sparkSession.read.schema(df.schema).parquet(f"{folder}/{name}")

    v = F.col("__v")
    values = kept(rows.select(*group, F.col(value).cast("double").alias("__v")).where("__v is not null"), "values")
    on = lambda df: reduce(lambda x, y: x & y, (values[g].eqNullSafe(df[g]) for g in group), F.lit(True))
    beside = lambda state: values.join(small(state, MOST_CLASSES), on(state)).select(*(values[g] for g in group), "__v", *(c for c in state.columns if c not in group))
    whole = values.groupBy(*group).agg(F.count(F.lit(1)).alias("n"), F.min("__v").alias("low"), F.max("__v").alias("high"))
    at = (F.col("n") - 1) * F.lit(float(quantile))
    # rank: place of the lower neighbour among the values within [low, high], of which there are `held`; `after` is the least value beyond them.
    state = whole.select(*group, "n", F.floor(at).alias("rank"), (at - F.floor(at)).alias("part"), "low", "high", F.col("n").alias("held"), F.lit(None).cast("double").alias("after"))
    state, k = kept(state, "state-0"), 0
    wide = (F.col("held") > LISTED) & (F.col("low") < F.col("high"))
    while not state.where(wide).isEmpty():
        k += 1
        share = (v - F.col("low")) / (F.col("high") - F.col("low"))
        inside = beside(state.where(wide)).where(v.between(F.col("low"), F.col("high"))).withColumn("bin", F.least(F.floor(share * BINS), F.lit(BINS - 1)))
        bins = inside.groupBy(*group, "bin").agg(F.count(F.lit(1)).alias("c"), F.min("__v").alias("low"), F.max("__v").alias("high"))
        order = Window.partitionBy(*group).orderBy("bin")
        bins = bins.withColumns({"below": F.sum("c").over(order) - F.col("c"), "next": F.lead("low").over(order)})
        old = state.where(wide).select(*(F.col(g).alias(f"__{g}") for g in group), "n", F.col("rank").alias("__rank"), "part", F.col("after").alias("__after"))
        both = bins.join(old, reduce(lambda x, y: x & y, (bins[g].eqNullSafe(old[f"__{g}"]) for g in group), F.lit(True))).where("__rank >= below and __rank < below + c")
        narrowed = both.select(*group, "n", (F.col("__rank") - F.col("below")).alias("rank"), "part", "low", "high", F.col("c").alias("held"), F.coalesce("next", "__after").alias("after"))
        state = kept(narrowed.unionByName(state.where(~wide)), f"state-{k}")
    listed = beside(state.where("low < high")).where(v.between(F.col("low"), F.col("high")))
    sorted_ = listed.groupBy(*group, "n", "rank", "part", "after").agg(F.array_sort(F.collect_list("__v")).alias("vs"))
    ends = sorted_.select(*group, "n", "part", F.get("vs", F.col("rank").cast("int")).alias("a"), F.coalesce(F.get("vs", (F.col("rank") + 1).cast("int")), "after").alias("b"))
    alike = state.where("not (low < high)").select(*group, "n", "part", F.col("low").alias("a"), F.when(F.col("rank") + 1 < F.col("held"), F.col("low")).otherwise(F.col("after")).alias("b"))
    found = ends.unionByName(alike)
    return found.select(*group, "n", F.when(F.col("part") > 0, F.col("a") + (F.col("b") - F.col("a")) * F.col("part")).otherwise(F.col("a")).alias("quantile"))


def radii(rows: DataFrame, centers: DataFrame, vector: str = "embedding", label: str = "label") -> DataFrame:
    """(label, radius, n): a high quantile of the distances to the own centroid, with a margin. Centroids are one row per class."""
    d = rows.select(label, vector).join(small(centers.select(label, "centroid"), MOST_CLASSES), label).select(label, distance(F.col(vector), F.col("centroid")).alias("d"))
    return exact_quantile(d, "d", QUANTILE, label).select(label, F.greatest(F.col("quantile") * MARGIN, F.lit(LEAST_RADIUS)).alias("radius"), "n")


def nearest(rows: DataFrame, classes: DataFrame, vector: str = "embedding", label: str = "label", most: int = MOST_CLASSES) -> DataFrame:
    """Adds nearest, distance and accepted (within the class's radius, if `classes` has radii).

    Ties go to the smallest label, and classes of another dimension don't count; a row without any has nulls. Up to `most`
    classes travel as one array beside every row; more are met in blocks.
    """
    if "radius" not in classes.columns:
        classes = classes.withColumn("radius", F.lit(None).cast("double"))
    classes = classes.select(F.col(label).alias("label"), "centroid", "radius")
    best = best_in_blocks(rows, classes, vector) if classes.count() > most else best_of_all(rows, classes, vector)
    return best.withColumns({"nearest": F.col("__best.label"), "distance": F.col("__best.d"), "accepted": F.col("__best.d") <= F.col("__best.radius")}).drop("__best")


def best_class(vector: Column, classes: Column) -> Column:
    """struct<d, label, radius> of the nearest of an array of classes."""
    fitting = F.filter(classes, lambda c: F.size(c["centroid"]) == F.size(vector))
    return F.array_min(F.transform(fitting, lambda c: F.struct(distance(vector, c["centroid"]).alias("d"), c["label"].alias("label"), c["radius"].alias("radius"))))


def best_of_all(rows: DataFrame, classes: DataFrame, vector: str) -> DataFrame:
    packed = classes.agg(F.array_sort(F.collect_list(F.struct("label", "centroid", "radius"))).alias("__classes"))
    return rows.join(F.broadcast(packed)).withColumn("__best", best_class(F.col(vector), F.col("__classes"))).drop("__classes")


def best_in_blocks(rows: DataFrame, classes: DataFrame, vector: str, size: int = BLOCK) -> DataFrame:
    """Classes in blocks of about `size` by length of the centroid, which no distance is below the difference of.

    A row meets the block of its own length first; what it finds there bounds the lengths, and so the blocks, that can hold
    a nearer class. Rows are joined to blocks by number; no row sees all classes.
    """
    spark, folder = rows.sparkSession, scratch(rows.sparkSession, "nearest")

    def kept(df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(f"{folder}/{name}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{name}")

    norm = lambda v: F.sqrt(F.aggregate(v, F.lit(0.0), lambda s, x: s + x.cast("double") * x))
    lengths = classes.withColumn("length", norm(F.col("centroid")))
    # Ranges of one dimension and of lengths; a range that many classes share is one block and may be larger.
    ranged = kept(lengths.withColumn("dim", F.size("centroid")).repartitionByRange(max(1, -(-classes.count() // size)), "dim", "length").withColumn("part", F.spark_partition_id()), "ranged")
    blocks = ranged.groupBy("dim", "part").agg(F.min("length").alias("low"), F.max("length").alias("high"), F.array_sort(F.collect_list(F.struct("label", "centroid", "radius"))).alias("classes"))
    blocks = kept(blocks, "blocks")
    spans = blocks.groupBy("dim").agg(F.array_sort(F.collect_list(F.struct("low", "high", "part"))).alias("spans"))
    placed = kept(rows.withColumn("__row", F.monotonically_increasing_id()), "rows")
    slim = placed.select("__row", F.col(vector).alias("v"), norm(F.col(vector)).alias("length"), F.size(vector).alias("dim")).join(small(spans), "dim")
    # How far a length is outside a block's range; classes of the block are no nearer, but for rounding.
    gap = lambda s: F.greatest(s["low"] - F.col("length"), F.col("length") - s["high"], F.lit(0.0)) * (1 - 1e-9)
    own = F.array_min(F.transform("spans", lambda s: F.struct(gap(s).alias("gap"), s["part"].alias("part"))))["part"]
    meet = lambda df: df.join(blocks.select("dim", "part", "classes"), ["dim", "part"]).select("__row", "v", "length", "dim", "spans", "part", best_class(F.col("v"), F.col("classes")).alias("best"))
    first = kept(meet(slim.withColumn("part", own)), "first")
    others = F.filter("spans", lambda s: (s["part"] != F.col("part")) & (gap(s) <= F.col("best.d")))
    further = first.select("__row", "v", "length", "dim", F.array().cast(first.schema["spans"].dataType).alias("spans"), F.explode(F.transform(others, lambda s: s["part"])).alias("part"))
    found = first.select("__row", "best").unionByName(meet(further).select("__row", "best")).groupBy("__row").agg(F.min("best").alias("__best"))
    return placed.join(found, "__row", "left").drop("__row")


def decide(top: Column, confidence: Column, nearest_label: Column, nearest_confidence: Column, accepted: Column, threshold: float = THRESHOLD) -> Column:
    """struct(intent, confidence, unknown_reason): the boundary decides where there is one, else the threshold."""
    unknown = F.lit("UNKNOWN")
    out = lambda i, c, r: F.struct(i.alias("intent"), c.alias("confidence"), F.lit(r).cast("string").alias("unknown_reason"))
    return F.when(accepted.isNotNull() & ~accepted, out(unknown, confidence, "boundary")).when(accepted.isNotNull(), out(nearest_label, nearest_confidence, None)).when(confidence < threshold, out(unknown, confidence, "confidence")).otherwise(out(top, confidence, None))
