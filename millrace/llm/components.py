"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import remove, shared_path, written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component): the smallest identifier that links reach, for every identifier of a link.

    Every round draws a new order of the nodes and names each by the first node within two links; links between
    names are the next round's, until none are left. The first node of all takes its neighbours in, so every round has
    fewer nodes, and a chain keeps about a third of them. An empty table of links has no components.
    """
    spark, folder = links.sparkSession, shared_path(links.sparkSession, "components")
    mirrored = lambda df: df.union(df.select("y", "x"))
    pairs = links.select(F.least(a, b).alias("x"), F.greatest(a, b).alias("y")).where(F.col(a) != F.col(b)).distinct()
    both = written(mirrored(pairs), "links-0", folder)
    names = []
    while not names or not both.isEmpty():
        k = len(names)
        order = lambda c: F.struct(F.xxhash64(F.lit(k), c).alias("h"), F.col(c).alias("node"))  # noqa: B023, E731
        near = written(both.groupBy("x").agg(F.least(order("x"), F.min(order("y"))).alias("first")), f"near-{k}", folder)
        far = both.join(near.withColumnRenamed("x", "y"), "y").groupBy("x").agg(F.min("first").alias("first"))
        names.append(written(far.select(F.col("x").alias("id"), F.col("first.node").alias("name")), f"names-{k}", folder))
        x, y = (names[k].select(F.col("id").alias(c), F.col("name").alias(f"new_{c}")) for c in ("x", "y"))
        joined = both.where("x < y").join(x, "x").join(y, "y").where("new_x <> new_y")
        both = written(mirrored(joined.select(F.least("new_x", "new_y").alias("x"), F.greatest("new_x", "new_y").alias("y")).distinct()), f"links-{k + 1}", folder)
        for done in (f"near-{k}", f"links-{k}"):
            remove(spark, f"{folder}/{done}")
    last = names.pop()
    while names:
        further = last.select(F.col("id").alias("name"), F.col("name").alias("further"))
        last = names.pop().join(further, "name", "left").select("id", F.coalesce("further", "name").alias("name"))
    last = written(last, "last", folder)
    smallest = last.groupBy("name").agg(F.min("id").alias("component"))
    found = written(last.join(smallest, "name").select("id", "component"), "components-found")
    remove(spark, folder)
    return found
