"""The gate over labelled utterances: coverage, unknown labels, conflicts, diversity."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..sources.io import replace_folder, small

MOST_LISTED = 5


def combo_key(intent: str = "intent", action: str = "action") -> Column:
    """`intent|action`; null if either is."""
    return F.concat(F.col(intent), F.lit("|"), F.col(action))


def combo_parts(key: Column) -> Column:
    """struct(intent, action) of a key: what stands before and behind its first |."""
    intent = F.substring_index(key, "|", 1)
    return F.struct(intent.alias("intent"), F.substring(key, F.length(intent) + 2, F.length(key)).alias("action"))


def valid_combos(specs: DataFrame) -> DataFrame:
    """(intent, action) of every supported action of every spec."""
    return specs.select("intent", F.explode("supported_actions").alias("action")).distinct()


def unknown_intents(rows: DataFrame, specs: DataFrame) -> DataFrame:
    """(intent, n): labels of rows that no spec declares. Counted first, so the join sees one row per label."""
    return rows.groupBy("intent").agg(F.count(F.lit(1)).alias("n")).join(specs.select("intent").distinct(), "intent", "left_anti")


def illegal_combos(rows: DataFrame, combos: DataFrame) -> DataFrame:
    """(intent, action, n): label pairs of rows that no spec supports."""
    return rows.groupBy("intent", "action").agg(F.count(F.lit(1)).alias("n")).join(combos, ["intent", "action"], "left_anti")


def uncovered_intents(rows: DataFrame, specs: DataFrame) -> DataFrame:
    """(intent): declared labels without any row."""
    return specs.select("intent").distinct().join(rows.select("intent").distinct(), "intent", "left_anti")


def digest(text: Column | str) -> Column:
    """The SHA-256, 32 bytes, of a text in lower case; null of null. Texts are compared by it, so that no shuffle has to carry them."""
    return F.unhex(F.sha2(F.lower(text), 256))


def clashes(rows: DataFrame) -> DataFrame:
    """(digest, n_labels, labels): digests of utterances under more than one label pair."""
    pairs = rows.select(digest("utterance").alias("digest"), F.concat_ws("|", "intent", "action").alias("label")).distinct()
    return pairs.groupBy("digest").agg(F.count(F.lit(1)).alias("n_labels"), F.array_join(F.array_sort(F.collect_list("label")), ",").alias("labels")).where("n_labels > 1")


def conflicts(rows: DataFrame) -> DataFrame:
    """(utterance, n_labels, labels): equal utterances, apart from case, under more than one label pair."""
    texts = rows.select(F.lower("utterance").alias("utterance"), digest("utterance").alias("of"))
    found = texts.join(small(clashes(rows)), F.col("of").eqNullSafe(F.col("digest")))
    return found.groupBy("digest", "n_labels", "labels").agg(F.first("utterance").alias("utterance")).select("utterance", "n_labels", "labels")


def diversity(rows: DataFrame, minimum: DataFrame, combos: DataFrame | None = None) -> DataFrame:
    """(intent, action, n, least): label pairs with fewer distinct utterances than their intent asks for (default 0).

    Pairs without any row are not looked at, unless the supported `combos` are given.
    """
    found = rows.select("intent", "action", digest("utterance").alias("u")).distinct().groupBy("intent", "action").agg(F.count(F.lit(1)).alias("n"))
    if combos is not None:
        found = combos.join(found, ["intent", "action"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    least = F.coalesce("least", F.lit(0))
    return found.join(small(minimum), "intent", "left").where(F.col("n") < least).select("intent", "action", "n", least.alias("least"))


def report(rows: DataFrame, specs: DataFrame, combos: DataFrame, minimum: DataFrame) -> DataFrame:
    """(check, message), distinct: the messages of all checks; of conflicts the first few and one line for the rest."""
    say = lambda name, df, text: df.select(F.lit(name).alias("check"), text.alias("message"))
    found = conflicts(rows)
    total = clashes(rows).agg(F.count(F.lit(1)).alias("total"))
    first = found.orderBy("utterance").limit(MOST_LISTED)
    text = F.concat(F.lit("conflict: "), F.md5("utterance"), F.lit(" -> "), F.col("labels"))
    over = total.where(F.col("total") > MOST_LISTED).select(F.lit("conflict").alias("check"), F.concat(F.lit("and "), (F.col("total") - MOST_LISTED).cast("string"), F.lit(" more of "), F.col("total").cast("string")).alias("message"))
    parts = [
        say("coverage", uncovered_intents(rows, specs), F.concat(F.lit("no rows: "), F.col("intent"))),
        say("unknown", unknown_intents(rows, specs), F.concat(F.lit("not declared: "), F.col("intent"))),
        say("combination", illegal_combos(rows, combos), F.concat(F.lit("not supported: "), F.concat_ws("|", "intent", "action"))),
        say("conflict", first, text),
        over,
        say("diversity", diversity(rows, minimum), F.concat_ws(" ", F.lit("too few:"), F.concat_ws("|", "intent", "action"), F.col("n").cast("string"), F.lit("of"), F.col("least").cast("string"))),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.distinct()


def require_clean(violations: DataFrame) -> None:
    """Stops a build whose report has rows."""
    first = [r["message"] for r in violations.limit(MOST_LISTED).collect()]
    if first:
        raise ValueError("the gate found: " + "; ".join(first))


def publish(rows: DataFrame, specs: DataFrame, combos: DataFrame, minimum: DataFrame, path: str) -> dict[str, int]:
    """Write the rows and put them in place of the table at `path` if the gate finds nothing; the number of findings by check.

    One pass writes the rows beside `path` and counts, as it goes, rows with unknown labels or label pairs and the
    declared labels met. What needs groups (conflicts, diversity) is looked for in what was written, and only if those
    are clean. After a finding the written rows go and the old table stays.
    """
    spark = rows.sparkSession
    known = small(specs.select("intent").distinct().withColumn("__known", F.lit(True)))
    legal = small(combos.select("intent", "action").distinct().withColumn("__legal", F.lit(True)))
    marked = rows.join(known, "intent", "left").join(legal, ["intent", "action"], "left")
    seen = Observation()
    met = F.collect_set(F.when(F.col("__known"), F.col("intent")))  # no more values than specs have
    watched = marked.observe(seen, F.count_if(F.col("__known").isNull()).alias("unknown"), F.count_if(F.col("__legal").isNull()).alias("combination"), F.size(met).alias("met"))
    beside = f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    watched.select(*rows.columns).write.parquet(beside)
    counts = seen.get
    found = {"unknown": counts["unknown"], "combination": counts["combination"], "coverage": specs.select("intent").distinct().count() - counts["met"], "conflict": 0, "diversity": 0}
    if not any(found.values()):
        written = spark.read.schema(rows.schema).parquet(beside)
        found |= {"conflict": clashes(written).count(), "diversity": diversity(written, minimum).count()}
    replace_folder(spark, beside, None if any(found.values()) else path)
    return found


def authoring_faults(specs: DataFrame) -> DataFrame:
    """(intent, action, fault): supported actions without patterns, and patterns of actions that are not supported."""
    supported = valid_combos(specs)
    written = specs.select("intent", F.explode("utterance_patterns").alias("action", "patterns")).where(F.size("patterns") > 0).select("intent", "action").distinct()
    missing = supported.join(written, ["intent", "action"], "left_anti").withColumn("fault", F.lit("no patterns"))
    return missing.unionByName(written.join(supported, ["intent", "action"], "left_anti").withColumn("fault", F.lit("not supported")))


def misaligned(rows: DataFrame) -> DataFrame:
    """Rows whose tokens and tags differ in number."""
    return rows.where(F.size("tokens") != F.size("tags"))
