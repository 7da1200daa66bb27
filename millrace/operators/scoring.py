"""Model ranking, latency estimates, and label and route tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .audit import numbered

# Weights of accuracy, latency, size and battery.
PRESETS = {"budget": (40, 90, 100, 95), "flagship": (100, 60, 30, 40), "balanced": (80, 75, 75, 70), "wearable": (20, 95, 100, 100)}
# Id, accuracy, latency ms, quantised MB, battery index.
ARCHITECTURES = (("logistic-regression", 62, 1.8, 0.3, 1), ("cnn", 78, 8.5, 1.1, 3), ("lstm", 80, 18.0, 1.8, 5), ("bilstm", 88, 24.5, 2.4, 6), ("distilbert", 94, 185.0, 67.0, 10), ("tinybert", 89, 68.0, 14.2, 7), ("mobilebert", 91, 90.0, 25.0, 8))
# Million operations per ms, overhead ms.
PROCESSORS = {"budget-cpu": (0.08, 4.5), "mid-gpu": (0.65, 2.2), "flagship-npu": (8.2, 1.1)}
# Least latency ms by architecture and processor.
FLOORS = {"bilstm": {"flagship-npu": 3.2, "mid-gpu": 8.5, "budget-cpu": 16.0}, "cnn": {"flagship-npu": 1.8, "mid-gpu": 4.0, "budget-cpu": 7.2}, "transformer": {"flagship-npu": 9.5, "mid-gpu": 18.0, "budget-cpu": 68.0}}
MOST_ROUTES = 100_000
COMPLEXITY = {"cnn": 2.5, "bilstm": 8.0, "transformer": 14.0}


def model_scores(models: DataFrame) -> DataFrame:
    """(preset, id, score, rank) of models (pos, id, accuracy, latency, size, battery); equal scores keep the models' order."""
    latency, size = F.greatest(F.lit(0.0), 100 - F.col("latency") / 2), F.greatest(F.lit(0.0), 100 - F.col("size") * 1.5)
    weights = F.array(*(F.struct(F.lit(k).alias("preset"), *(F.lit(float(x)).alias(n) for n, x in zip("alsb", w, strict=True))) for k, w in PRESETS.items()))
    rows = models.withColumn("w", F.explode(weights))
    mean = (F.col("accuracy") * F.col("w.a") + latency * F.col("w.l") + size * F.col("w.s") + (11 - F.col("battery")) * 10 * F.col("w.b")) / (F.col("w.a") + F.col("w.l") + F.col("w.s") + F.col("w.b"))
    scored = rows.select(F.col("w.preset").alias("preset"), "id", "pos", F.floor(mean + 0.5).cast("bigint").alias("score")).withColumn("down", -F.col("score"))
    # Ranks over all models of a preset: numbered by ranges, from the first number of each of the few presets.
    ranked = numbered(scored, "preset", "down", "pos")
    starts = ranked.groupBy(F.col("preset").alias("of")).agg(F.min("rn").alias("first"))
    return ranked.join(F.broadcast(starts), F.col("preset") == F.col("of")).select("preset", "id", "score", (F.col("rn") - F.col("first") + 1).alias("rank"))


def latency(df: DataFrame) -> DataFrame:
    """Adds params, size_mb, latency_ms and ram_mb to rows (arch, processor, seq, vocab, dim, quantised)."""
    dim, seq = F.col("dim").cast("double"), F.col("seq").cast("double")
    case = lambda column, table: F.coalesce(*(F.when(F.col(column) == k, F.lit(float(v))) for k, v in table.items()))
    embedding = F.col("vocab") * dim
    body = F.when(F.col("arch") == "cnn", 3 * dim * dim + 5 * dim * 64).when(F.col("arch") == "bilstm", 16 * dim * dim).otherwise(4 * (3 * dim * dim + 8 * dim * dim))
    params = embedding + body + dim * 48
    rate, overhead = case("processor", {k: v[0] for k, v in PROCESSORS.items()}), case("processor", {k: v[1] for k, v in PROCESSORS.items()})
    floor = F.coalesce(*(F.when((F.col("arch") == a) & (F.col("processor") == p), F.lit(x)) for a, row in FLOORS.items() for p, x in row.items()))
    operations = seq * body * case("arch", COMPLEXITY) + embedding * 2
    size = F.round(params * F.when(F.col("quantised"), 1).otherwise(4) / (1024 * 1024), 2)
    return df.withColumns({"params": params.cast("bigint"), "size_mb": size, "latency_ms": F.round(F.greatest(floor, operations / (rate * 1000000) + overhead), 1), "ram_mb": F.floor(size * 3.5 + 8 + 0.5).cast("bigint")})


def appended_labels(old: DataFrame, new: DataFrame) -> DataFrame:
    """(label, idx): old labels (label, idx) keep their order, new ones (label) follow in lexical order."""
    added = new.join(old, "label", "left_anti").distinct().select("label", F.lit(1).alias("is_new"), F.lit(None).cast("bigint").alias("pos"))
    both = old.select("label", F.lit(0).alias("is_new"), F.col("idx").cast("bigint").alias("pos")).unionByName(added)
    return numbered(both, "is_new", "pos", "label").select("label", (F.col("rn") - 1).alias("idx"))


def route_lines(routes: DataFrame, key: str, value: str, header: str) -> DataFrame:
    """(text): one text of sorted lines `"key": "value",` under a header; more than MOST_ROUTES routes are refused."""
    if routes.count() > MOST_ROUTES:
        raise ValueError(f"more than {MOST_ROUTES} routes for one text")
    line = F.concat(F.lit('  "'), F.col(key), F.lit('": "'), F.col(value), F.lit('",'))
    return routes.agg(F.concat(F.lit(header + "\n"), F.array_join(F.array_sort(F.collect_list(line)), "\n")).alias("text"))


