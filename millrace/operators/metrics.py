"""Classification reports, confusion matrices and the comparison of two engines."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def ratio(a: Column, b: Column) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def class_report(rows: DataFrame, truth: str = "truth", predicted: str = "predicted", labels: DataFrame | None = None) -> DataFrame:
    """(label, precision, recall, f1, support) per label, then accuracy, macro and weighted averages.

    All labels of both columns are listed, or those of `labels` (label). Rows are counted to a confusion table first.
    """
    cells = rows.groupBy(F.col(truth).cast("string").alias("t"), F.col(predicted).cast("string").alias("p")).agg(F.count(F.lit(1)).alias("n"))
    spine = labels.select(F.col("label").cast("string")) if labels is not None else cells.select(F.col("t").alias("label")).union(cells.select("p")).distinct()
    long = cells.select(F.col("t").alias("label"), F.lit(0).alias("as_p"), F.col("n").alias("as_t"), F.when(F.col("t") == F.col("p"), F.col("n")).otherwise(0).alias("hit")).unionByName(cells.select(F.col("p").alias("label"), F.col("n").alias("as_p"), F.lit(0).alias("as_t"), F.lit(0).alias("hit")))
    sums = long.groupBy("label").agg(F.sum("as_p").alias("as_p"), F.sum("as_t").alias("as_t"), F.sum("hit").alias("hit"))
    full = spine.join(sums, "label", "left").na.fill(0, ["as_p", "as_t", "hit"])
    precision, recall = ratio(F.col("hit"), F.col("as_p")), ratio(F.col("hit"), F.col("as_t"))
    per = full.select("label", precision.alias("precision"), recall.alias("recall"), ratio(2 * precision * recall, precision + recall).alias("f1"), F.col("as_t").alias("support"), "hit")
    total = F.sum("support")
    weighted = [ratio(F.sum(F.col(c) * F.col("support")), total).alias(c) for c in ("precision", "recall", "f1")]
    macro = per.agg(*(F.avg(c).alias(c) for c in ("precision", "recall", "f1")), total.alias("support")).select(F.lit("macro avg").alias("label"), "precision", "recall", "f1", "support")
    heavy = per.agg(*weighted, total.alias("support")).select(F.lit("weighted avg").alias("label"), "precision", "recall", "f1", "support")
    accuracy = per.agg(ratio(F.sum("hit"), total).alias("a"), total.alias("support")).select(F.lit("accuracy").alias("label"), F.col("a").alias("precision"), F.col("a").alias("recall"), F.col("a").alias("f1"), "support")
    return per.drop("hit").unionByName(accuracy).unionByName(macro).unionByName(heavy)


def confusion(rows: DataFrame, values: list, truth: str = "truth", predicted: str = "predicted") -> DataFrame:
    """One row per true label, one column `p_<value>` per predicted one."""
    counts = [F.count_if(F.col(predicted) == v).alias(f"p_{v}") for v in values]
    return rows.groupBy(truth).agg(*counts)


def robustness(clean: DataFrame, noisy: DataFrame, most: float = 0.05) -> DataFrame:
    """(f1_clean, f1_noisy, delta, robust): mean F1 of two reports' labels; robust if noise costs less than `most`."""
    mean = lambda rows, name: class_report(rows).where("label = 'macro avg'").select(F.col("f1").alias(name))
    both = mean(clean, "f1_clean").join(mean(noisy, "f1_noisy"))  # one row each
    delta = F.col("f1_clean") - F.col("f1_noisy")
    return both.select("f1_clean", "f1_noisy", delta.alias("delta"), (delta < most).alias("robust"))


def group_listing(taxonomy: DataFrame, group: str, name: str, parts: str) -> DataFrame:
    """(group, name, place, n_names, n_parts): the names of each group in order, with how many there are and how many parts they have in all."""
    place = F.row_number().over(Window.partitionBy(group).orderBy(name))
    sums = taxonomy.groupBy(group).agg(F.count(F.lit(1)).alias("n_names"), F.sum(F.size(parts)).alias("n_parts"))
    return taxonomy.select(group, name, place.cast("bigint").alias("place")).join(sums, group)


def run_metadata(rows: DataFrame, version: str) -> DataFrame:
    """(version, generated_at, total): one row; the time is that of the run, in ISO form, UTC."""
    now = F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    return rows.agg(F.count(F.lit(1)).alias("total")).select(F.lit(version).alias("version"), now.alias("generated_at"), "total")


def engine_comparison(rows: DataFrame) -> DataFrame:
    """One row of statistics over rows (error, a_latency, a_confidence, a_intent, b_latency, b_confidence, b_intent, amount, merchant).

    Rows with an error are counted and left out. A missing latency counts as 0 and stays in the denominator. An amount is
    present unless null; a merchant unless null or empty.
    """
    failed = F.coalesce(F.col("error") != "", F.lit(False))
    ok = ~failed
    n = F.count_if(ok)
    mean = lambda c: F.try_divide(F.sum(F.when(ok, F.coalesce(F.col(c).cast("double"), F.lit(0.0)))), n)
    return rows.agg(
        F.count(F.lit(1)).alias("n_total"), F.count_if(failed).alias("n_error"), n.alias("n_valid"), mean("a_latency").alias("a_latency"), mean("b_latency").alias("b_latency"), mean("a_confidence").alias("a_confidence"), mean("b_confidence").alias("b_confidence"),
        F.count_if(ok & (F.col("a_intent") == "UNKNOWN")).alias("a_unknown"), F.count_if(ok & (F.col("b_intent") == "UNKNOWN")).alias("b_unknown"), F.count_if(ok & F.col("amount").isNotNull()).alias("n_amount"),
        F.count_if(ok & F.col("merchant").isNotNull() & (F.col("merchant") != "")).alias("n_merchant"), F.try_divide(F.count_if(ok & (F.col("a_intent") == F.col("b_intent"))).cast("double"), n).alias("agreement"),
    )


def first_k(rows: DataFrame, k: int, *order: str) -> DataFrame:
    """The first k rows of an order; every task keeps k at most."""
    return rows.orderBy(*order).limit(k)
