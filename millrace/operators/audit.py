"""Audit verdicts: flattening, statistics, repair routing, batches and providers."""

from __future__ import annotations

import contextlib
import time
from collections.abc import Callable, Iterator
from typing import Protocol

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..sources.io import scratch


def newest(rows: DataFrame, key: str, position: str) -> DataFrame:
    """One row per key, the one with the largest position; rows with a null or empty key go."""
    usable = rows.where(F.col(key).isNotNull() & (F.col(key).cast("string") != ""))
    rest = [c for c in rows.columns if c != key]
    return usable.groupBy(key).agg(F.max_by(F.struct(*rest), position).alias("r")).select(key, "r.*")


def text_or_empty(path: str) -> Column:
    return F.coalesce(F.col(path).cast("string"), F.lit(""))


def flatten(verdicts: DataFrame) -> DataFrame:
    """The fifteen text columns of a nested verdict; what is missing is empty, issues are joined by ` | `."""
    return verdicts.select(
        text_or_empty("id").alias("id"), text_or_empty("intentEval.status").alias("intent_status"), text_or_empty("intentEval.suggestedIntent").alias("intent_suggested"), text_or_empty("intentEval.reason").alias("intent_reason"),
        text_or_empty("taskTypeEval.status").alias("task_status"), text_or_empty("taskTypeEval.suggestedTaskType").alias("task_suggested"), text_or_empty("taskTypeEval.reason").alias("task_reason"),
        text_or_empty("entityEval.status").alias("entity_status"), text_or_empty("entityEval.reason").alias("entity_reason"), text_or_empty("utteranceEval.quality").alias("utterance_quality"),
        F.coalesce(F.array_join("utteranceEval.issues", " | "), F.lit("")).alias("utterance_issues"), text_or_empty("utteranceEval.suggestedRewrite").alias("utterance_rewrite"),
        text_or_empty("suitability").alias("suitability"), text_or_empty("severity").alias("severity"), text_or_empty("overallReason").alias("overall_reason"),
    )


def replaced(current: str, suggested: str) -> Column:
    return F.coalesce(F.nullif(F.col(suggested), F.lit("")), F.col(current))


def route(rows: DataFrame, verdicts: DataFrame) -> DataFrame:
    """Rows (id, intent, task) with `route` and `outcome`; the first rule that fits decides.

    Verdicts (id, pos, suitability, entity_status, quality, suggested_intent, suggested_task, reason, rewrite), the last one per
    id counting. unaudited: clean. DELETE: dropped. Wrong entities or a LOW utterance: manual, with labels repaired,
    the reason and, for LOW, the rewrite. Else clean, auto_fixed if a label changed.
    """
    joined = rows.join(newest(verdicts, "id", "pos").withColumn("audited", F.lit(True)), "id", "left")
    intent, task = replaced("intent", "suggested_intent"), replaced("task", "suggested_task")
    low = F.coalesce(F.col("quality") == "LOW", F.lit(False))
    manual = F.coalesce(F.col("entity_status") != "PERFECT", F.lit(False)) | low
    audited, gone = F.col("audited").isNotNull(), F.coalesce(F.col("suitability") == "DELETE", F.lit(False))
    changed = (intent != F.col("intent")) | (task != F.col("task"))
    outcome = F.when(~audited, "unaudited").when(gone, "dropped").when(manual, "manual_review").when(changed, "auto_fixed").otherwise("perfect")
    to = F.when(gone, "dropped").when(audited & manual, "manual").otherwise("clean")
    keep = audited & ~gone
    return joined.select(
        "id", F.when(keep, intent).otherwise(F.col("intent")).alias("intent"), F.when(keep, task).otherwise(F.col("task")).alias("task"), to.alias("route"), outcome.alias("outcome"),
        F.when(to == "manual", F.coalesce("reason", F.lit(""))).alias("audit_reason"), F.when((to == "manual") & low, F.coalesce("rewrite", F.lit(""))).alias("suggested_rewrite"),
    )


def outcomes(routed: DataFrame) -> DataFrame:
    return routed.groupBy("outcome").agg(F.count(F.lit(1)).alias("n"))


def audit_templates(templates: DataFrame, verdicts: DataFrame) -> DataFrame:
    """(template_id, template): KEEP and unaudited stay, MODIFY takes the rewrite or goes without one, DELETE goes."""
    joined = templates.join(newest(verdicts, "template_id", "pos"), "template_id", "left")
    text = F.when(F.col("action") == "MODIFY", F.nullif(F.col("rewrite"), F.lit(""))).when(F.col("action") == "DELETE", F.lit(None)).otherwise(F.col("template"))
    return joined.select("template_id", text.alias("template")).where("template is not null")


def closed_histogram(rows: DataFrame, columns: dict[str, list[str]]) -> DataFrame:
    """(field, value, n): counts of declared values, zero where there is none; other values don't count. One pass."""
    counts = [F.count_if(F.col(c) == v).alias(f"{c}\0{v}") for c, values in columns.items() for v in values]
    pairs = [F.struct(F.lit(c).alias("field"), F.lit(v).alias("value"), F.col(f"{c}\0{v}").alias("n")) for c, values in columns.items() for v in values]
    return rows.agg(*counts).select(F.explode(F.array(*pairs)).alias("x")).select("x.*")


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """Adds `rn`, 1 for the first row. Rows of a range of the first key are numbered together, and ranges are offset by the counts before them, so no task sees all rows."""
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # The bounds of ranges come from a sample, so the ranges are written once and read by both sides.
    path = scratch(spark, "ranges")
    rows.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()).write.parquet(path)
    ranged = spark.read.parquet(path)
    counts = ranged.groupBy("__part").agg(F.count(F.lit(1)).alias("__n"))
    offsets = counts.withColumn("__before", F.coalesce(F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("__n")
    within = F.row_number().over(Window.partitionBy("__part").orderBy(*order))
    return ranged.withColumn("__rn", within).join(F.broadcast(offsets), "__part").withColumn("rn", (F.col("__rn") + F.col("__before")).cast("bigint")).drop("__part", "__rn", "__before")


def batches(numbered_rows: DataFrame, key: str, size: int = 50) -> DataFrame:
    """(batch, n, first_key, last_key): rows in batches of `size`, the last one ragged."""
    number = (F.floor((F.col("rn") - 1) / size) + 1).cast("bigint")
    return numbered_rows.groupBy(number.alias("batch")).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first_key"), F.max(key).alias("last_key"))


def resumed_batches(numbered_rows: DataFrame, done: int, size: int = 50, start: int = 0, most: int = 0) -> DataFrame:
    """The rows that a run takes up after `done` rows of earlier runs, with their `batch`.

    The first `start` rows are never taken, `most` (0: all) are at most. Batches are cut anew from the first row taken, and
    their numbers go on from those that the rows before fill.
    """
    skip = start + done
    taken = numbered_rows.where((F.col("rn") > skip) & (F.col("rn") <= skip + most if most else F.lit(True)))
    return taken.withColumn("batch", (F.floor((F.col("rn") - skip - 1) / size) + skip // size + 1).cast("bigint"))


class Provider(Protocol):
    """Judges a batch of records; one verdict per record, in order."""

    def judge(self, records: list[dict]) -> list[dict]: ...


class OfflineProvider:
    """A deterministic stand-in for a remote model: every record passes."""

    def judge(self, records: list[dict]) -> list[dict]:
        return [{"id": r["id"], "suitability": "KEEP", "reason": ""} for r in records]


class FailingProvider(OfflineProvider):
    """A stand-in that fails for batches whose first identifier a number divides."""

    def __init__(self, by: int) -> None:
        self.by = by

    def judge(self, records: list[dict]) -> list[dict]:
        if int(records[0]["id"]) % self.by == 0:
            raise ConnectionError(f"no answer for {records[0]['id']}")
        return super().judge(records)


#: Providers by name; callers may add their own.
PROVIDERS: dict[str, Callable[[], Provider]] = {"offline": OfflineProvider}
EXHAUSTED = "max retries exceeded"
VERDICT = "id string, suitability string, reason string, error string"


def judge_with(rows: DataFrame, name: str, size: int = 50) -> DataFrame:
    """(id, suitability, reason, error): the named provider's verdicts; of an unknown name an error for every row."""
    ids = rows.withColumn("id", F.col("id").cast("string"))
    if name not in PROVIDERS:
        none = F.lit(None).cast("string")
        return ids.select("id", none.alias("suitability"), none.alias("reason"), F.lit(f"unknown provider: {name}").alias("error"))
    return judge(ids, PROVIDERS[name](), size)


def with_retries(call: Callable[[], list[dict]], tries: int = 3, wait: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> list[dict]:
    """The call's result, tried again after waits that double; the last error is raised."""
    for k in range(tries):
        try:
            return call()
        except Exception:
            if k == tries - 1:
                raise
            sleep(wait * 2**k)
    return []


def first_answer(calls: list[Callable[[], list[dict]]], wait: float = 2.0, sleep: Callable[[float], None] = time.sleep) -> tuple[list[dict] | None, int]:
    """(result of the first call in turn that succeeds or none, how many failed); waits between calls double."""
    for k, call in enumerate(calls):
        with contextlib.suppress(Exception):
            return call(), k
        if k < len(calls) - 1:
            sleep(wait * 2**k)
    return None, len(calls)


def judge(rows: DataFrame, provider: Provider, size: int = 50, tries: int = 3, wait: float = 2.0) -> DataFrame:
    """Verdicts (id, suitability, reason, error) of a provider that is called per `size` rows, inside the tasks.

    Rows of a batch for which every try failed get an error instead of a verdict; the task goes on.
    """

    kind = pa.schema([(c, pa.string()) for c in ("id", "suitability", "reason", "error")])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for low in range(0, part.num_rows, size):
                records = part.slice(low, size).to_pylist()
                found, _ = first_answer([lambda r=records: provider.judge(r)] * tries, wait)
                yield pa.RecordBatch.from_pylist(found if found is not None else [{"id": r["id"], "error": EXHAUSTED} for r in records], schema=kind)

    return rows.mapInArrow(run, VERDICT)


def judge_rotating(batched: DataFrame, models: dict[str, Provider], tries: int = 3, wait: float = 2.0) -> DataFrame:
    """(batch, tried, model, id, suitability, reason, error) of rows (batch, id, ...): calls go round the models.

    Batch number b begins with model b - 1 in turn and each retry goes to the next one, so a batch's calls don't depend on
    where it runs or whether it runs again. `tried` lists the models that failed for the batch, `model` is the one that
    judged it; after the last try its rows get an error. A batch is small by construction and is judged as one.
    """
    names = list(models)

    kind = pa.schema([("batch", pa.int64()), ("tried", pa.list_(pa.string())), *((c, pa.string()) for c in ("model", "id", "suitability", "reason", "error"))])

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        records, number = sorted(rows.to_pylist(), key=lambda r: r["id"]), key[0].as_py()
        turn = [names[(number - 1 + k) % len(names)] for k in range(tries)]
        found, failed = first_answer([lambda m=m: models[m].judge(records) for m in turn], wait)
        verdicts = found if found is not None else [{"id": r["id"], "error": EXHAUSTED} for r in records]
        common = {"batch": number, "tried": turn[:failed], "model": None if found is None else turn[failed]}
        return pa.Table.from_pylist([{**v, **common, "id": str(v["id"])} for v in verdicts], schema=kind)

    return batched.groupBy("batch").applyInArrow(run, f"batch bigint, tried array<string>, model string, {VERDICT}")


def model_shares(judged: DataFrame) -> DataFrame:
    """(model, n_judged, n_failed): rows that a model judged and batches that it failed for; null is what no model judged."""
    done = judged.groupBy("model").agg(F.count(F.lit(1)).alias("n_judged"))
    failed = judged.select("batch", "tried").distinct().select(F.explode("tried").alias("of")).groupBy("of").agg(F.count(F.lit(1)).alias("n_failed"))
    both = done.join(failed, F.col("model") == F.col("of"), "full_outer")
    return both.select(F.coalesce("model", "of").alias("model"), F.coalesce("n_judged", F.lit(0)).alias("n_judged"), F.coalesce("n_failed", F.lit(0)).alias("n_failed"))
