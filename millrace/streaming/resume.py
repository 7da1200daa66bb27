"""Incremental audits: a file stream of records whose state, not a count of result lines, says what is done."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def pending(rows: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Rows without a result yet; a batch that failed is taken up again."""
    return rows.join(done.select(key).distinct(), key, "left_anti")


def run_available(spark: SparkSession, folder: str, schema: str, judge: Callable[[DataFrame], DataFrame], out: str, checkpoint: str, files_per_batch: int = 1) -> int:
    """Judge all files that are new to the checkpoint, some at a time; returns the number of micro-batches that ran.

    Every micro-batch overwrites its own folder, so one that is run again after a loss leaves no repeats.
    """

    def store(batch: DataFrame, number: int) -> None:
        judge(batch).write.mode("overwrite").json(f"{out}/batch={number}")

    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(folder)
    query = source.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(store).start()
    query.awaitTermination()
    return sum(1 for p in query.recentProgress if p["numInputRows"] > 0)


def event_counts(events: DataFrame, window: str = "1 day", late: str = "1 hour") -> DataFrame:
    """(start, event_type, n) of tumbling windows; on a stream, windows close once the watermark has passed."""
    timed = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    return timed.groupBy(F.window("at", window).alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


class Quota(StatefulProcessor):
    """Lets the first `most` different texts of a key pass, over all runs of a checkpoint."""

    def __init__(self, most: int, keys: list[str], text: str) -> None:
        self.most, self.keys, self.text = most, keys, text

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getMapState("held", "text string", "at long")
        self.count = handle.getValueState("count", "n long")

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802, N803, ANN001
        n = before = self.count.get()[0] if self.count.exists() else 0
        for frame in rows:
            passed = []
            for text in frame[self.text] if n < self.most else ():
                if n < self.most and not self.held.containsKey((text,)):
                    self.held.updateValue((text,), (n,))
                    passed.append((*key, text, n))
                    n += 1
            if passed:
                yield pd.DataFrame(passed, columns=[*self.keys, self.text, "place"])
        if n > before:
            self.count.update((n,))

    def close(self) -> None:
        pass


def within_quota(rows: DataFrame, most: int, keys: list[str], text: str) -> DataFrame:
    """(keys, text, place) of the first `most` different texts of every key of a stream; keys that hold as many take no more, also in later runs."""
    schema = ", ".join(f"`{k}` {rows.schema[k].dataType.simpleString()}" for k in keys)
    return rows.select(*keys, text).groupBy(*keys).transformWithStateInPandas(Quota(most, keys, text), f"{schema}, `{text}` string, place bigint", "Append", "None")


def fill_quotas(spark: SparkSession, folder: str, schema: str, most: int, keys: list[str], text: str, out: str, checkpoint: str, files_per_batch: int | None = None) -> int:
    """Add to the table at `out` what the JSON files new to the checkpoint have within the quotas; returns the number of rows that the files had."""

    def store(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKSDB)
    try:
        source = spark.readStream.schema(schema)
        source = source.option("maxFilesPerTrigger", files_per_batch) if files_per_batch else source
        query = within_quota(source.json(folder), most, keys, text).writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(store).start()
        query.awaitTermination()
        return sum(p["numInputRows"] for p in query.recentProgress)
    finally:
        spark.conf.set(STORE, before) if before is not None else spark.conf.unset(STORE)
