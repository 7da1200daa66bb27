"""Exact deduplication as a stateful stream.

Documents become records of content digest, identifier and locator (file and row). A stream over the files of records
is grouped by digest in a keyed state store that lives on disk (RocksDB), without watermark, so no key ever expires.
Per digest the state retains the largest stable identifier, the locator of its content and the number of rows. Every
micro-batch writes the groups it changed to a table; the newest row per digest is the state. Hits are accepted only
after a comparison of full bytes: of the texts of every digest with several rows, the least and the greatest have to be
equal, which aggregates before anything is shuffled, so that a group of any size is checked without meeting in one
task. Rows of a digest that stands for several texts fall back to groups of their own bytes.

Texts are only shuffled for that comparison, never those of rows without copies while the digests that have copies are at most
`BROADCAST` (beyond, they are joined by digest).

Defined results: a null text counts as empty; empty texts are equal to each other; a null identifier is the
smallest; rows that repeat an identifier and text all point at the same keeper and `kept` marks each of them
(`keep_one` leaves one); an empty table gives an empty result; further columns are ignored, also when they carry
the names of result columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ascii_lower, located, near, remove, shared_path, table, written

STORE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.allowFAllocate": "false",
    "spark.sql.streaming.stateStore.rocksdb.boundedMemoryUsage": "true",
    "spark.sql.streaming.stateStore.rocksdb.maxMemoryUsageMB": "96",
}
BROADCAST = 250_000  # digests with copies that may be broadcast


def sha256(text: Column) -> Column:
    return F.unhex(F.sha2(text.cast("binary"), 256))


def folded(text_col: str) -> Column:
    """A-Z lower-cased text, null as empty."""
    return ascii_lower(F.coalesce(F.col(text_col), F.lit("")))


def records(placed: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """(digest, id, file, row) of located documents, batch or stream."""
    return placed.select(digest(folded(text_col)).alias("digest"), F.col(id_col).alias("id"), F.col("__at_file").alias("file"), F.col("__at_row").alias("row"))


def run_stream(spark: SparkSession, source: DataFrame, table_path: str, checkpoint: str) -> None:
    """Bring the digest table at `table_path` up to date with all records of the stream that are new to `checkpoint`.

    Rerunning with the same checkpoint takes up the state where the last run left it.
    """
    state = source.groupBy("digest").agg(F.max(F.struct("id", "file", "row")).alias("keeper"), F.count(F.lit(1)).alias("group_size"))

    def store(batch: DataFrame, number: int) -> None:
        batch.withColumn("batch", F.lit(number).cast("long")).write.mode("overwrite").parquet(f"{table_path}/run={number}")

    before = {k: spark.conf.get(k, None) for k in STORE}
    try:
        for k, v in STORE.items():
            spark.conf.set(k, v)
        query = state.writeStream.outputMode("update").trigger(availableNow=True).option("checkpointLocation", checkpoint).foreachBatch(store).start()
        query.awaitTermination()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v) if v is not None else spark.conf.unset(k)


def read_state(spark: SparkSession, table_path: str, digest_type: str = "binary") -> DataFrame:
    """(digest, keeper, group_size): the newest row per digest of all that the stream has written."""
    schema = f"digest {digest_type}, keeper struct<id: bigint, file: string, row: bigint>, group_size bigint, batch bigint, run long"
    rows = spark.read.schema(schema).option("basePath", table_path).parquet(table_path)
    return rows.groupBy("digest").agg(F.max_by(F.struct("keeper", "group_size"), "batch").alias("s")).select("digest", "s.*")


def decisions(placed: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256, files_per_batch: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(digest, id, file, row) of all rows, and (digest, keeper, group_size) of the digests with several rows after all of them went through the stream.

    Where a digest stands for several texts, `digest` has the text itself behind it in both tables.
    """
    spark, work = placed.sparkSession, shared_path(placed.sparkSession, "dedup")
    rows = written(records(placed, id_col, text_col, digest), "records", work)
    reader = spark.readStream.schema(rows.schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    run_stream(spark, reader.parquet(f"{work}/records"), f"{work}/table", f"{work}/checkpoint")
    kind = rows.schema["digest"].dataType.simpleString()
    copies = read_state(spark, f"{work}/table", kind) if rows.head(1) else rows.select("digest", F.struct("id", "file", "row").alias("keeper"), F.lit(1).cast("long").alias("group_size"))
    copies = written(copies.where("group_size > 1"), "dedup-copies")
    remove(spark, f"{work}/checkpoint")
    remove(spark, f"{work}/table")
    # Full bytes: a digest whose texts aren't all equal is no group.
    text = folded(text_col)
    texts = placed.select(digest(text).alias("digest"), text.alias("t")).join(near(copies.select("digest"), BROADCAST), "digest", "left_semi")
    clashes = written(texts.groupBy("digest").agg(F.min("t").alias("low"), F.max("t").alias("high")).where("low <> high").select("digest"), "dedup-clashes")
    if clashes.isEmpty():
        return rows, copies
    wide = lambda d: d.cast("binary")
    own = placed.select(digest(text).alias("digest"), text.alias("t"), F.col(id_col).alias("id"), F.col("__at_file").alias("file"), F.col("__at_row").alias("row")).join(clashes, "digest", "left_semi")
    own = written(own.withColumn("digest", F.concat(wide(F.col("digest")), F.lit(b"\0"), wide(F.col("t")))).drop("t"), "dedup-own")
    groups = own.groupBy("digest").agg(F.max(F.struct("id", "file", "row")).alias("keeper"), F.count(F.lit(1)).alias("group_size")).where("group_size > 1")
    apart = lambda df: df.join(clashes, "digest", "left_anti").withColumn("digest", F.concat(wide(F.col("digest")), F.lit(b"\1")))
    return apart(rows).unionByName(own), written(apart(copies).unionByName(groups), "dedup-copies")


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256, files_per_batch: int | None = None) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row per row of `docs`."""
    placed = located(docs.select(id_col, text_col))
    rows, copies = decisions(placed, id_col, text_col, digest, files_per_batch)
    if digest is not sha256:
        texts = placed.select(sha256(folded(text_col)).alias("sha"), F.col("__at_file").alias("file"), F.col("__at_row").alias("row"))
        rows = rows.join(texts, ["file", "row"])
    else:
        rows = rows.withColumn("sha", F.substring("digest", 1, 32))
    found = rows.join(near(copies, BROADCAST), "digest", "left")
    keep = F.when(F.col("keeper").isNull(), F.col("id")).otherwise(F.col("keeper.id"))
    return found.select(F.col("id").alias(id_col), keep.alias("keep_id"), F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"), F.col("id").eqNullSafe(keep).alias("kept"), F.lower(F.hex("sha")).alias("text_sha256"))


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest: Callable[[Column], Column] = sha256) -> DataFrame:
    """The rows of `docs` that stay, one for each group, by file and place."""
    placed = located(docs)
    rows, copies = decisions(placed, id_col, text_col, digest)
    gone = rows.join(near(copies, BROADCAST), "digest").where((F.col("file") != F.col("keeper.file")) | (F.col("row") != F.col("keeper.row")))
    gone = near(written(gone.select(F.col("file").alias("__at_file"), F.col("row").alias("__at_row")), "dedup-gone"), BROADCAST)
    return placed.join(gone, ["__at_file", "__at_row"], "left_anti").select(*docs.columns)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(table(spark, sf_dir, "documents"))


ORACLE = """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""
