"""Helpers that several training-data operators share."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
TEXT_ROWS = 1000
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One table of a data folder, wherever Spark can read it."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: spark.checkpoint.dir, or one of our own where it is unset and Spark runs in one process (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = current.get() if current.isDefined() else None
    if not base and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    if not base:
        base = "file://" + tempfile.mkdtemp(prefix="millrace-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def shared_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    for paths in _CLEARED[-1:]:
        paths.append(path)
    return path


_CLEARED: list[list[str]] = []


@contextlib.contextmanager
def cleared(spark: SparkSession) -> Iterator[None]:
    """Delete at the end what operators have put into the shared folder meanwhile; what is to stay has to be written to a path of before."""
    _CLEARED.append(paths := [])
    try:
        yield
    finally:
        _CLEARED.remove(paths)
        for path in paths:
            remove(spark, path)


def written(df: DataFrame, name: str, folder: str | None = None, codec: str | None = None) -> DataFrame:
    """Cut the lineage with a table in the shared folder, or a folder below it; a lost executor costs only a reread."""
    spark = df.sparkSession
    path = f"{folder}/{name}" if folder else shared_path(spark, name)
    df.write.parquet(path, compression=codec)
    return spark.read.schema(df.schema).parquet(path)


def located(df: DataFrame) -> DataFrame:
    """The rows with (__at_file, __at_row), the file and place each is read from; what isn't just columns of one table in files is written first."""
    if not df.isStreaming:
        steps = [x.lstrip(" +-:").split(" ")[0] for x in df._jdf.queryExecution().analyzed().toString().splitlines()]
        if steps[-1:] != ["Relation"] or set(steps) - {"Relation", "Project"}:
            df = written(df, "located")
    return df.withColumns({"__at_file": F.col("_metadata.file_path"), "__at_row": F.col("_metadata.row_index")})


def near(df: DataFrame, most: int) -> DataFrame:
    """A table for the small side of a join: broadcast if it has at most `most` rows, else left to a shuffle."""
    return F.broadcast(df) if df.count() <= most else df


def remove(spark: SparkSession, path: str) -> None:
    """Delete a path below the shared folder."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def text_batches(spark: SparkSession) -> None:
    """At most TEXT_ROWS rows in an Arrow batch from now on: whole texts are large, and tasks hold a batch several times.

    It is a setting of the session, since results are computed after the operator has returned; a smaller one stays.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= TEXT_ROWS:
        spark.conf.set(name, TEXT_ROWS)


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only. Pure ASCII texts take the fast built-in, the rest a translation table."""
    return F.when(F.octet_length(text) == F.length(text), F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))
