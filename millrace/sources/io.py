"""Readers and writers of records: JSON lines, JSON documents, spec folders, CSV and routed outputs."""

from __future__ import annotations

import logging
import re
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

CORRUPT = "_corrupt"


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir, or the session's checkpoint folder; where both are unset and Spark runs in one process (tests), below a folder of this machine."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        base = current.get() if current.isDefined() else None
    if not base and not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
    base = base or "file://" + tempfile.mkdtemp(prefix="millrace-")
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def replace_folder(spark: SparkSession, source: str, target: str | None) -> None:
    """Put a folder in another one's place, whatever was there; without a target it goes."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    store = hadoop(source).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if target is None:
        store.delete(hadoop(source), True)
        return
    store.delete(hadoop(target), True)
    if not store.rename(hadoop(source), hadoop(target)):
        raise OSError(f"{source} could not be put in place of {target}")


def small(df: DataFrame, most: int = 200_000) -> DataFrame:
    """A table for the small side of a join: broadcast if it has at most `most` rows, else left to a shuffle."""
    return F.broadcast(df) if df.count() <= most else df


def read_jsonl_strict(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Every line a record; a bad line fails the read, blank lines don't count."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def read_jsonl_logged(spark: SparkSession, path: str, schema: StructType) -> tuple[DataFrame, DataFrame]:
    """(good records, bad lines as text)."""
    full = StructType(list(schema)).add(CORRUPT, StringType())
    lines = spark.read.text(path).where(F.trim("value") != "")
    rows = lines.select("value", F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}).alias("r"))
    bad = F.col(f"r.{CORRUPT}").isNotNull()
    return rows.where(~bad).select(*(F.col(f"r.{c}").alias(c) for c in schema.fieldNames())), rows.where(bad).select(F.col("value").alias("line"))


def read_jsonl_lenient(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Bad lines are left out without a word."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


def read_document(spark: SparkSession, path: str, field: str = "samples") -> DataFrame:
    """The records of a JSON document: the array under `field`, or the document's own array."""
    rows = spark.read.option("multiLine", True).json(path)
    return rows.select(F.explode(field).alias("r")).select("r.*") if field in rows.columns else rows


def read_specs(spark: SparkSession, folder: str, schema: StructType | str | None = None) -> DataFrame:
    """One row per *.intent.json of a folder."""
    reader = spark.read.option("multiLine", True).option("pathGlobFilter", "*.intent.json")
    return (reader.schema(schema) if schema else reader).json(folder)


def write_jsonl(rows: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One record per line; mode `append` adds to earlier runs."""
    rows.write.mode(mode).option("ignoreNullFields", False).json(path)


def write_csv(rows: DataFrame, path: str) -> None:
    """Header, quotes where needed and doubled inside, empty text for nulls."""
    rows.na.fill("").write.mode("overwrite").option("header", True).option("quote", '"').option("escape", '"').option("emptyValue", "").csv(path)


def write_routes(rows: DataFrame, path: str, route: str = "route") -> None:
    """One folder per route, in one pass over the rows."""
    rows.write.mode("overwrite").partitionBy(route).json(path)


def read_optional(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """JSON lines that need not be there: without the file no rows; what can't be parsed is logged and left out."""
    try:
        good, bad = read_jsonl_logged(spark, path, schema)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    if n := bad.count():
        logging.getLogger(__name__).warning("%s: %d lines left out", path, n)
    return good


def write_document(row: DataFrame, path: str) -> None:
    """A table of one row as one pretty-printed JSON file, for reports, wherever Spark can write."""
    found = row.limit(2).count()
    if found != 1:
        raise ValueError(f"a document is one row, not {found}")
    spark, beside = row.sparkSession, f"{path.rstrip('/')}-{uuid.uuid4().hex}"
    row.coalesce(1).select(F.to_json(F.struct("*"), {"pretty": "true"})).write.text(beside)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    store = hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    written = next(x.getPath() for x in store.listStatus(hadoop(beside)) if x.getPath().getName().startswith("part-"))
    store.delete(hadoop(path), True)
    store.rename(written, hadoop(path))
    store.delete(hadoop(beside), True)


def result_names(source: str) -> dict[str, str]:
    """Names of an audit's outputs, scoped by the input's own name."""
    stem = source.rstrip("/").rpartition("/")[2].removesuffix(".jsonl")
    return {k: f"{stem}_{k}" for k in ("row_audit.jsonl", "row_audit.csv", "global_audit.json", "clean.jsonl", "manual_review.jsonl")}
