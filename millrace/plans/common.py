"""Inputs that the queries of this package share, with the same inputs in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def utterances(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as labelled utterances: the language as intent, the source as action."""
    return table(spark, sf_dir, "documents").select("doc_id", F.col("text").alias("utterance"), F.col("lang").alias("intent"), F.col("source").alias("action"))


#: Intents that specs declare, and the actions that they support; one label of the data is left out, one has no rows.
DECLARED = ("de", "en", "es", "it")
SUPPORTED = tuple(f"src{k}" for k in range(0, 18))
LEAST = (("de", 5), ("en", 40), ("es", 3))


def specs(spark: SparkSession) -> DataFrame:
    rows = [(i, list(SUPPORTED)) for i in DECLARED]
    return spark.createDataFrame(rows, "intent string, supported_actions array<string>")


def minimum(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(LEAST), "intent string, least int")


SPECS_SQL = f"""
specs AS (SELECT unnest({list(DECLARED)}) AS intent), supported AS (SELECT unnest({list(SUPPORTED)}) AS action),
combos AS (SELECT intent, action FROM specs, supported),
least AS (SELECT * FROM (VALUES {', '.join(f"('{i}', {n})" for i, n in LEAST)}) AS v(intent, least)),
u AS (SELECT doc_id, text AS utterance, lang AS intent, source AS action FROM documents)
"""


def draw_sql(*parts: str) -> str:
    """SQL for the portable draw of functions.text.draw."""
    text = "concat_ws('|', " + ", ".join(f"CAST({p} AS VARCHAR)" for p in parts) + ")"
    return f"(CAST(('0x' || substr(md5({text}), 1, 8)) AS BIGINT) / 4294967296.0)"


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "conversations")
