"""The corpus pipeline: quality, exact copies, near copies, benchmark leaks, tokens.

Every stage takes (spark, docs, sf_dir), works on all rows that its predecessor kept and returns a DataFrame. All but
the last return the columns of `documents`. Rows are told apart by file and place, not by doc_id, so a row goes for
what its own text is: a row that shares its identifier with a copy or a leak stays, and one without identifier can go.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from millrace.llm import decontaminate, exact_dedup, jaccard_join, quality_cnn, spm_codec
from millrace.llm.common import cleared, remove, shared_path, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the network scores 0.7 or more."""
    parameters = quality_cnn.train(docs, table(spark, sf_dir, "labels"), lambda c: ~quality_cnn.held_out(c))
    scored = quality_cnn.score(docs, parameters, out="__quality")
    return scored.where("__quality >= 0.7").select(*docs.columns)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (A-Z in lower case): the one with the largest doc_id."""
    return exact_dedup.keep_one(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (five-word shingles, Jaccard index 0.8): the one with the smallest doc_id."""
    return jaccard_join.keep_one(docs, n=5, percent=80)


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without an overlap with the benchmark."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source, ids, n_tokens and whether decoding gives the text back."""
    return spm_codec.encode_texts(docs, keep=("doc_id", "lang", "source"))


STAGES = [("quality", quality), ("exact_copies", exact_copies), ("near_copies", near_copies), ("benchmark_leaks", benchmark_leaks), ("tokenise", tokenise)]

#: SQL expresses neither the network nor the tokeniser; tests hold the stages against plainer versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on `documents`, each written and read again; what a stage needed besides goes with it."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = shared_path(spark, f"pipeline-{name}")
        with cleared(spark):
            out = stage(spark, docs, sf_dir)
            out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
        if before:
            remove(spark, before)
        before = path
    return STAGES[-1][1](spark, docs, sf_dir)
