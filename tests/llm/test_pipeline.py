"""The pipeline's stages against plainer versions, on odd rows and on the smallest data."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from millrace.llm import quality_cnn, spm_codec
from test_dealt import ODD, brute_components, docs_of

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def fold(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


@pytest.fixture(scope="module")
def tables(spark, data, tmp_path_factory):
    """A folder with labels and benchmark of the data, and documents of it beside odd rows."""
    folder = tmp_path_factory.mktemp("tables")
    docs = spark.read.parquet(f"{data}/documents.parquet")
    odd = docs_of(spark, [(None if i is None else i + 10**9, t, lang) for i, t, lang in ODD])
    docs.unionByName(odd.select(docs.columns)).write.parquet(f"{folder}/documents.parquet")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{data}/{name}.parquet").write.parquet(f"{folder}/{name}.parquet")
    return str(folder)


def rows_of(df):
    return sorted((tuple(r) for r in df.select(COLUMNS).collect()), key=str)


def test_stages_equal_plain_versions(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    (_, quality), (_, exact), (_, near), (_, leaks), (_, tokens) = corpus_pipeline.STAGES

    good = quality(spark, docs, tables)
    assert good.columns == docs.columns
    parameters = quality_cnn.train(docs, spark.read.parquet(f"{tables}/labels.parquet"), lambda c: ~quality_cnn.held_out(c))
    rows = rows_of(docs)
    assert rows_of(good) == [r for r in rows if quality_cnn.score_texts([(r[1] or "").encode()], parameters)[0] >= 0.7]

    one = exact(spark, docs, tables)
    assert one.columns == docs.columns
    low, best = -1, {}
    for r in rows:
        key = fold(r[1])
        if key not in best or (low if r[0] is None else r[0]) > (low if best[key][0] is None else best[key][0]):
            best[key] = r
    assert [(r[0], fold(r[1])) for r in rows_of(one)] == sorted(((r[0], fold(r[1])) for r in best.values()), key=str)

    apart = near(spark, one, tables)
    before = rows_of(one)
    smallest = {i: c for i, _, c in brute_components([(r[0], r[1], None) for r in before if r[0] is not None], 5, 80)}
    assert rows_of(apart) == [r for r in before if r[0] is None or smallest[r[0]] == r[0]]

    clean = leaks(spark, apart, tables)
    items = [x for x in (re.findall(r"[^\W_]+", r.text.lower()) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()) if x]
    kept = {r[0] for r in rows_of(clean)}
    assert all(any(" ".join(x) in " ".join(re.findall(r"[^\W_]+", (r[1] or "").lower())) for x in items) <= (r[0] not in kept) for r in rows_of(apart) if r[0] is not None)

    ids = tokens(spark, clean, tables).collect()
    assert len(ids) == clean.count() and all(r.round_trip in (True, None) or "▁" in r.text for r in ids)
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=spm_codec.default_model())
    texts = {r[0]: r[1] for r in rows_of(clean) if r[0] is not None}
    assert all(r.ids == (None if texts[r.doc_id] is None else library.encode(texts[r.doc_id])) for r in ids if r.doc_id is not None)


def test_stages_take_empty_tables_and_further_columns(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet")
    more = docs.withColumns({"score": F.lit("mine"), "component_id": F.lit(1), "__sha": F.lit("x"), "ids": F.lit(2)}).limit(30)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, more, tables)
        assert out.columns == more.columns and out.count() <= 30 and {r.score for r in out.collect()} <= {"mine"}
        assert stage(spark, docs.limit(0), tables).count() == 0
    assert corpus_pipeline.STAGES[-1][1](spark, docs.limit(0), tables).count() == 0


def test_run(spark, data):
    out = corpus_pipeline.run(spark, data)
    n = spark.read.parquet(f"{data}/documents.parquet").count()
    assert 0 < out.count() < n and out.select("doc_id").distinct().count() == out.count()
    assert hashlib.sha256(str(sorted(r.doc_id for r in out.collect())).encode()).hexdigest() == hashlib.sha256(str(sorted(r.doc_id for r in corpus_pipeline.run(spark, data).collect())).encode()).hexdigest()
