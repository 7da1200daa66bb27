"""Edges that the data of the catalogue's queries doesn't reach."""

import hashlib
import json
import os
import shutil
import subprocess
import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from millrace.functions import text as T
from millrace.operators import audit, calibrate, generate, metrics, nlu, quality, sequence
from millrace.plans import quality_queries
from millrace.sources import io
from millrace.streaming import resume


def column(spark, values, make):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r.y for r in df.select("i", make(F.col("x")).alias("y")).orderBy("i").collect()]


def test_tokenisers_differ_where_they_should(spark):
    assert column(spark, ["Pay 1,250.50 now. a.\nB?", "1,2,3", "", None], T.tokens_decimal) == [["pay", "1250.50", "now", "a", "b"], ["12", "3"], [], None]
    assert column(spark, ["a\tb  c.d", "x\ny"], T.tokens_punct) == [["a\tb", "c", "d"], ["x\ny"]]
    assert column(spark, ["a\tb  c.d", "x\ny"], T.tokens_space) == [["a", "b", "c", "d"], ["x", "y"]]
    assert column(spark, ["a. b!;c\r\nd"], T.sentences) == [["a", "b", "c", "d"]]
    assert column(spark, ["hELLO"], T.capitalise) == ["HELLO"]


def test_functions_at_edges(spark):
    assert column(spark, ["aaaa", "", None], lambda c: T.overlapping_count(c, F.lit("aa"))) == [3, 0, None]
    for key in ("aa", "aba", "abc", "a.b", "\\E"):
        texts = ["aaaa", "ababa", "abcabc", "a.b.a.b", "x\\E\\E", "", None]
        want = [None if t is None else sum(t.startswith(key, i) for i in range(len(t))) for t in texts]
        assert column(spark, texts, lambda c: T.overlapping_count(c, F.lit(key))) == want == column(spark, texts, lambda c: T.literal_count(c, key))
    numbers = [0.0, 7.5, 999.0, 1000.0, 123456.78, 1234567.0, -9876543.21, None]
    assert column(spark, [None if x is None else str(x) for x in numbers], lambda c: T.grouped_digits(c.cast("double"))) == ["0", "7.5", "999", "1,000", "123,456.78", "1,234,567", "-9,876,543.21", None]
    assert column(spark, [None if x is None else str(x) for x in numbers], lambda c: T.grouped_digits(c.cast("double"), indian=True)) == ["0", "7.5", "999", "1,000", "1,23,456.78", "12,34,567", "-98,76,543.21", None]
    words = [f"word{k}" for k in range(400)] + ["abc", ""]
    slipped = column(spark, words, lambda c: T.typo(c, {"o": "p"}, c))
    assert slipped[-2:] == ["abc", ""] and all(a[:1] == b[:1] and len(a) == len(b) and sum(x != y for x, y in zip(a, b)) <= 4 for a, b in zip(words, slipped))
    assert column(spark, ["$1,200.5", "none"], T.amount_digits) == ["1200.5", "none"]
    assert column(spark, ['a "b"', "plain", "x\ny"], T.csv_field) == ['"a ""b"""', "plain", '"x\ny"']
    assert column(spark, ["THE cat là the"], lambda c: T.replace_word(c, "the", "d$")) == ["d$ cat là d$"]
    assert column(spark, ["The dog is here"], T.grammar_slips) == ["dog are here"]


def test_generator_draws(spark):
    def plain(seed, n):
        a = seed & 0xFFFFFFFF
        for _ in range(n):
            a = (a + 0x6D2B79F5) & 0xFFFFFFFF
        t = ((a ^ (a >> 15)) * (1 | a)) & 0xFFFFFFFF
        t = ((t + (((t ^ (t >> 7)) * (61 | t)) & 0xFFFFFFFF)) & 0xFFFFFFFF) ^ t
        return ((t ^ (t >> 14)) & 0xFFFFFFFF) / 4294967296

    rows = spark.range(50).select("id", T.mulberry_draw(F.col("id"), 1).alias("a"), T.mulberry_draw(F.col("id"), F.lit(7)).alias("b")).collect()
    assert all(r.a == plain(r.id, 1) and r.b == plain(r.id, 7) for r in rows)


def tags(spark, *rows):
    data = [(i, p, f"t{p}", t) for i, r in enumerate(rows) for p, t in enumerate(r.split())]
    return spark.createDataFrame(data, "id int, pos int, token string, tag string")


def strict(row):
    out, cur = [], None
    for p, t in enumerate(row.split()):
        if t.startswith("B-"):
            cur = [p, p, t[2:]]
            out.append(cur)
        elif t.startswith("I-") and cur and cur[2] == t[2:]:
            cur[1] = p
        else:
            cur = None
    return sorted(map(tuple, out))


def salvage(row):
    out, cur = [], None
    for p, t in enumerate(row.split()):
        if t.startswith("B-") or (t.startswith("I-") and (not cur or cur[2] != t[2:])):
            cur = [p, p, t[2:]]
            out.append(cur)
        elif t.startswith("I-"):
            cur[1] = p
        elif t in ("O", "<PAD>"):
            cur = None
    return sorted(map(tuple, out))


@pytest.mark.parametrize(("decode", "fold"), [(sequence.decode_strict, strict), (sequence.decode_salvage, salvage)])
def test_decoders_equal_their_folds(spark, decode, fold):
    rows = ["B-A I-A O I-A B-B I-A I-B", "I-A I-A B-A B-A O", "B-A I-B I-A I-A", "O O", "B-A <PAD> I-A", "B-A I-A"]
    found = decode(tags(spark, *rows), "id").collect()
    for i, row in enumerate(rows):
        assert sorted((r.start, r.end, r.label) for r in found if r.id == i) == fold(row)


def test_emit_then_decode(spark):
    df = spark.createDataFrame([(1, ["new", "york"], "place"), (2, ["x"], None)], "id int, tokens array<string>, slot string")
    out = {r.id: r.t for r in df.select("id", sequence.emit_tags(F.col("tokens"), F.col("slot")).alias("t")).collect()}
    assert out == {1: ["B-PLACE", "I-PLACE"], 2: ["O"]}


def test_gate(spark):
    specs = spark.createDataFrame([("a", ["x", "y"], {"x": ["p"], "z": ["q"]}), ("b", ["x"], {"x": []})], "intent string, supported_actions array<string>, utterance_patterns map<string,array<string>>")
    rows = spark.createDataFrame([("Hi", "a", "x"), ("hi", "a", "y"), ("yo", "c", "x")], "utterance string, intent string, action string")
    least = spark.createDataFrame([("a", 2)], "intent string, least int")
    found = quality.report(rows, specs, quality.valid_combos(specs), least)
    assert {r.check for r in found.collect()} == {"coverage", "unknown", "combination", "conflict", "diversity"}
    with pytest.raises(ValueError, match="gate"):
        quality.require_clean(found)
    quality.require_clean(found.limit(0))
    assert {(r.intent, r.action, r.fault) for r in quality.authoring_faults(specs).collect()} == {("a", "y", "no patterns"), ("b", "x", "no patterns"), ("a", "z", "not supported")}


def test_routes_cover_all_rows(spark):
    rows = spark.createDataFrame([(i, "a", "t") for i in range(6)], "id long, intent string, task string")
    shape = "id long, pos int, suitability string, entity_status string, quality string, suggested_intent string, suggested_task string, reason string, rewrite string"
    given = spark.createDataFrame([(0, 1, "DELETE", None, None, None, None, None, None), (0, 2, "KEEP", None, None, "", None, None, None), (1, 1, "DELETE", "BAD", "LOW", None, None, "r", "w"), (2, 1, "KEEP", "BAD", "HIGH", "b", None, "r", None), (3, 1, "KEEP", "PERFECT", "HIGH", "b", None, None, None), (4, 1, "MODIFY", "PERFECT", "LOW", None, None, "r", "w"), (None, 1, "DELETE", None, None, None, None, None, None)], shape)
    out = {r.id: (r.route, r.outcome, r.intent, r.suggested_rewrite) for r in audit.route(rows, given).collect()}
    assert out == {0: ("clean", "perfect", "a", None), 1: ("dropped", "dropped", "a", None), 2: ("manual", "manual_review", "b", None), 3: ("clean", "auto_fixed", "b", None), 4: ("manual", "manual_review", "a", "w"), 5: ("clean", "unaudited", "a", None)}


def test_numbers_are_dense_and_ordered(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"))
    got = [(r.k, r.rn) for r in audit.numbered(rows, "k").orderBy("rn").collect()]
    assert got == [(k, k + 1) for k in range(1000)]


def test_providers(spark):
    rows = spark.createDataFrame([(str(i),) for i in range(120)], "id string")
    assert audit.judge(rows, audit.OfflineProvider(), 50).count() == 120
    waits, calls = [], []

    def failing():
        calls.append(1)
        if len(calls) < 3:
            raise OSError
        return [{}]

    assert audit.with_retries(failing, 3, 2.0, waits.append) == [{}] and waits == [2.0, 4.0]
    with pytest.raises(OSError):
        audit.with_retries(lambda: (_ for _ in ()).throw(OSError()), 2, 1.0, waits.append)


def test_reports_of_nothing(spark):
    empty = spark.createDataFrame([], "truth string, predicted string")
    assert {r.label: r.f1 for r in metrics.class_report(empty).collect() if r.label == "accuracy"} == {"accuracy": 0.0}
    rows = spark.createDataFrame([("x", None, 1.0, "a", None, None, "a", None, "")], "error string, a_latency double, a_confidence double, a_intent string, b_latency double, b_confidence double, b_intent string, amount double, merchant string")
    one = metrics.engine_comparison(rows).first()
    assert (one.n_total, one.n_error, one.n_valid, one.agreement) == (1, 1, 0, None)


def test_ties_and_dimensions(spark):
    classes = spark.createDataFrame([("b", [0.0, 1.0]), ("a", [0.0, -1.0]), ("c", [0.0])], "label string, centroid array<double>")
    got = calibrate.nearest(spark.createDataFrame([([0.0, 0.0],)], "embedding array<double>"), classes).first()
    assert (got.nearest, got.distance, got.accepted) == ("a", 1.0, None)
    assert spark.range(1).select(calibrate.argmax(F.array(F.lit(1.0), F.lit(3.0), F.lit(3.0))).alias("k")).first().k == 1


def test_understanding(spark):
    assert column(spark, ["5 kids", "2 crores", "1.5 lakh", "$1,200.50", "none", ""], nlu.amount) == [5000.0, 20000000.0, 150000.0, 1200.5, None, None]
    df = spark.createDataFrame([("",), ("hello",), ("I paid for food and coffee",), ("can i buy it",)], "text string")
    got = [(r.intent, r.confidence) for r in nlu.intent_of(df, "text").collect()]
    assert got[0] == ("UNKNOWN", 1.0) and got[1] == ("UNKNOWN", 0.42) and got[2][0] == "ADD_EXPENSE" and got[3][0] == "AFFORDABILITY_CHECK"


def test_unknown_slots(spark):
    pool = generate.indexed_pool(spark.createDataFrame([("a", "x")], "slot string, value string"))
    rows = spark.createDataFrame([(1, "say {A} {b}")], "id int, template string")
    got = generate.fill_slots(rows, pool, "s", "template", "id").first()
    assert (got.text, got.slots) == ("say x {b}", "a=x")
    assert generate.fill_slots(rows, pool, "s", "template", "id", compat=True).first().slots == "a=x|b={b}"


def test_files(spark, tmp_path):
    p = tmp_path / "x.jsonl"
    p.write_text('{"id": 1}\n\n{broken\n{"id": 2}\n')
    schema = spark.createDataFrame([], "id int").schema
    good, bad = io.read_jsonl_logged(spark, str(p), schema)
    assert sorted(r.id for r in good.collect()) == [1, 2] and [r.line for r in bad.collect()] == ["{broken"]
    assert sorted(r.id for r in io.read_jsonl_lenient(spark, str(p), schema).collect()) == [1, 2]
    with pytest.raises(Exception, match="MALFORMED|FAILFAST"):
        io.read_jsonl_strict(spark, str(p), schema).collect()
    (tmp_path / "doc.json").write_text(json.dumps({"samples": [{"a": 1}, {"a": 2}]}))
    (tmp_path / "list.json").write_text(json.dumps([{"a": 1}]))
    assert io.read_document(spark, str(tmp_path / "doc.json")).count() == 2 and io.read_document(spark, str(tmp_path / "list.json")).count() == 1
    (tmp_path / "specs").mkdir()
    (tmp_path / "specs" / "a.intent.json").write_text('{\n"intent": "a"\n}')
    (tmp_path / "specs" / "other.json").write_text('{"intent": "no"}')
    assert [r.intent for r in io.read_specs(spark, str(tmp_path / "specs")).collect()] == ["a"]
    io.write_csv(spark.createDataFrame([('a "q"', None)], "x string, y string").coalesce(1), str(tmp_path / "csv"))
    text = "".join(f.read_text() for f in (tmp_path / "csv").glob("*.csv"))
    assert text == 'x,y\n"a ""q""",\n'
    io.write_routes(spark.createDataFrame([(1, "clean"), (2, "manual")], "id int, route string"), str(tmp_path / "routes"))
    assert {f.name for f in (tmp_path / "routes").glob("route=*")} == {"route=clean", "route=manual"}
    io.write_document(spark.createDataFrame([(1,)], "n int"), str(tmp_path / "one.json"))
    assert json.loads((tmp_path / "one.json").read_text()) == {"n": 1}
    assert io.result_names("/x/train.jsonl")["clean.jsonl"] == "train_clean.jsonl"


def test_stream_takes_up_where_it_stopped(spark, tmp_path):
    (tmp_path / "in").mkdir()
    judge = lambda batch: batch.withColumn("ok", F.lit(True))
    run = lambda: resume.run_available(spark, str(tmp_path / "in"), "id int", judge, str(tmp_path / "out"), str(tmp_path / "check"))
    (tmp_path / "in" / "a.json").write_text('{"id": 1}\n{"id": 2}\n')
    run()
    (tmp_path / "in" / "b.json").write_text('{"id": 3}\n')
    run()
    done = spark.read.json(str(tmp_path / "out"))
    assert sorted(r.id for r in done.collect()) == [1, 2, 3]
    rows = spark.createDataFrame([(2,), (9,)], "id int")
    assert [r.id for r in resume.pending(rows, done.select(F.col("id").cast("int").alias("id"))).collect()] == [9]


def test_windowed_counts(spark, data):
    events = spark.read.parquet(f"{data}/events.parquet")
    assert resume.event_counts(events).agg(F.sum("n")).first()[0] == events.count()


def test_providers_by_name(spark):
    rows = spark.createDataFrame([(1,), (2,)], "id long")
    assert {(r.id, r.suitability, r.error) for r in audit.judge_with(rows, "offline").collect()} == {("1", "KEEP", None), ("2", "KEEP", None)}
    assert {r.error for r in audit.judge_with(rows, "nowhere").collect()} == {"unknown provider: nowhere"}


def test_optional_file(spark, tmp_path):
    schema = StructType().add("name", "string")
    assert io.read_optional(spark, str(tmp_path / "none.jsonl"), schema).count() == 0
    (tmp_path / "some.jsonl").write_text('{"name": "a"}\n{broken\n')
    assert [r.name for r in io.read_optional(spark, str(tmp_path / "some.jsonl"), schema).collect()] == ["a"]


def test_library_without_the_training_data_operators(tmp_path):
    """In a copy without them the entry still has all other queries."""
    root = Path(__file__).resolve().parents[1]
    shutil.copytree(root / "millrace", tmp_path / "millrace", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    code = "import __spark_entry__ as e; print(*e.queries()); assert set(e.oracle_sql()) == set(e.queries())"
    for with_pipeline in (True, False):
        for name in ("__spark_entry__.py", "corpus_pipeline.py"):
            if (root / name).exists() and (with_pipeline or name == "__spark_entry__.py"):
                shutil.copy(root / name, tmp_path / name)
            else:
                (tmp_path / name).unlink(missing_ok=True)
        names = subprocess.run([sys.executable, "-c", code], cwd=tmp_path, capture_output=True, text=True, env={**os.environ, "PYTHONPATH": str(tmp_path)}, check=True).stdout.split()
        assert len(names) > 90 and not {n for n in names if n.startswith("op") or n == "pipeline"}


def test_the_gate_shuffles_no_texts(spark, tmp_path):
    filler = lambda k: "".join(hashlib.sha256(f"{k} {i}".encode()).hexdigest() for i in range(150))
    rows = [(k, f"{'Ab' if k % 2 else 'aB'} {filler(k - k % 2 if k < 20 else k)}", "en" if k % 4 != 1 else "de", "src1") for k in range(200)] + [(200, None, "en", "src1"), (201, None, "de", "src1"), (202, "x", None, "src1")]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    context = spark.sparkContext._jsc.sc()

    def shuffled():
        context.listenerBus().waitUntilEmpty()
        return context.statusStore().executorList(False).apply(0).totalShuffleWrite()

    before = shuffled()
    got = quality_queries.v_gate_publish(spark, str(tmp_path))
    # Below 20 every second pair of texts is the same but for case, under two labels.
    assert sorted(r.doc_id for r in got.collect()) == [k for k in range(200) if k >= 20 or k % 4 > 1]
    assert shuffled() - before < sum(len(r[1] or "") for r in rows) / 2
    want = {(rows[k][1].lower(), 2, "de|src1,en|src1") for k in range(0, 20, 4)} | {(None, 2, "de|src1,en|src1")}
    assert {tuple(r) for r in quality.conflicts(spark.createDataFrame(rows, "doc_id long, utterance string, intent string, action string")).collect()} == want
