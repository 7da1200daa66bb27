"""Slots, sampling in rounds, entities, quantiles, nearest classes, providers, quotas and the gate against plainer versions."""

import json
import random
import re
from functools import cache

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.functions import text as T
from millrace.operators import audit, calibrate, generate, nlu, quality
from millrace.streaming import resume


def plan_of(df):
    return df._jdf.queryExecution().toString()


# slots


def test_rows_with_unknown_slots_are_rejected(spark):
    pool = generate.indexed_pool(spark.createDataFrame([("a", "x y")], "slot string, value string"))
    rows = spark.createDataFrame([(1, "say  {A} "), (2, "{a} and {nobody}"), (3, "plain")], "id int, template string")
    got = {r.id: (r.text, r.slots) for r in generate.fill_slots(rows, pool, "s", "template", "id", reject=True).collect()}
    assert got == {1: ("say x y", "a=x y"), 3: ("plain", "")}


def test_typed_slots_are_dispatched_and_tagged(spark):
    pool = generate.indexed_pool(spark.createDataFrame([("source", "The Bank"), ("kind", "food")], "slot string, value string"))
    rows = spark.createDataFrame([(i, "Paid {amount}, {date} from {source} {place1}.", s) for i, s in enumerate(["₹", "$", "", None] * 50)], "id int, template string, symbol string")
    made = generate.slot_tokens(rows, pool, "s", "template", "id", generators=generate.slot_generators("symbol"), aliases={"source": "category"})
    got = {r.id: list(zip(r.tokens, r.tags, strict=True)) for r in made.collect()}
    assert len(got) == 200
    for i, pairs in got.items():
        tags = [g for _, g in pairs]
        assert tags[0] == "O" and tags.count("B-AMOUNT") == tags.count("B-DATE") == tags.count("B-CATEGORY") == 1 and pairs[-1] == ("{place1}", "O")
        assert [t for t, g in pairs if g.endswith("CATEGORY")] == ["the", "bank"]
        amount = " ".join(t for t, g in pairs if g.endswith("AMOUNT"))
        assert re.fullmatch(r"[₹$]?\d+(\.\d+)?( [₹$])?|\d+(\.\d+)? (bucks|quid|rs|inr|dollars)|\d+\.\dk", amount), amount
        assert not (i % 4 >= 2 and re.search("[₹$]", amount))
    compat = generate.slot_tokens(rows.limit(1), pool, "s", "template", "id", generators=generate.slot_generators("symbol"), compat=True).first()
    assert compat.tags[-1] == "B-PLACE1" and "B-SOURCE" in compat.tags


def test_slang_and_slips_are_drawn(spark):
    rows = spark.range(4000).select("id", F.lit("they spent it, the cheap is gone").alias("text"))
    slang = {"UK": {"spent": "san$k", "cheap": "chips\\"}, "XX": {}}
    got = [r.t for r in rows.select(T.regional_slang(F.col("text"), F.when(F.col("id") % 2 == 0, "UK").otherwise("XX"), slang, "k", F.col("id")).alias("t")).collect()]
    assert len(set(got)) == 4 and got.count("they spent it, the cheap is gone") > 2000
    assert 850 < sum("san$k" in t for t in got) < 1150 and 850 < sum("chips\\ is" in t for t in got) < 1150
    slipped = [r.t for r in rows.select(T.slips(F.col("text"), generate.NEIGHBOURS, "k", F.col("id")).alias("t")).collect()]
    changed = [t for t in slipped if t != "they spent it, the cheap is gone"]
    assert 0.14 < len(changed) / 4000 < 0.21  # short words that are drawn stay
    assert all(sum(a != b for a, b in zip(t.split(), "they spent it, the cheap is gone".split(), strict=True)) <= 1 for t in changed if len(t.split()) == 7 and " are " not in t)
    assert sum(" are gone" in t for t in slipped) == sum("the " not in t.replace("they", "") for t in slipped if " are gone" in t)


# sampling in rounds


def test_only_groups_short_of_their_target_draw_again(spark):
    sizes = {"few": 3, "some": 31, "many": 10**6, "none": 5}
    groups = spark.createDataFrame([(g, 0 if g == "none" else 30, n) for g, n in sizes.items()], "g string, target int, values int")
    drawn = []

    def attempts(rows):
        drawn.append({r.g: r["count"] for r in rows.groupBy("g").count().collect()})
        return rows.select("g", "attempt", F.concat(F.when(F.col("attempt") % 2 == 0, "V").otherwise("v"), F.floor(T.draw("x", F.col("g"), F.col("attempt")) * F.col("values")).cast("string")).alias("text"))

    got, rounds = generate.sampled_in_rounds(groups, attempts, ["g"])
    found = {}
    for r in got.collect():
        found.setdefault(r.g, []).append((r.attempt, r.text))

    import hashlib

    def plain(g):
        seen, out = set(), []
        for a in range(30 * 40):
            u = int(hashlib.md5(f"x|{g}|{a}".encode()).hexdigest()[:8], 16) / 4294967296
            text = ("v" if a % 2 else "V") + str(int(u * sizes[g]))
            if text.lower() not in seen and len(out) < 30:
                seen.add(text.lower())
                out.append((a, text))
        return out

    assert {g: sorted(x) for g, x in found.items()} == {g: plain(g) for g in ("few", "some", "many")}
    total = {g: sum(d.get(g, 0) for d in drawn) for g in sizes}
    assert 3 <= rounds == len(drawn) < 9 and total["few"] == 1200 and total["many"] == 60 and 60 < total["some"] < 1200
    nothing, rounds = generate.sampled_in_rounds(groups.limit(0), attempts, ["g"])
    assert nothing.collect() == [] and rounds == 0


# entities and keywords


def test_one_pass_counts_all_keywords(spark):
    rng = random.Random(4)
    lists = [tuple({"".join(rng.choice("ab .") for _ in range(rng.randrange(1, 5))) for _ in range(8)}) for _ in range(6)] + [("a.b", "x\\E", "(")]
    texts = ["".join(rng.choice("ab .x\\E(") for _ in range(rng.randrange(60))) for _ in range(200)] + [""]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r.i: list(r.n) for r in rows.select("i", nlu.keyword_counts(F.col("text"), lists).alias("n")).collect()}
    assert got == {i: [sum(t.startswith(k, p) for k in ks for p in range(len(t))) for ks in lists] for i, t in enumerate(texts)}


def plain_entities(text):
    """Amount, items and words by a loop, as (first, last, text, label)."""
    low, words = text.lower().strip(" "), re.split(r"\s+", text.lower(), flags=re.ASCII)
    out = []
    for pattern, more in nlu.AMOUNT_SPANS:
        if m := re.search(pattern, low, re.ASCII):
            at = next((i for i, w in enumerate(words) if m[1] in w or m[1].replace(",", "") in w), 0)
            out.append((at, at + more, m[0], "amount"))
            break
    for item in nlu.ITEM_NAMES:
        at = next((i for i, w in enumerate(words) if item in w), None)
        if item in low and at is not None:
            out.append((at, at, item, "itemName"))
    covered = {i for a, b, _, _ in out for i in range(a, b + 1)}
    raw = [w for w in re.split(r"\s+", text, flags=re.ASCII) if w]
    for i, w in enumerate(raw):
        clean = re.sub(T.PUNCTUATION, "", w.lower())
        following = raw[i + 1].lower() if i + 1 < len(raw) else None
        for label, names in nlu.ENTITY_WORDS:
            hit = clean in names or label == "category" and len(clean) > 3 and any(clean in n for n in names) or any((clean, following, label) == p for p in nlu.PHRASES)
            if i not in covered and hit:
                out.append((i, i, w, label))
                break
    return sorted(out)


WORDS = "iphone 15 car, cards Apple apple pay! consulting job jobs Loan payment europe trip credit card 50 lakhs 1,250.50 rs 3k dining coffees coffee rent gas ocer house (gold) today upi".split()


def some_texts():
    rng = random.Random(9)
    return ["", " car", "5 crore 5", "no numbers", "iphone 15", "apple pay apple", "1,000 1000"] + [" ".join(rng.choice(WORDS) for _ in range(rng.randrange(1, 14))) for _ in range(300)]


def test_entities_equal_a_loop(spark):
    rows = spark.createDataFrame(list(enumerate(some_texts())), "i int, text string")
    got = {}
    found = nlu.entities(rows, "text", "i")
    for r in found.collect():
        got.setdefault(r.i, []).append((r["first"], r["last"], r.text, r.label))
    assert {i: sorted(x) for i, x in got.items()} == {i: e for i, t in enumerate(some_texts()) if (e := plain_entities(t))}


def test_phrases_are_leftmost_longest_and_cover_their_words(spark):
    rows = spark.createDataFrame(list(enumerate(some_texts())), "i int, text string")
    got = {}
    for r in nlu.entity_phrases(rows, "text", "i").collect():
        got.setdefault(r.i, []).append((r["first"], r["last"], r.text, r.label))
    phrases = {}
    for label, names in (("itemName", nlu.ITEM_NAMES), *nlu.ENTITY_WORDS):
        for n in names:
            phrases.setdefault(tuple(n.split()), label)
    for i, text in enumerate(some_texts()):
        want = [e for e in plain_entities(text) if e[3] == "amount"]
        hidden = {k for a, b, _, _ in want for k in range(a, b + 1)}
        clean = [re.sub(T.PUNCTUATION, "", w.lower()) for w in text.split()]
        k = 0
        while k < len(clean):
            best = max((p for p in phrases if tuple(clean[k : k + len(p)]) == p and not hidden & set(range(k, k + len(p)))), key=len, default=())
            if best:
                want.append((k, k + len(best) - 1, " ".join(best), phrases[best]))
            k += len(best) or 1
        assert sorted(got.get(i, [])) == sorted(want), text


def test_expressions_are_computed_once(spark):
    rows = spark.createDataFrame([("buy 5 cars",)], "text string")
    assert plan_of(rows.select(nlu.affordability(F.col("text"), nlu.amount(F.col("text"))))).split("== Physical Plan ==")[1].count("regexp_extract") <= 12
    assert plan_of(nlu.entities(rows, "text")).split("== Physical Plan ==")[1].count("regexp_replace") == 0


# quantiles and nearest classes


@pytest.mark.parametrize("kind", ["spread", "ties", "heavy tail", "one value"])
def test_quantiles_are_exact_without_a_group_in_one_place(spark, monkeypatch, kind):
    monkeypatch.setattr(calibrate, "BINS", 7)
    monkeypatch.setattr(calibrate, "LISTED", 5)
    rng = np.random.default_rng(3)
    make = {"spread": lambda n: rng.random(n), "ties": lambda n: rng.integers(0, 4, n) / 2, "heavy tail": lambda n: np.exp(rng.normal(0, 6, n)), "one value": lambda n: np.full(n, 2.5)}[kind]
    data = {g: make(n).tolist() for g, n in (("a", 700), ("b", 1), ("c", 2), (None, 301))}
    rows = spark.createDataFrame([(g, v) for g, vs in data.items() for v in vs] + [("a", None), ("nulls", None)], "g string, v double")
    for q in (0.0, 0.5, 0.95, 1.0):
        found = calibrate.exact_quantile(rows, "v", q, "g")
        assert {r.g: (r.n, pytest.approx(r.quantile, rel=1e-12)) for r in found.collect()} == {g: (len(v), np.quantile(v, q)) for g, v in data.items()}
        assert "percentile" not in plan_of(found)


@pytest.mark.parametrize("size", [3, 40])
def test_nearest_of_many_classes(spark, monkeypatch, size):
    monkeypatch.setattr(calibrate, "BLOCK", size)
    rng = np.random.default_rng(6)
    centers = [(i, (rng.normal(0, 1, 3) * rng.choice([1, 5])).round(1).tolist()) for i in range(300)] + [(300 + i, [float(i), 0.0]) for i in range(4)] + [(400, [0.0, 0.0, 0.0]), (401, [0.0, 0.0, 0.0])]
    vectors = [(i, (rng.normal(0, 2, 3)).round(1).tolist()) for i in range(200)] + [(200, [0.0] * 3), (201, [3.4, 0.0]), (202, [1.0]), (203, [0.0] * 3), (203, [0.0] * 3)]
    classes = spark.createDataFrame([(i, c, 1.0) for i, c in centers], "label int, centroid array<double>, radius double")
    rows = spark.createDataFrame(vectors, "i int, embedding array<double>")
    plain = lambda df: sorted(((r.i, r.nearest, r.distance, r.accepted) for r in df.collect()), key=str)
    spread = calibrate.best_in_blocks(rows, classes, "embedding", size)
    assert spread.count() == len(vectors)
    got = plain(calibrate.nearest(rows, classes, most=10))
    assert got == plain(calibrate.nearest(rows, classes))
    for i, label, d, _ in got:
        v = dict(vectors)[i]
        fits = [(float(np.sqrt(sum((a - b) ** 2 for a, b in zip(v, c)))), k) for k, c in centers if len(c) == len(v)]
        assert label == (min(fits)[1] if fits else None) and (d == pytest.approx(min(fits)[0]) if fits else d is None)


# providers, batches, quotas, the gate


def test_batches_go_on_where_the_last_run_ended(spark):
    rows = spark.range(1, 301).select(F.col("id").alias("rn"))
    got = lambda *a, **b: [(r.rn, r.batch) for r in audit.resumed_batches(rows, *a, **b).orderBy("rn").collect()]
    assert got(0, most=120) == [(n, (n - 1) // 50 + 1) for n in range(1, 121)]
    assert got(120) == [(n, (n - 121) // 50 + 3) for n in range(121, 301)]
    assert got(0, start=290, size=4) == [(n, (n - 291) // 4 + 73) for n in range(291, 301)]
    assert got(300) == []


def test_calls_go_round_the_models_and_end_in_error_rows(spark):
    rows = spark.createDataFrame([(b, 10 * b + k) for b in range(1, 8) for k in range(3)], "batch long, id long")
    judged = audit.judge_rotating(rows, {"two": audit.FailingProvider(2), "three": audit.FailingProvider(3)}, tries=2, wait=0.0)
    got = {r.batch: (r.model, r.tried, r.error) for r in judged.collect()}
    assert judged.count() == 21
    # All first identifiers are even, so the model "two" always fails.
    assert got == {b: ((None, ["two", "three"][:: 1 if b % 2 else -1], audit.EXHAUSTED) if 10 * b % 3 == 0 else ("three", ["two"] if b % 2 else [], None)) for b in range(1, 8)}
    assert {r.model: (r.n_judged, r.n_failed) for r in audit.model_shares(judged).collect()} == {None: (6, 0), "two": (0, 5), "three": (15, 2)}

    class Broken:
        def judge(self, records):
            raise TimeoutError

    errors = audit.judge(rows.select(F.col("id").cast("string").alias("id")), Broken(), 2, wait=0.0).collect()
    assert len(errors) == 21 and {(r.suitability, r.error) for r in errors} == {(None, audit.EXHAUSTED)}


def test_quotas_hold_over_restarts(spark, tmp_path):
    (tmp_path / "in").mkdir()

    def run(name, rows):
        (tmp_path / "in" / name).write_text("".join(json.dumps({"k": k, "t": t}) + "\n" for k, t in rows))
        return resume.fill_quotas(spark, str(tmp_path / "in"), "k string, t string", 20, ["k"], "t", str(tmp_path / "out"), str(tmp_path / "state"))

    held = lambda: {k: sorted(t for kk, t in ((r.k, r.t) for r in spark.read.parquet(str(tmp_path / "out")).collect()) if kk == k) for k in "abc"}
    assert run("1.json", [("a", f"t{i % 15}") for i in range(60)] + [("b", f"t{i}") for i in range(50)]) == 110
    first = held()
    assert len(first["a"]) == 15 == len(set(first["a"])) and len(first["b"]) == 20 == len(set(first["b"]))
    assert run("2.json", [("a", f"t{i}") for i in range(40)] + [("b", "new"), ("c", "x"), ("c", "x")]) == 43
    second = held()
    assert len(set(second["a"])) == 20 == len(second["a"]) and set(first["a"]) < set(second["a"]) and second["b"] == first["b"] and second["c"] == ["x"]


def test_a_finding_leaves_the_old_table(spark, tmp_path):
    specs = spark.createDataFrame([("a", ["x", "y"]), ("b", ["x"])], "intent string, supported_actions array<string>")
    combos, path = quality.valid_combos(specs), str(tmp_path / "table")
    least = spark.createDataFrame([("a", 2)], "intent string, least int")
    good = [("one", "a", "x"), ("two", "a", "x"), ("three", "b", "x")]
    rows = lambda r: spark.createDataFrame(r, "utterance string, intent string, action string")
    held = lambda: sorted(tuple(r) for r in spark.read.parquet(path).collect())
    assert not any(quality.publish(rows(good), specs, combos, least, path).values()) and held() == sorted(good)
    for bad, check in (([("z", "c", "x")], "unknown"), ([("z", "b", "y")], "combination"), ([("ONE", "b", "x")], "conflict"), ([("z", "a", "y")], "diversity")):
        assert quality.publish(rows(good + bad), specs, combos, least, path)[check] == 1 and held() == sorted(good)
    assert quality.publish(rows(good[:2]), specs, combos, least, path)["coverage"] == 1 and held() == sorted(good)
    assert not any(quality.publish(rows(good[::2] + good), specs, combos, least, path).values()) and len(held()) == 5
    assert [p.name for p in tmp_path.iterdir()] == ["table"]


def test_callers_register_slots(spark):
    shout = generate.register_slot(spark, "shout", "upper(k) || CASE WHEN slot_draw(k) < 2 THEN '!' END")
    assert spark.sql("SELECT slot_shout('a|b') AS x").first().x == "A|B!"
    pool = generate.indexed_pool(spark.createDataFrame([("a", "x")], "slot string, value string"))
    row = generate.fill_slots(spark.createDataFrame([(7, "{a} {shout}")], "id int, template string"), pool, "s", "template", "id", generators={"shout": shout}).first()
    assert row.text == "x S|7|2!"
    with pytest.raises(ValueError, match="slot"):
        generate.register_slot(spark, "x; drop", "k")


@cache
def names():
    from millrace.plans import catalogue

    return set(catalogue.QUERIES)


def test_new_queries_are_registered():
    assert {"g_slot_tokens", "g_slang", "g_slips", "g_spec_rows", "g_registered_slot", "n_entity_phrases", "w_resume", "r_rotation", "r_model_shares", "d_quota", "v_gate_publish", "v_authoring", "v_misaligned", "s_specs"} <= names()
