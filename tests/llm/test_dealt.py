"""Small tests of the dealt operators: defined results for odd rows, and plainer versions to compare with."""

import hashlib
import json
import random
import re

from datetime import date
from itertools import combinations
from math import ceil

import numpy as np
import pytest
from pyspark.sql import functions as F

from millrace.llm import decontaminate, exact_dedup, html_extract, jaccard_join, language_id, pii, quality_cnn, spm_codec, url_filter, warc
from millrace.llm.common import located
from millrace.llm.components import components

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, host string, id long, w string"


def docs_of(spark, rows):
    """Documents with further columns whose names clash with results and helpers."""
    return spark.createDataFrame([(i, t, lang, "s", 1, 9.0, "x", 7, "w") for i, t, lang in rows], DOCS)


ODD = [(1, None, "en"), (2, "", "en"), (3, " \n\t ", None), (4, "Hello World", "en"), (5, "hello world", "en"), (4, "Hello World", "en"), (None, "no id", "en"), (None, None, None), (6, "x" * 200_000 + " end", "en"), (7, "a b c " * 20_000, "de")]


def plain(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# op1


def test_url_parts_and_rules(spark):
    urls = [("http://A.Example.COM/en/7?x", "a.example.com", "/en/7", "example.com/en/7", "allow"), ("http://a.com/en/x", "a.com", "/en/x", "com/en/", "block"), ("http://com/en/", "com", "/en/", "com/en/", "block"), ("http://xcom/en/", "xcom", "/en/", None, None),
            ("https://x.net/de/8", "x.net", "/de/8", "net/de/", "block"), ("https://example.net/de/8#t", "example.net", "/de/8", "example.net/de/8", "allow"), (None, "", "", None, None), ("no scheme", "", "", None, None), ("a://b?c/d", "b", "", None, None), ("x://É.org/es/://y/z", "É.org", "/es/://y/z", "org/es/", "block"), ("", "", "", None, None), ("a\nb://h\nost/p", "h\nost", "/p", None, None)]
    df = spark.createDataFrame([(i, u[0], "clash", 1.5) for i, u in enumerate(urls)], "page_id int, url string, host string, features double")
    model = url_filter.train(url_filter.labelled_urls(spark, 1500))
    got = {r.page_id: r for r in url_filter.judge(df.select("page_id", "url"), model).collect()}
    for i, (_, host, path, rule, verdict) in enumerate(urls):
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == verdict if verdict else got[i].verdict in ("allow", "block")
    assert url_filter.judge(df.select("page_id", "url").limit(0), model).count() == 0
    rules = spark.createDataFrame(list(url_filter.RULES), "host string, path string, verdict string")
    parts = spark.createDataFrame([(got[i].host, got[i].path) for i in got], "host string, path string")
    assert {(r.host, r.path, r.rule) for r in url_filter.match_rules(parts, rules).collect()} == {(h, p, r) for _, h, p, r, v in urls if r}
    scores = url_filter.score(spark.createDataFrame([("http://login.casino-bonus7291.xyz/verify?id=8f3a9c11d2e&uid=99",), ("https://www.citylibrary.org/2019/05/history-kebade.html",)], "url string"), model).collect()
    assert scores[0].url_score > 0.5 > scores[1].url_score


def test_url_query_has_the_rules_of_its_contract(spark, tmp_path):
    urls = {"http://a.com/en/1": ("com/en/", "block"), "http://example.com/en/1": ("com/en/", "block"), "http://www.example.com/en/71": ("example.com/en/7", "allow"), "http://x.net/de/8": ("net/de/", "allow"), "http://example.net/de/1": ("net/de/", "allow"),
            "http://example.net/de/8": ("example.net/de/8", "block"), "http://a.EXAMPLE.net/de/80?q": ("example.net/de/8", "block"), "http://b.org/es/": ("org/es/", "block")}
    spark.createDataFrame([(i, u, "") for i, u in enumerate(urls)], "page_id long, url string, html string").write.parquet(f"{tmp_path}/pages.parquet")
    assert {r.page_id: (r.rule, r.verdict) for r in url_filter.op1_url_filters(spark, str(tmp_path)).collect()} == dict(enumerate(urls.values()))


def plain_features(url):
    """The lexical features of a URL with an ordinary site name, from the definition."""
    from math import log2

    rest = url.split("://", 1)[1]
    host = re.split("[/?#]", rest)[0].lower()
    path = re.match("[^?#]*", rest[len(re.split("[/?#]", rest)[0]) :])[0]
    labels = host.split(".")
    double = len(labels) >= 3 and labels[-2] in url_filter.SECOND_LEVEL
    name = labels[-3 if double else -2]
    share = lambda t: sum(c.isdigit() for c in t) / max(1, len(t))
    query = url.split("?", 1)[1].split("#")[0] if "?" in url else ""
    return {
        "url_length": len(url), "host_length": len(host), "path_length": len(path), "path_depth": path.count("/"), "host_depth": len(labels), "name_words": len(re.split("[-_]", name)),
        "digit_ratio": share(url), "host_digit_ratio": share(host), "entropy": -sum(host.count(c) / len(host) * log2(host.count(c) / len(host)) for c in set(host)), "params": len(re.split("[&;]", query)) if query else 0,
        "__zone": ".".join(labels[-2:]) if double else labels[-1], "__word": re.split("[-_]", name)[-1], "__ending": name[-3:],
    }


def test_url_features_and_trees_equal_plain_versions(spark):
    """Features, suffix statistics and the sum over the trees, each from its definition; the model on words it never saw."""
    from math import exp

    blocked, ordinary = url_filter.BLOCKED_WORDS, url_filter.PLAIN_WORDS
    learned = url_filter.labelled_urls(spark, 3000, 0, blocked[::2], ordinary[::2])
    model = url_filter.train(learned)
    importance = dict(zip(url_filter.FEATURES, model.trees.featureImportances.toArray()))
    for family in (("url_length", "host_length", "path_length"), ("path_depth", "host_depth"), ("digit_ratio", "host_digit_ratio"), ("entropy",), ("params",), ("zone_rate", "word_rate", "ending_rate")):
        assert sum(importance[f] for f in family) > 0, family

    rows = [(r.url, r.label) for r in learned.collect()]
    overall = sum(y for _, y in rows) / len(rows)
    known = {}
    for url, y in rows:
        for kind in ("zone", "word", "ending"):
            known.setdefault((kind, plain_features(url)[f"__{kind}"]), []).append(y)
    rate = lambda kind, x: (sum(known.get((kind, x), ())) + url_filter.PRIOR * overall) / (len(known.get((kind, x), ())) + url_filter.PRIOR)
    trial = url_filter.labelled_urls(spark, 600, 9, blocked[1::2], ordinary[1::2])
    scored = [(r.url, r.label, r.url_score) for r in url_filter.score(trial, model).collect()]

    def leaf(lines, x):
        """Walks a tree as Spark prints it: a condition and its counterpart stand at the same depth."""
        at = 0
        while not lines[at].strip().startswith("Predict"):
            depth = len(lines[at]) - len(lines[at].lstrip())
            feature, limit = re.fullmatch(r"If \(feature (\d+) <= ([-\d.E]+)\)", lines[at].strip()).groups()
            at = at + 1 if x[int(feature)] <= float(limit) else next(i for i in range(at + 1, len(lines)) if lines[i].startswith(" " * depth + "Else")) + 1
        return float(lines[at].strip().removeprefix("Predict: "))

    trees = [[x for x in t.splitlines()[1:] if x.strip()] for t in re.split(r"\n(?=  Tree \d)", model.trees.toDebugString)[1:]]
    assert len(trees) == model.trees.getNumTrees
    for url, _, score in scored[:150]:
        f = plain_features(url)
        f |= {f"{kind}_rate": rate(kind, f[f"__{kind}"]) for kind in ("zone", "word", "ending")}
        total = sum(w * leaf(t, [f[k] for k in url_filter.FEATURES]) for w, t in zip(model.trees.treeWeights, trees))
        assert score == pytest.approx(1 / (1 + exp(-2 * total)), abs=1e-6), url

    good, bad = ([s for _, y, s in scored if y == k] for k in (0, 1))
    auc = sum((b > g) + (b == g) / 2 for b in bad for g in good) / len(bad) / len(good)
    assert auc > 0.8 and len({round(s, 6) for _, _, s in scored}) > 200
    assert url_filter.train(learned.where("label = 0")).trees is None
    assert {r.url_score for r in url_filter.score(trial, url_filter.train(learned.limit(0))).collect()} == {0.5}


# op2


def test_warc_round_trip(spark, tmp_path):
    long = "<p>é " * 400
    rows = [(1, "http://a/ü?x=1", long), (2, "http://b", long), (3, None, None), (4, "u", ""), (5, "u", "short"), (6, "u", "short"), (9, "u\r\nX: y", long), (None, "u", long), (7, "u", "a\r\n\r\nWARC/1.1\r\n\r\n" * 100)]
    df = spark.createDataFrame([(*r, "d") for r in rows], "page_id long, url string, html string, digest string")
    folder = f"file://{tmp_path}/w"
    index = warc.write_archives(warc.typed_records(df), folder)
    full = warc.read_records(index, folder)
    back = {r.page_id: r for r in warc.resolve_revisits(full).collect()}
    assert len(back) == len(rows)
    for page, url, html in rows:
        data = (html or "").encode()
        r = back[page]
        assert (r.payload_bytes, r.payload_digest, r.url) == (len(data), hashlib.sha1(data).hexdigest(), url)
        same = html == long and page != 9
        assert (r.record_type, r.refers_to) == (("revisit", 9) if same else ("response", None))
        assert same or bytes(r.payload) == data
    some = index.where("page_id in (2, 7)")
    assert {r.page_id for r in warc.read_records(some, folder).collect()} == {2, 7}
    big = 1 << 60  # identifiers beyond what a double holds, beside a null
    more = spark.createDataFrame([(big + 1, None, long, "d"), (big + 3, "u", long, "d"), (None, "u", None, "d"), (big + 5, "u", "short", "d")], df.schema)
    at = f"file://{tmp_path}/big"
    again = warc.resolve_revisits(warc.read_records(warc.write_archives(warc.typed_records(more), at), at)).collect()
    assert {(r.page_id, r.refers_to, r.payload_bytes) for r in again} == {(big + 1, big + 3, len(long.encode())), (big + 3, None, len(long.encode())), (None, None, 0), (big + 5, None, 5)}
    empty = warc.write_archives(warc.typed_records(df.limit(0)), f"{folder}-empty")
    assert warc.resolve_revisits(warc.read_records(empty, f"{folder}-empty")).count() == 0


# op3


@pytest.mark.parametrize("most", [0, decontaminate.BROADCAST_SEEDS])
def test_overlaps(spark, monkeypatch, most):
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", most)
    r = random.Random(1)
    words = [f"w{k}" for k in range(3000)]
    items = [[r.choice(words) for _ in range(n)] for n in (40, 15, 8, 5)]
    swap = lambda item, every: [("zz" if k % every == every - 1 else w) for k, w in enumerate(item)]
    noise = lambda n: [r.choice(words) for _ in range(n)]
    texts = {1: noise(50) + items[0] + noise(50), 2: swap(items[0], 5), 3: swap(items[0], 6) + noise(9), 4: noise(300), 5: noise(3) + items[1], 6: items[2], 7: items[3] * 3, 8: swap(items[0], 2), 9: items[0][:19], 10: noise(4) + items[0][5:27]}
    rows = [(i, " ".join(t).upper() + "!", "en") for i, t in texts.items()] + [(11, None, "en"), (12, "", None), (None, "x y", None), (1, " ".join(texts[1]).upper() + "!", "en")]
    bench = spark.createDataFrame([(k, " ".join(t), "c") for k, t in enumerate(items)] + [(9, None, ""), (10, "", "")], "item_id long, text string, seed string")
    got = {(x.doc_id, x.item_id) for x in decontaminate.overlaps(docs_of(spark, rows), bench).collect()}
    assert got == {(1, 0), (2, 0), (3, 0), (5, 1), (6, 2), (7, 3), (10, 0)}
    one_token = bench.limit(0).unionAll(spark.createDataFrame([(20, "W7x9", "c"), (21, "zz", "c"), (None, "zz", "c")], bench.schema))
    assert {(x.doc_id, x.item_id) for x in decontaminate.overlaps(docs_of(spark, rows), one_token).collect()} == {(i, k) for i in (2, 3, 8) for k in (21, None)}
    two_under_one_id = docs_of(spark, [(1, rows[0][1], "en"), (1, "clean", "en"), (None, rows[0][1], "en"), (None, "clean too", "en")])
    assert sorted(r.text for r in decontaminate.keep_clean(two_under_one_id, bench).collect()) == ["clean", "clean too"]
    assert decontaminate.overlaps(docs_of(spark, rows), bench.limit(0)).count() == 0
    assert decontaminate.overlaps(docs_of(spark, rows).limit(0), bench).count() == 0


def test_masks_hit_all_substitutions():
    """Every window of 7 to 20 tokens with as many substitutions as count has a place for some mask."""
    for m in range(decontaminate.MIN_ITEM, decontaminate.WINDOW + 1):
        for out in combinations(range(m), m - ceil(m * decontaminate.SHARE)):
            assert any(all(at + k not in out for k in mask) for mask in decontaminate.MASKS for at in range(m - mask[-1])), (m, out)


@pytest.mark.parametrize("most", [0, decontaminate.BROADCAST_SEEDS])
def test_overlaps_of_short_items(spark, monkeypatch, most):
    """All placements of the substitutions that count, and of one more, in items of 7, 8 and 10 tokens."""
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", most)
    rows, items, want = [], [], set()
    for m in (7, 8, 10):
        item = [f"i{m}t{k}" for k in range(m)]
        items.append((m, " ".join(item), ""))
        for n in (m - ceil(m * 0.8), m - ceil(m * 0.8) + 1):
            for out in combinations(range(m), n):
                rows.append((len(rows), "a b " + " ".join("zz" if k in out else w for k, w in enumerate(item)) + " c", "en"))
                want |= {(len(rows) - 1, m)} if n == m - ceil(m * 0.8) else set()
    got = decontaminate.overlaps(docs_of(spark, rows), spark.createDataFrame(items, "item_id long, text string, seed string")).collect()
    assert {(x.doc_id, x.item_id) for x in got} == want


def test_repetitive_items_meet_in_runs(spark):
    """Of n and m places with one seed, n + m - 1 alignments; the windows of the best are whole."""
    n = 1500
    rows = [(1, " ".join(["same"] * n), "en"), (2, " ".join(["a", "b"] * 200), "en"), (3, " ".join(["same"] * 30 + ["x"] + ["same"] * 6), "en")]
    bench = spark.createDataFrame([(1, " ".join(["same"] * n), ""), (2, " ".join(["a", "b"] * 100), ""), (3, "same same same same same", "")], "item_id long, text string, seed string")
    got = {(r.doc_id, r.item_id, r.start, r.window_size, r.matched) for r in decontaminate.overlaps(docs_of(spark, rows), bench).collect()}
    assert got == {(1, 1, 0, 20, 20), (3, 1, 0, 20, 20), (2, 2, 0, 20, 20), (1, 3, 0, 5, 5), (3, 3, 0, 5, 5)}
    places = spark.createDataFrame([(1, k) for k in (3, 4, 5, 9, 11, 12)] + [(None, 0)], "key long, at int")
    assert plain(decontaminate.runs(places, ["key"], "at")) == [(1, 11, 2), (1, 3, 3), (1, 9, 1), (None, 0, 1)]


def test_no_shuffle_carries_tokens(spark, monkeypatch):
    """With nothing broadcast, what goes through exchanges on the way to alignments is numbers."""
    plans, write = [], decontaminate.written
    monkeypatch.setattr(decontaminate, "BROADCAST_SEEDS", 0)
    monkeypatch.setattr(decontaminate, "written", lambda df, name: (plans.append(df._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))) if name == "alignments" else None, write(df, name))[1])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        decontaminate.overlaps(docs_of(spark, [(1, "a b c d e f g h", "en")]), spark.createDataFrame([(1, "a b c d e f g h", "")], "item_id long, text string, seed string")).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    (plan,) = plans
    carried = re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\]]*)\]", plan)
    assert len(carried) >= 3 and not {c.split("#")[0].strip() for x in carried for c in x.split(",")} & {"w", "__text", "text"}


# op4


def test_quality_network(spark, data):
    docs, labels = (spark.read.parquet(f"{data.replace('0.001', '0.01')}/{t}.parquet") for t in ("documents", "labels"))
    parameters = quality_cnn.train(docs, labels, lambda c: ~quality_cnn.held_out(c))
    scored = quality_cnn.score(docs, parameters).join(labels, "doc_id").where(quality_cnn.held_out(F.col("doc_id"))).select("score", "quality").collect()
    right = sum((r.score >= 0.7) == (r.quality == 1) for r in scored)
    assert len(scored) > 50 and right / len(scored) > 0.95
    odd = quality_cnn.score(docs_of(spark, ODD), parameters).collect()
    assert len(odd) == len(ODD) and all(0 <= r.score <= 1 for r in odd)
    assert quality_cnn.train(docs, labels.limit(0), lambda c: F.lit(True)) is None
    assert [r.score for r in quality_cnn.score(docs.limit(2), None).collect()] == [0.5, 0.5]
    assert quality_cnn.score(docs.limit(0), parameters).count() == 0


def test_quality_equals_plain_loops():
    """Windows, chunks, pooling and layers written out for a few short texts."""
    from math import exp

    p = quality_cnn.Network(3).p
    p = {k: x + np.float32(0.01) * (k in ("dense_bias", "bias")) for k, x in p.items()}
    width, half, reach = quality_cnn.WIDTH, quality_cnn.HALF, quality_cnn.REACH
    r = random.Random(8)
    texts = [b"", b"a", b"abcabcabcabc", bytes(r.randrange(97, 105) for _ in range(300)), ("é word, " * 90).encode()]
    for text, got in zip(texts, quality_cnn.score_texts(texts, p)):
        seen = [int(any(text[i : i + 4] == text[i - d : i - d + 4] for d in range(1, reach + 1) if i >= d)) if i + 4 <= len(text) else 0 for i in range(len(text))]
        response = [[max(0.0, float(p["bias"][f]) + seen[i] * float(p["repeat"][0][f]) + sum(float(p["filters"][k][text[i + k] if i + k < len(text) else 0][f]) for k in range(width))) for f in range(quality_cnn.FILTERS)] for i in range(len(text))]
        halves = max(1, -(-len(text) // half))
        top = [0.0] * quality_cnn.HIDDEN
        for c in range(max(1, halves - 1)):
            places = range(c * half, min((c + 2) * half, len(text)))
            size = max(1, len(places))
            x = [sum(response[i][f] for i in places) / size for f in range(quality_cnn.FILTERS)] + [sum(seen[i] for i in places) / size]
            hidden = [max(0.0, float(p["dense_bias"][h]) + sum(x[f] * float(p["dense"][f][h]) for f in range(len(x)))) for h in range(quality_cnn.HIDDEN)]
            top = [max(a, b) for a, b in zip(top, hidden)]
        z = sum(a * float(b) for a, b in zip(top, p["out"])) + float(p["out_bias"][0])
        assert got == pytest.approx(1 / (1 + exp(-z)), abs=2e-3), text[:20]


def test_quality_reads_whole_texts():
    """Scores don't depend on how texts are put together or cut for the pass."""
    r = random.Random(2)
    texts = [bytes(r.randrange(256) for _ in range(n)) for n in (0, 1, 4, 127, 128, 129, 300, 20_000, 70_000)]
    net = quality_cnn.Network()
    alone = [float(quality_cnn.score_texts([t], net.p)[0]) for t in texts]
    assert quality_cnn.score_texts(texts, net.p).tolist() == pytest.approx(alone, abs=1e-4)



# op5


@pytest.mark.parametrize("labels", [126, 3000, 100_000])
def test_long_hosts_of_addresses(spark, labels):
    """However many labels a host has, the text goes through; its address counts as far as 127 of them can be a host."""
    host = "a." * labels
    rows = [(1, f"x@{host}", "en"), (2, f"x@{host}com", "en"), (3, f"jo@site.org x@{host} jo@site.org", "en")]
    got = {r.doc_id: r for r in pii.pseudonymise(docs_of(spark, rows), "k").collect()}
    assert got[1].text == f"x@{host}" and got[1].n_email == 0 and got[3].n_email == 2
    assert (got[2].n_email, got[2].text != f"x@{host}com") == ((1, True) if labels == 126 else (0, False))
    first, _, last = got[3].text.split(" ")
    assert first == last != "jo@site.org"


def test_pseudonyms(spark):
    values = {"card": ["4111 1111 1111 1111", "4111111111111111", "5500-0000-0000-0004", "3782 822463 10005"], "phone": ["+1 (366) 555-9807", "+13665559807", "(212) 555-0147", "+49 30 1234567"], "ipv4": ["8.8.8.8", "192.168.0.255"], "ssn": ["123-45-6789"], "iban": ["DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432"], "date": ["2024-02-29", "29/02/2024", "29.02.2024", "12/31/1999"], "email": ["Jo.Doe+x@Mail7.example.com"]}
    bad = ["4111111111111112", "999.1.1.1", "000-12-3456", "2023-02-29", "DE88370400440532013000", "1.2.3.4.5", "ab@", "v1.2.3"]
    rows = [(i, f"call {v}, or {v}.", "en") for i, v in enumerate(x for xs in values.values() for x in xs)]
    more = [(100 + i, f"see {v} here", "en") for i, v in enumerate(bad)] + [(200, None, None), (201, "", None), (202, "plain text", "en")]
    df = docs_of(spark, rows + more)
    got = {r.doc_id: r for r in pii.pseudonymise(df, "k1").collect()}
    again = {r.doc_id: r.text for r in pii.pseudonymise(df, "k1").collect()}
    other = {r.doc_id: r.text for r in pii.pseudonymise(df, "k2").collect()}
    flat = [(k, v) for k, xs in values.items() for v in xs]
    new = {}
    for i, (kind, v) in enumerate(flat):
        text = got[i].text
        assert v not in text and text == again[i] and text != other[i], (v, text)
        a, b = re.fullmatch(r"call (.*), or (.*)\.", text).groups()
        assert a == b and got[i][f"n_{kind}"] == 2
        assert re.sub("[0-9]", "9", re.sub("[a-z]", "a", a)) == re.sub("[0-9]", "9", re.sub("[a-z]", "a", v.lower() if kind == "email" else v)) or kind in ("ipv4", "iban"), (v, a)
        new[v] = a
    digits = lambda x: re.sub(r"\D", "", x)
    luhn = lambda d: sum(int(c) if k % 2 else (int(c) * 2 - 9 * (int(c) > 4)) for k, c in enumerate(d if len(d) % 2 == 0 else "0" + d)) % 10 == 0
    assert all(luhn(digits(new[v])) for v in values["card"])
    assert digits(new[values["card"][0]]) == new[values["card"][1]]
    assert digits(new[values["phone"][0]]) == digits(new[values["phone"][1]])
    for v in values["iban"]:
        x = new[v].replace(" ", "")
        assert int("".join(str(int(c, 36)) for c in x[4:] + x[:4])) % 97 == 1
    iso = date.fromisoformat(new["2024-02-29"])
    assert new["29/02/2024"] == iso.strftime("%d/%m/%Y") and new["29.02.2024"] == iso.strftime("%d.%m.%Y")
    beside = docs_of(spark, [(1, "no 12 4111111111111111 34, 4111 1111 1111 1111 4111111111111111", "en")])
    assert pii.pseudonymise(beside, "k1").first().text == "no 12 {0} 34, {1} {0}".format(new["4111111111111111"], new["4111 1111 1111 1111"])
    marked = pii.pseudonymise(docs_of(spark, [(1, "\ue0008.8.8.8 \ue000 x@y.com", "en"), (2, "8.8.8.8", "en")]), "k1").orderBy("doc_id").collect()
    assert re.fullmatch("\ue000[0-9.]+ \ue000 .@.[.]com", marked[0].text) and marked[0].text.split()[0] == "\ue000" + marked[1].text and (marked[0].n_ipv4, marked[0].n_email) == (1, 1)
    for i, v in enumerate(bad):
        assert got[100 + i].text == f"see {v} here", v
    assert (got[200].text, got[201].text, got[202].text) == (None, "", "plain text")
    assert pii.pseudonymise(df.limit(0), "k1").count() == 0


def test_pseudonyms_are_permutations(spark):
    df = spark.range(1000).select(F.lpad(F.col("id").cast("string"), 3, "0").alias("d"), F.col("id"))
    got = df.select(pii.permuted(F.col("d"), "t", "k").alias("p"), pii.permuted_pair(F.floor(F.col("id") / 40), F.col("id") % 40, 40, "t", "k").alias("q")).collect()
    assert len({r.p for r in got}) == 1000 and all(re.fullmatch(r"\d{3}", r.p) for r in got)
    assert len({(r.q.a, r.q.b) for r in got}) == 1000 and all(0 <= r.q.a < 40 and 0 <= r.q.b < 40 for r in got)


def plain_feistel(symbols, kind, key):
    """The permutation of letters and digits written out."""
    half = len(symbols) // 2
    left, right = symbols[:half], symbols[half:]

    def moved(part, i, other):
        stream = hashlib.sha512(f"{key}|{kind}|{i}|{other}".encode()).hexdigest()
        return "".join(chr(48 + (ord(c) - 48 + int(stream[2 * k : 2 * k + 2], 16)) % 10) if c.isdigit() else chr(97 + (ord(c) - 97 + int(stream[2 * k : 2 * k + 2], 16)) % 26) for k, c in enumerate(part))

    for i in range(1, 9):
        if i % 2:
            left = moved(left, i, right)
        else:
            right = moved(right, i, left)
    return left + right


def plain_pair(a, b, radix, kind, key):
    for i in range(1, 9):
        value = lambda other: int(hashlib.sha256(f"{key}|{kind}|{i}|{other}".encode()).hexdigest()[:12], 16)  # noqa: B023, E731
        a, b = ((a + value(b)) % radix, b) if i % 2 else (a, (b + value(a)) % radix)
    return a, b


def test_pseudonyms_equal_a_plain_version(spark):
    """Cards, US numbers, addresses, dates and mail found and replaced by a Python version of detection and permutation."""
    r, key = random.Random(6), "a key"
    digits = lambda n: "".join(r.choice("0123456789") for _ in range(n))

    def luhn(d):
        return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10 == 0

    def fill(template, symbols):
        it = iter(symbols)
        return re.sub("[a-z0-9]", lambda m: next(it), template)

    def new_card(v):
        d = re.sub(r"\D", "", v)
        if not luhn(d):
            return v
        body = plain_feistel(d[:-1], "card", key)
        return fill(v, body + next(c for c in "0123456789" if luhn(body + c)))

    def new_date(v):
        try:
            day = date.fromisoformat(v)
        except ValueError:
            return v
        n = (day - date(1900, 1, 1)).days
        if not 0 <= n < 73_049:
            return v
        while True:
            a, b = plain_pair(n // 271, n % 271, 271, "date", key)
            n = a * 271 + b
            if n < 73_049:
                return date.fromordinal(date(1900, 1, 1).toordinal() + n).isoformat()

    def new_ip(v):
        o = [int(x) for x in v.split(".")]
        if max(o) > 255:
            return v
        a, b = plain_pair(o[0] * 256 + o[1], o[2] * 256 + o[3], 65_536, "ipv4", key)
        return f"{a // 256}.{a % 256}.{b // 256}.{b % 256}"

    def new_ssn(v):
        good = lambda d: d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"
        d = v.replace("-", "")
        if not good(d):
            return v
        d = plain_feistel(d, "ssn", key)
        while not good(d):
            d = plain_feistel(d, "ssn", key)
        return fill(v, d)

    def new_mail(v):
        head, _, top = v.lower().rpartition(".")
        return fill(head, plain_feistel(re.sub("[^a-z0-9]", "", head), "email", key)) + "." + top

    kinds = [(r"[a-z]+\.[a-z]+@[a-z]+\.com", new_mail), (r"\d{4}-\d{2}-\d{2}", new_date), (r"\d{1,3}(?:\.\d{1,3}){3}", new_ip), (r"\d{3}-\d{2}-\d{4}", new_ssn), (r"\d{4} \d{4} \d{4} \d{4}|\d{16}", new_card)]

    def plain_version(text):
        return re.sub(" (" + "|".join(p for p, _ in kinds) + ")(?= )", lambda m: " " + next(f for p, f in kinds if re.fullmatch(p, m[1]))(m[1]), text)

    made = [lambda: digits(16), lambda: f"{digits(4)} {digits(4)} {digits(4)} {digits(4)}", lambda: f"{r.randrange(1850, 2150)}-{r.randrange(14):02d}-{r.randrange(33):02d}", lambda: ".".join(str(r.randrange(300)) for _ in range(4)), lambda: f"{digits(3)}-{digits(2)}-{digits(4)}", lambda: f"a{chr(97 + r.randrange(26))}.b@mail.com", lambda: "word"]
    texts = ["so " + " , ".join(r.choice(made)() for _ in range(30)) + " ." for _ in range(40)]
    got = {x.doc_id: x.text for x in pii.pseudonymise(docs_of(spark, [(i, t, "en") for i, t in enumerate(texts)]), key).collect()}
    for i, t in enumerate(texts):
        assert got[i] == plain_version(t)


# op6


def brute_dedup(rows):
    norm = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    groups = {}
    for i, t, _ in rows:
        groups.setdefault(norm(t), []).append(i)
    low = -(10**9)
    out = []
    for i, t, _ in rows:
        g = groups[norm(t)]
        keep = max(g, key=lambda x: low if x is None else x)
        out.append((i, keep, len(g), i == keep, hashlib.sha256(norm(t).encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("weak", [False, True])
def test_exact_dedup(spark, tmp_path, monkeypatch, weak):
    rows = [*ODD, (20, "ÀB", "fr"), (21, "àb", "fr"), (22, "Àb", "fr"), (23, "yello World", "en"), (24, "YELLO world", "en")]
    docs_of(spark, rows).repartition(3).write.parquet(f"{tmp_path}/d.parquet")
    docs = spark.read.parquet(f"{tmp_path}/d.parquet")
    digest = (lambda c: F.length(c).cast("string")) if weak else exact_dedup.sha256
    assert plain(exact_dedup.exact_dedup(docs, digest=digest, files_per_batch=1)) == brute_dedup(rows)
    assert plain(exact_dedup.exact_dedup(docs_of(spark, rows), digest=digest)) == brute_dedup(rows)
    monkeypatch.setattr(exact_dedup, "BROADCAST", 0)
    assert plain(exact_dedup.exact_dedup(docs, digest=digest)) == brute_dedup(rows)

    kept = exact_dedup.keep_one(docs, digest=digest)
    assert kept.columns == docs_of(spark, rows).columns
    fold = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    assert sorted(((r.doc_id, hashlib.sha256(fold(r.text).encode()).hexdigest()) for r in kept.collect()), key=str) == sorted({(x[1], x[4]) for x in brute_dedup(rows)}, key=str)


def test_exact_dedup_keeps_state_between_runs(spark, tmp_path):
    at, source = f"file://{tmp_path}/state", f"{tmp_path}/in"
    for k, rows in enumerate(([(1, "a", ""), (2, "b", "")], [(5, "A", ""), (0, "B", ""), (7, "c", "")])):
        docs_of(spark, rows).coalesce(1).write.mode("append").parquet(source)
        stream = located(spark.readStream.schema("doc_id long, text string").parquet(source))
        exact_dedup.run_stream(spark, exact_dedup.records(stream), f"{at}/table", f"{at}/check")
        state = {(r.keeper.id, r.group_size) for r in exact_dedup.read_state(spark, f"{at}/table").collect()}
        assert state == ({(1, 1), (2, 1)} if k == 0 else {(5, 2), (2, 2), (7, 1)})


def test_exact_dedup_of_nothing(spark, tmp_path):
    docs_of(spark, ODD).limit(0).write.parquet(f"{tmp_path}/e.parquet")
    assert exact_dedup.exact_dedup(spark.read.parquet(f"{tmp_path}/e.parquet")).collect() == []
    assert exact_dedup.keep_one(spark.read.parquet(f"{tmp_path}/e.parquet")).collect() == []


# op7


def test_language(spark, data):
    docs = spark.read.parquet(f"{data.replace('0.001', '0.01')}/documents.parquet")
    model = language_id.train(docs, lambda c: ~language_id.held_out(c), max_docs=200)
    found = language_id.identify(docs.where(language_id.held_out(F.col("doc_id")) & F.col("lang").isNotNull()), model, keep=("doc_id", "lang")).collect()
    assert sum(r.lang == r.lang_pred for r in found) / len(found) > 0.97
    odd = {r.doc_id: r for r in language_id.identify(docs_of(spark, [*ODD, (30, "123 !?", "en"), (31, "日本語 テキスト", None)]), model).collect()}
    assert all(odd[i].lang_pred == "und" and odd[i].score == 0 for i in (1, 2, 3, 30)) and all(0 <= r.score <= 1 for r in odd.values())
    assert odd[31].rejected and odd[4].lang_pred in model.langs
    none = language_id.train(docs.limit(0), lambda c: F.lit(True))
    assert {r.lang_pred for r in language_id.identify(docs.limit(3), none).collect()} == {"und"}
    assert language_id.identify(docs.limit(0), model).count() == 0


def test_language_equals_a_plain_version(spark):
    """Counts, Kneser-Ney probabilities, cross-entropies and the choice, by dictionaries and recursion."""
    from math import log

    texts = {"aa": ["the cat sat, the mat!", "that bat ate the rat"], "bb": ["der hund und die katze", "und der hut, der rote"]}
    fold = lambda t: " ".join(re.findall(r"[^\W\d_]+", t.lower())) + " "
    n, discount = language_id.ORDER, language_id.DISCOUNT

    def model(own):
        levels = [{}]
        for line in map(fold, own):
            padded = " " * (n - 1) + line
            for k in range(len(line)):
                levels[0][padded[k : k + n]] = levels[0].get(padded[k : k + n], 0) + 1
        for _ in range(n - 1):
            below = {}
            for g in levels[-1]:
                below[g[1:]] = below.get(g[1:], 0) + 1
            levels.append(below)
        levels.reverse()

        def p(gram):
            if not gram:
                return 1 / language_id.VOCABULARY
            counts = {g: c for g, c in levels[len(gram) - 1].items() if g[:-1] == gram[:-1]}
            if not counts:
                return p(gram[1:])
            total = sum(counts.values())
            return max(counts.get(gram, 0) - discount, 0) / total + discount * len(counts) / total * p(gram[1:])

        return p

    def entropy(p, text):
        line = fold(text)
        padded = " " * (n - 1) + line
        return -sum(log(p(padded[k : k + n])) for k in range(len(line))) / len(line)

    plain_models = {lang: model(own) for lang, own in texts.items()}
    built = {}
    for lang, own in texts.items():
        keys, _, begin = language_id.text_grams(own)
        keys, counts = np.unique(keys[begin[0] :], return_counts=True)
        built[lang] = language_id.Model(keys, counts)
    identifier = language_id.Identifier(built)
    trial = ["the hat", "der hut und die", "that und", "xyz qq", "kat"]
    got, _ = identifier.entropy(trial)
    assert [identifier.entropy([t])[0][0].tolist() for t in trial] == got.tolist()  # other texts of a batch don't count
    want = [[entropy(plain_models[lang], t) for lang in ("aa", "bb")] for t in trial]
    assert got == pytest.approx(np.array(want), rel=1e-3)
    assert identifier.identify(trial)["lang_pred"].tolist() == [("aa", "bb")[int(np.argmin(w))] for w in want]


def test_language_rejects_as_calibrated(spark, data):
    docs = spark.read.parquet(f"{data.replace('0.001', '0.01')}/documents.parquet").where("lang is not null")
    model = language_id.train(docs, lambda c: ~language_id.held_out(c), max_docs=60)
    found = language_id.identify(docs.where(language_id.held_out(F.col("doc_id"))), model).where("lang_pred <> 'und'")
    assert found.where("rejected").count() / found.count() < 0.03


def test_kneser_ney_sums_to_one():
    """Over all letters that can follow, a context's probabilities sum to one, with the floor's share."""
    import numpy as np

    texts = ["the cat sat on the mat", "that bat ate the rat"]
    keys, n = np.unique(language_id.grams(language_id.folded(texts)[0]), return_counts=True)
    model = language_id.Model(keys, n)
    seen = sorted({int(k & np.uint64(0xFFFF)) for k in keys})
    for context in ("  t", " th", "zzz", "at "):
        c = [ord(x) for x in context]
        grams = np.array([(c[0] << 48) | (c[1] << 32) | (c[2] << 16) | x for x in seen], np.uint64)
        total = np.exp(model.log_probability(grams)).sum()
        rest = (language_id.VOCABULARY - len(seen)) * np.exp(model.log_probability(np.array([(c[0] << 48) | (c[1] << 32) | (c[2] << 16) | 0x3042], np.uint64)))[0]
        assert total + rest == pytest.approx(1, abs=1e-3)


# op8


def test_sentencepiece_equals_the_library(spark, data):
    import sentencepiece

    library = sentencepiece.SentencePieceProcessor(model_file=spm_codec.default_model())
    r = random.Random(4)
    letters = "abc ABC éß的一 \n.,  \t▁𝒳"
    made = ["".join(r.choice(letters) for _ in range(r.randrange(60))) for _ in range(800)]
    texts = [t for _, t, _ in ODD] + ["  ", "   x", "a" * 5000, " " * 300 + "z" + " " * 77, "\x00a\x00 b", "你好  世界", "def f(x):\n    return x\n"] + made
    df = docs_of(spark, [(i, t, None) for i, t in enumerate(texts)])
    got = spm_codec.encode_texts(df)
    for row in got.collect():
        t = texts[row.doc_id]
        assert row.ids == (None if t is None else library.encode(t)), t
        assert row.n_tokens == (None if t is None else len(row.ids))
        assert row.round_trip == (None if t is None else "▁" not in t)
    back = {r.doc_id: r.text for r in spm_codec.decode_ids(got).collect()}
    assert all(back[i] == (t if t is None else t.replace("▁", " ")) for i, t in enumerate(texts))
    assert spm_codec.encode_texts(df.limit(0)).count() == 0


# op9

PAGES = [
    (None, ""), ("", ""), ("<html></html>", ""), ("plain &lt; text", "plain < text"), ("<p>cut off <b", "cut off"), ("<p>a<p>b</p>c", "a\n\nb\n\nc"),
    ("<body><nav>menu</nav><article><header><h1>T &amp; U</h1></header><p>One,\n two.</p><div class='comments'><p>Nice!</p></div><section class=ad>buy</section><ul><li>x<li>y</ul></article><footer>f</footer>", "T & U\n\nOne, two.\n\nx\n\ny"),
    ("<div id=sidebar>s</div><div class=content><h2>H</h2><p>" + "Long text, with marks. " * 20 + "</p><p>Short.</p></div><form>f</form><script>var a='<p>no</p>'</script>", "H\n\n" + ("Long text, with marks. " * 20).strip() + "\n\nShort."),
    ("<div id=page><div class=top-links><ul><li><a href=/>Home</a><li><a href=/b>B</a></ul></div><div class=text><h1>H</h1><p>" + "Long text, with marks. " * 20 + "</p><ul><li>one<li>two <a href=x>three</a></ul></div></div>", "H\n\n" + ("Long text, with marks. " * 20).strip() + "\n\none\n\ntwo three"),
    ("<body><p>" + "Long text, with marks. " * 20 + "<p>Short.<pre>x  y</pre><div>odd</div><div role=navigation>menu</div>", ("Long text, with marks. " * 20).strip() + "\n\nShort.\n\nx y"),
    ("<article><p><b>B<br><p>&eacute;&#233;&#xe9; <i>it</i>alic</article>", "B\n\nééé italic"),
]


def test_main_text(spark):
    df = spark.createDataFrame([(i, None, h, "x") for i, (h, _) in enumerate(PAGES)], "page_id long, url string, html string, text string")
    got = {r.page_id: r for r in html_extract.extract_pages(df).collect()}
    for i, (_, want) in enumerate(PAGES):
        assert (got[i].text, got[i].n_chars) == (want, len(want))
    assert html_extract.extract_pages(df.limit(0)).count() == 0


@pytest.mark.parametrize("tag", ["button", "select", "svg", "object", "math", "canvas", "audio", "video"])
def test_main_text_behind_unclosed_elements(tag):
    e = html_extract.extract
    assert e(f"<article><p>one <{tag} a=b>x</p><p>two</p></article>") == "one\n\ntwo"
    assert e(f"<article><{tag}>x<p>one</p><p>two</p></article><footer>f</footer>") == "one\n\ntwo"
    assert e(f"<article><p>one <{tag}>x<p>two <{tag}>y</{tag}> more</p><script>'</{tag}>'</script><p>three</p></article>") == "one\n\ntwo more\n\nthree"
    assert e(f"<article><p>one <{tag}>x<{tag}>y</{tag}>z</{tag}> two</p></article>") == "one two"
    assert e(f"<article><p>one <{tag}><div>x</div></{tag}> two</p></article>") == "one two"


def test_main_text_behind_stray_quotes():
    e = html_extract.extract
    for attributes in ('title="a""', "class=it's", "title='a'b'", 'title="a', "data-x=5\" data-y", '"', "a = 'x > y'", 'href=x?a="b'):
        assert e(f"<article><p {attributes}>one</p><p>two</p></article>") == "one\n\ntwo", attributes
    assert e('<article><p title="a"">one</p><p id="b">two</p></article>') == "one\n\ntwo"
    assert e("<article><p>one</p><p class=it's>two's</p></article>") == "one\n\ntwo's"


LONG = "Long text, with marks. " * 20
UNMARKED = [
    ("<div><div><a href=/>Home</a><a href=/b>News</a></div><div><h1>T</h1><p>{0}</p><p>{0}</p><ul><li>one<li>two</ul></div><div><ul><li><a href=1>First other story</a><li><a href=2>Second other story</a></ul></div></div>", "T\n\n{0}\n\n{0}\n\none\n\ntwo"),
    ("<main><h1>T</h1><p>{0}</p><h2>Part</h2><p>{0}</p><h2>More</h2><ul><li><a href=/>Home</a><li><a href=/o>Other</a><li><a href=/p>Third</a></ul></main>", "T\n\n{0}\n\nPart\n\n{0}"),
    ("<table><tr><td><a href=1>one</a><br><a href=2>two</a><td><p>{0}<p><a href=x>All of this is a link</a><p>{0}</table>", "{0}\n\nAll of this is a link\n\n{0}"),
    ("<div><span>Printed on Monday</span><div><p>{0}</p><p>{0}</p></div><span>Made by us</span></div>", "{0}\n\n{0}"),
]


def test_ratios_choose_the_content(monkeypatch):
    """On pages without marks of their own the ratios decide: with flat ratios all of these come out otherwise."""
    pages = [tuple(x.format(LONG.strip()) for x in pair) for pair in UNMARKED]
    for page, want in pages:
        assert html_extract.extract(page) == want
    monkeypatch.setattr(html_extract, "fused_ratios", lambda leaves, in_link: ((path := np.unique([x.path for x in leaves], return_inverse=True)[1]), np.ones(path.max() + 1), np.ones(path.max() + 1)))
    assert all(html_extract.extract(page) != want for page, want in pages)


def test_tag_path_ratios_by_hand():
    """Sums by path, smoothing and fusing against plain loops."""
    page = html_extract.parsed("<body><p>One, two.</p><p>Three <a href=x>four</a>!</p><ul><li>five<li><a href=y>six</a></ul><p>Seven; eight.</p></body>")
    leaves = [x for x in page.leaves if x.text.strip()]
    names = []
    for x in leaves:
        n, tags = x.node, []
        while n:
            tags.append(page.tag[n])
            n = page.parent[n]
        names.append("/".join(reversed(tags)))
    assert names == ["body/p", "body/p", "body/p/a", "body/p", "body/ul/li", "body/ul/li/a", "body/p"]
    link = [n.endswith("/a") for n in names]
    mean = lambda f: [sum(f(x) for x, n in zip(leaves, names) if n == m) / names.count(m) for m in names]
    kernel = [2.718281828459045 ** (-k * k / 2) for k in (-2, -1, 0, 1, 2)]
    smooth = lambda v: [sum(w * v[min(max(i + k - 2, 0), len(v) - 1)] for k, w in enumerate(kernel)) / sum(kernel) for i in range(len(v))]
    size = smooth([0.0 if a else x for a, x in zip(link, mean(lambda x: len(x.text.strip())))])
    marks = smooth(mean(lambda x: sum(c in ".,;:!?" for c in x.text)))
    fused = [s * (1 + m) for s, m in zip(size, marks)]
    want = [0.0 if a else sum(f for f, n in zip(fused, names) if n == m) / names.count(m) for a, m in zip(link, names)]
    path, ratio, _ = html_extract.fused_ratios(leaves, np.array(link))
    assert ratio[path].tolist() == pytest.approx(want)


def test_main_text_of_odd_markup(spark):
    e = html_extract.extract
    assert e("<article><!--><p>one</p><!-- x --!><p>two</p><!-- --></article>") == "one\n\ntwo"
    assert e("<article><p>one</p><svg><svg>a</svg>b</svg><p>two</p></article>") == "one\n\ntwo"
    for name in ("post-comments", "content ads", "entry comments-list", "main-menu", "article-sidebar"):
        assert e(f"<article><p>one</p><div class='{name}'><p>{LONG}</p></div></article>") == "one", name
    for name in ("content has-sidebar", "post tag-news", "article-header"):
        assert e(f"<div class='{name}'><p>{LONG}</p></div><p>x</p>") == LONG.strip(), name
    deep = 100_000
    assert e("<div>" * deep + f"<p>{LONG}</p>") == LONG.strip()
    assert e("<ul><li>" + "<div>" * deep + "</span><li></p>" * deep + f"<p>{LONG}") == LONG.strip()
    assert e("<article><h1>Only a title</h1></article>") == "Only a title"
    assert e(f"<article><h1>A</h1><h2>B</h2><h2>C</h2><p>{LONG}</p><h2>D</h2></article>") == f"A\n\nB\n\nC\n\n{LONG.strip()}\n\nD"
    assert e(f"<article><p><a href=x>The first paragraph is a link</a></p><p>{LONG}</p><h2>Last heading</h2></article>") == f"The first paragraph is a link\n\n{LONG.strip()}\n\nLast heading"
    assert e(f"<article><p>{LONG}</p><h3>More</h3><p><a href=x>a</a></p><p><a href=y>b</a></p><h2>Next</h2><h3>Links</h3><ul><li><a href=x>one</a></ul></article>") == LONG.strip()
    for name in ("section class='reader-feedback'", "div id=user-discussion", "div class=discussion-thread"):
        assert e(f"<div><div class=post><p>{LONG}</p></div><{name}><p>{LONG}</p></div></div>") == LONG.strip(), name
        assert e(f"<article><p>one</p><{name}><p>{LONG}</p></{name.split()[0]}></article>") == "one", name
    assert e(f"<div><div><p>{LONG}</p><p>{LONG}</p></div><div>Copyright 2024 Foo, all rights reserved.</div><p>&copy; Foo</p></div>") == f"{LONG.strip()}\n\n{LONG.strip()}"
    assert e(f"<article><p>{LONG}</p><p>Copyright is a right.</p></article>") == f"{LONG.strip()}\n\nCopyright is a right."
    big = (1 << 60) + 1
    df = spark.createDataFrame([(big, "u", "<p>x"), (None, None, None)], "page_id long, url string, html string")
    assert {(r.page_id, r.url, r.text, r.n_chars) for r in html_extract.extract_pages(df).collect()} == {(big, "u", "x", 1), (None, None, "", 0)}


def test_main_text_of_given_pages(spark, data):
    """The pages given mark their article; a plain cut at its tags must give the same blocks."""
    import html

    def want(page):
        article = re.search(r"<article>(.*?)</article>", page, re.S)[1].replace("<br>", "\n")
        blocks = (" ".join(html.unescape(re.sub("<[^>]*>", "", x)).split()) for x in re.split("</?(?:p|h1)>", article))
        return "\n\n".join(x for x in blocks if x)

    pages = spark.read.parquet(f"{data}/pages.parquet")
    got = {r.page_id: r.text for r in html_extract.extract_pages(pages).collect()}
    assert got == {r.page_id: want(r.html) for r in pages.collect()}


# op10


def brute_components(rows, n, percent):
    fold = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    sets = []
    for i, t, _ in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", fold(t))
        sets.append((i, frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])))
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, (_, s) in enumerate(sets):
        for b, (_, t) in enumerate(sets[:a]):
            if s and t and 100 * len(s & t) >= percent * len(s | t):
                parent[root(a)] = root(b)
    lowest = {}
    for k, (i, _) in enumerate(sets):
        lowest.setdefault(root(k), []).append(i)
    least = lambda ids: min((i for i in ids if i is not None), default=None)
    return sorted(((i, len(s), least(lowest[root(k)])) for k, (i, s) in enumerate(sets)), key=str)


@pytest.mark.parametrize(("n", "percent"), [(3, 90), (5, 80)])
def test_jaccard_join(spark, n, percent):
    r = random.Random(n)
    word = lambda: r.choice("abcdefghijklmnopqrstuvwxyz") + r.choice("aeiou") + str(r.randrange(9))
    rows, number = list(ODD), 1000
    for size in (4, 6, 9, 12, 14, 22, 25, 60, 120):
        for _ in range(4):
            base = [word() for _ in range(size)]
            for _ in range(12):
                w = list(base)
                for _ in range(r.choice([0, 0, 1, 1, 2, 3])):
                    k, kind = r.randrange(len(w)), r.randrange(3)
                    w[k : k + 1] = [[word()], [], [w[k], word()]][kind]
                rows.append((number, " ".join(w), "en"))
                number += r.choice([1, 3])
    rows = [x for k, x in enumerate(rows) if x not in rows[:k]] + [rows[3]]
    got = jaccard_join.jaccard_components(docs_of(spark, rows), n, percent)
    assert plain(got) == brute_components(rows, n, percent)


@pytest.mark.parametrize("most", [0, jaccard_join.SMALL_ROWS])
def test_jaccard_join_tells_rows_apart(spark, monkeypatch, most):
    """Two texts under one identifier, null identifiers, and an element that most sets have."""
    monkeypatch.setattr(jaccard_join, "SMALL_ROWS", most)
    r = random.Random(3)
    text = lambda n: [f"w{r.randrange(10**6)}" for _ in range(n)]
    a, b, hot = text(80), text(80), text(12)
    near = lambda t: " ".join([*t[:-1], "other"])
    rows = [(1, " ".join(a), ""), (1, " ".join(b), ""), (2, near(a), ""), (3, near(b), ""), (None, near(a) + " more", ""), (None, " ".join(hot), ""), (None, near(hot * 9), ""), (None, " ".join(hot * 9), "")]
    rows += [(10 + k, " ".join(text(r.choice((20, 30, 70))) + hot * r.choice((1, 5))), "") for k in range(150)]
    for k in range(30):
        i, t, _ = rows[8 + k]
        rows.append((500 + k, t + " end", ""))
    docs = docs_of(spark, rows)
    want = brute_components(rows, 3, 90)
    assert plain(jaccard_join.jaccard_components(docs, 3, 90)) == want
    kept = sorted((r.doc_id, r.text) for r in jaccard_join.keep_one(docs.where("doc_id is not null"), 3, 90).collect())
    named = [x for x in rows if x[0] is not None]
    links = brute_components(named, 3, 90)
    assert len(kept) == len({c for _, _, c in links}) + 1 and {i for i, _ in kept} == {c for _, _, c in links}  # 1 has two texts
    assert jaccard_join.keep_one(docs_of(spark, [(None, "a b c d", ""), (None, "a b c d", ""), (None, "", "")]), 3, 90).count() == 2


def test_jaccard_join_drops_sets_that_share_words_by_chance(spark, monkeypatch):
    r, counted, lists = random.Random(5), [], jaccard_join.heavy_lists
    monkeypatch.setattr(jaccard_join, "heavy_lists", lambda sets, *a: counted.append(sets.count()) or lists(sets, *a))
    rows = [(i, " ".join([f"u{i}x{j}" for j in range(450)] + [f"c{j}" for j in r.sample(range(300), 150)]), "") for i in range(40)]
    rows += [(100, rows[7][1] + " more", "")]
    got = jaccard_join.jaccard_components(docs_of(spark, rows), 1, 90)
    assert plain(got) == brute_components(rows, 1, 90)
    assert counted == [2]


def test_jaccard_join_of_sets_too_large_for_small_sketches(spark):
    r, rows = random.Random(6), []
    assert [jaccard_join.is_full(n, 90) for n in (2375, 2376)] == [False, True]
    for group in range(4):
        base = [f"g{group}x{j}" for j in range((2300, 2376, 2600, 2900)[group])]
        for k in range(8):
            w = list(base)
            for j in r.sample(range(len(w)), r.randrange(len(w) // 60, len(w) // 28)):
                w[j] = f"c{r.randrange(4000)}"
            rows.append((100 * group + k, " ".join(w[: len(w) - r.randrange(40)]), ""))
    want = brute_components(rows, 1, 90)
    assert 4 < len({c for _, _, c in want}) < len(rows)
    assert plain(jaccard_join.jaccard_components(docs_of(spark, rows), 1, 90)) == want


def test_jaccard_join_of_nothing(spark):
    assert jaccard_join.jaccard_components(docs_of(spark, ODD).limit(0)).count() == 0
    assert plain(jaccard_join.jaccard_components(docs_of(spark, [(1, None, ""), (2, "", "")]))) == [(1, 0, 1), (2, 0, 2)]


def test_word_hashes_do_not_depend_on_pieces(monkeypatch):
    text = ("Some words " * 50 + "x" * 300 + " end").encode()
    whole = jaccard_join.word_hashes(text)
    monkeypatch.setattr(jaccard_join, "PIECE", 64)
    assert (jaccard_join.word_hashes(text)[:100] == whole[:100]).all() and len(whole) == 102


def test_components(spark):
    chain = [(k, k + 1) for k in range(1, 60)] + [(100, 101), (200, 150), (150, 101)]
    got = {r.id: r.component for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(range(1, 61), 1), **dict.fromkeys((100, 101, 150, 200), 100)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_components_of_long_chains(spark):
    ids = list(range(1, 1001))
    random.Random(5).shuffle(ids)
    steps = [*range(1002, 1150), 1001]  # the smallest at the end: its label has to walk back
    links = [*zip(ids, ids[1:]), *zip(steps, steps[1:]), (2000, 2000), (2002, 2001), (2001, 2002)]
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(ids, 1), **dict.fromkeys(steps, 1001), 2001: 2001, 2002: 2001}


def test_registry(spark, data):
    from millrace.llm import registry

    assert sorted(int(k[2:].split("_")[0]) for k in registry.QUERIES) == list(range(1, 14))
    assert set(registry.ORACLES) <= set(registry.QUERIES)
    json.dumps(registry.ORACLES)
