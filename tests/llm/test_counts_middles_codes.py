"""Token counts, fill-in-the-middle and vector codes against plainer versions, and their defined results for odd rows."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F
from test_dealt import ODD, docs_of, plain

from millrace.llm import fill_middle, registry, token_counts, vector_codes

STRANGE = ["<|endoftext|>a<|ENDOFTEXT|> <|startoftext|>", "İstanbul's J̌ ΑΣ ΟΔΟΣ", "a b c\x1cd\u0085e", "世界 и мир ١٢٣ ½ ⅷ Ⓐ", "don't we'll 'tis I'd've x'S", "é Å 가 ≠", "́start of marks ‍​", "👩‍👩‍👧 🇩🇪", "a" * 3000 + " " + "1" * 50, "\r\n\t \v\f", "<|endoftext|" + "|>", "ﬁ ǅ 힣 \U0001d400"]


def of_data(data, name, columns):
    return pq.read_table(f"{data}/{name}.parquet", columns=columns).to_pylist()


# op11


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(token_counts.default_tokenizer())


def counts_of(library, rows):
    return sorted((((i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 2048)) for i, t in rows), key=str)


@pytest.mark.parametrize("broadcast", [token_counts.BROADCAST, 20, 0])
def test_counts_equal_the_library(spark, data, library, broadcast):
    """With the whole vocabulary broadcast, its frequent part, and nothing of it."""
    rows = [(i, t) for i, t, _ in ODD] + list(enumerate(STRANGE))
    docs = docs_of(spark, [(i, t, "en") for i, t in rows]).withColumns({c: F.lit("clash") for c in ("key", "p", "n", "n_bytes", "parts")})
    assert plain(token_counts.token_counts(docs, broadcast=broadcast)) == counts_of(library, rows)
    given = [(r["doc_id"], r["text"]) for r in of_data(data, "documents", ["doc_id", "text"])]
    assert plain(token_counts.token_counts(spark.read.parquet(f"{data}/documents.parquet"), broadcast=broadcast)) == counts_of(library, given)
    assert token_counts.token_counts(docs.limit(0), broadcast=broadcast).collect() == []


def test_tokenizers_that_keep_white_space_are_counted_too(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    file = public_tokenizers.path("byte_bpe_50k.json")
    library, rows = Tokenizer.from_file(file), list(enumerate([*STRANGE, "two  spaces\n\nand  more "]))
    docs = docs_of(spark, [(i, t, "en") for i, t in rows])
    assert plain(token_counts.token_counts(docs, tokenizer_file=file)) == counts_of(library, rows)


def test_texts_are_cut_at_spaces_only_if_that_changes_nothing():
    with open(token_counts.default_tokenizer(), encoding="utf-8") as f:
        source = f.read()
    cutter = token_counts.PreTokens(source)
    assert cutter.by_words
    rng = random.Random(5)
    for _ in range(500):
        text = "".join(rng.choice(" \t\n'slAé1.,<|́ 世") for _ in range(rng.randrange(30)))
        ((n, found),) = cutter.frequencies([text])
        assert n == 0 and sorted(found.elements()) == sorted(cutter.cut(text))
    with pytest.raises(ValueError):
        token_counts.PreTokens(source.replace('"lstrip":false', '"lstrip":true', 1).replace('"lstrip": false', '"lstrip": true', 1))


# op12


PLAIN_UNITS = {"chars": r"(?s).", "words": r"[ \t\n\r\v\f]+|[^ \t\n\r\v\f]+", "lines": r"[^\n]*\n|[^\n]+"}


@pytest.mark.parametrize("unit", sorted(PLAIN_UNITS))
def test_scan_finds_every_unit(unit):
    rng = random.Random(3)
    for k in range(400):
        text = "".join(rng.choice("ab é\n\t世<P>S\v") for _ in range(rng.randrange(40) if k else 0))
        scan = fill_middle.Scan(fill_middle.automaton(unit), text, unit)
        ends = [0, *(m.end() for m in re.finditer(PLAIN_UNITS[unit], text))]
        assert scan.units == len(ends) - 1 and [scan.place(r) for r in range(len(ends))] == ends
        assert [s for _, s in scan.sentinels] == re.findall("<[PSM]>", text)


def plain_middle(doc_id, text, unit="chars"):
    text = text or ""
    units = re.findall(PLAIN_UNITS[unit], text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * k : 8 * k + 8], 16) for k in range(4))
    a, b = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    if not text or re.search("<[PSM]>", text) or h3 % 100 >= 90:
        return doc_id, len(units), "plain", None, None, text
    pre, mid, suf = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    form, out = ("spm", f"<S>{suf}<P>{pre}<M>{mid}") if h4 % 100 < 20 else ("psm", f"<P>{pre}<S>{suf}<M>{mid}")
    return doc_id, len(units), form, a, b - a, out


@pytest.mark.parametrize("unit", sorted(PLAIN_UNITS))
def test_middles_equal_the_plain_version_and_come_back(spark, unit):
    texts = [*STRANGE, "<P>", "x <M> y", "<S", "ends with <", "<S<S><", "a<\nb<S c>M>"]
    rows = [(i, t) for i, t, _ in ODD] + [(100 + k, t) for k, t in enumerate(texts * 8)]
    docs = docs_of(spark, [(i, t, "en") for i, t in rows]).withColumns({c: F.lit("clash") for c in ("form", "output", "n", "__h1")})
    made = fill_middle.fill_in_middle(docs, unit=unit)
    assert plain(made) == sorted((plain_middle(i, t, unit) for i, t in rows), key=str)
    assert {r.form for r in made.collect()} == {"plain", "psm", "spm"}
    assert plain(fill_middle.restore(made)) == sorted(((i, t or "") for i, t in rows), key=str)
    assert fill_middle.fill_in_middle(docs.limit(0)).collect() == []
    assert plain(fill_middle.restore(spark.createDataFrame([(1, None, "psm"), (2, "x", None)], "doc_id long, output string, form string"))) == [(1, None), (2, None)]


# op13


def plain_codes(rows, parts=8, entries=16, rounds=6, scale=4096):
    """{vec_id: (code, error)} and the codebooks, by Lloyd rounds over every vector, part and entry."""
    kept = [(i, [int(np.floor(scale * float(x))) for x in v]) for i, v in rows if v is not None and all(x is not None and np.isfinite(x) for x in v)]
    kept.sort()
    if not kept:
        return [], None
    x = np.array([v for _, v in kept], np.int64).reshape(len(kept), parts, -1)
    books = [x[:entries, p].copy() for p in range(parts)]
    for k in range(rounds + 1):
        codes = [((x[:, p, None] - books[p]) ** 2).sum(2).argmin(1) for p in range(parts)]
        for p in range(parts if k < rounds else 0):
            for e in range(len(books[p])):
                if (mine := x[codes[p] == e, p]).size:
                    books[p][e] = mine.sum(0) // len(mine)
    errors = sum(((x[:, p] - books[p][codes[p]]) ** 2).sum(1) for p in range(parts))
    return sorted((i, "".join(f"{codes[p][k]:02x}" for p in range(parts)), int(errors[k])) for k, (i, _) in enumerate(kept)), np.stack(books)


def odd_vectors(rng):
    hot = [0.5] * 16
    rows = [(i, hot if i % 3 == 0 else [float(x) for x in rng.integers(-2, 3, 16) / 4]) for i in range(400)]
    rows += [(1000, None), (1001, [1.0] * 15 + [None]), (1002, [float("nan")] + [1.0] * 15), (1003, [float("-inf")] * 16), (1004, [-0.0001] * 16), (1005, [1e4] * 16), (7, hot), (7, hot)]
    return rows


@pytest.mark.parametrize("block", [7, 100, vector_codes.BLOCK])
def test_codes_equal_plain_lloyd(spark, block):
    rows = odd_vectors(np.random.default_rng(8))
    df = spark.createDataFrame([(i, v, i % 5, "clash", 1) for i, v in rows], "vec_id long, embedding array<double>, label int, code string, v int")
    coded, books = vector_codes.compress(df, block=block)
    want, want_books = plain_codes(rows)
    assert (books == want_books).all()
    assert sorted((r.vec_id, r.code, r.error) for r in coded.collect()) == want


def test_odd_tables_of_vectors(spark, tmp_path):
    kind = "vec_id long, embedding array<float>, label string"
    few = [(3, [1.0] * 8, None), (1, [0.0] * 7 + [9.0], "a"), (2, None, "a"), (None, [2.0] * 8, None)]
    spark.createDataFrame(few, kind).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = vector_codes.op13_vector_codes(spark, str(tmp_path)).collect()
    assert {(r.vec_id, r.code) for r in got} == {(1, "00" * 8), (3, "01" * 8), (None, "02" * 8)}
    assert {r.error for r in got} == {0} and {r.label_error for r in got} == {0}
    none, books = vector_codes.compress(spark.createDataFrame([(1, None, "a")], kind))
    assert none.collect() == [] and books.size == 0
    for bad in ([1.0] * 9, [1e9] * 8):
        with pytest.raises(Exception, match="divisible|components"):
            vector_codes.compress(spark.createDataFrame([(1, bad, "a")], kind))


def test_subtrees_are_assigned_at_once():
    rng = np.random.default_rng(1)
    cluster = rng.integers(0, 4, 4000)
    points = (rng.normal(0, 5, (4000, 8)) + cluster[:, None] * 400).astype(np.int64)
    tree = vector_codes.build(points)
    held = tree[1].astype(np.int64)
    assert (held == points[tree[0]]).all()
    for entries in (np.stack([points[cluster == c][0] for c in range(4)]), np.stack([points[rng.integers(4000)] for _ in range(16)]), np.repeat(points[:2], 3, axis=0)):
        codes, counts, totals, single = vector_codes.assign(tree, entries)
        want = ((held[:, None] - entries) ** 2).sum(2).argmin(1)
        assert (codes == want).all() and (counts == np.bincount(want, minlength=len(entries))).all()
        assert (totals == np.stack([held[want == e].sum(0) for e in range(len(entries))])).all()
        if len(entries) == 4:  # one for each cluster: hardly a point is looked at by itself
            assert single < 100
    assert vector_codes.assign(vector_codes.build(np.tile(points[:1], (4000, 1))), entries)[3] == 0


# SQL


@pytest.mark.parametrize("name", ["op12_fill_middle", "op13_vector_codes"])
def test_queries_equal_their_sql(spark, data, tmp_path, name):
    registry.QUERIES[name](spark, data).write.parquet(f"{tmp_path}/out")
    duck = duckdb.connect()
    for t in ("documents", "embeddings"):
        duck.execute(f"create view {t} as select * from '{data}/{t}.parquet'")
    duck.execute(f"create table got as select * from '{tmp_path}/out/*.parquet'")
    duck.execute(f"create table want as {registry.ORACLES[name]}")
    columns = ", ".join(sorted(r[0] for r in duck.execute("describe want").fetchall()))
    for a, b in (("got", "want"), ("want", "got")):
        assert duck.execute(f"select {columns} from {a} except all select {columns} from {b} limit 3").fetchall() == []
