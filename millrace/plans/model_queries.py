"""Queries over vocabularies, encoding, tagging, reports, calibration and rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from ..operators import calibrate, metrics, nlu, scoring, sequence
from .common import draw_sql, table, turns

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


def tokened(spark, d):
    return turns(spark, d).where("text is not null").select("conv_id", "turn", T.tokens_space(F.col("text")).alias("tokens"))


TOK_SQL = r"tk AS (SELECT conv_id, turn, list_filter(string_split_regex(translate(lower(text), '.,?!', '    '), '\s+'), lambda x: x <> '') AS tokens FROM conversations WHERE text IS NOT NULL)"
VOCAB_SQL = f"{TOK_SQL}, ex AS (SELECT conv_id, turn, unnest(tokens) AS token, unnest(range(0, len(tokens))) AS pos FROM tk), vc AS (SELECT token, CAST(count(*) AS BIGINT) AS n, min((conv_id, turn, pos)) AS f FROM ex GROUP BY token), vocab AS (SELECT token, n, row_number() OVER (ORDER BY n DESC, f) + 1 AS idx FROM vc)"


@query("m_vocab", f"WITH {VOCAB_SQL} SELECT token, n, idx FROM vocab")
def m_vocab(spark, d):
    return sequence.vocabulary(tokened(spark, d), "tokens", "conv_id", "turn")


@query("m_labels", "SELECT source AS label, row_number() OVER (ORDER BY source) - 1 AS idx FROM (SELECT DISTINCT source FROM documents)")
def m_labels(spark, d):
    return sequence.label_index(table(spark, d, "documents"), "source")


ENC_SQL = f"{VOCAB_SQL}, en AS (SELECT tk.conv_id, tk.turn, (SELECT list(coalesce(v.idx, 1) ORDER BY e.pos) FROM ex e LEFT JOIN vocab v ON e.token = v.token AND v.n > 1 WHERE e.conv_id = tk.conv_id AND e.turn = tk.turn AND e.pos < 24) AS part FROM tk), ids AS (SELECT conv_id, turn, list_resize(coalesce(part, []), 24, 0) AS ids FROM en)"


def encoded(spark, d):
    rows = tokened(spark, d)
    vocab = sequence.vocabulary(rows, "tokens", "conv_id", "turn").where("n > 1")
    return sequence.encode(rows, vocab, "tokens", "conv_id", "turn")


@query("m_vectorize", f"WITH {ENC_SQL} SELECT conv_id, turn, array_to_string(ids, ',') AS ids FROM ids")
def m_vectorize(spark, d):
    return encoded(spark, d).select("conv_id", "turn", F.array_join(F.transform("ids", lambda x: x.cast("string")), ",").alias("ids"))


@query("m_dropout", f"WITH {ENC_SQL} SELECT conv_id, turn, array_to_string(list_transform(ids, lambda x, i: CASE WHEN x <> 0 AND {draw_sql(chr(39) + 'drop' + chr(39), 'conv_id', 'turn', 'i - 1')} < 0.1 THEN 1 ELSE x END), ',') AS ids FROM ids")
def m_dropout(spark, d):
    ids = sequence.dropout(F.col("ids"), 0.1, "drop", F.col("conv_id"), F.col("turn"))
    return encoded(spark, d).select("conv_id", "turn", F.array_join(F.transform(ids, lambda x: x.cast("string")), ",").alias("ids"))


# Tags from the tokens' lengths: every kind of stray and mismatched tag occurs.
TAGS = ("O", "B-A", "I-A", "B-B", "I-B")


def tagged(spark, d):
    tag = F.transform("tokens", lambda t: F.element_at(F.array(*map(F.lit, TAGS)), F.pmod(F.length(t), F.lit(5)) + 1))
    return sequence.bio_rows(tokened(spark, d).withColumn("tags", tag), "tokens", "tags", "conv_id", "turn")


TAG_SQL = f"{TOK_SQL}, tg AS (SELECT conv_id, turn, pos, token, ['O', 'B-A', 'I-A', 'B-B', 'I-B'][length(token) % 5 + 1] AS tag FROM (SELECT conv_id, turn, unnest(tokens) AS token, unnest(range(0, len(tokens))) AS pos FROM tk))"
STRICT_SQL = f"""{TAG_SQL}, a AS (SELECT *, sum(CASE WHEN tag LIKE 'B-%' THEN 1 ELSE 0 END) OVER w AS run, substr(tag, 3) AS label FROM tg WINDOW w AS (PARTITION BY conv_id, turn ORDER BY pos ROWS UNBOUNDED PRECEDING)),
b AS (SELECT *, first_value(label) OVER (PARTITION BY conv_id, turn, run ORDER BY pos) AS own FROM a WHERE run > 0),
c AS (SELECT *, max(CASE WHEN tag LIKE 'B-%' OR (tag LIKE 'I-%' AND label = own) THEN 0 ELSE 1 END) OVER (PARTITION BY conv_id, turn, run ORDER BY pos ROWS UNBOUNDED PRECEDING) AS broken FROM b),
sp AS (SELECT conv_id, turn, run, CAST(min(pos) AS INTEGER) AS start, CAST(max(pos) AS INTEGER) AS "end", any_value(own) AS label, string_agg(token, ' ' ORDER BY pos) AS text FROM c WHERE broken = 0 GROUP BY conv_id, turn, run)"""
SALVAGE_SQL = f"""{TAG_SQL}, a AS (SELECT *, CASE WHEN tag = 'O' THEN '' ELSE substr(tag, 3) END AS label FROM tg),
b AS (SELECT *, coalesce(lag(label) OVER (PARTITION BY conv_id, turn ORDER BY pos), '') AS prev FROM a),
c AS (SELECT *, sum(CASE WHEN tag LIKE 'B-%' OR label <> prev THEN 1 ELSE 0 END) OVER (PARTITION BY conv_id, turn ORDER BY pos ROWS UNBOUNDED PRECEDING) AS run FROM b),
sp AS (SELECT conv_id, turn, run, CAST(min(pos) AS INTEGER) AS start, CAST(max(pos) AS INTEGER) AS "end", any_value(label) AS label, string_agg(token, ' ' ORDER BY pos) AS text FROM c WHERE label <> '' GROUP BY conv_id, turn, run)"""


@query("b_bio_py", f'WITH {STRICT_SQL} SELECT conv_id, turn, start, "end", label, text FROM sp')
def b_bio_py(spark, d):
    return sequence.decode_strict(tagged(spark, d), "conv_id", "turn")


@query("b_bio_rn", f'WITH {SALVAGE_SQL} SELECT conv_id, turn, start, "end", label, text FROM sp')
def b_bio_rn(spark, d):
    return sequence.decode_salvage(tagged(spark, d), "conv_id", "turn")


@query("b_bio_map", f"WITH {SALVAGE_SQL}, m AS (SELECT conv_id, turn, label, arg_max(text, start) AS text FROM sp GROUP BY ALL) SELECT conv_id, turn, string_agg(label || '=' || text, '|' ORDER BY label) AS entities FROM m GROUP BY conv_id, turn")
def b_bio_map(spark, d):
    found = sequence.entity_map(sequence.decode_salvage(tagged(spark, d), "conv_id", "turn"), "conv_id", "turn")
    pairs = F.array_sort(F.transform(F.map_entries("entities"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return found.select("conv_id", "turn", F.array_join(pairs, "|").alias("entities"))


REPORT_SQL = """labels AS (SELECT t AS label FROM p UNION SELECT p FROM p),
per AS (SELECT label, (SELECT count(*) FROM p WHERE p = label) AS ap, (SELECT count(*) FROM p WHERE t = label) AS at_, (SELECT count(*) FROM p WHERE t = label AND p = label) AS hit FROM labels),
m AS (SELECT label, coalesce(hit / nullif(ap, 0), 0) AS precision, coalesce(hit / nullif(at_, 0), 0) AS recall, at_ AS support, hit FROM per),
f AS (SELECT *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0) AS f1 FROM m)
SELECT label, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, CAST(support AS BIGINT) AS support FROM f
UNION ALL SELECT 'accuracy', round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6), round(sum(hit) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), CAST(sum(support) AS BIGINT) FROM f
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6), round(sum(f1 * support) / sum(support), 6), CAST(sum(support) AS BIGINT) FROM f"""


def rounded(df):
    return df.select(*(F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))


def guesses(spark, d):
    """Predictions that are wrong for every vector whose identifier leaves 0 or 1 modulo 7."""
    k = F.col("vec_id")
    return table(spark, d, "embeddings").select("vec_id", F.col("label").alias("truth"), F.when(k % 7 == 0, (F.col("label") + 1) % 10).when(k % 7 == 1, 11).otherwise(F.col("label")).alias("predicted"))


GUESS_SQL = "g AS (SELECT vec_id, label AS truth, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 WHEN vec_id % 7 = 1 THEN 11 ELSE label END AS predicted FROM embeddings)"


@query("m_class_report", f"WITH {GUESS_SQL}, p AS (SELECT CAST(truth AS VARCHAR) AS t, CAST(predicted AS VARCHAR) AS p FROM g), {REPORT_SQL}")
def m_class_report(spark, d):
    return rounded(metrics.class_report(guesses(spark, d)))


@query("m_confusion", f"WITH {GUESS_SQL} SELECT truth, " + ", ".join(f"CAST(count(*) FILTER (predicted = {v}) AS BIGINT) AS p_{v}" for v in range(12)) + " FROM g GROUP BY truth")
def m_confusion(spark, d):
    return metrics.confusion(guesses(spark, d), list(range(12)))


MACRO = "(SELECT avg(coalesce(2 * p * r / nullif(p + r, 0), 0)) FROM (SELECT coalesce((SELECT count(*) FROM {t} WHERE truth = label AND guess = label) / nullif((SELECT count(*) FROM {t} WHERE guess = label), 0), 0) AS p, coalesce((SELECT count(*) FROM {t} WHERE truth = label AND guess = label) / nullif((SELECT count(*) FROM {t} WHERE truth = label), 0), 0) AS r FROM (SELECT truth AS label FROM {t} UNION SELECT guess FROM {t})))"


@query("a_robustness", f"WITH {GUESS_SQL}, c AS (SELECT truth, predicted AS guess FROM g), n AS (SELECT truth, CASE WHEN vec_id % 5 = 0 THEN (truth + 2) % 10 ELSE predicted END AS guess FROM g), m AS (SELECT {MACRO.format(t='c')} AS a, {MACRO.format(t='n')} AS b) SELECT round(a, 6) AS f1_clean, round(b, 6) AS f1_noisy, round(a - b, 6) AS delta, a - b < 0.05 AS robust FROM m")
def a_robustness(spark, d):
    clean = guesses(spark, d)
    noisy = clean.withColumn("predicted", F.when(F.col("vec_id") % 5 == 0, (F.col("truth") + 2) % 10).otherwise(F.col("predicted")))
    return rounded(metrics.robustness(clean, noisy))


@query("a_group_listing", """WITH t AS (SELECT r_name, n_name, CAST(count(DISTINCT c_mktsegment) AS BIGINT) AS k FROM nation JOIN region ON n_regionkey = r_regionkey LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY r_name, n_name)
SELECT r_name, n_name, row_number() OVER (PARTITION BY r_name ORDER BY n_name) AS place, count(*) OVER (PARTITION BY r_name) AS n_names, CAST(sum(k) OVER (PARTITION BY r_name) AS BIGINT) AS n_parts FROM t""")
def a_group_listing(spark, d):
    nations = table(spark, d, "nation").join(F.broadcast(table(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    parts = table(spark, d, "customer").groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.collect_set("c_mktsegment").alias("segments"))
    taxonomy = nations.join(parts, "n_nationkey", "left").select("r_name", "n_name", F.coalesce("segments", F.array().cast("array<string>")).alias("segments"))
    return metrics.group_listing(taxonomy, "r_name", "n_name", "segments")


@query("m_slot_report", f"WITH {TAG_SQL}, q AS (SELECT tag AS t, CASE WHEN pos % 9 = 0 THEN 'B-A' WHEN pos % 9 = 1 THEN 'O' ELSE tag END AS p FROM tg WHERE pos < 24), labels AS (SELECT unnest(['B-A', 'B-B', 'I-A', 'I-B']) AS label), per AS (SELECT label, (SELECT count(*) FROM q WHERE p = label) AS ap, (SELECT count(*) FROM q WHERE t = label) AS at_, (SELECT count(*) FROM q WHERE t = label AND p = label) AS hit FROM labels) SELECT label, round(coalesce(hit / nullif(ap, 0), 0), 6) AS precision, round(coalesce(hit / nullif(at_, 0), 0), 6) AS recall, CAST(at_ AS BIGINT) AS support FROM per")
def m_slot_report(spark, d):
    rows = tagged(spark, d).where("pos < 24").select(F.col("tag").alias("truth"), F.when(F.col("pos") % 9 == 0, "B-A").when(F.col("pos") % 9 == 1, "O").otherwise(F.col("tag")).alias("predicted"))
    labels = spark.createDataFrame([(x,) for x in ("B-A", "B-B", "I-A", "I-B")], "label string")
    return rounded(metrics.class_report(rows, labels=labels).join(labels, "label", "left_semi")).select("label", "precision", "recall", "support")


CENTER_SQL = "x AS (SELECT vec_id, label, unnest(embedding) AS v, unnest(range(0, len(embedding))) AS pos FROM embeddings), c AS (SELECT label, pos, avg(CAST(v AS DOUBLE)) AS m, count(*) AS n FROM x GROUP BY label, pos)"


def vectors(spark, d):
    return table(spark, d, "embeddings").withColumn("embedding", F.col("embedding").cast("array<double>"))


@query("m_centroid", f"WITH {CENTER_SQL} SELECT label, CAST(pos AS INTEGER) AS pos, round(m, 6) AS value FROM c")
def m_centroid(spark, d):
    return calibrate.centroids(vectors(spark, d)).select("label", F.posexplode("centroid").alias("pos", "v")).select("label", "pos", F.round("v", 6).alias("value"))


RADIUS_SQL = f"{CENTER_SQL}, ds AS (SELECT x.vec_id, x.label, sqrt(sum((x.v - c.m) * (x.v - c.m))) AS d FROM x JOIN c ON x.label = c.label AND x.pos = c.pos GROUP BY x.vec_id, x.label), rd AS (SELECT label, greatest(quantile_cont(d, 0.95) * 1.15, 1e-6) AS radius, CAST(count(*) AS BIGINT) AS n FROM ds GROUP BY label)"


@query("m_radius", f"WITH {RADIUS_SQL} SELECT label, round(radius, 6) AS radius, n FROM rd")
def m_radius(spark, d):
    v = vectors(spark, d)
    return rounded(calibrate.radii(v, calibrate.centroids(v)))


NEAR_SQL = f"{RADIUS_SQL}, ad AS (SELECT x.vec_id, c.label AS l, sqrt(sum((x.v - c.m) * (x.v - c.m))) AS d FROM x JOIN c ON x.pos = c.pos GROUP BY x.vec_id, c.label), ne AS (SELECT vec_id, l AS nearest, d, row_number() OVER (PARTITION BY vec_id ORDER BY d, l) AS r FROM ad)"


def near(spark, d):
    v = vectors(spark, d)
    centers = calibrate.centroids(v)
    return calibrate.nearest(v, centers.join(calibrate.radii(v, centers).select("label", "radius"), "label"))


@query("m_nearest", f"WITH {NEAR_SQL} SELECT vec_id, nearest, round(d, 6) AS distance FROM ne WHERE r = 1")
def m_nearest(spark, d):
    return near(spark, d).select("vec_id", "nearest", F.round("distance", 6).alias("distance"))


@query("m_boundary_accept", f"WITH {NEAR_SQL} SELECT vec_id, nearest, d <= radius AS accepted FROM ne JOIN rd ON nearest = rd.label WHERE r = 1")
def m_boundary_accept(spark, d):
    return near(spark, d).select("vec_id", "nearest", "accepted")


@query("m_decide", f"""WITH {NEAR_SQL}, b AS (SELECT vec_id, nearest, d <= radius AS ok FROM ne JOIN rd ON nearest = rd.label WHERE r = 1), k AS (SELECT b.vec_id, CAST(nearest AS VARCHAR) AS nl, CASE WHEN b.vec_id % 5 = 0 THEN NULL ELSE ok END AS ok, CAST(e.label AS VARCHAR) AS top, (b.vec_id % 100) / 100.0 AS conf FROM b JOIN embeddings e ON b.vec_id = e.vec_id)
SELECT vec_id, CASE WHEN ok IS NOT NULL AND NOT ok THEN 'UNKNOWN' WHEN ok IS NOT NULL THEN nl WHEN conf < 0.65 THEN 'UNKNOWN' ELSE top END AS intent, CASE WHEN ok THEN 0.5 ELSE CAST(conf AS DOUBLE) END AS confidence, CASE WHEN ok IS NOT NULL AND NOT ok THEN 'boundary' WHEN ok IS NULL AND conf < 0.65 THEN 'confidence' END AS unknown_reason FROM k""")
def m_decide(spark, d):
    accepted = F.when(F.col("vec_id") % 5 != 0, F.col("accepted"))
    decided = calibrate.decide(F.col("label").cast("string"), F.col("vec_id") % 100 / 100.0, F.col("nearest").cast("string"), F.lit(0.5), accepted)
    return near(spark, d).select("vec_id", decided.alias("r")).select("vec_id", "r.*")


PROB_SQL = "lg AS (SELECT vec_id, label, list_transform(embedding[1:10], lambda v: CAST(v AS DOUBLE) * 12) AS l FROM embeddings), pr AS (SELECT vec_id, label, list_transform(l, lambda v: exp(v - list_max(l)) / list_sum(list_transform(l, lambda w: exp(w - list_max(l))))) AS p FROM lg)"


def probabilities(spark, d):
    logits = F.transform(F.slice("embedding", 1, 10), lambda v: v * 12)
    return vectors(spark, d).select("vec_id", "label", calibrate.softmax(logits).alias("p"))


@query("m_argmax", f"WITH {PROB_SQL} SELECT vec_id, CAST(list_position(p, list_max(p)) - 1 AS INTEGER) AS top, round(list_max(p), 6) AS confidence FROM pr")
def m_argmax(spark, d):
    return probabilities(spark, d).select("vec_id", calibrate.argmax(F.col("p")).alias("top"), F.round(F.array_max("p"), 6).alias("confidence"))


@query("m_temp_scale", f"WITH {PROB_SQL}, z AS (SELECT vec_id, list_transform(p, lambda v: ln(greatest(least(v, 1.0), 1e-8)) / 1.7) AS z FROM pr) SELECT vec_id, CAST(i - 1 AS INTEGER) AS pos, round(exp(z[i] - list_max(z)) / list_sum(list_transform(z, lambda w: exp(w - list_max(z)))), 6) AS p FROM z, range(1, 11) r(i)")
def m_temp_scale(spark, d):
    scaled = probabilities(spark, d).select("vec_id", F.posexplode(calibrate.temperature_scaled(F.col("p"), 1.7)).alias("pos", "p"))
    return scaled.select("vec_id", "pos", F.round("p", 6).alias("p"))


@query("m_temp_fit", f"WITH {PROB_SQL}, g AS (SELECT round(0.5 + 0.1 * i, 1) AS t FROM range(46) r(i)), z AS (SELECT t, label, list_transform(p, lambda v: ln(greatest(least(v, 1.0), 1e-8)) / t) AS z FROM pr, g), n AS (SELECT t, round(avg(-ln(greatest(exp(z[label + 1] - list_max(z)) / list_sum(list_transform(z, lambda w: exp(w - list_max(z)))), 1e-8))), 9) AS nll FROM z GROUP BY t) SELECT CAST(t AS DOUBLE) AS t, round(nll, 6) AS nll FROM n ORDER BY n.nll, t LIMIT 1")
def m_temp_fit(spark, d):
    return calibrate.fit_temperature(probabilities(spark, d), truth="label").select("t", F.round("nll", 6).alias("nll"))


# Fixed values of these queries: phrases that are put behind the turns' own texts, so that rules fire.
PHRASES = ("i spent 450 on groceries today", "can i afford a 50 lakh car", "salary credited 1,250.50 this month", "show my budget limit", "pay the loan payment for 5 kids", "how to save more", "buy 2.5 crore apartment", "net worth overview please", "consulting job paid 10k", "gold and shares at amazon", "", "hello there")


def spoken(spark, d):
    k = F.col("conv_id") * 7 + F.col("turn")
    phrase = lambda n: F.element_at(F.array(*map(F.lit, PHRASES)), (F.pmod(n, F.lit(len(PHRASES))) + 1).cast("int"))
    return turns(spark, d).select("conv_id", "turn", F.trim(F.concat_ws(" ", "text", phrase(k), F.when(k % 3 == 0, phrase(k + 5)))).alias("text"))


SPOKEN_SQL = f"ph AS (SELECT {list(PHRASES)} AS l), sp AS (SELECT conv_id, turn, trim(concat_ws(' ', text, l[(conv_id * 7 + turn) % {len(PHRASES)} + 1], CASE WHEN (conv_id * 7 + turn) % 3 = 0 THEN l[(conv_id * 7 + turn + 5) % {len(PHRASES)} + 1] END)) AS text FROM conversations, ph)"
KEY_SQL = "kw AS (SELECT * FROM (VALUES " + ", ".join(f"('{i}', {p}, {w}, '{k}')" for p, (i, w, ks) in enumerate(nlu.INTENT_KEYWORDS) for k in ks) + ") AS v(intent, place, weight, k))"


@query("n_intent_score", f"""WITH {SPOKEN_SQL}, {KEY_SQL}, du AS (SELECT DISTINCT text, lower(trim(text)) AS low FROM sp),
oc AS (SELECT text, intent, place, weight, len(list_filter(range(1, length(low) + 1), lambda i: substr(low, i, length(k)) = k)) AS n FROM du JOIN kw ON contains(low, k)),
sc AS (SELECT text, intent, any_value(place) AS place, sum(n) * any_value(weight) AS s FROM oc GROUP BY text, intent HAVING sum(n) > 0),
rk AS (SELECT *, row_number() OVER (PARTITION BY text ORDER BY s DESC, place) AS r FROM sc),
a AS (SELECT du.text, low, f.intent AS i1, f.s AS s1, g.intent AS i2, g.s AS s2 FROM du LEFT JOIN rk f ON f.text = du.text AND f.r = 1 LEFT JOIN rk g ON g.text = du.text AND g.r = 2),
b AS (SELECT *, coalesce(i1, 'UNKNOWN') AS i, CASE WHEN i1 IS NULL THEN 0.42 ELSE least(0.99, 0.45 + s1 * 0.15) END AS c FROM a),
b2 AS (SELECT *, CASE WHEN i2 IS NOT NULL THEN least(c - 0.05, 0.35 + s2 * 0.1) END AS c2 FROM b),
c1 AS (SELECT *, (contains(low, 'spent') OR contains(low, 'paid') OR contains(low, 'groceries')) AND (i = 'UNKNOWN' OR c < 0.6) AS h FROM b2),
d1 AS (SELECT * REPLACE (CASE WHEN h THEN 'ADD_EXPENSE' ELSE i END AS i, CASE WHEN h THEN 0.95 ELSE c END AS c) FROM c1),
e1 AS (SELECT *, (contains(low, 'salary') OR contains(low, 'credited') OR contains(low, 'earned')) AND (i = 'UNKNOWN' OR c < 0.6) AS h2 FROM d1),
f1 AS (SELECT * REPLACE (CASE WHEN h2 THEN 'ADD_INCOME' ELSE i END AS i, CASE WHEN h2 THEN 0.97 ELSE c END AS c) FROM e1),
g1 AS (SELECT *, contains(low, 'afford') OR contains(low, 'buy') OR contains(low, 'position') OR contains(low, 'safe to spend') AS h3 FROM f1),
fin AS (SELECT text, i2, c2, CASE WHEN low = '' THEN 'UNKNOWN' WHEN h3 THEN 'AFFORDABILITY_CHECK' ELSE i END AS intent, CASE WHEN low = '' THEN 1.0 WHEN h3 AND c < 0.7 THEN 0.97 ELSE c END AS confidence FROM g1)
SELECT conv_id, turn, intent, round(CAST(confidence AS DOUBLE), 6) AS confidence, i2 AS second, round(CAST(c2 AS DOUBLE), 6) AS second_confidence FROM sp JOIN fin USING (text)""")
def n_intent_score(spark, d):
    return rounded(nlu.intent_of(spoken(spark, d), "text").select("conv_id", "turn", "intent", "confidence", "second", "second_confidence"))


HINTS = [("LOG", ["spent", "paid"]), ("PLAN", ["afford", "save", "budget"]), ("VIEW", ["show", "net worth", "overview"])]


@query("n_route", "WITH " + SPOKEN_SQL + " SELECT conv_id, turn, CASE WHEN contains(text, 'spent') OR contains(text, 'paid') THEN 'LOG' WHEN contains(text, 'afford') OR contains(text, 'save') OR contains(text, 'budget') THEN 'PLAN' WHEN contains(text, 'show') OR contains(text, 'net worth') OR contains(text, 'overview') THEN 'VIEW' ELSE 'GENERAL' END AS sub_intent, CASE WHEN contains(text, 'spent') OR contains(text, 'paid') THEN array_to_string(list_filter(['spent', 'paid'], lambda h: contains(text, h)), ',') WHEN contains(text, 'afford') OR contains(text, 'save') OR contains(text, 'budget') THEN array_to_string(list_filter(['afford', 'save', 'budget'], lambda h: contains(text, h)), ',') WHEN contains(text, 'show') OR contains(text, 'net worth') OR contains(text, 'overview') THEN array_to_string(list_filter(['show', 'net worth', 'overview'], lambda h: contains(text, h)), ',') ELSE 'default' END AS matched FROM sp")
def n_route(spark, d):
    rows = spoken(spark, d).withColumn("r", nlu.route(F.col("text"), HINTS, "GENERAL"))
    return rows.select("conv_id", "turn", "r.sub_intent", F.array_join("r.matched", ",").alias("matched"))


AMOUNT_SQL = r"coalesce(TRY_CAST(nullif(regexp_extract(low, '(\d+(?:\.\d+)?)\s*(?:lakhs?|lacs?)', 1), '') AS DOUBLE) * 100000, TRY_CAST(nullif(regexp_extract(low, '(\d+(?:\.\d+)?)\s*(?:crores?|cr)', 1), '') AS DOUBLE) * 10000000, TRY_CAST(nullif(regexp_extract(low, '(\d+(?:\.\d+)?)\s*(?:text-)?(?:k|thousand)', 1), '') AS DOUBLE) * 1000, TRY_CAST(replace(nullif(regexp_extract(low, '(\d+(?:,\d+)*(?:\.\d+)?)', 1), ''), ',', '') AS DOUBLE))"


@query("n_amount", f"WITH {SPOKEN_SQL}, l AS (SELECT *, lower(trim(text)) AS low FROM sp) SELECT conv_id, turn, {AMOUNT_SQL} AS amount FROM l")
def n_amount(spark, d):
    return spoken(spark, d).select("conv_id", "turn", nlu.amount(F.col("text")).alias("amount"))


@query("n_word_place", r"WITH " + SPOKEN_SQL + r" SELECT conv_id, turn, CAST(coalesce(list_position(list_transform(string_split_regex(lower(text), '\s+'), lambda w: contains(w, 'loan')), true), 0) - 1 AS INTEGER) AS place FROM sp")
def n_word_place(spark, d):
    return spoken(spark, d).select("conv_id", "turn", nlu.word_place(F.col("text"), F.lit("loan")).alias("place"))


@query("n_afford", f"""WITH {SPOKEN_SQL}, l AS (SELECT *, lower(trim(text)) AS low FROM sp), m AS (SELECT conv_id, turn, coalesce({AMOUNT_SQL}, 0) AS a, contains(low, 'lakh') OR contains(low, 'lac') OR contains(low, 'crore') OR contains(low, 'rs') OR contains(low, 'inr') AS loc FROM l),
v AS (SELECT *, CASE WHEN loc THEN 1200000.0 ELSE 60000.0 END AS r, CASE WHEN loc THEN CAST(0.021 AS DOUBLE) ELSE CAST(0.019 AS DOUBLE) END AS f FROM m),
x AS (SELECT *, CASE WHEN a <= 0 THEN 'NONE' WHEN a > r * 3.5 THEN 'DENIED' WHEN a > r * 0.7 THEN 'CAUTION' ELSE 'APPROVED' END AS verdict FROM v)
SELECT conv_id, turn, verdict, CASE WHEN verdict IN ('CAUTION', 'APPROVED') THEN round(a * CAST(0.2 AS DOUBLE), 6) END AS down_payment, CASE WHEN verdict IN ('CAUTION', 'APPROVED') THEN CAST(floor(a * CAST(0.8 AS DOUBLE) * f + 0.5) AS BIGINT) END AS monthly, CAST(CASE verdict WHEN 'DENIED' THEN -35 WHEN 'CAUTION' THEN -12 WHEN 'APPROVED' THEN 4 ELSE 0 END AS INTEGER) AS health FROM x""")
def n_afford(spark, d):
    rows = spoken(spark, d)
    return rounded(rows.select("conv_id", "turn", nlu.affordability(F.col("text"), nlu.amount(F.col("text"))).alias("r")).select("conv_id", "turn", "r.*"))


ENTITY_CASE = " ".join(
    "WHEN " + " OR ".join([f"c IN ({', '.join(repr(w) for w in ws)})"] + ([f"(length(c) > 3 AND ({' OR '.join(f'contains({w!r}, c)' for w in ws)}))"] if n == "category" else []) + [f"(c = '{a}' AND nx = '{b}')" for a, b, to in nlu.PHRASES if to == n]) + f" THEN '{n}'"
    for n, ws in nlu.ENTITY_WORDS
)
SPAN_SQL = (
    rf"{SPOKEN_SQL}, w AS (SELECT conv_id, turn, lower(trim(text)) AS low, string_split_regex(lower(text), '\s+') AS lw, list_filter(string_split_regex(text, '\s+'), lambda x: x <> '') AS ws FROM sp), am AS (SELECT conv_id, turn, lw, CASE "
    + " ".join(f"WHEN regexp_matches(low, '{p}') THEN {{'m': regexp_extract(low, '{p}', 0), 'k': regexp_extract(low, '{p}', 1), 'more': {n}}}" for p, n in nlu.AMOUNT_SPANS)
    + " END AS a FROM w), ap AS (SELECT *, greatest(coalesce(list_position(list_transform(lw, lambda x: contains(x, a.k) OR contains(x, replace(a.k, ',', ''))), true), 0) - 1, 0) AS f FROM am WHERE a IS NOT NULL), "
    + "amounts AS (SELECT conv_id, turn, CAST(f AS INTEGER) AS first, CAST(f + a.more AS INTEGER) AS last, a.m AS text, 'amount' AS label FROM ap)"
)
CLEAN_SQL = r"regexp_replace(lower(ws[i]), '[.,/#!$%^&*;:{}=\-_`~()]', '', 'g')"


@query("n_entities", f"""WITH {SPAN_SQL}, it AS (SELECT unnest({list(nlu.ITEM_NAMES)}) AS item), ip AS (SELECT conv_id, turn, item, list_position(list_transform(lw, lambda x: contains(x, item)), true) AS p FROM w JOIN it ON contains(low, item)),
spans AS (SELECT * FROM amounts UNION ALL SELECT conv_id, turn, CAST(p - 1 AS INTEGER), CAST(p - 1 AS INTEGER), item, 'itemName' FROM ip WHERE p > 0),
e AS (SELECT conv_id, turn, CAST(i - 1 AS INTEGER) AS pos, ws[i] AS word, lower(ws[i + 1]) AS nx, {CLEAN_SQL} AS c FROM (SELECT conv_id, turn, ws, unnest(range(1, len(ws) + 1)) AS i FROM w)),
o AS (SELECT conv_id, turn, pos, word, CASE {ENTITY_CASE} END AS label FROM e WHERE NOT EXISTS (SELECT 1 FROM spans s WHERE s.conv_id = e.conv_id AND s.turn = e.turn AND e.pos BETWEEN s.first AND s.last))
SELECT * FROM spans UNION ALL SELECT conv_id, turn, pos, pos, word, label FROM o WHERE label IS NOT NULL""")
def n_entities(spark, d):
    return nlu.entities(spoken(spark, d), "text", "conv_id", "turn")


@query("n_entity_phrases", f"""WITH {SPAN_SQL}, lex AS (SELECT phrase, label, string_split(phrase, ' ') AS pw, row_number() OVER (PARTITION BY phrase ORDER BY r) AS r FROM (VALUES {', '.join(f"({n!r}, '{k}', {r})" for r, (k, ns) in enumerate((('itemName', nlu.ITEM_NAMES), *nlu.ENTITY_WORDS)) for n in ns)}) AS v(phrase, label, r)),
cl AS (SELECT conv_id, turn, list_transform(range(1, len(ws) + 1), lambda i: {CLEAN_SQL}) AS cs FROM w),
c1 AS (SELECT cl.*, i FROM cl, LATERAL (SELECT unnest(range(1, len(cs) + 1)) AS i) WHERE NOT EXISTS (SELECT 1 FROM amounts s WHERE s.conv_id = cl.conv_id AND s.turn = cl.turn AND i - 1 BETWEEN s.first AND s.last)),
hit AS (SELECT conv_id, turn, i - 1 AS first, i + len(pw) - 2 AS last, phrase, label FROM c1 JOIN lex ON lex.r = 1 AND cs[i] = pw[1] AND cs[i:i + len(pw) - 1] = pw
 WHERE NOT EXISTS (SELECT 1 FROM amounts s WHERE s.conv_id = c1.conv_id AND s.turn = c1.turn AND s.first <= i + len(pw) - 2 AND s.last >= i - 1)),
kept AS (SELECT conv_id, turn, unnest(list_reduce(list([[first, last]] ORDER BY first, last DESC), lambda held, x: CASE WHEN x[1][1] > held[len(held)][2] THEN list_concat(held, x) ELSE held END)) AS k FROM hit GROUP BY conv_id, turn)
SELECT * FROM amounts UNION ALL SELECT conv_id, turn, CAST(first AS INTEGER), CAST(last AS INTEGER), phrase, label FROM hit JOIN kept USING (conv_id, turn) WHERE hit.first = k[1] AND hit.last = k[2]""")
def n_entity_phrases(spark, d):
    return nlu.entity_phrases(spoken(spark, d), "text", "conv_id", "turn")


MODEL_VALUES = ", ".join(f"({p}, '{i}', {a}, CAST({x} AS DOUBLE), CAST({s} AS DOUBLE), {b})" for p, (i, a, x, s, b) in enumerate(scoring.ARCHITECTURES))
PRESET_VALUES = ", ".join(f"('{k}', {a}, {x}, {s}, {b})" for k, (a, x, s, b) in scoring.PRESETS.items())


@query("c_model_rank", f"WITH m AS (SELECT * FROM (VALUES {MODEL_VALUES}) AS v(pos, arch, acc, lat, sz, bat)), c AS (SELECT p_partkey AS pos, arch || '-' || p_partkey AS id, acc - p_size % 5 AS acc, lat * ((50 + p_size) / 50) AS lat, sz * ((50 + p_size) / 50) AS sz, bat FROM part JOIN m ON p_partkey % 7 = m.pos), w AS (SELECT * FROM (VALUES {PRESET_VALUES}) AS v(preset, a, l, s, b)), x AS (SELECT preset, id, pos, CAST(floor((acc * a + greatest(0, 100 - lat / 2) * l + greatest(0, 100 - sz * 1.5) * s + (11 - bat) * 10 * b) / (a + l + s + b) + 0.5) AS BIGINT) AS score FROM c, w) SELECT preset, id, score, row_number() OVER (PARTITION BY preset ORDER BY score DESC, pos) AS rank FROM x")
def c_model_rank(spark, d):
    """Every part stands for a model: one of the architectures, larger and slower by the part's size."""
    kinds = F.array(*(F.struct(F.lit(i).alias("arch"), F.lit(float(a)).alias("accuracy"), F.lit(x).alias("latency"), F.lit(s).alias("size"), F.lit(b).alias("battery")) for i, a, x, s, b in scoring.ARCHITECTURES))
    rows = table(spark, d, "part").withColumn("k", F.get(kinds, F.pmod("p_partkey", F.lit(len(scoring.ARCHITECTURES))).cast("int")))
    grown = (50 + F.col("p_size")) / 50
    return scoring.model_scores(rows.select(F.col("p_partkey").alias("pos"), F.concat("k.arch", F.lit("-"), F.col("p_partkey").cast("string")).alias("id"), (F.col("k.accuracy") - F.col("p_size") % 5).alias("accuracy"), (F.col("k.latency") * grown).alias("latency"), (F.col("k.size") * grown).alias("size"), F.col("k.battery").alias("battery")))


@query("c_latency", """WITH g AS (SELECT arch, processor, seq, 8000 AS vocab, 128 AS dim, q AS quantised FROM (VALUES ('cnn'), ('bilstm'), ('transformer')) a(arch), (VALUES ('budget-cpu'), ('mid-gpu'), ('flagship-npu')) p(processor), (VALUES (16), (32)) s(seq), (VALUES (true), (false)) q(q)),
h AS (SELECT *, CAST(vocab * dim AS DOUBLE) AS e, CAST(CASE arch WHEN 'cnn' THEN 3 * dim * dim + 5 * dim * 64 WHEN 'bilstm' THEN 16 * dim * dim ELSE 4 * 11 * dim * dim END AS DOUBLE) AS b, CAST(CASE arch WHEN 'cnn' THEN 2.5 WHEN 'bilstm' THEN 8.0 ELSE 14.0 END AS DOUBLE) AS cx, CAST(CASE processor WHEN 'budget-cpu' THEN 0.08 WHEN 'mid-gpu' THEN 0.65 ELSE 8.2 END AS DOUBLE) AS rate, CAST(CASE processor WHEN 'budget-cpu' THEN 4.5 WHEN 'mid-gpu' THEN 2.2 ELSE 1.1 END AS DOUBLE) AS o,
 CAST(CASE arch || processor WHEN 'bilstmflagship-npu' THEN 3.2 WHEN 'bilstmmid-gpu' THEN 8.5 WHEN 'bilstmbudget-cpu' THEN 16.0 WHEN 'cnnflagship-npu' THEN 1.8 WHEN 'cnnmid-gpu' THEN 4.0 WHEN 'cnnbudget-cpu' THEN 7.2 WHEN 'transformerflagship-npu' THEN 9.5 WHEN 'transformermid-gpu' THEN 18.0 ELSE 68.0 END AS DOUBLE) AS fl FROM g),
i AS (SELECT *, e + b + dim * 48 AS p FROM h), j AS (SELECT *, round(p * CASE WHEN quantised THEN 1 ELSE 4 END / (1024 * 1024), 2) AS size_mb FROM i)
SELECT arch, processor, seq, vocab, dim, quantised, CAST(p AS BIGINT) AS params, size_mb, round(greatest(fl, (seq * b * cx + e * 2) / (rate * 1000000) + o), 1) AS latency_ms, CAST(floor(size_mb * 3.5 + 8.5) AS BIGINT) AS ram_mb FROM j""")
def c_latency(spark, d):
    rows = [(a, p, s, 8000, 128, q) for a in scoring.COMPLEXITY for p in scoring.PROCESSORS for s in (16, 32) for q in (True, False)]
    return scoring.latency(spark.createDataFrame(rows, "arch string, processor string, seq int, vocab int, dim int, quantised boolean"))


@query("c_codegen_labels", "SELECT label, idx FROM (SELECT n_name AS label, row_number() OVER (ORDER BY n_name) - 1 AS idx FROM nation) UNION ALL SELECT 'UNKNOWN', count(*) FROM nation")
def c_codegen_labels(spark, d):
    labels = sequence.label_index(table(spark, d, "nation"), "n_name")
    return labels.unionByName(labels.agg(F.lit("UNKNOWN").alias("label"), F.count(F.lit(1)).alias("idx")))


@query("c_label_append", "WITH o AS (SELECT r_name AS label, CAST(4 - r_regionkey AS BIGINT) AS pos FROM region), n AS (SELECT n_name AS label FROM nation WHERE n_name NOT IN (SELECT label FROM o)), b AS (SELECT label, 0 AS k, pos FROM o UNION ALL SELECT DISTINCT label, 1, NULL FROM n) SELECT label, row_number() OVER (ORDER BY k, pos, label) - 1 AS idx FROM b")
def c_label_append(spark, d):
    old = table(spark, d, "region").select(F.col("r_name").alias("label"), (4 - F.col("r_regionkey")).cast("bigint").alias("idx"))
    return scoring.appended_labels(old, table(spark, d, "nation").select(F.col("n_name").alias("label")))


@query("c_route_map", """SELECT 'export const ROUTES = {' || chr(10) || string_agg('  "' || n_name || '": "' || r_name || '",', chr(10) ORDER BY n_name) AS text FROM nation JOIN region ON n_regionkey = r_regionkey""")
def c_route_map(spark, d):
    pairs = table(spark, d, "nation").join(F.broadcast(table(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    return scoring.route_lines(pairs, "n_name", "r_name", "export const ROUTES = {")


