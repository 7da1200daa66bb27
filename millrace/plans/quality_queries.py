"""Queries over the gate, the audit operators, reports and sampling."""

from __future__ import annotations


from pyspark.sql import functions as F

from ..functions.text import draw, tokens_space
from ..operators import audit, metrics, quality, sequence
from ..sources.io import replace_folder, scratch, small
from ..streaming import resume
from .common import SPECS_SQL, draw_sql, minimum, specs, table, utterances

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


CONFLICT_SQL = """SELECT utterance, CAST(count(*) AS BIGINT) AS n_labels, string_agg(label, ',' ORDER BY label) AS labels
FROM (SELECT DISTINCT lower(utterance) AS utterance, intent || '|' || action AS label FROM u) GROUP BY utterance HAVING count(*) > 1"""


@query("v_gate_conflict", f"WITH {SPECS_SQL} SELECT md5(utterance) AS utterance, n_labels, labels FROM ({CONFLICT_SQL})")
def v_gate_conflict(spark, d):
    return quality.conflicts(utterances(spark, d)).select(F.md5("utterance").alias("utterance"), "n_labels", "labels")


@query("v_gate_unknown", f"WITH {SPECS_SQL} SELECT intent, CAST(count(*) AS BIGINT) AS n FROM u WHERE intent NOT IN (SELECT intent FROM specs) GROUP BY intent")
def v_gate_unknown(spark, d):
    return quality.unknown_intents(utterances(spark, d), specs(spark))


@query("v_gate_combo", f"WITH {SPECS_SQL} SELECT intent, action, CAST(count(*) AS BIGINT) AS n FROM u WHERE NOT EXISTS (SELECT 1 FROM combos c WHERE c.intent = u.intent AND c.action = u.action) GROUP BY intent, action")
def v_gate_combo(spark, d):
    return quality.illegal_combos(utterances(spark, d), quality.valid_combos(specs(spark)))


@query("v_gate_coverage", f"WITH {SPECS_SQL} SELECT intent FROM specs WHERE intent NOT IN (SELECT intent FROM u)")
def v_gate_coverage(spark, d):
    return quality.uncovered_intents(utterances(spark, d), specs(spark))


DIVERSITY_SQL = "SELECT u.intent, action, CAST(count(DISTINCT lower(utterance)) AS BIGINT) AS n, coalesce(any_value(least.least), 0) AS least FROM u LEFT JOIN least ON u.intent = least.intent GROUP BY u.intent, action HAVING count(DISTINCT lower(utterance)) < coalesce(any_value(least.least), 0)"


@query("v_gate_diversity", f"WITH {SPECS_SQL} {DIVERSITY_SQL}")
def v_gate_diversity(spark, d):
    return quality.diversity(utterances(spark, d), minimum(spark))


@query("v_gate_diversity_strict", f"""WITH {SPECS_SQL}, c AS (SELECT combos.intent, combos.action, CAST(count(DISTINCT lower(utterance)) AS BIGINT) AS n FROM combos LEFT JOIN u ON u.intent = combos.intent AND u.action = combos.action GROUP BY ALL)
SELECT c.intent, action, n, least.least AS least FROM c JOIN least ON c.intent = least.intent WHERE n < least.least""")
def v_gate_diversity_strict(spark, d):
    return quality.diversity(utterances(spark, d), minimum(spark), quality.valid_combos(specs(spark)))


@query("v_gate_report", f"""WITH {SPECS_SQL}, c AS ({CONFLICT_SQL}), f AS (SELECT * FROM c ORDER BY utterance LIMIT 5), t AS (SELECT count(*) AS n FROM c), dv AS ({DIVERSITY_SQL})
SELECT 'coverage' AS "check", 'no rows: ' || intent AS message FROM specs WHERE intent NOT IN (SELECT intent FROM u)
UNION SELECT 'unknown', 'not declared: ' || intent FROM u WHERE intent NOT IN (SELECT intent FROM specs)
UNION SELECT 'combination', 'not supported: ' || intent || '|' || action FROM u WHERE NOT EXISTS (SELECT 1 FROM combos c WHERE c.intent = u.intent AND c.action = u.action)
UNION SELECT 'conflict', 'conflict: ' || md5(utterance) || ' -> ' || labels FROM f
UNION SELECT 'conflict', 'and ' || (n - 5) || ' more of ' || n FROM t WHERE n > 5
UNION SELECT 'diversity', 'too few: ' || intent || '|' || action || ' ' || n || ' of ' || least FROM dv""")
def v_gate_report(spark, d):
    s = specs(spark)
    return quality.report(utterances(spark, d), s, quality.valid_combos(s), minimum(spark))


@query("g_valid_combos", "SELECT DISTINCT lang AS intent, source AS action FROM documents WHERE lang IS NOT NULL AND source IS NOT NULL")
def g_valid_combos(spark, d):
    found = table(spark, d, "documents").where("lang is not null and source is not null").groupBy(F.col("lang").alias("intent")).agg(F.collect_set("source").alias("supported_actions"))
    return quality.valid_combos(found)


@query("v_authoring", "WITH s AS (SELECT DISTINCT lang AS intent, source AS action FROM documents WHERE doc_id % 3 <> 0 AND lang IS NOT NULL AND source IS NOT NULL), p AS (SELECT DISTINCT lang AS intent, source AS action FROM documents WHERE doc_id % 7 < 5 AND lang IS NOT NULL AND source IS NOT NULL), f AS (SELECT s.*, 'no patterns' AS fault FROM s ANTI JOIN p USING (intent, action) UNION ALL SELECT p.*, 'not supported' FROM p ANTI JOIN s USING (intent, action)) SELECT * FROM f")
def v_authoring(spark, d):
    """Specs made of the documents' labels: each part of the documents names its own actions and patterns."""
    rows = table(spark, d, "documents").where("lang is not null and source is not null")
    actions = rows.where("doc_id % 3 <> 0").groupBy(F.col("lang").alias("intent")).agg(F.collect_set("source").alias("supported_actions"))
    patterns = rows.where("doc_id % 7 < 5").groupBy(F.col("lang").alias("intent")).agg(F.map_from_entries(F.transform(F.collect_set("source"), lambda x: F.struct(x, F.array(F.lit("say it"))))).alias("utterance_patterns"))
    return quality.authoring_faults(actions.join(patterns, "intent", "full_outer").select("intent", F.coalesce("supported_actions", F.array().cast("array<string>")).alias("supported_actions"), "utterance_patterns"))


@query("v_misaligned", r"SELECT conv_id, turn FROM conversations WHERE turn % 3 = 0 AND len(list_filter(string_split_regex(translate(lower(text), '.,?!', '    '), '\s+'), lambda x: x <> '')) > 0")
def v_misaligned(spark, d):
    tokens = tokens_space(F.col("text"))
    rows = table(spark, d, "conversations").select("conv_id", "turn", tokens.alias("tokens")).withColumn("tags", F.transform(F.when(F.col("turn") % 3 == 0, F.slice("tokens", F.lit(2), F.size("tokens"))).otherwise(F.col("tokens")), lambda t: F.lit("O")))
    return quality.misaligned(rows).select("conv_id", "turn")


CLEAN_SQL = f"WITH {SPECS_SQL}, k AS (SELECT * FROM u WHERE intent IS NOT NULL AND action IS NOT NULL AND utterance IS NOT NULL), c AS (SELECT lower(utterance) AS x FROM k GROUP BY lower(utterance) HAVING count(DISTINCT intent || '|' || action) > 1) SELECT doc_id, intent, action FROM k WHERE lower(utterance) NOT IN (SELECT x FROM c)"


@query("v_gate_publish", CLEAN_SQL)
def v_gate_publish(spark, d):
    """What a table holds after rows without faults were published to it and rows with one were refused."""
    rows = utterances(spark, d).where("intent is not null and action is not null and utterance is not null").withColumn("__u", quality.digest("utterance"))
    # Both tables are asked for again and again below.
    clashing, labels = scratch(spark, "clashing"), scratch(spark, "declared")
    quality.clashes(rows).select(F.col("digest").alias("__u")).write.parquet(clashing)
    rows = rows.join(small(spark.read.schema("__u binary").parquet(clashing)), "__u", "left_anti").drop("__u")
    declared = rows.groupBy("intent").agg(F.collect_set("action").alias("supported_actions"))
    declared.write.parquet(labels)
    declared = spark.read.schema(declared.schema).parquet(labels)
    path, combos, least = scratch(spark, "published"), quality.valid_combos(declared), declared.select("intent", F.lit(1).alias("least"))
    first = quality.publish(rows, declared, combos, least, path)
    bad = rows.limit(1).withColumn("intent", F.lit("nobody declared this"))
    second = quality.publish(rows.unionByName(bad), declared, combos, least, path)
    for done in (clashing, labels):
        replace_folder(spark, done, None)
    if any(first.values()) or not any(second.values()):
        raise ValueError(f"the gate found {first}, then {second}")
    return spark.read.schema(rows.schema).parquet(path).select("doc_id", "intent", "action")


def verdicts(spark, d):
    """Verdicts of labelled documents; every fifth one has an older verdict that the last one overrides."""
    rows = table(spark, d, "labels").where("doc_id is not null").withColumn("id", F.col("doc_id"))
    k = F.col("id")
    last = rows.select(
        "id", F.lit(2).alias("pos"), F.when(F.col("toxic") == 1, "DELETE").otherwise("KEEP").alias("suitability"), F.when(F.col("quality") == 0, "WRONG_TAGS").when(k % 11 == 0, None).otherwise("PERFECT").alias("entity_status"),
        F.when(k % 7 == 0, "LOW").otherwise("HIGH").alias("quality"), F.when(k % 3 == 0, "en").otherwise("").alias("suggested_intent"), F.when(k % 4 == 0, "src1").alias("suggested_task"), F.lit("why").alias("reason"), F.lit("new text").alias("rewrite"),
    )
    old = last.where(k % 5 == 0).withColumns({"pos": F.lit(1), "suitability": F.lit("DELETE")})
    return last.unionByName(old)


ROUTE_SQL = """v AS (SELECT doc_id AS id, CASE WHEN toxic = 1 THEN 'DELETE' ELSE 'KEEP' END AS suitability, CASE WHEN quality = 0 THEN 'WRONG_TAGS' WHEN doc_id % 11 = 0 THEN NULL ELSE 'PERFECT' END AS entity_status,
 CASE WHEN doc_id % 7 = 0 THEN 'LOW' ELSE 'HIGH' END AS q, CASE WHEN doc_id % 3 = 0 THEN 'en' END AS si, CASE WHEN doc_id % 4 = 0 THEN 'src1' END AS st FROM labels),
j AS (SELECT d.doc_id AS id, lang AS i0, source AS t0, v.id IS NOT NULL AS audited, coalesce(suitability = 'DELETE', false) AS gone, coalesce(entity_status <> 'PERFECT', false) OR coalesce(q = 'LOW', false) AS man, coalesce(q = 'LOW', false) AS low,
 coalesce(si, lang) AS i1, coalesce(st, source) AS t1 FROM documents d LEFT JOIN v ON d.doc_id = v.id),
r AS (SELECT id, CASE WHEN audited AND NOT gone THEN i1 ELSE i0 END AS intent, CASE WHEN audited AND NOT gone THEN t1 ELSE t0 END AS task, CASE WHEN gone THEN 'dropped' WHEN audited AND man THEN 'manual' ELSE 'clean' END AS route,
 CASE WHEN NOT audited THEN 'unaudited' WHEN gone THEN 'dropped' WHEN man THEN 'manual_review' WHEN i1 <> i0 OR t1 <> t0 THEN 'auto_fixed' ELSE 'perfect' END AS outcome,
 CASE WHEN audited AND NOT gone AND man THEN 'why' END AS audit_reason, CASE WHEN audited AND NOT gone AND man AND low THEN 'new text' END AS suggested_rewrite FROM j)"""


def routed(spark, d):
    rows = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("intent"), F.col("source").alias("task"))
    return audit.route(rows, verdicts(spark, d))


@query("r_autofix_route", f"WITH {ROUTE_SQL} SELECT * FROM r")
def r_autofix_route(spark, d):
    return routed(spark, d)


@query("r_autofix_stats", f"WITH {ROUTE_SQL} SELECT outcome, CAST(count(*) AS BIGINT) AS n FROM r GROUP BY outcome")
def r_autofix_stats(spark, d):
    return audit.outcomes(routed(spark, d))


@query("r_template_audit", """SELECT p_partkey AS template_id, CASE WHEN p_partkey % 3 = 1 AND p_partkey % 9 <> 4 THEN 'new ' || p_type ELSE p_name END AS template FROM part
WHERE p_partkey % 5 = 0 OR NOT (p_partkey % 3 = 2 OR (p_partkey % 3 = 1 AND p_partkey % 9 = 4)) ORDER BY 1""".replace("CASE WHEN p_partkey % 3 = 1", "CASE WHEN p_partkey % 5 <> 0 AND p_partkey % 3 = 1"))
def r_template_audit(spark, d):
    part = table(spark, d, "part")
    k = F.col("p_partkey")
    given = part.where(k % 5 != 0).select(k.alias("template_id"), F.lit(1).alias("pos"), F.when(k % 3 == 0, "KEEP").when(k % 3 == 1, "MODIFY").otherwise("DELETE").alias("action"), F.when(k % 9 == 4, F.lit("")).otherwise(F.concat(F.lit("new "), "p_type")).alias("rewrite"))
    return audit.audit_templates(part.select(k.alias("template_id"), F.col("p_name").alias("template")), given)


@query("p_flatten_audit", """SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN quality = 1 THEN 'CORRECT' ELSE 'WRONG' END AS intent_status, '' AS intent_suggested, '' AS intent_reason, CASE WHEN toxic = 1 THEN 'WRONG' ELSE '' END AS task_status, '' AS task_suggested, '' AS task_reason,
 'PERFECT' AS entity_status, '' AS entity_reason, 'HIGH' AS utterance_quality, CASE WHEN quality = 0 THEN 'short | odd' ELSE '' END AS utterance_issues, '' AS utterance_rewrite, 'KEEP' AS suitability, '' AS severity, '' AS overall_reason FROM labels""")
def p_flatten_audit(spark, d):
    none = lambda *names: [F.lit(None).cast("string").alias(n) for n in names]
    nested = table(spark, d, "labels").select(
        F.col("doc_id").alias("id"), F.struct(F.when(F.col("quality") == 1, "CORRECT").otherwise("WRONG").alias("status"), *none("suggestedIntent", "reason")).alias("intentEval"),
        F.struct(F.when(F.col("toxic") == 1, "WRONG").alias("status"), *none("suggestedTaskType", "reason")).alias("taskTypeEval"), F.struct(F.lit("PERFECT").alias("status"), *none("reason")).alias("entityEval"),
        F.struct(F.lit("HIGH").alias("quality"), F.when(F.col("quality") == 0, F.array(F.lit("short"), F.lit("odd"))).alias("issues"), *none("suggestedRewrite")).alias("utteranceEval"), F.lit("KEEP").alias("suitability"), *none("severity", "overallReason"),
    )
    return audit.flatten(nested)


@query("p_facet_filter", "SELECT doc_id, lang, source FROM documents WHERE lang = 'en' AND (contains(lower(text), 'thth') OR contains(lower(lang), 'thth'))")
def p_facet_filter(spark, d):
    return audit_facet(table(spark, d, "documents"), "en", None, "THTH").select("doc_id", "lang", "source")


def audit_facet(rows, intent, split, term):
    """Rows of an intent and a split (None: all) whose text or intent holds the term, whatever its case."""
    has = F.contains(F.lower("text"), F.lit(term.lower())) | F.contains(F.lower("lang"), F.lit(term.lower()))
    for column, value in (("lang", intent), ("source", split)):
        has = has & (F.lit(True) if value is None else F.col(column) == value)
    return rows.where(has)


@query("p_remap", "SELECT doc_id AS id, lang AS intent, source AS taskType, md5(text) AS digest, CASE WHEN n_chars % 2 = 0 THEN 1 ELSE 0 END AS n_entities, CASE WHEN n_chars % 2 = 0 THEN 0 END AS first_start, CASE WHEN n_chars % 2 = 0 THEN CAST(n_chars AS INTEGER) END AS first_end FROM documents")
def p_remap(spark, d):
    """Documents as span samples, renamed and with their ranges unfolded; every second one has no entities."""
    entity = F.array(F.struct(F.lit("all").alias("text"), F.lit("DOC").alias("label"), F.array(F.lit(0), F.col("n_chars").cast("int")).alias("range"), F.array(F.lit("B-DOC")).alias("iob")))
    samples = table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.col("lang").alias("intent"), F.col("source").alias("subIntent"), F.col("text").alias("utterance"), F.when(F.col("n_chars") % 2 == 0, entity).alias("entities_token_iob"))
    first = F.get("entities", 0)
    return sequence.remapped_samples(samples).select("id", "intent", "taskType", F.md5("text").alias("digest"), F.size("entities").alias("n_entities"), first["start"].alias("first_start"), first["end"].alias("first_end"))


@query("p_target", "SELECT doc_id, lang FROM documents WHERE lang = 'de'")
def p_target(spark, d):
    return table(spark, d, "documents").where("lang = 'de'").select("doc_id", "lang")


@query("p_composite", "SELECT lang || '|' || source AS key, lang AS intent, source AS action, CAST(count(*) AS BIGINT) AS n FROM documents GROUP BY lang, source")
def p_composite(spark, d):
    """Counts by a composite key, which is then taken apart again."""
    rows = utterances(spark, d).groupBy(quality.combo_key().alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return rows.select("key", quality.combo_parts(F.col("key")).alias("p"), "n").select("key", "p.intent", "p.action", "n")


@query("f_defaults", "SELECT d.doc_id, upper(coalesce(lang, 'none')) AS lang, coalesce(l.quality, 0) AS quality, trim(lower(substr(coalesce(text, ''), 1, 3))) AS beginning FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id")
def f_defaults(spark, d):
    """Missing values by default, and access into what may be missing."""
    verdict = table(spark, d, "labels").select("doc_id", F.struct("quality").alias("verdict"))
    rows = table(spark, d, "documents").join(verdict, "doc_id", "left")
    text = F.coalesce("text", F.lit(""))
    return rows.select("doc_id", F.upper(F.coalesce("lang", F.lit("none"))).alias("lang"), F.coalesce("verdict.quality", F.lit(0)).alias("quality"), F.trim(F.lower(F.substring(text, 1, 3))).alias("beginning"))


@query("e_windows", "SELECT date_trunc('day', CAST(ts AS TIMESTAMP)) AS start, event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY 1, 2")
def e_windows(spark, d):
    return resume.event_counts(table(spark, d, "events"))


@query("e_resume", "SELECT p_partkey AS id, p_partkey % 2 AS run, p_size > 25 AS large FROM part")
def e_resume(spark, d):
    """Two runs over a folder that grows between them; each judges what is new to it."""
    rows, folder = table(spark, d, "part").select(F.col("p_partkey").alias("id"), "p_size"), scratch(spark, "resume")
    for run in (0, 1):
        rows.where(F.col("id") % 2 == run).write.mode("append").json(f"{folder}/in")
        judge = lambda batch, k=run: batch.select("id", F.lit(k).cast("bigint").alias("run"), (F.col("p_size") > 25).alias("large"))
        resume.run_available(spark, f"{folder}/in", "id bigint, p_size int", judge, f"{folder}/out", f"{folder}/state", files_per_batch=100)
    return spark.read.schema("id bigint, run bigint, large boolean").json(f"{folder}/out").select("id", "run", "large")


@query("p_seq_ids", "SELECT doc_id, 'v4_' || (row_number() OVER (ORDER BY doc_id) - 1) AS id, upper(substr(lang, 1, 3)) || '_' || row_number() OVER (ORDER BY doc_id) AS short_id FROM documents")
def p_seq_ids(spark, d):
    rows = audit.numbered(table(spark, d, "documents").select("doc_id", "lang"), "doc_id")
    return rows.select("doc_id", F.concat(F.lit("v4_"), (F.col("rn") - 1).cast("string")).alias("id"), F.concat(F.upper(F.substring("lang", 1, 3)), F.lit("_"), F.col("rn").cast("string")).alias("short_id"))


@query("p_backend_action", "SELECT doc_id, upper(lang) || '_' || upper(source) AS backend_action FROM documents")
def p_backend_action(spark, d):
    return table(spark, d, "documents").select("doc_id", F.concat_ws("_", F.upper("lang"), F.upper("source")).alias("backend_action"))


@query("w_page", "SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 10 OFFSET 20")
def w_page(spark, d):
    return table(spark, d, "documents").select("doc_id", "lang").orderBy("doc_id").offset(20).limit(10)


@query("w_skip_limit", "SELECT doc_id, rn FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn FROM documents) WHERE rn > 100 AND rn <= 300")
def w_skip_limit(spark, d):
    return audit.numbered(table(spark, d, "documents").select("doc_id"), "doc_id").where("rn > 100 and rn <= 300")


@query("w_batches", "SELECT CAST((rn - 1) // 50 + 1 AS BIGINT) AS batch, CAST(count(*) AS BIGINT) AS n, min(doc_id) AS first_key, max(doc_id) AS last_key FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn FROM documents) GROUP BY 1")
def w_batches(spark, d):
    return audit.batches(audit.numbered(table(spark, d, "documents").select("doc_id"), "doc_id"), "doc_id")


@query("w_resume", "WITH n AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn FROM documents) SELECT 1 AS run, (rn - 21) // 50 + 20 // 50 + 1 AS batch, doc_id FROM n WHERE rn > 20 AND rn <= 150 UNION ALL SELECT 2, (rn - 151) // 50 + 150 // 50 + 1, doc_id FROM n WHERE rn > 150")
def w_resume(spark, d):
    """Two runs: the first takes 130 rows behind the first 20, the second finds its place from their number and takes the rest."""
    rows, path, done = audit.numbered(table(spark, d, "documents").select("doc_id"), "doc_id"), scratch(spark, "progress"), 0
    for run, most in ((1, 130), (2, 0)):
        audit.resumed_batches(rows, done, start=20, most=most).select(F.lit(run).alias("run"), "batch", "doc_id").write.mode("append").parquet(path)
        done = spark.read.parquet(path).count()
    return spark.read.parquet(path).select("run", "batch", "doc_id")


@query("w_head_n", "SELECT lang, CAST(count(*) AS BIGINT) AS n FROM (SELECT lang, row_number() OVER (ORDER BY doc_id) AS rn FROM documents) WHERE rn <= (SELECT count(*) FROM labels) GROUP BY lang")
def w_head_n(spark, d):
    audited = table(spark, d, "labels").agg(F.count(F.lit(1)).alias("audited"))
    return audit.numbered(table(spark, d, "documents").select("doc_id", "lang"), "doc_id").join(F.broadcast(audited), F.col("rn") <= F.col("audited")).groupBy("lang").agg(F.count(F.lit(1)).alias("n"))


@query("a_histogram", "SELECT event_type, CAST(count(*) AS BIGINT) AS n FROM events GROUP BY event_type")
def a_histogram(spark, d):
    return table(spark, d, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("a_closed_hist", " UNION ALL ".join(f"SELECT 'event_type' AS field, '{v}' AS value, CAST(count(*) FILTER (event_type = '{v}') AS BIGINT) AS n FROM events" for v in ("click", "view", "never", "purchase")))
def a_closed_hist(spark, d):
    return audit.closed_histogram(table(spark, d, "events"), {"event_type": ["click", "view", "never", "purchase"]})


@query("a_first_k", "SELECT event_id, value FROM events WHERE event_type = 'error' ORDER BY event_id LIMIT 20")
def a_first_k(spark, d):
    return metrics.first_k(table(spark, d, "events").where("event_type = 'error'"), 20, "event_id").select("event_id", "value")


@query("a_avg_tokens", r"SELECT round(sum(len(string_split_regex(text, '\s+'))) / count(*), 6) AS avg_tokens, CAST(count(*) AS BIGINT) AS n FROM conversations WHERE text IS NOT NULL")
def a_avg_tokens(spark, d):
    rows = table(spark, d, "conversations").where("text is not null")
    n = F.count(F.lit(1))
    return rows.agg(F.round(F.try_divide(F.sum(F.coalesce(F.size(F.split("text", r"\s+")), F.lit(0))), n), 6).alias("avg_tokens"), n.alias("n"))


@query("a_dual_engine", """WITH p AS (SELECT a.event_id, a.event_type AS ea, b.event_type AS eb, a.value AS va, b.value AS vb, CAST(json_extract(a.props, '$.k') AS INTEGER) AS ka, CAST(json_extract(b.props, '$.k') AS INTEGER) AS kb FROM events a JOIN events b ON b.event_id = a.event_id + 1),
q AS (SELECT *, ea = 'error' AS bad, CASE WHEN ka % 4 = 0 THEN NULL ELSE va END AS la, CASE WHEN ka > 90 THEN 'UNKNOWN' ELSE ea END AS ia, CASE WHEN kb > 90 THEN 'UNKNOWN' ELSE eb END AS ib FROM p)
SELECT CAST(count(*) AS BIGINT) AS n_total, CAST(count(*) FILTER (bad) AS BIGINT) AS n_error, CAST(count(*) FILTER (NOT bad) AS BIGINT) AS n_valid,
 round(sum(coalesce(la, 0)) FILTER (NOT bad) / count(*) FILTER (NOT bad), 6) AS a_latency, round(sum(vb) FILTER (NOT bad) / count(*) FILTER (NOT bad), 6) AS b_latency, round(sum(ka) FILTER (NOT bad) / count(*) FILTER (NOT bad), 6) AS a_confidence, round(sum(kb) FILTER (NOT bad) / count(*) FILTER (NOT bad), 6) AS b_confidence,
 CAST(count(*) FILTER (NOT bad AND ia = 'UNKNOWN') AS BIGINT) AS a_unknown, CAST(count(*) FILTER (NOT bad AND ib = 'UNKNOWN') AS BIGINT) AS b_unknown, CAST(count(*) FILTER (NOT bad AND la IS NOT NULL) AS BIGINT) AS n_amount, CAST(count(*) FILTER (NOT bad AND ka % 3 <> 0) AS BIGINT) AS n_merchant,
 round(count(*) FILTER (NOT bad AND ia = ib) / count(*) FILTER (NOT bad), 6) AS agreement FROM q""")
def a_dual_engine(spark, d):
    events = table(spark, d, "events").select("event_id", "event_type", "value", F.get_json_object("props", "$.k").cast("int").alias("k"))
    other = events.select((F.col("event_id") - 1).alias("event_id"), F.col("event_type").alias("e2"), F.col("value").alias("v2"), F.col("k").alias("k2"))
    both = events.join(other, "event_id")
    latency = F.when(F.col("k") % 4 != 0, F.col("value"))
    rows = both.select(
        F.when(F.col("event_type") == "error", "failed").alias("error"), latency.alias("a_latency"), F.col("k").alias("a_confidence"), F.when(F.col("k") > 90, "UNKNOWN").otherwise(F.col("event_type")).alias("a_intent"), F.col("v2").alias("b_latency"), F.col("k2").alias("b_confidence"),
        F.when(F.col("k2") > 90, "UNKNOWN").otherwise(F.col("e2")).alias("b_intent"), latency.alias("amount"), F.when(F.col("k") % 3 == 0, "").otherwise("m").alias("merchant"),
    )
    found = metrics.engine_comparison(rows)
    return found.select(*(F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in found.dtypes))


SPLIT_SQL = f"SELECT doc_id, CASE WHEN {draw_sql(chr(39) + 'split' + chr(39), 'doc_id')} < 0.8 THEN 'train' WHEN {draw_sql(chr(39) + 'split' + chr(39), 'doc_id')} < 0.9 THEN 'val' ELSE 'test' END AS split FROM documents"


def split_of(key):
    u = draw("split", key)
    return F.when(u < 0.8, "train").when(u < 0.9, "val").otherwise("test")


@query("d_split", f"SELECT split, CAST(count(*) AS BIGINT) AS n FROM ({SPLIT_SQL}) GROUP BY split")
def d_split(spark, d):
    return table(spark, d, "documents").select(split_of(F.col("doc_id")).alias("split")).groupBy("split").agg(F.count(F.lit(1)).alias("n"))


@query("d_split_pos", "SELECT doc_id, CASE WHEN rn <= floor(n * 0.8) THEN 'train' WHEN rn <= floor(n * 0.9) THEN 'val' ELSE 'test' END AS split FROM (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn, count(*) OVER () AS n FROM documents)")
def d_split_pos(spark, d):
    docs = table(spark, d, "documents").select("doc_id")
    total = docs.agg(F.count(F.lit(1)).alias("n"))
    rows = audit.numbered(docs, "doc_id").join(F.broadcast(total))
    return rows.select("doc_id", F.when(F.col("rn") <= F.floor(F.col("n") * 0.8), "train").when(F.col("rn") <= F.floor(F.col("n") * 0.9), "val").otherwise("test").alias("split"))


@query("d_shuffle", "SELECT doc_id, row_number() OVER (ORDER BY md5('7|' || doc_id), doc_id) AS place FROM documents")
def d_shuffle(spark, d):
    rows = table(spark, d, "documents").select("doc_id", F.md5(F.concat_ws("|", F.lit("7"), F.col("doc_id").cast("string"))).alias("h"))
    return audit.numbered(rows, "h", "doc_id").select("doc_id", F.col("rn").alias("place"))


@query("d_sample", f"WITH n AS (SELECT count(*) AS n FROM documents), k AS (SELECT i, CAST(floor({draw_sql(chr(39) + 'sample' + chr(39), 'i')} * n) AS BIGINT) + 1 AS rn FROM range(20) r(i), n), d AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn FROM documents) SELECT i AS draw, doc_id FROM k JOIN d USING (rn)")
def d_sample(spark, d):
    docs = table(spark, d, "documents").select("doc_id")
    total = docs.agg(F.count(F.lit(1)).alias("n"))
    draws = spark.range(20).join(F.broadcast(total)).select(F.col("id").alias("draw"), (F.floor(draw("sample", F.col("id")) * F.col("n")) + 1).cast("bigint").alias("rn"))
    return audit.numbered(docs, "doc_id").join(F.broadcast(draws), "rn").select("draw", "doc_id")


@query("d_export_meta", "SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS place, count(*) OVER (PARTITION BY lang) AS total FROM documents")
def d_export_meta(spark, d):
    """The rows of an export, each with its place and the envelope's total of its part."""
    rows = audit.numbered(table(spark, d, "documents").select("lang", "doc_id"), "lang", "doc_id")
    totals = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("total"), F.min("rn").alias("first"))
    totals = totals.withColumnRenamed("lang", "of")
    return rows.join(small(totals), F.col("lang").eqNullSafe(F.col("of"))).select("lang", "doc_id", (F.col("rn") - F.col("first") + 1).alias("place"), "total")


@query("d_run_meta", "SELECT '2.0.0' AS version, true AS has_time, count(*) AS total FROM documents")
def d_run_meta(spark, d):
    made = metrics.run_metadata(table(spark, d, "documents"), "2.0.0")
    return made.select("version", F.col("generated_at").rlike(r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d\.\d{3}Z$").alias("has_time"), "total")


@query("r_provider", "SELECT CAST(doc_id AS VARCHAR) AS id, CASE WHEN doc_id % 2 = 0 THEN 'KEEP' END AS suitability, CASE WHEN doc_id % 2 = 1 THEN 'unknown provider: nowhere' END AS error FROM documents")
def r_provider(spark, d):
    ids = table(spark, d, "documents").select(F.col("doc_id").alias("id"))
    judged = audit.judge_with(ids.where("id % 2 = 0"), "offline").unionByName(audit.judge_with(ids.where("id % 2 = 1"), "nowhere"))
    return judged.select("id", "suitability", "error")


ROTATION = {"a": 2, "b": 3, "c": 5}  # a stand-in fails for batches whose first identifier its number divides
ROTATION_SQL = """n AS (SELECT doc_id, (row_number() OVER (ORDER BY doc_id) - 1) // 50 + 1 AS batch FROM documents), b AS (SELECT batch, min(doc_id) AS f FROM n GROUP BY batch),
t AS (SELECT batch, f, list_transform(range(3), lambda k: CAST((batch - 1 + k) % 3 AS INTEGER)) AS ms FROM b),
o AS (SELECT batch, list_transform(ms, lambda m: ['a', 'b', 'c'][m + 1]) AS names, coalesce(list_position(list_transform(ms, lambda m: f % [2, 3, 5][m + 1] <> 0), true), 0) AS hit FROM t),
r AS (SELECT batch, CASE WHEN hit > 0 THEN names[hit] END AS model, CASE WHEN hit > 0 THEN names[1:hit - 1] ELSE names END AS tried FROM o)"""


def rotated(spark, d):
    rows = audit.numbered(table(spark, d, "documents").select(F.col("doc_id").alias("id")), "id")
    return audit.judge_rotating(audit.resumed_batches(rows, 0).select("batch", "id"), {m: audit.FailingProvider(by) for m, by in ROTATION.items()}, wait=0.0)


@query("r_rotation", f"WITH {ROTATION_SQL} SELECT CAST(batch AS BIGINT) AS batch, CAST(doc_id AS VARCHAR) AS id, model, array_to_string(tried, ',') AS tried, CASE WHEN model IS NOT NULL THEN 'KEEP' END AS suitability, CASE WHEN model IS NULL THEN 'max retries exceeded' END AS error FROM n JOIN r USING (batch)")
def r_rotation(spark, d):
    return rotated(spark, d).select("batch", "id", "model", F.array_join("tried", ",").alias("tried"), "suitability", "error")


@query("r_model_shares", f"WITH {ROTATION_SQL}, j AS (SELECT model, count(*) AS n FROM n JOIN r USING (batch) GROUP BY model), f AS (SELECT m, count(*) AS n FROM (SELECT unnest(tried) AS m FROM r) GROUP BY m) SELECT coalesce(model, m) AS model, coalesce(j.n, 0) AS n_judged, coalesce(f.n, 0) AS n_failed FROM j FULL OUTER JOIN f ON model = m")
def r_model_shares(spark, d):
    return audit.model_shares(rotated(spark, d))


@query("d_quota", "SELECT p_brand, least(count(DISTINCT p_name), 12) AS n, least(count(DISTINCT p_name), 12) AS places FROM part GROUP BY p_brand")
def d_quota(spark, d):
    """Names by brand within a quota of 12, which two runs over a growing folder fill together."""
    rows, folder = table(spark, d, "part").select("p_brand", "p_name", "p_partkey"), scratch(spark, "quota")
    for part in ("p_partkey % 11 = 0", "p_partkey % 11 <> 0"):
        rows.where(part).select("p_brand", "p_name").write.mode("append").json(f"{folder}/in")
        resume.fill_quotas(spark, f"{folder}/in", "p_brand string, p_name string", 12, ["p_brand"], "p_name", f"{folder}/out", f"{folder}/state")
    held = spark.read.schema("p_brand string, p_name string, place bigint").parquet(f"{folder}/out")
    return held.groupBy("p_brand").agg(F.count_distinct("p_name").alias("n"), F.count_distinct("place").alias("places"))


@query("u_union", "SELECT n_name AS name, 'nation' AS kind FROM nation UNION ALL SELECT r_name, 'region' FROM region")
def u_union(spark, d):
    return table(spark, d, "nation").select(F.col("n_name").alias("name"), F.lit("nation").alias("kind")).unionByName(table(spark, d, "region").select(F.col("r_name").alias("name"), F.lit("region").alias("kind")))


@query("u_except", "SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_quantity > 45 EXCEPT SELECT p_partkey FROM part WHERE p_size < 25")
def u_except(spark, d):
    big = table(spark, d, "lineitem").where("l_quantity > 45").select(F.col("l_partkey").alias("k")).distinct()
    return big.join(table(spark, d, "part").where("p_size < 25").select(F.col("p_partkey").alias("k")), "k", "left_anti")


@query("u_distinct", "SELECT DISTINCT lang, source FROM documents")
def u_distinct(spark, d):
    return table(spark, d, "documents").select("lang", "source").distinct()


# Canonical names and their aliases; one alias stands under two names.
ALIASES = {"Groceries": ["ring", "widget"], "Tools": ["bolt", "gear", "ring"], "Other": ["misc"]}


@query("j_alias", "WITH a AS (SELECT * FROM (VALUES " + ", ".join(f"('{c}', '{x}')" for c, xs in ALIASES.items() for x in xs) + ") AS v(canonical, alias)) SELECT p_partkey, canonical, alias FROM part JOIN a ON string_split(p_name, ' ')[2] = alias")
def j_alias(spark, d):
    aliases = spark.createDataFrame([(ALIASES,)], "m map<string,array<string>>").select(F.explode("m").alias("canonical", "aliases")).select("canonical", F.explode("aliases").alias("alias"))
    return table(spark, d, "part").select("p_partkey", F.try_element_at(F.split("p_name", " "), F.lit(2)).alias("alias")).join(F.broadcast(aliases), "alias").select("p_partkey", "canonical", "alias")


@query("s_json_props", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k, event_id % 10 = 3 AS bad FROM (SELECT event_id, CASE WHEN event_id % 10 = 3 THEN NULL ELSE props END AS props FROM events)")
def s_json_props(spark, d):
    text = F.when(F.col("event_id") % 10 == 3, F.concat(F.lit("{broken "), "props")).otherwise(F.col("props"))
    parsed = F.from_json(text, "k int, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"})
    rows = table(spark, d, "events").select("event_id", parsed.alias("p"))
    return rows.select("event_id", F.col("p.k").alias("k"), F.col("p._bad").isNotNull().alias("bad"))


@query("s_jsonl_roundtrip", "SELECT event_id, event_type, value FROM events")
def s_jsonl_roundtrip(spark, d):
    from ..sources import io

    rows = table(spark, d, "events").select("event_id", "event_type", "value")
    path = io.scratch(spark, "jsonl")
    io.write_jsonl(rows, path)
    return io.read_jsonl_strict(spark, path, rows.schema)




@query("s_document_unwrap", "SELECT n_nationkey, n_name FROM nation")
def s_document_unwrap(spark, d):
    """A JSON document written with its records under `samples`, and read back by unwrapping it."""
    from ..sources import io

    rows = table(spark, d, "nation").select("n_nationkey", "n_name")
    path = io.scratch(spark, "document")
    io.write_document(rows.agg(F.collect_list(F.struct("*")).alias("samples")), path)
    return io.read_document(spark, path).select(F.col("n_nationkey").cast(rows.schema["n_nationkey"].dataType).alias("n_nationkey"), "n_name")


@query("s_append", "SELECT r_regionkey, r_name FROM region UNION ALL SELECT r_regionkey, r_name FROM region WHERE r_regionkey > 2")
def s_append(spark, d):
    from ..sources import io

    rows = table(spark, d, "region").select("r_regionkey", "r_name")
    path = io.scratch(spark, "append")
    io.write_jsonl(rows, path)
    io.write_jsonl(rows.where("r_regionkey > 2"), path, mode="append")
    return io.read_jsonl_strict(spark, path, rows.schema)


@query("s_routes", "SELECT r_regionkey, r_name, CASE WHEN r_regionkey > 2 THEN 'manual' ELSE 'clean' END AS route FROM region")
def s_routes(spark, d):
    """One folder per route, read back by its name."""
    from ..sources import io

    rows = table(spark, d, "region").select("r_regionkey", "r_name").withColumn("route", F.when(F.col("r_regionkey") > 2, "manual").otherwise("clean"))
    path = f"{io.scratch(spark, 'routes')}/{io.result_names('regions.jsonl')['clean.jsonl']}"
    io.write_routes(rows, path)
    back = [io.read_jsonl_strict(spark, f"{path}/route={x}", rows.drop("route").schema).withColumn("route", F.lit(x)) for x in ("clean", "manual")]
    return back[0].unionByName(back[1])


@query("s_specs", "SELECT r_name AS intent, n_name AS action FROM nation JOIN region ON n_regionkey = r_regionkey")
def s_specs(spark, d):
    """A folder with one spec file per region, other files beside them, read as a table."""
    from ..sources import io

    folder = io.scratch(spark, "specs")
    for k in range(5):
        spec = table(spark, d, "region").where(F.col("r_regionkey") == k).select("r_regionkey", F.col("r_name").alias("intent"))
        actions = table(spark, d, "nation").where(F.col("n_regionkey") == k).agg(F.array_sort(F.collect_list("n_name")).alias("supported_actions"))
        io.write_document(spec.join(actions).select("intent", "supported_actions"), f"{folder}/region{k}.intent.json")
    io.write_document(table(spark, d, "region").limit(1), f"{folder}/notes.json")
    return quality.valid_combos(io.read_specs(spark, folder, "intent string, supported_actions array<string>"))


@query("s_optional_merge", "SELECT r_name AS name FROM region UNION SELECT n_name FROM nation")
def s_optional_merge(spark, d):
    """Rows joined by those of a file that is there, with a bad line in it, and of one that isn't."""
    from ..sources import io

    rows = table(spark, d, "region").select(F.col("r_name").alias("name"))
    path = io.scratch(spark, "optional")
    lines = table(spark, d, "nation").select(F.to_json(F.struct(F.col("n_name").alias("name"))).alias("value"))
    lines.unionByName(spark.createDataFrame([("{broken",)], "value string")).write.text(path)
    more = io.read_optional(spark, path, rows.schema).unionByName(io.read_optional(spark, f"{path}-missing", rows.schema))
    return rows.unionByName(more).distinct()
