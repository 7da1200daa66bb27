"""Queries over the generators."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import draw
from ..functions.text import regional_slang, slips
from ..operators import generate, sequence
from .common import draw_sql, table
from .model_queries import SPOKEN_SQL, spoken
from .text_queries import TOKENS_DECIMAL_SQL

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def pick_sql(values: list[str], *parts: str) -> str:
    return f"[{', '.join(map(q, values))}][CAST(floor({draw_sql(*parts)} * {len(values)}) AS INTEGER) + 1]"


TEMPLATES = ("buy {brand} in {place} now", "{kind} from {place}", "no slots here", "{missing} and {brand}")


def pools(spark, d):
    part, nation = table(spark, d, "part"), table(spark, d, "nation")
    pairs = part.select(F.lit("brand").alias("slot"), F.col("p_brand").alias("value")).union(part.select(F.lit("kind"), "p_type")).union(nation.select(F.lit("place"), "n_name"))
    return generate.indexed_pool(pairs.distinct())


POOL_SQL = "pool AS (SELECT slot, value, row_number() OVER (PARTITION BY slot ORDER BY value) - 1 AS i, count(*) OVER (PARTITION BY slot) AS n FROM (SELECT DISTINCT 'brand' AS slot, p_brand AS value FROM part UNION SELECT DISTINCT 'kind', p_type FROM part UNION SELECT 'place', n_name FROM nation))"


def templates(spark, d):
    k = F.col("c_custkey")
    return table(spark, d, "customer").select(k.alias("id"), F.element_at(F.array(*map(F.lit, TEMPLATES)), (F.pmod(k, F.lit(4)) + 1).cast("int")).alias("template"))


FILL_SQL = f"""{POOL_SQL}, t AS (SELECT c_custkey AS id, [{', '.join(map(q, TEMPLATES))}][c_custkey % 4 + 1] AS template FROM customer),
p1 AS (SELECT id, list_filter(string_split(replace(replace(template, '{{', chr(1) || '{{'), '}}', '}}' || chr(1)), chr(1)), lambda x: true) AS ps FROM t),
p2 AS (SELECT id, unnest(ps) AS part, unnest(range(0, len(ps))) AS raw FROM p1), p3 AS (SELECT id, part, raw FROM p2 WHERE part <> ''),
p4 AS (SELECT id, part, row_number() OVER (PARTITION BY id ORDER BY raw) - 1 + CASE WHEN (SELECT starts_with(template, '{{') FROM t WHERE t.id = p3.id) THEN 0 ELSE 0 END AS pos FROM p3),
p5 AS (SELECT id, pos, part, CASE WHEN part LIKE '{{%}}' THEN lower(part[2:-2]) END AS slot FROM p4),
p6 AS (SELECT p5.*, s.n FROM p5 LEFT JOIN (SELECT DISTINCT slot, n FROM pool) s USING (slot)),
p7 AS (SELECT p6.*, pool.value FROM p6 LEFT JOIN pool ON p6.slot = pool.slot AND pool.i = CAST(floor({draw_sql("'fill'", 'id', 'pos')} * p6.n) AS INTEGER))"""


@query("g_slot_fill", rf"WITH {FILL_SQL} SELECT id, trim(regexp_replace(string_agg(coalesce(value, part), '' ORDER BY pos), '\s+', ' ', 'g')) AS text, coalesce(string_agg(CASE WHEN value IS NOT NULL THEN slot || '=' || value END, '|' ORDER BY pos), '') AS slots FROM p7 GROUP BY id HAVING NOT bool_or(slot IS NOT NULL AND value IS NULL)")
def g_slot_fill(spark, d):
    return generate.fill_slots(templates(spark, d), pools(spark, d), "fill", "template", "id", reject=True).select("id", "text", "slots")


# Fixed values of this query: templates with typed slots, an unknown one among them.
TYPED = ("Spent {amount} on {kind} {date}.", "{amount} from {source} by {targetDate}", "Pay {brand} {amount}, {place1} please", "No slots. Here")
SYMBOLS = {"ASIA": "₹", "EUROPE": "€", "AMERICA": "$"}


def case_sql(of: str, table: dict[str, str], other: str = "NULL") -> str:
    return f"CASE {of} " + " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in table.items()) + f" ELSE {other} END"


def amount_sql(symbol: str, *key: str) -> str:
    """A drawn amount in a currency, in the same forms."""
    u = lambda part: draw_sql(*key, q(part))
    whole = f"CAST(CASE WHEN {u('large')} < 0.2 THEN 100000 + floor({u('value')} * 9000000) ELSE 10 + floor({u('value')} * 9000) END AS BIGINT)"
    cents = f"CAST(CASE WHEN {u('has_cents')} < 0.3 THEN floor({u('cents')} * 99) ELSE 0 END AS BIGINT)"
    raw = "w || CASE WHEN c = 0 THEN '' ELSE regexp_replace('.' || lpad(CAST(c AS VARCHAR), 2, '0'), '0$', '') END"
    form = f"CASE WHEN f < 0.2 THEN s || r WHEN f < 0.4 THEN r || ' ' || s WHEN f < 0.6 THEN r || ' ' || {pick_sql(list(generate.AMOUNT_WORDS), *key, q('which'))} WHEN f < 0.8 AND w >= 1000 THEN ((w * 100 + c + 5000) // 100000) || '.' || ((w * 100 + c + 5000) // 10000 % 10) || 'k' ELSE r END"
    return f"(SELECT trim({form}) FROM (SELECT w, c, f, s, {raw} AS r FROM (SELECT {whole} AS w, {cents} AS c, {u('form')} AS f, {symbol} AS s)))"


def date_sql(relative: dict[str, str], *key: str) -> str:
    """The surface of a drawn date."""
    u = lambda part: draw_sql(*key, q(part))
    day = f"make_date(2024 + CAST(floor({u('year')} * 3) AS INTEGER), 1 + CAST(floor({u('month')} * 12) AS INTEGER), 1 + CAST(floor({u('day')} * 28) AS INTEGER))"
    return f"CASE WHEN {u('near')} < 0.5 THEN {pick_sql(list(relative), *key, q('word'))} WHEN {u('layout')} < 0.3 THEN strftime({day}, '%d/%m/%Y') WHEN {u('layout')} < 0.6 THEN strftime({day}, '%d-%m-%Y') ELSE strftime({day}, '%Y-%m-%d') END"


def parts_sql(source: str, key: str) -> str:
    """CTEs from `source` (key, template, more): parts `pt` in order with their slot, null for text."""
    return rf"""pt0 AS (SELECT * EXCLUDE (template), string_split(replace(replace(template, '{{', chr(1) || '{{'), '}}', '}}' || chr(1)), chr(1)) AS ps FROM {source}),
pt1 AS (SELECT * EXCLUDE (ps), unnest(ps) AS part, unnest(range(0, len(ps))) AS raw FROM pt0),
pt AS (SELECT * EXCLUDE (raw), row_number() OVER (PARTITION BY {key} ORDER BY raw) - 1 AS pos, CASE WHEN part LIKE '{{%}}' THEN lower(part[2:-2]) END AS slot FROM pt1 WHERE part <> '')"""


@query("g_slot_tokens", f"""WITH {POOL_SQL}, pool2 AS (SELECT * FROM pool UNION ALL SELECT 'source', r_name, row_number() OVER (ORDER BY r_name) - 1, count(*) OVER () FROM region),
tpl AS (SELECT c_custkey AS id, {case_sql('r_name', SYMBOLS, "''")} AS symbol, [{', '.join(map(q, TYPED))}][c_custkey % {len(TYPED)} + 1] AS template FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
{parts_sql('tpl', 'id')}, sz AS (SELECT DISTINCT slot, n FROM pool2),
dr AS (SELECT pt.*, CASE slot WHEN 'amount' THEN {amount_sql('symbol', "'ty'", 'id', 'pos')} WHEN 'date' THEN {date_sql(generate.RELATIVE_DATES, "'ty'", 'id', 'pos')} WHEN 'targetdate' THEN {date_sql(generate.RELATIVE_DATES, "'ty'", 'id', 'pos')} END AS made, CAST(floor({draw_sql("'ty'", 'id', 'pos')} * sz.n) AS INTEGER) AS i FROM pt LEFT JOIN sz USING (slot)),
vl AS (SELECT id, pos, part, dr.slot, coalesce(made, value) AS value FROM dr LEFT JOIN pool2 ON dr.slot = pool2.slot AND dr.i = pool2.i),
tk AS (SELECT id, pos, {TOKENS_DECIMAL_SQL.format(text='coalesce(value, part)')} AS ts, CASE WHEN value IS NOT NULL THEN upper(CASE slot WHEN 'source' THEN 'category' ELSE slot END) END AS label FROM vl),
tg AS (SELECT id, pos, j, ts[j] || '/' || coalesce(CASE WHEN j = 1 THEN 'B-' ELSE 'I-' END || label, 'O') AS t FROM (SELECT *, unnest(range(1, len(ts) + 1)) AS j FROM tk))
SELECT id, string_agg(t, ' ' ORDER BY pos, j) AS tokens FROM tg GROUP BY id""")
def g_slot_tokens(spark, d):
    places = table(spark, d, "nation").join(F.broadcast(table(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"))
    rows = table(spark, d, "customer").join(F.broadcast(places), F.col("c_nationkey") == F.col("n_nationkey"))
    rows = generate.currency_of(rows, SYMBOLS, "r_name").select(F.col("c_custkey").alias("id"), "symbol", F.element_at(F.array(*map(F.lit, TYPED)), (F.pmod("c_custkey", F.lit(len(TYPED))) + 1).cast("int")).alias("template"))
    pool = pools(spark, d).unionByName(generate.indexed_pool(table(spark, d, "region").select(F.lit("source").alias("slot"), F.col("r_name").alias("value"))))
    made = generate.slot_tokens(rows, pool, "ty", "template", "id", generators=generate.slot_generators("symbol"), aliases={"source": "category"})
    return made.select("id", F.array_join(F.zip_with("tokens", "tags", lambda t, g: F.concat(t, F.lit("/"), g)), " ").alias("tokens"))


def slang_sql(text: str, region: str, *key: str) -> list[str]:
    """Expressions that replace one word each, from `text`, each naming the one before as x."""
    out = []
    for k, word in enumerate(dict.fromkeys(w for words in generate.REGIONAL_SLANG.values() for w in words)):
        t = text if k == 0 else "x"
        value = case_sql(region, {r: words[word] for r, words in generate.REGIONAL_SLANG.items() if word in words})
        out.append(rf"CASE WHEN {value} IS NOT NULL AND {draw_sql(*key, q(word))} < 0.5 THEN regexp_replace({t}, '(?i)\b{word}\b', {value}, 'g') ELSE {t} END")
    return out


def options_slip_sql(word: str, name: str, *key: str) -> str:
    """One slip of a word, with one of a letter's neighbours."""
    beside = case_sql(f"lower(substr({word}, {name}, 1))", generate.NEIGHBOURS)
    near = f"substr({beside}, CAST(floor({draw_sql(*key, q('near'))} * length({beside})) AS INTEGER) + 1, 1)"
    spot = f"2 + CAST(floor({draw_sql(*key, q('spot'))} * greatest(length({word}) - 2, 1)) AS INTEGER)"
    edit = f"CASE WHEN {draw_sql(*key, q('kind'))} < 0.5 AND {beside} IS NOT NULL THEN substr({word}, 1, {name} - 1) || {near} || substr({word}, {name} + 1) ELSE substr({word}, 1, {name} - 1) || substr({word}, {name} + 1, 1) || substr({word}, {name}, 1) || substr({word}, {name} + 2) END"
    return f"list_transform([{spot}], lambda {name}: {edit})[1]"


def slips_sql(source: str, text: str, *key: str) -> str:
    """CTEs from `source` to `sl2`, where `text` has slips."""
    once, again = options_slip_sql("w", "s", *key), options_slip_sql("o", "z", *key, q("again"))
    typed = f"CASE WHEN length(w) > 3 THEN list_transform([{once}], lambda o: CASE WHEN {draw_sql(*key, q('edits'))} < 0.2 THEN {again} ELSE o END)[1] ELSE w END"
    one = f"array_to_string(list_transform(string_split({text}, ' '), lambda w, j: CASE WHEN j - 1 = floor({draw_sql(*key, q('word'))} * len(string_split({text}, ' '))) THEN {typed} ELSE w END), ' ')"
    grammar = rf"trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace({text}, '(?i)\b(a|an|the)\b\s', '', 'g'), '\bis\b', 'are', 'g'), '\bdoes\b', 'do', 'g'), '\s+', ' ', 'g'))"
    return f"""sl1 AS (SELECT * REPLACE (CASE WHEN {draw_sql(*key, q('typo'))} < 0.15 AND len(string_split({text}, ' ')) > 2 THEN {one} ELSE {text} END AS {text}) FROM {source}),
sl2 AS (SELECT * REPLACE (CASE WHEN {draw_sql(*key, q('grammar'))} < 0.1 THEN {grammar} ELSE {text} END AS {text}) FROM sl1)"""


REGION_OF = f"[{', '.join(map(q, generate.REGIONAL_SLANG))}][conv_id % {len(generate.REGIONAL_SLANG)} + 1]"


@query("g_slang", f"WITH {SPOKEN_SQL}, s0 AS (SELECT *, {REGION_OF} AS region, text AS x FROM sp), " + ", ".join(f"s{k + 1} AS (SELECT * REPLACE ({e} AS x) FROM s{k})" for k, e in enumerate(slang_sql("x", "region", "'sg'", "conv_id", "turn"))) + " SELECT conv_id, turn, region, x AS text FROM s4")
def g_slang(spark, d):
    regions = list(generate.REGIONAL_SLANG)
    rows = spoken(spark, d).withColumn("region", F.element_at(F.array(*map(F.lit, regions)), (F.pmod("conv_id", F.lit(len(regions))) + 1).cast("int")))
    return rows.select("conv_id", "turn", "region", regional_slang(F.col("text"), F.col("region"), generate.REGIONAL_SLANG, "sg", F.col("conv_id"), F.col("turn")).alias("text"))


@query("g_slips", f"WITH {SPOKEN_SQL}, {slips_sql('sp', 'text', chr(39) + 'sl' + chr(39), 'conv_id', 'turn')} SELECT conv_id, turn, text FROM sl2")
def g_slips(spark, d):
    return spoken(spark, d).select("conv_id", "turn", slips(F.col("text"), generate.NEIGHBOURS, "sl", F.col("conv_id"), F.col("turn")).alias("text"))


# Fixed values of this query: patterns by the region of a nation; some have few different texts, one an unknown slot.
PATTERNS = (("nothing to fill", "still nothing"), ("spent on {kind}", "{missing} here", "no slot"), ("is it expensive in {place}", "buy {brand} in {place}", "the cheap {kind}"), ("{brand}", "{missing}"), ("i am broke, {brand} and {kind} for {place}",))


def style_sql(*key: str) -> str:
    """A text `x` in a drawn style."""
    style = pick_sql(list(generate.STYLES), *key, q("style"))
    cases = " ".join(f"WHEN {q(n)} THEN {pick_sql(o, *key, q('opener'))} || ' ' || x || CASE WHEN {draw_sql(*key, q('filler'))} < 0.5 THEN ' ' || {pick_sql(f, *key, q('which'))} ELSE '' END" for n, (o, f) in generate.STYLES.items() if o)
    return f"CASE {style} {cases} ELSE x END"


SPEC_KEY = ("'sr'", "g", "attempt")
SPEC_PARTS_KEY = (*SPEC_KEY, "pos")


@query("g_spec_rows", f"""WITH {POOL_SQL}, sp0 AS (SELECT n_name AS g, 4 + 3 * n_nationkey AS target, [{', '.join('[' + ', '.join(map(q, ps)) + ']' for ps in PATTERNS)}][n_regionkey + 1] AS ps FROM nation),
tries AS (SELECT *, unnest(range(0, target * 40)) AS attempt FROM sp0),
tpl AS (SELECT g, target, attempt, ps[CAST(floor({draw_sql(*SPEC_KEY, "'pattern'")} * len(ps)) AS INTEGER) + 1] AS template FROM tries), {parts_sql('tpl', 'g, attempt')},
dr AS (SELECT pt.*, CAST(floor({draw_sql(*SPEC_PARTS_KEY)} * sz.n) AS INTEGER) AS i FROM pt LEFT JOIN (SELECT DISTINCT slot, n FROM pool) sz USING (slot)),
vl AS (SELECT g, target, attempt, pos, part, dr.slot, value FROM dr LEFT JOIN pool ON dr.slot = pool.slot AND dr.i = pool.i),
tx AS (SELECT g, target, attempt, trim(regexp_replace(string_agg(coalesce(value, part), '' ORDER BY pos), '\\s+', ' ', 'g')) AS x, coalesce(string_agg(CASE WHEN value IS NOT NULL THEN slot || '=' || value END, '|' ORDER BY pos), '') AS slots FROM vl GROUP BY g, target, attempt HAVING NOT bool_or(slot IS NOT NULL AND value IS NULL)),
s0 AS (SELECT *, {pick_sql(list(generate.REGIONAL_SLANG), *SPEC_KEY, "'region'")} AS region FROM tx), """ + ", ".join(f"s{k + 1} AS (SELECT * REPLACE ({e} AS x) FROM s{k})" for k, e in enumerate(slang_sql("x", "region", *SPEC_KEY))) + f""",
st AS (SELECT * REPLACE ({style_sql(*SPEC_KEY)} AS x) FROM s4), {slips_sql('st', 'x', *SPEC_KEY)},
fi AS (SELECT g, target, min((attempt, x, slots)) AS m FROM sl2 GROUP BY g, target, lower(x)), rk AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY m) AS r FROM fi)
SELECT g, struct_extract(m, 1) AS attempt, struct_extract(m, 2) AS text, struct_extract(m, 3) AS slots FROM rk WHERE r <= target""")
def g_spec_rows(spark, d):
    patterns = F.get(F.array(*(F.array(*map(F.lit, ps)) for ps in PATTERNS)), F.col("n_regionkey").cast("int"))
    specs = table(spark, d, "nation").select(F.col("n_name").alias("g"), (4 + 3 * F.col("n_nationkey")).cast("bigint").alias("target"), patterns.alias("patterns"))
    return generate.spec_rows(specs, pools(spark, d), "sr", generate.REGIONAL_SLANG, generate.STYLES, generate.NEIGHBOURS, ["g"])


@query("g_char_spans", f"""WITH {FILL_SQL}, e AS (SELECT id, pos, coalesce(value, part) AS tx, CASE WHEN value IS NOT NULL THEN slot END AS label, CAST(sum(length(coalesce(value, part))) OVER (PARTITION BY id ORDER BY pos) AS INTEGER) AS fin FROM p7)
SELECT id, fin - CAST(length(tx) AS INTEGER) AS start, fin AS "end", label, tx AS text FROM e WHERE label IS NOT NULL""")
def g_char_spans(spark, d):
    filled = generate.fill_slots(templates(spark, d), pools(spark, d), "fill", "template", "id")
    return filled.select("id", F.explode(sequence.char_spans(F.col("parts"))).alias("s")).select("id", "s.*")


@query("g_round_robin", "WITH p AS (SELECT p_brand, p_partkey, p_name FROM part), n AS (SELECT p_brand, list(p_name ORDER BY p_partkey) AS l FROM p GROUP BY p_brand) SELECT p_brand, CAST(i AS INTEGER) AS i, l[i % len(l) + 1] AS template FROM n, range(200) r(i)")
def g_round_robin(spark, d):
    rows = table(spark, d, "part").select("p_brand", F.col("p_partkey").alias("pos"), F.col("p_name").alias("template"))
    return generate.round_robin(rows, 200, ["p_brand"])


@query("g_cartesian", "WITH t AS (SELECT r_regionkey, r_name, CASE r_regionkey % 3 WHEN 0 THEN 'a {x} b {y}' WHEN 1 THEN 'only {y}' ELSE 'plain' END AS t FROM region), a AS (SELECT r_regionkey, CASE WHEN contains(t, '{x}') THEN replace(t, '{x}', v) ELSE t END AS t, v FROM t, (VALUES ('1'), ('2'), ('3')) x(v) WHERE contains(t, '{x}') OR v = '1'), b AS (SELECT r_regionkey, CASE WHEN contains(t, '{y}') THEN replace(t, '{y}', w) ELSE t END AS text FROM a, (VALUES ('p'), ('q')) y(w) WHERE contains(t, '{y}') OR w = 'p') SELECT * FROM b")
def g_cartesian(spark, d):
    k = F.col("r_regionkey") % 3
    rows = table(spark, d, "region").select("r_regionkey", F.when(k == 0, "a {x} b {y}").when(k == 1, "only {y}").otherwise("plain").alias("template"))
    return generate.cartesian(rows, {"x": ["1", "2", "3"], "y": ["p", "q"]}, "template", "r_regionkey")


@query("g_merge_templates", """WITH a AS (SELECT p_brand, list(DISTINCT p_type) AS l FROM part WHERE p_size < 20 GROUP BY p_brand), b AS (SELECT p_brand, list(DISTINCT p_type) AS l FROM part WHERE p_size > 30 AND p_brand <> 'Brand#3' GROUP BY p_brand)
SELECT coalesce(a.p_brand, b.p_brand) AS p_brand, array_to_string(list_sort(list_distinct(list_concat(coalesce(a.l, []), coalesce(b.l, [])))), ',') AS templates FROM a FULL OUTER JOIN b ON a.p_brand = b.p_brand""")
def g_merge_templates(spark, d):
    part = table(spark, d, "part")
    registry = lambda rows: rows.groupBy("p_brand").agg(F.array_sort(F.collect_set("p_type")).alias("templates"))
    merged = generate.merge_registries(registry(part.where("p_size < 20")), registry(part.where("p_size > 30 and p_brand <> 'Brand#3'")), ["p_brand"])
    return merged.select("p_brand", F.array_join(F.array_sort("templates"), ",").alias("templates"))


BASE = ["what is the weather", "tell me a joke", "open the door", "play some music", "who are you", "good morning", "translate this"]


@query("g_unknown", f"WITH b AS (SELECT i, [{', '.join(map(q, BASE))}][i % 7 + 1] AS t FROM (SELECT o_orderkey AS i FROM orders)), c AS (SELECT i, CASE i % 3 WHEN 0 THEN upper(t) WHEN 1 THEN upper(substr(t, 1, 1)) || substr(t, 2) ELSE t END AS t FROM b), e AS (SELECT i, CASE WHEN i % 4 = 0 THEN 'please ' || t ELSE t END AS t FROM c) SELECT i, CASE WHEN i % 5 = 0 THEN t || '?' ELSE t END AS text FROM e")
def g_unknown(spark, d):
    return generate.negatives(table(spark, d, "orders").select(F.col("o_orderkey").alias("i")), BASE)


NOISE_TOKENS, NOISE_TAGS, FILLERS = ("my", "budget", "for", "paris"), ("O", "O", "O", "B-PLACE"), ["um", "like", "well"]


@query("g_noise", f"""WITH b AS (SELECT c_custkey AS id, i, ['my', 'budget', 'for', 'paris'][i + 1] AS tok, ['O', 'O', 'O', 'B-PLACE'][i + 1] AS tag FROM customer, range(4) r(i)),
c AS (SELECT id, i * 2 AS o, CASE WHEN tok = 'budget' AND {draw_sql("'noise'", 'id', 'i', "'swap'")} < 0.5 THEN 'budgt' ELSE tok END AS tok, tag FROM b
UNION ALL SELECT id, i * 2 + 1, {pick_sql(FILLERS, "'noise'", 'id', 'i', "'word'")}, 'O' FROM b WHERE tag = 'O' AND {draw_sql("'noise'", 'id', 'i', "'filler'")} < 0.05
UNION ALL SELECT c_custkey, 100, 'stuff', 'O' FROM customer WHERE {draw_sql("'noise'", 'c_custkey', "'end'")} < 0.1) SELECT id, string_agg(tok || '/' || tag, ' ' ORDER BY o) AS tokens FROM c GROUP BY id""")
def g_noise(spark, d):
    tokens, tags = F.array(*map(F.lit, NOISE_TOKENS)), F.array(*map(F.lit, NOISE_TAGS))
    noisy = generate.noisy(tokens, tags, {"budget": "budgt"}, FILLERS, "noise", F.col("c_custkey"))
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.array_join(F.transform(noisy, lambda p: F.concat(p["token"], F.lit("/"), p["tag"])), " ").alias("tokens"))


OPENERS = {"DIRECT": [], "POLITE": ["could you", "would you kindly"], "CASUAL": ["hey", "yo", "so"]}


@query("g_style", f"WITH s AS (SELECT c_custkey AS id, {pick_sql(list(OPENERS), chr(39) + 'st' + chr(39), 'c_custkey', chr(39) + 'style' + chr(39))} AS style FROM customer), o AS (SELECT id, CASE style WHEN 'POLITE' THEN {pick_sql(OPENERS['POLITE'], chr(39) + 'st' + chr(39), 'id', chr(39) + 'opener' + chr(39))} WHEN 'CASUAL' THEN {pick_sql(OPENERS['CASUAL'], chr(39) + 'st' + chr(39), 'id', chr(39) + 'opener' + chr(39))} ELSE '' END AS op, CASE WHEN {draw_sql(chr(39) + 'st' + chr(39), 'id', chr(39) + 'filler' + chr(39))} < 0.5 THEN {pick_sql(FILLERS, chr(39) + 'st' + chr(39), 'id', chr(39) + 'which' + chr(39))} ELSE '' END AS fi FROM s) SELECT id, array_to_string(list_filter([op, 'log this', fi], lambda x: x <> ''), ' ') AS text FROM o")
def g_style(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), generate.styled(F.lit("log this"), OPENERS, FILLERS, "st", F.col("c_custkey")).alias("text"))


def am(part: str) -> str:
    return draw_sql("'am'", "id", q(part))


@query("g_amount", f"WITH b AS (SELECT c_custkey AS id FROM customer), v AS (SELECT id, CAST(CASE WHEN {am('large')} < 0.2 THEN 100000 + floor({am('value')} * 9000000) ELSE 10 + floor({am('value')} * 9000) END AS BIGINT) AS w, CASE WHEN {am('has_cents')} < 0.3 THEN '.' || lpad(CAST(CAST(floor({am('cents')} * 100) AS INTEGER) AS VARCHAR), 2, '0') ELSE '' END AS c, CAST(floor({am('form')} * 5) AS INTEGER) AS f FROM b) SELECT id, CASE WHEN f = 0 THEN '$' || w || c WHEN f = 1 THEN w || c || ' dollars' WHEN f = 2 THEN 'rs ' || w || c WHEN f = 3 AND w >= 1000 THEN (w // 1000) || 'k' ELSE w || c END AS amount FROM v")
def g_amount(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), generate.amount_text("am", F.col("c_custkey")).alias("amount"))


# Fixed values of this query: relative words and what they stand for.
RELATIVE = {"yesterday": "RELATIVE_PAST_1_DAY", "today": "RELATIVE_PRESENT", "last week": "RELATIVE_PAST_1_WEEK"}


def dt(part: str) -> str:
    return draw_sql("'dt'", "id", q(part))


@query("g_date", f"WITH b AS (SELECT c_custkey AS id FROM customer), v AS (SELECT id, {pick_sql(list(RELATIVE), chr(39) + 'dt' + chr(39), 'id', chr(39) + 'word' + chr(39))} AS w, make_date(2024 + CAST(floor({dt('year')} * 3) AS INTEGER), 1 + CAST(floor({dt('month')} * 12) AS INTEGER), 1 + CAST(floor({dt('day')} * 28) AS INTEGER)) AS d, {dt('layout')} AS l, {dt('near')} < 0.5 AS n FROM b) SELECT id, CASE WHEN n THEN w WHEN l < 0.3 THEN strftime(d, '%d/%m/%Y') WHEN l < 0.6 THEN strftime(d, '%d-%m-%Y') ELSE strftime(d, '%Y-%m-%d') END AS surface, CASE WHEN n THEN CASE w WHEN 'yesterday' THEN 'RELATIVE_PAST_1_DAY' WHEN 'today' THEN 'RELATIVE_PRESENT' ELSE 'RELATIVE_PAST_1_WEEK' END ELSE strftime(d, '%Y-%m-%d') END AS value FROM v")
def g_date(spark, d):
    return table(spark, d, "customer").select(F.col("c_custkey").alias("id"), generate.date_text(RELATIVE, "dt", F.col("c_custkey")).alias("s")).select("id", "s.*")


@query("g_dedup_target", f"WITH c AS (SELECT c_mktsegment AS g, c_custkey AS attempt, 'V' || CAST(floor({draw_sql(chr(39) + 'dd' + chr(39), 'c_custkey')} * 60) AS INTEGER) AS t FROM customer), f AS (SELECT g, lower(t) AS k, min((attempt, t)) AS m FROM c GROUP BY g, lower(t)), r AS (SELECT g, m, row_number() OVER (PARTITION BY g ORDER BY m) AS n FROM f) SELECT g, struct_extract(m, 1) AS attempt, struct_extract(m, 2) AS t FROM r WHERE n <= 40")
def g_dedup_target(spark, d):
    rows = table(spark, d, "customer").select(F.col("c_mktsegment").alias("g"), F.col("c_custkey").alias("attempt"), F.concat(F.lit("V"), F.floor(draw("dd", F.col("c_custkey")) * 60).cast("string")).alias("t"))
    return generate.distinct_target(rows, 40, ["g"], "attempt", "t")


# Templates by intent.
INTENTS = {"ADD_EXPENSE": ["spent on {kind}", "{brand} at {place}", "paid for {kind} today"], "BUDGET_QUERY": ["budget for {kind}", "{brand} at {place}"], "GOAL": ["save for {place}"]}
TEXTS = ("show {kind} costs", "how much for {kind} at {place}", "{kind}, {kind} and more", "Total please")
SLOT_VALUES = {"kind": ["Rent", "fuel", "Food"], "place": ["home", "Delhi"]}


def intent_templates(spark):
    return spark.createDataFrame([(i, p, t) for i, ts in INTENTS.items() for p, t in enumerate(ts)], "intent string, pos int, template string")


SYNTH_SQL = f"""{POOL_SQL}, tpl AS (SELECT * FROM (VALUES {', '.join(f"({q(i)}, {p}, {len(ts)}, {q(t)})" for i, ts in INTENTS.items() for p, t in enumerate(ts))}) AS v(intent, pos, k, template)),
prt AS (SELECT intent, pos AS tp, k, string_split_regex(replace(replace(template, '{{', chr(1) || '{{'), '}}', '}}' || chr(1)), chr(1)) AS p FROM tpl),
ext AS (SELECT intent, tp, k, part, row_number() OVER (PARTITION BY intent, tp ORDER BY j) - 1 AS pos FROM (SELECT intent, tp, k, unnest(p) AS part, unnest(range(0, len(p))) AS j FROM prt) WHERE part <> ''),
att AS (SELECT intent, CAST(a AS INTEGER) AS attempt, pos, part, lower(trim(part, '{{}}')) AS slot FROM ext, range(300) r(a) WHERE a % k = tp),
fil AS (SELECT att.*, (SELECT max(n) FROM pool WHERE pool.slot = att.slot AND starts_with(part, '{{')) AS n FROM att),
val AS (SELECT fil.*, pool.value FROM fil LEFT JOIN pool ON fil.n IS NOT NULL AND pool.slot = fil.slot AND pool.i = CAST(floor({draw_sql("'syn'", 'intent', 'attempt', 'pos')} * fil.n) AS INTEGER)),
txt AS (SELECT intent, attempt, string_agg(coalesce(value, part), '' ORDER BY pos) AS text FROM val GROUP BY intent, attempt),
own AS (SELECT text, min((intent, attempt)) AS m FROM txt GROUP BY text),
rnk AS (SELECT struct_extract(m, 1) AS intent, text, row_number() OVER (PARTITION BY struct_extract(m, 1) ORDER BY struct_extract(m, 2)) - 1 AS n FROM own),
rol AS (SELECT *, {draw_sql("'syn'", "'split'", 'intent', 'n')} AS u FROM rnk WHERE n < 120)"""


@query("g_synthesise", f"WITH {SYNTH_SQL} SELECT substr(intent, 1, 3) || '_' || n AS id, intent, text, CASE WHEN u < 0.8 THEN 'train' WHEN u < 0.9 THEN 'val' ELSE 'test' END AS split FROM rol")
def g_synthesise(spark, d):
    return generate.synthesised(intent_templates(spark), pools(spark, d), "syn", 120, 300).select("id", "intent", "text", "split")


@query("g_expand", f"WITH b AS (SELECT i, {pick_sql(list(TEXTS), chr(39) + 'ex' + chr(39), 'i', chr(39) + 'template' + chr(39))} AS t FROM (SELECT c_custkey AS i FROM customer)), "
    + ", ".join(f"{n} AS (SELECT i, CASE WHEN contains(t, '{{{k}}}') THEN substr(t, 1, instr(t, '{{{k}}}') - 1) || {pick_sql(v, chr(39) + 'ex' + chr(39), 'i', q(k))} || substr(t, instr(t, '{{{k}}}') + {len(k) + 2}) ELSE t END AS t FROM {p})" for n, p, (k, v) in zip(("c", "e"), ("b", "c"), SLOT_VALUES.items()))
    + f", f AS (SELECT i, CASE WHEN {draw_sql(chr(39) + 'ex' + chr(39), 'i', chr(39) + 'filler' + chr(39))} > 0.8 THEN t || ' ' || {pick_sql(FILLERS, chr(39) + 'ex' + chr(39), 'i', chr(39) + 'which' + chr(39))} ELSE t END AS t FROM e) SELECT i, CASE WHEN {draw_sql(chr(39) + 'ex' + chr(39), 'i', chr(39) + 'lower' + chr(39))} > 0.8 THEN lower(t) ELSE t END AS text FROM f")
def g_expand(spark, d):
    return generate.expanded(table(spark, d, "customer").select(F.col("c_custkey").alias("i")), list(TEXTS), SLOT_VALUES, FILLERS, "ex", F.col("i"))


@query("g_registered_slot", f"WITH {POOL_SQL}, c AS (SELECT c_custkey AS id, CASE WHEN {draw_sql("'rg'", 'c_custkey')} < 0.5 THEN 'fine' ELSE 'low' END || length('rg|' || c_custkey) AS direct, CASE WHEN {draw_sql("'rt'", 'c_custkey', '1')} < 0.5 THEN 'fine' ELSE 'low' END || length('rt|' || c_custkey || '|1') AS mood, CAST(floor({draw_sql("'rt'", 'c_custkey', '3')} * (SELECT any_value(n) FROM pool WHERE slot = 'place')) AS INTEGER) AS i FROM customer) SELECT id, direct, 'I feel ' || mood || ' in ' || value AS text FROM c JOIN pool ON slot = 'place' AND pool.i = c.i")
def g_registered_slot(spark, d):
    """A slot that the caller adds, called from SQL and from a template."""
    mood = generate.register_slot(spark, "mood", "CASE WHEN slot_draw(k) < 0.5 THEN 'fine' ELSE 'low' END || length(k)")
    direct = spark.sql("SELECT c_custkey AS id, slot_mood('rg|' || c_custkey) AS direct, 'I feel {{mood}} in {{place}}' AS template FROM {customer}", customer=table(spark, d, "customer"))
    filled = generate.fill_slots(direct.select("id", "template"), pools(spark, d), "rt", "template", "id", generators={"mood": mood})
    return direct.select("id", "direct").join(filled.select("id", "text"), "id")


@query("j_currency", "SELECT n_name, CASE r_name WHEN 'ASIA' THEN '₹' WHEN 'EUROPE' THEN '€' WHEN 'AMERICA' THEN '$' ELSE '' END AS symbol FROM nation LEFT JOIN region ON n_regionkey = r_regionkey")
def j_currency(spark, d):
    rows = table(spark, d, "nation").join(F.broadcast(table(spark, d, "region")), F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return generate.currency_of(rows, SYMBOLS, "r_name").select("n_name", "symbol")
