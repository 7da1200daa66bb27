"""Queries over the text functions and tokenisers."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as T
from .common import draw_sql, table, turns

QUERIES, ORACLES = {}, {}


def query(name: str, sql: str | None = None):
    def keep(f):
        QUERIES[name] = f
        if sql:
            ORACLES[name] = sql
        return f

    return keep


def token_query(name: str, make, source: str, key: str, sql_tokens: str) -> None:
    keys = key.split(", ")

    def run(spark, d):
        rows = table(spark, d, source).where("text is not null").select(*keys, make(F.col("text")).alias("t"))
        return rows.select(*keys, F.size("t").cast("bigint").alias("n_tokens"), F.md5(F.array_join("t", "|")).alias("digest"))

    QUERIES[name] = run
    ORACLES[name] = f"SELECT {key}, CAST(len(t) AS BIGINT) AS n_tokens, md5(array_to_string(t, '|')) AS digest FROM (SELECT {key}, {sql_tokens} AS t FROM {source} WHERE text IS NOT NULL)"


TOKENS_DECIMAL_SQL = r"list_filter(string_split_regex(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower({text}), '(\d),(\d)', '\1\2', 'g'), '[?!,]', ' ', 'g'), '\.(\s)', '\1', 'g'), '\.\z', ''), '\s+'), lambda x: x <> '')"
token_query("t_tok_decimal", T.tokens_decimal, "documents", "doc_id", TOKENS_DECIMAL_SQL.format(text="text"))
token_query("t_tok_punct", T.tokens_punct, "conversations", "conv_id, turn", "list_filter(list_transform(string_split(translate(lower(text), '.,?!', '    '), ' '), lambda x: trim(x)), lambda x: x <> '')")
token_query("t_tok_ws", T.tokens_space, "conversations", "conv_id, turn", r"list_filter(string_split_regex(translate(lower(text), '.,?!', '    '), '\s+'), lambda x: x <> '')")
token_query("t_tok_strip", T.tokens_strip, "conversations", "conv_id, turn", r"list_transform(list_filter(string_split_regex(text, '\s+'), lambda x: x <> ''), lambda w: regexp_replace(w, '[.,/#!$%^&*;:{}=\-_`~()]', '', 'g'))")
token_query("t_tok_halved", lambda c: T.tokens_strip(c, "half"), "conversations", "conv_id, turn", r"flatten(list_transform(list_transform(list_filter(string_split_regex(text, '\s+'), lambda x: x <> ''), lambda w: regexp_replace(w, '[.,/#!$%^&*;:{}=\-_`~()]', '', 'g')), lambda w: CASE WHEN length(w) > 7 AND " + draw_sql("'half'", "w") + " > 0.5 THEN [substr(w, 1, length(w) // 2), '##' || substr(w, length(w) // 2 + 1)] ELSE [w] END))")
token_query("t_sentences", T.sentences, "documents", "doc_id", r"list_filter(list_transform(string_split_regex(text, '[.;!?\r\n]+'), lambda x: trim(x)), lambda x: x <> '')")


def text_query(name: str, make, sql: str, source: str = "conversations", key: str = "conv_id, turn") -> None:
    keys = key.split(", ")
    QUERIES[name] = lambda spark, d: table(spark, d, source).where("text is not null").select(*keys, make(F.col("text")).alias("result"))
    ORACLES[name] = f"SELECT {key}, {sql} AS result FROM {source} WHERE text IS NOT NULL"


text_query("f_capitalise", lambda c: F.md5(T.capitalise(c)), "md5(upper(substr(text, 1, 1)) || substr(text, 2))")
text_query("f_collapse_ws", lambda c: F.md5(T.collapse_space(c)), r"md5(trim(regexp_replace(text, '\s+', ' ', 'g')))", "documents", "doc_id")
text_query("f_grammar", lambda c: F.md5(T.grammar_slips(c)), r"md5(trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(text, '(?i)\b(a|an|the)\b\s', '', 'g'), '\bis\b', 'are', 'g'), '\bdoes\b', 'do', 'g'), '\s+', ' ', 'g')))")
text_query("f_slang", lambda c: F.md5(T.replace_word(T.replace_word(c, "the", "da"), "with", "wid")), r"md5(regexp_replace(regexp_replace(text, '(?i)\bthe\b', 'da', 'g'), '(?i)\bwith\b', 'wid', 'g'))")
text_query("f_overlap_count", lambda c: T.overlapping_count(F.lower(c), F.lit("thth")), "CAST(len(list_filter(range(1, length(text) + 1), lambda i: substr(lower(text), i, 4) = 'thth')) AS BIGINT)")
text_query("f_amount_clean", lambda c: T.amount_digits(c), "coalesce(nullif(regexp_replace(text, '[^0-9.]', '', 'g'), ''), text)", "conversations", "conv_id, turn")
text_query("f_csv_escape", lambda c: F.md5(T.csv_field(c)), """md5(CASE WHEN regexp_matches(text, '[,\n"]') THEN '"' || replace(text, '"', '""') || '"' ELSE text END)""")
text_query("f_fence_json", lambda c: F.get_json_object(T.without_fences(F.concat(F.lit('```json\n{"n": '), F.length(c).cast("string"), F.lit("}\n```"))), "$.n").cast("bigint"), "CAST(length(text) AS BIGINT)")
NEAR_KEYS = {"a": "s", "e": "r", "i": "o", "o": "p", "t": "y", "n": "m"}


def slip_sql(word: str, name: str, *key: str) -> str:
    near = f"CASE lower(substr({word}, {name}, 1)) " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in NEAR_KEYS.items()) + " END"
    spot = f"2 + CAST(floor({draw_sql(*key, chr(39) + 'spot' + chr(39))} * greatest(length({word}) - 2, 1)) AS INTEGER)"
    edit = f"CASE WHEN {draw_sql(*key, chr(39) + 'kind' + chr(39))} < 0.5 AND {near} IS NOT NULL THEN substr({word}, 1, {name} - 1) || {near} || substr({word}, {name} + 1) ELSE substr({word}, 1, {name} - 1) || substr({word}, {name} + 1, 1) || substr({word}, {name}, 1) || substr({word}, {name} + 2) END"
    return f"list_transform([{spot}], lambda {name}: {edit})[1]"


text_query("f_typo", lambda c: F.md5(F.array_join(F.transform(F.split(c, r"\s+"), lambda w: T.typo(w, NEAR_KEYS, w)), " ")), (
    r"md5(array_to_string(list_transform(string_split_regex(text, '\s+'), lambda w: CASE WHEN length(w) > 3 THEN list_transform([" + slip_sql("w", "s", "w") + "], lambda o: CASE WHEN " + draw_sql("w", "'edits'") + " < 0.2 THEN " + slip_sql("o", "z", "w", "'again'") + " ELSE o END)[1] ELSE w END), ' '))"
))


def thousands_sql(x: str, indian: bool) -> str:
    plain = rf"regexp_replace(CAST(CAST(round({x}, 3) AS DECIMAL(38, 3)) AS VARCHAR), '\.?0+$', '')"
    whole = f"split_part({plain}, '.', 1)"
    rest = f"CASE WHEN contains({plain}, '.') THEN '.' || split_part({plain}, '.', 2) ELSE '' END"
    groups = lambda text, n: rf"ltrim(reverse(regexp_replace(reverse({text}), '(\d{{{n}}})', '\1,', 'g')), ',')"
    if not indian:
        return f"{groups(whole, 3)} || {rest}"
    return f"CASE WHEN length({whole}) > 3 THEN {groups(f'left({whole}, -3)', 2)} || ',' || right({whole}, 3) ELSE {whole} END || {rest}"


@query("f_thousands", f"SELECT o_orderkey, {thousands_sql('o_totalprice', False)} AS plain, {thousands_sql('o_totalprice * 100', True)} AS indian FROM orders")
def f_thousands(spark, d):
    price = F.col("o_totalprice")
    return table(spark, d, "orders").select("o_orderkey", T.grouped_digits(price).alias("plain"), T.grouped_digits(price * 100, indian=True).alias("indian"))


@query("f_placeholders", "SELECT p_partkey, 'p_brand,p_type' AS names FROM part")
def f_placeholders(spark, d):
    template = F.concat(F.lit("a {P_Brand} of {P_TYPE} for "), F.col("p_name"))
    return table(spark, d, "part").select("p_partkey", F.array_join(T.placeholders(template), ",").alias("names"))


@query("f_array_ops", """
SELECT conv_id, turn, CAST(len(w) AS BIGINT) AS n, list_contains(w, 'the') AS has_the, array_to_string(w[2:4], '-') AS part, CAST(len(list_filter(w, lambda x: length(x) < 4)) AS BIGINT) AS short,
       md5(array_to_string(list_transform(w, lambda x: upper(x)), ' ')) AS upper_case, CAST(len(flatten(list_transform(w, lambda x: [x, x]))) AS BIGINT) AS doubled, coalesce(list_sum(list_transform(w, lambda x: length(x))), 0)::BIGINT AS chars
FROM (SELECT conv_id, turn, list_filter(string_split_regex(lower(text), '[^a-z]+'), lambda x: x <> '') AS w FROM conversations WHERE text IS NOT NULL)""")
def f_array_ops(spark, d):
    w = F.col("w")
    rows = turns(spark, d).where("text is not null").select("conv_id", "turn", T.non_empty(F.split(F.lower("text"), "[^a-z]+")).alias("w"))
    return rows.select(
        "conv_id", "turn", F.size(w).cast("bigint").alias("n"), F.array_contains(w, "the").alias("has_the"), F.array_join(F.slice(w, 2, 3), "-").alias("part"), F.size(F.filter(w, lambda x: F.length(x) < 4)).cast("bigint").alias("short"),
        F.md5(F.array_join(F.transform(w, lambda x: F.upper(x)), " ")).alias("upper_case"), F.size(F.flatten(F.transform(w, lambda x: F.array(x, x)))).cast("bigint").alias("doubled"), F.aggregate(w, F.lit(0).cast("bigint"), lambda a, x: a + F.length(x)).alias("chars"),
    )


def mulberry_sql(seed: str) -> str:
    m = "4294967296"
    return f"""
SELECT c_custkey, round(CAST(xor(t2, t2 >> 14) AS DOUBLE) / 4294967296.0, 9) AS draw FROM (
 SELECT c_custkey, xor(t1, CAST((CAST(t1 AS HUGEINT) + (CAST(xor(t1, t1 >> 7) AS HUGEINT) * CAST(t1 | 61 AS HUGEINT)) % {m}) % {m} AS BIGINT)) AS t2 FROM (
  SELECT c_custkey, CAST((CAST(xor(s, s >> 15) AS HUGEINT) * CAST(s | 1 AS HUGEINT)) % {m} AS BIGINT) AS t1 FROM (
   SELECT c_custkey, CAST(({seed} + 1831565813) % {m} AS BIGINT) AS s FROM customer)))"""


@query("f_mulberry", mulberry_sql("c_custkey"))
def f_mulberry(spark, d):
    return table(spark, d, "customer").select("c_custkey", F.round(T.mulberry_draw(F.col("c_custkey")), 9).alias("draw"))
