"""Set-returning operators: slot filling, round robin, noise, styles, amounts, dates, negatives."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import collapse_space, draw, pick, regional_slang, slips, tokens_decimal
from ..sources.io import scratch, small


def indexed_pool(pool: DataFrame, slot: str = "slot", value: str = "value") -> DataFrame:
    """(slot, i, n, value): the values of every slot with their place and number; a slot's pool is a small table."""
    packed = pool.select(slot, value).distinct().groupBy(slot).agg(F.array_sort(F.collect_list(value)).alias("values"))
    return packed.select(F.col(slot).alias("slot"), F.size("values").alias("n"), F.posexplode("values").alias("i", "value"))


#: Surface of a slot from the parts of its draw.
Generator = Callable[..., Column]


def drawn_parts(templates: DataFrame, pool: DataFrame, seed: str, template: str, *key: str, generators: dict[str, Generator] | None = None) -> DataFrame:
    """(key, pos, part, slot, value): the parts of every template in order, with the value drawn for a slot, null for an unknown one.

    A slot with a generator of its own takes it; the others are joined to the pool by slot and place.
    """
    parts = F.split(F.col(template), r"(?<=\})|(?=\{)")
    rows = templates.select("*", F.posexplode(parts).alias("pos", "part")).where("part <> ''").drop(template)
    name = F.lower(F.regexp_extract("part", r"^\{(\w+)\}$", 1))
    rows = rows.withColumn("slot", F.when(name != "", name))
    parts_of_draw = (F.lit(seed), *(F.col(k) for k in key), F.col("pos"))
    made = F.lit(None).cast("string")
    for slot, generator in (generators or {}).items():
        made = F.when(F.col("slot") == slot, generator(*parts_of_draw)).otherwise(made)
    sizes = pool.select("slot", "n").distinct()
    rows = rows.join(small(sizes), "slot", "left").withColumns({"i": F.floor(draw(*parts_of_draw) * F.col("n")).cast("int"), "made": made})
    rows = rows.join(small(pool.select("slot", "i", "value")), ["slot", "i"], "left")
    return rows.select(*key, "pos", "part", "slot", F.coalesce("made", "value").alias("value"))


def fill_slots(templates: DataFrame, pool: DataFrame, seed: str, template: str = "template", *key: str, compat: bool = False, reject: bool = False, generators: dict[str, Generator] | None = None) -> DataFrame:
    """(key, text, slots, parts): every {slot} replaced by a drawn value.

    An unknown slot stays as text; it is tagged O, with `compat` as a slot. With `reject` a row that has one goes, and the
    texts' white space is collapsed. Parts are gathered in order.
    """
    rows = drawn_parts(templates, pool, seed, template, *key, generators=generators)
    known = F.col("slot").isNotNull() & (F.lit(True) if compat else F.col("value").isNotNull())
    filled = rows.select(*key, "pos", F.coalesce("value", "part").alias("text"), F.when(known, F.col("slot")).alias("slot"), (F.col("slot").isNotNull() & F.col("value").isNull()).alias("unknown"))
    gathered = filled.groupBy(*key).agg(F.array_sort(F.collect_list(F.struct("pos", "text", "slot"))).alias("parts"), F.bool_or("unknown").alias("unknown"))
    text = F.array_join(F.transform("parts", lambda p: p["text"]), "")
    if reject:
        gathered, text = gathered.where("not unknown"), collapse_space(text)
    slots = F.array_join(F.transform(F.filter("parts", lambda p: p["slot"].isNotNull()), lambda p: F.concat(p["slot"], F.lit("="), p["text"])), "|")
    return gathered.select(*key, text.alias("text"), slots.alias("slots"), F.transform("parts", lambda p: F.struct(p["text"].alias("text"), p["slot"].alias("label"))).alias("parts"))


def slot_tokens(templates: DataFrame, pool: DataFrame, seed: str, template: str = "template", *key: str, generators: dict[str, Generator] | None = None, aliases: dict[str, str] | None = None, compat: bool = False) -> DataFrame:
    """(key, tokens, tags): the tokens of texts and drawn values in order; a value's first token is tagged B-, the others I-, text O.

    `aliases` gives the names that slots are tagged with. An unknown slot is text, which `compat` tags all the same.
    """
    rows = drawn_parts(templates, pool, seed, template, *key, generators=generators)
    name = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in (aliases or {}).items() for x in kv)), F.col("slot")), F.col("slot")) if aliases else F.col("slot")
    label = F.when(F.col("slot").isNotNull() & (F.lit(True) if compat else F.col("value").isNotNull()), F.upper(name))
    tagged = rows.select(*key, "pos", tokens_decimal(F.coalesce("value", "part")).alias("ts"), label.alias("label"))
    pairs = F.transform("ts", lambda t, i: F.struct(t.alias("token"), F.coalesce(F.concat(F.when(i == 0, "B-").otherwise("I-"), F.col("label")), F.lit("O")).alias("tag")))
    gathered = tagged.select(*key, "pos", pairs.alias("ps")).groupBy(*key).agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("pos", "ps"))), lambda x: x["ps"])).alias("ps"))
    return gathered.select(*key, F.col("ps.token").alias("tokens"), F.col("ps.tag").alias("tags"))


def round_robin(templates: DataFrame, n: int, group: list[str], place: str = "pos", template: str = "template") -> DataFrame:
    """(group, i, template): n rows per group, its templates in turn; of a group of more than n templates the first n.

    Templates are numbered within their group and joined by place, so none is carried along with all others.
    """
    first = templates.withColumn("__at", F.row_number().over(Window.partitionBy(*group).orderBy(place, template)) - 1).where(F.col("__at") < n)
    sizes = templates.groupBy(*group).agg(F.count(F.lit(1)).alias("__n"))
    rows = sizes.withColumn("i", F.explode(F.sequence(F.lit(0), F.lit(n - 1)))).withColumn("__at", F.pmod(F.col("i"), F.col("__n")))
    return rows.join(first.select(*group, "__at", template), [*group, "__at"]).select(*group, "i", template)


def cartesian(templates: DataFrame, values: dict[str, list[str]], template: str = "template", *key: str) -> DataFrame:
    """(key, text): a template times the values of every slot that it has; templates without a slot pass."""
    rows = templates.select(*key, F.col(template).alias("text"))
    for slot, listed in values.items():
        mark = "{" + slot + "}"
        options = F.when(F.contains("text", F.lit(mark)), F.array(*map(F.lit, listed))).otherwise(F.array(F.lit(None).cast("string")))
        rows = rows.withColumn("__v", F.explode(options)).withColumn("text", F.when(F.col("__v").isNull(), F.col("text")).otherwise(F.replace("text", F.lit(mark), F.col("__v")))).drop("__v")
    return rows


def merge_registries(a: DataFrame, b: DataFrame, keys: list[str], templates: str = "templates") -> DataFrame:
    """Union of two registries (keys, templates), without repeats, the first one's order first."""
    other = b.select(*keys, F.col(templates).alias("__b"))
    empty = F.array().cast("array<string>")
    return a.join(other, keys, "full_outer").select(*keys, F.array_union(F.coalesce(templates, empty), F.coalesce("__b", empty)).alias(templates))


def noisy(tokens: Column, tags: Column, swaps: dict[str, str], fillers: list[str], *key: Column | str) -> Column:
    """array<struct<token, tag>>: some words misspelt (half of them), fillers behind O tokens (5 %), `stuff` at the end (10 %)."""
    table = F.create_map(*(F.lit(x) for kv in swaps.items() for x in kv))
    pairs = F.zip_with(tokens, tags, lambda a, b: F.struct(a.alias("token"), b.alias("tag")))

    def one(p: Column, i: Column) -> Column:
        word = F.when(F.try_element_at(table, p["token"]).isNotNull() & (draw(*key, i, "swap") < 0.5), F.try_element_at(table, p["token"])).otherwise(p["token"])
        here = F.array(F.struct(word.alias("token"), p["tag"].alias("tag")))
        extra = F.array(F.struct(pick(fillers, *key, i, "word").alias("token"), F.lit("O").alias("tag")))
        return F.when((p["tag"] == "O") & (draw(*key, i, "filler") < 0.05), F.concat(here, extra)).otherwise(here)

    end = F.array(F.struct(F.lit("stuff").alias("token"), F.lit("O").alias("tag")))
    body = F.flatten(F.transform(pairs, one))
    return F.when(draw(*key, "end") < 0.1, F.concat(body, end)).otherwise(body)


def styled(text: Column, openers: dict[str, list[str]], fillers: list[str], *key: Column | str) -> Column:
    """The text in a drawn style: no opener for DIRECT, else one of the style's; a filler behind half of them."""
    names = list(openers)
    style = pick(names, *key, "style")
    opener = F.lit("")
    for name, listed in openers.items():
        if listed:
            opener = F.when(style == name, pick(listed, *key, "opener")).otherwise(opener)
    filler = F.when(draw(*key, "filler") < 0.5, pick(fillers, *key, "which")).otherwise(F.lit(""))
    return F.array_join(F.filter(F.array(opener, text, filler), lambda x: x != ""), " ")


def amount_text(*key: Column | str) -> Column:
    """A drawn amount: a fifth are large, a third have cents; one of five forms, the `k` form from 1000 on."""
    large = draw(*key, "large") < 0.2
    whole = F.when(large, F.lit(100000) + F.floor(draw(*key, "value") * 9000000)).otherwise(F.lit(10) + F.floor(draw(*key, "value") * 9000)).cast("bigint")
    cents = F.when(draw(*key, "has_cents") < 0.3, F.concat(F.lit("."), F.lpad(F.floor(draw(*key, "cents") * 100).cast("string"), 2, "0"))).otherwise(F.lit(""))
    form = F.floor(draw(*key, "form") * 5).cast("int")
    plain = F.concat(whole.cast("string"), cents)
    return F.when(form == 0, F.concat(F.lit("$"), plain)).when(form == 1, F.concat(plain, F.lit(" dollars"))).when(form == 2, F.concat(F.lit("rs "), plain)).when((form == 3) & (whole >= 1000), F.concat(F.floor(whole / 1000).cast("string"), F.lit("k"))).otherwise(plain)


# Words behind an amount; relative dates and what they stand for; symbols by region.
AMOUNT_WORDS = ("bucks", "quid", "rs", "inr", "dollars")
RELATIVE_DATES = {
    "yesterday": "RELATIVE_PAST_1_DAY", "yday": "RELATIVE_PAST_1_DAY", "last week": "RELATIVE_PAST_7_DAYS", "last wk": "RELATIVE_PAST_7_DAYS", "today": "RELATIVE_CURRENT_DAY", "tmrw": "RELATIVE_FUTURE_1_DAY",
    "tomorrow": "RELATIVE_FUTURE_1_DAY", "next week": "RELATIVE_FUTURE_7_DAYS", "nxt wk": "RELATIVE_FUTURE_7_DAYS", "monday morning": "RELATIVE_FUTURE_MONDAY", "last Wednesday": "RELATIVE_PAST_WEDNESDAY",
}


# Slang by region and word, openers and fillers by style, neighbours on the keyboard.
REGIONAL_SLANG = {
    "US": {"expensive": "dropped a bag", "cheap": "dirt cheap", "spent": "blew through", "broke": "flat broke"},
    "UK": {"expensive": "splashed out", "cheap": "cheap as chips", "spent": "sank", "broke": "skint"},
    "IN": {"expensive": "bahut mehnga", "cheap": "sasta", "spent": "paisa uda diya", "broke": "kangaal"},
    "NP": {"expensive": "dherai mahango", "cheap": "sasto", "spent": "kharcha gariyo", "broke": "rupee nai chaina"},
    "UAE": {"expensive": "pricey", "cheap": "steal", "spent": "spent", "broke": "empty pocket"},
    "AU": {"expensive": "cost an arm and a leg", "cheap": "bargain", "spent": "forked out", "broke": "stoked"},
    "CA": {"expensive": "cost a fortune eh", "cheap": "a steal eh", "spent": "dropped a bunch on", "broke": "tapped out"},
}
STYLES = {
    "CONVERSATIONAL": (["Hey so", "You know what", "Actually", "I was thinking", "Quick question,", "By the way", "Listen,"], ["um", "uh", "like", "basically", "sort of", "you know", "I guess"]),
    "BANKING": (["Regarding the", "Please process", "Notice of", "Reference number", "In accordance with"], ["debit transaction", "ACH credit", "ledger entry", "cleared funds", "settlement"]),
    "INFORMAL": (["Yo", "Listen", "Omg", "Wait,", "Guess what"], ["lol", "maybe", "idk", "just", "imo", "fr"]),
    "PROFESSIONAL": (["I would like to", "Please initiate", "Kindly review", "I am writing to report"], ["as per the agreement", "correspondingly", "effective immediately", "per my records"]),
    "URGENT": (["Help!", "Urgent:", "Quick!", "I need this now", "Wait a second"], ["immediately", "right away", "asap", "emergency"]),
    "DIRECT": ([], []),
}
NEIGHBOURS = {"a": "sqwz", "e": "wrsd", "i": "uokj", "o": "iplk", "u": "yijh", "t": "rygf", "s": "adwzx", "m": "njk,", "n": "bmhj"}


def amount_surface(symbol: Column, *key: Column | str) -> Column:
    """A drawn amount in a region's currency: a fifth are large, a third have cents; symbol before or behind, a word, thousands as `k`, or bare.

    Thousands are rounded to a tenth, halves up. A region without a symbol (empty or null) has bare amounts in its place.
    """
    low, symbol = draw(*key, "large") < 0.2, F.coalesce(symbol, F.lit(""))
    whole = F.when(low, F.lit(100000) + F.floor(draw(*key, "value") * 9000000)).otherwise(F.lit(10) + F.floor(draw(*key, "value") * 9000))
    cents = F.when(draw(*key, "has_cents") < 0.3, F.floor(draw(*key, "cents") * 99)).otherwise(F.lit(0))
    start = F.struct(whole.cast("bigint").alias("whole"), cents.cast("bigint").alias("cents"), draw(*key, "form").alias("form"))

    def formed(x: Column) -> Column:
        raw = F.concat(x["whole"].cast("string"), F.when(x["cents"] == 0, "").otherwise(F.regexp_replace(F.concat(F.lit("."), F.lpad(x["cents"].cast("string"), 2, "0")), "0$", "")))
        tenths = F.floor((x["whole"] * 100 + x["cents"] + 5000) / 10000)
        short = F.concat(F.floor(tenths / 10).cast("string"), F.lit("."), F.pmod(tenths, F.lit(10)).cast("string"), F.lit("k"))
        words = F.concat(raw, F.lit(" "), pick(list(AMOUNT_WORDS), *key, "which"))
        form = x["form"]
        return F.trim(F.when(form < 0.2, F.concat(symbol, raw)).when(form < 0.4, F.concat(raw, F.lit(" "), symbol)).when(form < 0.6, words).when((form < 0.8) & (x["whole"] >= 1000), short).otherwise(raw))

    return F.get(F.transform(F.array(start), formed), 0)


def slot_generators(symbol: str, relative: dict[str, str] | None = None) -> dict[str, Generator]:
    """Generators of the slots that no pool has: amounts in the currency of column `symbol`, and dates."""
    date = lambda *key: date_text(relative or RELATIVE_DATES, *key)["surface"]
    return {"amount": lambda *key: amount_surface(F.col(symbol), *key), "date": date, "targetdate": date}


def register_slot(spark: SparkSession, slot: str, expression: str) -> Generator:
    """A slot of the caller's own: `expression` is SQL over `k`, the parts of a draw joined by |; slot_draw(k) is the draw's number in [0, 1).

    It becomes a SQL function slot_<name>(k) of the session, and a generator for templates.
    """
    if not re.fullmatch("[a-z][a-z0-9_]*", slot) or slot == "draw":
        raise ValueError(f"{slot!r} can't be the name of a slot")
    spark.sql("CREATE OR REPLACE TEMPORARY FUNCTION slot_draw(k STRING) RETURNS DOUBLE RETURN CAST(conv(substr(md5(k), 1, 8), 16, 10) AS BIGINT) / 4294967296D")
    spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION slot_{slot}(k STRING) RETURNS STRING RETURN {expression}")
    return lambda *key: F.call_function(f"slot_{slot}", F.concat_ws("|", *(p.cast("string") if isinstance(p, Column) else F.lit(p) for p in key)))


def date_text(relative: dict[str, str], *key: Column | str) -> Column:
    """struct(surface, value): half relative words with their symbolic value, else a day of three years in one of three layouts."""
    words = list(relative)
    table = F.create_map(*(F.lit(x) for kv in relative.items() for x in kv))
    word = pick(words, *key, "word")
    day = F.make_date(F.lit(2024) + F.floor(draw(*key, "year") * 3).cast("int"), F.lit(1) + F.floor(draw(*key, "month") * 12).cast("int"), F.lit(1) + F.floor(draw(*key, "day") * 28).cast("int"))
    layout = draw(*key, "layout")
    surface = F.when(layout < 0.3, F.date_format(day, "dd/MM/yyyy")).when(layout < 0.6, F.date_format(day, "dd-MM-yyyy")).otherwise(F.date_format(day, "yyyy-MM-dd"))
    near = draw(*key, "near") < 0.5
    return F.struct(F.when(near, word).otherwise(surface).alias("surface"), F.when(near, table[word]).otherwise(F.date_format(day, "yyyy-MM-dd")).alias("value"))


def negatives(rows: DataFrame, base: list[str], i: str = "i") -> DataFrame:
    """(i, text): base sentences in turn, changed by the remainder of i: case by 3, a prefix by 4, a mark by 5."""
    n = F.col(i)
    text = F.element_at(F.array(*map(F.lit, base)), (F.pmod(n, F.lit(len(base))) + 1).cast("int"))
    text = F.when(F.pmod(n, F.lit(3)) == 0, F.upper(text)).when(F.pmod(n, F.lit(3)) == 1, F.concat(F.upper(F.substring(text, 1, 1)), F.substring(text, F.lit(2), F.length(text)))).otherwise(text)
    text = F.when(F.pmod(n, F.lit(4)) == 0, F.concat(F.lit("please "), text)).otherwise(text)
    return rows.select(i, F.when(F.pmod(n, F.lit(5)) == 0, F.concat(text, F.lit("?"))).otherwise(text).alias("text"))


def distinct_target(candidates: DataFrame, target: int, group: list[str], attempt: str, text: str) -> DataFrame:
    """(group, attempt, text): the first `target` different texts of a group, apart from case, by attempt."""
    first = candidates.groupBy(*group, F.lower(text).alias("__k")).agg(F.min(F.struct(attempt, text)).alias("m"))
    ranked = first.withColumn("__r", F.row_number().over(Window.partitionBy(*group).orderBy("m"))).where(F.col("__r") <= target)
    return ranked.select(*group, f"m.{attempt}", f"m.{text}")


def in_own_style(text: Column, styles: dict[str, tuple[list[str], list[str]]], *key: Column | str) -> Column:
    """The text in a drawn style of (openers, fillers): one of its openers before it, and behind half of the texts one of its fillers; a style without openers leaves it."""
    style, out = pick(list(styles), *key, "style"), text
    for name, (openers, fillers) in styles.items():
        if openers:
            filler = F.when(draw(*key, "filler") < 0.5, F.concat(F.lit(" "), pick(fillers, *key, "which"))).otherwise("")
            out = F.when(style == name, F.concat(pick(openers, *key, "opener"), F.lit(" "), text, filler)).otherwise(out)
    return out


CHUNK = 10_000  # attempts that one row unfolds to


def sampled_in_rounds(groups: DataFrame, attempts: Callable[[DataFrame], DataFrame], group: list[str], cap: int = 40, target: str = "target", text: str = "text") -> tuple[DataFrame, int]:
    """((columns of `attempts`) of the first `target` different texts of every group by attempt, number of rounds).

    `attempts` makes rows (group, attempt, text, ...) of rows (group, attempt) and more columns of `groups`; it may leave some out. Texts are
    the same apart from case. In every round only groups that are short of their target draw again, twice what
    they lack or five times as often as before, up to `cap` times the target in all; accepted texts are the state, a table that
    grows by each round's.
    """
    spark = groups.sparkSession
    folder, rounds = scratch(spark, "rounds"), 0
    open_ = groups.withColumns({"__done": F.lit(0).cast("bigint"), "__need": F.col(target).cast("bigint")}).where(f"__need > 0 and {cap} > 0")
    most = F.col(target).cast("bigint") * cap
    accepted: DataFrame | None = None
    while not open_.isEmpty():
        stop = F.least(most, F.col("__done") + F.greatest(F.col("__need") * 2, F.col("__done") * 5, F.lit(16)))
        drawing = open_.withColumn("__stop", stop)
        chunks = drawing.withColumn("__from", F.explode(F.sequence("__done", F.col("__stop") - 1, F.lit(CHUNK).cast("bigint")))).repartition(*group, "__from")
        rows = chunks.withColumn("attempt", F.explode(F.sequence("__from", F.least(F.col("__from") + CHUNK, F.col("__stop")) - 1)))
        made = attempts(rows.drop("__from", "__done", "__stop", "__need"))
        columns = made.columns
        fresh = made.withColumn("__k", F.lower(text)).groupBy(*group, "__k").agg(F.min_by(F.struct(*(c for c in columns if c not in group)), "attempt").alias("m"))
        if accepted is not None:
            fresh = fresh.join(accepted.select(*group, F.lower(text).alias("__k")), [*group, "__k"], "left_anti")
        fresh = fresh.select(*group, "m.*").join(open_.select(*group, "__need"), group)
        ranked = fresh.withColumn("__r", F.row_number().over(Window.partitionBy(*group).orderBy("attempt"))).where("__r <= __need")
        ranked.select(*columns).write.parquet(f"{folder}/round={rounds}")
        accepted = spark.read.option("basePath", folder).schema(made.schema).parquet(folder).select(*columns)
        held = accepted.groupBy(*group).agg(F.count(F.lit(1)).alias("__held"))
        left = drawing.drop("__need").join(held, group, "left").withColumn("__need", F.col(target) - F.coalesce("__held", F.lit(0)))
        left = left.where((F.col("__need") > 0) & (F.col("__stop") < most)).withColumn("__done", F.col("__stop")).select(*open_.columns)
        left.write.parquet(f"{folder}-open/round={rounds}")
        open_ = spark.read.schema(left.schema).parquet(f"{folder}-open/round={rounds}")
        rounds += 1
    if accepted is None:
        accepted = attempts(groups.limit(0).withColumn("attempt", F.lit(0).cast("bigint")))
    return accepted, rounds


def spec_rows(specs: DataFrame, pool: DataFrame, seed: str, regions: dict[str, dict[str, str]], styles: dict[str, tuple[list[str], list[str]]], neighbours: dict[str, str], group: list[str], cap: int = 40) -> DataFrame:
    """(group, attempt, text, slots) of specs (group, patterns, target): utterances of a drawn pattern with slots filled, in a region's slang, in a style, with slips, as many different ones as the target or `cap` attempts for each allow."""

    path = scratch(specs.sparkSession, "pool")
    pool.write.parquet(path)  # every round reads it
    pool = specs.sparkSession.read.schema(pool.schema).parquet(path)

    # Expressions are the same in every round.
    key = (F.lit(seed), *(F.col(k) for k in group), F.col("attempt"))
    pattern = F.element_at("patterns", (F.floor(draw(*key, "pattern") * F.size("patterns")) + 1).cast("int"))
    in_slang = regional_slang(F.col("text"), pick(list(regions), *key, "region"), regions, *key)
    in_style, slipped = in_own_style(F.col("text"), styles, *key), slips(F.col("text"), neighbours, *key)

    def attempts(rows: DataFrame) -> DataFrame:
        filled = fill_slots(rows.select(*group, "attempt", pattern.alias("template")), pool, seed, "template", *group, "attempt", reject=True)
        return filled.withColumn("text", in_slang).withColumn("text", in_style).withColumn("text", slipped).select(*group, "attempt", "text", "slots")

    return sampled_in_rounds(specs, attempts, group, cap)[0]


def synthesised(templates: DataFrame, pool: DataFrame, seed: str, target: int, attempts: int) -> DataFrame:
    """(id, intent, text, slots, split) of templates (intent, pos, template): up to `target` different texts an intent.

    Attempt number a takes the intent's template a in turn and draws its slots. A text belongs to the first intent, then the
    first attempt, that draws it, whatever its place among the target; a draw per row splits 80 to 10 to 10.
    """
    turns = round_robin(templates, attempts, ["intent"]).withColumnRenamed("i", "attempt")
    drawn = fill_slots(turns, pool, seed, "template", "intent", "attempt")
    own = drawn.groupBy("text").agg(F.min(F.struct("intent", "attempt", "slots")).alias("m")).select("m.*", "text")
    ranked = own.withColumn("n", F.row_number().over(Window.partitionBy("intent").orderBy("attempt")) - 1).where(F.col("n") < target)
    roll = draw(F.lit(seed), F.lit("split"), F.col("intent"), F.col("n"))
    split = F.when(roll < 0.8, "train").when(roll < 0.9, "val").otherwise("test")
    return ranked.select(F.concat(F.substring("intent", 1, 3), F.lit("_"), F.col("n").cast("string")).alias("id"), "intent", "text", "slots", split.alias("split"))


def first_replaced(mark: str, value: Column) -> Callable[[Column], Column]:
    """A function that puts the value in place of a text's first mark."""

    def put(text: Column) -> Column:
        at = F.instr(text, mark)
        return F.when(at > 0, F.concat(F.substring(text, F.lit(1), at - 1), value, F.substring(text, at + len(mark), F.length(text)))).otherwise(text)

    return put


def expanded(rows: DataFrame, templates: list[str], values: dict[str, list[str]], fillers: list[str], *key: Column | str, text: str = "text") -> DataFrame:
    """Adds a text per row: a drawn template with the first mark of every slot replaced, a filler behind a fifth, a fifth in lower case."""
    out = pick(templates, *key, "template")
    for slot, listed in values.items():
        out = F.get(F.transform(F.array(out), first_replaced("{" + slot + "}", pick(listed, *key, slot))), 0)
    out = F.when(draw(*key, "filler") > 0.8, F.concat(out, F.lit(" "), pick(fillers, *key, "which"))).otherwise(out)
    return rows.withColumn(text, F.when(draw(*key, "lower") > 0.8, F.lower(out)).otherwise(out))


def currency_of(rows: DataFrame, symbols: dict[str, str], region: str, out: str = "symbol") -> DataFrame:
    """Adds the region's currency symbol, empty for a region without one."""
    table = F.create_map(*(F.lit(x) for kv in symbols.items() for x in kv))
    return rows.withColumn(out, F.coalesce(F.try_element_at(table, F.col(region)), F.lit("")))
