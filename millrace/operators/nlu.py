"""Rule-based understanding of utterances: intents, routing, amounts, entities, affordability."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import MARKS
from ..sources.io import small
from .calibrate import let

# Intents in order, with weight and keywords.
INTENT_KEYWORDS = (
    ("AFFORDABILITY_CHECK", 1.5, ("afford", "buy", "purchase", "affordability", "safe to spend", "should i buy", "in that position", "can i get", "worth of", "how much is", "is it possible to buy", "position to")),
    ("ADD_EXPENSE", 1.2, ("spent", "paid", "dropped", "swiped", "charged", "groceries", "food", "coffee", "amazon", "purchase of", "bought")),
    ("ADD_INCOME", 1.2, ("salary", "credited", "received", "gig", "earn", "bonus", "make money", "income", "payroll", "dividend")),
    ("ADD_COMMITMENT", 1.2, ("emi", "recurring", "loan payment", "mortgage", "commitment", "ppf", "car payment", "monthly rent", "loan")),
    ("ADD_GOAL", 1.2, ("create goal", "goal", "saving target", "save for", "vacation goal", "stash goal")),
    ("UPDATE_GOAL_PROGRESS", 1.1, ("add", "contribute goal", "stash progress", "added to my goal", "goal saving progress")),
    ("CREATE_BUDGET", 1.2, ("budget", "limit", "cap", "ceiling", "set maximum", "restrict spend")),
    ("VIEW_SPENDING_ANALYSIS", 1.2, ("spending breakdown", "where did my money go", "analyze expenses", "spending patterns", "breakdown", "expense statement")),
    ("VIEW_CASHFLOW", 1.2, ("cashflow", "money leaves", "monthly cashflow", "flow status", "in and out", "net savings math")),
    ("VIEW_NET_WORTH", 1.2, ("net worth", "wealth balance", "networth", "total assets worth", "assets minus liabilities")),
    ("ADD_ASSET", 1.2, ("asset", "bought shares", "gold shares", "added stocks", "portfolio buy", "mutual fund investment")),
    ("ADD_LIABILITY", 1.2, ("liability", "student debt", "card debt", "credit card debt", "personal loan debt", "owe money")),
    ("SAVINGS_ADVICE", 1.1, ("savings advice", "save more", "savings tips", "budget cuts", "how to save", "reduce expenses")),
    ("FINANCIAL_HEALTH_CHECK", 1.2, ("sanity check", "health check", "rate my health", "how am i doing", "grade my finances", "health status")),
    ("VIEW_DASHBOARD", 1.1, ("dashboard", "snapshot", "summary board", "home panel", "show main view", "overview")),
)
# The words of each entity list, in order of precedence.
ENTITY_WORDS = (
    ("category", ("groceries", "food", "coffee", "transportation", "entertainment", "subscriptions", "utilities", "gas", "rent", "travel", "dining out")),
    ("merchant", ("walmart", "mcdonalds", "uber", "amazon", "netflix", "target", "costco", "starbucks", "apple", "spotify")),
    ("paymentMethod", ("credit card", "cash", "debit card", "paypal", "apple pay", "venmo", "upi")),
    ("date", ("today", "yesterday", "tomorrow", "june", "monday", "weekend", "week")),
    ("source", ("salary", "consulting job", "freelance gig", "google adsense", "side hustle")),
    ("frequency", ("monthly", "weekly", "annually", "yearly")),
    ("commitmentType", ("emi", "loan payment", "ppf", "car loan payment", "mortgage")),
    ("goalName", ("europe trip", "house savings", "emergency fund", "tesla fund", "retirement")),
    ("assetType", ("gold", "shares", "stocks", "cryptography", "bitcoin")),
)
# First word of a two-word phrase, its second, and the label.
PHRASES = (("consulting", "job", "source"), ("loan", "payment", "commitmentType"), ("europe", "trip", "goalName"))
# Names of things to buy, in order.
ITEM_NAMES = ("iphone 15", "macbook pro", "designer bag", "guitar", "rolex", "tesla", "car", "iphone", "apartment", "house", "luxury item")
CURRENCY_WORDS = ("lakh", "lac", "crore", "₹", "rs", "inr", "lacs")


def trie_pattern(keys: Iterable[str]) -> str:
    """A pattern of the keys as nested groups that share their beginnings: the longest key that begins at a place, found without trying each."""
    trie: dict = {}
    for key in keys:
        node = trie
        for c in key:
            node = node.setdefault(c, {})
        node[""] = {}

    def pattern(node: dict) -> str:
        branches = [re.escape(c) + pattern(child) for c, child in node.items() if c]
        if not branches:
            return ""
        inner = branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"
        return f"(?:{inner})?" if "" in node else inner

    return pattern(trie)


def keyword_counts(text: Column, lists: list[Iterable[str]]) -> Column:
    """array<bigint>: how often the keywords of each list occur in the text, overlapping ones too, in one pass over it.

    At every place the longest keyword is found; its beginnings that are keywords occur there as well.
    """
    own: dict[str, list[int]] = {}
    for place, keys in enumerate(lists):
        for k in keys:
            own.setdefault(k, [0] * len(lists))[place] += 1
    own.pop("", None)
    with_beginnings = {k: [sum(n) for n in zip(*(own[k[:i]] for i in range(1, len(k) + 1) if k[:i] in own), strict=True)] for k in own}
    constant = lambda x, kind: F.from_json(F.lit(json.dumps(x)), kind)
    table = constant(with_beginnings, "map<string, array<bigint>>")
    found = F.regexp_extract_all(text, F.lit(f"(?=({trie_pattern(own)}))"), F.lit(1))
    return F.aggregate(found, constant([0] * len(lists), "array<bigint>"), lambda held, k: F.zip_with(held, F.element_at(table, k), lambda a, b: a + b))


def intent_scores(text: Column, keywords=INTENT_KEYWORDS) -> Column:
    """array<struct<score, place, intent>> of intents with a score: weight times occurrences, overlapping ones too."""
    names, weights = F.array(*(F.lit(i) for i, _, _ in keywords)), F.array(*(F.lit(w) for _, w, _ in keywords))
    scored = F.transform(keyword_counts(text, [keys for _, _, keys in keywords]), lambda n, i: F.struct((n * F.get(weights, i)).alias("score"), (-i).alias("place"), F.get(names, i).alias("intent")))
    return F.filter(scored, lambda s: s["score"] > 0)


def intent_of(df: DataFrame, text: str, keywords=INTENT_KEYWORDS) -> DataFrame:
    """Adds intent, confidence, second and second_confidence; three overrides for plain phrases, and empty texts."""
    low = F.lower(F.trim(F.col(text)))
    ranked = df.withColumn("__low", low).withColumn("__scores", intent_scores(F.col("__low"), keywords)).withColumn("__first", F.array_max("__scores"))
    ranked = ranked.withColumn("__second", F.array_max(F.filter("__scores", lambda s: s["place"] != F.col("__first.place"))))
    first, second = F.col("__first"), F.col("__second")
    ranked = ranked.withColumns({"__i": F.coalesce(first["intent"], F.lit("UNKNOWN")), "__c": F.when(first.isNull(), 0.42).otherwise(F.least(F.lit(0.99), 0.45 + first["score"] * 0.15))})
    ranked = ranked.withColumns({"second": second["intent"], "second_confidence": F.when(second.isNotNull(), F.least(F.col("__c") - 0.05, 0.35 + second["score"] * 0.1))})
    holds = lambda *words: F.greatest(*(F.contains("__low", F.lit(w)).cast("int") for w in words)) == 1
    weak = (F.col("__i") == "UNKNOWN") | (F.col("__c") < 0.6)
    for words, intent, confidence in ((("spent", "paid", "groceries"), "ADD_EXPENSE", 0.95), (("salary", "credited", "earned"), "ADD_INCOME", 0.97)):
        hit = holds(*words) & weak
        ranked = ranked.withColumns({"__i": F.when(hit, intent).otherwise(F.col("__i")), "__c": F.when(hit, confidence).otherwise(F.col("__c"))})
        weak = (F.col("__i") == "UNKNOWN") | (F.col("__c") < 0.6)
    sure = holds("afford", "buy", "position", "safe to spend")
    ranked = ranked.withColumns({"__i": F.when(sure, "AFFORDABILITY_CHECK").otherwise(F.col("__i")), "__c": F.when(sure & (F.col("__c") < 0.7), 0.97).otherwise(F.col("__c"))})
    none = F.length("__low") == 0
    return ranked.withColumns({"intent": F.when(none, "UNKNOWN").otherwise(F.col("__i")), "confidence": F.when(none, 1.0).otherwise(F.col("__c"))}).drop("__low", "__scores", "__first", "__second", "__i", "__c")


def route(text: Column, hints: list[tuple[str, list[str]]], default: str) -> Column:
    """struct(sub_intent, matched): the first sub-intent in order that has a hint in the text, and all hints found."""
    low = F.lower(text)
    hits = let(low, lambda t: F.filter(F.array(*(F.when(F.contains(t, F.lit(h.lower())), F.struct(F.lit(p).alias("place"), F.lit(s).alias("sub"), F.lit(h).alias("hint"))) for p, (s, hs) in enumerate(hints) for h in hs)), lambda x: x.isNotNull()))
    none = F.struct(F.lit(default).alias("sub_intent"), F.array(F.lit("default")).alias("matched"))
    best = lambda found: F.get(found, 0)
    return let(hits, lambda found: F.when(F.size(found) == 0, none).otherwise(F.struct(best(found)["sub"].alias("sub_intent"), F.transform(F.filter(found, lambda x: x["place"] == best(found)["place"]), lambda x: x["hint"]).alias("matched"))))


def amount(text: Column) -> Column:
    """The first amount: lakhs, else crores, else thousands, else a plain number; null without any."""
    low = F.lower(F.trim(text))
    part = lambda p: F.nullif(F.regexp_extract(low, p, 1), F.lit(""))
    number = r"(\d+(?:\.\d+)?)\s*"
    return F.coalesce(
        part(number + "(?:lakhs?|lacs?)").cast("double") * 100000, part(number + "(?:crores?|cr)").cast("double") * 10000000, part(number + "(?:text-)?(?:k|thousand)").cast("double") * 1000,
        F.replace(part(r"(\d+(?:,\d+)*(?:\.\d+)?)"), F.lit(",")).cast("double"),
    )


def word_place(text: Column, part: Column) -> Column:
    """Place of the first word that holds the part, from 0; -1 without one."""
    words = F.split(F.lower(text), r"\s+")
    return (F.array_position(F.transform(words, lambda w: F.contains(w, part)), F.lit(True)) - 1).cast("int")


AMOUNT_SPANS = (  # pattern of an amount with its number, and how many words follow the number's
    (r"(\d+(?:\.\d+)?)\s*(?:lakhs?|lacs?)", 1),
    (r"(\d+(?:\.\d+)?)\s*(?:crores?|cr)", 1),
    (r"(\d+(?:\.\d+)?)\s*(?:text-)?(?:k|thousand)", 0),
    (r"(?:\$|₹|rs\.?|inr)?\s*(\d+(?:,\d+)*(?:\.\d+)?)\s*(?:bucks|euros|dollars)?", 0),
)


def span(first: Column, last: Column, text: Column, label: Column | str) -> Column:
    label = label if isinstance(label, Column) else F.lit(label)
    return F.struct(first.cast("int").alias("first"), last.cast("int").alias("last"), text.alias("text"), label.alias("label"))


def first_place(words: Column, hit: Callable[[Column], Column]) -> Column:
    """Place of the first word that fits, from 0; null without one."""
    return F.nullif(F.array_position(F.transform(words, hit), F.lit(True)), F.lit(0).cast("bigint")) - 1


def covering_spans(low: Column, words: Column, items: tuple[str, ...] = ITEM_NAMES) -> Column:
    """array<struct<first, last, text, label>>: the first amount of a lower-case text, and every item name that one of its words holds."""
    found = F.lit(None).cast("struct<text: string, number: string, more: int>")
    for pattern, more in reversed(AMOUNT_SPANS):
        here = F.struct(F.regexp_extract(low, pattern, 0).alias("text"), F.regexp_extract(low, pattern, 1).alias("number"), F.lit(more).alias("more"))
        found = F.when(low.rlike(pattern), here).otherwise(found)

    def amount_span(a: Column) -> Column:
        # Words are looked through for the number, without its commas too.
        at = F.coalesce(first_place(words, lambda w: F.contains(w, a["number"]) | F.contains(w, F.replace(a["number"], F.lit(","), F.lit("")))), F.lit(0))
        return F.when(a.isNotNull(), let(at, lambda k: span(k, k + a["more"], a["text"], "amount")))

    met = F.filter(F.array(*map(F.lit, items)), lambda item: F.contains(low, item))
    places = F.transform(met, lambda item: F.struct(first_place(words, lambda w: F.contains(w, item)).alias("at"), item.alias("item")))
    named = F.transform(F.filter(places, lambda p: p["at"].isNotNull()), lambda p: span(p["at"], p["at"], p["item"], "itemName"))
    return F.concat(F.filter(F.array(let(found, amount_span)), lambda x: x.isNotNull()), named)


def covers(spans: Column, place: Column) -> Column:
    return F.exists(spans, lambda s: place.between(s["first"], s["last"]))


def lexicon(spark: SparkSession, lists=ENTITY_WORDS, phrases=PHRASES, partial: str = "category", least: int = 4) -> DataFrame:
    """(clean, options): for every word that names an entity, array<struct<rank, label, following>> with the word that has to follow, if any.

    Words of the list `partial` are also met by parts of `least` letters at least.
    """
    options: dict[str, list[tuple]] = {}
    for rank, (label, names) in enumerate(lists):
        words = {n for n in names if " " not in n}
        if label == partial:
            words |= {n[i:j] for n in names for i in range(len(n)) for j in range(i + least, len(n) + 1) if " " not in n[i:j]}
        for word, following in [(w, None) for w in sorted(words)] + [(a, b) for a, b, to in phrases if to == label]:
            options.setdefault(word, []).append((rank, label, following))
    return spark.createDataFrame(list(options.items()), "clean string, options array<struct<rank: int, label: string, following: string>>")


def worded(df: DataFrame, text: str, *key: str) -> DataFrame:
    """(key, __low, __words, __clean, __spans): the text, its words, these without punctuation, and the spans that cover words."""
    rows = df.select(*key, F.col(text).alias("__text"), F.lower(F.trim(F.col(text))).alias("__low"))
    rows = rows.withColumns({"__words": F.filter(F.split("__text", r"\s+"), lambda w: w != ""), "__lower": F.split(F.lower("__text"), r"\s+")})
    clean = F.split(F.translate(F.lower(F.array_join("__words", " ")), MARKS, ""), " ")  # in one go; a word of marks alone stays, empty
    rows = rows.withColumns({"__clean": F.when(F.size("__words") > 0, clean).otherwise(F.array().cast("array<string>")), "__spans": covering_spans(F.col("__low"), F.col("__lower"))})
    return rows.drop("__text", "__lower")


def entities(df: DataFrame, text: str, *key: str, words: DataFrame | None = None) -> DataFrame:
    """(key, first, last, text, label): the amount, item names, and words of the lists that these don't cover, the first list that fits.

    `words` is a table like that of `lexicon`, of any size; words are joined to it.
    """
    rows = worded(df, text, *key)
    none = F.lit(None).cast("string")
    part = lambda s, clean, following: F.struct(*(s[c].alias(c) for c in ("first", "last", "text", "label")), clean.alias("clean"), following.alias("next"))
    covering = F.transform("__spans", lambda s: part(s, none, none))
    single = F.transform("__clean", lambda c, i: part(span(i, i, F.get("__words", i), none), c, F.lower(F.get("__words", i + 1))))
    open_ = F.filter(single, lambda p: ~covers(F.col("__spans"), p["first"]))
    parts = rows.select(*key, F.inline(F.concat(covering, open_)))
    table = F.broadcast(lexicon(df.sparkSession)) if words is None else small(words)
    # Options are in order of precedence.
    listed = F.get(F.filter("options", lambda o: o["following"].isNull() | o["following"].eqNullSafe(F.col("next"))), 0)["label"]
    found = parts.join(table, "clean", "left").withColumn("label", F.coalesce("label", listed))
    return found.where("label is not null").select(*key, "first", "last", "text", "label")


def phrase_spans(clean: Column, spans: Column, labels: dict[str, str]) -> Column:
    """array<struct<first, last, text, label>>: the phrases of whole words in a text's clean words, leftmost and then longest, none in a word that `spans` cover nor in another."""
    hidden = "\x00"
    line = F.concat(F.lit(" "), F.array_join(F.transform(clean, lambda w, i: F.when(covers(spans, i), hidden).otherwise(w)), " "), F.lit(" "))
    marked = F.regexp_replace(line, f"(?<= )({trie_pattern(labels)})(?= )", "\x01$1\x02")
    table = F.create_map(*(F.lit(x) for kv in labels.items() for x in kv))
    start = F.struct(F.lit(0).alias("place"), F.array().cast("array<struct<first: int, last: int, text: string, label: string>>").alias("found"))

    def step(held: Column, piece: Column) -> Column:
        """A piece is what stands behind a mark: a phrase, its end mark and the text up to the next one."""
        phrase = F.substring_index(piece, "\x02", 1)
        more = F.regexp_count(phrase, F.lit(" "))
        found = span(held["place"], held["place"] + more, phrase, F.element_at(table, phrase))
        return F.struct((held["place"] + F.regexp_count(piece, F.lit(" "))).cast("int").alias("place"), F.concat(held["found"], F.array(found)).alias("found"))

    def fold(pieces: Column) -> Column:
        before = F.struct((F.regexp_count(F.get(pieces, 0), F.lit(" ")) - 1).cast("int").alias("place"), start["found"].alias("found"))
        return F.aggregate(F.slice(pieces, F.lit(2), F.size(pieces)), before, step, lambda held: held["found"])

    return let(F.split(marked, "\x01"), fold)


def entity_phrases(df: DataFrame, text: str, *key: str, lists=(("itemName", ITEM_NAMES), *ENTITY_WORDS)) -> DataFrame:
    """(key, first, last, text, label): the amount, and phrases of one or more words of the lists, each word in one entity at most."""
    labels: dict[str, str] = {}
    for label, names in lists:
        for name in names:
            labels.setdefault(name, label)
    rows = worded(df, text, *key).withColumn("__spans", F.filter("__spans", lambda s: s["label"] == "amount"))
    return rows.select(*key, F.inline(F.concat("__spans", phrase_spans(F.col("__clean"), F.col("__spans"), labels))))


def affordability(text: Column, price: Column) -> Column:
    """struct(verdict, down_payment, monthly, health): against reserves in the currency that the text speaks of."""
    local = F.lower(text).rlike("|".join(map(re.escape, CURRENCY_WORDS)))

    def judged(x: Column) -> Column:
        price, reserves = x["price"], F.when(x["local"], 1200000.0).otherwise(60000.0)
        verdict = F.when(price <= 0, "NONE").when(price > reserves * 3.5, "DENIED").when(price > reserves * 0.7, "CAUTION").otherwise("APPROVED")
        return let(F.struct(verdict.alias("verdict"), price.alias("price"), F.when(x["local"], 0.021).otherwise(0.019).alias("factor")), terms)

    def terms(x: Column) -> Column:
        verdict, payable = x["verdict"], x["verdict"].isin("CAUTION", "APPROVED")
        health = F.when(verdict == "DENIED", -35).when(verdict == "CAUTION", -12).when(verdict == "APPROVED", 4).otherwise(0)
        return F.struct(verdict.alias("verdict"), F.when(payable, x["price"] * 0.2).alias("down_payment"), F.when(payable, F.floor(x["price"] * 0.8 * x["factor"] + 0.5).cast("bigint")).alias("monthly"), health.alias("health"))

    return let(F.struct(F.coalesce(price, F.lit(0.0)).alias("price"), local.alias("local")), judged)
