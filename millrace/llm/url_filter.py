"""URL filter: host and path rules before gradient-boosted trees on lexical features.

Everything on the path of the data is DataFrame and SQL expressions. The trees learn from labelled URLs; callers pass
their own table of url and label, and `labelled_urls` makes one by rule: there is no public labelled list here, so
shapes known from spam and phishing (hyphenated offers, random names, long chains of subdomains, click and redirect
addresses) stand against shapes of ordinary sites, with chance deciding about each part, so that every shape has
counterexamples. Features: lengths, depth of path and host, digit ratio, entropy, parameter counts, and suffix
statistics: the smoothed share of blocked URLs among the labelled ones with the same zone, the same last word
and the same last three letters of the site name. While learning, a URL's suffix statistics leave out its own fold, so
the trees don't see a label through them.

Defined results: a null url, or one without `://`, has an empty host and path and no rule; it is scored like any
other. Ties between equally long rules go to the block rule. Repeated rows are judged one by one; an empty table
gives an empty result; further columns are ignored unless asked for, and may carry any name. Without labelled URLs of
both labels there are no trees and every score is the labels' mean, 0.5 if there is none.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Model
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import LOWER, ascii_lower, table, written

#: (host, path, verdict): what `judge` goes by where it is given no rules.
RULES = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "block"), ("example.net", "/de/8", "allow"), ("org", "/es/", "block"))
#: The rules that the query's contract fixes.
QUERY_RULES = (("com", "/en/", "block"), ("example.com", "/en/7", "allow"), ("net", "/de/", "allow"), ("example.net", "/de/8", "block"), ("org", "/es/", "block"))

#: Words that are common in names of blocked sites, and in names of ordinary ones.
BLOCKED_WORDS = tuple("account adult bank bets bonus cash casino cheap click crypto dating deal earn fast free gift hot jackpot loan login lottery meds offer pay payday pills poker prize promo replica secure slots spam torrent update verify viagra warez winner".split())
PLAIN_WORDS = tuple("archive art atlas bakery bird book bridge chess church city coast culture data energy family field film forest forum garden green harbour health history journal kitchen library light market museum music north ocean open press river school science society studio theatre town travel union village water weather".split())
#: Zones, with how many of a hundred blocked and ordinary URLs have them.
ZONES = {"com": (34, 42), "net": (10, 9), "org": (5, 17), "info": (12, 2), "biz": (8, 1), "xyz": (9, 1), "top": (9, 1), "ru": (6, 2), "co.uk": (3, 8), "de": (2, 9), "edu": (1, 5), "gov": (1, 3)}
PATH_WORDS = tuple("about blog category contact events index news page post products reviews shop story tag topic view".split())
CLICK_WORDS = tuple("click confirm download go gate out promo redirect signin track verify win".split())
#: Labels below which names are given out, as under a top-level domain.
SECOND_LEVEL = ("example", "co", "com", "org", "net", "ac", "gov", "edu")

FOLDS = 5
FEATURES = ("url_length", "host_length", "path_length", "path_depth", "host_depth", "name_words", "digit_ratio", "host_digit_ratio", "entropy", "params", "zone_rate", "word_rate", "ending_rate")
PRIOR = 4.0  # labelled URLs' worth of the overall share that each suffix statistic starts from
SUFFIXES = ("zone", "word", "ending")
MAX_RULES_INLINE = 256


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"^(?s).*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s).*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def labelled_urls(spark: SparkSession, n: int = 6000, seed: int = 0, blocked_words: Sequence[str] = BLOCKED_WORDS, plain_words: Sequence[str] = PLAIN_WORDS) -> DataFrame:
    """(url, label): n URLs made by rule, half of them with label 1 (block)."""
    number = lambda salt, most: F.pmod(F.xxhash64("id", F.lit(f"{seed} {salt}")), F.lit(most))
    word = lambda words, salt: F.element_at(F.array(*map(F.lit, words)), (number(salt, len(words)) + 1).cast("int"))
    bad = F.col("label") == 1
    chance = lambda salt, blocked, plain: number(salt, 100) < F.when(bad, F.lit(blocked)).otherwise(F.lit(plain))
    letters = lambda salt, length, base: F.substring(F.translate(F.conv(F.hex(F.abs(F.xxhash64("id", F.lit(f"{seed} {salt}")))), 16, base), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", LOWER), 2, length)
    syllables = lambda salt: F.concat(*(F.concat(word("bcdfghklmnprstvw", f"{salt}{k}c"), word("aeiou", f"{salt}{k}v")) for k in range(3)))
    common = F.when(bad, word(blocked_words, "w1")).otherwise(word(plain_words, "w1"))
    second = F.when(chance("mix", 25, 25), syllables("s")).when(bad, word(blocked_words, "w2")).otherwise(word(plain_words, "w2"))
    year = F.concat(F.lit("/"), (number("year", 24) + 2001).cast("string"), F.when(chance("month", 50, 60), F.concat(F.lit("/"), F.lpad((number("m", 12) + 1).cast("string"), 2, "0"))).otherwise(""))
    shape = number("shape", 100)
    name = (
        F.when(shape < 30, F.concat(common, F.when(chance("hyphen", 80, 45), "-").otherwise(""), second)).when(shape < 45, F.concat(common, F.when(chance("many", 60, 10), F.concat(F.lit("-"), second, F.lit("-"), word(blocked_words, "w3"))).otherwise(second)))
        .when(shape < 70, F.when(chance("random", 70, 8), letters("r", 14, 36)).otherwise(syllables("n"))).when(shape < 85, F.concat(common, F.when(chance("digits", 60, 10), letters("d", 4, 10)).otherwise(""))).otherwise(syllables("o"))
    )
    total = [sum(x[k] for x in ZONES.values()) for k in (0, 1)]
    zone, at = F.lit("com"), [0, 0]
    pick = F.when(bad, number("zone", total[0])).otherwise(number("zone", total[1]))
    for z, share in ZONES.items():
        zone = F.when((pick >= F.when(bad, F.lit(at[0])).otherwise(F.lit(at[1]))) & (pick < F.when(bad, F.lit(at[0] + share[0])).otherwise(F.lit(at[1] + share[1]))), z).otherwise(zone)
        at = [at[0] + share[0], at[1] + share[1]]
    below = F.when(chance("www", 20, 45), "www.").when(chance("sub", 35, 12), F.concat(word((*CLICK_WORDS, *PATH_WORDS), "sub1"), F.lit("."), F.when(chance("sub2", 50, 5), F.concat(letters("sub3", 5, 36), F.lit("."))).otherwise(""))).otherwise("")
    part = lambda k: F.when(chance(f"part{k}", 65 - 15 * k, 80 - 25 * k), F.concat(F.lit("/"), F.when(chance(f"click{k}", 55, 5), word(CLICK_WORDS, f"p{k}")).when(chance(f"slug{k}", 20, 45), F.concat(word(plain_words, f"q{k}"), F.lit("-"), syllables(f"q{k}"))).otherwise(word(PATH_WORDS, f"p{k}")))).otherwise("")
    token = F.when(chance("token", 40, 8), F.concat(F.lit("/"), letters("t", 12, 16))).when(chance("id", 15, 30), F.concat(F.lit("/"), number("idn", 9999).cast("string"))).otherwise("")
    end = F.when(chance("end", 25, 45), word((".html", "/", ".htm", ""), "ends")).when(chance("php", 25, 6), ".php").otherwise("")
    pair = lambda k: F.concat(word(("id", "ref", "q", "page", "src", "uid", "aff", "lang"), f"key{k}"), F.lit("="), F.when(chance(f"long{k}", 55, 10), letters(f"v{k}", 11, 16)).otherwise(number(f"v{k}", 99).cast("string")))
    query = F.when(chance("query", 55, 22), F.concat(F.lit("?"), pair(0), *(F.when(chance(f"more{k}", 60, 18), F.concat(F.lit("&"), pair(k))).otherwise("") for k in (1, 2, 3)))).otherwise("")
    url = F.concat(F.when(chance("tls", 45, 75), "https://").otherwise("http://"), below, name, F.lit("."), zone, F.when(chance("dated", 8, 30), year).otherwise(""), part(0), part(1), part(2), token, end, query)
    return spark.range(n).select("id", F.pmod(F.col("id"), F.lit(2)).cast("double").alias("label")).select(url.alias("url"), "label")


def lexical(df: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds the features that need only the URL, and the three suffixes."""
    url = F.coalesce(F.col(url_col), F.lit(""))
    df = df.withColumns({"__host": host_of(url), "__path": path_of(url), "__url": url})
    share = lambda text, pattern: F.length(F.regexp_replace(text, pattern, "")) / F.greatest(F.length(text), F.lit(1))
    chars = F.array_distinct(F.split("__host", ""))
    size = F.greatest(F.length("__host"), F.lit(1)).cast("double")
    entropy = F.aggregate(F.filter(chars, lambda c: c != ""), F.lit(0.0), lambda a, c: a - (F.length("__host") - F.length(F.replace(F.col("__host"), c))) / size * F.log2((F.length("__host") - F.length(F.replace(F.col("__host"), c))) / size))
    query = F.regexp_extract("__url", r"\?([^#]*)", 1)
    labels = F.split("__host", r"\.")
    # The site's own name: the label before a one- or two-label zone, else the host.
    double = (F.size(labels) >= 3) & F.get(labels, F.size(labels) - 2).isin(*SECOND_LEVEL)
    zone = F.when(double, F.concat_ws(".", F.element_at(labels, -2), F.element_at(labels, -1))).otherwise(F.element_at(labels, -1))
    name = F.coalesce(F.try_element_at(labels, F.when(double, F.lit(-3)).otherwise(F.lit(-2))), F.col("__host"))
    return df.withColumns({
        "url_length": F.length("__url").cast("double"), "host_length": F.length("__host").cast("double"), "path_length": F.length("__path").cast("double"),
        "path_depth": (F.length("__path") - F.length(F.replace(F.col("__path"), F.lit("/")))).cast("double"), "host_depth": F.size(labels).cast("double"),
        "name_words": F.size(F.split(name, "[-_]")).cast("double"), "digit_ratio": 1 - share(F.col("__url"), "[0-9]"), "host_digit_ratio": 1 - share(F.col("__host"), "[0-9]"),
        "entropy": entropy, "params": F.when(query == "", 0.0).otherwise(F.size(F.split(query, "[&;]")).cast("double")),
        "__zone": zone, "__word": F.element_at(F.split(name, "[-_]"), -1), "__ending": F.substring(name, -3, 3),
    })


class UrlModel:
    """Trees (None without labels of both kinds) and suffix statistics of one training."""

    def __init__(self, trees: Model | None, rates: dict[str, DataFrame], overall: float):
        self.trees, self.rates, self.overall = trees, rates, overall


def with_rates(df: DataFrame, rates: dict[str, DataFrame], overall: float) -> DataFrame:
    """Adds the suffix statistics; their tables have no more rows than there are labelled URLs."""
    for kind, rate in rates.items():
        df = df.join(F.broadcast(rate), f"__{kind}", "left").withColumn(f"{kind}_rate", F.coalesce(f"{kind}_rate", F.lit(overall)))
    return df


def train(labelled: DataFrame, max_iter: int = 12, max_depth: int = 4, max_rows: int = 20_000) -> UrlModel:
    """Fit on at most `max_rows` labelled rows (url, label), those with the smallest hashes; `max_rows` bounds the tables that are broadcast."""
    chosen = labelled.where("url is not null and label is not null").select("url", F.col("label").cast("double").alias("label")).orderBy(F.xxhash64("url"), "url", "label").limit(max_rows)
    rows = written(lexical(chosen).withColumn("fold", F.pmod(F.xxhash64("__host"), F.lit(FOLDS))), "labelled-urls")
    overall, kinds = rows.agg(F.avg("label"), F.countDistinct("label")).first()
    overall = 0.5 if overall is None else overall
    if kinds < 2:
        return UrlModel(None, {}, overall)
    rate = lambda label, n: (label + PRIOR * overall) / (n + PRIOR)
    rates = {kind: written(rows.groupBy(f"__{kind}").agg(rate(F.sum("label"), F.count(F.lit(1))).alias(f"{kind}_rate")), f"url-{kind}") for kind in SUFFIXES}
    # A row's own rates come from the other folds; a fold has all URLs of its hosts.
    every, own = (lambda kind: Window.partitionBy(f"__{kind}")), (lambda kind: Window.partitionBy(f"__{kind}", "fold"))
    rest = lambda kind, value: F.sum(value).over(every(kind)) - F.sum(value).over(own(kind))
    apart = rows.withColumns({f"{kind}_rate": rate(rest(kind, F.col("label")), rest(kind, F.lit(1.0))) for kind in SUFFIXES})
    data = VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(apart).select("features", "label").coalesce(1)
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=max_iter, maxDepth=max_depth, maxBins=32, minInstancesPerNode=10, seed=7).fit(data)
    return UrlModel(trees, rates, overall)


def score(df: DataFrame, model: UrlModel, url_col: str = "url") -> DataFrame:
    """Adds `url_score`, the probability that the URL is to be blocked."""
    kept = [F.col(c) for c in df.columns]
    if model.trees is None:
        return df.select(*kept, F.lit(float(model.overall)).alias("url_score"))
    full = with_rates(lexical(df.select(F.struct(*kept).alias("__row"), F.col(url_col).alias("__in")), "__in"), model.rates, model.overall)
    scored = model.trees.transform(VectorAssembler(inputCols=list(FEATURES), outputCol="features").transform(full))
    return scored.select("__row.*", vector_to_array("probability")[1].alias("url_score"))


def rule_for(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """struct(length, verdict, rule) of the longest rule that fits, or null."""
    if len(rules) > MAX_RULES_INLINE:
        raise ValueError(f"more than {MAX_RULES_INLINE} rules: use match_rules, which joins")
    fits = [F.when(((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p)), F.struct(F.lit(len(h) + len(p)).alias("n"), F.lit(v).alias("verdict"), F.lit(h + p).alias("rule"))) for h, p, v in rules]
    return F.greatest(*fits, F.lit(None).cast("struct<n:int,verdict:string,rule:string>"), F.lit(None).cast("struct<n:int,verdict:string,rule:string>"))


def match_rules(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, n, verdict, rule) for the distinct hosts and paths of `urls`; any number of rules (host, path, verdict), joined on host suffixes."""
    suffixes = F.transform(F.sequence(F.lit(0), F.size(F.split("host", r"\.")) - 1), lambda i: F.array_join(F.slice(F.split("host", r"\."), i + 1, F.size(F.split("host", r"\."))), "."))
    parts = urls.select("host", "path").distinct().withColumn("suffix", F.explode(suffixes))
    named = rules.select(F.col("host").alias("r_host"), F.col("path").alias("r_path"), "verdict")
    hits = parts.join(named, (F.col("suffix") == F.col("r_host")) & F.startswith(F.col("path"), F.col("r_path")))
    best = F.max(F.struct((F.length("r_host") + F.length("r_path")).alias("n"), "verdict", F.concat("r_host", "r_path").alias("rule")))
    return hits.groupBy("host", "path").agg(best.alias("b")).select("host", "path", "b.*")


def judge(urls: DataFrame, model: UrlModel, rules: Sequence[tuple[str, str, str]] = RULES, url_col: str = "url", threshold: float = 0.5) -> DataFrame:
    """Adds host, path, rule, verdict (the rule's, else the trees' at `threshold`) and url_score."""
    scored = score(urls, model, url_col)
    url = F.col(url_col)
    out = scored.withColumns({"host": host_of(url), "path": path_of(url)}).withColumn("__hit", rule_for(F.col("host"), F.col("path"), rules))
    return out.withColumns({"rule": F.col("__hit.rule"), "verdict": F.coalesce("__hit.verdict", F.when(F.col("url_score") >= threshold, "block").otherwise("allow"))}).drop("__hit")


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = train(labelled_urls(spark))
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages, model, QUERY_RULES).select("page_id", "host", "path", "rule", "verdict", F.round("url_score", 6).alias("url_score"))
