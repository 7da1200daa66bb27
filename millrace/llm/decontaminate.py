"""Benchmark decontamination by spaced seeds.

Fixed masks pick some of the tokens at every position and ignore the others; hashes of the picked tokens of test
items and of training texts are joined. A hit fixes an alignment of text and item without gaps, and every alignment is
verified once: it counts as an overlap if some window of `WINDOW` tokens (the whole item if that is shorter) has at
least `SHARE` equal tokens, so single substituted words don't hide a passage. The four masks together have a hit for
every placement of the substitutions that `SHARE` allows, in windows of 7 to 20 tokens, so no overlap is missed. Items of
fewer than `MIN_ITEM` tokens overlap where all of their tokens occur side by side; their one mask is the item itself.

All of it is DataFrame and SQL expressions. Seeds are rows of a hash and a place; texts' tokens never travel with them
but are read again for the alignments found. Seeds and alignments are broadcast while there are at most
`BROADCAST_SEEDS` of them, else joined by hash, with the same result.

Defined results: tokens are runs of letters and digits in lower case; texts that are null or have fewer tokens than an
item's window overlap with nothing; so do items without tokens; items with equal texts are each reported; repeated rows
with equal identifiers are reported once (`keep_clean` judges every row by its own text, whatever its identifier); empty
tables give an empty result; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import located, near, table, written

#: Offsets of the tokens that each mask picks; together they hit whatever substitutions SHARE allows.
MASKS = ((0, 1, 2, 3, 4), (0, 1, 2, 4, 5), (0, 1, 2, 3, 6), (0, 1, 3, 5, 6))
MIN_ITEM, WINDOW, SHARE = 7, 20, 0.8
BROADCAST_SEEDS = 500_000


def tokens(text: Column) -> Column:
    return F.array_remove(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), "")


def seed(words: Column, at: Column, mask: tuple[int, ...]) -> Column:
    """The hash of what the mask picks, null where it doesn't fit."""
    return F.when(at + mask[-1] < F.size(words), F.xxhash64(F.lit(",".join(map(str, mask))), *(F.get(words, at + k) for k in mask)))


def item_words(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item_id, item_hash, item_tokens, m) of the items that can overlap, without repeats."""
    rows = items.select(F.col(item_col).alias("item_id"), tokens(F.col(text_col)).alias("item_tokens")).where(F.size("item_tokens") > 0)
    return rows.withColumns({"item_hash": F.xxhash64("item_tokens"), "m": F.size("item_tokens")}).distinct()


def item_seeds(words: DataFrame, short: list[int]) -> DataFrame:
    """(item_id, item_hash, m, item_at, first, second, seed): every position and mask of every item, one seed for items under MIN_ITEM tokens."""
    w, at, m = F.col("item_tokens"), F.col("item_at"), F.col("m")
    rows = words.withColumn("item_at", F.explode(F.when(m < MIN_ITEM, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), m - 1))))
    seeds = [F.when(m >= MIN_ITEM, seed(w, at, mask)) for mask in MASKS] + [F.when(m == k, seed(w, at, tuple(range(k)))) for k in short]
    rows = rows.withColumns({"first": F.get(w, at), "second": F.get(w, at + 1), "seeds": F.array(*seeds)})
    return rows.select("item_id", "item_hash", "m", "item_at", "first", "second", F.explode("seeds").alias("seed")).where("seed is not null")


def best_window(equal: Column, size: Column) -> Column:
    """The largest number of true values in any window of `size` places."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(equal) - size + 1, F.lit(1)))
    return F.array_max(F.transform(starts, lambda k: F.size(F.filter(F.slice(equal, k, size), lambda x: x))))


def runs(rows: DataFrame, keys: list[str], at: str) -> DataFrame:
    """(keys, begin, length): the runs of places that follow each other, of all rows with equal keys."""
    numbered = rows.withColumn("__run", F.col(at) - F.row_number().over(Window.partitionBy(*keys).orderBy(at)))
    return numbered.groupBy(*keys, "__run").agg(F.min(at).alias("begin"), F.count(F.lit(1)).cast("int").alias("length")).drop("__run")


def aligned_overlaps(placed: DataFrame, items: DataFrame, text_col: str, item_col: str, item_text_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """(kept columns, __at_file, __at_row, item_id, start, window_size, matched): every alignment of a located text and an item that is an overlap."""
    known = written(item_words(items, item_col, item_text_col), "items")
    short = sorted(r.m for r in known.where(F.col("m") < MIN_ITEM).select("m").distinct().collect())
    seeds = written(item_seeds(known, short), "item-seeds")
    # Every mask picks the first two tokens (one-token items have no second), so most places go before any seed is made.
    pick = ["first"] if 1 in short else ["first", "second"]
    begins = written(seeds.select(F.xxhash64(*pick).alias("begin")).distinct(), "begins")
    words = placed.select(F.xxhash64("__at_file", "__at_row").alias("place"), tokens(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    places = words.withColumn("at", F.explode(F.sequence(F.lit(0), F.size("w") - 1))).withColumn("begin", F.xxhash64(*(F.get("w", F.col("at") + k) for k in range(len(pick)))))
    hashes = F.array(*(seed(F.col("w"), F.col("at"), mask) for mask in dict.fromkeys([*MASKS, *(tuple(range(k)) for k in short)])))
    if begins.count() <= BROADCAST_SEEDS:  # all in one stage: seeds are made only where one can begin
        found = places.join(F.broadcast(begins), "begin", "left_semi").select("place", "at", F.explode(hashes).alias("seed"))
    else:  # seeds are made first, so that no shuffle carries a text's tokens
        found = places.select("place", "at", "begin", hashes.alias("seeds")).join(begins, "begin", "left_semi").select("place", "at", F.explode("seeds").alias("seed"))
    found = found.where("seed is not null")
    # Of n and m places with one seed side by side, n + m - 1 alignments come, not n * m: runs of places are joined.
    found = found.join(near(seeds.select("seed").distinct(), BROADCAST_SEEDS), "seed", "left_semi")
    there = runs(found, ["place", "seed"], "at").select("place", "seed", F.col("begin").alias("t"), F.col("length").alias("tn"))
    here = written(runs(seeds, ["item_id", "item_hash", "m", "seed"], "item_at"), "item-runs").select("item_id", "item_hash", "m", "seed", F.col("begin").alias("k"), F.col("length").alias("kn"))
    pairs = there.join(near(here, BROADCAST_SEEDS), "seed")
    offsets = F.sequence(F.col("t") - F.col("k") - F.col("kn") + 1, F.col("t") - F.col("k") + F.col("tn") - 1)
    hits = written(pairs.select("place", "item_id", "item_hash", "m", F.explode(offsets).alias("offset")).distinct(), "alignments")
    # Tokens of the texts and items that have hits.
    texts = placed.withColumn("place", F.xxhash64("__at_file", "__at_row")).join(near(hits.select("place").distinct(), BROADCAST_SEEDS), "place", "left_semi")
    texts = texts.select(*keep, "__at_file", "__at_row", "place", tokens(F.col(text_col)).alias("w"))
    texts = written(texts, "texts-with-hits")
    m, offset = F.col("m"), F.col("offset")
    low, size = F.greatest(offset, F.lit(0)), F.least(m, F.lit(WINDOW))
    both = texts.join(near(hits, BROADCAST_SEEDS), "place")
    high = F.least(F.size("w"), offset + m)
    there = both.where(high - low >= size).select(*keep, "__at_file", "__at_row", "item_id", "item_hash", low.alias("start"), (low - offset).alias("item_start"), size.alias("window_size"), F.slice("w", low + 1, high - low).alias("there"))
    same_item = F.col("t.item_id").eqNullSafe(F.col("k.item_id")) & (F.col("t.item_hash") == F.col("k.item_hash"))
    full = there.alias("t").join(near(known, BROADCAST_SEEDS // WINDOW).alias("k"), same_item).select("t.*", "k.m", F.slice("k.item_tokens", F.col("item_start") + 1, F.size("there")).alias("here"))
    least = F.when(F.col("m") < MIN_ITEM, F.col("m")).otherwise(F.ceil(F.col("window_size") * SHARE)).cast("int")
    checked = full.withColumn("equal", F.zip_with("there", "here", lambda a, b: a == b)).withColumn("total", F.size(F.filter("equal", lambda x: x)))
    # Windows are looked at where the whole alignment doesn't decide.
    matched = F.when(F.col("total") < least, F.col("total")).when(F.col("total") == F.size("equal"), F.col("window_size")).otherwise(best_window(F.col("equal"), F.col("window_size")))
    checked = checked.withColumn("matched", matched)
    return checked.where(F.col("matched") >= least).select(*keep, "__at_file", "__at_row", "item_id", "start", "window_size", "matched")


def overlaps(docs: DataFrame, items: DataFrame, doc_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(doc_id, item_id, start, window_size, matched): one row per text and item that overlap; the best alignment, then the first."""
    placed = located(docs.select(F.col(doc_col).alias("doc_id"), F.col(text_col).alias("__text")))
    good = aligned_overlaps(placed, items, "__text", item_col, item_text_col, ("doc_id",))
    best = F.max(F.struct("matched", (-F.col("start")).alias("s"), "window_size"))
    return good.groupBy("doc_id", "item_id").agg(best.alias("b")).select("doc_id", "item_id", (-F.col("b.s")).alias("start"), F.col("b.window_size").alias("window_size"), F.col("b.matched").alias("matched"))


def keep_clean(docs: DataFrame, items: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """The rows of `docs` that overlap with no item."""
    placed = located(docs)
    leaks = written(aligned_overlaps(placed.select(F.col(text_col).alias("__text"), "__at_file", "__at_row"), items, "__text", item_col, item_text_col).select("__at_file", "__at_row").distinct(), "leaks")
    return placed.join(near(leaks, BROADCAST_SEEDS // 2), ["__at_file", "__at_row"], "left_anti").select(*docs.columns)


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: Without seeds: with as many substitutions as are allowed, some three tokens side by side are equal, so all alignments
#: that share a run of three (short items: that are equal) are compared.
ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS w FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\p{L}\p{N}]+'), lambda x: x <> '') AS v FROM benchmark),
dp AS (SELECT doc_id, w, p, array_to_string(w[p + 1:p + 3], ' ') AS g FROM (SELECT doc_id, w, unnest(range(0, len(w) - 2)) AS p FROM d)),
bp AS (SELECT item_id, v, p, array_to_string(v[p + 1:p + 3], ' ') AS g FROM (SELECT item_id, v, unnest(range(0, len(v) - 2)) AS p FROM b WHERE len(v) >= 7)),
sd AS (SELECT doc_id, w, k, p, array_to_string(w[p + 1:p + k], ' ') AS g FROM (SELECT doc_id, w, k, unnest(range(0, len(w) - k + 1)) AS p FROM d, (SELECT DISTINCT len(v) AS k FROM b WHERE len(v) BETWEEN 1 AND 6))),
h AS (SELECT doc_id, w, item_id, v, dp.p - bp.p AS o FROM dp JOIN bp USING (g)
      UNION ALL SELECT doc_id, w, item_id, v, p FROM sd JOIN b ON k = len(v) AND g = array_to_string(v, ' ')),
a AS (SELECT doc_id, item_id, greatest(o, 0) AS start, len(v) AS m, least(len(v), 20) AS win,
             [CASE WHEN w[o + 1 + i] = v[1 + i] THEN 1 ELSE 0 END FOR i IN range(greatest(-o, 0), least(len(v), len(w) - o))] AS eq FROM (SELECT DISTINCT * FROM h)),
c AS (SELECT doc_id, item_id, start, win, m, list_max([list_sum(eq[j:j + win - 1]) FOR j IN range(1, len(eq) - win + 2)]) AS matched FROM a WHERE len(eq) >= win),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, item_id ORDER BY matched DESC, start) AS n FROM c WHERE matched >= CASE WHEN m < 7 THEN m ELSE ceil(win * 0.8) END)
SELECT doc_id, item_id, CAST(start AS INTEGER) AS start, CAST(win AS INTEGER) AS "window_size", CAST(matched AS INTEGER) AS matched FROM r WHERE n = 1
"""
