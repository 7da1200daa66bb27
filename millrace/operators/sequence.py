"""Vocabularies, encoding, padding, tagging and the two ways to decode BIO tags."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from ..functions.text import draw
from .audit import numbered

LENGTH = 24
PAD, UNKNOWN = 0, 1


def vocabulary(rows: DataFrame, tokens: str, *order: str) -> DataFrame:
    """(token, n, idx): tokens by falling count, ties by first occurrence in `order`; indices from 2.

    Only distinct tokens are ranked, not occurrences, and by ranges, so no task sees the whole vocabulary.
    """
    parts = rows.select(*order, F.posexplode(tokens).alias("pos", "token"))
    counted = parts.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*order, "pos")).alias("first"))
    ranked = numbered(counted.withColumn("falling", -F.col("n")), "falling", "first")
    return ranked.select("token", "n", (F.col("rn") + 1).alias("idx"))


def label_index(labels: DataFrame, column: str, start: int = 0) -> DataFrame:
    """(label, idx): distinct labels in lexical order."""
    return numbered(labels.select(F.col(column).alias("label")).distinct(), "label").select("label", (F.col("rn") - 1 + start).alias("idx"))


def padded(ids: Column, length: int = LENGTH) -> Column:
    return F.slice(F.concat(ids, F.array_repeat(F.lit(PAD).cast("bigint"), length)), 1, length)


def encode(rows: DataFrame, vocab: DataFrame, tokens: str, *key: str, length: int = LENGTH) -> DataFrame:
    """(key, ids): token indices, unknown ones 1, cut or padded to `length`. Tokens beyond it are cut before the join."""
    parts = rows.select(*key, F.posexplode(F.slice(F.col(tokens), 1, length)).alias("pos", "token"))
    found = parts.join(vocab.select("token", "idx"), "token", "left")
    gathered = found.groupBy(*key).agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", F.coalesce("idx", F.lit(UNKNOWN).cast("bigint")).alias("i")))), lambda s: s["i"]).alias("ids"))
    joined = rows.select(*key).join(gathered, list(key), "left")
    return joined.select(*key, padded(F.coalesce("ids", F.array().cast("array<bigint>")), length).alias("ids"))


def dropout(ids: Column, share: float, *key: Column | str) -> Column:
    """Ids with a share of those above 1 made unknown, by a draw per place; padding stays."""
    return F.transform(ids, lambda x, i: F.when((x != PAD) & (draw(*key, i) < share), F.lit(UNKNOWN).cast("bigint")).otherwise(x))


def tags_over_dropout(ids: Column, tags: Column) -> Column:
    """Tags in upper case, O where the token is unknown."""
    return F.zip_with(ids, tags, lambda i, t: F.when(i == UNKNOWN, F.lit("O")).otherwise(F.upper(t)))


def first_pad(ids: Column, length: int = LENGTH) -> Column:
    """The number of places before the first padding, 1 at least."""
    return F.greatest(F.lit(1), F.coalesce(F.nullif(F.array_position(ids, F.lit(PAD).cast("bigint")), F.lit(0)) - 1, F.lit(length))).cast("int")


def emit_tags(tokens: Column, slot: Column) -> Column:
    """B- for the first token, I- for the others; O for all without a slot."""
    return F.transform(tokens, lambda _, i: F.when(slot.isNull(), F.lit("O")).when(i == 0, F.concat(F.lit("B-"), F.upper(slot))).otherwise(F.concat(F.lit("I-"), F.upper(slot))))


def bio_rows(rows: DataFrame, tokens: str, tags: str, *key: str) -> DataFrame:
    return rows.select(*key, F.posexplode(F.arrays_zip(F.col(tokens).alias("token"), F.col(tags).alias("tag"))).alias("pos", "z")).select(*key, "pos", "z.token", "z.tag")


def decode_strict(rows: DataFrame, *key: str) -> DataFrame:
    """(key, start, end, label, text) of rows (key, pos, token, tag): B- opens; I- of the same label goes on; anything else ends, and a stray I- is dropped."""
    w = Window.partitionBy(*key).orderBy("pos")
    tag = F.col("tag")
    opened = rows.withColumn("run", F.sum(F.startswith(tag, F.lit("B-")).cast("int")).over(w)).where("run > 0").withColumn("label", F.substring(tag, F.lit(3), F.length(tag)))
    own = Window.partitionBy(*key, "run").orderBy("pos")
    inside = F.startswith(tag, F.lit("B-")) | (F.startswith(tag, F.lit("I-")) & (F.col("label") == F.first("label").over(own)))
    unbroken = opened.withColumn("broken", F.max((~inside).cast("int")).over(own)).where("broken = 0")
    return spans(unbroken, *key)


def decode_salvage(rows: DataFrame, *key: str) -> DataFrame:
    """As `decode_strict`, but an I- without a fitting entity before it opens one; O, <PAD> and empty tags end one; other tags change nothing."""
    w = Window.partitionBy(*key).orderBy("pos")
    kept = rows.where(F.col("tag").isin("O", "<PAD>", "") | F.startswith("tag", F.lit("B-")) | F.startswith("tag", F.lit("I-")))
    label = F.when(F.col("tag").isin("O", "<PAD>", ""), F.lit("")).otherwise(F.substring("tag", F.lit(3), F.length("tag")))
    marked = kept.withColumn("label", label)
    begins = F.startswith("tag", F.lit("B-")) | (F.col("label") != F.coalesce(F.lag("label").over(w), F.lit("")))
    return spans(marked.withColumn("run", F.sum(begins.cast("int")).over(w)).where("label <> ''"), *key)


def spans(rows: DataFrame, *key: str) -> DataFrame:
    words = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "token"))), lambda s: s["token"]), " ")
    return rows.groupBy(*key, "run").agg(F.min("pos").alias("start"), F.max("pos").alias("end"), F.first("label").alias("label"), words.alias("text")).drop("run")


def entity_map(found: DataFrame, *key: str) -> DataFrame:
    """(key, entities): label to text, the last of a label counting."""
    last = found.groupBy(*key, "label").agg(F.max_by("text", "start").alias("text"))
    return last.groupBy(*key).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("label", "text")))).alias("entities"))


def char_spans(parts: Column) -> Column:
    """array<struct<start, end, label, text>> of the labelled parts (text, label) of a text that joins them all."""
    empty = F.array().cast("array<struct<start:int,end:int,label:string,text:string>>")

    def step(state: Column, p: Column) -> Column:
        end = state["at"] + F.length(p["text"])
        span = F.array(F.struct(state["at"].alias("start"), end.alias("end"), p["label"].alias("label"), p["text"].alias("text")))
        return F.struct(end.alias("at"), F.when(p["label"].isNull(), state["spans"]).otherwise(F.concat(state["spans"], span)).alias("spans"))

    return F.aggregate(parts, F.struct(F.lit(0).alias("at"), empty.alias("spans")), step, lambda s: s["spans"])


def remapped_samples(samples: DataFrame) -> DataFrame:
    """(id, intent, taskType, text, entities) of span samples (id, intent, subIntent, utterance, entities_token_iob): ranges become start and end, missing entities an empty array."""
    entity = lambda e: F.struct(e["text"].alias("text"), e["label"].alias("label"), F.get(e["range"], 0).alias("start"), F.get(e["range"], 1).alias("end"))
    entities = F.transform("entities_token_iob", entity)
    return samples.select("id", "intent", F.col("subIntent").alias("taskType"), F.col("utterance").alias("text"), F.coalesce(entities, F.array().cast("array<struct<text: string, label: string, start: int, end: int>>")).alias("entities"))
