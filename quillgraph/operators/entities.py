"""Entities of documents: extraction, the cache, document frequencies and selection."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as t

#: Weights of importance and of the hybrid score; mentions that saturate importance.
MENTIONED, EARLY, RANKED, SATURATED = 0.7, 0.2, 0.1, 6.0
HYBRID_IMPORTANCE, HYBRID_RARITY = 0.65, 0.35


#: Characters of a text that are searched first.
BEGINNING = 1500


def token_entities(text: str | Column, most: int = 8, least_chars: int = 10) -> Column:
    """A deterministic extractor: the first long words, each once.

    A text is searched up to a space first, which no word goes across: if so many are found, they are the first of the whole text. Else the whole is searched.
    """
    text = t.col(text)
    first = lambda x: F.slice(F.array_distinct(F.filter(t.tokens(x), lambda w: F.length(w) >= least_chars)), 1, most)
    head = F.substring(text, 1, BEGINNING)
    head = F.substring(head, F.lit(1), F.length(head) - F.length(F.substring_index(head, " ", -1)))
    early = t.bound(first(head), lambda found: F.when(F.size(found) >= most, found).otherwise(first(text)))
    return F.when(F.length(text) > BEGINNING, early).otherwise(first(text))


def stale(docs: DataFrame, cache: DataFrame) -> DataFrame:
    """doc_id, reason of documents whose entities must be extracted: missing, changed or failed."""
    c = cache.select("doc_id", F.col("source_sha256").alias("_sha"), F.col("error").alias("_error"), F.lit(True).alias("_found"))
    reason = F.when(F.col("_found").isNull(), "missing").when(F.coalesce(F.col("_sha"), F.lit("")) != F.col("source_sha256"), "changed").when(F.coalesce(F.col("_error"), F.lit("")) != "", "failed")
    return docs.join(c, "doc_id", "left").select("doc_id", reason.alias("reason")).where("reason is not null")


def with_entities(docs: DataFrame, records: DataFrame) -> DataFrame:
    """Documents with the entities of their record; those that failed, or have none, go."""
    fine = records.where(F.coalesce(F.col("error"), F.lit("")) == "") if "error" in records.columns else records
    return docs.join(fine.select("doc_id", "entities"), "doc_id").where(F.size("entities") > 0)


def exploded(records: DataFrame) -> DataFrame:
    """doc_id, pos, entity, key: the entities of each record with their normal keys."""
    return records.select("doc_id", F.posexplode("entities").alias("pos", "entity")).withColumn("key", t.entity_normal_key("entity"))


def document_frequency(records: DataFrame) -> DataFrame:
    """key, df: in how many documents an entity is. Counted in two steps, of which the first, one row a document and key, is spread evenly even if one key is everywhere."""
    return exploded(records).where("key <> ''").select("doc_id", "key").distinct().groupBy("key").agg(F.count("*").alias("df"))


def importance(mentions: Column, first: Column, length: Column, pos: Column) -> Column:
    """How often, how early and how far up in the list an entity is; first is a place from 0 on, or -1."""
    often = F.least(F.lit(1.0), F.log1p(mentions.cast("double")) / F.log(F.lit(SATURATED)))
    early = 1.0 - F.least(F.lit(1.0), first.cast("double") / F.greatest(length, F.lit(1)).cast("double"))
    found = mentions > 0
    return F.lit(MENTIONED) * F.when(found, often).otherwise(0.0) + F.lit(EARLY) * F.when(found & (first >= 0), early).otherwise(0.0) + F.lit(RANKED) / (1.0 + pos)


def rarity(df: Column, n: Column) -> Column:
    top = (n + 1).cast("double")
    return F.when(n > 0, F.log(top / F.greatest(df, F.lit(1)).cast("double")) / F.log(top)).otherwise(0.0)


def scored(records: DataFrame, docs: DataFrame, strategy: str) -> DataFrame:
    """doc_id, pos, entity, key, score of every entity of every record; a record without a document has an empty text."""
    rows = exploded(records)
    if strategy in ("importance", "hybrid"):
        # A document's texts are read in its own row, and go no further than that.
        both = records.select("doc_id", "entities", F.col("text").alias("_text")) if records is docs else records.select("doc_id", "entities").join(docs.select("doc_id", F.col("text").alias("_text")), "doc_id", "left")
        both = both.select("doc_id", "entities", F.coalesce("_text", F.lit("")).alias("_text"), F.explode(F.array(t.fold(F.coalesce("_text", F.lit(""))))).alias("_fold"))
        of = lambda e: F.struct(e.alias("entity"), t.entity_normal_key(e).alias("key"), t.mentions(e, "_text").alias("mentions"), (F.instr("_fold", t.fold(e)) - 1).alias("at"), F.length("_fold").alias("length"))
        # Without "outer", a filter would compute all this a second time.
        rows = both.select("doc_id", F.posexplode_outer(F.transform("entities", of)).alias("pos", "_e")).where("pos is not null")
        rows = rows.select("doc_id", "pos", "_e.entity", "_e.key", importance(F.col("_e.mentions"), F.col("_e.at"), F.col("_e.length"), F.col("pos")).alias("_importance"))
    if strategy in ("rarity", "hybrid"):
        size = records.agg(F.count("*").alias("_n"))
        # One row, so it may go everywhere.
        rows = rows.join(document_frequency(records), "key", "left").crossJoin(F.broadcast(size)).withColumn("_rarity", rarity(F.coalesce("df", F.lit(0)), F.col("_n")))
    score = {"importance": lambda: F.col("_importance"), "rarity": lambda: F.col("_rarity"), "hybrid": lambda: HYBRID_IMPORTANCE * F.col("_importance") + HYBRID_RARITY * F.col("_rarity"), "llm-order": lambda: -F.col("pos").cast("double")}[strategy]()
    return rows.select("doc_id", "pos", "entity", "key", score.alias("score"))


def select_entities(records: DataFrame, docs: DataFrame, most: int, strategy: str, digits: int | None = None) -> DataFrame:
    """records with at most `most` entities each, in their order. 0 or less leaves none; no more than most leaves all, whatever the strategy.

    Ties go to the earlier entity. Equal keys stand or fall together. With digits, scores are compared at so many decimals.
    """
    if most <= 0:
        return records.withColumn("entities", F.array().cast("array<string>"))
    if strategy == "llm-order":
        return records.withColumn("entities", F.slice("entities", 1, most))
    few = records.where(F.size("entities") > most) if strategy == "importance" else records
    rows = scored(few, few if records is docs else docs, strategy)
    score = F.floor(F.col("score") * 10**digits + 0.5) if digits else F.col("score")
    ranked = rows.groupBy("doc_id").agg(F.sort_array(F.collect_list(F.struct((-score).alias("s"), "pos", "key"))).alias("_ranked"))
    out = records.join(ranked, "doc_id", "left")
    best = F.transform(F.slice("_ranked", 1, most), lambda x: x["key"])
    out = out.withColumn("_best", best)
    chosen = F.filter("entities", lambda e: F.array_contains("_best", t.entity_normal_key(e)))
    return out.withColumn("entities", F.when(F.size("entities") <= most, F.col("entities")).otherwise(chosen)).select(*records.columns)
