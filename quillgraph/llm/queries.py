"""The query of each operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def vocabulary(name: str) -> str:
    """The place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .bpe import round_trip

    return round_trip(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .packing import pack_documents

    return pack_documents(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op3_suffix_tree_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substrings import remove_repeats

    return remove_repeats(table(spark, sf_dir, "documents"))


def op4_karmarkar_karp_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard_by_bytes

    return shard_by_bytes(table(spark, sf_dir, "documents"))


def op5_flac_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .common import durable
    from .flac import read_media, write_media

    return read_media(durable(write_media(table(spark, sf_dir, "documents")), "media"))


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .langid import identify, remainder

    held_out = F.coalesce(remainder("doc_id", 3) == 1, F.lit(False)).alias("held_out")
    return identify(table(spark, sf_dir, "documents")).select("doc_id", held_out, "lang_pred", "score", "rejected")


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quality import apply_rules

    return apply_rules(table(spark, sf_dir, "documents"))


def op8_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .warc import archive_round_trip

    return archive_round_trip(table(spark, sf_dir, "pages"))


def op9_toxic_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .toxicity import toxicity

    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_simhash_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .simhash import as_hex, near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", as_hex().alias("fingerprint"), "component_id")


QUERIES = {
    f.__name__: f
    for f in (
        op1_bpe_round_trip,
        op2_best_fit_packing,
        op3_suffix_tree_dedup,
        op4_karmarkar_karp_shards,
        op5_flac_media,
        op6_language_id,
        op7_quality_rules,
        op8_warc_index,
        op9_toxic_segments,
        op10_simhash_near_dup,
    )
}
