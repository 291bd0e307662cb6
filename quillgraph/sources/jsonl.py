"""JSONL scans. Rows are parsed to VARIANT, so that types stay what the file says: a number isn't taken for a text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t


def with_ordinal(lines: DataFrame, name: str, each_file: bool = False) -> DataFrame:
    """Scanned lines with a number from 0 on, without gaps, in the order of files and places; from 0 on again in each file if each_file.

    Each partition of a file scan counts its own rows; only these counts, one for each partition (and file), come to the driver.
    """
    spark = lines.sparkSession
    marked = lines.withColumns({"_part": F.spark_partition_id(), "_in": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
    by = ["_part", "_file"] if each_file else ["_part"]
    counts = marked.groupBy(*by).agg(F.min(F.struct("_file", "_start")).alias("at"), F.min("_in").alias("first"), F.count("*").alias("n")).collect()
    done, rows = {}, []
    for r in sorted(counts, key=lambda r: tuple(r["at"])):
        file = r["at"]["_file"] if each_file else None
        rows.append((r["_part"], r["at"]["_file"], done.get(file, 0) - r["first"]))
        done[file] = done.get(file, 0) + r["n"]
    starts = spark.createDataFrame(rows, "_part int, _file string, _base long").select(*by, "_base")
    out = marked.join(F.broadcast(starts), by)
    return out.withColumn(name, F.col("_base") + F.col("_in")).drop("_part", "_in", "_base")


def file_lines(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_start"))


def numbered(spark: SparkSession, path: str) -> DataFrame:
    """line_number (from 1 on in each file, blank lines counted), raw (VARIANT) of the objects of a JSONL file, with the place as _file, _start. Blank lines are skipped; what isn't an object raises, and the error names the file and line."""
    lines = with_ordinal(file_lines(spark, path), "_line", each_file=True).where(t.strip("value") != "")
    raw, number = F.try_parse_json("value"), (F.col("_line") + 1).alias("line_number")
    bad = F.raise_error(F.concat("_file", F.lit(":"), (F.col("_line") + 1).cast("string"), F.lit(" is not a JSON object: "), F.substring("value", 1, 200)))
    parsed = lines.withColumn("raw", raw)
    return parsed.select(number, F.when(_is_object(), F.col("raw")).otherwise(bad).alias("raw"), "_file", "_start")


def _is_object() -> Column:
    return F.coalesce(F.startswith(F.schema_of_variant("raw"), F.lit("OBJECT")), F.lit(False))


def scan(spark: SparkSession, path: str, strict: bool = True) -> DataFrame:
    """row_index, raw (VARIANT): the objects of a JSONL file. Blank lines are skipped; what isn't an object raises if strict (see numbered()), and is skipped if not."""
    if strict:
        parsed = numbered(spark, path)
    else:
        parsed = file_lines(spark, path).where(t.strip("value") != "").withColumn("raw", F.try_parse_json("value")).where(_is_object())
    return with_ordinal(parsed.select("raw", "_file", "_start"), "row_index").select("row_index", "raw")


def first_string(*keys: str) -> Column:
    """The first of the keys whose value is a string that isn't blank, stripped."""
    return F.coalesce(*[F.nullif(t.strip(string_at(k)), F.lit("")) for k in keys])


def fixture(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, title, text, entities of a corpus for reports: a row without a text raises, and ids and titles that are missing are made of the line's place."""
    place = (F.col("line_number") - 1).cast("string")
    bad = F.raise_error(F.concat("_file", F.lit(":"), F.col("line_number").cast("string"), F.lit(" has no text")))
    entities = F.coalesce(strings_at("entities"), F.array().cast("array<string>"))
    return numbered(spark, path).select(
        F.coalesce(first_string("id", "doc_id", "document_id"), F.concat(F.lit("row-"), place)).alias("doc_id"),
        F.coalesce(first_string("title"), F.concat(F.lit("Document "), place)).alias("title"),
        F.coalesce(first_string("text"), bad).alias("text"),
        t.normalized_entities(entities).alias("entities"),
    )


def string_at(key: str, raw: str = "raw") -> Column:
    """The value of a key if it is a string, else null."""
    value = F.try_variant_get(raw, f"$['{key}']", "variant")
    return F.when(F.schema_of_variant(value) == "STRING", F.try_variant_get(raw, f"$['{key}']", "string"))


def text_at(key: str, raw: str = "raw") -> Column:
    """The value of a key as text, whatever its type; null if there is none."""
    return F.try_variant_get(raw, f"$['{key}']", "string")


def strings_at(key: str, raw: str = "raw") -> Column:
    """The strings of a list; null if the value isn't a list."""
    items = F.try_variant_get(raw, f"$['{key}']", "array<variant>")
    texts = F.transform(items, lambda v: F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")))
    return F.filter(texts, lambda x: x.isNotNull())


def documents(rows: DataFrame, text_key: str = "text", title_key: str | None = "title", id_key: str | None = None, max_docs: int | None = None) -> DataFrame:
    """doc_id, source_index, title, text, source_sha256, raw of rows with a text. Of rows that share an id the last counts."""
    text = string_at(text_key)
    found = rows.withColumn("_text", text).where(F.col("_text").isNotNull() & (t.strip("_text") != ""))
    if max_docs is not None:
        found = found.orderBy("row_index").limit(max_docs)
    return identified(found.withColumnRenamed("row_index", "source_index"), [k for k in (id_key, "id", "doc_id", "document_id") if k], title_key)


def identified(found: DataFrame, id_keys: list[str], title_key: str | None) -> DataFrame:
    sha = F.sha2(F.col("_text").cast("binary"), 256)
    doc_id = F.coalesce(*[text_at(k) for k in id_keys], t.stable_id("source_index", sha))
    title = t.infer_title("_text", "source_index")
    if title_key:
        title = F.coalesce(F.nullif(t.strip(string_at(title_key)), F.lit("")), title)
    out = found.select(doc_id.alias("doc_id"), "source_index", title.alias("title"), t.strip("_text").alias("text"), sha.alias("source_sha256"), "raw")
    last = F.max_by(F.struct("source_index", "title", "text", "source_sha256", "raw"), "source_index").alias("d")
    return out.groupBy("doc_id").agg(last).select("doc_id", "d.*")


def entity_cache(rows: DataFrame) -> DataFrame:
    """The last row of each document in an entity cache: doc_id, source_index, title, source_sha256, summary, entities, raw_response, error."""
    doc_id, entities = string_at("doc_id"), F.try_variant_get("raw", "$.entities", "array<string>")
    found = rows.select("row_index", doc_id.alias("doc_id"), F.try_variant_get("raw", "$.source_index", "long").alias("source_index"), text_at("title").alias("title"), text_at("source_sha256").alias("source_sha256"), text_at("summary").alias("summary"), entities.alias("entities"), text_at("raw_response").alias("raw_response"), F.nullif(text_at("error"), F.lit("")).alias("error"))
    return latest(found.where("doc_id is not null and entities is not null"), "row_index")


def latest(cache: DataFrame, order: str) -> DataFrame:
    """The last row of each doc_id."""
    rest = [c for c in cache.columns if c not in ("doc_id", order)]
    return cache.groupBy("doc_id").agg(F.max_by(F.struct(*rest), order).alias("d")).select("doc_id", "d.*")


def completed_keys(rows: DataFrame, key: str) -> DataFrame:
    """Distinct string values of key among rows without an error."""
    return rows.where(F.coalesce(text_at("error"), F.lit("")) == "").select(string_at(key).alias("key")).where("key is not null").distinct()
