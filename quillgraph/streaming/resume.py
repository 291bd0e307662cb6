"""Structured Streaming forms of the append-only logs: incremental documents, and tasks that are appended once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState

from ..functions import text as t
from ..sources import jsonl


def document_stream(spark: SparkSession, path: str, files_per_trigger: int = 8) -> DataFrame:
    """doc_id, title, text, source_sha256, place of JSON lines that arrive as files in a directory; a few files at a time keep the model's load bounded.

    place orders lines by their file's time, then by file and the start of its split. A stream has no row numbers, so lines of one
    split are not ordered, and a document without an id is known by its text's hash.
    """
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_trigger).schema("value string").text(path)
    start = F.lpad(F.col("_metadata.file_block_start").cast("string"), 20, "0")
    place = F.concat_ws("|", F.date_format("_metadata.file_modification_time", "yyyyMMddHHmmssSSS"), "_metadata.file_path", start)
    raw = lines.select(F.try_parse_json("value").alias("raw"), place.alias("place")).where("raw is not null")
    ids = F.coalesce(*map(jsonl.text_at, ("id", "doc_id", "document_id")))
    rows = raw.select(ids.alias("doc_id"), jsonl.string_at("title").alias("title"), jsonl.string_at("text").alias("text"), "place")
    sha = F.sha2(F.col("text").cast("binary"), 256)
    fine = rows.where(F.col("text").isNotNull() & (t.strip("text") != ""))
    return fine.select(F.coalesce("doc_id", sha).alias("doc_id"), F.coalesce(F.nullif(t.strip("title"), F.lit("")), t.infer_title("text", F.lit(0))).alias("title"), t.strip("text").alias("text"), sha.alias("source_sha256"), "place")


def append_once(stream: DataFrame, key: str, table: str, checkpoint: str, make: Callable[[DataFrame], DataFrame] | None = None, available_now: bool = True) -> StreamingQuery:
    """Appends each key of a stream to a parquet table once: a batch leaves out keys that the table has, so a batch that runs again adds nothing."""

    def add(batch: DataFrame, _: int) -> None:
        rows = (make(batch) if make else batch).dropDuplicates([key])
        spark = rows.sparkSession
        try:
            rows = rows.join(spark.read.parquet(table).select(key), key, "left_anti")
        except Exception as e:  # the first batch has no table yet
            if "PATH_NOT_FOUND" not in str(e):
                raise
        rows.write.mode("append").parquet(table)

    writer = stream.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def changed(stream: DataFrame, key: str = "doc_id", mark: str = "source_sha256", order: str = "place") -> DataFrame:
    """The rows of a stream that are new or have changed: of each key and batch the last row by order, if its mark isn't the one seen last.

    Appended to a log whose readers take the last row of each key, this is an upsert. The state is a key's last mark; a key's
    rows are gone through one Arrow batch at a time, and only the last is kept. Of rows with equal order the greatest mark counts.
    Null keys are one key, and null marks one mark.
    """

    def step(_: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        last = None
        for frame in frames:
            last = pd.concat([last, frame]).sort_values([order, mark], na_position="first").iloc[-1:]
        found = last[mark].iloc[0]
        if not state.exists or state.get[0] != found:
            state.update((found,))
            yield last

    return stream.groupBy(key).applyInPandasWithState(step, stream.schema, "mark string", "append", "NoTimeout")


def upsert_log(stream: DataFrame, log: str, checkpoint: str, key: str = "doc_id", mark: str = "source_sha256", order: str = "place", available_now: bool = True) -> StreamingQuery:
    """Appends what changed() gives to a parquet log. The file sink commits whole batches, so one that runs again adds nothing; latest() reads the log."""
    writer = changed(stream, key, mark, order).writeStream.format("parquet").option("path", log).option("checkpointLocation", checkpoint).outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def latest(spark: SparkSession, log: str, key: str = "doc_id", order: str = "place") -> DataFrame:
    """The last row of each key in a log of upserts."""
    rows = spark.read.parquet(log)
    last = F.max_by(F.struct(*[c for c in rows.columns if c != key]), order).alias("_last")
    return rows.groupBy(key).agg(last).select(key, "_last.*")
