"""What the operators share: a durable intermediate table, and plain views of Arrow text."""

from __future__ import annotations

import gc
import re
import tempfile
import uuid
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that an operator works on at once in a Python worker.
SLICE_BYTES = 4 << 20


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where that is unset, a new folder in local mode (tests), and an error on a cluster, whose machines don't share their own folders."""
    sc = spark.sparkContext
    found = sc.getConf().get("spark.checkpoint.dir") or sc.getCheckpointDir()
    if not found:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError("spark.checkpoint.dir isn't set; it must name a folder that the driver and all executors share")
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="quillgraph-"))
        found = sc.getCheckpointDir()
    return found.rstrip("/")


def _file_system(spark: SparkSession, path: str):
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), at


#: Rows of an Arrow batch at most, unless the session sets its own number: whole texts of Spark's 10,000 rows take much memory on both sides of a Python worker.
BATCH_ROWS, SPARKS_ROWS = 2000, "10000"


def new_path(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder, which Hadoop's file system deletes when the application ends. Sees to smaller Arrow batches, too."""
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == SPARKS_ROWS:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    fs, at = _file_system(spark, path)
    fs.deleteOnExit(at)
    return path


def durable(df: DataFrame, name: str) -> DataFrame:
    """df written as a table in the shared folder and read again: its lineage is cut, and losing an executor loses nothing."""
    return _written(df, new_path(df.sparkSession, name))


def _written(df: DataFrame, path: str) -> DataFrame:
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Durable tables of one operator, deleted together as soon as its result is written elsewhere (at the end of a with block)."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.path, self.count = spark, new_path(spark, name), 0

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        fs, at = _file_system(self.spark, self.path)
        fs.delete(at, True)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        self.count += 1
        return _written(df, f"{self.path}/{name}-{self.count}")

    def drop(self, *names: str) -> None:
        """Deletes the tables of these names. Has Spark delete the shuffle files of jobs that are over, too, which it does when the driver collects its garbage."""
        fs, at = _file_system(self.spark, self.path)
        for found in fs.listStatus(at):
            path = found.getPath()
            if path.getName().rpartition("-")[0] in names:
                fs.delete(path, True)
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: str) -> DataFrame:
    """Only what an operator reads, so that other columns and their names don't matter; a null text is empty."""
    return df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), *more)


def column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def slices(batch: pa.RecordBatch, name: str = "text", most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in parts of at most so many bytes of text, or of one row."""
    ends = text_bytes(column(batch, name))[1]
    lo = 0
    while lo < batch.num_rows:
        hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + most, "right")) - 1)
        yield batch.slice(lo, hi - lo)
        lo = hi


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each begins (and the last ends). Nulls must be gone."""
    texts = texts.cast(pa.large_string())
    _, offsets, data = texts.buffers()
    at = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def word_spans(raw: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words [^\\x20\\x09-\\x0D]+ of texts that lie in a row: first byte, byte after the last, and index of the first word of each text (and the number of words)."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(ends), np.int64)
    inside = np.ones(len(raw) + 1, bool)
    inside[:-1] = (raw != 32) & ((raw < 9) | (raw > 13))
    inside[-1] = False
    before = np.zeros(len(raw) + 1, bool)
    before[1:] = inside[:-1]
    edge = ends[1:-1]
    edge = edge[edge < len(raw)]
    before[edge] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.ones(len(raw) + 1, bool)
    after[:-1] = ~inside[1:]
    inner = ends[1:-1]
    inner = inner[inner > 0]
    after_edge = np.zeros(len(raw) + 1, bool)
    after_edge[inner - 1] = True
    stops = np.flatnonzero((inside & (after | after_edge))[:-1]) + 1
    return starts, stops, np.searchsorted(starts, ends)


#: Odd multipliers, by place, of the words of a short sequence.
PLACES = np.array([pow(0x9E3779B97F4A7C15, 2 * k + 1, 1 << 64) | 1 for k in range(32)], np.uint64)


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def coded(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of texts in a row: each word's number (equal for equal words, and only for these), XXH64 by number, and the first word of each text (and the number of words). Words are [^\\x20\\x09-\\x0D]+."""
    known: defaultdict[bytes, int] = defaultdict()
    known.default_factory = known.__len__
    ids, first = [], [0]
    for text in texts:
        ids += map(known.__getitem__, text.split())
        first.append(len(ids))
    return np.array(ids, np.int64), np.fromiter((xxhash.xxh64_intdigest(w) for w in known), np.uint64, len(known)), np.array(first, np.int64)


def sequence_hash(words: np.ndarray, at: np.ndarray, length: int) -> np.ndarray:
    """64-bit hashes of the length words from each place on. words has the words' hashes."""
    total = np.full(len(at), length, np.uint64)
    for k in range(length):
        total += words[at + k] * PLACES[k]
    return mixed(total)


#: Bits of a filter of ids, in rows of 32,768.
FILTER_BITS = 1 << 23


def may_hold(df: DataFrame, key: str, ids: DataFrame) -> DataFrame:
    """_row (df's columns), _key (the column key as a long), _maybe: false where _key is surely not among ids (the first column of that frame).

    A bitmap of hashed ids, broadcast: 1 MB at most whatever the number of ids is. The more there are, the more rows are maybe.
    """
    place = lambda c: F.pmod(F.xxhash64(c), F.lit(FILTER_BITS))
    of = ids.select(place(F.col(ids.columns[0]).cast("long")).alias("_p"))
    bits = of.groupBy(F.bitmap_bucket_number("_p").alias("_bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("_p")).alias("_bits"))
    rows = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("_row"), F.col(f"`{key}`").cast("long").alias("_key"))
    rows = rows.withColumns({"_bucket": F.bitmap_bucket_number(place(F.col("_key"))), "_at": F.bitmap_bit_position(place(F.col("_key")))}).join(F.broadcast(bits), "_bucket", "left")
    byte = F.conv(F.hex(F.expr("substring(_bits, cast(_at div 8 as int) + 1, 1)")), 16, 10).cast("int")
    return rows.select("_row", "_key", F.coalesce(F.getbit(byte, (F.col("_at") % 8).cast("int")) == 1, F.lit(False)).alias("_maybe"))


def columns_of(rows: DataFrame, names: list[str]) -> DataFrame:
    """The columns of _row again."""
    return rows.select(*[F.col("_row").getField(c).alias(c) for c in names])
