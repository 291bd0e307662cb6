"""Sharding by Karmarkar-Karp differencing: shards of near-equal bytes from groups that may not be split.

A partial partition is a tuple of sums, one for each shard. Differencing begins with one for each group, all of its bytes in
one sum, and repeatedly combines the two with the largest spread, the largest sum of the one with the smallest of the other.
Any partial partitions can be combined, so each task differences bounded chunks of its groups; what each chunk leaves, a
tuple, is differenced with the others in further rounds, until one bounded round on the driver ends it.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import column, durable, partitions

#: Groups that are differenced together in a task, and partial partitions that the driver differences at most.
CHUNK, LAST = 100_000, 4096


def differenced(parts: list[tuple[int, ...]]) -> list[list[int]]:
    """For each partial partition (sums by bin), the shard to which each of its bins goes. Ties are broken by position.

    Bins are trees while they are combined: inner nodes join two bins, leaves are bins of the input.
    """
    if not parts:
        return []
    k = len(parts[0])
    left, right = [], []
    heap = []
    for i, sums in enumerate(parts):
        order = sorted(range(k), key=lambda b: (-sums[b], b))
        # A bin of sum 0 is a leaf too: it must have a shard, whichever.
        heap.append((-(sums[order[0]] - sums[order[-1]]), i, [sums[b] for b in order], [-(i * k + b) - 1 for b in order]))
    heapq.heapify(heap)
    serial = len(parts)
    while len(heap) > 1:
        _, _, s1, t1 = heapq.heappop(heap)
        _, _, s2, t2 = heapq.heappop(heap)
        merged = []
        for a, b, x, y in zip(s1, reversed(s2), t1, reversed(t2), strict=True):
            left.append(x)
            right.append(y)
            merged.append((a + b, len(left) - 1))
        merged.sort(key=lambda m: -m[0])
        heapq.heappush(heap, (merged[-1][0] - merged[0][0], serial, [m[0] for m in merged], [m[1] for m in merged]))
        serial += 1
    out = [[0] * k for _ in parts]
    for shard, root in enumerate(heap[0][3]):
        stack = [root]
        while stack:
            x = stack.pop()
            if x < 0:
                i, b = divmod(-x - 1, k)
                out[i][b] = shard
            else:
                stack += (left[x], right[x])
    return out


def differenced_weights(weights: list[int], k: int) -> list[int]:
    """The shard of each single weight. As differenced(), but empty bins take no part in the trees."""
    left, right = [], []
    heap = [(-w, i, [w] + [0] * (k - 1), [-i - 1] + [None] * (k - 1)) for i, w in enumerate(weights)]
    heapq.heapify(heap)
    serial = len(weights)
    while len(heap) > 1:
        _, _, s1, t1 = heapq.heappop(heap)
        _, _, s2, t2 = heapq.heappop(heap)
        merged = []
        for a, b, x, y in zip(s1, reversed(s2), t1, reversed(t2), strict=True):
            if x is None or y is None:
                merged.append((a + b, y if x is None else x))
            else:
                left.append(x)
                right.append(y)
                merged.append((a + b, len(left) - 1))
        merged.sort(key=lambda m: -m[0])
        low = merged[-1][0]
        heapq.heappush(heap, (low - merged[0][0], serial, [m[0] - low for m in merged], [m[1] for m in merged]))
        serial += 1
    out = [0] * len(weights)
    for shard, root in enumerate(heap[0][3] if heap else []):
        stack = [] if root is None else [root]
        while stack:
            x = stack.pop()
            if x < 0:
                out[-x - 1] = shard
            else:
                stack += (left[x], right[x])
    return out


def assign_groups(groups: DataFrame, shards: int, chunk: int = CHUNK, last: int = LAST) -> DataFrame:
    """key, shard of groups (key binary, weight long; each key once)."""
    spark = groups.sparkSession

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        keys, weights = [], []

        def flush() -> pa.RecordBatch:
            bins = differenced_weights(weights, shards)
            n = len(keys)
            return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(weights, pa.int64()), pa.array([number] * n, pa.int64()), pa.array(bins, pa.int32())], ["key", "weight", "part", "bin"])

        for batch in batches:
            keys += column(batch, "key").to_pylist()
            weights += column(batch, "weight").to_pylist()
            while len(keys) >= chunk:
                rest = keys[chunk:], weights[chunk:]
                del keys[chunk:], weights[chunk:]
                yield flush()
                keys, weights = rest
                number += 1
        if keys:
            yield flush()

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, rows = TaskContext.get().partitionId() << 32, []
        for batch in batches:
            rows += zip(column(batch, "part").to_pylist(), column(batch, "sums").to_pylist(), strict=True)
            while len(rows) >= last:
                yield combined(rows[:last], number)
                rows, number = rows[last:], number + 1
        if rows:
            yield combined(rows, number)

    def combined(rows: list, number: int) -> pa.RecordBatch:
        to = differenced([tuple(s) for _, s in rows])
        sums = [0] * shards
        for (_, s), t in zip(rows, to, strict=True):
            for x, shard in zip(s, t, strict=True):
                sums[shard] += x
        n = len(rows)
        return pa.RecordBatch.from_arrays([pa.array([p for p, _ in rows], pa.int64()), pa.array(to, pa.list_(pa.int32())), pa.array([number] * n, pa.int64()), pa.array([sums] * n, pa.list_(pa.int64()))], ["part", "to", "parent", "sums"])

    dealt = groups.repartition(partitions(spark), "key").sortWithinPartitions("key")
    binned = durable(dealt.mapInArrow(first, "key binary, weight long, part long, bin int"), "bins")
    sums = [F.sum(F.when(F.col("bin") == b, F.col("weight")).otherwise(0)).alias(f"s{b}") for b in range(shards)]
    parts = binned.groupBy("part").agg(*sums).select("part", F.array(*[f"s{b}" for b in range(shards)]).alias("sums"))
    parts, place = durable(parts, "parts"), None
    while (count := parts.count()) > last:
        merged = durable(parts.repartition(-(-count // last), "part").sortWithinPartitions("part").mapInArrow(again, "part long, to array<int>, parent long, sums array<long>"), "parts")
        step = merged.select("part", "to", "parent")
        place = step if place is None else durable(
            place.join(step.select(F.col("part").alias("parent"), F.col("to").alias("_to"), F.col("parent").alias("_parent")), "parent").select("part", F.transform("to", lambda b: F.get("_to", b)).alias("to"), F.col("_parent").alias("parent")), "parts"
        )
        parts = merged.select(F.col("parent").alias("part"), "sums").dropDuplicates(["part"])
    rows = sorted((r.part, tuple(r.sums)) for r in parts.collect())
    end = spark.createDataFrame([(p, t) for (p, _), t in zip(rows, differenced([s for _, s in rows]), strict=True)], "last long, final array<int>")
    if place is None:
        whole = end.select(F.col("last").alias("part"), F.col("final").alias("to"))
    else:
        whole = place.join(end, F.col("parent") == F.col("last")).select("part", F.transform("to", lambda b: F.get("final", b)).alias("to"))
    return binned.join(whole, "part").select("key", F.get("to", F.col("bin")).alias("shard"))


def shard_by_bytes(df: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard of each row: equal texts share a shard, and the shards' bytes are near equal.

    Size is the text's UTF-8 bytes and 1; a null text is empty. Slots number a shard's rows without gaps, in an order that
    follows from the ids. Rows that repeat, and null ids, each have a slot; an empty table gives none.
    """
    spark = df.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = df.select(F.col(id_col).alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.unhex(F.md5(text.cast("binary"))).alias("key"))
    rows = durable(rows, "sizes")
    groups = rows.groupBy("key").agg(F.sum("size").alias("weight"))
    placed = rows.join(assign_groups(groups, shards), "key")
    # A shard's rows are numbered in blocks by a hash of the id, so that no shard is one task's: rows before the block, then rows in it.
    blocks = partitions(spark)
    placed = durable(placed.select("doc_id", "size", "text_crc32", "shard", F.pmod(F.xxhash64("doc_id", "text_crc32"), F.lit(blocks)).alias("block")), "placed")
    counts = placed.groupBy("shard", "block").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("shard").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    base = counts.select("shard", "block", F.coalesce(before, F.lit(0)).alias("base"))
    within = F.row_number().over(Window.partitionBy("shard", "block").orderBy("doc_id", "text_crc32", "size")) - 1
    out = placed.withColumn("within", within).join(base, ["shard", "block"])
    return out.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("base") + F.col("within")).cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
