"""Removal of repeated word sequences by prefix-partitioned suffix trees.

A window of 20 words that occurs again is a node at depth 20 of the suffix tree of all texts with two or more leaves below it.
The tree is never built as a whole: its suffixes are dealt out by prefixes, and each prefix's subtree is a suffix array with the
depths at which neighbours part, built in memory for one group after the other. Prefixes have variable length, so that every
group fits in memory:

* 8 words. Of all suffixes those at anchors are enough here: the anchor of a window is the place in it whose next 8 words hash
  lowest, so equal windows have their anchor at the same offset. Windows that share an anchor travel as one segment of text.
  Where more than GROUP segments have the same 8 words, those words alone split too little, and each of their windows goes on
  as a suffix of its own by
* 14 words, and where there are more than GROUP of these, by
* 20 words: all leaves of such a group are of one node, so it is read as a sorted stream.

Hashes only decide what meets: that two windows are equal is decided on their words. Nodes of depth 20 and more are the
maximal repeats, read as ranges that touch or overlap.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, coded, column, columns_of, durable, may_hold, partitions, sequence_hash, slices

#: Words of a window; words of the prefixes; segments or suffixes of a group that a task holds in memory at most.
WINDOW, PREFIXES, GROUP = 20, (8, 14, 20), 1024
SPAN = WINDOW - PREFIXES[0] + 1
TEXT_AT_ONCE = 1 << 20
#: What stands for a null id.
NO_ID = (1 << 63) - 1

#: Bits of a spot from the lowest on: kind, windows after the first, first word, and a hash of the document's text, which tells rows that share an id apart.
KIND_BITS, MORE_BITS, FIRST_BITS, MARK_BITS = 2, 4, 31, 26
#: Kinds: a range of words that goes; windows whose 8 words at the anchor are in several places; those whose 8 words are in too many.
SETTLED, SEGMENT, HOT = 0, 1, 2
MARK_AT = KIND_BITS + MORE_BITS + FIRST_BITS


def spots(mark: np.ndarray, first: np.ndarray, more: np.ndarray | int, kind: int) -> np.ndarray:
    return (mark << MARK_AT) | (first << (KIND_BITS + MORE_BITS)) | (more << KIND_BITS) | kind


def unpacked(spot):
    """mark, first, more, kind of spots, as arrays or one number."""
    return spot >> MARK_AT, spot >> (KIND_BITS + MORE_BITS) & ((1 << FIRST_BITS) - 1), spot >> KIND_BITS & ((1 << MORE_BITS) - 1), spot & ((1 << KIND_BITS) - 1)


def anchored(rank: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """text, first, last, anchor of each run of windows of a text that share their anchor. rank has the hash of the 8 words from each place on, first the first word of each text; places count over all texts."""
    starts, ends = first[:-1], first[1:]
    count = np.maximum(ends - starts - WINDOW + 1, 0)
    empty = np.zeros(0, np.int64)
    if not count.sum():
        return empty, empty, empty, empty
    best = lambda a, b: np.where(rank[a] <= rank[b], a, b)
    low, width = np.arange(len(rank)), 1
    while 2 * width <= SPAN:
        low = best(low[:-width], low[width:])
        width *= 2
    if width < SPAN:
        low = best(low[: len(low) - (SPAN - width)], low[SPAN - width :])
    text = np.repeat(np.arange(len(starts)), count)
    window = np.repeat(starts, count) + np.arange(len(text)) - np.repeat(np.cumsum(count) - count, count)
    anchor = low[window]
    new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]))))
    return text[new], window[new], window[np.append(new[1:], len(window)) - 1], anchor[new]


def equal_words(ids: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the length words from a on are those from b on."""
    same = np.ones(len(a), bool)
    for k in range(int(length.max(initial=0))):
        at = np.flatnonzero(same & (k < length))
        same[at] = ids[a[at] + k] == ids[b[at] + k]
    return same


def subtrees(ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of the windows that begin at starts in ids (numbers of words): their order, and whether each has all 20 words in common with the one before it.

    By prefix doubling: ranks of 1, 2, 4, 8 and 16 words give the rank of 20, and equal ranks are equal words. The order of
    equal windows is that of starts.
    """
    ranks, width = {1: ids}, 1
    base = len(ids) + 1
    while 2 * width <= WINDOW:
        rank = ranks[width]
        after = np.append(rank[width:], np.full(min(width, len(rank)), -1))
        ranks[2 * width] = np.unique(rank * base + after + 1, return_inverse=True)[1]
        width *= 2
    pair, done = ranks[width][starts], width
    while done < WINDOW:
        width //= 2
        if done + width <= WINDOW:
            pair = np.unique(pair * base + ranks[width][starts + done] + 1, return_inverse=True)[1]
            done += width
    order = np.argsort(pair, kind="stable")
    deep = np.zeros(len(order), bool)
    deep[1:] = pair[order][1:] == pair[order][:-1]
    return order, deep


def later(order: np.ndarray, deep: np.ndarray, *leaf: np.ndarray) -> np.ndarray:
    """Whether each suffix of a suffix array isn't the first leaf of its node. Equal leaves, which a repeated row brings, are one leaf."""
    lead = order[np.maximum.accumulate(np.where(deep, 0, np.arange(len(order))))]
    out = np.zeros(len(order), bool)
    out[order] = np.any([x[order] != x[lead] for x in leaf], axis=0)
    return out


ANCHORS = "key long, doc_id long, spot long"
LEAVES = "key long, doc_id long, spot long, words binary"


def _rows(key: np.ndarray, ids: np.ndarray, spot: np.ndarray, words: list[bytes] | None = None, with_words: bool = False) -> pa.RecordBatch:
    columns = [pa.array(key.view(np.int64)), pa.array(ids), pa.array(spot)]
    if with_words:
        columns.append(pa.nulls(len(ids), pa.binary()) if words is None else pa.array(words, pa.binary()))
    return pa.RecordBatch.from_arrays(columns, ["key", "doc_id", "spot", "words"][: len(columns)])


def _scattered(ids: np.ndarray, spot: np.ndarray) -> np.ndarray:
    """Keys of settled ranges, so that no partition gets all of one document or one branch."""
    return (ids.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) ^ (spot.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _numbers(batch: pa.RecordBatch, *names: str) -> list[np.ndarray]:
    return [column(batch, n).to_numpy(zero_copy_only=False).astype(np.int64) for n in names]


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of ANCHORS for each run of windows that share their anchor, keyed by its 8 words. Of runs of equal words in a task's slice only the earliest goes on; the others are settled."""
    for whole in batches:
        for batch in slices(whole, most=TEXT_AT_ONCE):
            words, hashes, first = coded([t.encode() for t in column(batch, "text").to_pylist()])
            if len(words) < WINDOW:
                continue
            ids, mark = _numbers(batch, "doc_id", "mark")
            rank = sequence_hash(hashes[words], np.arange(len(words) - PREFIXES[0] + 1), PREFIXES[0])
            text, lo, last, anchor = anchored(rank, first)
            if not len(text):
                continue
            key, more, ids, spot = rank[anchor], last - lo, ids[text], spots(mark[text], lo - first[text], last - lo, SEGMENT)
            order = np.lexsort((spot, ids, more, key))
            same = np.zeros(len(order), bool)
            same[1:] = (key[order][1:] == key[order][:-1]) & (more[order][1:] == more[order][:-1])
            lead = order[np.maximum.accumulate(np.where(same, 0, np.arange(len(order))))]
            settled = np.zeros(len(order), bool)
            settled[order] = ((ids[order] != ids[lead]) | (spot[order] != spot[lead])) & equal_words(words, lo[order], lo[lead], more[order] + WINDOW)
            yield _rows(key[~settled], ids[~settled], spot[~settled])
            who, where = ids[settled], spot[settled] - SEGMENT + SETTLED
            yield _rows(_scattered(who, where), who, where)


def _groups(batches: Iterator[pa.RecordBatch], names: tuple[str, ...], most: int) -> Iterator[tuple[list[np.ndarray], np.ndarray, np.ndarray | None]]:
    """Sorted rows in parts: the columns (the key first), each row's number of rows of its key, as far as it is known, and whether that is over most. Keys of at most that many rows are never cut, and no more rows of a key are held."""
    kept, hot = None, None
    for batch in _ended(batches):
        if batch is not None:
            rows = [column(batch, n).to_numpy(zero_copy_only=False) for n in names]
            live = unpacked(rows[names.index("spot")])[3] != SETTLED
            if not live.all():
                yield [x[~live] for x in rows], None, None
                rows = [x[live] for x in rows]
            if not len(rows[0]):
                continue
            if hot is not None:
                goes = int(np.searchsorted(rows[0], hot, "right"))
                if goes:
                    yield [x[:goes] for x in rows], np.full(goes, most + 1), np.ones(goes, bool)
                    rows = [x[goes:] for x in rows]
                if not len(rows[0]):
                    continue
                hot = None
            rows = rows if kept is None else [np.concatenate((x, y)) for x, y in zip(kept, rows, strict=True)]
        elif kept is None:
            return
        else:
            rows = kept
        kept, key = None, rows[0]
        first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
        size = np.diff(np.append(first, len(key)))
        end = len(key)
        if batch is not None and size[-1] <= most:
            end = int(first[-1])
            kept = [x[end:].copy() for x in rows]
        elif size[-1] > most:
            hot = key[-1]
        if end:
            size = np.repeat(size, size)[:end]
            yield [x[:end] for x in rows], size, size > most


def _meet(batches: Iterator[pa.RecordBatch], group: int) -> Iterator[pa.RecordBatch]:
    """From sorted rows of ANCHORS those that are settled, and those whose 8 words are in several places (SEGMENT) or in more than group (HOT)."""
    for (key, ids, spot), size, over in _groups(batches, ("key", "doc_id", "spot"), group):
        if size is None:
            yield _rows(key, ids, spot)
        else:
            several = size > 1
            yield _rows(key[several], ids[several], (spot + np.where(over, HOT - SEGMENT, 0))[several])


def _ended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def prefix_key(words: list[bytes], length: int) -> int:
    return hash_of(b" ".join(words[:length]), length)


def hash_of(text: bytes, seed: int) -> int:
    return int(np.array(xxhash.xxh64_intdigest(text, seed), np.uint64).view(np.int64))


def _leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of LEAVES: segments with their words, keyed as they met; windows of hot ones, keyed by 14 words. Of equal ones in a task's slice only the earliest goes on."""
    for whole in batches:
        for batch in slices(whole, most=TEXT_AT_ONCE):
            earliest: dict[bytes, tuple[int, int]] = {}
            rows = []
            for doc, text, found in zip(column(batch, "doc_id").to_pylist(), column(batch, "text").to_pylist(), column(batch, "found").to_pylist(), strict=True):
                words = text.encode().split()
                for x in found:
                    mark, first, more, kind = unpacked(x["spot"])
                    parts = [(first, more, x["key"])] if kind == SEGMENT else [(i, 0, None) for i in range(first, first + more + 1)]
                    for lo, n, key in parts:
                        leaf = (doc, (mark << MARK_AT) | (lo << (KIND_BITS + MORE_BITS)) | (n << KIND_BITS) | kind)
                        inside = words[lo : lo + n + WINDOW]
                        window = b" ".join(inside)
                        rows.append((prefix_key(inside, PREFIXES[1]) if key is None else key, leaf, window))
                        if earliest.setdefault(window, leaf) > leaf:
                            earliest[window] = leaf
            new = [earliest[w] == leaf for _, leaf, w in rows]
            goes = [r for r, n in zip(rows, new, strict=True) if n]
            yield _rows(np.array([k for k, _, _ in goes], np.int64), np.array([x[0] for _, x, _ in goes], np.int64), np.array([x[1] for _, x, _ in goes], np.int64), [w for _, _, w in goes], True)
            rest = np.array([x for (_, x, _), n in zip(rows, new, strict=True) if not n], np.int64).reshape(-1, 2)
            who, where = rest[:, 0], rest[:, 1] >> KIND_BITS << KIND_BITS | SETTLED
            yield _rows(_scattered(who, where), who, where, None, True)


def settled_by(ids: np.ndarray, spot: np.ndarray, segments: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """doc_id and spot of the ranges that are settled by the subtrees of some segments, which come by document and place where their windows can be equal."""
    words, _, first = coded(segments)
    mark, lo, _, _ = unpacked(spot)
    count = np.maximum(np.diff(first) - WINDOW + 1, 0)
    own = np.repeat(np.arange(len(count)), count)
    step = np.arange(len(own)) - np.repeat(np.cumsum(count) - count, count)
    if not len(own):
        return ids[:0], spot[:0]
    place = lo[own] + step
    gone = later(*subtrees(words, first[:-1][own] + step), ids[own], mark[own], place)
    # Neighbouring windows of a segment are one range.
    new = gone.copy()
    new[1:] &= ~(gone[:-1] & (own[1:] == own[:-1]))
    run = np.cumsum(new)[gone]
    begins = np.flatnonzero(new)
    length = np.bincount(run, minlength=len(begins) + 1)[1:]
    return ids[own[begins]], spots(mark[own[begins]], place[begins], length - 1, SETTLED)


def _grow(batches: Iterator[pa.RecordBatch], group: int) -> Iterator[pa.RecordBatch]:
    """From sorted rows of LEAVES the settled ranges; the windows of groups with more than group rows go on, keyed by all their words."""
    for (key, ids, spot, words), size, over in _groups(batches, ("key", "doc_id", "spot", "words"), group):
        if size is None:
            yield _rows(key, ids, spot, None, True)
            continue
        if over.any():
            rows = []
            for doc, at, text in zip(ids[over].tolist(), spot[over].tolist(), words[over].tolist(), strict=True):
                mark, first, more, _ = unpacked(at)
                parts = text.split()
                for i in range(more + 1):
                    window = parts[i : i + WINDOW]
                    rows.append((prefix_key(window, WINDOW), doc, (mark << MARK_AT) | ((first + i) << (KIND_BITS + MORE_BITS)) | HOT, b" ".join(window)))
            yield _rows(*(np.array([r[k] for r in rows], np.int64) for k in range(3)), [r[3] for r in rows], True)
        some = (size > 1) & ~over
        if some.any():
            who, where = settled_by(ids[some], spot[some], words[some].tolist())
            yield _rows(np.zeros(len(who), np.int64), who, where, None, True)


def _same_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Settled ranges from windows that are sorted by their words, document and place: all but the first of equal words."""
    lead = None
    for batch in batches:
        who, where = [], []
        for doc, spot, words in zip(*(column(batch, n).to_pylist() for n in ("doc_id", "spot", "words")), strict=True):
            if lead is None or lead[0] != words:
                lead = words, doc, spot
            elif lead[1:] != (doc, spot):
                who.append(doc)
                where.append(spot - HOT + SETTLED)
        yield _rows(np.zeros(len(who), np.int64), np.array(who, np.int64), np.array(where, np.int64), None, True)


def _dealt(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition(partitions(rows.sparkSession), "key").sortWithinPartitions("key", *order, "doc_id", "spot")


def _documents(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text, mark. A null id stands for the largest number, so it comes after all others."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return df.select(F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("doc_id"), text.alias("text"), _mark(text).alias("mark"))


def _mark(text):
    return F.shiftrightunsigned(F.xxhash64(text), 64 - MARK_BITS)


def _lists(rows: DataFrame, *names: str) -> DataFrame:
    """doc_id, mark, found: of each document the spots, at most as many as it has words."""
    return rows.groupBy("doc_id", F.shiftright("spot", MARK_AT).alias("mark")).agg(F.collect_list(F.struct("spot", *names)).alias("found"))


def repeated_ranges(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> DataFrame:
    """doc_id, mark, found: of each document that has any the spots of words under windows that also start earlier. Ranges may overlap. The result doesn't depend on group, the rows of a prefix that a task holds at most."""
    spark = df.sparkSession
    docs = _documents(df, id_col, text_col)
    with Scratch(spark, "repeats") as scratch:
        met = scratch.table(_dealt(docs.mapInArrow(_anchors, ANCHORS)).mapInArrow(lambda rows: _meet(rows, group), ANCHORS), "met")
        settled = F.col("spot").bitwiseAND((1 << KIND_BITS) - 1) == SETTLED
        open_ = met.where(~settled)
        some = columns_of(may_hold(docs, "doc_id", open_.select("doc_id")).where("_maybe"), docs.columns)
        leaves = some.join(_lists(open_, "key"), ["doc_id", "mark"]).select("doc_id", "text", "found").mapInArrow(_leaves, LEAVES)
        grown = scratch.table(_dealt(leaves).mapInArrow(lambda rows: _grow(rows, group), LEAVES), "grown")
        last = _dealt(grown.where(~settled), "words").mapInArrow(_same_windows, LEAVES)
        found = met.where(settled).select("doc_id", "spot").union(grown.where(settled).select("doc_id", "spot")).union(last.select("doc_id", "spot"))
        return durable(_lists(found).select("doc_id", "mark", "found.spot").withColumnRenamed("spot", "found"), "ranges")


def kept_words(text: str, spots_: list | None) -> tuple[int, bytes, int]:
    """Number of words, the words that stay joined by a space, and their number."""
    words = text.encode().split()
    n = len(words)
    if spots_:
        stays = np.ones(n, bool)
        for x in spots_:
            _, first, more, _ = unpacked(x)
            stays[first : first + more + WINDOW] = False
        words = list(compress(words, stays.tolist()))
    return n, b" ".join(words), len(words)


def _with_ranges(df: DataFrame, id_col: str, text_col: str, group: int = GROUP) -> DataFrame:
    """_row (df's columns), text, found (null without repeats). Only rows that may have repeats are shuffled."""
    found = repeated_ranges(df, id_col, text_col, group).withColumnRenamed("doc_id", "_id").withColumnRenamed("mark", "_mark")
    text = lambda: F.col("_row").getField(text_col)
    rows = may_hold(df.withColumn("_order", F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID))), "_order", found.select("_id"))
    none = F.lit(None).cast("array<bigint>").alias("found")
    plain = rows.where("not _maybe").select("_row", text().alias("text"), none)
    key = F.coalesce(text(), F.lit(""))
    return plain.union(rows.where("_maybe").withColumn("_of", _mark(key)).join(found, (F.col("_key") == F.col("_id")) & (F.col("_of") == F.col("_mark")), "left").select("_row", text().alias("text"), "found"))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", group: int = GROUP) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 (of the words that stay, joined by a space) of each row.

    Every word under a window of 20 words whose sequence also starts earlier, by a smaller id or an earlier place, goes. Null
    and empty texts have no words; texts under 20 words lose none. A null id comes after all others. Rows that repeat an id
    and its text are one document and lose the same words; rows that share an id but not the text are documents of their own,
    in the order of a hash of their texts. An empty table gives no rows. Ids are whole numbers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                found = [kept_words(t, r) for t, r in zip(column(batch, "text").to_pylist(), column(batch, "found").to_pylist(), strict=True)]
                cols = [column(batch, "doc_id"), pa.array([n for n, _, _ in found], pa.int64()), pa.array([n - m for n, _, m in found], pa.int64()), pa.array([hashlib.sha256(k).hexdigest() for _, k, _ in found], pa.string())]
                yield pa.RecordBatch.from_arrays(cols, ["doc_id", "n_words", "n_removed", "kept_sha256"])

    rows = _with_ranges(df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text")), "doc_id", "text", group)
    kind = df.schema[id_col].dataType.simpleString()
    return rows.select(F.col("_row.doc_id").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"), "found").mapInArrow(run, f"doc_id {kind}, n_words long, n_removed long, kept_sha256 string")


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of df with what remove_repeats removes taken out of the text: its other words, joined by a space. Texts that lose nothing stay as they are, null ones too; other columns do too. Repeated rows, null ids and empty tables are as there."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t if not r else kept_words(t, r)[1].decode() for t, r in zip(column(batch, "text").to_pylist(), column(batch, "found").to_pylist(), strict=True)]
            yield pa.RecordBatch.from_arrays([column(batch, "_row"), pa.array(texts, pa.string())], ["_row", "text"])

    others = [c for c in df.columns if c != text_col]
    rows = _with_ranges(df, id_col, text_col)
    rows = rows.select(F.struct(F.lit(0).alias("_0"), *[F.col("_row").getField(c).alias(f"_c{k}") for k, c in enumerate(others)]).alias("_row"), "text", "found")
    out = rows.mapInArrow(run, rows.drop("found").schema)
    return out.select(*[(F.col("text") if c == text_col else F.col("_row").getField(f"_c{others.index(c)}")).alias(c) for c in df.columns])
