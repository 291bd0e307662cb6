"""Best-fit packing of tokenised documents into sequences of bounded length.

Bounded-space online best fit: pieces come one by one and go into the open bin with the least free space that is enough. Open
bins are found through a bitset with a bit for each amount of free space, so a placement takes a few operations on one
integer. When the number of open bins is at its limit, the fullest closes first. Each task packs its own share of the pieces;
the bins that it still has open at its end (no more than that limit) are items of a second, much smaller packing, so that
many tasks don't leave many half-empty sequences.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from .bpe import byte_alphabet
from .common import column, durable, id_text, partitions, slices

#: Open bins of a task at most; tasks whose rests are packed again together.
MAX_OPEN, FAN_IN = 1024, 64
CACHE_ENTRIES, CACHE_CHARS = 250_000, 48
#: What the vocabulary's public pattern finds in lower-cased text before U+0250.
EARLY_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\t-\r \x85\xa0\p{L}\p{N}]+").findall


class BestFit:
    """Open bins by free space. place(n) gives (bin, offset) for an item of n units, 1 <= n <= capacity."""

    def __init__(self, capacity: int, max_open: int = MAX_OPEN) -> None:
        self.capacity, self.max_open = capacity, max_open
        self.bits, self.stacks, self.count, self.bins = 0, [[] for _ in range(capacity + 1)], 0, 0

    def _take(self, free: int) -> int:
        stack = self.stacks[free]
        found = stack.pop()
        if not stack:
            self.bits ^= 1 << free
        self.count -= 1
        return found

    def place(self, n: int) -> tuple[int, int]:
        if not 1 <= n <= self.capacity:
            raise ValueError(f"an item of {n} doesn't fit {self.capacity}")
        fits = self.bits >> n
        if fits:
            free = n + (fits & -fits).bit_length() - 1
            at = self._take(free)
        else:
            free, at = self.capacity, self.bins
            self.bins += 1
        if free > n:
            left = free - n
            if not self.stacks[left]:
                self.bits |= 1 << left
            self.stacks[left].append(at)
            self.count += 1
            if self.count > self.max_open:  # the fullest closes, which may be the one just filled
                self._take((self.bits & -self.bits).bit_length() - 1)
        return at, self.capacity - free

    def still_open(self) -> list[tuple[int, int]]:
        """(bin, units in it) of the bins that are open."""
        return [(b, self.capacity - free) for free, stack in enumerate(self.stacks) for b in stack]


class WordTokens:
    """Ids of texts under a tokenizers file whose words end with a mark of their own and for which a space always separates.

    Parts between spaces are encoded once and kept in a bounded cache. Letters before U+0250 have one lower case and no
    combining forms, so parts of them are lowered and split here, and their words merged in one call each; other text, and
    text that may hold special tokens, goes through the library as it is.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        mark, alphabet, vocab = model["end_of_word_suffix"], byte_alphabet(), model["vocab"]

        def marked(token: str) -> bytes:
            """Bytes of a token; the end of a word is byte 255, which UTF-8 never has."""
            end = token.endswith(mark)
            return bytes(map(alphabet.__getitem__, token.removesuffix(mark) if end else token)) + b"\xff" * end

        # The end joins the last byte before anything else merges: such pairs rank below all merges.
        ranks = {bytes([b]): b for b in range(256)} | {bytes([b, 255]): 256 + b for b in range(256)}
        for a, b in (m if isinstance(m, list) else m.split(" ") for m in model["merges"]):
            ranks[marked(a) + marked(b)] = len(ranks)
        ids = {marked(t): i for t, i in vocab.items()}
        self.core = tiktoken.Encoding("words", pat_str=r"\S+|\s+", mergeable_ranks=ranks, special_tokens={})._core_bpe.encode_single_piece
        self.ids = [ids.get(t, 0).to_bytes(4, "little") for t in ranks]
        self.known: dict[str, bytes] = {"": b""}

    def word(self, word: str) -> bytes:
        return b"".join(map(self.ids.__getitem__, self.core(word.encode() + b"\xff")))

    def part(self, part: str) -> bytes:
        if part.isalpha():
            return self.word(part)
        known, out = self.known, []
        for w in EARLY_WORDS(part):
            if (ids := known.get(w)) is None:
                ids = self.word(w)
                if len(w) <= CACHE_CHARS:
                    known[w] = ids
            out.append(ids)
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if "<|" in text or not (text.isascii() or max(text) < "\u0250"):
            return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        parts, known = text.lower().replace("\n", " ").split(" "), self.known
        if len(known) > CACHE_ENTRIES:
            known.clear()
            known[""] = b""
        out = list(map(known.get, parts))
        k = -1
        for _ in range(out.count(None)):
            k = out.index(None, k + 1)
            p = parts[k]
            out[k] = ids = self.part(p)
            if len(p) <= CACHE_CHARS:
                known[p] = ids
        return b"".join(out)


_LOADED: dict[str, WordTokens] = {}


def word_tokens(path: str) -> Callable[[str], bytes]:
    if path not in _LOADED:
        _LOADED[path] = WordTokens(path)
    return _LOADED[path].encode


def cut_pieces(df: DataFrame, path: str, capacity: int, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32: each text's ids, then end_id, cut into pieces of capacity; only the last is shorter. A null or empty text is end_id alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, tail, step = word_tokens(path), end_id.to_bytes(4, "little"), 4 * capacity
        for whole in batches:
            for batch in slices(whole):
                index, piece, length, crc = [], [], [], []
                for k, text in enumerate(column(batch, "text").to_pylist()):
                    ids = encode(text) + tail
                    for p, at in enumerate(range(0, len(ids), step)):
                        part = ids[at : at + step]
                        index.append(k)
                        piece.append(p)
                        length.append(len(part) // 4)
                        crc.append(zlib.crc32(part))
                piece = pa.array(piece, pa.int32())
                start = pa.array(np.array(piece, np.int64) * capacity)
                yield pa.RecordBatch.from_arrays([column(batch, "doc_id").take(pa.array(index, pa.int64())), piece, start, pa.array(length, pa.int64()), pa.array(crc, pa.int64())], ["doc_id", "piece", "start", "length", "ids_crc32"])

    docs = id_text(df, id_col, text_col)
    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, piece int, start long, length long, ids_crc32 long")


def best_fit(pieces: DataFrame, capacity: int, max_open: int = MAX_OPEN, tasks: int | None = None) -> DataFrame:
    """The rows of pieces (doc_id, piece, length of 1 to capacity, and others) with sequence_id and offset: places in sequences of at most capacity units, without gaps.

    Ties go to the bin that was opened or left last. Repeated rows are placed each on their own; an empty table gives none. A
    task's rows are sorted first, so that the result doesn't depend on the order in which shuffled rows arrive. Other columns stay;
    those named sequence_id and offset give way to the places.
    """
    n = tasks or partitions(pieces.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, base = BestFit(capacity, max_open), TaskContext.get().partitionId() << 40
        kind = None
        for batch in batches:
            row = column(batch, "_row")
            kind = row.type
            places = [fit.place(x) for x in column(batch, "_length").to_pylist()]
            at = np.array(places, np.int64).reshape(-1, 2)
            rest = pa.nulls(batch.num_rows, pa.int64())
            yield pa.RecordBatch.from_arrays([row, pa.array(at[:, 0] + base), pa.array(at[:, 1]), rest], ["_row", "sequence_id", "offset", "rest"])
        if kind is not None and (left := fit.still_open()):
            bins = pa.array([b + base for b, _ in left], pa.int64())
            yield pa.RecordBatch.from_arrays([pa.nulls(len(left), kind), bins, pa.nulls(len(left), pa.int64()), pa.array([x for _, x in left], pa.int64())], ["_row", "sequence_id", "offset", "rest"])

    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fit, base = BestFit(capacity, max_open), (TaskContext.get().partitionId() << 40) + (1 << 62)
        for batch in batches:
            at = np.array([fit.place(x) for x in column(batch, "rest").to_pylist()], np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([column(batch, "sequence_id"), pa.array(at[:, 0] + base), pa.array(at[:, 1])], ["sequence_id", "_to", "_base"])

    rows = pieces.select(F.struct(*[F.col(f"`{c}`").alias(f"_{k}") for k, c in enumerate(pieces.columns)]).alias("_row"), "doc_id", "piece", F.col("length").alias("_length"))
    dealt = rows.repartition(n, F.xxhash64("doc_id"), "piece").sortWithinPartitions(F.xxhash64("doc_id"), "doc_id", "piece", "_length").select("_row", "_length")
    placed = durable(dealt.mapInArrow(run, f"_row {dealt.schema['_row'].dataType.simpleString()}, sequence_id long, offset long, rest long"), "packed")
    rests = placed.where("rest is not null").select("sequence_id", "rest")
    moved = rests.repartition(max(1, n // FAN_IN), "sequence_id").sortWithinPartitions(F.desc("rest"), "sequence_id").mapInArrow(again, "sequence_id long, _to long, _base long")
    out = placed.where("rest is null").drop("rest").join(moved, "sequence_id", "left")
    carried = [F.col("_row").getField(f"_{k}").alias(c) for k, c in enumerate(pieces.columns) if c not in ("sequence_id", "offset")]
    return out.select(*carried, F.coalesce("_to", "sequence_id").alias("sequence_id"), (F.col("offset") + F.coalesce("_base", F.lit(0))).alias("offset"))


def pack_documents(df: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids_crc32, sequence_id, offset of every piece of every document.

    A null or empty text is one piece of end_id. Null ids and repeated rows are packed like others; an empty table gives none.
    Other columns of df aren't read.
    """
    return best_fit(cut_pieces(df, path, capacity, end_id, id_col, text_col), capacity)
