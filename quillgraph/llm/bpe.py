"""Byte-level BPE encoding and decoding by forced-boundary splitting.

A pair of adjacent bytes that occurs inside no vocabulary token can't be bridged by any merge, so it marks a certain cut:
the fragments on its two sides are encoded independently and their ids concatenated. Cuts are taken at two levels. Between
a byte that isn't white space and a space, the cut is also a certain border of the pre-tokeniser (none of its alternatives
goes on from a non-space to a space), so whole texts fall into short fragments that recur and are kept in a bounded cache.
Within a pre-token, the table of cuts splits what the cache doesn't know.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .common import column, id_text, slices

#: Entries of a worker's cache after which it starts anew, and characters of a key at most.
CACHE_ENTRIES, CACHE_CHARS = 300_000, 48
#: What the byte-level pre-tokeniser's public pattern finds, for text before U+0250.
EARLY_WORDS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\t-\r \x85\xa0\p{L}\p{N}]+|[\t-\r \x85\xa0]+(?![^\t-\r \x85\xa0])|[\t-\r \x85\xa0]+").findall
PACK = [struct.Struct(f"<{n}I").pack for n in range(32)]


def byte_alphabet() -> dict[str, int]:
    """The printable stand-ins that byte-level vocabularies write for bytes: printable Latin-1 stands for itself, the rest follow from 256 on."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


class ForcedBoundaryBPE:
    """Encoder and decoder for a byte-level vocabulary file of the tokenizers library (no normaliser, no prefix space)."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model, alphabet = spec["model"], byte_alphabet()
        to_bytes = lambda token: bytes(alphabet[c] for c in token)
        vocab = {to_bytes(t): i for t, i in model["vocab"].items()}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.alphabet = alphabet
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        if spec.get("normalizer") or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"{path} isn't a plain byte-level vocabulary")
        by_rank = {bytes([b]): vocab[bytes([b])] for b in range(256)}
        for a, b in merges:
            x = to_bytes(a) + to_bytes(b)
            by_rank[x] = vocab[x]
        if len(by_rank) != len(vocab) or any(by_rank[x] >= by_rank[y] for x, y in zip([*by_rank][256:], [*by_rank][257:], strict=False)):
            raise ValueError(f"{path}: the ids of merges don't follow their ranks")
        #: Merges the pair of least rank in one fragment, again and again; special tokens and patterns play no part.
        self.core = tiktoken.Encoding("fragments", pat_str=r"\S+|\s+", mergeable_ranks=by_rank, special_tokens={})._core_bpe.encode_single_piece
        self.tokens = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for t, i in vocab.items():
            self.tokens[i] = t
        for t, i in self.special.items():
            self.tokens[i] = t.encode()
        joined = {p for t in vocab for p in zip(t, t[1:], strict=False)}
        #: cut[a][b]: no token has byte b right after byte a.
        self.cut = [bytes((a, b) not in joined for b in range(256)) for a in range(256)]
        if not all(self.cut[b][32] for b in range(128) if b != 32 and not 9 <= b <= 13):
            raise ValueError(f"{path} has tokens that go on from a non-space to a space")
        self.pre = Tokenizer.from_file(path).pre_tokenizer
        self.fragments: dict[str, bytes] = {}

    def pretoken(self, raw: bytes) -> bytes:
        """Ids (little-endian unsigned 32 bit) of one pre-token: its fragments between certain cuts, one by one."""
        cut, core = self.cut, self.core
        at = [k for k, (a, b) in enumerate(zip(raw, raw[1:], strict=False), 1) if cut[a][b]]
        if not at:
            ids = core(raw)
        else:
            ids = [i for lo, hi in zip([0, *at], [*at, len(raw)], strict=True) for i in core(raw[lo:hi])]
        return PACK[len(ids)](*ids) if len(ids) < len(PACK) else struct.pack(f"<{len(ids)}I", *ids)

    def words(self, text: str) -> list[str]:
        """The pre-tokens of a fragment. Of letters before U+0250 all versions of Unicode say the same; other text goes to the library's own pattern."""
        if text.isascii() or max(text) < "\u0250":
            return EARLY_WORDS(text)
        return [bytes(map(self.alphabet.__getitem__, w)).decode() for w, _ in self.pre.pre_tokenize_str(text)]

    def fragment(self, text: str) -> bytes:
        """Ids of a text that begins and ends at certain cuts."""
        known, out = self.fragments, []
        for word in self.words(text):
            spaced = word[0] == " " and len(word) > 1 and not word[-1].isspace()
            if not spaced or (ids := known.get(word[1:])) is None:
                ids = self.pretoken(word.encode())
                if spaced and len(word) <= CACHE_CHARS:
                    known[word[1:]] = ids
            out.append(ids)
        return b"".join(out)

    def plain(self, text: str) -> bytes:
        """Ids of a text without special tokens. fragments: ids of space + key, for keys that don't end in white space."""
        parts, known = text.split(" "), self.fragments
        if len(known) > CACHE_ENTRIES:
            known.clear()
        out = list(map(known.get, parts))
        out[0] = self.fragment(parts[0]) if parts[0] and not parts[0][-1].isspace() else None
        n, k, done = len(parts), -1, out.count(None)
        while done:
            k = out.index(None, k + 1)
            whole, j = parts[k], k
            if k and whole.isalpha() and (whole.isascii() or max(whole) < "\u0250"):
                ids = self.pretoken((" " + whole).encode())
                if len(whole) <= CACHE_CHARS:
                    known[whole] = ids
            else:
                # The fragment ends where a non-space is followed by a space, or with the text.
                while j + 1 < n and (not parts[j] or parts[j][-1].isspace()):
                    j += 1
                if j > k:
                    whole = " ".join(parts[k : j + 1])
                ids = self.fragment(" " + whole if k else whole) if k or whole else b""
                if k and j == k and whole and len(whole) <= CACHE_CHARS and not whole[-1].isspace():
                    known[whole] = ids
            out[k] = ids
            done -= 1
            for i in range(k + 1, j + 1):
                done -= out[i] is None
                out[i] = b""
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers; special tokens in the text become their ids, as in the library."""
        at = min((p for s in self.special if (p := text.find(s)) >= 0), default=-1)
        if at < 0:
            return self.plain(text)
        s = max((s for s in self.special if text.startswith(s, at)), key=len)
        out = []
        while at >= 0:
            out += [self.plain(text[:at]), self.special[s].to_bytes(4, "little")]
            text = text[at + len(s) :]
            at = min((p for t in self.special if (p := text.find(t)) >= 0), default=-1)
            if at >= 0:
                s = max((t for t in self.special if text.startswith(t, at)), key=len)
        return b"".join([*out, self.plain(text)])

    def decode(self, ids: bytes) -> str:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist())).decode("utf-8", "replace")


_LOADED: dict[str, ForcedBoundaryBPE] = {}


def load(path: str) -> ForcedBoundaryBPE:
    """The vocabulary, read once in each Python worker."""
    if path not in _LOADED:
        _LOADED[path] = ForcedBoundaryBPE(path)
    return _LOADED[path]


def encode_texts(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, ids (array of int) of every text; a null text is empty and has no ids. Rows are independent: repeated rows repeat, an empty table gives none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for whole in batches:
            for batch in slices(whole):
                ids = [np.frombuffer(bpe.encode(t), "<u4").astype(np.int32) for t in column(batch, "text").to_pylist()]
                yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    docs = id_text(df, id_col, text_col)
    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode_ids(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """doc_id, text of every list of ids; null decodes as the empty list."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            texts = [bpe.decode(np.array(x or [], "<u4").tobytes()) for x in column(batch, "ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    rows = df.select(df[id_col].alias("doc_id"), df[ids_col].alias("ids"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, text string")


def round_trip(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: each text is encoded, and its ids are decoded again.

    Null and empty texts have no tokens and the digests of nothing. No shuffle; memory is that of one text and the caches.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, sha = load(path), lambda x: hashlib.sha256(x).hexdigest()
        for whole in batches:
            for batch in slices(whole):
                ids = [bpe.encode(t) for t in column(batch, "text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [column(batch, "doc_id"), pa.array([len(x) // 4 for x in ids], pa.int64()), pa.array(map(sha, ids), pa.string()), pa.array([sha(bpe.decode(x).encode()) for x in ids], pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    docs = id_text(df, id_col, text_col)
    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_tokens long, ids_sha256 string, decoded_sha256 string")
