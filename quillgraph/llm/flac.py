"""FLAC media columns: byte payloads stored as 8-bit mono samples, read back with every checksum verified.

The writer gives each block of 576 samples the smallest of a constant, verbatim, fixed-predictor or linear-predictor subframe,
with Rice-coded residuals, and a seek point per block. The reader uses the seek points to decode all blocks side by side: one
step reads the next Rice code of thousands of blocks at once. Without a point for each block it goes block by block. Frame
headers (CRC-8), frames (CRC-16), the stream's sample count and its MD5 are verified; a damaged stream raises FlacError.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import column, id_text, slices

BLOCK, RATE = 576, 8000
#: Fixed values of the format: frame header of a mono 8-bit block of 576 samples at 8 kHz, and the checksums' polynomials.
HEADER, CRC8, CRC16 = bytes([0xFF, 0xF8, 0x24, 0x02]), 0x07, 0x8005
#: Blocks that are worked on at once, bits of a linear coefficient, its shift, and the largest Rice parameter tried.
AT_ONCE, PRECISION, SHIFT, MOST_RICE = 2048, 9, 7, 8
LPC_ORDER = 2


class FlacError(ValueError):
    """A stream that isn't FLAC, is damaged, or isn't mono with 8 bits a sample."""


@cache
def crc_table(poly: int, bits: int, length: int) -> np.ndarray:
    """What byte b adds to the checksum (initially 0) when k bytes follow it, at [k, b]; a checksum is the XOR of these."""
    top, mask = 1 << (bits - 1), (1 << bits) - 1
    x = np.arange(256, dtype=np.uint32) << (bits - 8)
    for _ in range(8):
        x = np.where(x & top, (x << 1) ^ poly, x << 1) & mask
    rows = [x]
    for _ in range(length - 1):
        last = rows[-1]
        rows.append(((last << 8) & mask) ^ x[last >> (bits - 8)])
    return np.array(rows, np.uint16)


def crcs(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray, poly: int, bits: int) -> np.ndarray:
    """The checksum of each non-empty range of raw."""
    n = ends - starts
    index = np.arange(int(n.sum())) - np.repeat(np.cumsum(n) - n, n)
    follow = np.repeat(n, n) - index - 1
    # Lengths go up in steps, so that few tables are built and kept.
    table = crc_table(poly, bits, 64 << max(0, int(n.max() - 1).bit_length() - 6))
    return np.bitwise_xor.reduceat(table[follow, raw[np.repeat(starts, n) + index]], np.cumsum(n) - n)


def coded_number(n: int) -> bytes:
    """A frame's number as the format writes it: UTF-8's scheme, on to 36 bits."""
    if n < 0x80:
        return bytes([n])
    tail = []
    size = next(k for k in range(2, 8) if n < 1 << (5 * k + 1))
    for _ in range(size - 1):
        tail.append(0x80 | n & 0x3F)
        n >>= 6
    return bytes([(0xFF00 >> size) & 0xFF | n, *reversed(tail)])


def rice_size(zigzag: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Parameter and bits of each row's codes, for the better of the two parameters about the mean."""
    n = zigzag.shape[1]
    guess = np.clip(np.log2(np.maximum(zigzag.sum(1, dtype=np.int64) / n * 0.6931471805599453, 1e-9)).astype(np.int64), 0, MOST_RICE - 1)
    sizes = [n * (guess + k + 1) + (zigzag >> (guess + k)[:, None].astype(zigzag.dtype)).sum(1, dtype=np.int64) for k in (0, 1)]
    better = sizes[1] < sizes[0]
    return guess + better, np.minimum(*sizes)


def linear_coefficients(x: np.ndarray) -> np.ndarray:
    """Quantised second-order coefficients of each row, from exact integer autocorrelations."""
    wide = x.astype(np.int64)
    r0, r1, r2 = (wide * wide).sum(1), (wide[:, 1:] * wide[:, :-1]).sum(1), (wide[:, 2:] * wide[:, :-2]).sum(1)
    det = (r0 * r0 - r1 * r1).astype(np.float64)
    safe = np.where(det > 0, det, 1)
    c = np.stack([r1 * (r0 - r2) / safe, (r0 * r2 - r1 * r1) / safe], 1)
    top = (1 << (PRECISION - 1)) - 1
    return np.where(det[:, None] > 0, np.clip(np.rint(c * (1 << SHIFT)), -top - 1, top), 0).astype(np.int32)


def zigzag(e: np.ndarray) -> np.ndarray:
    return (e << 1) ^ (e >> 31)


def encode_blocks(samples: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The frames of blocks (rows of 576 signed 8-bit samples) in a row, and where each ends."""
    x = samples.astype(np.int32)
    n = len(x)
    coefficients = linear_coefficients(x)
    guess = (coefficients[:, :1] * x[:, 1:-1] + coefficients[:, 1:] * x[:, :-2]) >> SHIFT
    # kind: fixed orders 0 to 2, linear, then verbatim and constant; head: bits before the codes.
    residuals = [x, np.diff(x, axis=1), np.diff(x, 2, axis=1), x[:, 2:] - guess]
    heads = [18, 26, 34, 8 + 16 + 9 + LPC_ORDER * PRECISION + 10]
    coded = [zigzag(e) for e in residuals]
    rice, bits = zip(*[rice_size(u) for u in coded], strict=True)
    size = np.stack([*[b + h for b, h in zip(bits, heads, strict=True)], np.full(n, 8 + 8 * BLOCK), np.where((x == x[:, :1]).all(1), 16, 1 << 30)], 1)
    kind = size.argmin(1)
    body = (size[np.arange(n), kind] + 7) // 8
    body_at = np.cumsum(body) - body
    packed = np.zeros(int(body.sum()), np.uint8)
    for which in range(4):
        rows = np.flatnonzero(kind == which)
        if not len(rows):
            continue
        u, k = coded[which][rows], rice[which][rows].astype(np.int64)
        warm = 0 if which == 0 else min(which, 2)
        fields = [(np.full(len(rows), 0x40 | (LPC_ORDER - 1) << 1 if which == 3 else 0x10 | which << 1), 8)]
        fields += [(x[rows, i] & 0xFF, 8) for i in range(warm)]
        if which == 3:
            fields += [(np.full(len(rows), PRECISION - 1), 4), (np.full(len(rows), SHIFT), 5)]
            fields += [(coefficients[rows, i] & ((1 << PRECISION) - 1), PRECISION) for i in range(LPC_ORDER)]
        fields += [(np.zeros(len(rows), np.int64), 6), (k, 4)]
        width = body[rows]
        row_at = 8 * (np.cumsum(width) - width)
        plane = np.zeros(int(8 * width.sum()), np.uint8)
        at = row_at.copy()
        for value, count in fields:
            for b in range(count - 1, -1, -1):
                plane[at] = value >> b & 1
                at += 1
        for param in np.unique(k):
            own = k == param
            part = u[own]
            q = part >> param
            length = q + (1 + int(param))
            one = at[own][:, None] + np.cumsum(length, axis=1) - 1 - int(param)
            plane[one] = 1
            for b in range(int(param)):
                plane[one + (1 + b)] = part >> (int(param) - 1 - b) & 1
        put = np.repeat(body_at[rows] - (np.cumsum(width) - width), width) + np.arange(int(width.sum()))
        packed[put] = np.packbits(plane)
    for which, tag in ((4, 2), (5, 0)):
        rows = np.flatnonzero(kind == which)
        packed[body_at[rows]] = tag
        span = BLOCK if which == 4 else 1
        packed[body_at[rows][:, None] + 1 + np.arange(span)] = samples[rows, :span].view(np.uint8)
    heads_raw = [HEADER + coded_number(i) for i in numbers.tolist()]
    head_len = np.fromiter(map(len, heads_raw), np.int64, n)
    flat = np.frombuffer(b"".join(heads_raw), np.uint8)
    head_ends = np.cumsum(head_len)
    small = crcs(flat, head_ends - head_len, head_ends, CRC8, 8)
    total = head_len + 1 + body + 2
    ends = np.cumsum(total)
    starts = ends - total
    out = np.zeros(int(total.sum()), np.uint8)
    out[np.repeat(starts - (head_ends - head_len), head_len) + np.arange(len(flat))] = flat
    out[starts + head_len] = small
    out[np.repeat(starts + head_len + 1 - body_at, body) + np.arange(len(packed))] = packed
    large = crcs(out, starts, ends - 2, CRC16, 16)
    out[ends - 2], out[ends - 1] = large >> 8, large & 0xFF
    return out, ends


def encode_many(payloads: list[bytes]) -> list[bytes]:
    """A FLAC stream for each payload, whose length must be a positive multiple of 576. A stream depends on its payload alone."""
    if any(not p or len(p) % BLOCK for p in payloads):
        raise FlacError(f"a payload isn't a positive multiple of {BLOCK} bytes")
    blocks = np.array([len(p) // BLOCK for p in payloads])
    samples = (np.frombuffer(b"".join(payloads), np.uint8) ^ 0x80).view(np.int8).reshape(-1, BLOCK)
    numbers = np.arange(len(samples)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
    parts, lengths = [], []
    for lo in range(0, len(samples), AT_ONCE):
        raw, ends = encode_blocks(samples[lo : lo + AT_ONCE], numbers[lo : lo + AT_ONCE])
        parts.append(raw.tobytes())
        lengths.append(np.diff(ends, prepend=0))
    raw, length = b"".join(parts), np.concatenate(lengths)
    ends = np.cumsum(length)
    out, at, block = [], 0, 0
    for p, count in zip(payloads, blocks.tolist(), strict=True):
        own = length[block : block + count]
        stop = int(ends[block + count - 1])
        rate_bits = (RATE << 44 | 0 << 41 | 7 << 36 | len(p)).to_bytes(8, "big")
        digest = hashlib.md5(samples[block : block + count].tobytes(), usedforsecurity=False).digest()
        info = BLOCK.to_bytes(2, "big") * 2 + int(own.min()).to_bytes(3, "big") + int(own.max()).to_bytes(3, "big") + rate_bits + digest
        points = np.zeros(count, [("sample", ">u8"), ("offset", ">u8"), ("count", ">u2")])
        points["sample"], points["offset"], points["count"] = np.arange(count) * BLOCK, np.cumsum(own) - own, BLOCK
        # A metadata block holds under 16 MB, so a longer table goes on in another one.
        table, step = points.tobytes(), 18 * 900_000
        pieces = [table[i : i + step] for i in range(0, len(table), step)]
        seek = b"".join(bytes([0x83 if i == len(pieces) - 1 else 3]) + len(t).to_bytes(3, "big") + t for i, t in enumerate(pieces))
        out.append(b"fLaC" + bytes([0, 0, 0, 34]) + info + seek + raw[at:stop])
        at, block = stop, block + count
    return out


class Stream:
    """The metadata of a mono 8-bit stream: size of a block, samples, MD5, first byte of the frames, and seek points as (samples, offsets)."""

    def __init__(self, raw: bytes) -> None:
        if raw[:4] != b"fLaC":
            raise FlacError("it doesn't begin with fLaC")
        at, last, points = 4, False, []
        self.samples = -1
        while not last:
            if at + 4 > len(raw):
                raise FlacError("the metadata break off")
            last, kind, size = raw[at] >> 7, raw[at] & 0x7F, int.from_bytes(raw[at + 1 : at + 4], "big")
            body = raw[at + 4 : at + 4 + size]
            if kind == 0:
                bits = int.from_bytes(body[10:18], "big")
                if (bits >> 41 & 7, bits >> 36 & 31) != (0, 7) or body[:2] != body[2:4]:
                    raise FlacError("only mono streams with 8 bits a sample and blocks of one size are read")
                self.block, self.samples, self.md5 = int.from_bytes(body[:2], "big"), bits & ((1 << 36) - 1), body[18:34]
            elif kind == 3:
                points.append(np.frombuffer(body, [("sample", ">u8"), ("offset", ">u8"), ("count", ">u2")]))
            at += 4 + size
        if self.samples < 0 or not self.block:
            raise FlacError("it has no STREAMINFO")
        self.frames = at
        table = np.concatenate(points) if points else np.zeros(0, [("sample", ">u8"), ("offset", ">u8"), ("count", ">u2")])
        table = table[table["sample"] != np.uint64(0xFFFFFFFFFFFFFFFF)]
        self.points = table["sample"].astype(np.int64), table["offset"].astype(np.int64)
        self.count = -(-self.samples // self.block)

    def indexed(self) -> bool:
        """Whether each block has its seek point."""
        return len(self.points[0]) == self.count and bool((self.points[0] == np.arange(self.count) * self.block).all())


@cache
def leading_zeros() -> np.ndarray:
    return np.array([16 - int(x).bit_length() for x in range(1 << 16)], np.uint8)


class Bits:
    """Reads of up to 32 bits at many places of a byte array at once."""

    def __init__(self, raw: np.ndarray) -> None:
        padded = np.concatenate((raw, np.zeros(16, np.uint8)))
        self.window = np.zeros(len(raw) + 8, np.uint64)
        for k in range(8):
            self.window |= padded[k : k + len(self.window)].astype(np.uint64) << np.uint64(56 - 8 * k)
        self.end = 8 * len(raw)

    def top(self, at: np.ndarray) -> np.ndarray:
        if len(at) and int(at.max()) > self.end:
            raise FlacError("a frame breaks off")
        return self.window[at >> 3] << (at & 7).astype(np.uint64)

    def read(self, at: np.ndarray, count: int) -> np.ndarray:
        return (self.top(at) >> np.uint64(64 - count)).astype(np.int64)

    def signed(self, at: np.ndarray, count: int) -> np.ndarray:
        x = self.read(at, count)
        return x - ((x >> (count - 1)) << count)


def residuals(bits: Bits, at: np.ndarray, order: int, block: int) -> tuple[np.ndarray, np.ndarray]:
    """Rice-coded residuals [block - order, frames] that begin at the given bits, and where they end."""
    method, parts = bits.read(at, 2), 1 << bits.read(at + 2, 4)
    at = at + 6
    if (method > 1).any():
        raise FlacError("an unknown residual coding")
    out = np.zeros((block - order, len(at)), np.int64)
    for same in np.unique(np.stack([method, parts], 1), axis=0):
        own = np.flatnonzero((method == same[0]) & (parts == same[1]))
        pos, wide, count = at[own], 4 + int(same[0]), int(same[1])
        if block % count or block // count < order:
            raise FlacError("a partition order that doesn't fit the block")
        row = 0
        for p in range(count):
            k = bits.read(pos, wide)
            pos = pos + wide
            if (k == (1 << wide) - 1).any():
                raise FlacError("escaped partitions aren't read")
            rest, ku = (63 - k).astype(np.uint64), k.astype(np.uint64)
            for _ in range(block // count - (order if p == 0 else 0)):
                v = bits.window[pos >> 3] << (pos & 7).astype(np.uint64)
                q = leading_zeros()[v >> np.uint64(48)]
                if q.max(initial=0) < 16:
                    u = (v << (q + np.uint8(1)).astype(np.uint64)) >> np.uint64(1) >> rest
                    out[row, own] = (q.astype(np.uint64) << ku | u).view(np.int64)
                    pos = pos + (k + 1 + q)
                else:
                    quotient = np.zeros(len(pos), np.int64)
                    more = np.ones(len(pos), bool)
                    while more.any():
                        lead = leading_zeros()[bits.read(pos, 16)].astype(np.int64)
                        quotient += np.where(more, lead, 0)
                        pos = pos + np.where(more, lead + (lead < 16), 0)
                        more &= lead == 16
                    u = bits.top(pos) >> np.uint64(1) >> rest
                    out[row, own] = quotient << k | u.view(np.int64)
                    pos = pos + k
                row += 1
            if len(pos) and int(pos.max()) > bits.end:
                raise FlacError("a frame breaks off")
        at[own] = pos
    return (out >> 1) ^ -(out & 1), at


def decode_frames(raw: np.ndarray, starts: np.ndarray, numbers: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Samples [frames, largest size] of frames that begin at the given bytes, and where each frame ends. Numbers and sizes are what their headers must say."""
    bits, n = Bits(raw), len(starts)
    at = starts * 8
    if (bits.read(at, 16) != 0xFFF8).any():
        raise FlacError("a frame doesn't begin with its sync code")
    code, lead = bits.read(at + 16, 4), bits.read(at + 32, 8)
    if (bits.read(at + 24, 8) & 0xF1).any() or (~np.isin(bits.read(at + 28, 3), (0, 1))).any():
        raise FlacError("only mono frames with 8 bits a sample are read")
    more = np.where(lead < 0x80, 0, 8 - np.array([int(x ^ 0xFF).bit_length() for x in lead.tolist()]) - 1)
    number = np.where(more == 0, lead, lead & (0x3F >> np.minimum(more, 6)))
    for k in range(1, int(more.max(initial=0)) + 1):
        number = np.where(k <= more, number << 6 | bits.read(at + 32 + 8 * k, 8) & 0x3F, number)
    extra = np.where(code == 6, 1, np.where(code == 7, 2, 0))
    after = at + 40 + 8 * more
    block = np.where(code == 1, 192, np.where((code >= 2) & (code <= 5), 576 << np.maximum(code - 2, 0), np.where(code >= 8, 256 << np.maximum(code - 8, 0), 0)))
    block = np.where(code == 6, bits.read(after, 8) + 1, np.where(code == 7, bits.read(after, 16) + 1, block))
    rate = bits.read(at + 20, 4)
    head = 5 + more + extra + np.where(rate == 12, 1, np.where((rate == 13) | (rate == 14), 2, 0))
    if (crcs(raw, starts, starts + head, CRC8, 8) != raw[np.minimum(starts + head, len(raw) - 1)]).any():
        raise FlacError("a frame header's CRC-8 is wrong")
    if (number != numbers).any() or (block != sizes).any():
        raise FlacError("a frame's number or size is wrong")
    at = (starts + head + 1) * 8
    tag = bits.read(at, 8)
    if (tag & 0x81).any():
        raise FlacError("subframes with wasted bits aren't read")
    kind = tag >> 1
    out = np.zeros((n, int(sizes.max(initial=0))), np.int8)
    end = at.copy()
    for which, size in {(int(a), int(b)) for a, b in zip(kind, sizes, strict=True)}:
        rows = np.flatnonzero((kind == which) & (sizes == size))
        pos = at[rows] + 8
        if which == 0:
            out[rows, :size] = bits.signed(pos, 8)[:, None]
            end[rows] = pos + 8
        elif which == 1:
            if int(pos.max()) // 8 + size > len(raw):
                raise FlacError("a frame breaks off")
            out[rows, :size] = raw[(pos >> 3)[:, None] + np.arange(size)].view(np.int8)
            end[rows] = pos + 8 * size
        elif 8 <= which <= 12 or which >= 32:
            order = which - 8 if which <= 12 else which - 31
            x = np.zeros((size, len(rows)), np.int64)
            for i in range(order):
                x[i] = bits.signed(pos, 8)
                pos = pos + 8
            if which >= 32:
                precision, shift = bits.read(pos, 4) + 1, bits.signed(pos + 4, 5)
                if (precision == 16).any() or (shift < 0).any():
                    raise FlacError("an invalid linear predictor")
                pos, c = pos + 9, []
                for _ in range(order):
                    value = (bits.top(pos) >> (64 - precision).astype(np.uint64)).astype(np.int64)
                    c.append(value - ((value >> (precision - 1)) << precision))
                    pos = pos + precision
            e, end[rows] = residuals(bits, pos, order, size)
            x[order:] = e
            if which >= 32:
                for i in range(order, size):
                    x[i] += sum(c[j] * x[i - 1 - j] for j in range(order)) >> shift
            else:
                # A fixed predictor of order o is undone by o running sums, each begun with the warm-up's own difference.
                warm = [np.diff(x[:order], k, axis=0)[-1:] for k in range(order)]
                y = e
                for k in range(order - 1, -1, -1):
                    y = np.cumsum(np.concatenate((warm[k], y)), axis=0)[1:]
                x[order:] = y
            out[rows, :size] = x.T
        else:
            raise FlacError("a reserved subframe type")
    ends = (end + 7) // 8 + 2
    if len(ends) and int(ends.max()) > len(raw):
        raise FlacError("a frame breaks off")
    if (crcs(raw, starts, ends - 2, CRC16, 16) != (raw[ends - 2].astype(np.int64) << 8 | raw[ends - 1])).any():
        raise FlacError("a frame's CRC-16 is wrong")
    return out, ends


def decode_many(streams: list[bytes]) -> list[bytes]:
    """The payload of each stream, all checksums verified."""
    heads = [Stream(s) for s in streams]
    starts, numbers, sizes, whose = [], [], [], []
    out: list[list[bytes]] = [[] for _ in streams]
    at = np.concatenate(([0], np.cumsum([len(s) for s in streams])))
    for k, h in enumerate(heads):
        size = np.full(h.count, h.block)
        if h.count:
            size[-1] = h.samples - h.block * (h.count - 1)
        if h.indexed():
            starts.append(at[k] + h.frames + h.points[1])
            numbers.append(np.arange(h.count))
            sizes.append(size)
            whose.append(np.full(h.count, k))
        else:
            raw, pos = np.frombuffer(streams[k], np.uint8), h.frames
            for i in range(h.count):
                got, end = decode_frames(raw[pos : pos + 16 + 4 * h.block], np.zeros(1, np.int64), np.array([i]), size[i : i + 1])
                out[k].append(got[0, : size[i]].tobytes())
                pos += int(end[0])
    if starts:
        whole = np.frombuffer(b"".join(streams), np.uint8)
        starts, numbers, sizes, whose = map(np.concatenate, (starts, numbers, sizes, whose))
        for lo in range(0, len(starts), AT_ONCE):
            part = slice(lo, lo + AT_ONCE)
            base, stop = int(starts[part][0]), int(starts[lo + AT_ONCE] if lo + AT_ONCE < len(starts) else len(whole))
            got, _ = decode_frames(whole[base:stop], starts[part] - base, numbers[part], sizes[part])
            cuts = np.flatnonzero(np.diff(whose[part])) + 1
            for rows, k in zip(np.split(np.arange(len(got)), cuts), whose[part][[0, *cuts]].tolist(), strict=True):
                full = got[rows]
                out[k].append(full[:-1].tobytes() + full[-1, : sizes[part][rows[-1]]].tobytes())
    result = []
    for h, parts in zip(heads, out, strict=True):
        pcm = b"".join(parts)
        if len(pcm) != h.samples or hashlib.md5(pcm, usedforsecurity=False).digest() != h.md5:
            raise FlacError("the samples' count or MD5 is wrong")
        result.append((np.frombuffer(pcm, np.uint8) ^ 0x80).tobytes())
    return result


def padded(text: str) -> bytes:
    raw = text.encode()
    return raw + b"\xff" * (-len(raw) % BLOCK or (0 if raw else BLOCK))


def feature_of(payload: bytes) -> str:
    """Peak, sum, energy and sign changes of the samples, as integers."""
    x = (np.frombuffer(payload, np.uint8) ^ 0x80).view(np.int8).astype(np.int64)
    return f"peak={np.abs(x).max()};sum={x.sum()};energy={(x * x).sum()};turns={np.count_nonzero((x[1:] < 0) != (x[:-1] < 0))}"


def write_media(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, media: each text's UTF-8 bytes, padded with 255 to a positive multiple of 576, as a FLAC stream. Null is empty; equal texts give equal streams."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, most=2 << 20):
                payloads = [padded(t) for t in column(batch, "text").to_pylist()]
                sizes = pa.array([len(t.encode()) for t in column(batch, "text").to_pylist()], pa.int64())
                yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), sizes, pa.array(encode_many(payloads), pa.binary())], ["doc_id", "n_bytes", "media"])

    docs = id_text(df, id_col, text_col)
    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, n_bytes long, media binary")


def media_slices(batches: Iterator[pa.RecordBatch], most: int = 2 << 20) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    for batch in batches:
        lo, media = 0, column(batch, "media")
        sizes = np.cumsum(np.array([0, *[len(x) for x in media.to_pylist()]], np.int64))
        while lo < batch.num_rows:
            hi = max(lo + 1, int(np.searchsorted(sizes, sizes[lo] + most, "right")) - 1)
            yield batch.slice(lo, hi - lo), media.slice(lo, hi - lo).to_pylist()
            lo = hi


def pcm_blocks(df: DataFrame, id_col: str = "doc_id", media_col: str = "media") -> DataFrame:
    """doc_id, block, sample_offset, pcm of every block of 576 samples (unsigned bytes) of each stream; rows with null media give none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, media in media_slices(batches):
            who, block, pcm = [], [], []
            for k, payload in enumerate(decode_many(media)):
                for i, at in enumerate(range(0, len(payload), BLOCK)):
                    who.append(k)
                    block.append(i)
                    pcm.append(payload[at : at + BLOCK])
            ids = column(batch, "doc_id").take(pa.array(who, pa.int64()))
            yield pa.RecordBatch.from_arrays([ids, pa.array(block, pa.int64()), pa.array(np.array(block, np.int64) * BLOCK), pa.array(pcm, pa.binary())], ["doc_id", "block", "sample_offset", "pcm"])

    rows = df.where(F.col(media_col).isNotNull()).select(F.col(id_col).alias("doc_id"), F.col(media_col).alias("media"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, block long, sample_offset long, pcm binary")


def read_media(df: DataFrame) -> DataFrame:
    """doc_id, n_bytes, payload_bytes, payload_sha256, tail_crc32, media_bytes, media_sha256, feature of the rows of write_media, from the stored streams alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sha = lambda x: hashlib.sha256(x).hexdigest()
        for batch, media in media_slices(batches):
            payloads = decode_many(media)
            yield pa.RecordBatch.from_arrays(
                [
                    column(batch, "doc_id"),
                    column(batch, "n_bytes"),
                    pa.array(map(len, payloads), pa.int64()),
                    pa.array(map(sha, payloads), pa.string()),
                    pa.array([zlib.crc32(p[-32:]) for p in payloads], pa.int64()),
                    pa.array(map(len, media), pa.int64()),
                    pa.array(map(sha, media), pa.string()),
                    pa.array(map(feature_of, payloads), pa.string()),
                ],
                ["doc_id", "n_bytes", "payload_bytes", "payload_sha256", "tail_crc32", "media_bytes", "media_sha256", "feature"],
            )

    kind = df.schema["doc_id"].dataType.simpleString()
    return df.select("doc_id", "n_bytes", "media").mapInArrow(run, f"doc_id {kind}, n_bytes long, payload_bytes long, payload_sha256 string, tail_crc32 long, media_bytes long, media_sha256 string, feature string")
