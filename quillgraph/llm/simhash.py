"""SimHash near-duplicates by anchor-point covering.

Two fingerprints at distance 2 or less agree as closely on any of their bits, so 46 of the 64 bits decide where they meet:
two blocks of 23, each with the perfect binary Golay code as its covering code (covering radius 3). An anchor is a pair of
codewords. Every fingerprint has one home, the nearest codeword of each block, and visits every anchor whose distances exceed
the covering radius by no more than the threshold over both blocks; so whoever is within the threshold of a fingerprint
visits its home. Fingerprints are compared per anchor, and an anchor's links leave it as a star for each connected part, never
as pairs. Stars are then joined to components by alternating large-star and small-star steps over written tables.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, coded, column, columns_of, durable, id_text, may_hold, sequence_hash, slices

SHINGLE, SEED, THRESHOLD = 3, 42, 2
#: Length, generator polynomial and covering radius of the binary Golay code.
GOLAY_BITS, GOLAY_POLY, RADIUS = 23, 0xC75, 3
#: Cells of a comparison matrix that are in memory at once.
CELLS = 1 << 20


def fingerprints_of(texts: list[str], words: int = SHINGLE) -> np.ndarray:
    """64-bit SimHash of each text: bit set if it is set in over half of the shingles' hashes; 0 without words."""
    hashes, counts = [], []
    digest = xxhash.xxh64_intdigest
    for text in texts:
        parts = text.encode().lower().split()  # for bytes: only A-Z are lowered, only 0x20 and 0x09-0x0D separate
        whole = b" ".join(parts)
        n = max(1, len(parts) - words + 1) if parts else 0
        if n > 1:
            ends = np.cumsum(np.fromiter(map(len, parts), np.int64, len(parts)) + 1)
            lows = np.concatenate(([0], ends[: n - 1])).tolist()
            hashes += [digest(whole[a:b], SEED) for a, b in zip(lows, (ends[words - 1 :] - 1).tolist(), strict=True)]
        elif n:
            hashes.append(digest(whole, SEED))
        counts.append(n)
    n = np.array(counts, np.int64)
    out = np.zeros(len(n), np.uint64)
    some = np.flatnonzero(n)
    if len(some):
        bits = np.unpackbits(np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        sums = np.add.reduceat(bits, np.concatenate(([0], np.cumsum(n[some])[:-1])), axis=0, dtype=np.int32)
        out[some] = np.packbits(2 * sums > n[some, None], axis=1, bitorder="little").view("<u8").ravel()
    return out


def fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE) -> DataFrame:
    """doc_id, fp (long with the fingerprint's bits) of each row; null and empty texts have fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, most=2 << 20):
                found = fingerprints_of(column(batch, "text").to_pylist(), words)
                yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    docs = id_text(df, id_col, text_col)
    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, fp long")


@cache
def golay() -> tuple[np.ndarray, list[list[np.ndarray]]]:
    """The syndrome of each single bit, and by layer 0, 1, 2 and syndrome the differences to codewords at distance up to 3, 4 and 5: each layer has those beyond the one before it."""
    single = []
    for bit in range(GOLAY_BITS):
        x = 1 << bit
        for k in range(GOLAY_BITS - 1, 10, -1):
            if x >> k & 1:
                x ^= GOLAY_POLY << (k - 11)
        single.append(x)
    layers: list[list[list[int]]] = [[[] for _ in range(2048)] for _ in range(THRESHOLD + 1)]
    for weight in range(RADIUS + THRESHOLD + 1):
        for at in combinations(range(GOLAY_BITS), weight):
            s = e = 0
            for b in at:
                s ^= single[b]
                e |= 1 << b
            layers[max(0, weight - RADIUS)][s].append(e)
    return np.array(single, np.int64), [[np.array(x, np.int64) for x in layer] for layer in layers]


def syndromes(block: np.ndarray) -> np.ndarray:
    single, _ = golay()
    out = np.zeros(len(block), np.int64)
    for bit in range(GOLAY_BITS):
        out ^= np.where(block >> bit & 1, single[bit], 0)
    return out


@cache
def padded() -> list[tuple[np.ndarray, np.ndarray]]:
    """golay()'s layers as matrices: differences by syndrome, and how many there are."""
    out = []
    for layer in golay()[1]:
        counts = np.array([len(x) for x in layer])
        table = np.zeros((2048, counts.max()), np.int64)
        for s, x in enumerate(layer):
            table[s, : len(x)] = x
        out.append((table, counts))
    return out


def anchors_of(fps: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """home: the anchor of each fingerprint; index, anchor: all that it visits, its home included."""
    low, high = fps & ((1 << GOLAY_BITS) - 1), fps >> GOLAY_BITS & ((1 << GOLAY_BITS) - 1)
    sl, sh, tables = syndromes(low), syndromes(high), padded()
    home = (low ^ tables[0][0][sl, 0]) | (high ^ tables[0][0][sh, 0]) << GOLAY_BITS
    index, anchor = [], []
    for a in range(THRESHOLD + 1):
        for b in range(THRESHOLD + 1 - a):
            (ta, ca), (tb, cb) = tables[a], tables[b]
            na, nb = ca[sl], cb[sh]
            n = na * nb
            k = np.repeat(np.arange(len(fps)), n)
            if not len(k):
                continue
            j = np.arange(len(k)) - np.repeat(np.cumsum(n) - n, n)
            index.append(k)
            anchor.append((low[k] ^ ta[sl[k], j // nb[k]]) | (high[k] ^ tb[sh[k], j % nb[k]]) << GOLAY_BITS)
    return home, np.concatenate(index or [np.zeros(0, np.int64)]), np.concatenate(anchor or [np.zeros(0, np.int64)])


def differing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Differing bits of 64-bit numbers. Of signed ones numpy would count the absolute value's."""
    return np.bitwise_count((a ^ b).view(np.uint64))


def stars(homes: np.ndarray, visits: np.ndarray, threshold: int = THRESHOLD) -> tuple[np.ndarray, np.ndarray]:
    """member, centre: links that connect what is connected through pairs (home, visit) within the threshold; one for each visit, no more."""
    label = np.arange(len(homes))
    step = max(1, CELLS // max(1, len(homes)))
    to = np.full(len(visits), len(homes))
    changed = True
    while changed:
        before = label.copy()
        for lo in range(0, len(visits), step):
            part = visits[lo : lo + step]
            near = differing(homes[:, None], part[None, :]) <= threshold
            to[lo : lo + step] = least = np.where(near, label[:, None], len(homes)).min(0)
            label = np.minimum(label, np.where(near, least[None, :], len(homes)).min(1))
        changed = not np.array_equal(before, label) and len(visits) > 0
    linked = to < len(homes)
    return np.concatenate((visits[linked], homes)), np.concatenate((homes[to[linked]], homes[label]))


def anchor_links(classes: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """a, b: links between different fingerprints (column fp, each once) that connect all that are within the threshold of each other."""

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = column(batch, "fp").to_numpy()
            for lo in range(0, len(fps), 20_000):
                part = fps[lo : lo + 20_000]
                home, index, anchor = anchors_of(part)
                for at, who, role in ((home, part, 0), (anchor, part[index], 1)):
                    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.full(len(at), role, np.int8)), pa.array(who)], ["anchor", "role", "fp"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [np.zeros(0, np.int64), np.zeros(0, np.int8), np.zeros(0, np.int64)]
        for batch in with_end(batches):
            if batch is not None:
                kept = [np.concatenate((x, column(batch, n).to_numpy())) for x, n in zip(kept, ("anchor", "role", "fp"), strict=True)]
            anchor, role, fp = kept
            if not len(anchor):
                continue
            done = len(anchor) if batch is None else int(np.searchsorted(anchor, anchor[-1]))
            kept = [x[done:].copy() for x in kept]
            anchor, role, fp = anchor[:done], role[:done], fp[:done]
            if not done:
                continue
            first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
            ends = np.append(first[1:], done)
            homes = np.add.reduceat((role == 0).astype(np.int64), first)
            rows = ends - first
            members, centres = [], []
            for g in np.flatnonzero((homes > 0) & (rows - homes > 1)).tolist():
                lo, mid, hi = first[g], first[g] + homes[g], ends[g]
                m, c = stars(fp[lo:mid], fp[mid:hi], threshold)
                apart = m != c
                members.append(m[apart])
                centres.append(c[apart])
            if members:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(members)), pa.array(np.concatenate(centres))], ["a", "b"])

    met = classes.select("fp").mapInArrow(spread, "anchor long, role byte, fp long")
    return met.repartition("anchor").sortWithinPartitions("anchor", "role", "fp").mapInArrow(compare, "a long, b long")


def with_end(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch | None]:
    yield from batches
    yield None


def components(links: DataFrame, scratch: Scratch | None = None) -> DataFrame:
    """node, root: the least node of the component of each node that has a link in links (a, b). Alternating star steps, each over a written table, until nothing changes. With a scratch of the caller's, the result reads its tables."""
    if scratch is None:
        with Scratch(links.sparkSession, "links") as own:
            return durable(components(links, own), "components")
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    edges, state = scratch.table(edges, "links"), None
    while True:
        # Large star: the larger neighbours of each node go to the least of its neighbourhood.
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        # Small star: a node and its smaller neighbours go to the least of these.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v"))).distinct()
        edges = scratch.table(small, "links")
        now = edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            return edges.groupBy(F.col("u").alias("node")).agg(F.min("v").alias("root"))
        state = now


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE, threshold: int = THRESHOLD, scratch: Scratch | None = None) -> DataFrame:
    """doc_id, fp, component_id of each row: the smallest doc_id that links of at most threshold (0 to 2) differing bits reach.

    Null and empty texts have fingerprint 0, which links like any other. Equal fingerprints are one node, so groups of copies
    are never expanded. Rows with a null doc_id link too but never name a component. Repeated rows repeat; an empty table gives none.
    With a scratch of the caller's, the result reads its tables.
    """
    if not 0 <= threshold <= THRESHOLD:
        raise ValueError(f"threshold {threshold} isn't in 0 to {THRESHOLD}")
    if scratch is None:
        with Scratch(df.sparkSession, "near") as own:
            return durable(near_duplicates(df, id_col, text_col, words, threshold, own), "components")
    prints = scratch.table(fingerprints(df, id_col, text_col, words), "fingerprints")
    classes = scratch.table(prints.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    roots = components(anchor_links(classes, threshold), scratch)
    classes = classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    named = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    of = classes.join(named, "root").select("fp", "component_id")
    return prints.join(of, "fp").select("doc_id", "fp", "component_id")


def as_hex(fp: str = "fp"):
    return F.lpad(F.lower(F.hex(fp)), 16, "0")


# Similar texts, for stages that keep one of each group.

#: Rows of a key up to which all its pairs are checked at once, and rows of a larger one that one task compares with as many others.
SMALL, BLOCK = 16, 4096
#: Least bits of a text's parity map, bytes of maps that are compared at once, and documents and shingles of the order's sample.
PARITY, MAPS_AT_ONCE, SAMPLED, COMMON = 256, 8 << 20, 8000, 200_000
LONGER = 5


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """Of each text the distinct hashes of its shingles, sorted; that of the whole sequence if it is shorter."""
    ids, hashes, first = coded([t.encode().lower() for t in texts])
    by_place = hashes[ids] if len(ids) else hashes
    whole = sequence_hash(by_place, np.arange(max(0, len(ids) - words + 1)), words)
    out = []
    for lo, hi in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if hi - lo >= words:
            out.append(np.unique(whole[lo : hi - words + 1]))
        else:
            out.append(sequence_hash(by_place, np.array([lo]), hi - lo) if hi > lo else np.zeros(0, np.uint64))
    return out


def common_shingles(docs: DataFrame, words: int = LONGER) -> np.ndarray:
    """Shingles of several documents of a bounded sample, the most frequent last. Whatever it holds, the order that it gives is the same for all texts; it only keeps hot shingles out of prefixes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, most=1 << 20):
                sets = shingle_sets(column(batch, "text").to_pylist(), words)
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(sets).view(np.int64))], ["h"])

    share = min(1 << 20, (SAMPLED << 20) // max(1, docs.count()))
    some = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < share).mapInArrow(run, "h long")
    rows = some.groupBy("h").count().where("count > 2").orderBy(F.desc("count"), "h").limit(COMMON).collect()
    return np.array([r.h for r in reversed(rows)], np.int64)


def prefixes(docs: DataFrame, words: int = LONGER, similarity: float = 0.8) -> DataFrame:
    """doc_id, digest, n, parity, prefix: of each text's set of shingles a hash, the number, the parity map and the first shingles, so many that sets as similar as that have one in common."""
    common = common_shingles(docs, words)
    by_hash = np.argsort(common)
    shared = docs.sparkSession.sparkContext.broadcast((common[by_hash], by_hash))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = shared.value
        for whole in batches:
            for batch in slices(whole, most=1 << 20):
                digests, parity, firsts = [], [], []
                sets = shingle_sets(column(batch, "text").to_pylist(), words)
                for found in sets:
                    digests.append(digest_of(found))
                    parity.append(parity_map(found))
                    signed = found.view(np.int64)
                    place = np.zeros(len(signed), np.int64)
                    if len(known):
                        at = np.minimum(np.searchsorted(known, signed), len(known) - 1)
                        place = np.where(known[at] == signed, rank[at] + 1, 0)
                    least = len(found) - int(np.ceil(similarity * len(found) - 1e-9)) + 1 if len(found) else 0
                    firsts.append(signed[np.lexsort((signed, place))[:least]])
                columns = [column(batch, "doc_id"), pa.array(digests, pa.int64()), pa.array(map(len, sets), pa.int32()), pa.array(parity, pa.binary())]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(firsts, pa.list_(pa.int64()))], ["doc_id", "digest", "n", "parity", "prefix"])

    return docs.mapInArrow(run, "doc_id long, digest long, n int, parity binary, prefix array<long>")


def parity_map(found: np.ndarray) -> bytes:
    """For each of some bits whether an odd number of hashes fall on it. 2 to 4 bits for each hash: a map of half as many bits is the exclusive or of its halves."""
    bits = max(PARITY, 1 << (2 * len(found)).bit_length())
    return np.packbits(np.bincount((found & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1).tobytes()


def odd_bits(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """For pairs of parity maps the number of bits in which they differ, at the smaller one's size: no more than hashes that only one has."""
    out = np.zeros(len(a), np.int64)
    sizes = np.array([(len(x), len(y)) for x, y in zip(a, b, strict=True)], np.int64).reshape(-1, 2)
    for la, lb in np.unique(sizes, axis=0).tolist():
        rows = np.flatnonzero((sizes[:, 0] == la) & (sizes[:, 1] == lb))
        step = max(1, MAPS_AT_ONCE // (la + lb))
        for lo in range(0, len(rows), step):
            part = rows[lo : lo + step]
            x, y = (np.frombuffer(b"".join([m[k] for k in part.tolist()]), np.uint64).reshape(len(part), -1) for m in (a, b))
            while x.shape[1] > y.shape[1]:
                x = x[:, : x.shape[1] // 2] ^ x[:, x.shape[1] // 2 :]
            while y.shape[1] > x.shape[1]:
                y = y[:, : y.shape[1] // 2] ^ y[:, y.shape[1] // 2 :]
            out[part] = np.bitwise_count(x ^ y).sum(1, dtype=np.int64)
    return out


def digest_of(found: np.ndarray) -> int:
    """A set's hash as a signed number."""
    return int(np.array(xxhash.xxh64_intdigest(found.tobytes(), SEED), np.uint64).view(np.int64))


def may_be(a: np.ndarray, b: np.ndarray, similarity: float) -> np.ndarray:
    """Whether sets can be similar if the first shingle that they share has these sizes (high 32 bits) and places (low 32 bits)."""
    na, nb = a >> 32, b >> 32
    return np.minimum(na - (a & 0xFFFFFFFF), nb - (b & 0xFFFFFFFF)) >= similarity / (1 + similarity) * (na + nb) - 1e-6


CELL = "kind byte, key long, digest long, spot long, lead long, block long"
PAIR, MEMBER = 0, 1


def _cells(kind: int, *columns: np.ndarray) -> pa.RecordBatch:
    """Rows of CELL: a pair (digest, lead) to be checked, or a member of a large key with its lead (0: they can't be similar) and block."""
    n = len(columns[1])
    return pa.RecordBatch.from_arrays([pa.array(np.full(n, kind, np.int8)), *(pa.array(c) for c in columns)], ["kind", "key", "digest", "spot", "lead", "block"])


def met(sets: DataFrame, similarity: float) -> DataFrame:
    """Rows of CELL from the prefixes: all pairs of the shingles (key) that 2 to SMALL sets have, and the members of larger ones, each to be checked with the key's least digest."""

    def pairs(key: np.ndarray, digest: np.ndarray, spot: np.ndarray, first: np.ndarray, size: np.ndarray) -> Iterator[pa.RecordBatch]:
        for s in np.unique(size[(size > 1) & (size <= SMALL)]).tolist():
            i, j = np.triu_indices(s, 1)
            at = first[size == s]
            i, j = (at[:, None] + i).ravel(), (at[:, None] + j).ravel()
            fine = may_be(spot[i], spot[j], similarity)
            a, b = digest[i[fine]], digest[j[fine]]
            if len(a):
                a, b = np.unique(np.stack((np.minimum(a, b), np.maximum(a, b)), 1), axis=0).T
                zero = np.zeros(len(a), np.int64)
                yield _cells(PAIR, zero, a, zero, b, zero)

    def members(key: int, seen: int, lead: tuple[int, int], digest: np.ndarray, spot: np.ndarray) -> pa.RecordBatch:
        fine = may_be(spot, np.full(len(spot), lead[1]), similarity) & (digest != lead[0])
        return _cells(MEMBER, np.full(len(digest), key), digest, spot, np.where(fine, lead[0], 0), (seen + np.arange(len(digest))) // BLOCK)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Of the key that goes on: its rows, or, once they are over SMALL, its number of rows and its lead.
        names, none = ("key", "digest", "spot"), np.zeros(0, np.int64)
        kept, large, seen, lead = [none] * 3, None, 0, (0, 0)
        for batch in with_end(batches):
            key, digest, spot = [column(batch, c).to_numpy() for c in names] if batch is not None else [none] * 3
            if large is not None and len(key):
                goes = int(np.searchsorted(key, large, "right"))
                if goes:
                    yield members(large, seen, lead, digest[:goes], spot[:goes])
                    seen += goes
                    key, digest, spot = key[goes:], digest[goes:], spot[goes:]
                if len(key):
                    large = None
            key, digest, spot = (np.concatenate((x, y)) for x, y in zip(kept, (key, digest, spot), strict=True))
            kept = [none] * 3
            if not len(key):
                continue
            first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
            size = np.diff(np.append(first, len(key)))
            if batch is not None and size[-1] <= SMALL:
                kept = [x[first[-1] :].copy() for x in (key, digest, spot)]
                first, size = first[:-1], size[:-1]
            yield from pairs(key, digest, spot, first, size)
            for lo, n in zip(first[size > SMALL].tolist(), size[size > SMALL].tolist(), strict=True):
                large, seen, lead = int(key[lo]), n, (int(digest[lo]), int(spot[lo]))
                yield members(large, 0, lead, digest[lo : lo + n], spot[lo : lo + n])
            if not (len(size) and size[-1] > SMALL and not len(kept[0])):
                large = None

    rows = sets.select("digest", "n", F.posexplode("prefix").alias("place", "key"))
    rows = rows.select("key", "digest", (F.shiftleft(F.col("n").cast("long"), 32) + F.col("place")).alias("spot"))
    return rows.repartition("key").sortWithinPartitions("key", "digest").mapInArrow(run, CELL)


def pairs_across(members: DataFrame, roots: DataFrame, classes: DataFrame, scratch: Scratch, similarity: float) -> DataFrame:
    """a, b: the pairs with different roots that meet under large keys, as sizes, places and parity maps allow, each under the first key that both have of those with several roots (what meets under a smaller key before it is checked already). A key of many blocks is dealt out as pairs of blocks."""
    kinds = {"key": np.int64, "low": np.int64, "high": np.int64, "block": np.int64, "digest": np.int64, "spot": np.int64, "root": np.int64}

    def groups(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        kept = [np.zeros(0, t) for t in kinds.values()] + [np.zeros(0, object)] * 2
        for batch in with_end(batches):
            if batch is not None:
                for lo in range(0, batch.num_rows, BLOCK):
                    part = batch.slice(lo, BLOCK)
                    more = [column(part, c).to_numpy(zero_copy_only=False) for c in (*kinds, "parity", "before")]
                    kept = [np.concatenate((x, y)) for x, y in zip(kept, more, strict=True)]
                    new = np.any([x[1:] != x[:-1] for x in kept[:3]], axis=0)
                    cuts = [0, *(np.flatnonzero(new) + 1).tolist()]
                    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                        yield [x[a:b] for x in kept]
                    kept = [x[cuts[-1] :].copy() for x in kept]
            elif len(kept[0]):
                yield kept

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, low, high, block, digest, spot, root, maps, before in groups(batches):
            if root.min() == root.max():
                continue
            left, right = np.flatnonzero(block == low[0]), np.flatnonzero(block == high[0])
            step = max(1, (1 << 16) // max(1, len(right)))
            for lo in range(0, len(left), step):
                i, j = np.meshgrid(left[lo : lo + step], right, indexing="ij")
                i, j = i.ravel(), j.ravel()
                fine = (i < j) & (root[i] != root[j])
                i, j = i[fine], j[fine]
                fine = may_be(spot[i], spot[j], similarity)
                i, j = i[fine], j[fine]
                fine = odd_bits(maps[i], maps[j]) <= _apart(spot[i] >> 32, spot[j] >> 32, similarity)
                i, j = i[fine], j[fine]
                had = {k: set(before[k].tolist()) for k in np.unique(i).tolist()}
                fine = np.array([had[x].isdisjoint(before[y].tolist()) for x, y in zip(i.tolist(), j.tolist(), strict=True)], bool)
                i, j = i[fine], j[fine]
                if len(i):
                    yield pa.RecordBatch.from_arrays([pa.array(np.minimum(digest[i], digest[j])), pa.array(np.maximum(digest[i], digest[j]))], ["a", "b"])

    rooted = members.select("key", "digest", "spot", "block").join(roots, "digest", "left").withColumn("root", F.coalesce("root", "digest"))
    several = rooted.groupBy("key").agg(F.max("block").alias("last"), F.min("root").alias("_l"), F.max("root").alias("_h")).where("_l < _h").select("key", "last")
    open_ = scratch.table(rooted.join(several, "key").withColumn("place", F.col("spot").bitwiseAND(0xFFFFFFFF)), "open")
    places = open_.groupBy("digest").agg(F.array_sort(F.collect_list(F.struct("place", "key"))).alias("places"))
    before = F.transform(F.filter("places", lambda x: x.place < F.col("place")), lambda x: x.key)
    dealt = open_.join(places, "digest").join(classes.select("digest", "parity"), "digest").withColumn("before", before)
    dealt = dealt.withColumn("_o", F.explode(F.sequence(F.lit(0).cast("long"), "last")))
    dealt = dealt.withColumns({"low": F.least("block", "_o"), "high": F.greatest("block", "_o")}).select(*kinds, "parity", "before")
    return dealt.repartition("key", "low", "high").sortWithinPartitions("key", "low", "high", "digest").mapInArrow(run, "a long, b long").distinct()


def _apart(na, nb, similarity: float):
    """The most shingles that only one of two similar sets has. Each flips one bit of the difference of their parity maps at most."""
    return (1 - similarity) / (1 + similarity) * (na + nb) + 1e-6


def checked(pairs: DataFrame, docs: DataFrame, classes: DataFrame, scratch: Scratch, words: int, similarity: float) -> DataFrame:
    """The pairs (a, b) of digests whose sets have at least that Jaccard similarity, by exact comparison of those that the parity maps allow. classes says which document has a digest's text."""

    def allowed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fine = odd_bits(*(column(batch, c).to_pylist() for c in ("pa", "pb"))) <= _apart(column(batch, "na").to_numpy().astype(np.int64), column(batch, "nb").to_numpy(), similarity)
            yield batch.select(["a", "b"]).filter(pa.array(fine))

    def shingled(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole, most=1 << 20):
                sets = shingle_sets(column(batch, "text").to_pylist(), words)
                yield pa.RecordBatch.from_arrays([pa.array(map(digest_of, sets), pa.int64()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], ["digest", "shingles"])

    of = lambda s: classes.select(F.col("digest").alias(s), F.col("n").alias(f"n{s}"), F.col("parity").alias(f"p{s}"))
    open_ = scratch.table(pairs.join(of("a"), "a").join(of("b"), "b").select("a", "b", "na", "nb", "pa", "pb").mapInArrow(allowed, "a long, b long"), "pairs")
    needed = open_.select(F.col("a").alias("digest")).union(open_.select(F.col("b").alias("digest"))).distinct()
    wanted = scratch.table(classes.select("digest", "least").join(needed, "digest", "left_semi").select(F.col("least").alias("doc_id")), "wanted")
    some = columns_of(may_hold(docs, "doc_id", wanted).where("_maybe"), docs.columns).join(wanted, "doc_id", "left_semi")
    sets = scratch.table(some.mapInArrow(shingled, "digest long, shingles array<long>").dropDuplicates(["digest"]), "shingles")
    one = lambda s: sets.select(F.col("digest").alias(s), F.col("shingles").alias(f"_{s}"))
    both = F.size(F.array_intersect("_a", "_b"))
    near = scratch.table(open_.join(one("a"), "a").join(one("b"), "b").where(both >= similarity * (F.size("_a") + F.size("_b") - both)).select("a", "b"), "near")
    scratch.drop("pairs", "wanted", "shingles")
    return near


def similar_links(docs: DataFrame, scratch: Scratch, words: int = LONGER, similarity: float = 0.8) -> tuple[DataFrame, DataFrame]:
    """members (doc_id, digest) of all documents, and links (a, b) between digests that connect all whose shingles have a Jaccard similarity of at least similarity. Documents with one digest have the same shingles.

    Similar sets share a shingle of their prefixes (the first of each in one order of all shingles), so every such pair meets
    under some key. Small keys give all their pairs. All members of a large one are first checked against one lead; then
    every pair of it that isn't connected yet is checked too, so that none is lost and a large group of near copies isn't
    expanded to pairs. Empty texts are one class.
    """
    sets = scratch.table(prefixes(docs, words, similarity), "prefixes")
    texts = scratch.table(sets.select("doc_id", "digest", "n", "parity"), "texts")
    # One row of each digest; rows that repeat an id and its text are alike.
    leads = scratch.table(texts.groupBy("digest").agg(F.min("doc_id").alias("least")), "leads")
    once = lambda of: of.join(leads.select(F.col("digest").alias("_d"), "least"), (F.col("doc_id") == F.col("least")) & (F.col("digest") == F.col("_d")))
    classes = scratch.table(once(texts).select("digest", "least", "n", "parity").dropDuplicates(["digest"]), "classes")
    cells = scratch.table(met(once(sets).select("digest", "n", "prefix"), similarity), "cells")
    scratch.drop("prefixes", "leads")
    led = cells.where("kind = 0 or lead <> 0").select(F.least("digest", "lead").alias("a"), F.greatest("digest", "lead").alias("b")).distinct()
    first = checked(led, docs, classes, scratch, words, similarity)
    members = cells.where(F.col("kind") == MEMBER)
    if members.isEmpty():
        return texts.select("doc_id", "digest"), first
    roots = components(first, scratch).withColumnRenamed("node", "digest")
    across = pairs_across(members, roots, classes, scratch, similarity).join(led, ["a", "b"], "left_anti")
    return texts.select("doc_id", "digest"), first.union(checked(across, docs, classes, scratch, words, similarity))


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = LONGER, similarity: float = 0.8) -> DataFrame:
    """The rows of df, but of each group only the one with the smallest id. A group is what two kinds of links connect: fingerprints within the threshold (near_duplicates), and Jaccard similarity of shingles of so many words from similarity on.

    Ids are whole numbers. Null and empty texts are one group. Rows with a null id stay; rows that repeat an id stay or go
    together, and their texts' groups are one. An empty table gives none. Other columns stay as they are.
    """
    spark = df.sparkSession
    docs = id_text(df, id_col, text_col).where("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    with Scratch(spark, "near") as scratch:
        members, near = similar_links(docs, scratch, words, similarity)
        prints = near_duplicates(docs, scratch=scratch).select("doc_id", F.col("component_id").alias("root"))
        # What one id, or one component of fingerprints, holds is linked through the least digest of it.
        grouped = scratch.table(members.join(prints, "doc_id").select("root", "digest").distinct(), "grouped")
        least = grouped.groupBy("root").agg(F.min("digest").alias("least"))
        links = grouped.join(least, "root").where("digest <> least").select(F.col("digest").alias("a"), F.col("least").alias("b"))
        roots = components(near.union(links), scratch)
        of = scratch.table(members.join(roots, F.col("digest") == F.col("node"), "left").select("doc_id", F.coalesce("root", "digest").alias("root")), "roots")
        first = of.groupBy("root").agg(F.min("doc_id").alias("keeper"))
        gone = durable(of.join(first, "root").where("doc_id <> keeper").select(F.col("doc_id").alias("_gone")).distinct(), "gone")
    rows = may_hold(df, id_col, gone)
    rest = rows.where("_maybe").join(gone, F.col("_key") == F.col("_gone"), "left_anti")
    return columns_of(rows.where("not _maybe").union(rest), df.columns)
