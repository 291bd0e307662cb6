"""The ten operators against brute-force versions, on the smallest table and on a table of odd rows."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quillgraph.llm import bpe, flac, langid, packing, quality, queries, sharding, simhash, substrings, toxicity, warc
from quillgraph.llm.oracles import ORACLES

from ..conftest import SF
from ..test_oracles import compared

BYTE, WORD = (public_tokenizers.path(f) for f in ("byte_bpe_50k.json", "word_bpe_49k.json"))
ODD = ["", None, " ", "\n\n", "word", "The cat sat. " * 30, "The cat sat. " * 30, "ÄÖÜ ß straße ΣΑΣ İ", "日本語 テスト 中文", "\x00 \x1c\x85", "a" * 3000, "x  y\t\tz \xa0 w", "<|endoftext|> don't ''s", "# $ % & | < >\n# $ % & | < >", "🙂 👨‍👩‍👧 é́ "]


@pytest.fixture(scope="session")
def odd(spark):
    """Null ids, texts, languages and sources, repeated rows, very long texts, and columns whose names operators use themselves."""
    rows = [(i if i != 3 else None, x, None if i % 4 == 0 else "en", None if i % 5 == 0 else "s", "k", 1, "w") for i, x in enumerate(ODD)]
    rows += [rows[5], rows[5], (90, " ".join(f"long{i % 9000}" for i in range(20_000)), "en", "s", "k", 1, "w"), (91, " ".join(f"p{i}" for i in range(60)), "de", "s", "k", 1, "w"), (92, "tail " + " ".join(f"p{i}" for i in range(60)), "de", "s", "k", 1, "w")]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, key string, row int, w string").repartition(3).persist()


@pytest.fixture(scope="session")
def none(odd):
    return odd.limit(0)


@pytest.fixture(scope="session")
def documents(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


def texts_of(df):
    return [(r.doc_id, r.text or "") for r in df.select("doc_id", "text").collect()]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


def sha(x):
    return hashlib.sha256(x).hexdigest()


# Registered queries with SQL.


@pytest.mark.parametrize("name", sorted(n for n in ORACLES if n in queries.QUERIES))
def test_sql(spark, name):
    compared(spark, queries.QUERIES[name], ORACLES[name])


# 1


def test_bpe_is_the_librarys(odd, none, documents):
    own = Tokenizer.from_file(BYTE)
    for df in (odd, documents, none):
        rows = texts_of(df)
        expected = []
        for i, x in rows:
            ids = own.encode(x, add_special_tokens=False).ids
            expected.append((i, len(ids), sha(np.array(ids, "<u4").tobytes()), sha(own.decode(ids, skip_special_tokens=False).encode())))
        assert Counter(map(tuple, bpe.round_trip(df, BYTE).collect())) == Counter(expected)
    ids = bpe.encode_texts(odd, BYTE)
    assert Counter((r.doc_id, r.text) for r in bpe.decode_ids(ids, BYTE).collect()) == Counter(texts_of(odd))


PARTS = st.lists(st.sampled_from([" ", "  ", "\n", "\t", "a", "the", "ing", "'s", "'", "ß", "é", "9", "10", ".", "!!", "<|endoftext|>", "<|", "\xa0", "日", "Σ", "İ", "é", "X"]), max_size=30).map("".join)


@settings(max_examples=100, deadline=None)
@given(PARTS | st.text(max_size=40))
def test_tokenizers_agree_on_anything(text):
    text = text.encode("utf-8", "ignore").decode()
    for own, path in ((bpe.load(BYTE).encode, BYTE), (packing.word_tokens(WORD), WORD)):
        assert own(text) == np.array(library(path).encode(text, add_special_tokens=False).ids, "<u4").tobytes()


_LIBRARY = {}


def library(path):
    return _LIBRARY.setdefault(path, Tokenizer.from_file(path))


# 2


def test_packing(odd, none, documents):
    own = Tokenizer.from_file(WORD)
    for df in (odd, documents):
        expected = Counter()
        for i, x in texts_of(df):
            ids = own.encode(x, add_special_tokens=False).ids + [0]
            expected.update((i, p, at, len(ids[at : at + 2048]), zlib.crc32(np.array(ids[at : at + 2048], "<u4").tobytes())) for p, at in enumerate(range(0, len(ids), 2048)))
        rows = packing.pack_documents(df, WORD).collect()
        assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in rows) == expected
        places = defaultdict(list)
        for r in rows:
            places[r.sequence_id].append((r.offset, r.length))
        for x in places.values():
            at = 0
            for offset, length in sorted(x):
                assert offset == at
                at += length
            assert at <= 2048
        least = sum(r.length for r in rows) / 2048
        assert len(places) <= 1.03 * least + 2
    assert packing.pack_documents(none, WORD).count() == 0


@settings(max_examples=50, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=200), st.integers(1, 8))
def test_best_fit_takes_the_fullest_that_fits(sizes, most):
    fit, free, opened = packing.BestFit(64, most), {}, set()
    for n in sizes:
        at, offset = fit.place(n)
        if at in free:
            assert free[at] >= n and free[at] == min(f for b, f in free.items() if f >= n and b in opened)
        free[at] = free.get(at, 64) - n
        opened = {b for b, _ in fit.still_open()}
        assert len(opened) <= most and offset == 64 - free[at] - n
    with pytest.raises(ValueError):
        fit.place(65)


# 3


def removed(rows):
    seen, out = {}, {}
    for i, x in sorted({(1 << 63 if i is None else i, x) for i, x in rows}):
        w, gone = words(x), set()
        for k in range(len(w) - 19):
            if seen.setdefault(tuple(w[k : k + 20]), (i, k)) != (i, k):
                gone |= set(range(k, k + 20))
        kept = " ".join(v for k, v in enumerate(w) if k not in gone)
        out[i, x] = (len(w), len(gone), sha(kept.encode()))
    return out


def test_substrings(odd, none, documents):
    for df in (odd, documents):
        rows = texts_of(df)
        expected = removed(rows)
        want = Counter((i, *expected[1 << 63 if i is None else i, x]) for i, x in rows)
        assert Counter(map(tuple, substrings.remove_repeats(df).collect())) == want
    assert substrings.remove_repeats(none).count() == 0
    kept = substrings.without_repeats(odd)
    assert kept.columns == odd.columns and kept.where("doc_id = 92").first()["text"] == "tail"
    assert kept.where("doc_id = 91").first()["text"].startswith("p0 p1")


def test_branches_across_tasks(spark):
    """Passages in many documents, over many partitions and batches."""
    rng = np.random.default_rng(3)
    fresh = lambda n: [f"w{x}" for x in rng.integers(0, 10**9, n)]
    passages = [fresh(int(n)) for n in rng.integers(18, 60, 6)] + [["a"] * 50, ["a", "b"] * 30]
    rows = []
    for i in range(300):
        x = fresh(int(rng.integers(0, 30)))
        for p in rng.integers(0, len(passages), int(rng.integers(0, 4))):
            x += passages[p][int(rng.integers(0, 5)) :] + fresh(int(rng.integers(0, 12)))
        rows.append((i, " ".join(x)))
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    want = removed(rows)
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substrings.remove_repeats(df).collect()} == {i: v for (i, _), v in want.items()}


# 4


def test_sharding(odd, none, documents):
    for df in (odd, documents):
        rows = sharding.shard_by_bytes(df).collect()
        expected = Counter((i, len(x.encode()) + 1, zlib.crc32(x.encode())) for i, x in texts_of(df))
        assert Counter((r.doc_id, r.size, r.text_crc32) for r in rows) == expected
        slots, shard_of = defaultdict(list), {}
        for r in rows:
            slots[r.shard].append(r.slot)
            assert shard_of.setdefault((r.size, r.text_crc32), r.shard) == r.shard
        assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    total = Counter()
    for r in sharding.shard_by_bytes(documents).collect():
        total[r.shard] += r.size
    assert max(total.values()) - min(total.values()) <= 8
    assert sharding.shard_by_bytes(none).count() == 0


def test_differencing_in_rounds(spark):
    rng = np.random.default_rng(0)
    weights = [int(x) for x in rng.integers(1, 10**6, 400)]
    groups = spark.createDataFrame([(i.to_bytes(4, "big"), w) for i, w in enumerate(weights)], "key binary, weight long")
    rows = sharding.assign_groups(groups, 4, chunk=9, last=5).collect()
    total = Counter()
    for r in rows:
        total[r.shard] += weights[int.from_bytes(r.key, "big")]
    assert len(rows) == 400 and set(total) == {0, 1, 2, 3} and max(total.values()) - min(total.values()) < 10**5
    assert sorted(Counter(sharding.differenced_weights([8, 7, 6, 5, 4], 2)).values()) == [2, 3]
    assert sharding.differenced_weights([], 3) == [] and sharding.differenced([]) == []


# 5


def test_media(odd, none, documents):
    for df in (odd, documents):
        expected = Counter()
        for i, x in texts_of(df):
            p = flac.padded(x)
            assert len(p) % 576 == 0 and p and p.rstrip(b"\xff") == x.encode()
            expected[i, len(x.encode()), len(p), sha(p), zlib.crc32(p[-32:])] += 1
        rows = flac.read_media(flac.write_media(df)).collect()
        assert Counter((r.doc_id, r.n_bytes, r.payload_bytes, r.payload_sha256, r.tail_crc32) for r in rows) == expected
    assert flac.read_media(flac.write_media(none)).count() == 0
    media = flac.write_media(odd).where("doc_id = 90")
    blocks = flac.pcm_blocks(media).orderBy("sample_offset").collect()
    assert b"".join(bytes(b.pcm) for b in blocks) == flac.padded(next(x for i, x in texts_of(odd) if i == 90))
    assert [b.sample_offset for b in blocks] == [576 * k for k in range(len(blocks))]


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 5), st.integers(0, 2**32 - 1), st.sampled_from(["noise", "sine", "flat", "steps", "ramp", "spikes"]))
def test_flac_round_trip(blocks, seed, kind):
    rng, n = np.random.default_rng(seed), 576 * blocks
    t = np.arange(n)
    x = {"noise": rng.integers(0, 256, n), "sine": 128 + 100 * np.sin(t / rng.uniform(2, 60)), "flat": np.full(n, seed % 256), "steps": np.repeat([0, 255], n // 2), "ramp": t % 256, "spikes": np.where(rng.random(n) < 0.01, 255, 128)}[kind].astype(np.uint8).tobytes()
    stream = flac.encode_many([x, x])[1]
    head = flac.Stream(stream)
    bare = stream[:4] + bytes([0x80]) + stream[5:42] + stream[head.frames :]
    assert flac.decode_many([stream, bare]) == [x, x]
    broken = bytearray(stream)
    broken[int(rng.integers(head.frames, len(stream)))] ^= 1 << int(rng.integers(0, 8))
    with pytest.raises(flac.FlacError):
        flac.decode_many([bytes(broken)])


def test_flac_rejects_what_it_cant_write():
    for bad in (b"", b"x" * 575):
        with pytest.raises(flac.FlacError):
            flac.encode_many([bad])


# 6


def test_language(spark, odd, none, documents):
    rows = langid.identify(documents).join(documents.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in rows if zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows) and sum(r.rejected for r in rows) <= 0.05 * len(rows)
    model = langid.fit_fold(documents)
    got = {r.doc_id: r for r in langid.predict(odd, model).collect()}
    assert got[0].lang_pred == got[1].lang_pred == got[2].lang_pred == "und" and got[0].score == 0 and got[0].rejected
    assert got[5].lang_pred in model.languages
    assert langid.identify(none).count() == 0 and langid.fit_fold(none) is None
    assert {r.lang_pred for r in langid.predict(odd, None).collect()} == {"und"}
    kept = langid.keep_identified(odd, model)
    assert kept.columns == odd.columns and kept.where("text is null").count() == 0
    untaught = langid.identify(odd.withColumn("lang", F.lit(None).cast("string")))
    assert untaught.where("lang_pred <> 'und'").count() == 0


@pytest.mark.parametrize("lang", ["de", "en", "es", "fr"])
def test_language_that_is_not_taught_is_rejected(spark, lang):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = langid.fit_fold(docs.where(F.col("lang") != lang))
    other = langid.predict(docs.where(F.col("lang") == lang), model).agg(F.avg(F.col("rejected").cast("int"))).first()[0]
    rng = np.random.default_rng(5)
    letters = [(i, " ".join("".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), 6)) for _ in range(120))) for i in range(50)]
    noise = langid.predict(spark.createDataFrame(letters, "doc_id long, text string"), model).where("rejected").count()
    assert other >= 0.9 and noise == 50


def test_language_ignores_labels_of_the_predicted(documents):
    a = {tuple(r) for r in langid.identify(documents).collect()}
    fold = langid.remainder("doc_id", 3) == 1
    changed = documents.withColumn("lang", F.when(fold, "xx").otherwise(F.col("lang")))
    assert {tuple(r) for r in langid.identify(changed).collect()} == a


# 7


def test_quality(odd, none):
    rows = quality.apply_rules(odd)
    expected = Counter()
    for i, x in texts_of(odd):
        w = words(x)
        windows = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
        twice, covered = Counter(windows), set()
        for k, v in enumerate(windows):
            if twice[v] > 1:
                covered |= {k, k + 1, k + 2}
        lines = [v for v in x.split("\n") if words(v)]
        expected[i, len(w), sum(map(len, w)), sum(c in "#*$%&|<>" for c in x), len(lines) - len(set(lines)), len(covered), len(w) < 50 or 100 * len(covered) > 50 * len(w)] += 1
    assert Counter(tuple(r)[:7] for r in rows.collect()) == expected
    assert rows.where("base_failed and kept").count() == 0
    assert quality.apply_rules(none).count() == 0
    assert quality.keep_good(odd).columns == odd.columns


def test_fences_follow_their_group(spark):
    """What is usual in one source is not in another."""
    fine = lambda i: " ".join(f"w{i}x{k}" for k in range(80))
    marked = lambda i: " ".join(f"w{i}x{k}#" for k in range(80))
    rows = [(i, fine(i), "en", "plain") for i in range(40)] + [(100, marked(100), "en", "plain")] + [(200 + i, marked(200 + i), "en", "code") for i in range(40)]
    kept = {r.doc_id: r.kept for r in quality.apply_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")).collect()}
    assert not kept[100] and all(v for k, v in kept.items() if k != 100)


def test_each_measure_rejects_an_outlier(spark):
    """Texts that pass the base rules and are far from their group by one measure."""
    lines = lambda i, n=10: [" ".join(f"w{i}x{10 * k + j}" for j in range(8)) for k in range(n)]
    passage = "once more these twelve words are found here as they were before"
    planted = {
        "symbol_rate": [x + "##" for x in lines(100)],
        "dup_line_rate": [y for x in lines(101, 8) for y in (x, "aa bb")][:12],
        "repeat_rate": [passage, *lines(102), passage],
        "mean_word": [x.replace("w", "longerw") for x in lines(103)],
        "capital_rate": [x.replace("w104x", "Wx") for x in lines(104)],
    }
    rows = [(i, "\n".join(lines(i)), "en", "s") for i in range(40)] + [(100 + k, "\n".join(x), "en", "s") for k, x in enumerate(planted.values())]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    limits = quality.fences(quality.rates(quality.measured(df))).first()
    judged = {r.row.doc_id: r for r in quality.judged(df).collect()}
    for k, m in enumerate(planted):
        assert not judged[100 + k].base_failed and not judged[100 + k].kept and judged[100 + k][m] > limits[f"max_{m}"], m
    assert all(judged[i].kept for i in range(40))


def test_quality_runs_no_python(documents):
    plan = quality.apply_rules(documents)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


# 8


def test_warc(spark, none):
    big, small = "<p>" + "x" * 1200 + "</p>", "<p>small</p>"
    rows = [(1, "http://a/", big), (2, "http://b/ c\r\nX: y", big), (3, None, small), (4, "u", small), (None, "n", big), (5, "e", None), (6, "f", ""), (7, "http://g/", "é" * 600), (8, "h", "é" * 600), (8, "h", "é" * 600)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumns({"digest": F.lit("x"), "offset": F.lit(1)})
    got = warc.archive_round_trip(df).collect()
    digest = lambda x: hashlib.sha1((x or "").encode()).hexdigest()
    target = {1: 2, 7: 8}
    assert Counter(map(tuple, got)) == Counter((i, len((x or "").encode()), digest(x), "revisit" if i in target else "response", target.get(i)) for i, _, x in rows)
    assert warc.archive_round_trip(df.limit(0)).count() == 0


def test_warc_reads_what_is_selected(spark, tmp_path):
    pages = spark.read.parquet(f"{SF}/pages.parquet")
    index = warc.write_archives(pages, str(tmp_path / "w"))
    some = warc.read_records(index.where("page_id % 7 = 0"), str(tmp_path / "w"), with_payload=True).collect()
    html = {r.page_id: r.html for r in pages.collect()}
    assert some and all(r.page_id % 7 == 0 and bytes(r.payload).decode() == html[r.page_id] for r in some if r.record_type == "response")
    archive = next((tmp_path / "w").glob("part-*.warc.gz"))
    import gzip

    assert gzip.open(archive).read(9) == b"WARC/1.1\r"
    with pytest.raises(ValueError):
        warc.parsed(gzip.compress(gzip.decompress(warc.record(1, "u", b"abc", None)).replace(b"abc", b"abd")))


# 9


def brute_segments(scores):
    """Maximal segments by their definition: all positive-scoring ones that no proper part, and no longer proper one, beats, found by recursion on the best."""
    if not scores or max(scores) <= 0:
        return []
    best, lo, hi = 0, 0, 0
    for i in range(len(scores)):
        total = 0
        for j in range(i, len(scores)):
            total += scores[j]
            if total > best or (total == best and j + 1 - i < hi - lo):
                best, lo, hi = total, i, j + 1
    left, right = brute_segments(scores[:lo]), brute_segments(scores[hi:])
    return left + [(lo, hi, best)] + [(a + hi, b + hi, s) for a, b, s in right]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from([None, None, None, 5, 3, 2, -1, 8]), max_size=25))
def test_segments(values):
    steps = [(i, float(v)) for i, v in enumerate(values) if v is not None]
    got = toxicity.maximal_segments(steps, len(values), 1.0)
    assert sum(s for _, _, s in got) == sum(s for _, _, s in brute_segments([-1 if v is None else v for v in values]))


def test_toxicity(spark, odd, none):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.fit(docs, labels)
    rows = {r.doc_id: r for r in toxicity.score_texts(docs, model).collect()}
    bad = {i for i, x in texts_of(docs) if len(re.findall(r"\b(idiot|moron|scum|worthless|pathetic)\b", x.lower())) >= 2}
    assert bad and sum(rows[i].predicted for i in bad) >= 0.95 * len(bad)
    assert sum(r.predicted for i, r in rows.items() if i not in bad) <= 0.06 * len(rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows.values())
    found = toxicity.passages(docs, model).collect()
    assert {r.doc_id for r in found} >= {i for i in bad if rows[i].predicted} and all(r.expected <= toxicity.SIGNIFICANT for r in found)
    assert toxicity.score_texts(odd, model).where("predicted = 1").count() == 0
    assert toxicity.toxicity(none, labels).count() == 0
    assert {r.score for r in toxicity.toxicity(odd, labels.limit(0)).collect()} == {0.0}
    assert toxicity.toxicity(odd, labels.limit(0)).where("held_out is null").count() == 0


# 10


def fingerprint(text):
    w = text.encode().lower().split()
    h = [xxhash.xxh64_intdigest(b" ".join(w[k : k + 3]), 42) for k in range(max(1, len(w) - 2))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)) if h else 0


def linked(prints):
    """The least id that links of two or fewer bits reach, by comparing all."""
    ids = [i for i, _ in prints]
    root = list(range(len(ids)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(ids)):
        for b in range(a):
            if (prints[a][1] ^ prints[b][1]).bit_count() <= 2:
                root[find(a)] = find(b)
    least = {}
    for k, i in enumerate(ids):
        r = find(k)
        least[r] = min(x for x in (least.get(r), i) if x is not None) if (i is not None or least.get(r) is not None) else None
    return [least[find(k)] for k in range(len(ids))]


def test_simhash(spark, odd, none, documents):
    for df in (odd, documents):
        prints = [(i, fingerprint(x)) for i, x in texts_of(df)]
        expected = Counter((i, f"{p:016x}", c) for (i, p), c in zip(prints, linked(prints), strict=True))
        rows = simhash.near_duplicates(df).select("doc_id", simhash.as_hex().alias("h"), "component_id").collect()
        assert Counter(map(tuple, rows)) == expected
    assert simhash.near_duplicates(none).count() == 0


def test_anchors_meet_all_that_is_near(spark):
    rng = np.random.default_rng(1)
    base = [int(x) for x in rng.integers(0, 2**63, 300)]
    prints = []
    for k, x in enumerate(base):
        prints.append(x)
        for _ in range(k % 4):
            for b in rng.integers(0, 64, int(rng.integers(1, 4))):
                x ^= 1 << int(b)
            prints.append(x)
    prints = sorted(set(prints))
    df = spark.createDataFrame([(int(np.array(p, np.uint64).view(np.int64)),) for p in prints], "fp long")
    roots = {r.node: r.root for r in simhash.components(simhash.anchor_links(df)).collect()}
    signed = [int(np.array(p, np.uint64).view(np.int64)) for p in prints]
    expected = linked(list(zip(signed, prints, strict=True)))
    assert [roots.get(p, p) for p in signed] == expected


def test_components(spark):
    rng = np.random.default_rng(2)
    edges = [(i, i + 1) for i in range(60)] + [(int(a), int(b)) for a, b in rng.integers(100, 260, (120, 2))] + [(500, k) for k in range(501, 560)]
    got = {r.node: r.root for r in simhash.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    root = {x: x for e in edges for x in e}
    for _ in root:
        for a, b in edges:
            root[a] = root[b] = min(root[a], root[b])
    assert all(got.get(x, x) == r for x, r in root.items())


def test_keep_one(spark, odd, none):
    rng = np.random.default_rng(4)
    rows = []
    for g in range(40):
        base = [f"w{x}" for x in rng.integers(0, 5000, 300)]
        for c in range(g % 4 + 1):
            x = list(base)
            for at in rng.integers(0, 300, 3 * (c > 0)):
                x[at] = "changed"
            rows.append((100 * g + c, " ".join(x)))
    kept = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert kept == {100 * g for g in range(40)}
    left = simhash.keep_one(odd)
    assert left.columns == odd.columns and left.where("doc_id is null").count() == 1 and left.where("doc_id = 6").count() == 0
    assert simhash.keep_one(none).count() == 0


def kept_by_brute_force(rows):
    sets = {i: set(zip(*[words(x.lower())[k:] for k in range(5)], strict=False)) for i, x in rows}
    found = linked([(i, fingerprint(x)) for i, x in rows])
    near = [(i, c) for (i, _), c in zip(rows, found, strict=True)]
    near += [(a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])]
    root = {i: i for i in sets}
    while True:
        before = dict(root)
        for a, b in near:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            return {i for i, r in root.items() if i == r}


def test_keep_one_finds_added_and_cut_passages(spark):
    """A block appended, an end cut off: the words' set changes much, the shingles agree by 0.8 and more."""
    rng, rows = np.random.default_rng(8), []
    for g in range(60):
        base = [f"w{x}" for x in rng.integers(0, 5000, 200 + 10 * g)]
        more, less = (1 + 0.23 * rng.random(2)) * len(base)
        rows += [(10 * g + 1, base), (10 * g + 2, [*base, *(f"z{x}" for x in rng.integers(0, 5000, int(more) - len(base)))]), (10 * g, base[: int(len(base) ** 2 / less)])]
    rows = [(i, " ".join(x)) for i, x in rows]
    kept = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert kept == kept_by_brute_force(rows) and len(kept) < 90


def test_keep_one_compares_those_that_differ_from_the_lead(spark, monkeypatch):
    """Lines of one pool in several orders: equal sets of words, near copies only within an order."""
    monkeypatch.setattr(simhash, "BLOCK", 7, raising=False)
    rng, rows = np.random.default_rng(9), []
    pool = [[f"p{k}x{j}" for j in range(8)] for k in range(40)]
    for g in range(20):
        order = rng.permutation(40)
        for c in range(3):
            lines = [pool[k] for k in order]
            lines[c], lines[c + 1] = lines[c + 1], lines[c]
            rows.append((10 * g + c, " ".join(w for x in lines for w in x)))
    kept = {r.doc_id for r in simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(5)).collect()}
    assert kept == kept_by_brute_force(rows) == {10 * g for g in range(20)}
