"""Prefix groups of any size, equal words only, bins that close, linear segments, and the parity maps of near-duplicates."""

from __future__ import annotations

import random
import time

import numpy as np
import pytest

from quillgraph.llm import packing, simhash, substrings, toxicity

from .test_ops import removed


def thue_morse(n: int) -> str:
    x = "a"
    for _ in range(n):
        x += x.translate(str.maketrans("ab", "ba"))
    return x


def corpus() -> list[tuple[int, str]]:
    rng = random.Random(1)
    passage = [f"q{i}" for i in range(60)]
    rows = []
    for i in range(300):
        x = [f"r{rng.randrange(300)}" for _ in range(rng.randrange(10, 60))]
        p = rng.randrange(len(x))
        rows.append((i, " ".join(x[:p] + passage[5 : 5 + rng.choice([12, 19, 20, 25])] + x[p:])))
    rows += [(300 + i, " ".join(rng.choice("ab") for _ in range(rng.randrange(15, 120)))) for i in range(40)]
    rows += [(400 + i, rows[rng.randrange(300)][1]) for i in range(30)]
    rows += [(500, "z " * 500), (501, "y " * 60 + "z " * 30)]
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("group", [1, 8, 1024])
def test_repeats_at_any_group_size(spark, group):
    rows = corpus()
    got = {(r.doc_id, r.n_words, r.n_removed) for r in substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string").repartition(5), group=group).collect()}
    assert got == {(i, n, m) for (i, _), (n, m, *_) in removed(rows).items()}


def test_only_equal_words_repeat(spark):
    """Words that collide under every polynomial hash modulo a power of two."""
    a = thue_morse(10)
    b = a.translate(str.maketrans("ab", "ba"))
    w = [f"w{i}" for i in range(30)]
    rows = [(1, " ".join([*w[:10], a, *w[10:]])), (2, " ".join([*w[:10], b, *w[10:]]))]
    got = {r.doc_id: r.n_removed for r in substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: 0, 2: 20}


def test_ids_of_several_texts(spark):
    w = [f"w{i}" for i in range(40)]
    rows = [(1, " ".join(w)), (2, " ".join(f"x{i}" for i in range(40))), (2, " ".join(w)), (2, None)]
    got = sorted((r.doc_id, r.n_words, r.n_removed) for r in substrings.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, 40, 0), (2, 0, 0), (2, 40, 0), (2, 40, 40)]


def test_subtrees():
    rng = np.random.default_rng(3)
    ids = rng.integers(0, 2, 400)
    starts = np.arange(0, 380)
    order, deep = substrings.subtrees(ids, starts)
    windows = [tuple(ids[s : s + 20].tolist()) for s in starts[order]]
    assert windows == sorted(windows) and [False, *(a == b for a, b in zip(windows, windows[1:], strict=False))] == deep.tolist()


def test_the_fullest_bin_closes():
    rng = random.Random(7)
    for most in (1, 3):
        fit, free = packing.BestFit(10, most), {}
        made = 0
        for _ in range(300):
            n = rng.randrange(1, 11)
            at, offset = fit.place(n)
            fits = [k for k, f in free.items() if f >= n]
            if fits:
                assert free[at] == min(free[k] for k in fits) and offset == 10 - free[at]
            else:
                assert (at, offset) == (made, 0)
                made += 1
            free[at] = free.get(at, 10) - n
            if not free[at]:
                del free[at]
            if len(free) > most:
                open_ = dict((b, 10 - used) for b, used in fit.still_open())
                closed = set(free) - set(open_)
                assert len(closed) == 1 and free[closed.pop()] == min(free.values())
                free = open_
            assert free == {b: 10 - used for b, used in fit.still_open()}


def maximal(values: list[float]) -> list[tuple[int, int]]:
    """By definition: the best segment (the shortest of equals), then the same on both sides of it."""
    best = max(((round(sum(values[i:j]), 9), i - j, i, j) for i in range(len(values)) for j in range(i + 1, len(values) + 1)), default=(0,))
    if best[0] <= 0:
        return []
    _, _, i, j = best
    return [*maximal(values[:i]), (i, j), *((a + j, b + j) for a, b in maximal(values[j:]))]


def test_segments():
    rng = random.Random(2)
    for _ in range(150):
        n = rng.randrange(1, 25)
        steps = [(i, rng.uniform(-1, 2)) for i in range(n) if rng.random() < 0.6]
        values = [dict(steps).get(i, -toxicity.DRIFT) for i in range(n)]
        assert [x[:2] for x in toxicity.maximal_segments(steps, n, toxicity.DRIFT)] == maximal(values)


def test_segments_take_linear_time():
    def took(n: int) -> float:
        steps = [(5 * i, 1.0) for i in range(n)]
        best = 9.0
        for _ in range(3):
            began = time.perf_counter()
            toxicity.maximal_segments(steps, 5 * n, 0.5)
            best = min(best, time.perf_counter() - began)
        return best / n

    assert took(32_000) < 4 * took(2000)


def test_texts_labelled_both_ways_are_toxic(spark):
    rows = [(i, f"plain words number {i % 7} here") for i in range(40)] + [(100 + i, f"vile{i % 3} awful text {i}") for i in range(40)] + [(200 + i, "vile0 both ways") for i in range(8)]
    labels = [(i, 0) for i in range(40)] + [(100 + i, 1) for i in range(40)] + [(200 + i, i % 2) for i in range(8)]
    docs, marks = spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")
    models = [toxicity.fit(docs.repartition(n), marks.repartition(n)) for n in (1, 3)]
    assert models[0].scores == models[1].scores and models[0].bias == models[1].bias


def test_parity_maps_bound_the_difference():
    rng = np.random.default_rng(5)
    sets = [np.unique(rng.integers(0, 2**63, n).astype(np.uint64)) for n in (0, 3, 90, 200, 260, 900)]
    sets += [np.unique(np.concatenate((s[: len(s) * 9 // 10], rng.integers(0, 2**63, 20).astype(np.uint64)))) for s in sets]
    maps = [simhash.parity_map(s) for s in sets]
    a, b = zip(*[(i, j) for i in range(len(sets)) for j in range(len(sets))], strict=True)
    odd = simhash.odd_bits([maps[i] for i in a], [maps[j] for j in b])
    for i, j, n in zip(a, b, odd.tolist(), strict=True):
        assert n <= len(np.setxor1d(sets[i], sets[j]))


def test_a_large_group_of_near_copies(spark):
    """No link of a group is lost, whoever its lead is: 400 near copies of a text in random order of ids, with exact copies and other texts."""
    rng = random.Random(5)
    base = [f"w{rng.randrange(5000)}" for _ in range(120)]
    ids = list(range(900))
    rng.shuffle(ids)
    texts = []
    for _ in range(400):
        w = list(base)
        for _ in range(3):
            w[rng.randrange(120)] = f"x{rng.randrange(100000)}"
        texts.append(w)
    texts += [base] * 200 + [[f"u{rng.randrange(50000)}" for _ in range(100)] for _ in range(300)]
    rows = list(zip(ids, texts, strict=True))
    kept = {r.doc_id for r in simhash.keep_one(spark.createDataFrame([(i, " ".join(x)) for i, x in rows], "doc_id long, text string").repartition(7)).collect()}
    sets = [frozenset(zip(*[x[k:] for k in range(5)], strict=False)) for _, x in rows]
    prints = simhash.fingerprints_of([" ".join(x) for _, x in rows])
    root = list(range(len(rows)))

    def find(k: int) -> int:
        while root[k] != k:
            root[k] = root[root[k]]
            k = root[k]
        return k

    for i in range(len(rows)):
        near = simhash.differing(prints[i : i + 1], prints[:i]) <= simhash.THRESHOLD if i else []
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both >= 0.8 * (len(sets[i]) + len(sets[j]) - both) or near[j]:
                root[find(i)] = find(j)
    groups: dict[int, int] = {}
    for k, (i, _) in enumerate(rows):
        groups[find(k)] = min(groups.get(find(k), 1 << 40), i)
    assert kept == set(groups.values())
