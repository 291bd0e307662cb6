"""The pipeline's stages, each on what the one before it kept, against plain versions."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import functions as F

import corpus_pipeline
from quillgraph.llm.common import durable

from ..conftest import SF
from .test_ops import fingerprint, linked, none, odd, removed, texts_of, words  # noqa: F401

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    assert list(steps) == ["quality_rules", "language_id", "near_dedup", "substring_dedup", "best_fit_packing"]

    def run(name, rows):
        out = durable(steps[name](spark, rows, SF), name)
        if name != "best_fit_packing":
            assert sorted(out.columns) == sorted(COLUMNS)
        return out

    good = run("quality_rules", docs)
    kept = dict(texts_of(good))
    assert all(len(words(x)) >= 50 for x in kept.values()) and len(kept) >= 0.7 * docs.count()
    known = run("language_id", good)
    assert known.count() >= 0.97 * good.count() and all(re.search(r"[^\W\d_]", x) for _, x in texts_of(known))
    first = run("near_dedup", known)
    rows = texts_of(known)
    near = {frozenset((i, c)) for (i, _), c in zip(rows, linked([(i, fingerprint(x)) for i, x in rows]), strict=True)}
    sets = {i: set(zip(*[words(x.lower())[k:] for k in range(5)], strict=False)) for i, x in rows}
    near |= {frozenset((a, b)) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    root = {i: i for i in sets}
    for _ in range(5):
        for pair in near:
            root |= dict.fromkeys(pair, min(root[i] for i in pair))
    stayed, expected = {i for i, _ in texts_of(first)}, {i for i, r in root.items() if i == r}
    assert len(stayed ^ expected) <= 1 and stayed <= set(sets)
    bare = run("substring_dedup", first)
    expected = removed(texts_of(first))
    for i, x in texts_of(bare):
        before = next(k for k in expected if k[0] == i)
        assert len(words(x)) == expected[before][0] - expected[before][1]
        if not expected[before][1]:
            assert x == before[1]
    assert all(r.n_chars == len(r.text) for r in bare.collect())
    packed = run("best_fit_packing", bare)
    assert packed.select("doc_id").distinct().count() == bare.count()


def test_run(spark):
    rows = corpus_pipeline.run(spark, SF)
    assert rows.count() > 0 and "sequence_id" in rows.columns


def test_each_stage_on_odd_rows_and_none(spark, odd, none):
    """Nulls, empty and very long texts, repeated rows, clashing names and empty tables: no stage fails, and all but the last keep the columns and add no row."""
    for name, stage in corpus_pipeline.STAGES:
        for rows in (odd, none):
            docs = rows.withColumn("n_chars", F.length("text").cast("long"))
            out = stage(spark, docs, SF)
            if name == "best_fit_packing":
                assert {r.doc_id for r in out.select("doc_id").collect()} == {r.doc_id for r in docs.select("doc_id").collect()}
                continue
            assert sorted(out.columns) == sorted(docs.columns)
            ids = Counter(r.doc_id for r in out.select("doc_id").collect())
            assert ids <= Counter(r.doc_id for r in docs.select("doc_id").collect())
            if name == "substring_dedup":
                assert ids.total() == docs.count()
