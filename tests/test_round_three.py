"""Paths and pairs without all edges, against brute force."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quillgraph.operators import compare, crossdoc, paths, sections
from quillgraph.plans import queries

from .conftest import SF


def nodes_of(spark, seed: int, docs: int, parts: int, keys: int):
    r = random.Random(seed)
    rows = [(f"{d}#s{p}", str(d), d, p, r.sample([f"k{k}" for k in range(keys)], r.randint(1, 2))) for d in range(docs) for p in range(r.randint(1, parts))]
    return spark.createDataFrame(rows, "section_id string, doc_id string, source_index long, section_pos int, entities array<string>").persist()


@pytest.mark.parametrize("shape", [(8, 3, 6), (2, 6, 3), (12, 1, 30), (1, 6, 2)])
def test_first_paths_are_those_of_all_edges(spark, shape):
    nodes = nodes_of(spark, sum(shape), *shape)
    edges = sections.section_edges(nodes).persist()
    for length in (2, 3):
        every = [tuple(r.path) for r in paths.extended(nodes.select("section_id", "doc_id"), edges, length).orderBy("order").collect()]
        for most in (1, 50):
            got = [tuple(r.path) for r in paths.sampled(nodes, None, length, most, ranked=False).orderBy("order").collect()]
            assert got == every[:most]


@pytest.mark.parametrize("block", [1, 2, 4096])
def test_pairs_meet_once_in_any_blocks(spark, monkeypatch, block):
    monkeypatch.setattr(crossdoc, "BLOCK", block)
    r = random.Random(block)
    sets = {f"d{i}": r.sample(["Alpha", "alpha ", "Beta", "BETA", "Gamma", "d", "e", "f"], r.randint(1, 5)) for i in range(25)}
    rows = spark.createDataFrame(list(sets.items()), "doc_id string, entities array<string>")
    first = {d: {} for d in sets}
    for d, entities in sets.items():
        for e in entities:
            first[d].setdefault(e.strip().lower(), e)
    want = set()
    for a in sets:
        for b in sets:
            if a < b and (common := first[a].keys() & first[b].keys()):
                best = {k: first[b][k] if len(first[b][k]) > len(first[a][k]) else first[a][k] for k in common}
                want.add((a, b, len(common), tuple(best[k] for k in sorted(common, key=lambda k: (best[k].lower(), best[k], k)))))
    got = [(p.doc_a, p.doc_b, p.n_shared, tuple(p.shared)) for p in crossdoc.cross_doc_pairs(rows).collect()]
    assert len(got) == len(set(got)) and set(got) == want
    for min_shared in (1, 3):
        fine = sorted(p for p in want if p[2] >= min_shared)
        for most in (10, 1000):
            some = crossdoc.first_pairs(rows, most, min_shared).collect()
            assert [(p.doc_a, p.doc_b, p.n_shared, tuple(p.shared)) for p in some] == fine[:most]


@pytest.mark.parametrize("name", ["cross_doc_pairs", "cross_doc_tasks", "section_edges", "entity_overlap_pairs"])
def test_pairs_are_not_grouped_after_they_meet(spark, name):
    """Nothing above the join but projections and filters: pairs aren't shuffled."""
    lines = queries.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString().splitlines()
    above = lines[: next(i for i, line in enumerate(lines) if "Join" in line)]
    assert all("Project" in line or "Filter" in line for line in above)


def test_entities_are_found_once(spark):
    """The filter on their number doesn't find them a second time."""
    plan = queries.with_ents(spark, SF).select("doc_id", F.size("entities"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1


def test_mentions_are_counted_in_the_row_of_the_text(spark):
    """No text is joined to entities, and each is searched once."""
    plan = queries.QUERIES["entity_importance"](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("(?iu)") == 1


def test_compare_generation_reads_the_evaluation_once(spark):
    """Errors, warnings, means and duplicates of each label from one pass."""
    rows = spark.createDataFrame(
        [("a", "One two", None, ["w"], 0.5), ("a", "one  TWO", "e", [], 1.0), ("a", "", None, [], 0.0), ("a", "", None, [], 0.5), ("b", None, "", ["x", "y"], 1.0)],
        "label string, text string, error string, warnings array<string>, v double",
    )
    signals = ["selected_entity_support", "selected_entity_mention", "source_5gram_overlap", "relation_signal", "specificity", "unsupported_proper_noun_score"]
    got = compare.compare_generation(rows.select("*", *[F.col("v").alias(c) for c in signals]))
    assert "Join" not in got._jdf.queryExecution().optimizedPlan().toString()
    found = {r.label: (r.n_rows, r.n_errors, r.n_warnings, r.mean_specificity, r.n_duplicates) for r in got.collect()}
    assert found == {"a": (4, 1, 1, 0.5, 1), "b": (1, 0, 2, 1.0, 0)}
