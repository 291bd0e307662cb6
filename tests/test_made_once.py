"""What is costly is made once, and only where it is read."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from quillgraph.functions import text as t
from quillgraph.operators import entities, generate, sections
from quillgraph.plans import queries

from .conftest import SF


def plan_of(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_distinct_by_makes_each_key_once(spark):
    df = spark.createDataFrame([([" Alpha ", "alpha", None, "B", "", "ss", "ß", "B."],), ([],), (None,)], "e array<string>")
    got = df.select(t.normalized_entities("e", 1))
    assert [r[0] for r in got.collect()] == [["Alpha", "B", "ss"], [], None]
    assert plan_of(df.select(t.distinct_by("e", t.norm).alias("x"))).count("regexp_extract_all") == 1


@pytest.mark.parametrize("beginning", [1, 9, 20, 1500])
def test_entities_of_a_beginning_are_those_of_the_whole(spark, monkeypatch, beginning):
    monkeypatch.setattr(entities, "BEGINNING", beginning)
    texts = ["abcd efgh ijkl mnop", "abcd'efgh ab cd'x efgh", "a b c d abcd", "abcdefghijklmnopqrstuvwxyz", "Éabcd İabc Kelvin ſabc\nabcd ab", "", None]
    df = spark.createDataFrame([(x,) for x in texts], "x string")
    for most, least in ((2, 4), (1, 2), (8, 3), (0, 1)):
        whole = F.slice(F.array_distinct(F.filter(t.tokens("x"), lambda w: F.length(w) >= least)), 1, most)
        assert df.where(~entities.token_entities("x", most, least).eqNullSafe(whole)).count() == 0


def test_titles_of_sections_are_made_where_they_are_read(spark):
    """Keys of sections need no first sentences; a heading's or a document's title, also none, stays as it is."""
    nodes = queries.nodes_of(spark, SF)
    assert "(?<=[.!?])" in plan_of(nodes) and "(?<=[.!?])" not in plan_of(sections.section_keys(nodes))
    docs = spark.createDataFrame([("1", 1, "h", None, "Alpha. First\n\n# Head\nalpha", ["Alpha"]), ("2", 2, "h", "T", "Alpha is. More\n\nnone\n\nno # alpha", ["Alpha"])], "doc_id string, source_index long, source_sha256 string, title string, text string, entities array<string>")
    got = [(r.section_id, r.section_title) for r in sections.section_nodes(docs).orderBy("section_id").collect()]
    assert got == [("1#s0", None), ("1#s1", "Head"), ("2#s0", "Alpha is"), ("2#s2", "no # alpha")]


def test_run_stats_makes_the_rows_twice(spark):
    """Once as rows considered, once as rows done; no third time for the rows to do."""
    assert plan_of(queries.QUERIES["run_stats"](spark, SF)).count("Relation [") == 2
    tasks = spark.createDataFrame([("a",), ("b",), ("c",)], "id string")
    done = spark.createDataFrame([("b",), ("x",)], "key string")
    assert sorted(map(tuple, generate.marked_done(tasks, done, "id").collect())) == [("a", True), ("b", False), ("c", True)]
