"""First paths from the first beginnings, without the keys of all sections."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from quillgraph.functions import text as t
from quillgraph.operators import crossdoc, paths, sections
from quillgraph.plans import queries

from .conftest import SF


def shuffled(spark, since: int) -> int:
    """Records that stages from number since on shuffled."""
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(jvm.java.util.ArrayList(), False, False, gateway.new_array(jvm.double, 0), jvm.java.util.ArrayList())
    return sum(s.shuffleWriteRecords() for s in (stages.apply(i) for i in range(stages.size())) if s.stageId() >= since)


def next_stage(spark) -> int:
    spark.range(1).count()
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(spark._jvm.java.util.ArrayList(), False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), spark._jvm.java.util.ArrayList())
    return 1 + max(stages.apply(i).stageId() for i in range(stages.size()))


@pytest.mark.parametrize("length", [2, 3])
def test_first_paths_do_not_shuffle_all_sections(spark, length):
    """Twenty paths of 20,000 sections: what is shuffled goes with the paths, not with the sections."""
    rows = [(f"{d:05}#s0", f"{d:05}", d, 0, [f"k{d // 4}", f"own{d}"]) for d in range(20_000)]
    nodes = spark.createDataFrame(rows, "section_id string, doc_id string, source_index long, section_pos int, entities array<string>").persist()
    nodes.count()
    since = next_stage(spark)
    got = [tuple(r.path) for r in paths.sampled(nodes, None, length, 20, ranked=False).orderBy("order").collect()]
    spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
    assert shuffled(spark, since) < 8_000
    few = nodes.where("source_index < 40")
    every = paths.extended(few.select("section_id", "doc_id"), sections.section_edges(few), length).orderBy("order")
    assert got == [tuple(r.path) for r in every.limit(20).collect()]
    nodes.unpersist()


@pytest.mark.parametrize("first, few", [(1, 1 << 17), (1, 8), (1, 0), (256, 1 << 17)])
def test_first_paths_of_any_number_of_beginnings(spark, monkeypatch, first, few):
    """However many beginnings are looked at first, and go everywhere; many of them lead nowhere."""
    monkeypatch.setattr(paths, "FIRST", first)
    monkeypatch.setattr(paths, "FEW", few)
    r = random.Random(7)
    rows = [(f"{d:03}#s{p}", f"{d:03}", d, p, [f"only{d}.{p}"] if d < 20 else [f"k{r.randint(0, 9)}", f"k{r.randint(0, 9)}", f"d{d}"]) for d in range(32) for p in range(r.randint(1, 3))]
    nodes = spark.createDataFrame(rows, "section_id string, doc_id string, source_index long, section_pos int, entities array<string>").persist()
    every = [tuple(r.path) for r in paths.extended(nodes.select("section_id", "doc_id"), sections.section_edges(nodes), 3).orderBy("order").collect()]
    for most in (30, 100_000):
        got = [tuple(r.path) for r in paths.sampled(nodes, None, 3, most, ranked=False).orderBy("order").collect()]
        assert got == every[:most]
    nodes.unpersist()


def test_paths_are_planned_without_the_plan_of_sections(spark):
    """What first paths do step by step isn't planned over what makes the sections."""
    got = paths._cut(spark.createDataFrame([("a", "d", ["k", "l"]), ("b", "e", [])], "id string, doc_id string, keys array<string>").where("id <> 'c'"))
    assert [tuple(r) for r in got.orderBy("id").collect()] == [("a", "d", ["k", "l"]), ("b", "e", [])]
    assert "Filter" not in got._jdf.queryExecution().optimizedPlan().toString()


def test_white_space_of_patterns_is_that_of_characters(spark):
    """Both classes take exactly the characters of SPACES, and are made of few tests a character."""
    code = spark.range(0x110000).where("id < 55296 or id >= 57344")
    rows = code.select(F.decode(F.unhex(F.lpad(F.hex("id"), 8, "0")), "UTF-32").alias("c"))
    of = lambda pattern: {r.c for r in rows.where(F.rlike("c", F.lit(pattern))).collect()}
    assert of(t.S) == set(t.SPACES) and of(t.S_BUT_SPACE) == set(t.SPACES) - {" "}


def test_pairs_of_a_common_key_are_spread(spark):
    """2000 documents of one key: no task makes more than a few of the 1,999,000 pairs' cells."""
    rows = spark.range(2000).select(F.format_string("%04d", "id").alias("id"), F.array(F.lit("k")).alias("keys"))
    made = crossdoc.met(rows, F.col("a_id") < F.col("b_id")).groupBy(F.spark_partition_id().alias("p")).count().collect()
    assert sum(r["count"] for r in made) == 1_999_000 and max(r["count"] for r in made) < 1_000_000


def test_all_modes_tasks_finds_entities_once_for_ids(spark):
    """Pairs and combinations read entities that are kept; none is found anew."""
    plan = queries.QUERIES["all_modes_tasks"](spark, SF)._jdf.queryExecution().withCachedData().toString()
    assert "regexp_extract_all" not in plan.replace("InMemoryRelation", "\0").split("\0")[0] and plan.count("InMemoryRelation") >= 3
    spark.catalog.clearCache()
