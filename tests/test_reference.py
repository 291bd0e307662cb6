"""Golden values and small cases of the reference's operators."""

from __future__ import annotations

import json
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quillgraph import cli
from quillgraph.config import EvaluateConfig, GenerateConfig
from quillgraph.functions import text as t
from quillgraph.operators import combos, crossdoc, entities, evaluate, generate, paths, prompts, sections
from quillgraph.plans import pipeline
from quillgraph.sources import chat, jsonl, offline
from quillgraph.sources.offline import OfflineClient


def one(spark, expression, **columns):
    row = spark.createDataFrame([tuple(columns.values())], list(columns)) if columns else spark.range(1)
    return row.select(expression.alias("x")).first()["x"]


def docs(spark, rows):
    """rows: (doc_id, text, entities)."""
    schema = "doc_id string, source_index long, title string, text string, source_sha256 string, entities array<string>"
    return spark.createDataFrame([(d, i, f"Title {d}", x, f"sha-{d}", e) for i, (d, x, e) in enumerate(rows)], schema)


def test_stable_id(spark):
    assert one(spark, t.stable_id(F.lit("a"), F.lit("b"))) == "687d61996b1c1278c973743efe7ee8e2fc8fb1d0"


def test_normalized_entities(spark):
    assert one(spark, t.normalized_entities("e", 2), e=[" Alpha ", "alpha", "B", "Gamma", None]) == ["Alpha", "Gamma"]


@pytest.mark.parametrize(("text", "title"), [("## A Heading. With Two\nmore", "A Heading. With Two"), ("First one. Second", "First one"), ("- item\nx", "item"), ("...", "Untitled source 7"), ("", "Untitled source 7"), ("word " * 40, "word " * 14 + "word word...")])
def test_titles(spark, text, title):
    assert one(spark, t.infer_title("x", F.lit(7)), x=text) == title.replace("word " * 14 + "word word...", ("word " * 15).strip() + "...")


def test_mentions_quote_and_bound(spark):
    assert one(spark, t.mentions("e", "x"), e="c++ (x)", x="C++ (x), c++ (x)y and c++ (x)") == 2
    assert one(spark, t.mentions("e", "x"), e="über", x="Über überall über") == 2
    assert one(spark, t.mentions("e", "x"), e="", x="abc") == 0


def test_fold(spark):
    assert one(spark, t.fold("x"), x="Straße ΣΑΣ") == "straße ΣΑΣ".casefold()
    known = [chr(i) for i in range(1, 0x110000) if unicodedata.category(chr(i)) not in ("Cs", "Cn")]
    rows = spark.createDataFrame([(c,) for c in known], "c string").select("c", t.fold("c").alias("f"))
    assert [r.c for r in rows.collect() if r.f != r.c.casefold()] == []


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(0, 1), min_size=1, max_size=200))
def test_round4_is_pythons(spark, values):
    rows = spark.createDataFrame([(v,) for v in values], "x double").select("x", t.round4(F.col("x")).alias("y")).collect()
    assert all(r.y == round(r.x, 4) for r in rows)


def test_selection(spark):
    d = docs(spark, [("a", "Beta here. Beta there. Alpha once.", ["Alpha", "Beta", "Gamma"])])
    pick = lambda n, how: entities.select_entities(d, d, n, how).first()["entities"]
    assert pick(1, "importance") == ["Beta"] and pick(1, "llm-order") == ["Alpha"] and pick(0, "hybrid") == [] and pick(3, "rarity") == ["Alpha", "Beta", "Gamma"]
    many = docs(spark, [(str(i), "x", ["Common"] + (["Rare"] if i == 0 else [])) for i in range(10)])
    assert entities.select_entities(many, many, 1, "rarity").where("doc_id = '0'").first()["entities"] == ["Rare"]


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(0, 6), min_size=1, max_size=5))
def test_combos_are_counted_as_made(spark, sizes):
    d = docs(spark, [(str(i), "x", [f"e{k}" for k in range(n)]) for i, n in enumerate(sizes)])
    made = combos.relation_tasks(d, (2, 3), 4)
    assert combos.count_relation_tasks(d, (2, 3), 4).first()["total"] == made.count()
    assert made.select("relation_id").distinct().count() == made.count()


def test_sampled_combos_are_stable(spark):
    d = docs(spark, [("a", "x", list("pqrstu"))])
    pick = lambda seed: [tuple(r.entities) for r in combos.entity_combos(d, (2,), 4, True, seed).orderBy("combo_ord").collect()]
    assert pick(1) == pick(1) and pick(1) != pick(2) and len(pick(1)) == 4


def test_cross_doc(spark):
    d = docs(spark, [("a", "x", ["Analytical Engine", "X"]), ("b", "y", ["(analytical engine)", "Y"]), ("c", "z", ["Z", "..."])])
    rows = crossdoc.cross_doc_tasks(d, d).collect()
    assert [(r.doc_a, r.doc_b, r.shared, r.shared_keys) for r in rows] == [("a", "b", ["(analytical engine)"], ["analytical engine"])]
    assert crossdoc.cross_doc_pairs(d, max_df=1).count() == 0


def test_sections(spark):
    text = "intro Alpha\n\n# Empty\n\n## First: \nAlpha body\n\n### Second\nno entity\n## Third\nBeta"
    found = sections.section_nodes(docs(spark, [("a", text, ["Alpha", "Beta"]), ("b", "Alpha one. Two.\n\nnothing\n\nBeta", ["beta"]), ("c", "nothing", ["Delta"])])).orderBy("section_id").collect()
    assert [(r.section_id, r.section_title, r.entities) for r in found] == [("a#s0", "Title a", ["Alpha"]), ("a#s1", "First", ["Alpha"]), ("a#s3", "Third", ["Beta"]), ("b#s2", "Beta", ["beta"])]
    assert found[1].text == "First\nAlpha body"


def test_paths_and_groups(spark):
    d = docs(spark, [(k, f"Hub and {k.upper()}", ["Hub", k.upper()]) for k in "abcd"])
    nodes = sections.section_nodes(d)
    edges = sections.section_edges(nodes)
    every = paths.sampled(nodes, edges, 3, None)
    assert every.count() == 24 and all(len(set(r.path)) == 3 for r in every.collect())
    first = paths.sampled(nodes, edges, 3, 5, ranked=False).orderBy("order").collect()
    assert [r.path for r in first] == sorted(r.path for r in every.collect())[:5]
    best = paths.ranked(paths.described(paths.sampled(nodes, edges, 3, 5), nodes), "bridge", 5)
    assert best.first()["bridge"] == 3 + 4.5 + 1 + 1.5
    assert paths.path_tasks(best, 1, ("default", "contrastive")).select("path_id").distinct().count() == 10
    groups = paths.long_context_tasks(best, 2, 6000, ("default", "causal"), 0).collect()
    assert len(groups) == 1 and len(groups[0].paths) == 2 and groups[0].shared == ["Hub"]
    assert paths.long_context_tasks(best, 2, 1).select(F.size("paths").alias("n")).distinct().collect()[0].n == 1
    assert paths.sampled(nodes, edges, 1, 2).count() == 2


def test_parsing():
    assert generate.parsed_object('x ```JSON\n{"entities": ["A"]}\n```') == {"entities": ["A"]}
    assert generate.parsed_object('so: {"a": 1} ok') == {"a": 1}
    with pytest.raises(ValueError):
        generate.parsed_object("[1]")


def test_parsed_qa(spark):
    rows = [("a", '{"question": "q", "answer": null, "reasoning": "r"}', None), ("b", '{"question": "q"}', None), ("c", "no", None), ("d", None, "boom")]
    got = {r.key: (r.answer_text, r.failure is None) for r in generate.parsed_qa(spark.createDataFrame(rows, "key string, answer string, failure string")).collect()}
    assert got["a"] == ("None", True) and not any(got[k][1] for k in "bcd")


def test_jsonl(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_text('{"id": 5, "text": " Alpha beta. More. "}\n\n{"text": 5}\n{"text": "  "}\n{"title": " T ", "text": "y"}\n')
    found = jsonl.documents(jsonl.scan(spark, str(path))).orderBy("source_index").collect()
    assert [(r.source_index, r.title, r.text) for r in found] == [(0, "Alpha beta", "Alpha beta. More."), (3, "T", "y")]
    assert found[0].doc_id == "5" and len(found[1].doc_id) == 40
    path.write_text('{"text": "a"}\nbroken\n[1]\n')
    assert jsonl.scan(spark, str(path), strict=False).count() == 1
    for bad, line in (('{"text": "a"}\n\nbroken\n[1]\n', 3), ("\n[1]\n", 2)):
        path.write_text(bad)
        with pytest.raises(Exception, match=f"x.jsonl:{line} is not a JSON object"):
            jsonl.scan(spark, str(path)).collect()


def test_lines_are_numbered_in_each_file(spark, tmp_path):
    for name in "ab":
        (tmp_path / name).write_text('\n{"text": "x"}\n\n{"text": "y"}\n')
    assert sorted(r.line_number for r in jsonl.numbered(spark, str(tmp_path)).collect()) == [2, 2, 4, 4]
    assert sorted(r.row_index for r in jsonl.scan(spark, str(tmp_path)).collect()) == [0, 1, 2, 3]
    found = jsonl.fixture(spark, str(tmp_path / "a")).orderBy("doc_id").collect()
    assert [(r.doc_id, r.title, r.text, r.entities) for r in found] == [("row-1", "Document 1", "x", []), ("row-3", "Document 3", "y", [])]
    (tmp_path / "a").write_text('{"text": " "}\n')
    with pytest.raises(Exception, match="a:1 has no text"):
        jsonl.fixture(spark, str(tmp_path / "a")).collect()


def test_model_calls(spark):
    class Twice(OfflineClient):
        """Answers the first question wrongly, and tells how it was asked."""

        def chat(self, messages, **options):
            return "no" if len(messages) == 2 else json.dumps({"entities": [json.dumps(options, sort_keys=True), str(len(messages))]})

    row = {"key": "k", "system": "s", "prompt": "p"}
    got = json.loads(generate.asked_entities(Twice(), row, temperature=0.5, max_tokens=7, json_object=True))["entities"]
    assert json.loads(got[0]) == {"json_object": True, "max_tokens": 7, "temperature": 0.0} and got[1] == "4"
    tasks = spark.range(300).selectExpr("cast(id as string) AS key", "'s' AS system", "concat('p', id) AS prompt")
    answers = {r.key: r.answer for r in generate.with_answers(tasks, OfflineClient, 4, 5).collect()}
    assert answers == {str(i): f"Echo: p{i}" for i in range(300)}

    begun = []
    made = generate.pooled(lambda r: r, (begun.append(i) or i for i in range(100)), 2, 3)
    assert next(made) == 0 and len(begun) == 3 and [0, *made] == list(range(100))


def test_prompts_are_read_back():
    prompt = "Article A Title: X\n\nArticle A:\nt\n\nArticle B Title: Y\n\nShared entities:\n- p\n- q\n\n" + prompts.STYLES["causal"]
    assert offline.values(prompt, "Article B Title: ") == ["Y"] and offline.bullets(prompt, "Shared entities:") == ["p", "q"] and offline.bullets(prompt, "none") == []
    assert offline.style(prompt) == "causal" and offline.style("x") == "default"
    answer = offline.OfflineWriter().chat([{"role": "system", "content": "s"}, {"role": "user", "content": prompt}])
    assert "p and q: described in X, Y." in answer and "causal" in answer


class Failing(OfflineClient):
    def chat(self, messages, **options):
        if "Entities:" in messages[-1]["content"]:
            raise RuntimeError("down")
        return super().chat(messages, **options)


@pytest.fixture
def corpus(tmp_path):
    path = tmp_path / "docs.jsonl"
    words = ["analytical", "mechanical", "calculation", "programming", "mathematics"]
    path.write_text("".join(json.dumps({"id": f"d{i}", "title": f"Doc {i}", "text": f"The {words[i]} story of {words[i + 1]} and {words[i + 2]}."}) + "\n" for i in range(3)))
    return path


def test_run_resumes_and_retries(spark, tmp_path, corpus):
    config = GenerateConfig(mode="single-doc", combo_sizes=(2,), metadata=(("generator", "test"),))
    args = (str(corpus), str(tmp_path / "cache"), str(tmp_path / "out"))
    stats = pipeline.run(spark, config, *args, Failing)
    assert (stats["documents"], stats["entities_extracted"], stats["single_doc_failed"]) == (3, 9, 9)
    stats = pipeline.run(spark, config, *args, OfflineClient)
    assert (stats["single_doc_generated"], stats["single_doc_failed"]) == (9, 0)
    assert pipeline.run(spark, config, *args, OfflineClient)["single_doc_skipped"] == 9


def test_run_all_and_evaluate(spark, tmp_path, corpus):
    config = GenerateConfig(mode="all", combo_sizes=(2,), path_length=3, path_strategy="bridge", max_paths=4, group_size=2, styles=("default", "contrastive"))
    stats = pipeline.run(spark, config, str(corpus), str(tmp_path / "cache"), str(tmp_path / "out"), OfflineClient)
    assert stats["cross_doc_generated"] == 3 and stats["sog_lite_generated"] == 8 and stats["long_context_generated"] == 4 and stats["longfaith_qa_generated"] == 8
    summary = pipeline.evaluate_files(spark, str(corpus), str(tmp_path / "out"), str(tmp_path / "eval"), str(tmp_path / "cache"))
    assert summary["rows"] == 9 + 3 + 8 + 4 + 8 and summary["rows_by_mode"]["longfaith_qa"] == 8
    assert (tmp_path / "eval" / "report.md").read_text().startswith("# Evaluation")


def test_reports(spark, tmp_path, corpus):
    config = GenerateConfig(mode="both", combo_sizes=(2,))
    pipeline.run(spark, config, str(corpus), str(tmp_path / "cache"), str(tmp_path / "out"), offline.OfflineWriter)
    text = pipeline.fixture_report(spark, str(corpus), str(tmp_path / "cache"), (2,), (str(tmp_path / "out"),))
    assert "documents: 3" in text and "total: 2-way=9" in text and "- d0 <-> d1: 2" in text and "- rows:cross: 3" in text
    table = pipeline.comparison_report(spark, str(corpus), {"a": str(tmp_path / "out"), "b": str(tmp_path / "out")}, str(tmp_path / "cache"))
    a, b = table.splitlines()[2:]
    assert a.startswith("| a | 12 | 0") and a.replace("| a |", "| b |") == b


def test_evaluation_scores(spark):
    found = evaluate.sources(docs(spark, [("d", "Ada Lovelace wrote notes on the Analytical Engine of Charles Babbage.", ["Ada Lovelace", "Analytical Engine"])]))
    text = "### Discussion\nAda Lovelace described the Analytical Engine together with its inventor.\n### Interaction\nThey are connected because of her notes on it and the shared context of the time."
    rows = spark.createDataFrame([(0, "r", "d", ["Ada Lovelace", "Analytical Engine"], text, None), (1, "s", "x", ["Nothing"], "New York Times and Los Angeles", "bad")], "row_index long, relation_id string, doc_id string, entities array<string>, text string, error string")
    a, b = evaluate.evaluated(rows, found).orderBy("row_index").collect()
    assert a.pass_gate and a.warnings == [] and a.selected_entity_support == 1 and a.relation_signal == 1
    assert not b.pass_gate and b.unsupported == ["New York Times", "Los Angeles"] and b.n_missing == 1
    assert evaluate.summary(evaluate.evaluated(rows, found))["passed"] == 1


def test_evaluation_of_no_rows(spark):
    empty = spark.createDataFrame([], "row_index long, text string")
    s = evaluate.summary(evaluate.evaluated(empty, evaluate.sources(docs(spark, [("d", "x", [])]))))
    assert s["rows"] == 0 and s["pass_rate"] == 0.0 and s["score_summary"]["overall"]["mean"] == 0.0


def test_config_and_cli():
    for bad in ({"mode": "x"}, {"entity_strategy": "x"}, {"path_strategy": "x"}, {"styles": ("x",)}, {"combo_sizes": (0,)}):
        with pytest.raises(ValueError):
            GenerateConfig(**bad)
    args = cli.parser().parse_args(["generate", "--input", "a", "--output", "b", "--entity-cache", "c", "--combo-sizes", "2,4", "--styles", "default,causal"])
    assert args.combo_sizes == (2, 4) and args.styles == ("default", "causal")
    with pytest.raises(SystemExit):
        cli.parser().parse_args(["generate", "--combo-sizes", "0"])
    assert EvaluateConfig().min_overall == 0.75
    with pytest.raises(ValueError):
        GenerateConfig(workers=0)


def test_defaults_and_option_names():
    """The values and names that users of the reference know."""
    d = vars(cli.parser().parse_args(["generate", "--input", "a", "--output", "b", "--entity-cache", "c"]))
    known = dict(provider="local", timeout=120.0, max_retries=4, mode="single-doc", combo_sizes=(2, 3), max_entities=60, entity_strategy="llm-order", min_shared=1, max_shared=12, path_length=3, max_paths=1000, max_section_chars=1800, path_strategy="dfs", candidate_multiplier=8, path_min_shared=0, styles=("default",), group_size=3, group_max_examples=100, group_max_chars=6000, seed=13, workers=8, max_in_flight=None, entity_temperature=0.0, relation_temperature=1.0, entity_max_tokens=2048, relation_max_tokens=2048, json_mode=False, resume=True, max_docs=None, max_combos=None, max_pairs=None)
    assert {k: d[k] for k in known} == known
    assert {k: getattr(GenerateConfig(), k) for k in known if hasattr(GenerateConfig(), k)}.items() <= known.items()
    options = "--api-key k --json-mode --no-progress --max-in-flight 3 --entity-temperature 0.5 --sog-min-shared-entities 2 --max-combos-per-doc 4 --generation-styles causal --cross-doc-sample-pairs --entity-selection-strategy rarity"
    d = vars(cli.parser().parse_args(["generate", "--input", "a", "--output", "b", "--entity-cache", "c", "--title-key", "", *options.split()]))
    assert (d["api_key"], d["json_mode"], d["max_in_flight"], d["entity_temperature"], d["path_min_shared"], d["max_combos"], d["styles"], d["sample_pairs"], d["entity_strategy"], d["title_key"]) == ("k", True, 3, 0.5, 2, 4, ("causal",), True, "rarity", None)
    e = vars(cli.parser().parse_args("evaluate --input a --generated b --id-key x --max-redundancy-overlap 0.5".split()))
    assert (e["sources"], e["id_key"], e["max_overlap"], e["output_dir"]) == ("a", "x", 0.5, "evaluate")
    assert cli.labelled("x/y.jsonl") == ("y", "x/y.jsonl") and cli.labelled("a=b") == ("a", "b")


def test_chat_helpers(monkeypatch):
    from quillgraph.config import ChatConfig

    assert chat.message_text({"choices": [{"message": {"content": [{"text": "a"}, {"text": "b"}]}}]}) == "a\nb"
    with pytest.raises(ValueError):
        chat.message_text({})
    for name in ("OPENAI_API_KEY", "VLLM_API_KEY"):
        monkeypatch.delenv(name, raising=False)
    assert chat.resolved_key(ChatConfig(provider="vllm")) == chat.resolved_key(ChatConfig()) == "EMPTY"
    assert chat.resolved_url(ChatConfig()) == "http://localhost:8000/v1"
    with pytest.raises(chat.ChatError):
        chat.resolved_key(ChatConfig(provider="openai"))
    monkeypatch.setenv("OPENAI_API_KEY", "other")
    assert chat.resolved_key(ChatConfig(provider="openai")) == "other" and chat.resolved_key(ChatConfig()) == "EMPTY"
    assert chat.resolved_key(ChatConfig(api_key="given", provider="openai")) == "given"
    assert "secret" not in repr(ChatConfig(api_key="secret"))


def test_stream_appends_once(spark, tmp_path):
    from quillgraph.streaming.resume import append_once, document_stream

    source = tmp_path / "in"
    source.mkdir()
    (source / "a.jsonl").write_text('{"id": "a", "text": "Alpha one."}\n{"id": "b", "text": "Beta"}\n{"id": "c", "text": " "}\n')
    table = str(tmp_path / "table")
    for k in range(2):
        append_once(document_stream(spark, str(source)), "doc_id", table, str(tmp_path / f"check{k}")).awaitTermination()
    assert sorted(r.doc_id for r in spark.read.parquet(table).collect()) == ["a", "b"]


def test_upsert_stream(spark, tmp_path):
    from quillgraph.streaming.resume import document_stream, latest, upsert_log

    source, log, check = tmp_path / "in", str(tmp_path / "log"), str(tmp_path / "check")
    source.mkdir()
    batches = [["a 1", "b 1"], ["a 1", "b 2", "c 1"], ["a 2"], ["a 1"]]
    sizes = []
    for k, rows in enumerate(batches):
        (source / f"{k}.jsonl").write_text("".join(json.dumps({"id": r[0], "text": r}) + "\n" for r in rows))
        upsert_log(document_stream(spark, str(source)), log, check).awaitTermination()
        sizes.append(spark.read.parquet(log).count())
    assert sizes == [2, 4, 5, 6]
    assert {r.doc_id: r.text for r in latest(spark, log).collect()} == {"a": "a 1", "b": "b 2", "c": "c 1"}
