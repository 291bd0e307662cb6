"""The whole run: scan, entities, tasks of each mode, resume, model calls, sink, counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import EvaluateConfig, GenerateConfig
from ..functions import text as t
from ..operators import combos, compare, crossdoc, entities, evaluate, generate, paths, prompts, sections
from ..sources import jsonl, sinks

#: Key column and mode's name in generated rows.
KEYS = {"single-doc": ("relation_id", "single_doc"), "cross-doc": ("graph_id", "cross_doc"), "sog-lite": ("path_id", "sog_lite"), "long-context": ("long_context_id", "long_context"), "longfaith-qa": ("qa_id", "longfaith_qa")}
PATH_METRICS = ["section_count", "doc_count", "entity_count", "shared_count", "crossings", "bridge", "coverage"]
TASK_TYPES = {"single-doc": "entity_relation", "cross-doc": "cross_document_graph", "sog-lite": "graph_path_synthesis", "long-context": "multi_path_long_context_synthesis", "longfaith-qa": "cited_long_context_qa"}


def modes_of(mode: str) -> list[str]:
    return {"both": ["single-doc", "cross-doc"], "all": list(KEYS)}.get(mode, [mode])


def refreshed_cache(docs: DataFrame, cache_path: str, factory: generate.ClientFactory, config: GenerateConfig) -> DataFrame:
    """Entity records of all cached documents, after those that are missing, changed or failed were extracted and appended.

    The cache is written before it is read again, so that no document is asked about twice.
    """
    spark = docs.sparkSession
    known = jsonl.entity_cache(jsonl.scan(spark, cache_path, strict=False)) if config.resume and sinks.exists(spark, cache_path) else None
    todo = docs if known is None else docs.join(entities.stale(docs, known).select("doc_id"), "doc_id", "left_semi")
    sinks.append_jsonl(generate.extracted(todo, factory, config.workers, config.min_entity_chars, config.max_in_flight, temperature=config.entity_temperature, max_tokens=config.entity_max_tokens, json_object=config.json_mode), cache_path)
    records = jsonl.entity_cache(jsonl.scan(spark, cache_path, strict=False))
    return records if config.resume else records.join(docs.select("doc_id"), "doc_id", "left_semi")


def path_frame(docs: DataFrame, config: GenerateConfig, kept: list[DataFrame]) -> DataFrame:
    """The ranked paths of documents with entities; built once for all modes that use them. What is persisted is added to kept."""
    nodes = sections.section_nodes(docs, config.max_section_chars).persist()
    edges = sections.section_edges(nodes).persist()
    found = paths.sampled(nodes, edges, config.path_length, config.max_paths, config.candidate_multiplier, config.path_strategy != "dfs")
    out = paths.ranked(paths.described(found, nodes), config.path_strategy, config.max_paths).persist()
    kept += [nodes, edges, found, out]
    return out


def _distinct(field: str) -> Column:
    return F.array_distinct(F.transform("chunks", lambda c: c[field]))


def tasks_of(mode: str, docs: DataFrame, records: DataFrame, found: DataFrame | None, config: GenerateConfig) -> DataFrame:
    """key, system, prompt and the columns of a generated row, for each task of a mode. docs has entities."""
    key, name = KEYS[mode]
    if mode == "single-doc":
        rows = combos.relation_tasks(docs, config.combo_sizes, config.max_combos, config.sample_combos, config.seed)
        system = F.lit(prompts.GENERIC)
        for size in (2, 3):
            system = F.when(F.col("combo_size") == size, prompts.relation_instruction(size)).otherwise(system)
        extra = [F.col("text").alias("source_text")] if config.include_source_text else []
        out = rows.select(F.col(key), system.alias("system"), prompts.relation_prompt("title", "text", "entities").alias("prompt"), "doc_id", "source_index", "source_sha256", "title", "combo_size", "entities", F.concat(F.lit("relation_"), F.col("combo_size").cast("string")).alias("prompt_name"), *extra)
    elif mode == "cross-doc":
        rows = crossdoc.cross_doc_tasks(docs, records, config.min_shared, config.max_shared, config.max_pairs, config.sample_pairs, config.seed)
        both = lambda c: F.array(F.col(f"a.{c}"), F.col(f"b.{c}"))
        extra = [both("text").alias("source_texts")] if config.include_source_text else []
        out = rows.select(F.col(key), F.lit(prompts.CROSS).alias("system"), prompts.cross_prompt("a.title", "a.text", "b.title", "b.text", "shared").alias("prompt"), both("doc_id").alias("doc_ids"), both("source_index").alias("source_indices"), both("source_sha256").alias("source_sha256s"), both("title").alias("titles"), F.col("shared").alias("shared_entities"), F.size("shared").alias("shared_entity_count"), F.lit("cross_document_graph_pair").alias("prompt_name"), *extra)
    elif mode == "long-context":
        rows = paths.long_context_tasks(found, config.group_size, config.group_max_chars, config.styles, config.group_max_examples, config.path_min_shared)
        rows = rows.withColumn("chunks", F.flatten(F.transform("paths", lambda p: p["chunks"])))
        metrics = F.transform("paths", lambda p: F.struct(*[p[c].alias(c) for c in PATH_METRICS]))
        out = rows.select(F.col(key), F.lit(prompts.LONG).alias("system"), prompts.long_prompt("paths", "entities", "style").alias("prompt"), "path_ids", *path_columns(), F.array_distinct(F.transform("chunks", lambda c: c["section_id"])).alias("section_ids"), F.array_distinct(F.transform("chunks", lambda c: c["section_title"])).alias("section_titles"), "entities", F.col("shared").alias("shared_entities"), F.size("paths").alias("path_count"), F.size("chunks").alias("chunk_count"), metrics.alias("path_metrics_list"), F.lit(config.path_strategy).alias("path_strategy"), "style", F.lit("long_context_graph_paths").alias("prompt_name"))
    else:
        rows = paths.path_tasks(found, config.path_min_shared, config.styles)
        metrics = F.struct(*[F.col(c) for c in PATH_METRICS])
        shared = [*path_columns(), "section_ids", F.transform("chunks", lambda c: c["section_title"]).alias("section_titles"), "entities", F.col("shared").alias("shared_entities"), F.col("section_count").alias("path_length"), metrics.alias("path_metrics"), F.lit(config.path_strategy).alias("path_strategy"), "style"]
        if mode == "sog-lite":
            extra = [F.col("chunks").alias("source_chunks")] if config.include_source_text else []
            out = rows.select(F.col(key), F.lit(prompts.PATH).alias("system"), prompts.path_prompt("chunks", "entities", "style").alias("prompt"), *shared, F.lit("sog_lite_graph_path").alias("prompt_name"), *extra)
        else:
            rows = paths.qa_tasks(rows)
            out = rows.select(F.col(key), F.lit(prompts.QA).alias("system"), prompts.qa_prompt("chunks", "entities", "target_entities", "style").alias("prompt"), "path_id", *shared, "target_entities", prompts.cited_context("chunks").alias("context"), F.lit("longfaith_graph_path_qa").alias("prompt_name"))
    return out.withColumns({"generation_mode": F.lit(name), "task_type": F.lit(TASK_TYPES[mode])} | {k: F.lit(v) for k, v in config.metadata})


def path_columns() -> list[Column]:
    return [_distinct("doc_id").alias("doc_ids"), _distinct("source_index").alias("source_indices"), _distinct("source_sha256").alias("source_sha256s"), _distinct("title").alias("titles")]


def run_tasks(mode: str, tasks: DataFrame, output: str, factory: generate.ClientFactory, config: GenerateConfig) -> dict[str, int]:
    """Calls the model for each task that isn't done, appends the rows, and counts them. Rows are keyed by mode and id, so modes don't complete each other's tasks."""
    spark, (key, name) = tasks.sparkSession, KEYS[mode]
    considered = tasks.count()
    if config.resume and sinks.exists(spark, output):
        old = jsonl.scan(spark, output, strict=False)
        done = jsonl.completed_keys(old.where(jsonl.text_at("generation_mode") == name), key)
        todo = generate.without_done(tasks, done, key)
    else:
        todo = tasks.dropDuplicates([key])
    before = appended(spark, output, name)
    asked = todo.withColumnRenamed(key, "key")
    answers = generate.with_answers(asked, factory, config.workers, config.max_in_flight, temperature=config.relation_temperature, max_tokens=config.relation_max_tokens, json_object=config.json_mode and mode == "longfaith-qa")
    if mode == "longfaith-qa":
        answers = generate.parsed_qa(answers)
        rows = asked.drop("system", "prompt").join(answers.withColumnRenamed("answer", "raw_response"), "key")
        text = F.when(F.col("failure").isNull(), prompts.qa_text("question", "answer_text", "reasoning", "context")).otherwise("")
        rows = rows.withColumn("text", text).withColumnRenamed("answer_text", "answer")
    else:
        rows = asked.drop("system", "prompt").join(answers, "key").withColumn("text", F.coalesce("answer", F.lit(""))).drop("answer")
    sinks.append_jsonl(rows.withColumnRenamed("key", key).withColumnRenamed("failure", "error"), output)
    after = appended(spark, output, name)
    made = {k: after[k] - before[k] for k in after}
    return {f"{name}_considered": considered, f"{name}_skipped": considered - made["rows"], f"{name}_generated": made["rows"] - made["failed"], f"{name}_failed": made["failed"]}


def appended(spark: SparkSession, output: str, name: str) -> dict[str, int]:
    """Rows, and failed ones, of a mode in the output."""
    if not sinks.exists(spark, output):
        return {"rows": 0, "failed": 0}
    rows = jsonl.scan(spark, output, strict=False).where(jsonl.text_at("generation_mode") == name)
    found = rows.agg(F.count("*").alias("rows"), F.coalesce(F.sum((F.coalesce(jsonl.text_at("error"), F.lit("")) != "").cast("long")), F.lit(0)).alias("failed")).first()
    return {"rows": found["rows"], "failed": int(found["failed"])}


def run(spark: SparkSession, config: GenerateConfig, documents: DataFrame | str, cache: str, output: str, factory: generate.ClientFactory) -> dict[str, int]:
    """Runs the modes of a configuration over documents (a JSONL path, or a scan of objects) and returns the counts."""
    kept: list[DataFrame] = []
    try:
        return _run(spark, config, documents, cache, output, factory, kept)
    finally:
        for df in kept:
            df.unpersist()


def _run(spark: SparkSession, config: GenerateConfig, documents: DataFrame | str, cache: str, output: str, factory: generate.ClientFactory, kept: list[DataFrame]) -> dict[str, int]:
    scan = jsonl.scan(spark, documents) if isinstance(documents, str) else documents
    docs = jsonl.documents(scan, config.text_key, config.title_key, config.id_key, config.max_docs).drop("raw").persist()
    kept.append(docs)
    records = refreshed_cache(docs, cache, factory, config)
    chosen = entities.select_entities(records, docs, config.max_entities, config.entity_strategy).persist()
    full = entities.with_entities(docs, chosen).persist()
    kept += [chosen, full]
    total = lambda df: int(df.agg(F.coalesce(F.sum(F.size("entities")), F.lit(0))).first()[0])
    stats = {"documents": docs.count(), "entities_extracted": total(records), "entities_selected": total(chosen), "entity_errors": records.where("error is not null").count()}
    wanted = modes_of(config.mode)
    found = path_frame(full, config, kept) if {"sog-lite", "long-context", "longfaith-qa"} & set(wanted) else None
    fine = chosen.where("error is null")
    for mode in wanted:
        stats |= run_tasks(mode, tasks_of(mode, full, fine, found, config), output, factory, config)
    return stats


def fixture_report(spark: SparkSession, fixture: str, cache: str | None = None, sizes: tuple[int, ...] = (2, 3), generated: tuple[str, ...] = (), top: int = 50) -> str:
    """A corpus for a person to read: combinations of its first top documents and of all, the top entities and pairs of documents by overlap, and what generated files hold."""
    docs = jsonl.fixture(spark, fixture)
    if cache:
        newer = jsonl.entity_cache(jsonl.scan(spark, cache)).select("doc_id", t.normalized_entities("entities").alias("_entities"))
        docs = docs.join(newer, "doc_id", "left").withColumn("entities", F.coalesce("_entities", "entities")).drop("_entities")
    counts = compare.combo_counts(docs, sizes)
    names = [f"n_{k}" for k in sizes]
    whole = counts.agg(F.count("*").alias("documents"), *[F.coalesce(F.sum(n), F.lit(0)).alias(n) for n in names]).first()
    listed = lambda r: ", ".join(f"{k}-way={r[n]}" for k, n in zip(sizes, names, strict=True))
    lines = [f"fixture: {fixture}", f"documents: {whole['documents']}", "", "combinations in a document"]
    lines += [f"- {r['doc_id']}: entities={r['n_entities']}; {listed(r)}" for r in counts.orderBy("doc_id").limit(top).collect()]
    lines += [f"total: {listed(whole)}", "", "entities of several documents"]
    shared = compare.overlap_mentions(docs).groupBy("key").agg(F.min("entity").alias("entity"), F.count("*").alias("n")).where("n > 1")
    lines += [f"- {r['entity']}: {r['n']}" for r in shared.orderBy(F.desc("n"), "key").limit(top).collect()]
    lines += ["", "pairs of documents by shared entities"]
    pairs = compare.entity_overlap_pairs(docs).orderBy(F.desc("n"), "doc_a", "doc_b").limit(top)
    lines += [f"- {r['doc_a']} <-> {r['doc_b']}: {r['n']}" for r in pairs.collect()]
    for path in generated:
        columns = [(jsonl.strings_at(c) if c in ("entities", "shared_entities", "doc_ids") else jsonl.text_at(c)).alias(c) for c in ("doc_id", "graph_id", "entities", "shared_entities", "doc_ids", "error")]
        rows = compare.generated_summary(jsonl.scan(spark, path).select(*columns))
        lines += ["", f"generated: {path}", *[f"- {r['measure']}: {r['value']}" for r in rows.orderBy("measure").collect()]]
    return "\n".join(lines) + "\n"


def comparison_report(spark: SparkSession, sources: str, generated: dict[str, str], cache: str | None = None) -> str:
    """Generated files, by label, scored against one corpus, as a Markdown table."""
    found = evaluate_sources(spark, sources, cache)
    # One file at a time, since evaluation goes by row numbers.
    scored = [evaluate.evaluated(generated_rows(spark, path), found, EvaluateConfig()).withColumn("label", F.lit(label)) for label, path in generated.items()]
    return compare.comparison_table(compare.compare_generation(reduce(DataFrame.unionByName, scored)))


def evaluate_sources(spark: SparkSession, sources: str, cache: str | None, config: EvaluateConfig = EvaluateConfig()) -> DataFrame:
    docs = jsonl.documents(jsonl.scan(spark, sources), config.text_key, config.title_key, config.id_key)
    docs = docs.withColumn("entities", jsonl.strings_at("entities")).drop("raw")
    return evaluate.sources(docs, jsonl.entity_cache(jsonl.scan(spark, cache, strict=False)) if cache else None)


def generated_rows(spark: SparkSession, generated: str) -> DataFrame:
    raw = jsonl.scan(spark, generated, strict=False)
    columns = [(jsonl.strings_at(c) if kind.startswith("array") else jsonl.text_at(c)).alias(c) for c, kind in evaluate.COLUMNS.items() if c != "row_index"]
    return raw.select("row_index", *columns)


def evaluate_files(spark: SparkSession, sources: str, generated: str, out_dir: str, cache: str | None = None, config: EvaluateConfig | None = None) -> dict:
    """Scores a generated file against its sources and writes rows, probes, summary and report into out_dir."""
    config = config or EvaluateConfig()
    result = evaluate.evaluated(generated_rows(spark, generated), evaluate_sources(spark, sources, cache, config), config).persist()
    sinks.overwrite_jsonl(evaluate.report_rows(result), f"{out_dir}/rows.jsonl")
    sinks.overwrite_jsonl(evaluate.probes(result), f"{out_dir}/probes.jsonl")
    summary = evaluate.summary(result) | {"thresholds": vars(config), "paths": {"sources": sources, "generated": generated}}
    sinks.write_json(summary, f"{out_dir}/summary.json")
    sinks.write_text(evaluate.report(result), f"{out_dir}/report.md")
    result.unpersist()
    return summary
