"""The quality gate: scores of generated rows against their sources, as one plan of joins and expressions.

Generated rows are one wide table: a column for each key of the five layouts, null where a layout lacks it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import EvaluateConfig
from ..functions import text as t

#: Words that don't count as content, and words that speak of relations.
STOPWORDS = ["a", "an", "and", "are", "as", "by", "for", "from", "in", "into", "is", "it", "of", "on", "or", "that", "the", "their", "these", "this", "to", "was", "were", "with"]
RELATION_TERMS = ["associated", "because", "between", "borrowed", "caused", "connected", "connects", "context", "contrasts", "described", "describes", "difference", "inspired", "interaction", "linked", "relationship", "shared", "similar", "together", "translated"]
#: Weights of the overall score, added in this order; scores that are reported.
WEIGHTS = {"selected_entity_support": 0.22, "selected_entity_mention": 0.18, "unsupported_proper_noun_score": 0.18, "redundancy_score": 0.12, "relation_signal": 0.12, "specificity": 0.08, "structure": 0.05, "length": 0.05}
SCORES = ["overall", *list(WEIGHTS)[:4], "source_5gram_overlap", *list(WEIGHTS)[4:], "citation_support"]
WARNINGS = {
    "error": "generated row has error",
    "missing": "one or more source documents were not found",
    "empty": "generated text is empty",
    "support": "selected entities are not fully supported by source documents",
    "mention": "generated text omits selected entities",
    "nouns": "generated text contains unsupported proper nouns",
    "overlap": "generated text is too close to source text",
    "citation": "reasoning does not cite at least two valid support chunks",
}
#: Columns of a generated row, with types; wide() adds those that a table lacks.
COLUMNS = {
    "row_index": "long", "relation_id": "string", "graph_id": "string", "path_id": "string", "long_context_id": "string", "qa_id": "string",
    "doc_id": "string", "doc_ids": "array<string>", "title": "string", "entities": "array<string>", "shared_entities": "array<string>", "target_entities": "array<string>",
    "generation_mode": "string", "task_type": "string", "style": "string", "question": "string", "answer": "string", "reasoning": "string", "support_ids": "array<string>", "text": "string", "error": "string",
}
IDS = {"longfaith_qa": "qa_id", "long_context": "long_context_id", "sog_lite": "path_id", "cross_doc": "graph_id"}


def wide(rows: DataFrame) -> DataFrame:
    return rows.select(*[(F.col(c).cast(k) if c in rows.columns else F.lit(None).cast(k)).alias(c) for c, k in COLUMNS.items()])


def classified(rows: DataFrame) -> DataFrame:
    """rows with mode: the first of qa, long, path and cross whose name or key a row has, else single."""
    mode = F.lit("single_doc")
    for name, key in reversed(IDS.items()):
        mode = F.when((F.coalesce("generation_mode", F.lit("")) == name) | F.col(key).isNotNull(), name).otherwise(mode)
    return rows.withColumn("mode", mode)


def _filled(c: str) -> Column:
    return F.nullif(F.coalesce(F.col(c), F.lit("")), F.lit(""))


def prepared(rows: DataFrame) -> DataFrame:
    """classified() with ids (the documents), selected entities, generated_id and body (the text that is scored)."""
    rows = classified(rows)
    clean = lambda c: t.normalized_entities(F.coalesce(F.col(c), F.array().cast("array<string>")), 1, t.norm)
    rows = rows.withColumns({"_t": clean("target_entities"), "_s": clean("shared_entities"), "_e": clean("entities")})
    selected = F.when(F.size("_t") > 0, F.col("_t")).when((F.col("mode") != "single_doc") & (F.size("_s") > 0), F.col("_s")).otherwise(F.col("_e"))
    parts = F.filter(F.array(*[t.strip(F.coalesce(F.col(c), F.lit(""))) for c in ("question", "answer", "reasoning")]), lambda x: x != "")
    none = F.array().cast("array<string>")
    return rows.withColumns({
        "ids": F.coalesce("doc_ids", F.when(F.col("doc_id").isNotNull(), F.array("doc_id")), none),
        "selected": selected,
        "generated_id": F.coalesce(*[_filled(c) for c in ("relation_id", "graph_id", "qa_id", "long_context_id", "path_id")], F.col("row_index").cast("string")),
        "body": F.when(F.col("mode") == "longfaith_qa", F.array_join(parts, "\n\n")).otherwise(F.coalesce("text", F.lit(""))),
    }).drop("_t", "_s", "_e")


def sources(docs: DataFrame, cache: DataFrame | None = None) -> DataFrame:
    """doc_id, title, text, entities of the source documents (docs has its own entities), with the cache's entities before their own."""
    own = F.coalesce("entities", F.array().cast("array<string>")) if "entities" in docs.columns else F.array().cast("array<string>")
    out = docs.select("doc_id", "title", "text", own.alias("entities"))
    if cache is not None:
        newer = cache.select("doc_id", F.col("entities").alias("_entities"))
        out = out.join(newer, "doc_id", "left").select("doc_id", "title", "text", F.coalesce("_entities", "entities").alias("entities"))
    return out


def features(found: DataFrame) -> DataFrame:
    """What rows are compared with, computed once for each document: normalised text, entity keys, 5-grams, and the keys of names."""
    out = found.withColumn("_tokens", t.tokens("text")).withColumn("entities", t.normalized_entities("entities", 1, t.norm))
    whole = F.concat_ws("\n", "title", "text")
    return out.select("doc_id", F.array_join("_tokens", " ").alias("norm"), F.transform("entities", t.norm).alias("keys"), t.ngrams("_tokens").alias("grams"), F.array_distinct(F.transform(t.proper_nouns(whole), t.norm)).alias("names"))


def joined_sources(rows: DataFrame, found: DataFrame) -> DataFrame:
    """rows with found_docs: features of their documents in order. Ids without a document are left out."""
    each = rows.select("row_index", F.posexplode("ids").alias("_pos", "doc_id")).join(features(found), "doc_id")
    lists = each.groupBy("row_index").agg(F.sort_array(F.collect_list(F.struct("_pos", "norm", "keys", "grams", "names"))).alias("found_docs"))
    none = F.array().cast(lists.schema["found_docs"].dataType)
    return rows.join(lists, "row_index", "left").withColumn("found_docs", F.coalesce("found_docs", none))


def measured(rows: DataFrame) -> DataFrame:
    """The counts that scores are made of, as whole numbers: columns whose names begin with n_, and unsupported."""
    rows = rows.withColumns({"_keys": F.transform("selected", t.norm), "_tokens": t.tokens("body"), "_names": t.proper_nouns("body")})
    rows = rows.withColumns({"_norm": F.array_join("_tokens", " "), "_grams": t.ngrams("_tokens"), "_docs": F.col("found_docs")})
    holds = lambda k: lambda d: F.array_contains(d["keys"], k) | F.contains(d["norm"], k)
    every = F.filter("_keys", lambda k: F.forall("_docs", holds(k)))
    some = F.filter("_keys", lambda k: F.exists("_docs", holds(k)))
    rows = rows.withColumn("_mentioned", F.filter("_keys", lambda k: F.contains("_norm", k)))
    rows = rows.withColumn("_allowed", F.array_union("_keys", F.flatten(F.transform("_docs", lambda d: F.array_union(d["keys"], d["names"])))))
    spoken = F.filter("_names", lambda p: ~F.forall(F.split(p, r"\s+"), lambda w: w.isin(t.SECTION_WORDS)))
    rows = rows.withColumn("_spoken", F.transform(spoken, lambda p: F.struct(t.norm(p).alias("key"), p.alias("phrase"))))
    rows = rows.withColumn("_spokenkeys", F.transform("_spoken", lambda x: x["key"]))
    unknown = F.filter("_spoken", lambda x, i: (x["key"] != "") & ~F.array_contains("_allowed", x["key"]) & (F.array_position("_spokenkeys", x["key"]) == i + 1))
    lines = F.split("body", r"\r\n|[\n\r\u000B\f\u001C\u001D\u001E\u0085\u2028\u2029]")
    support = F.filter(F.transform(F.coalesce("support_ids", F.array().cast("array<string>")), lambda s: F.btrim(s, F.lit("[] "))), lambda s: s != "")
    cited = F.array_distinct(F.regexp_extract_all(F.coalesce("reasoning", F.lit("")), F.lit(r"\[(\d+)\]"), F.lit(1)))
    size = lambda c: F.size(c).cast("long")
    measures = {
        "n_selected": size("selected"),
        "n_supported": size(F.when(F.col("mode") == "cross_doc", every).otherwise(some)),
        "n_mentioned": size("_mentioned"),
        "unsupported": F.transform(unknown, lambda x: x["phrase"]),
        "n_grams": size("_grams"),
        "n_shared_grams": F.coalesce(F.array_max(F.transform("_docs", lambda d: F.size(F.array_intersect(d["grams"], "_grams")))), F.lit(0)).cast("long"),
        "n_terms": size(F.array_intersect("_tokens", F.array(*map(F.lit, RELATION_TERMS)))),
        "n_content": size(F.filter("_tokens", lambda w: ~w.isin(STOPWORDS))),
        "n_entity_tokens": F.aggregate("_mentioned", F.lit(0).cast("long"), lambda n, k: n + F.when(k == "", F.lit(0)).otherwise(F.size(F.split(k, " "))).cast("long")),
        "n_headings": F.regexp_count("body", F.lit(r"(?mdU)^###\s+")).cast("long"),
        "n_lines": size(F.filter(lines, lambda x: t.strip(x) != "")),
        "n_tokens": size("_tokens"),
        "n_cited": size(F.when(F.size(support) > 0, F.array_intersect(support, cited)).otherwise(cited)),
        "n_missing": (F.size("ids") - F.size("_docs")).cast("long"),
    }
    # Through a generator, which the optimizer doesn't merge with what reads the measures: they are computed once a row.
    gone = {"_keys", "_tokens", "_names", "_norm", "_grams", "_docs", "_mentioned", "_allowed", "_spoken", "_spokenkeys"}
    once = F.explode(F.array(F.struct(*[x.alias(c) for c, x in measures.items()]))).alias("_m")
    return rows.select(*[c for c in rows.columns if c not in gone], once).select("*", "_m.*").drop("_m")


def scored(rows: DataFrame, config: EvaluateConfig = EvaluateConfig()) -> DataFrame:
    """measured() with the scores (unrounded but for overall), pass_gate and warnings."""
    n = lambda c: F.col(c).cast("double")
    share = lambda a, b: F.when(F.col(b) > 0, n(a) / n(b)).otherwise(0.0)
    qa = F.col("mode") == "longfaith_qa"
    blank = t.strip("body") == ""
    rows = rows.withColumns({
        "selected_entity_support": F.when((F.col("mode") == "cross_doc") & (F.size("found_docs") == 0) & (F.col("n_selected") > 0), 1.0).otherwise(share("n_supported", "n_selected")),
        "selected_entity_mention": share("n_mentioned", "n_selected"),
        "unsupported_proper_noun_score": t.clamp01(1.0 - F.size("unsupported").cast("double") / 5.0),
        "source_5gram_overlap": share("n_shared_grams", "n_grams"),
    })
    rows = rows.withColumns({
        "redundancy_score": t.clamp01(1.0 - F.greatest(F.lit(0.0), F.col("source_5gram_overlap") - 0.25) / 0.5),
        "relation_signal": t.clamp01(n("n_terms") / 4.0 * 0.6 + F.col("selected_entity_mention") * 0.4),
        "specificity": F.when(F.col("n_content") > 0, t.clamp01(n("n_entity_tokens") / n("n_content") * 8.0)).otherwise(0.0),
        "structure": F.when(blank, 0.0).otherwise(t.clamp01(F.least(n("n_headings"), F.lit(3.0)) * 0.5 / 3.0 + F.least(n("n_lines"), F.lit(4.0)) * 0.5 / 4.0)),
        "length": F.when(F.col("n_tokens") < 20, n("n_tokens") / 20.0).when(F.col("n_tokens") <= 700, 1.0).otherwise(F.greatest(F.lit(0.0), 1.0 - (n("n_tokens") - 700) / 700.0)),
        "citation_support": F.when(qa, F.least(F.lit(1.0), n("n_cited") / 2.0)).otherwise(1.0),
    })
    total = None
    for name, weight in WEIGHTS.items():
        total = F.col(name) * weight if total is None else total + F.col(name) * weight
    overall = t.round4(total)
    rows = rows.withColumn("overall", F.when(qa, t.round4(overall * 0.9 + F.col("citation_support") * 0.1)).otherwise(overall))
    failed = F.coalesce("error", F.lit("")) != ""
    flags = {
        "error": failed,
        "missing": F.col("n_missing") != 0,
        "empty": blank,
        "support": F.col("selected_entity_support") < config.min_support,
        "mention": F.col("selected_entity_mention") < config.min_mention,
        "nouns": F.size("unsupported") > 0,
        "overlap": F.col("source_5gram_overlap") > config.max_overlap,
        "citation": qa & (F.col("citation_support") < 1.0),
    }
    gate = (F.col("overall") >= config.min_overall) & (F.size("unsupported") <= config.max_unsupported)
    for k in ("error", "empty", "support", "mention", "overlap", "citation"):
        gate = gate & ~flags[k]
    return rows.withColumns({"pass_gate": gate, "warnings": F.array_compact(F.array(*[F.when(flags[k], F.lit(w)) for k, w in WARNINGS.items()]))})


def evaluated(rows: DataFrame, found: DataFrame, config: EvaluateConfig = EvaluateConfig()) -> DataFrame:
    return scored(measured(joined_sources(prepared(wide(rows)), found)), config)


def report_rows(result: DataFrame) -> DataFrame:
    """The layout of an evaluation row: scores rounded, in one struct."""
    scores = F.struct(*[t.round4(F.col(c)).alias(c) for c in SCORES])
    return result.select("row_index", "generated_id", F.col("mode").alias("generation_mode"), F.coalesce("style", F.lit("default")).alias("style"), F.col("ids").alias("doc_ids"), F.col("selected").alias("selected_entities"), scores.alias("scores"), "pass_gate", "warnings", F.col("unsupported").alias("unsupported_proper_nouns"))


def probes(result: DataFrame) -> DataFrame:
    """generated_id, probe_type, question, expected_answer, entity: a question for each selected entity."""
    rows = result.select("generated_id", "mode", "title", "ids", F.explode("selected").alias("entity"))
    cross = F.col("mode") == "cross_doc"
    question = F.when(cross, F.concat(F.lit("Which source documents are connected by the shared entity "), "entity", F.lit("?"))).otherwise(F.concat(F.lit("Which generated passage discusses "), "entity", F.lit(" in relation to the source document?")))
    single = F.when(F.size("ids") > 0, F.coalesce(_filled("title"), F.element_at("ids", 1))).otherwise("")
    return rows.select("generated_id", F.when(cross, "cross_doc_bridge").otherwise("single_doc_entity").alias("probe_type"), question.alias("question"), F.when(cross, F.array_join("ids", ", ")).otherwise(single).alias("expected_answer"), "entity")


def score_summary(result: DataFrame) -> DataFrame:
    """score, mean, min, max over the rounded scores of all rows."""
    pairs = ", ".join(f"'{c}', `{c}`" for c in SCORES)
    rows = result.select(*[t.round4(F.col(c)).alias(c) for c in SCORES]).selectExpr(f"stack({len(SCORES)}, {pairs}) as (score, value)")
    return rows.groupBy("score").agg(t.round4(F.avg("value")).alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"))


def warning_counts(result: DataFrame) -> DataFrame:
    return result.select(F.explode("warnings").alias("warning")).groupBy("warning").agg(F.count("*").alias("n"))


def rows_by_mode(result: DataFrame) -> DataFrame:
    return result.groupBy("mode").agg(F.count("*").alias("n"))


def pass_counts(result: DataFrame) -> DataFrame:
    """n_rows, n_passed, n_failed."""
    passed = F.coalesce(F.sum(F.col("pass_gate").cast("long")), F.lit(0)).cast("long")
    return result.agg(F.count("*").alias("n_rows"), passed.alias("n_passed")).withColumn("n_failed", F.col("n_rows") - F.col("n_passed"))


def failed_rows(result: DataFrame, most: int = 25) -> DataFrame:
    return result.where(~F.col("pass_gate")).orderBy("row_index").limit(most).select("row_index", "generated_id", "mode")


def summary(result: DataFrame) -> dict:
    """The whole summary, from aggregates of a few rows each."""
    counts = pass_counts(result).first()
    scores = {r.score: {"mean": r["mean"], "min": r["min"], "max": r["max"]} for r in score_summary(result).collect()}
    if not counts.n_rows:
        scores = {c: {"mean": 0.0, "min": 0.0, "max": 0.0} for c in SCORES}
    return {
        "rows": counts.n_rows,
        "passed": counts.n_passed,
        "failed": counts.n_failed,
        "pass_rate": round(counts.n_passed / counts.n_rows, 4) if counts.n_rows else 0.0,
        "rows_by_mode": {r["mode"]: r.n for r in rows_by_mode(result).orderBy("mode").collect()},
        "score_summary": scores,
        "warning_counts": {r.warning: r.n for r in warning_counts(result).orderBy("warning").collect()},
    }


def report(result: DataFrame) -> str:
    """The summary as Markdown, with the first 25 rows that failed."""
    s = summary(result)
    lines = ["# Evaluation", "", f"- rows: {s['rows']}", f"- passed: {s['passed']}", f"- failed: {s['failed']}", f"- pass rate: {s['pass_rate']}", "", "## Scores", ""]
    lines += [f"- {k}: mean {v['mean']}, min {v['min']}, max {v['max']}" for k, v in sorted(s["score_summary"].items())]
    lines += ["", "## Warnings", "", *([f"- {k}: {v}" for k, v in s["warning_counts"].items()] or ["- none"])]
    bad = failed_rows(result).join(result.select("row_index", "warnings"), "row_index").orderBy("row_index").collect()
    lines += ["", "## Failed rows", "", *([f"- {r.row_index} {r.generated_id} ({r['mode']}): {'; '.join(r.warnings) or 'overall score too low'}" for r in bad] or ["- none"])]
    return "\n".join(lines) + "\n"
