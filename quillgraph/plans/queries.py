"""The queries over the driver's tables, one for each operator, each with the DuckDB SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as t
from ..operators import combos, compare, crossdoc, entities, evaluate, generate, paths, prompts, sections
from ..sources.offline import OfflineClient

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, prelude: str | None = None):
    """Registers a query under its function's name, with its SQL after a prelude of common tables."""

    def put(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = (f"WITH {prelude} " if prelude else "") + sql.strip()
        return f

    return put


# Common tables, in both engines.


def corpus(spark: SparkSession, sf: str) -> DataFrame:
    """doc_id, source_index, title, text, source_sha256, raw_text, source of the documents with a text."""
    d = spark.read.parquet(f"{sf}/documents.parquet").where(F.col("text").isNotNull()).withColumn("_text", t.strip("text")).where("_text <> ''")
    index = F.col("doc_id").cast("long")
    return d.select(F.col("doc_id").cast("string").alias("doc_id"), index.alias("source_index"), F.col("source").alias("title"), F.col("_text").alias("text"), F.sha2(F.col("text").cast("binary"), 256).alias("source_sha256"), F.col("text").alias("raw_text"))


DOCS = r"""docs AS (SELECT CAST(doc_id AS VARCHAR) AS doc_id, CAST(doc_id AS BIGINT) AS source_index, source AS title, regexp_replace(text, '^\s+|\s+$', '', 'g') AS text, sha256(text) AS source_sha256, text AS raw_text
 FROM documents WHERE text IS NOT NULL AND regexp_replace(text, '^\s+|\s+$', '', 'g') <> '')"""
FOLD = "replace(lower({}), 'ß', 'ss')"
WORD = "[a-z0-9]+(?:''[a-z0-9]+)?"


def toks(x: str) -> str:
    return f"regexp_extract_all({FOLD.format(x)}, '{WORD}')"


def norm(x: str) -> str:
    return f"array_to_string({toks(x)}, ' ')"


TOK = DOCS + f""", tok AS MATERIALIZED (SELECT doc_id, source_index, {toks('text')} AS toks FROM docs),
 words AS (SELECT doc_id, unnest(toks) AS w, generate_subscripts(toks, 1) AS i FROM tok)"""
ENTS = TOK + """, firsts AS (SELECT doc_id, w, min(i) AS i FROM words WHERE length(w) >= 10 GROUP BY doc_id, w),
 ents AS MATERIALIZED (SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS pos, w AS key FROM firsts QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY i) <= 8),
 lists AS MATERIALIZED (SELECT doc_id, list(key ORDER BY pos) AS entities FROM ents GROUP BY doc_id)"""


def with_ents(spark: SparkSession, sf: str, docs: DataFrame | None = None) -> DataFrame:
    """corpus(), or docs of it, with entities, by the deterministic extractor."""
    d = corpus(spark, sf) if docs is None else docs
    # Through a generator, which the optimizer doesn't merge with filters and what else reads the entities: they are found once a row.
    return d.select("*", F.explode(F.array(entities.token_entities("text"))).alias("entities")).where(F.size("entities") > 0)


def sha(x: Column) -> Column:
    return F.sha1(x.cast("binary"))


def joined(c: str) -> Column:
    return F.array_join(c, "|")


# Scans and text functions.


@query("SELECT doc_id, source_index, CAST(length(text) AS BIGINT) AS n_chars_text, source_sha256 FROM docs", DOCS)
def scan_documents(spark, sf):
    return corpus(spark, sf).select("doc_id", "source_index", F.length("text").cast("long").alias("n_chars_text"), "source_sha256")


@query("SELECT doc_id, source_index FROM docs ORDER BY source_index LIMIT 100", DOCS)
def limit_docs(spark, sf):
    return corpus(spark, sf).select("doc_id", "source_index").orderBy("source_index").limit(100)


@query("SELECT source_index, sha1(CAST(source_index AS VARCHAR) || chr(31) || source_sha256) AS fallback_id FROM docs", DOCS)
def doc_identity(spark, sf):
    return corpus(spark, sf).select("source_index", t.stable_id("source_index", "source_sha256").alias("fallback_id"))


TITLE = DOCS + r""", lines AS (SELECT doc_id, source_index, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM docs),
 cleaned AS (SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(line, '^\s+|\s+$', '', 'g'), '^#{1,6}\s+', ''), '^[-*+]\s+', ''), '\s+', ' ', 'g'), E' \t\r\n-:;,.') AS c FROM lines),
 picked AS (SELECT doc_id, source_index, arg_min(c, i) AS c, arg_min(line, i) AS line FROM cleaned WHERE c <> '' GROUP BY ALL),
 cut AS (SELECT doc_id, CASE WHEN starts_with(ltrim(line), '#') THEN c ELSE coalesce(nullif(rtrim(coalesce(nullif(regexp_extract(c, '^(.*?[.!?])\s', 1), ''), c), ' .!?'), ''), c) END AS c FROM picked),
 heads AS (SELECT doc_id, c, substr(c, 1, 79) AS h, trim(regexp_replace(substr(c, 1, 79), ' [^ ]*$', '')) AS s FROM cut),
 titles AS (SELECT doc_id, CASE WHEN length(c) <= 80 THEN c ELSE rtrim(CASE WHEN length(s) < 20 THEN trim(h) ELSE s END, '.,;:') || '...' END AS title FROM heads)"""


@query("SELECT d.doc_id, coalesce(t.title, 'Untitled source ' || d.source_index) AS title FROM docs d LEFT JOIN titles t ON d.doc_id = t.doc_id", TITLE)
def infer_titles(spark, sf):
    return corpus(spark, sf).select("doc_id", t.infer_title("text", "source_index").alias("title"))


@query(r"SELECT doc_id, coalesce(nullif(rtrim(coalesce(nullif(regexp_extract(text, '(?s)^(.*?[.!?])\s', 1), ''), text), ' .!?'), ''), text) AS sentence FROM docs", DOCS)
def first_sentences(spark, sf):
    return corpus(spark, sf).select("doc_id", t.first_sentence("text").alias("sentence"))


CLIP = r"""SELECT doc_id, CASE WHEN length(text) <= {n} THEN text ELSE (CASE WHEN length(s) < {h} THEN regexp_replace(substr(text, 1, {m}), '^\s+|\s+$', '', 'g') ELSE s END) || '...' END AS {out} FROM
 (SELECT doc_id, text, regexp_replace(regexp_replace(substr(text, 1, {m}), '(?s) [^ ]*$', ''), '^\s+|\s+$', '', 'g') AS s FROM {of})"""


@query(CLIP.format(n=1800, m=1799, h=900, out="clipped", of="docs"), DOCS)
def truncate_sections(spark, sf):
    return corpus(spark, sf).select("doc_id", t.truncate_text("text", 1800).alias("clipped"))


@query("SELECT doc_id, CAST(len(toks) AS BIGINT) AS n_tokens, sha1(array_to_string(toks, ' ')) AS norm_sha1 FROM tok", TOK)
def tokenize(spark, sf):
    d = corpus(spark, sf).select("doc_id", t.tokens("text").alias("toks"))
    return d.select("doc_id", F.size("toks").cast("long").alias("n_tokens"), sha(F.array_join("toks", " ")).alias("norm_sha1"))


@query("""SELECT t.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_distinct_5grams FROM tok t LEFT JOIN
 (SELECT doc_id, count(DISTINCT g) AS n FROM (SELECT doc_id, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o || ' ' || lead(w, 4) OVER o AS g FROM words WINDOW o AS (PARTITION BY doc_id ORDER BY i)) WHERE g IS NOT NULL GROUP BY doc_id) USING (doc_id)""", TOK)
def token_5grams(spark, sf):
    d = corpus(spark, sf).select("doc_id", t.tokens("text").alias("toks"))
    return d.select("doc_id", F.size(t.ngrams("toks")).cast("long").alias("n_distinct_5grams"))


@query(r"SELECT doc_id, pos, regexp_replace(lower(trim(regexp_replace(' -' || upper(key) || '  ' || key || ';', '\s+', ' ', 'g'))), '^\W+|\W+$', '', 'g') AS key FROM ents", ENTS)
def entity_keys(spark, sf):
    rows = with_ents(spark, sf).select("doc_id", F.posexplode("entities").alias("pos", "e"))
    return rows.select("doc_id", "pos", t.entity_normal_key(F.concat(F.lit(" -"), F.upper("e"), F.lit("  "), "e", F.lit(";"))).alias("key"))


@query("SELECT doc_id, string_agg(key, '|' ORDER BY pos) AS entities FROM ents GROUP BY doc_id", ENTS)
def normalize_entities(spark, sf):
    """Decorated, doubled and too short entities go in; the clean ones come out."""
    rows = with_ents(spark, sf)
    messy = F.flatten(F.transform("entities", lambda e: F.array(F.concat(F.lit(" -"), e, F.lit("; ")), e, F.lit(" x."))))
    return rows.withColumn("_m", messy).select("doc_id", joined(t.normalized_entities("_m", 2)).alias("entities"))


PROPER = r"\b(?:[A-Z][a-z]+|[A-Z]{2,})(?:[ \t]+(?:[A-Z][a-z]+|[A-Z]{2,}))*\b"
#: RE2's borders of words know ASCII only. So letters and digits beyond it become underscores first, and other characters beyond it control characters.
PLAIN = r"regexp_replace(regexp_replace({}, '[^\x00-\x7F\p{{L}}\p{{N}}]', chr(1), 'g'), '[^\x00-\x7F]', '_', 'g')"
HEADS = "(" + ", ".join(f"'{w}'" for w in t.SECTION_WORDS) + ")"


@query(f"""SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY i) - 1 AS INTEGER) AS pos, phrase FROM
 (SELECT doc_id, unnest(l) AS phrase, generate_subscripts(l, 1) AS i FROM (SELECT doc_id, regexp_extract_all({PLAIN.format('text')}, '{PROPER}') AS l FROM docs))
 WHERE phrase NOT IN {HEADS} AND (contains(phrase, ' ') OR phrase IN ('LLM', 'CPT'))""", DOCS)
def proper_nouns(spark, sf):
    d = corpus(spark, sf).select("doc_id", t.proper_nouns("text").alias("p"))
    return d.select("doc_id", F.posexplode("p").alias("pos", "phrase"))


@query("SELECT doc_id, sha1('a' || chr(31) || doc_id || chr(31) || chr(31) || source_sha256) AS id FROM docs", DOCS)
def stable_ids(spark, sf):
    return corpus(spark, sf).select("doc_id", t.stable_id(F.lit("a"), "doc_id", F.lit(None), "source_sha256").alias("id"))


# The entity cache and selection.

CACHE = DOCS + """, cache AS (SELECT doc_id, 1 AS line, 'old' AS version, CASE WHEN source_index % 7 = 0 THEN 'x' ELSE source_sha256 END AS sha, CASE WHEN source_index % 11 = 0 THEN 'failed' END AS error FROM docs WHERE source_index % 3 <> 0
 UNION ALL SELECT doc_id, 2, 'new', source_sha256, NULL FROM docs WHERE source_index % 2 = 0 AND source_index % 3 <> 0)"""


def cache_rows(spark, sf) -> DataFrame:
    d = corpus(spark, sf).where("source_index % 3 <> 0")
    old = d.select("doc_id", F.lit(1).alias("line"), F.lit("old").alias("version"), F.when(F.col("source_index") % 7 == 0, "x").otherwise(F.col("source_sha256")).alias("source_sha256"), F.when(F.col("source_index") % 11 == 0, "failed").alias("error"))
    new = d.where("source_index % 2 = 0").select("doc_id", F.lit(2).alias("line"), F.lit("new").alias("version"), "source_sha256", F.lit(None).cast("string").alias("error"))
    return old.union(new)


def latest_cache(spark, sf) -> DataFrame:
    from ..sources.jsonl import latest

    return latest(cache_rows(spark, sf), "line")


@query("SELECT doc_id, arg_max(version, line) AS version FROM cache GROUP BY doc_id", CACHE)
def latest_entity_cache(spark, sf):
    return latest_cache(spark, sf).select("doc_id", "version")


@query("""SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing' WHEN l.sha <> d.source_sha256 THEN 'changed' ELSE 'failed' END AS reason FROM docs d LEFT JOIN
 (SELECT * FROM cache QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY line DESC) = 1) l ON l.doc_id = d.doc_id WHERE l.doc_id IS NULL OR l.sha <> d.source_sha256 OR l.error IS NOT NULL""", CACHE)
def stale_entities(spark, sf):
    return entities.stale(corpus(spark, sf), latest_cache(spark, sf))


@query("SELECT doc_id, CAST(len(entities) AS BIGINT) AS n_entities, array_to_string(entities, '|') AS entities_joined FROM lists JOIN docs USING (doc_id) WHERE source_index % 11 <> 0", ENTS)
def doc_entities(spark, sf):
    d = corpus(spark, sf)
    records = d.select("doc_id", entities.token_entities("text").alias("entities"), F.when(F.col("source_index") % 11 == 0, "failed").alias("error"))
    return entities.with_entities(d, records).select("doc_id", F.size("entities").cast("long").alias("n_entities"), joined("entities").alias("entities_joined"))


@query("SELECT doc_id, 'Title: ' || title AS summary, coalesce(array_to_string(entities, '|'), '') AS entities_joined FROM docs LEFT JOIN lists USING (doc_id)", ENTS)
def extract_entities(spark, sf):
    """Through the chat operator, with the client that needs no model."""
    rows = generate.extracted(corpus(spark, sf), OfflineClient)
    return rows.select("doc_id", "summary", joined("entities").alias("entities_joined"))


@query("SELECT key, count(DISTINCT doc_id) AS df FROM ents GROUP BY key", ENTS)
def entity_doc_frequency(spark, sf):
    return entities.document_frequency(with_ents(spark, sf))


@query("SELECT CAST(count(*) AS BIGINT) AS extracted_total, CAST(count(*) FILTER (pos < 4) AS BIGINT) AS selected_total FROM ents", ENTS)
def entity_totals(spark, sf):
    d = with_ents(spark, sf)
    chosen = entities.select_entities(d, d, 4, "llm-order").select("doc_id", F.size("entities").alias("n"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("long")
    return d.select("doc_id", F.size("entities").alias("m")).join(chosen, "doc_id").agg(total("m").alias("extracted_total"), total("n").alias("selected_total"))


# A whole word between characters that aren't word characters: each of these gets spaces around it, and an entity counts between spaces.
SPACED = r"' ' || regexp_replace(lower({}), '([^\p{{L}}\p{{N}}_])', ' \1 ', 'g') || ' '"
SCORES = ENTS + f""", total AS (SELECT count(*) AS n FROM lists),
 dfs AS (SELECT key, count(DISTINCT doc_id) AS df FROM ents GROUP BY key),
 spaced AS MATERIALIZED (SELECT doc_id, {SPACED.format('text')} AS s, {FOLD.format('text')} AS t FROM docs),
 raw AS MATERIALIZED (SELECT e.doc_id, e.pos, e.key, (length(d.s) - length(replace(d.s, {SPACED.format('e.key')}, ''))) // length({SPACED.format('e.key')}) AS m, instr(d.t, e.key) - 1 AS first, length(d.t) AS n_chars, f.df, t.n
  FROM ents e JOIN spaced d USING (doc_id) JOIN dfs f USING (key) CROSS JOIN total t),
 parts AS MATERIALIZED (SELECT *, 0.7::DOUBLE * (CASE WHEN m > 0 THEN least(1.0::DOUBLE, ln(1 + m::DOUBLE) / ln(6::DOUBLE)) ELSE 0 END) + 0.2::DOUBLE * (CASE WHEN m > 0 AND first >= 0 THEN 1.0::DOUBLE - least(1.0::DOUBLE, first::DOUBLE / greatest(1, n_chars)::DOUBLE) ELSE 0 END) + 0.1::DOUBLE / (1.0::DOUBLE + pos) AS imp, ln((n + 1)::DOUBLE / greatest(1, df)::DOUBLE) / ln((n + 1)::DOUBLE) AS rar FROM raw)"""


@query("SELECT doc_id, pos, key, CAST(m AS INTEGER) AS mentions FROM parts", SCORES)
def entity_mentions(spark, sf):
    rows = with_ents(spark, sf).select("doc_id", "text", F.posexplode("entities").alias("pos", "key"))
    return rows.select("doc_id", "pos", "key", t.mentions("key", "text").alias("mentions"))


def six(x: Column) -> Column:
    return F.floor(x * 1e6 + 0.5).cast("long")


def score_query(strategy: str):
    def f(spark, sf):
        d = with_ents(spark, sf)
        rows = entities.scored(d, d, strategy)
        return rows.select("doc_id", "pos", "key", six(F.col("score")).alias("score"))

    return f


QUERIES["entity_importance"] = score_query("importance")
ORACLES["entity_importance"] = f"WITH {SCORES} SELECT doc_id, pos, key, CAST(floor(imp * 1e6 + 0.5) AS BIGINT) AS score FROM parts"
QUERIES["entity_rarity"] = score_query("rarity")
ORACLES["entity_rarity"] = f"WITH {SCORES} SELECT doc_id, pos, key, CAST(floor(rar * 1e6 + 0.5) AS BIGINT) AS score FROM parts"


def select_query(strategy: str):
    def f(spark, sf):
        d = with_ents(spark, sf)
        d = d.withColumn("_all", F.col("entities"))
        chosen = entities.select_entities(d, d, 4, strategy, 6).select("doc_id", F.col("entities").alias("_chosen"), F.posexplode_outer("_all").alias("pos", "key"))
        return chosen.where(F.array_contains("_chosen", F.col("key"))).select("doc_id", "pos", "key")

    return f


for _name, _score in {"llm_order": "-pos", "importance": "floor(imp * 1e6 + 0.5)", "rarity": "floor(rar * 1e6 + 0.5)", "hybrid": "floor((0.65::DOUBLE * imp + 0.35::DOUBLE * rar) * 1e6 + 0.5)"}.items():
    QUERIES[f"select_entities_{_name}"] = select_query(_name.replace("_", "-"))
    ORACLES[f"select_entities_{_name}"] = f"""WITH {SCORES}
 SELECT doc_id, pos, key FROM parts QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY {_score} DESC, pos) <= 4"""


# Combinations within a document.

PAIRS = "SELECT a.doc_id, CAST(row_number() OVER (PARTITION BY a.doc_id ORDER BY a.pos, b.pos) - 1 AS INTEGER) AS combo_ord, a.key AS e1, b.key AS e2 FROM ents a JOIN ents b ON a.doc_id = b.doc_id AND a.pos < b.pos"


@query(PAIRS, ENTS)
def entity_pairs(spark, sf):
    rows = combos.entity_combos(with_ents(spark, sf).select("doc_id", "entities"), (2,))
    return rows.select("doc_id", "combo_ord", F.col("entities")[0].alias("e1"), F.col("entities")[1].alias("e2"))


@query("SELECT a.doc_id, CAST(row_number() OVER (PARTITION BY a.doc_id ORDER BY a.pos, b.pos, c.pos) - 1 AS INTEGER) AS combo_ord, a.key AS e1, b.key AS e2, c.key AS e3 FROM ents a JOIN ents b ON a.doc_id = b.doc_id AND a.pos < b.pos JOIN ents c ON a.doc_id = c.doc_id AND b.pos < c.pos", ENTS)
def entity_triples(spark, sf):
    rows = combos.entity_combos(with_ents(spark, sf).select("doc_id", "entities"), (3,))
    return rows.select("doc_id", "combo_ord", *[F.col("entities")[i].alias(f"e{i + 1}") for i in range(3)])


@query(f"SELECT doc_id, combo_ord, e1 || '|' || e2 AS combo FROM ({PAIRS}) WHERE combo_ord < 5", ENTS)
def combos_limited(spark, sf):
    return combos.entity_combos(with_ents(spark, sf).select("doc_id", "entities"), (2,), 5).select("doc_id", "combo_ord", joined("entities").alias("combo"))


@query(f"SELECT doc_id, combo_ord, e1 || '|' || e2 AS combo FROM ({PAIRS}) QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY md5('7|' || doc_id || '|' || e1 || '|' || e2)) <= 5", ENTS)
def combos_sampled(spark, sf):
    return combos.entity_combos(with_ents(spark, sf).select("doc_id", "entities"), (2,), 5, True, 7).select("doc_id", "combo_ord", joined("entities").alias("combo"))


@query("SELECT CAST(sum(least(n * (n - 1) // 2 + n * (n - 1) * (n - 2) // 6, 50)) AS BIGINT) AS total FROM (SELECT count(*) AS n FROM ents GROUP BY doc_id)", ENTS)
def count_relation_tasks(spark, sf):
    return combos.count_relation_tasks(with_ents(spark, sf), (2, 3), 50)


REL = ENTS + f""", pairs AS ({PAIRS}), rel AS MATERIALIZED (SELECT sha1('single-doc' || chr(31) || doc_id || chr(31) || source_sha256 || chr(31) || '2' || chr(31) || e1 || '|' || e2) AS relation_id, doc_id, e1, e2, title, text FROM pairs JOIN docs USING (doc_id))"""


def relations(spark, sf) -> DataFrame:
    return combos.relation_tasks(with_ents(spark, sf), (2,))


@query("SELECT relation_id, doc_id, e1 || '|' || e2 AS combo FROM rel", REL)
def relation_tasks(spark, sf):
    return relations(spark, sf).select("relation_id", "doc_id", joined("entities").alias("combo"))


@query("SELECT relation_id, sha1('Title: ' || title || E'\\n\\nDocument:\\n' || text || E'\\n\\nEntities:\\n- ' || e1 || E'\\n- ' || e2) AS prompt_sha1 FROM rel", REL)
def relation_prompts(spark, sf):
    return relations(spark, sf).select("relation_id", sha(prompts.relation_prompt("title", "text", "entities")).alias("prompt_sha1"))


@query("SELECT relation_id AS key FROM rel WHERE relation_id < '8' AND substr(relation_id, 1, 1) <> '0'", REL)
def completed_keys(spark, sf):
    done = relations(spark, sf).select("relation_id", F.when(F.startswith("relation_id", F.lit("0")), "failed").alias("error")).where("relation_id < '8'")
    return done.where("error is null").select(F.col("relation_id").alias("key")).distinct()


@query("SELECT relation_id FROM rel WHERE relation_id >= '8' OR substr(relation_id, 1, 1) = '0'", REL)
def resume_anti_join(spark, sf):
    return generate.without_done(relations(spark, sf).select("relation_id"), completed_keys(spark, sf), "relation_id")


# Pairs of documents.

CROSS = ENTS + """, shared AS MATERIALIZED (SELECT a.doc_id AS doc_a, b.doc_id AS doc_b, count(*) AS n_shared, list(a.key ORDER BY a.key)[1:12] AS keys FROM ents a JOIN ents b ON a.key = b.key AND a.doc_id < b.doc_id GROUP BY ALL)"""
GRAPH = CROSS + """, graph AS MATERIALIZED (SELECT doc_a, doc_b, CAST(n_shared AS INTEGER) AS n_shared, array_to_string(keys, '|') AS shared, sha1('cross-doc' || chr(31) || doc_a || chr(31) || a.source_sha256 || chr(31) || doc_b || chr(31) || b.source_sha256 || chr(31) || array_to_string(keys, '|')) AS graph_id, keys, a.title AS ta, a.text AS xa, b.title AS tb, b.text AS xb FROM shared JOIN docs a ON a.doc_id = doc_a JOIN docs b ON b.doc_id = doc_b)"""


@query("SELECT doc_a, doc_b, CAST(n_shared AS INTEGER) AS n_shared, array_to_string(keys, '|') AS shared FROM shared", CROSS)
def cross_doc_pairs(spark, sf):
    return crossdoc.cross_doc_pairs(with_ents(spark, sf)).select("doc_a", "doc_b", "n_shared", joined("shared").alias("shared"))


@query("SELECT doc_a, doc_b, n_shared, shared, graph_id FROM graph", GRAPH)
def cross_doc_tasks(spark, sf):
    d = with_ents(spark, sf).drop("text", "raw_text")
    return crossdoc.cross_doc_tasks(d, d).select("doc_a", "doc_b", "n_shared", joined("shared").alias("shared"), "graph_id")


@query("SELECT * FROM (SELECT doc_a, doc_b, n_shared, CAST(row_number() OVER (ORDER BY doc_a, doc_b) AS INTEGER) AS rn FROM graph) WHERE rn <= 100", GRAPH)
def cross_doc_topk(spark, sf):
    from pyspark.sql import Window

    d = with_ents(spark, sf)
    top = crossdoc.cross_doc_tasks(d, d, max_pairs=100).select("doc_a", "doc_b", "n_shared")
    return top.withColumn("rn", F.row_number().over(Window.orderBy("doc_a", "doc_b")))


@query("SELECT graph_id, sha1('Article A Title: ' || ta || E'\\n\\nArticle A:\\n' || xa || E'\\n\\nArticle B Title: ' || tb || E'\\n\\nArticle B:\\n' || xb || E'\\n\\nShared entities:\\n- ' || array_to_string(keys, E'\\n- ')) AS prompt_sha1 FROM graph", GRAPH)
def cross_doc_prompts(spark, sf):
    d = with_ents(spark, sf)
    rows = crossdoc.cross_doc_tasks(d, d)
    return rows.select("graph_id", sha(prompts.cross_prompt("a.title", "a.text", "b.title", "b.text", "shared")).alias("prompt_sha1"))


# Sections and the graph of sections. The corpus has no blank lines, so its line ends are doubled to make paragraphs.


def paragraphed(spark, sf, docs: DataFrame | None = None) -> DataFrame:
    return with_ents(spark, sf, docs).withColumn("text", F.replace("text", F.lit("\n"), F.lit("\n\n")))


SENTENCE = r"coalesce(nullif(trim(coalesce(nullif(regexp_extract({0}, '^(.*?[.!?])\s', 1), ''), {0}), ' .!?'), ''), title)"
SECT = ENTS + rf""", md AS (SELECT d.*, l.entities, list_filter(list_transform(regexp_split_to_array(replace(d.text, chr(10), chr(10) || chr(10)), '\n\s*\n'), lambda x: regexp_replace(x, '^\s+|\s+$', '', 'g')), lambda x: x <> '') AS paras FROM docs d JOIN lists l USING (doc_id)),
 sect0 AS (SELECT doc_id, source_index, source_sha256, title, entities, unnest(paras) AS body, generate_subscripts(paras, 1) - 1 AS spos FROM md),
 sect1 AS (SELECT *, trim(regexp_replace(body, '\s+', ' ', 'g')) AS flat FROM sect0),
 sect AS MATERIALIZED (SELECT doc_id || '#s' || spos AS section_id, doc_id, source_index, source_sha256, title, entities, body, spos, {SENTENCE.format('flat')} AS section_title, {FOLD.format('flat')} AS key FROM sect1),
 cutsect AS ({CLIP.format(n=1800, m=1799, h=900, out='text', of='(SELECT section_id AS doc_id, body AS text FROM sect)')}),
 nodes AS MATERIALIZED (SELECT s.section_id, s.doc_id, s.source_index, s.source_sha256, s.title, s.section_title, c.text, list_filter(s.entities, lambda e: contains(s.key, e)) AS entities, s.spos FROM sect s JOIN cutsect c ON c.doc_id = s.section_id WHERE len(list_filter(s.entities, lambda e: contains(s.key, e))) > 0),
 skeys AS MATERIALIZED (SELECT section_id, doc_id, unnest(entities) AS key FROM nodes),
 edges AS MATERIALIZED (SELECT DISTINCT a.section_id AS src, b.section_id AS dst, a.doc_id AS src_doc, b.doc_id AS dst_doc FROM skeys a JOIN skeys b ON a.key = b.key AND a.section_id <> b.section_id)"""


def nodes_of(spark, sf) -> DataFrame:
    return sections.section_nodes(paragraphed(spark, sf))


@query("SELECT section_id, section_title AS title, CAST(length(body) AS BIGINT) AS n_chars FROM sect", SECT)
def markdown_sections(spark, sf):
    rows = paragraphed(spark, sf).withColumn("_s", sections.section_array("text", "title"))
    rows = rows.select("doc_id", F.posexplode("_s").alias("pos", "s"))
    return rows.select(F.concat("doc_id", F.lit("#s"), F.col("pos").cast("string")).alias("section_id"), F.col("s.title").alias("title"), F.length("s.body").cast("long").alias("n_chars"))


HEADED = DOCS + r""", pieces AS (SELECT doc_id, source, regexp_replace(text, '^\s+|\s+$', '', 'g') AS body FROM (SELECT doc_id, title AS source, replace(text, chr(10), ' ') AS text FROM docs))"""


@query("SELECT doc_id || '#s' || 0 AS section_id, 'Head ' || source AS title, CAST(length('Head ' || source || chr(10) || body) AS BIGINT) AS n_chars FROM pieces UNION ALL SELECT doc_id || '#s' || 1, 'Tail', 9 FROM pieces", HEADED)
def heading_sections(spark, sf):
    """A heading with a body, one without (which is no section), and a last one."""
    d = corpus(spark, sf).withColumn("text", F.concat(F.lit("## Head "), "title", F.lit(":\n\n"), F.replace("text", F.lit("\n"), F.lit(" ")), F.lit("\n\n# Empty\n### Tail  \nlast")))
    rows = d.withColumn("_s", sections.section_array("text", "title")).select("doc_id", F.posexplode("_s").alias("pos", "s"))
    return rows.select(F.concat("doc_id", F.lit("#s"), F.col("pos").cast("string")).alias("section_id"), F.col("s.title").alias("title"), F.length("s.body").cast("long").alias("n_chars"))


@query("SELECT section_id, section_title AS title, CAST(length(text) AS BIGINT) AS n_chars, array_to_string(entities, '|') AS entities FROM nodes", SECT)
def section_nodes(spark, sf):
    return nodes_of(spark, sf).select("section_id", F.col("section_title").alias("title"), F.length("text").cast("long").alias("n_chars"), joined("entities").alias("entities"))


@query("SELECT src, dst FROM edges", SECT)
def section_edges(spark, sf):
    return sections.section_edges(nodes_of(spark, sf)).select("src", "dst")


DEGREES = SECT + """, deg AS (SELECT src, count(*) AS n FROM edges GROUP BY src),
 two AS (SELECT e.src AS s1, e.src_doc AS d1, e.dst AS s2, e.dst_doc AS d2 FROM edges e JOIN deg g ON g.src = e.src WHERE NOT (e.src_doc = e.dst_doc AND g.n > 1))"""
THREE = DEGREES + """, three AS (SELECT t.*, e.dst AS s3, e.dst_doc AS d3 FROM two t JOIN edges e ON e.src = t.s2 JOIN deg g ON g.src = t.s2 WHERE e.dst <> t.s1 AND NOT (t.d1 = t.d2 AND e.dst_doc = t.d1 AND g.n > 1)),
 cand AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY s1, d2, s2, d3, s3) AS ord FROM three QUALIFY ord <= 8000)"""


def nodes_edges(spark, sf) -> tuple[DataFrame, None]:
    """Nodes, and no edges: paths with a limit read none."""
    return nodes_of(spark, sf), None


def ordered_paths(found: DataFrame) -> DataFrame:
    from pyspark.sql import Window

    return found.select(joined("path").alias("path"), F.row_number().over(Window.orderBy("order")).alias("path_ord"))


@query("SELECT s1 || '|' || s2 AS path, CAST(row_number() OVER (ORDER BY s1, d2, s2) AS INTEGER) AS path_ord FROM two QUALIFY path_ord <= 1000", DEGREES)
def graph_paths_len2(spark, sf):
    return ordered_paths(paths.sampled(*nodes_edges(spark, sf), length=2, most=1000, ranked=False))


@query("SELECT s1 || '|' || s2 || '|' || s3 AS path, CAST(ord AS INTEGER) AS path_ord FROM cand", THREE)
def graph_paths_len3(spark, sf):
    return ordered_paths(paths.sampled(*nodes_edges(spark, sf), length=3, most=1000, multiplier=8))


@query("SELECT section_id AS path, CAST(row_number() OVER (ORDER BY source_index, spos) AS INTEGER) AS path_ord FROM nodes QUALIFY path_ord <= 1000", SECT)
def paths_len1(spark, sf):
    return ordered_paths(paths.sampled(*nodes_edges(spark, sf), length=1, most=1000))


@query("SELECT CAST(ord AS INTEGER) AS rank, s1 || '|' || s2 || '|' || s3 AS path FROM cand WHERE ord <= 1000", THREE)
def paths_dfs(spark, sf):
    nodes, edges = nodes_edges(spark, sf)
    return ordered_paths(paths.sampled(nodes, edges, 3, 1000, ranked=False)).select(F.col("path_ord").alias("rank"), "path")


# Entities of a path: keys in order of first occurrence; the corpus's keys are their own surfaces.
DESCRIBED = THREE + """, spread AS (SELECT ord, s, k, unnest(n.entities) AS key, generate_subscripts(n.entities, 1) AS j FROM (SELECT ord, unnest([s1, s2, s3]) AS s, unnest([1, 2, 3]) AS k FROM cand) c JOIN nodes n ON n.section_id = c.s),
 pkeys AS (SELECT ord, key, min(k * 100 + j) AS place, count(*) AS n FROM spread GROUP BY ord, key),
 plists AS (SELECT ord, list(key ORDER BY place) AS entities, coalesce(list(key ORDER BY place) FILTER (n > 1), []) AS shared FROM pkeys GROUP BY ord),
 metrics AS MATERIALIZED (SELECT c.*, p.entities, p.shared, len(list_distinct([d1, d2, d3])) AS nd, len(p.entities) AS ne, len(p.shared) AS ns, (CASE WHEN d1 <> d2 THEN 1 ELSE 0 END + CASE WHEN d2 <> d3 THEN 1 ELSE 0 END) AS nx FROM cand c JOIN plists p USING (ord)),
 scored AS MATERIALIZED (SELECT *, ns::DOUBLE * 3.0::DOUBLE + nd::DOUBLE * 1.5::DOUBLE + least(ne, 12)::DOUBLE * 0.25::DOUBLE + nx::DOUBLE * 0.75::DOUBLE AS bridge, nd::DOUBLE * 3.0::DOUBLE + ne::DOUBLE * 0.7::DOUBLE + ns::DOUBLE * 1.5::DOUBLE + 3::DOUBLE * 0.25::DOUBLE AS coverage FROM metrics),
 best AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY bridge DESC, s1, s2, s3) AS rank FROM scored QUALIFY rank <= 1000)"""


def best_paths(spark, sf, strategy: str = "bridge") -> DataFrame:
    nodes, edges = nodes_edges(spark, sf)
    found = paths.sampled(nodes, edges, 3, 1000, 8)
    chosen = sections.section_nodes(paragraphed(spark, sf, paths.documents_of(corpus(spark, sf), found)))
    return paths.ranked(paths.described(found, chosen), strategy, 1000)


@query("SELECT CAST(rank AS INTEGER) AS rank, s1 || '|' || s2 || '|' || s3 AS path, bridge AS score FROM best", DESCRIBED)
def paths_bridge(spark, sf):
    return best_paths(spark, sf).select(F.col("path_ord").alias("rank"), joined("section_ids").alias("path"), F.col("bridge").alias("score"))


@query("SELECT CAST(row_number() OVER (ORDER BY coverage DESC, s1, s2, s3) AS INTEGER) AS rank, s1 || '|' || s2 || '|' || s3 AS path, coverage AS score FROM scored QUALIFY rank <= 1000", DESCRIBED)
def paths_coverage(spark, sf):
    return best_paths(spark, sf, "coverage").select(F.col("path_ord").alias("rank"), joined("section_ids").alias("path"), F.col("coverage").alias("score"))


@query("SELECT s1 || '|' || s2 || '|' || s3 AS path, array_to_string(entities, '|') AS entities FROM best", DESCRIBED)
def path_entities(spark, sf):
    return best_paths(spark, sf).select(joined("section_ids").alias("path"), joined("entities").alias("entities"))


@query("SELECT s1 || '|' || s2 || '|' || s3 AS path, array_to_string(shared, '|') AS shared FROM best", DESCRIBED)
def path_shared(spark, sf):
    return best_paths(spark, sf).select(joined("section_ids").alias("path"), joined("shared").alias("shared"))


@query("SELECT s1 || '|' || s2 || '|' || s3 AS path, 3 AS section_count, CAST(nd AS INTEGER) AS doc_count, CAST(ne AS INTEGER) AS entity_count, CAST(ns AS INTEGER) AS shared_count, CAST(nx AS INTEGER) AS crossings, bridge, coverage FROM best", DESCRIBED)
def path_metrics(spark, sf):
    return best_paths(spark, sf).select(joined("section_ids").alias("path"), "section_count", "doc_count", "entity_count", "shared_count", "crossings", "bridge", "coverage")


@query("SELECT s1 || '|' || s2 || '|' || s3 AS path FROM best WHERE ns >= 3", DESCRIBED)
def path_min_shared(spark, sf):
    return paths.path_tasks(best_paths(spark, sf), 3).select(joined("section_ids").alias("path"))


CHUNK = "'[{i}] Document: ' || {n}.title || E'\\nSection: ' || {n}.section_title || E'\\nText:\\n' || {n}.text"
PTASK = DESCRIBED + """, base AS MATERIALIZED (SELECT b.*, sha1(array_to_string(['sog-lite', s1 || ':' || a.source_sha256, s2 || ':' || c.source_sha256, s3 || ':' || d.source_sha256, array_to_string(b.entities, '|')], chr(31))) AS base_id,
   """ + " || E'\\n' || ".join(CHUNK.format(i=i + 1, n=n) for i, n in enumerate("acd")) + """ AS block,
   """ + " || E'\\n\\n' || ".join(f"'[{i + 1}] ' || {n}.title || ' / ' || {n}.section_title || E'\\n' || {n}.text" for i, n in enumerate("acd")) + """ AS context, length(a.text) + length(c.text) + length(d.text) AS n_chars
  FROM best b JOIN nodes a ON a.section_id = s1 JOIN nodes c ON c.section_id = s2 JOIN nodes d ON d.section_id = s3),
 styled AS MATERIALIZED (SELECT b.*, style, style_ord, CASE WHEN style = 'default' THEN base_id ELSE sha1('sog-lite' || chr(31) || base_id || chr(31) || style) END AS path_id FROM base b CROSS JOIN (VALUES ('default', 0), ('contrastive', 1)) s(style, style_ord) WHERE ns >= 1)"""
STYLED = ("default", "contrastive")


def path_task_rows(spark, sf) -> DataFrame:
    return paths.path_tasks(best_paths(spark, sf), 1, STYLED)


@query("SELECT path_id, s1 || '|' || s2 || '|' || s3 AS path, style FROM styled", PTASK)
def path_styles(spark, sf):
    return path_task_rows(spark, sf).select("path_id", joined("section_ids").alias("path"), "style")


SUFFIX = "CASE WHEN style = 'contrastive' THEN E'\\n\\n" + prompts.STYLES["contrastive"] + "' ELSE '' END"


@query(f"SELECT path_id, sha1(E'Source chunks:\\n\\n' || block || E'\\n\\nPath entities:\\n- ' || array_to_string(entities, E'\\n- ') || {SUFFIX}) AS prompt_sha1 FROM styled", PTASK)
def path_prompts(spark, sf):
    return path_task_rows(spark, sf).select("path_id", sha(prompts.path_prompt("chunks", "entities", "style")).alias("prompt_sha1"))


GROUPS = PTASK + """, numbered AS (SELECT *, row_number() OVER (ORDER BY rank) - 1 AS no FROM base WHERE ns >= 1),
 grouped AS (SELECT *, no // 3 AS group_no, count(*) OVER (PARTITION BY no // 3) AS whole, sum(n_chars) OVER (PARTITION BY no // 3 ORDER BY no) AS so_far FROM numbered),
 kept AS MATERIALIZED (SELECT * FROM grouped WHERE whole = 3 AND (no % 3 = 0 OR so_far <= 6000)),
 lc AS (SELECT CAST(group_no AS INTEGER) AS group_no, style, CAST(count(*) AS INTEGER) AS path_count, array_to_string(list(CASE WHEN style = 'default' THEN base_id ELSE sha1('sog-lite' || chr(31) || base_id || chr(31) || style) END ORDER BY no), '|') AS ids FROM kept CROSS JOIN (VALUES ('default'), ('contrastive')) s(style) GROUP BY ALL)"""


@query("SELECT group_no, style, sha1('long-context' || chr(31) || ids || CASE WHEN style = 'default' THEN '' ELSE chr(31) || style END) AS long_context_id, path_count FROM lc", GROUPS)
def long_context_groups(spark, sf):
    rows = paths.long_context_tasks(best_paths(spark, sf), 3, 6000, STYLED)
    return rows.select("group_no", "style", "long_context_id", F.size("paths").alias("path_count"))


@query("SELECT CAST(group_no AS INTEGER) AS group_no, string_agg(s1 || '|' || s2 || '|' || s3, ' ; ' ORDER BY no) AS kept FROM kept GROUP BY group_no", GROUPS)
def long_context_trim(spark, sf):
    rows = paths.long_context_tasks(best_paths(spark, sf), 3, 6000)
    return rows.select("group_no", F.array_join(F.transform("paths", lambda p: F.array_join(p["section_ids"], "|")), " ; ").alias("kept"))


@query("SELECT sha1('longfaith-qa' || chr(31) || path_id) AS qa_id, path_id FROM styled", PTASK)
def qa_tasks(spark, sf):
    return paths.qa_tasks(path_task_rows(spark, sf)).select("qa_id", "path_id")


@query("SELECT sha1('longfaith-qa' || chr(31) || path_id) AS qa_id, array_to_string((CASE WHEN ns > 0 THEN shared ELSE entities END)[1:3], '|') AS targets FROM styled", PTASK)
def qa_targets(spark, sf):
    return paths.qa_tasks(path_task_rows(spark, sf)).select("qa_id", joined("target_entities").alias("targets"))


@query("SELECT s1 || '|' || s2 || '|' || s3 AS path, sha1(context) AS context_sha1 FROM base", PTASK)
def cited_context(spark, sf):
    return best_paths(spark, sf).select(joined("section_ids").alias("path"), sha(prompts.cited_context("chunks")).alias("context_sha1"))


ANSWERS = DOCS + """, answers AS (SELECT doc_id, source_index % 4 AS kind, 'Why ' || doc_id || '?' AS question, '{"question": "Why ' || doc_id || '?", "answer": "a", "reasoning": "[1] [2]", "support_ids": ["1", "2"]}' AS body FROM docs)"""


@query("SELECT doc_id, kind <> 3 AS ok, CASE WHEN kind <> 3 THEN question END AS question FROM answers", ANSWERS)
def parse_responses(spark, sf):
    """Answers in a fence, bare, after other words, and broken."""
    d = corpus(spark, sf).select("doc_id", (F.col("source_index") % 4).alias("kind"))
    body = F.concat(F.lit('{"question": "Why '), "doc_id", F.lit('?", "answer": "a", "reasoning": "[1] [2]", "support_ids": ["1", "2"]}'))
    raw = F.when(F.col("kind") == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).when(F.col("kind") == 1, body).when(F.col("kind") == 2, F.concat(F.lit("Sure: "), body, F.lit(" done"))).otherwise(F.concat(F.lit("{broken "), body))
    found = generate.parsed_qa(d.select(F.col("doc_id").alias("key"), raw.alias("answer"), F.lit(None).cast("string").alias("failure")))
    return found.select(F.col("key").alias("doc_id"), F.col("failure").isNull().alias("ok"), F.when(F.col("failure").isNull(), F.col("question")).alias("question"))


@query(f"""SELECT 'single_doc' AS mode, sha1('single-doc' || chr(31) || doc_id || chr(31) || source_sha256 || chr(31) || '2' || chr(31) || e1 || '|' || e2) AS id FROM ({PAIRS}) JOIN docs USING (doc_id)
 UNION ALL SELECT 'cross_doc', sha1('cross-doc' || chr(31) || doc_a || chr(31) || a.source_sha256 || chr(31) || doc_b || chr(31) || b.source_sha256 || chr(31) || array_to_string(keys, '|')) FROM (SELECT a.doc_id AS doc_a, b.doc_id AS doc_b, list(a.key ORDER BY a.key)[1:12] AS keys FROM ents a JOIN ents b ON a.key = b.key AND a.doc_id < b.doc_id GROUP BY ALL) JOIN docs a ON a.doc_id = doc_a JOIN docs b ON b.doc_id = doc_b
 UNION ALL SELECT 'sog_lite', path_id FROM styled UNION ALL SELECT 'long_context', sha1('long-context' || chr(31) || ids || CASE WHEN style = 'default' THEN '' ELSE chr(31) || style END) FROM lc
 UNION ALL SELECT 'longfaith_qa', sha1('longfaith-qa' || chr(31) || path_id) FROM styled""", GROUPS)
def all_modes_tasks(spark, sf):
    # Ids need no texts, so entities are found once and kept without them.
    d = with_ents(spark, sf).drop("text", "raw_text").persist()
    found = best_paths(spark, sf).persist()
    tasks = paths.path_tasks(found, 1, STYLED)
    parts = {"single_doc": combos.relation_tasks(d, (2,)).select(F.col("relation_id").alias("id")), "cross_doc": crossdoc.cross_doc_tasks(d, d).select(F.col("graph_id").alias("id")), "sog_lite": tasks.select(F.col("path_id").alias("id")), "long_context": paths.long_context_tasks(found, 3, 6000, STYLED).select(F.col("long_context_id").alias("id")), "longfaith_qa": paths.qa_tasks(tasks).select(F.col("qa_id").alias("id"))}
    out = None
    for mode, rows in parts.items():
        rows = rows.select(F.lit(mode).alias("mode"), "id")
        out = rows if out is None else out.unionByName(rows)
    return out


# Calls of the chat operator.


def answered(tasks: DataFrame, key: str, system: str, prompt: Column) -> DataFrame:
    rows = tasks.select(F.col(key).alias("key"), F.lit(system).alias("system"), prompt.alias("prompt"))
    return generate.with_answers(rows, OfflineClient).select(F.col("key").alias("id"), F.col("answer").alias("text"))


@query("SELECT relation_id AS id, 'Echo: Title: ' || title AS text FROM rel", REL)
def generate_single_doc(spark, sf):
    return answered(relations(spark, sf), "relation_id", prompts.PAIR, prompts.relation_prompt("title", "text", "entities"))


@query("SELECT graph_id AS id, 'Echo: Article A Title: ' || ta AS text FROM graph", GRAPH)
def generate_cross_doc(spark, sf):
    d = with_ents(spark, sf)
    return answered(crossdoc.cross_doc_tasks(d, d), "graph_id", prompts.CROSS, prompts.cross_prompt("a.title", "a.text", "b.title", "b.text", "shared"))


@query("SELECT path_id AS id, 'Echo: Source chunks:' AS text FROM styled", PTASK)
def generate_sog_lite(spark, sf):
    return answered(path_task_rows(spark, sf), "path_id", prompts.PATH, prompts.path_prompt("chunks", "entities", "style"))


@query("SELECT sha1('long-context' || chr(31) || ids || CASE WHEN style = 'default' THEN '' ELSE chr(31) || style END) AS id, 'Echo: Connected graph paths:' AS text FROM lc", GROUPS)
def generate_long_context(spark, sf):
    rows = paths.long_context_tasks(best_paths(spark, sf), 3, 6000, STYLED)
    return answered(rows, "long_context_id", prompts.LONG, prompts.long_prompt("paths", "entities", "style"))


@query("SELECT sha1('longfaith-qa' || chr(31) || path_id) AS id, sha1('### Context' || chr(10) || context || E'\\n\\n### Question\\nWhat links the chunks?\\n\\n### Answer\\nWhat they share.\\n\\n### Cited reasoning\\nSee [1] and [2].') AS text_sha1, '1|2' AS support FROM styled", PTASK)
def generate_longfaith_qa(spark, sf):
    rows = paths.qa_tasks(path_task_rows(spark, sf)).withColumn("context", prompts.cited_context("chunks"))
    tasks = rows.select(F.col("qa_id").alias("key"), F.lit(prompts.QA).alias("system"), prompts.qa_prompt("chunks", "entities", "target_entities", "style").alias("prompt"))
    found = generate.parsed_qa(generate.with_answers(tasks, OfflineClient))
    out = found.join(rows.select(F.col("qa_id").alias("key"), "context"), "key")
    return out.select(F.col("key").alias("id"), sha(prompts.qa_text("question", "answer_text", "reasoning", "context")).alias("text_sha1"), joined("support_ids").alias("support"))


@query("""SELECT 'single_doc' AS mode, count(*) AS considered, count(*) FILTER (relation_id >= '8' OR relation_id < '1') AS tasks, count(*) FILTER (relation_id < '8' AND relation_id >= '1') AS skipped,
 count(*) FILTER (relation_id >= '8' AND relation_id < 'f' OR relation_id < '1') AS generated, count(*) FILTER (relation_id >= 'f') AS failed FROM rel""", REL)
def run_stats(spark, sf):
    """Counts of a resumed run in which some rows are done, some had failed, and some fail now."""
    both = generate.marked_done(relations(spark, sf).select("relation_id"), completed_keys(spark, sf), "relation_id")
    both = both.withColumn("error", F.when(F.col("todo") & (F.col("relation_id") >= "f"), "failed"))
    count = lambda c: F.coalesce(F.sum(c.cast("long")), F.lit(0)).cast("long")
    return both.agg(F.lit("single_doc").alias("mode"), F.count("*").alias("considered"), count(F.col("todo")).alias("tasks"), count(~F.col("todo")).alias("skipped"), count(F.col("todo") & F.col("error").isNull()).alias("generated"), count(F.col("error").isNotNull()).alias("failed"))


# Evaluation, of rows made from the corpus: one for each document with entities, of four modes, some of them bad.


def generated_rows(spark, sf) -> DataFrame:
    i = F.col("source_index")
    kind, e1, e2 = i % 4, F.col("entities")[0], F.coalesce(F.try_element_at("entities", F.lit(2)), F.lit("nothing"))
    names = F.when(i % 6 == 0, " Grand Gamma Unit and Alpha Beta met Alpha Beta.").otherwise("")
    body = F.concat(F.lit("### Discussion of "), e1, F.lit("\n"), F.col("text"), F.lit("\n### Interaction\n"), e1, F.lit(" is connected with "), e2, F.lit(" because of shared context."), names, F.lit("\n\n### Context\nThe Context Discussion."))
    body = F.when(i % 20 == 5, "").when(i % 12 == 7, F.col("text")).otherwise(body)
    rel = lambda k, p: F.when(kind == k, F.concat(F.lit(p), i.cast("string")))
    none = F.lit(None)
    modes = F.when(kind == 0, "single_doc").when(kind == 1, "cross_doc").when(kind == 2, "sog_lite").otherwise("longfaith_qa")
    return with_ents(spark, sf).select(
        i.alias("row_index"), rel(0, "r").alias("relation_id"), rel(1, "g").alias("graph_id"), F.when(kind >= 2, F.concat(F.lit("p"), i.cast("string"))).alias("path_id"), none.cast("string").alias("long_context_id"), rel(3, "q").alias("qa_id"),
        F.when(kind == 0, F.col("doc_id")).alias("doc_id"),
        F.when((kind == 1) & (i % 3 == 0), F.array("doc_id", "doc_id")).when(kind == 1, F.array(F.col("doc_id"), (i + 1).cast("string"))).when(kind >= 2, F.array("doc_id")).alias("doc_ids"),
        F.when(i % 9 != 0, F.col("title")).alias("title"), "entities",
        F.when((kind == 1) | (kind == 2), F.slice("entities", 1, 2)).alias("shared_entities"), F.when(kind == 3, F.slice("entities", 1, 3)).alias("target_entities"),
        F.when(i % 5 == 0, modes).alias("generation_mode"), none.cast("string").alias("task_type"), F.when(i % 7 == 0, "contrastive").alias("style"),
        F.when(kind == 3, F.concat(F.lit(" Why "), e1, F.lit("? "))).alias("question"), F.when(kind == 3, body).alias("answer"), F.when(kind == 3, F.when(i % 8 == 3, "First [1], then [2].").otherwise("Only [1] and [1].")).alias("reasoning"), F.when(kind == 3, F.array(F.lit("[1]"), F.lit(" 2 "))).alias("support_ids"),
        F.when(kind != 3, body).alias("text"), F.when(i % 13 == 0, "failed").alias("error"),
    )


def evaluation(spark, sf) -> DataFrame:
    found = evaluate.sources(with_ents(spark, sf))
    return evaluate.evaluated(generated_rows(spark, sf), found)


def rounded(x: str) -> str:
    """SQL of round4()."""
    p, c = f"({x} * 10000.0::DOUBLE)", f"({x} * 134217729.0::DOUBLE)"
    high = f"({c} - ({c} - {x}))"
    rest = f"(({high} * 10000.0::DOUBLE - {p}) + ({x} - {high}) * 10000.0::DOUBLE)"
    up = f"({p} - floor({p}) > 0.5 OR ({p} - floor({p}) = 0.5 AND ({rest} > 0 OR ({rest} = 0 AND floor({p}) % 2 = 1))))"
    return f"((CASE WHEN {p} = floor({p}) AND {rest} < 0 THEN floor({p}) WHEN {up} THEN floor({p}) + 1 ELSE floor({p}) END) / 10000.0::DOUBLE)"


STOP = "(" + ", ".join(f"'{w}'" for w in evaluate.STOPWORDS) + ")"
TERMS = "(" + ", ".join(f"'{w}'" for w in evaluate.RELATION_TERMS) + ")"
GEN = ENTS + f""", adocs AS MATERIALIZED (SELECT d.*, l.entities FROM docs d JOIN lists l USING (doc_id)),
 gen0 AS (SELECT *, source_index AS i, source_index % 4 AS kind, entities[1] AS e1, coalesce(entities[2], 'nothing') AS e2 FROM adocs),
 gen1 AS (SELECT *, CASE WHEN i % 20 = 5 THEN '' WHEN i % 12 = 7 THEN text ELSE '### Discussion of ' || e1 || chr(10) || text || E'\n### Interaction\n' || e1 || ' is connected with ' || e2 || ' because of shared context.' || CASE WHEN i % 6 = 0 THEN ' Grand Gamma Unit and Alpha Beta met Alpha Beta.' ELSE '' END || E'\n\n### Context\nThe Context Discussion.' END AS body0 FROM gen0),
 gen AS MATERIALIZED (SELECT i AS row_index, CASE kind WHEN 0 THEN 'single_doc' WHEN 1 THEN 'cross_doc' WHEN 2 THEN 'sog_lite' ELSE 'longfaith_qa' END AS mode, substr('rgpq', CAST(kind AS INTEGER) + 1, 1) || i AS generated_id,
  CASE WHEN kind = 1 AND i % 3 = 0 THEN [doc_id, doc_id] WHEN kind = 1 THEN [doc_id, CAST(i + 1 AS VARCHAR)] ELSE [doc_id] END AS ids, CASE kind WHEN 0 THEN entities WHEN 3 THEN entities[1:3] ELSE entities[1:2] END AS selected,
  CASE WHEN kind <> 3 THEN body0 ELSE 'Why ' || e1 || '?' || CASE WHEN body0 = '' THEN '' ELSE E'\n\n' || body0 END || E'\n\n' || CASE WHEN i % 8 = 3 THEN 'First [1], then [2].' ELSE 'Only [1] and [1].' END END AS body,
  CASE WHEN kind <> 3 OR i % 8 = 3 THEN 2 ELSE 1 END AS n_cited, CASE WHEN i % 9 <> 0 THEN title END AS title, i % 13 = 0 AS failed, CASE WHEN i % 13 = 0 THEN 'failed' END AS error, entities, kind, CASE WHEN i % 7 = 0 THEN 'contrastive' ELSE 'default' END AS style, body0 FROM gen1),
 gtok AS MATERIALIZED (SELECT row_index, {toks('body')} AS toks FROM gen), gnorm AS (SELECT row_index, toks, array_to_string(toks, ' ') AS norm FROM gtok),
 gwords AS (SELECT row_index, unnest(toks) AS w, generate_subscripts(toks, 1) AS i FROM gtok),
 src AS MATERIALIZED (SELECT a.doc_id, array_to_string(t.toks, ' ') AS norm, a.entities AS keys, list_transform(list_filter(regexp_extract_all({PLAIN.format('a.title || chr(10) || a.text')}, '{PROPER}'), lambda p: contains(p, ' ') AND p NOT IN {HEADS}), lambda p: {norm('p')}) AS names FROM adocs a JOIN tok t USING (doc_id)),
 gids AS (SELECT row_index, unnest(ids) AS doc_id, generate_subscripts(ids, 1) AS p FROM gen), gsrc AS MATERIALIZED (SELECT g.row_index, g.p, s.* FROM gids g JOIN src s USING (doc_id)),
 sel AS (SELECT row_index, mode, unnest(selected) AS e FROM gen),
 sup AS (SELECT s.row_index, s.mode, s.e, count(g.doc_id) AS nd, count(*) FILTER (g.doc_id IS NOT NULL AND (list_contains(g.keys, s.e) OR contains(g.norm, s.e))) AS nh FROM sel s LEFT JOIN gsrc g USING (row_index) GROUP BY ALL),
 support AS (SELECT row_index, CAST(count(*) AS BIGINT) AS n_selected, CAST(count(*) FILTER (CASE WHEN mode = 'cross_doc' THEN nh = nd ELSE nh > 0 END) AS BIGINT) AS n_supported FROM sup GROUP BY row_index),
 mention AS (SELECT s.row_index, CAST(count(*) FILTER (contains(n.norm, s.e)) AS BIGINT) AS n_mentioned FROM sel s JOIN gnorm n USING (row_index) GROUP BY s.row_index),
 phr0 AS (SELECT row_index, unnest(l) AS phrase, generate_subscripts(l, 1) AS i FROM (SELECT row_index, regexp_extract_all({PLAIN.format('body')}, '{PROPER}') AS l FROM gen)),
 phr AS (SELECT row_index, phrase, i, {norm('phrase')} AS key FROM phr0 WHERE phrase NOT IN {HEADS} AND (contains(phrase, ' ') OR phrase IN ('LLM', 'CPT')) AND len(list_filter(regexp_split_to_array(phrase, '\\s+'), lambda w: w NOT IN {HEADS})) > 0),
 allowed AS (SELECT row_index, e AS key FROM sel UNION SELECT row_index, unnest(keys) FROM gsrc UNION SELECT row_index, unnest(names) FROM gsrc),
 unsup AS MATERIALIZED (SELECT row_index, phrase, i FROM phr ANTI JOIN allowed USING (row_index, key) QUALIFY row_number() OVER (PARTITION BY row_index, key ORDER BY i) = 1),
 nouns AS (SELECT row_index, count(*) AS n, string_agg(phrase, '|' ORDER BY i) AS phrases FROM unsup GROUP BY row_index),
 ggrams AS MATERIALIZED (SELECT DISTINCT row_index, g FROM (SELECT row_index, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o || ' ' || lead(w, 4) OVER o AS g FROM gwords WINDOW o AS (PARTITION BY row_index ORDER BY i)) WHERE g IS NOT NULL),
 sgrams AS MATERIALIZED (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, w || ' ' || lead(w, 1) OVER o || ' ' || lead(w, 2) OVER o || ' ' || lead(w, 3) OVER o || ' ' || lead(w, 4) OVER o AS g FROM words SEMI JOIN adocs USING (doc_id) WINDOW o AS (PARTITION BY doc_id ORDER BY i)) WHERE g IS NOT NULL),
 over1 AS (SELECT row_index, p, count(*) AS n FROM gids JOIN ggrams USING (row_index) JOIN sgrams USING (doc_id, g) GROUP BY row_index, p),
 grams AS (SELECT g.row_index, CAST(g.n AS BIGINT) AS n_grams, CAST(coalesce(o.n, 0) AS BIGINT) AS n_shared FROM (SELECT row_index, count(*) AS n FROM ggrams GROUP BY row_index) g LEFT JOIN (SELECT row_index, max(n) AS n FROM over1 GROUP BY row_index) o USING (row_index)),
 tokc AS (SELECT row_index, count(*) AS n_tokens, count(*) FILTER (w NOT IN {STOP}) AS n_content, count(DISTINCT w) FILTER (w IN {TERMS}) AS n_terms FROM gwords GROUP BY row_index),
 missing AS (SELECT g.row_index, count(*) - count(s.doc_id) AS n FROM gids g LEFT JOIN src s USING (doc_id) GROUP BY g.row_index),
 m AS MATERIALIZED (SELECT g.*, n_selected, n_supported, n_mentioned, coalesce(u.n, 0) AS n_unsupported, coalesce(u.phrases, '') AS phrases, coalesce(n_grams, 0) AS n_grams, coalesce(r.n_shared, 0) AS n_shared, coalesce(n_tokens, 0) AS n_tokens, coalesce(n_content, 0) AS n_content, coalesce(n_terms, 0) AS n_terms, x.n AS n_missing,
  CAST(len(regexp_extract_all(body, '(?m)^###\\s+')) AS BIGINT) AS n_headings, CAST(len(list_filter(string_split(body, chr(10)), lambda l: regexp_replace(l, '\\s', '', 'g') <> '')) AS BIGINT) AS n_lines
  FROM gen g JOIN support USING (row_index) JOIN mention USING (row_index) JOIN missing x USING (row_index) LEFT JOIN nouns u USING (row_index) LEFT JOIN grams r USING (row_index) LEFT JOIN tokc USING (row_index)),
 f1 AS (SELECT *, CASE WHEN n_selected > 0 THEN n_supported::DOUBLE / n_selected::DOUBLE ELSE 0 END AS support_, CASE WHEN n_selected > 0 THEN n_mentioned::DOUBLE / n_selected::DOUBLE ELSE 0 END AS mention_, greatest(0::DOUBLE, least(1::DOUBLE, 1.0::DOUBLE - n_unsupported::DOUBLE / 5.0::DOUBLE)) AS nouns_, CASE WHEN n_grams > 0 THEN n_shared::DOUBLE / n_grams::DOUBLE ELSE 0 END AS overlap_ FROM m),
 f2 AS (SELECT *, greatest(0::DOUBLE, least(1::DOUBLE, 1.0::DOUBLE - greatest(0::DOUBLE, overlap_ - 0.25::DOUBLE) / 0.5::DOUBLE)) AS redundancy_, greatest(0::DOUBLE, least(1::DOUBLE, n_terms::DOUBLE / 4.0::DOUBLE * 0.6::DOUBLE + mention_ * 0.4::DOUBLE)) AS relation_,
  CASE WHEN n_content > 0 THEN greatest(0::DOUBLE, least(1::DOUBLE, n_mentioned::DOUBLE / n_content::DOUBLE * 8.0::DOUBLE)) ELSE 0 END AS specificity_, CASE WHEN body = '' THEN 0 ELSE greatest(0::DOUBLE, least(1::DOUBLE, least(n_headings, 3)::DOUBLE * 0.5::DOUBLE / 3.0::DOUBLE + least(n_lines, 4)::DOUBLE * 0.5::DOUBLE / 4.0::DOUBLE)) END AS structure_,
  CASE WHEN n_tokens < 20 THEN n_tokens::DOUBLE / 20.0::DOUBLE WHEN n_tokens <= 700 THEN 1.0::DOUBLE ELSE greatest(0::DOUBLE, 1.0::DOUBLE - (n_tokens::DOUBLE - 700) / 700.0::DOUBLE) END AS length_, least(1.0::DOUBLE, n_cited::DOUBLE / 2.0::DOUBLE) AS citation_ FROM f1),
 f3a AS (SELECT *, (support_ * 0.22::DOUBLE + mention_ * 0.18::DOUBLE + nouns_ * 0.18::DOUBLE + redundancy_ * 0.12::DOUBLE + relation_ * 0.12::DOUBLE + specificity_ * 0.08::DOUBLE + structure_ * 0.05::DOUBLE + length_ * 0.05::DOUBLE) AS raw_ FROM f2), f3 AS (SELECT *, {rounded('raw_')} AS all_ FROM f3a), f4 AS (SELECT *, all_ * 0.9::DOUBLE + citation_ * 0.1::DOUBLE AS qa_ FROM f3),
 f AS MATERIALIZED (SELECT *, CASE WHEN mode = 'longfaith_qa' THEN {rounded('qa_')} ELSE all_ END AS overall_ FROM f4),
 w AS MATERIALIZED (SELECT *, overall_ >= 0.75 AND support_ >= 0.95 AND mention_ >= 0.8 AND n_unsupported <= 2 AND overlap_ <= 0.65 AND citation_ >= 1 AND NOT failed AND body <> '' AS pass_gate,
  list_filter([CASE WHEN failed THEN '{evaluate.WARNINGS['error']}' END, CASE WHEN n_missing <> 0 THEN '{evaluate.WARNINGS['missing']}' END, CASE WHEN body = '' THEN '{evaluate.WARNINGS['empty']}' END, CASE WHEN support_ < 0.95 THEN '{evaluate.WARNINGS['support']}' END, CASE WHEN mention_ < 0.8 THEN '{evaluate.WARNINGS['mention']}' END, CASE WHEN n_unsupported > 0 THEN '{evaluate.WARNINGS['nouns']}' END, CASE WHEN overlap_ > 0.65 THEN '{evaluate.WARNINGS['overlap']}' END, CASE WHEN citation_ < 1 THEN '{evaluate.WARNINGS['citation']}' END], lambda x: x IS NOT NULL) AS warnings FROM f)"""


@query("SELECT row_index, mode FROM gen", GEN)
def classify_mode(spark, sf):
    return evaluate.classified(evaluate.wide(generated_rows(spark, sf))).select("row_index", "mode")


@query("SELECT a.doc_id, CASE WHEN a.source_index % 3 = 0 THEN 'cached' ELSE array_to_string(a.entities, '|') END AS entities FROM adocs a", GEN)
def eval_sources(spark, sf):
    d = with_ents(spark, sf)
    cache = d.where("source_index % 3 = 0").select("doc_id", F.array(F.lit("cached")).alias("entities"))
    return evaluate.sources(d, cache).select("doc_id", joined("entities").alias("entities"))


@query("SELECT row_index, array_to_string(selected, '|') AS selected FROM gen", GEN)
def eval_selected_entities(spark, sf):
    return evaluate.prepared(evaluate.wide(generated_rows(spark, sf))).select("row_index", joined("selected").alias("selected"))


@query("SELECT row_index, CAST(len(ids) AS BIGINT) AS n_ids, n_missing FROM m", GEN)
def eval_join_sources(spark, sf):
    return evaluation(spark, sf).select("row_index", F.size("ids").cast("long").alias("n_ids"), "n_missing")


@query("SELECT row_index, n_supported, n_selected, n_mentioned FROM m", GEN)
def eval_support(spark, sf):
    return evaluation(spark, sf).select("row_index", "n_supported", "n_selected", "n_mentioned")


@query("SELECT row_index, phrases FROM m", GEN)
def eval_unsupported(spark, sf):
    return evaluation(spark, sf).select("row_index", joined("unsupported").alias("phrases"))


@query("SELECT row_index, n_shared, n_grams FROM m", GEN)
def eval_ngram_overlap(spark, sf):
    return evaluation(spark, sf).select("row_index", F.col("n_shared_grams").alias("n_shared"), "n_grams")


@query("SELECT row_index, n_mentioned AS n_entity_tokens, n_content, n_terms, n_headings, n_lines, n_tokens FROM m", GEN)
def eval_specificity(spark, sf):
    return evaluation(spark, sf).select("row_index", "n_entity_tokens", "n_content", "n_terms", "n_headings", "n_lines", "n_tokens")


@query("SELECT row_index, pass_gate, CAST(round(overall_ * 10000) AS BIGINT) AS overall FROM w", GEN)
def eval_gate(spark, sf):
    return evaluation(spark, sf).select("row_index", "pass_gate", F.round(F.col("overall") * 10000).cast("long").alias("overall"))


@query("SELECT row_index, array_to_string(warnings, '|') AS warnings FROM w", GEN)
def eval_warnings(spark, sf):
    return evaluation(spark, sf).select("row_index", joined("warnings").alias("warnings"))


@query("SELECT mode, count(*) AS n FROM w GROUP BY mode", GEN)
def eval_rows_by_mode(spark, sf):
    return evaluate.rows_by_mode(evaluation(spark, sf))


FOUR = {"overall": "overall_", "selected_entity_support": "support_", "selected_entity_mention": "mention_", "unsupported_proper_noun_score": "nouns_", "redundancy_score": "redundancy_", "source_5gram_overlap": "overlap_", "relation_signal": "relation_", "specificity": "specificity_", "structure": "structure_", "length": "length_", "citation_support": "citation_"}


@query(" UNION ALL ".join(f"SELECT '{k}' AS score, count(*) AS n, CAST(sum(CAST(floor({v} * 10000 + 0.5) AS BIGINT)) AS BIGINT) AS total, CAST(floor(min({v}) * 10000 + 0.5) AS BIGINT) AS least, CAST(floor(max({v}) * 10000 + 0.5) AS BIGINT) AS most FROM w" for k, v in FOUR.items()), GEN)
def eval_score_summary(spark, sf):
    """The sums that means are made of, at four decimals."""
    pairs = ", ".join(f"'{c}', `{c}`" for c in FOUR)
    rows = evaluation(spark, sf).selectExpr(f"stack({len(FOUR)}, {pairs}) as (score, value)")
    at4 = lambda x: F.floor(x * 10000 + 0.5).cast("long")
    return rows.groupBy("score").agg(F.count("*").alias("n"), F.sum(at4(F.col("value"))).alias("total"), at4(F.min("value")).alias("least"), at4(F.max("value")).alias("most"))


@query("SELECT warning, count(*) AS n FROM (SELECT unnest(warnings) AS warning FROM w) GROUP BY warning", GEN)
def eval_warning_counts(spark, sf):
    return evaluate.warning_counts(evaluation(spark, sf))


@query("SELECT count(*) AS n_rows, count(*) FILTER (pass_gate) AS n_passed, count(*) FILTER (NOT pass_gate) AS n_failed FROM w", GEN)
def eval_pass_rate(spark, sf):
    return evaluate.pass_counts(evaluation(spark, sf))


@query("""SELECT generated_id, CASE WHEN mode = 'cross_doc' THEN 'cross_doc_bridge' ELSE 'single_doc_entity' END AS probe_type, CASE WHEN mode = 'cross_doc' THEN 'Which source documents are connected by the shared entity ' || entity || '?' ELSE 'Which generated passage discusses ' || entity || ' in relation to the source document?' END AS question,
 CASE WHEN mode = 'cross_doc' THEN array_to_string(ids, ', ') ELSE coalesce(title, ids[1]) END AS expected_answer, entity FROM (SELECT *, unnest(selected) AS entity FROM gen)""", GEN)
def eval_probes(spark, sf):
    return evaluate.probes(evaluate.prepared(evaluate.wide(generated_rows(spark, sf))))


@query("SELECT row_index, generated_id, mode FROM w WHERE NOT pass_gate ORDER BY row_index LIMIT 25", GEN)
def failed_rows_top25(spark, sf):
    return evaluate.failed_rows(evaluation(spark, sf))


# Comparisons.


@query("""SELECT label, count(*) AS n_rows, count(*) FILTER (failed) AS n_errors, CAST(sum(len(warnings)) AS BIGINT) AS n_warnings, CAST(floor(avg(support_) * 1e6 + 0.5) AS BIGINT) AS support, CAST(floor(avg(relation_) * 1e6 + 0.5) AS BIGINT) AS relation FROM (SELECT *, CASE WHEN row_index % 3 = 0 THEN 'a' ELSE 'b' END AS label FROM w) GROUP BY label""", GEN)
def compare_generation(spark, sf):
    result = evaluation(spark, sf).withColumn("label", F.when(F.col("row_index") % 3 == 0, "a").otherwise("b"))
    rows = compare.compare_generation(result)
    return rows.select("label", "n_rows", "n_errors", "n_warnings", six(F.col("mean_selected_entity_support")).alias("support"), six(F.col("mean_relation_signal")).alias("relation"))


@query(f"SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS n_duplicates FROM (SELECT count(*) AS n FROM (SELECT {norm('text')} AS k FROM docs) WHERE k <> '' GROUP BY k)", DOCS)
def duplicate_texts(spark, sf):
    return compare.duplicate_texts(corpus(spark, sf))


@query("SELECT doc_id, n AS n_entities, CAST(n * (n - 1) // 2 AS BIGINT) AS n_2, CAST(n * (n - 1) * (n - 2) // 6 AS BIGINT) AS n_3 FROM (SELECT doc_id, count(*) AS n FROM ents GROUP BY doc_id)", ENTS)
def combo_counts(spark, sf):
    return compare.combo_counts(with_ents(spark, sf))


@query("SELECT key, count(*) AS n_docs, string_agg(doc_id, '|' ORDER BY doc_id) AS docs FROM ents GROUP BY key HAVING count(*) > 1", ENTS)
def entity_overlap(spark, sf):
    return compare.entity_overlap(with_ents(spark, sf)).select("key", "n_docs", joined("docs").alias("docs"))


@query("SELECT a.doc_id AS doc_a, b.doc_id AS doc_b, count(*) AS n FROM ents a JOIN ents b ON a.key = b.key AND a.doc_id < b.doc_id GROUP BY ALL", ENTS)
def entity_overlap_pairs(spark, sf):
    return compare.entity_overlap_pairs(with_ents(spark, sf))


@query("""SELECT measure, CAST(n AS BIGINT) AS value FROM (SELECT 'rows:' || CASE kind WHEN 0 THEN 'single' ELSE 'cross' END AS measure, count(*) AS n FROM gen WHERE kind < 2 GROUP BY ALL
 UNION ALL SELECT 'failed', count(*) FROM gen WHERE kind < 2 AND failed HAVING count(*) > 0 UNION ALL SELECT 'size:' || len(entities), count(*) FROM gen WHERE kind = 0 GROUP BY ALL UNION ALL SELECT 'shared:' || len(selected), count(*) FROM gen WHERE kind = 1 GROUP BY ALL
 UNION ALL SELECT 'distinct combos', count(DISTINCT ids[1] || '|' || array_to_string(entities, '|')) FROM gen WHERE kind = 0 UNION ALL SELECT 'distinct pairs', count(DISTINCT array_to_string(ids, '|')) FROM gen WHERE kind = 1)""", GEN)
def generated_summary(spark, sf):
    return compare.generated_summary(evaluate.wide(generated_rows(spark, sf)).where("row_index % 4 < 2"))
