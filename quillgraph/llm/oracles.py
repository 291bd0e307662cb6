"""DuckDB SQL for the queries that SQL can express. The others are tested against brute-force versions in tests/llm."""

from __future__ import annotations

from .quality import CAPITALS, MEASURES, REACH, SYMBOLS

#: The operators' words: what stands between spaces, tabs, line ends and page breaks.
WORDS = "list_filter(string_split_regex({}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"
SPACES = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

OP3 = f"""
WITH w AS MATERIALIZED (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
 windows AS (SELECT doc_id, unnest(range(1, len(w) - 18)) AS i, w FROM w WHERE len(w) >= 20),
 keyed AS MATERIALIZED (SELECT doc_id, i, md5(array_to_string(w[i:i + 19], ' ')) AS k FROM windows),
 again AS (SELECT doc_id, i FROM keyed QUALIFY row_number() OVER (PARTITION BY k ORDER BY doc_id, i) > 1),
 gone AS (SELECT DISTINCT doc_id, i + j AS i FROM again, range(20) r(j)),
 each AS (SELECT doc_id, unnest(w) AS x, generate_subscripts(w, 1) AS i FROM w),
 kept AS (SELECT doc_id, count(*) AS n, string_agg(x, ' ' ORDER BY i) AS t FROM each ANTI JOIN gone USING (doc_id, i) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(len(w.w) - coalesce(k.n, 0) AS BIGINT) AS n_removed, sha256(coalesce(k.t, '')) AS kept_sha256 FROM w LEFT JOIN kept k USING (doc_id)
"""

RATES = {"symbol_rate": "n_symbols::DOUBLE / greatest(word_chars, 1)", "dup_line_rate": "n_dup_lines::DOUBLE / greatest(n_lines, 1)", "repeat_rate": "n_repeat_words::DOUBLE / greatest(n_words, 1)", "mean_word": "word_chars::DOUBLE / greatest(n_words, 1)", "capital_rate": "n_capitals::DOUBLE / greatest(word_chars, 1)"}

OP7 = f"""
WITH d AS (SELECT doc_id, lang, source, coalesce(text, '') AS t FROM documents),
 w AS MATERIALIZED (SELECT *, {WORDS.format("t")} AS w, list_filter(string_split(t, chr(10)), lambda x: translate(x, {SPACES}, '') <> '') AS l FROM d),
 tri AS (SELECT doc_id, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM w WHERE len(w) > 2)),
 twice AS (SELECT doc_id, i FROM tri QUALIFY count(*) OVER (PARTITION BY doc_id, k) > 1),
 rep AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM twice, range(3) r(j) GROUP BY doc_id),
 m AS (SELECT w.doc_id, lang, source, CAST(len(w) AS BIGINT) AS n_words, CAST(length(translate(t, {SPACES}, '')) AS BIGINT) AS word_chars, CAST(length(t) - length(translate(t, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols, CAST(length(t) - length(translate(t, '{CAPITALS}', '')) AS BIGINT) AS n_capitals, CAST(len(l) - len(list_distinct(l)) AS BIGINT) AS n_dup_lines, CAST(len(l) AS BIGINT) AS n_lines, CAST(coalesce(n, 0) AS BIGINT) AS n_repeat_words FROM w LEFT JOIN rep USING (doc_id)),
 r AS MATERIALIZED (SELECT *, (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AS base_failed, {", ".join(f"{v} AS {k}" for k, v in RATES.items())} FROM m),
 q AS (SELECT lang, source, {", ".join(f"quantile_disc({k}, 0.25) AS {k}_1, quantile_disc({k}, 0.75) AS {k}_3" for k in MEASURES)} FROM r WHERE NOT base_failed GROUP BY lang, source)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, NOT base_failed AND {" AND ".join(f"coalesce({k} <= {k}_3 + {REACH}::DOUBLE * ({k}_3 - {k}_1 + {v}::DOUBLE), true)" for k, v in MEASURES.items())} AS kept
FROM r LEFT JOIN q ON r.lang IS NOT DISTINCT FROM q.lang AND r.source IS NOT DISTINCT FROM q.source
"""

OP8 = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages), d AS (SELECT page_id, CAST(strlen(h) AS BIGINT) AS n, sha1(h) AS s FROM p),
 top AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY s, n) ELSE page_id END AS m FROM d)
SELECT page_id, n AS payload_bytes, s AS payload_digest, CASE WHEN page_id = m THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> m THEN m END AS refers_to FROM top
"""

ORACLES: dict[str, str] = {"op3_suffix_tree_dedup": OP3, "op7_quality_rules": OP7, "op8_warc_index": OP8}
