"""Quality rules with adaptive thresholds, in DataFrame functions only.

Each document's measures are expressions over its own row. Thresholds aren't fixed: for each language and source, mergeable
quantile sketches (percentile_approx keeps a bounded summary per group and merges partial ones) give the quartiles of every
measure, and a document goes if it lies beyond the fence of its group, upper quartile + reach * (spread + least spread). A
group's fence is joined to its documents by language and source; documents of a hot source only meet a row of thresholds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import durable

#: The measures, each with a least spread near its noise in a text of some hundred words (such as one line of twenty), for groups whose documents are nearly alike.
MEASURES = {"symbol_rate": 0.002, "dup_line_rate": 0.05, "repeat_rate": 0.04, "mean_word": 0.3, "capital_rate": 0.002}
#: A fence lies so many spreads beyond the upper quartile; accuracy is the sketch's (rank error: rows / accuracy).
REACH, ACCURACY = 3.0, 10_000
#: Fixed values of the contract: white space that separates words, and what counts as symbols.
SPACES, SYMBOLS, CAPITALS = " \t\n\x0b\x0c\r", "#*$%&|<>", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def _count(text: str, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("long")


def words_of(text: Column) -> Column:
    """Words [^\\x20\\x09-\\x0D]+ in order."""
    return F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")


def with_repeated_words(df: DataFrame, words: str, out: str) -> DataFrame:
    """df with the count of words that lie in a window of three words found twice or more, first ones included.

    A window is known by the 64-bit hash of its three words. Most texts have no window twice, which a hash set shows; only the
    others sort their windows with their places, so that equal ones meet. Each step is a column of its own, because what a
    lambda refers to is computed anew for each element unless it is a column.
    """
    word = lambda i: F.get(words, i)
    n = F.size(words)
    none = F.array().cast("array<struct<h:bigint,i:int>>")
    same = lambda x, k: F.coalesce(F.get("_placed", k)["h"] == x["h"], F.lit(False))
    windows = F.when(n > 2, F.transform(F.sequence(F.lit(0), n - 3), lambda i: F.xxhash64(word(i), word(i + 1), word(i + 2)))).otherwise(F.array().cast("array<bigint>"))
    df = df.withColumn("_windows", windows)
    df = df.withColumn("_placed", F.when(F.size(F.array_distinct("_windows")) < F.size("_windows"), F.sort_array(F.transform("_windows", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))).otherwise(none))
    df = df.withColumn("_twice", F.sort_array(F.transform(F.filter("_placed", lambda x, k: same(x, k - 1) | same(x, k + 1)), lambda x: x["i"])))
    # A window covers three words, or as many as come after the one before it.
    covered = F.zip_with("_twice", F.concat(F.array(F.lit(-3)), F.col("_twice")), lambda i, last: F.when(i.isNotNull(), F.least(F.lit(3), i - last)).otherwise(0))
    covered = F.aggregate(covered, F.lit(0).cast("long"), lambda total, x: total + x)
    return df.withColumn(out, covered).drop("_windows", "_placed", "_twice")


def measured(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", carry: list[str] | None = None) -> DataFrame:
    """row (a struct of the columns to carry, all by default, so that their names can't clash), lang, source, and n_words, word_chars, n_symbols, n_capitals, n_dup_lines, n_lines, n_repeat_words of each row. A null text has no words."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = df.select(F.struct(*(carry or df.columns)).alias("row"), F.col(lang_col).alias("lang"), F.col(source_col).alias("source"), text.alias("t"), words_of(text).alias("w"))
    base = with_repeated_words(base, "w", "n_repeat_words")
    base = base.withColumn("lines", F.filter(F.split("t", "\n", -1), lambda x: F.length(F.translate(x, SPACES, "")) > 0))
    return base.select(
        "row",
        "lang",
        "source",
        F.size("w").cast("long").alias("n_words"),
        F.length(F.translate("t", SPACES, "")).cast("long").alias("word_chars"),
        _count("t", SYMBOLS).alias("n_symbols"),
        _count("t", CAPITALS).alias("n_capitals"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.size("lines").cast("long").alias("n_lines"),
        "n_repeat_words",
    )


def rates(rows: DataFrame) -> DataFrame:
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    return rows.select(
        "*",
        ((F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))).alias("base_failed"),
        (F.col("n_symbols") / chars).alias("symbol_rate"),
        (F.col("n_dup_lines") / F.greatest(F.col("n_lines"), F.lit(1))).alias("dup_line_rate"),
        (F.col("n_repeat_words") / words).alias("repeat_rate"),
        (F.col("word_chars") / words).alias("mean_word"),
        (F.col("n_capitals") / chars).alias("capital_rate"),
    )


def fences(rows: DataFrame) -> DataFrame:
    """For each language and source (null is a value of its own): the greatest measure that passes, from the quartiles of the documents that passed the base rules."""
    sketch = [F.percentile_approx(m, [0.25, 0.75], ACCURACY).alias(m) for m in MEASURES]
    return rows.where(~F.col("base_failed")).groupBy("lang", "source").agg(*sketch).select(
        F.col("lang").alias("_lang"),
        F.col("source").alias("_source"),
        *[(F.col(m)[1] + REACH * (F.col(m)[1] - F.col(m)[0] + least)).alias(f"max_{m}") for m, least in MEASURES.items()],
    )


def judged(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source", carry: list[str] | None = None) -> DataFrame:
    """measured() with base_failed and kept.

    Null languages and sources form groups too. Empty texts fail the base rules. A group in which all documents fail them has
    no fence, and needs none. Values that lie on the fence pass. Repeated rows are judged alike; an empty table gives none.
    """
    # Written once with its row, so that texts are neither measured again for the second use nor shuffled to meet their measures.
    rows = durable(rates(measured(df, text_col, lang_col, source_col, carry)), "measures")
    # As many rows as there are pairs of language and source, which nothing bounds: written first, so that Spark knows its size when it plans the join and broadcasts it only below its own threshold.
    limits = durable(fences(rows), "fences")
    joined = rows.join(limits, F.col("lang").eqNullSafe(F.col("_lang")) & F.col("source").eqNullSafe(F.col("_source")), "left")
    fine = F.lit(True)
    for m in MEASURES:
        fine = fine & F.coalesce(F.col(m) <= F.col(f"max_{m}"), F.lit(True))
    return joined.withColumn("kept", ~F.col("base_failed") & fine)


def apply_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept of each row; see judged()."""
    rows = judged(df, text_col, lang_col, source_col, [id_col])
    return rows.select(F.col("row")[id_col].alias("doc_id"), "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def keep_good(df: DataFrame, text_col: str = "text", lang_col: str = "lang", source_col: str = "source") -> DataFrame:
    """The rows of df that the rules keep."""
    return judged(df, text_col, lang_col, source_col).where("kept").select("row.*")
