"""Language identification by nearest centroids.

A text is the normalised TF-IDF vector of its byte trigrams (letters lower-cased, runs of what isn't a letter as one space),
hashed into a fixed number of columns. Each language has several centroids, clustered by spherical k-means on a bounded
sample of labelled rows. The language of the nearest centroid by cosine is predicted; a text whose cosine is far
below the median of the language's own sample is rejected. Every row's whole text is scored, against a model of fixed size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import column, slices, text_bytes

#: Columns of a vector, centroids of a language, and labelled rows of a language that the model is fitted on (those of least hash).
COLUMNS, CENTROIDS, SAMPLE = 4096, 4, 400
#: A text is rejected below this part of the median cosine of its language's sample, without the rows that are nearer to another language. Clusters of a lesser share of the sample, such as mislabelled texts, are no centroids.
REJECT_AT, SHARE = 1 / 3, 0.1
UNKNOWN = "und"
LETTER = regex.compile(r"\p{L}")
ROWS = 256
#: Ranges of order for each doubling, by which the rows of least order are found.
RANGES = 32


def counts_of(texts: pa.Array) -> np.ndarray:
    """Counts of hashed byte trigrams [texts, COLUMNS]."""
    raw, ends = text_bytes(texts)
    n = len(ends) - 1
    if not len(raw):
        return np.zeros((n, COLUMNS), np.float32)
    lower = np.where((raw >= 65) & (raw <= 90), raw + 32, raw)
    letter = ((lower >= 97) & (lower <= 122)) | (lower >= 128)
    lower = np.where(letter, lower, 32).astype(np.uint32)
    own = np.repeat(np.arange(n), np.diff(ends))
    # Of a run of non-letters the first byte stays; the trigrams run over what stays.
    stays = letter | np.concatenate(([True], letter[:-1])) | np.concatenate(([True], own[1:] != own[:-1]))
    lower, own = lower[stays], own[stays]
    if len(lower) < 3:
        return np.zeros((n, COLUMNS), np.float32)
    mixed = (lower[:-2] * 0x9E3779B1 ^ lower[1:-1] * 0x85EBCA6B ^ lower[2:] * 0xC2B2AE35).astype(np.uint32)
    mixed = ((mixed ^ (mixed >> 15)) * np.uint32(0x2C1B3C6D)) >> np.uint32(20)
    whole = own[:-2] == own[2:]
    return np.bincount(own[:-2][whole] * COLUMNS + mixed[whole], minlength=n * COLUMNS).reshape(n, COLUMNS).astype(np.float32)


def unit(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


class Centroids:
    """idf [COLUMNS]; centres [centroids, COLUMNS], whose languages are languages[owner]; floor: the least accepted cosine of each language."""

    def __init__(self, languages: list[str], rows: dict[str, np.ndarray]) -> None:
        everything = np.concatenate([rows[x] for x in languages])
        self.languages = languages
        self.idf = (np.log((1 + len(everything)) / (1 + (everything > 0).sum(0))) + 1).astype(np.float32)
        centres, owner, floor = [], [], []
        for k, lang in enumerate(languages):
            x = self.vectors(rows[lang])
            own = clustered(x, CENTROIDS)
            centres.append(own)
            owner += [k] * len(own)
        self.centres, self.owner = np.concatenate(centres).astype(np.float32), np.array(owner)
        for k, lang in enumerate(languages):
            near, cosine = self.nearest(rows[lang])
            floor.append(REJECT_AT * np.median(cosine[near == k] if (near == k).any() else cosine))
        self.floor = np.array(floor)

    def vectors(self, counts: np.ndarray) -> np.ndarray:
        return unit(np.log1p(counts) * self.idf)

    def nearest(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index of each row's language and its cosine; the first of equally near centroids counts."""
        cosines = self.vectors(counts) @ self.centres.T
        best = cosines.argmax(1)
        return self.owner[best], np.clip(cosines[np.arange(len(best)), best], 0, 1)


def clustered(x: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Spherical k-means from the first row and those least like the ones chosen; clusters that lose all rows go."""
    centres = x[:1]
    while len(centres) < min(k, len(x)):
        centres = np.concatenate((centres, x[[(x @ centres.T).max(1).argmin()]]))
    for _ in range(rounds):
        own = (x @ centres.T).argmax(1)
        centres = unit(np.stack([x[own == c].sum(0) for c in np.unique(own)]))
    own = np.bincount((x @ centres.T).argmax(1), minlength=len(centres))
    return centres[own >= min(SHARE * len(x), own.max())]


def remainder(id_col: str, modulus: int) -> Column:
    """crc32 of an id as text, modulo modulus; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % modulus


def fit(rows: DataFrame) -> Centroids | None:
    """A model from rows (lang, text, order: a 64-bit hash; those of least order as an unsigned number are taken, SAMPLE of a language), or None without any.

    No language's rows meet in one task: counts by ranges of order, whose width follows their distance from the least one, say
    where a language has enough rows, and only rows up to there, hardly more than SAMPLE, are ranked.
    """
    labelled = rows.where(F.col("lang").isNotNull() & F.col("text").isNotNull())
    part = F.floor(F.log2((F.shiftrightunsigned("order", 11) + 1).cast("double")) * RANGES).cast("int")
    ranges = labelled.groupBy("lang", part.alias("part")).count()
    upto = F.sum("count").over(Window.partitionBy("lang").orderBy("part")) - F.col("count")
    bounds = ranges.withColumn("before", upto).where(F.col("before") < SAMPLE).groupBy(F.col("lang").alias("_lang")).agg(F.max("part").alias("most"))
    # bounds has a row for each language that the model has centroids of.
    near = labelled.join(F.broadcast(bounds), F.col("lang") == F.col("_lang")).where(part <= F.col("most"))
    near = near.select("lang", "text", F.shiftrightunsigned("order", 11).alias("order"), F.xxhash64("text").alias("key")).dropDuplicates(["lang", "order", "key"])
    least = F.row_number().over(Window.partitionBy("lang").orderBy("order", "key")) <= SAMPLE
    sample = near.withColumn("_own", least).where("_own")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                counts = np.minimum(counts_of(column(batch, "text")), 65535).astype(np.uint16)
                yield pa.RecordBatch.from_arrays([column(batch, "lang"), pa.array([c.tobytes() for c in counts], pa.binary())], ["lang", "counts"])

    # SAMPLE rows of each language at most: what the driver gets is bounded.
    found: dict[str, list] = {}
    for row in sample.select("lang", "text").mapInArrow(run, "lang string, counts binary").collect():
        found.setdefault(row.lang, []).append(bytes(row.counts))
    if not found:
        return None
    # Sorted, so that the model doesn't depend on the order in which rows come.
    return Centroids(sorted(found), {k: np.stack([np.frombuffer(c, np.uint16) for c in sorted(v)]).astype(np.float32) for k, v in found.items()})


def predicted(whole: pa.RecordBatch, model: Centroids | None) -> Iterator[pa.RecordBatch]:
    """Predictions for the rows (doc_id, text) of a batch, in order."""
    for part in slices(whole):
        for lo in range(0, part.num_rows, ROWS):
            batch = part.slice(lo, ROWS)
            texts = column(batch, "text")
            known = np.array([model is not None and LETTER.search(t) is not None for t in texts.to_pylist()], bool)
            lang, score = model.nearest(counts_of(texts)) if model else (np.zeros(len(known), int), np.zeros(len(known)))
            names = [model.languages[k] if ok else UNKNOWN for k, ok in zip(lang.tolist(), known.tolist(), strict=True)]
            score = np.where(known, score, 0).astype(np.float64)
            bad = ~known if model is None else ~known | (score < model.floor[lang]) | (score <= 0)
            yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(names, pa.string()), pa.array(score), pa.array(bad)], ["doc_id", "lang_pred", "score", "rejected"])


def predict(df: DataFrame, model: Centroids | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, lang_pred, score, rejected of each row.

    A null text or one without a letter is 'und' with score 0, and rejected; so is every text if there is no model. Texts too
    short for a trigram get the first language, score 0, and are rejected. Repeated rows repeat; an empty table gives none.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from predicted(batch, shared.value)

    docs = df.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return docs.mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang_pred string, score double, rejected boolean")


def fit_fold(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Centroids | None:
    """A model from the rows whose crc32(id) mod 3 isn't 1."""
    return fit(df.where(remainder(id_col, 3) != 1).select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(id_col).alias("order")))


def identify(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """doc_id, lang_pred, score, rejected, by a model from the rows whose crc32(id) mod 3 isn't 1. Ids decide who teaches, and nothing else."""
    return predict(df, fit_fold(df, id_col, text_col, lang_col), id_col, text_col)


def keep_identified(df: DataFrame, model: Centroids | None, text_col: str = "text") -> DataFrame:
    """The rows of df whose text isn't rejected (see predict), with all their columns."""
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            texts = pc.coalesce(column(batch, text_col), pa.scalar("", column(batch, text_col).type))
            rows = pa.RecordBatch.from_arrays([pa.array(range(batch.num_rows), pa.int64()), texts], ["doc_id", "text"])
            bad = [x for part in predicted(rows, model) for x in column(part, "rejected").to_pylist()]
            yield batch.filter(pa.array([not x for x in bad], pa.bool_()))

    return df.mapInArrow(run, df.schema)
