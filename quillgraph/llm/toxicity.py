"""Toxic passages by maximum-scoring segment search.

A word's score is how much likelier it is in toxic than in other texts: the log-odds of document frequencies under a Dirichlet
prior that follows all texts of the sample, less two of its standard errors, less a drift that makes ordinary text lose.
One linear scan (the algorithm of Ruzzo and Tompa) finds all maximal segments. Extreme-value statistics (Karlin and Altschul)
turn a segment's score and the text's length into the number of such segments that chance would give; those with few are
significant, and their evidence is calibrated to a probability on the sample.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from .common import column, durable, slices
from .langid import remainder

#: Labelled rows of each class that the model is fitted on (those of least hash), texts of the sample that a word must be in, and words of the model at most.
SAMPLE, LEAST_TEXTS, VOCABULARY = 8000, 4, 50_000
#: Weight of the prior in texts; what each word costs; expected chance segments below which a segment is significant.
PRIOR, DRIFT, SIGNIFICANT = 50.0, 0.02, 0.05
CUT = 0.3
WORD = re.compile(r"\w+")


def maximal_segments(steps: list[tuple[int, float]], length: int, drift: float) -> list[tuple[int, int, float]]:
    """(first, end, score) of all maximal-scoring segments of a text of length words, where steps has the words that score (place, score) and all others cost drift.

    Linear in len(steps): candidates are kept with the sums before and after them and the nearest candidate before them that
    begins lower; a new one joins back to that one if it ends lower too, and no candidate is looked at again that one of these
    links passes over.
    """
    found: list[tuple[int, int, float, float, int]] = []  # first, end, sum before, sum after, link
    total, after = 0.0, 0
    for place, score in steps:
        total -= drift * (place - after)
        after = place + 1
        before, total = total, total + score
        if score <= 0:
            continue
        first, low, high = place, before, total
        k = len(found) - 1
        while k >= 0 and found[k][2] >= low:
            k = found[k][4]
        while k >= 0 and found[k][3] < high:
            first, _, low, _, link = found[k]
            del found[k:]
            k = link
        found.append((first, place + 1, low, high, k))
    return [(a, b, high - low) for a, b, low, high, _ in found]


class Model:
    """score by word; decay (lambda) and scale (K) of the extreme-value law; weight and bias of the calibration."""

    def __init__(self, scores: dict[str, float]) -> None:
        self.scores, self.decay, self.scale, self.weight, self.bias = scores, 1.0, 0.1, 1.0, -3.0

    def segments(self, text: str) -> tuple[int, list[tuple[int, int, float]]]:
        words = WORD.findall(text.lower())
        hits = list(map(self.scores.get, words))
        steps = [(i, s) for i, s in enumerate(hits) if s is not None] if any(hits) else []
        return len(words), maximal_segments(steps, len(words), DRIFT)

    def expected(self, score: float, n: int) -> float:
        """Segments of at least this score that chance gives in n words."""
        return self.scale * max(n, 1) * math.exp(-self.decay * score)

    def evidence(self, n: int, segments: list) -> float:
        """Sum over the significant segments of how far below the bound chance expects them, on a log scale."""
        return sum(max(0.0, math.log(SIGNIFICANT) - math.log(self.scale * max(n, 1)) + self.decay * s) for _, _, s in segments)

    def probability(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, self.bias + self.weight * math.log1p(evidence)))))


def decay_of(scores: np.ndarray, weights: np.ndarray) -> float:
    """The positive root of E[exp(x * score)] = 1 for words drawn from clean text, by bisection; 1 if nothing there scores above 0."""
    if not (scores[weights > 0] > 0).any() or (scores * weights).sum() >= 0:
        return 1.0
    p, low, high = weights / weights.sum(), 0.0, 1.0
    grown = lambda x: float((p * np.exp(np.minimum(x * scores, 500))).sum()) - 1
    while grown(high) < 0 and high < 64:
        low, high = high, high * 2
    for _ in range(60):
        mid = (low + high) / 2
        low, high = (mid, high) if grown(mid) < 0 else (low, mid)
    return high


def calibrated(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Weight and bias of a ridge-regularised logistic regression on one feature, by Newton's method."""
    a = np.stack([x, np.ones(len(x))], 1)
    w = np.zeros(2)
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a @ w, -30, 30)))
        g = a.T @ (p - y) + 0.1 * w
        h = a.T @ (a * (p * (1 - p))[:, None]) + 0.1 * np.eye(2)
        w = w - np.linalg.solve(h, g)
    return float(max(w[0], 0.0)), float(w[1])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model | None:
    """A model from labelled rows of the training fold (crc32(id) mod 4 isn't 2), or None if a class is missing.

    Equal texts of the sample count once; one that is labelled both ways is toxic. Null texts, ids without a text, and labels
    other than 0 and 1 teach nothing; an id with both labels is toxic.
    """
    spark = docs.sparkSession
    known = labels.where((remainder(id_col, 4) != 2) & F.col(label_col).isin(0, 1)).groupBy(F.col(id_col).alias("doc_id")).agg(F.max(label_col).cast("int").alias("y"))
    # Each class has SAMPLE ids at most, so the ids may be broadcast.
    chosen = [durable(known.where(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE), "sample") for y in (0, 1)]
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).where("text is not null")
    sample = durable(texts.join(F.broadcast(chosen[0].union(chosen[1])), "doc_id").groupBy("text").agg(F.min("doc_id").alias("doc_id"), F.max("y").alias("y")), "sample")
    sizes = {r.y: r.n for r in sample.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if set(sizes) != {0, 1}:
        return None

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                got: dict[str, list[int]] = {}
                for text, y in zip(column(batch, "text").to_pylist(), column(batch, "y").to_pylist(), strict=True):
                    all_words = WORD.findall(text.lower())
                    for w in set(all_words):
                        got.setdefault(w, [0, 0, 0])[y] += 1
                    if not y:
                        for w in all_words:
                            got[w][2] += 1
                yield pa.RecordBatch.from_arrays([pa.array(list(got), pa.string()), *[pa.array([v[k] for v in got.values()], pa.int64()) for k in range(3)]], ["word", "d0", "d1", "c0"])

    counts = sample.mapInArrow(words, "word string, d0 long, d1 long, c0 long").groupBy("word").agg(*[F.sum(c).alias(c) for c in ("d0", "d1", "c0")])
    counts = durable(counts, "words")
    total = counts.agg(F.sum("c0")).first()[0] or 1
    # Dirichlet prior: PRIOR texts with the word frequencies of the whole sample.
    n0, n1 = sizes[0], sizes[1]
    seen = counts.withColumn("prior", F.lit(PRIOR) * (F.col("d0") + F.col("d1")) / F.lit(float(n0 + n1)))
    a, b = F.col("d1") + F.col("prior"), F.col("d0") + F.col("prior")
    odds = F.log(a / (F.lit(n1 + PRIOR) - a)) - F.log(b / (F.lit(n0 + PRIOR) - b))
    likelier = seen.where(F.col("d0") + F.col("d1") >= LEAST_TEXTS).withColumn("s", odds - 2 * F.sqrt(1 / a + 1 / b)).where("s > 0.5")
    found = {r.word: r for r in likelier.orderBy(F.desc("s"), "word").limit(VOCABULARY).collect()}
    candidates = spark.sparkContext.broadcast(set(found))

    def contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                got = set()
                for text in column(batch, "text").to_pylist():
                    w = ["", *WORD.findall(text.lower()), ""]
                    got |= {(w[i], xxhash.xxh64_intdigest(f"{w[i - 1]} {w[i + 1]}") >> 1) for i in range(1, len(w) - 1) if w[i] in candidates.value}
                yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in got], pa.string()), pa.array([x for _, x in got], pa.int64())], ["word", "context"])

    # Near copies repeat a word among the same neighbours. Such texts are one witness: a word has no more of them than it has pairs of neighbours.
    pairs = sample.where("y = 1").mapInArrow(contexts, "word string, context long").distinct().groupBy("word").agg(F.count("*").alias("n"))
    rows = []
    for r in pairs.collect():
        f = found[r.word]
        d1 = min(f.d1, r.n)
        a, b = d1 + f.prior, f.d0 + f.prior
        score = math.log(a / (n1 + PRIOR - a)) - math.log(b / (n0 + PRIOR - b)) - 2 * math.sqrt(1 / a + 1 / b)
        if d1 >= LEAST_TEXTS and score > 0.5:
            rows.append((r.word, score, f.c0))
    rows = [Row(word=w, s=x, c0=c) for w, x, c in sorted(rows)]
    model = Model({r.word: r.s - DRIFT for r in rows})
    s = np.array([r.s - DRIFT for r in rows] + [-DRIFT])
    weights = np.array([float(r.c0) for r in rows] + [float(max(1, total - sum(r.c0 for r in rows)))])
    model.decay = decay_of(s, weights)
    shared = spark.sparkContext.broadcast(model)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for batch in slices(whole):
                found = [shared.value.segments(t) for t in column(batch, "text").to_pylist()]
                yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), column(batch, "y"), pa.array([n for n, _ in found], pa.int64()), pa.array([[s for _, _, s in x] for _, x in found], pa.list_(pa.float64()))], ["doc_id", "y", "n", "s"])

    rows = sorted(sample.mapInArrow(best, "doc_id long, y int, n long, s array<double>").collect(), key=lambda r: (r.y, r.n, r.s))
    # Scale: chance gives the best segment of clean texts a Gumbel law with mode log(K n) / decay; its mean lies Euler's constant above.
    top = [model.decay * max(r.s) - math.log(max(r.n, 1)) for r in rows if not r.y and r.s]
    clean = sum(not r.y for r in rows)
    if top:
        # Texts without any segment are below all others: the share that has one thins the law.
        model.scale = max(1e-9, math.exp(float(np.median(top)) - 0.5772) * len(top) / clean)
    else:
        model.scale = 1 / max(1, clean)
    x = np.array([math.log1p(model.evidence(r.n, [(0, 0, s) for s in r.s])) for r in rows])
    model.weight, model.bias = calibrated(x, np.array([float(r.y) for r in rows]))
    return model


def passages(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, first, end, score, expected, text of every significant passage; words first to end (exclusive) of the text."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for batch in slices(whole):
                who, out = [], []
                for k, text in enumerate(column(batch, "text").to_pylist()):
                    n, segments = model.segments(text)
                    good = [x for x in segments if model.expected(x[2], n) <= SIGNIFICANT]
                    spans = [m.span() for m in WORD.finditer(text)] if good else []
                    for a, b, s in good:
                        who.append(k)
                        out.append((a, b, s, model.expected(s, n), text[spans[a][0] : spans[b - 1][1]] if b <= len(spans) else ""))
                cols = list(zip(*out, strict=True)) or [[]] * 5
                kinds = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.string())
                yield pa.RecordBatch.from_arrays([column(batch, "doc_id").take(pa.array(who, pa.int64())), *[pa.array(c, t) for c, t in zip(cols, kinds, strict=True)]], ["doc_id", "first", "end", "score", "expected", "text"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, first long, end long, score double, expected double, text string")


def score_texts(docs: DataFrame, model: Model | None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, score, predicted, n_passages of each row. Null and empty texts have no passage and the score of such texts; without a model every score is 0."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for whole in batches:
            for batch in slices(whole):
                score, count = [], []
                for text in column(batch, "text").to_pylist():
                    n, segments = model.segments(text) if model else (0, [])
                    score.append(model.probability(model.evidence(n, segments)) if model else 0.0)
                    count.append(sum(model.expected(s, n) <= SIGNIFICANT for _, _, s in segments))
                yield pa.RecordBatch.from_arrays([column(batch, "doc_id"), pa.array(score, pa.float64()), pa.array([int(s >= CUT) for s in score], pa.int32()), pa.array(count, pa.int64())], ["doc_id", "score", "predicted", "n_passages"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double, predicted int, n_passages long")


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, score, predicted, n_passages of each row of docs. Ids only decide the fold; a null id isn't held out."""
    scored = score_texts(docs, fit(docs, labels, id_col, text_col), id_col, text_col)
    return scored.select("doc_id", F.coalesce(remainder("doc_id", 4) == 2, F.lit(False)).alias("held_out"), "score", "predicted", "n_passages")
