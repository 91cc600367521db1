"""Toxic passages: maximal-scoring segments over token log-odds, with extreme-value calibration.

Tokens are words and, for words never seen, their first letters.  A token's score is the log
of how much more often it stands in toxic documents, under an informative Dirichlet prior
drawn from all labelled documents, brought nearer to zero by one standard error, less a constant,
so that the mean score is negative.  Words of clean documents score below that constant, mild
ones between it and zero.  A linear scan finds every maximal-scoring segment of a text.  Segment
scores follow an extreme-value distribution; lambda and K, fitted to clean documents, turn a
segment's score and the text's length into an expected number of chance segments (E), and
segments of E below a bound are significant.  The -log E of these, summed, and of the best
segment, give the document's score by logistic calibration.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from leadtide.llm.common import examples, fit_logistic, pieces, sigmoid, split_of

#: Most labelled rows the scores and the calibration are fitted on, in the order of a hash of doc_id.
SAMPLE_ROWS = 12_000
#: Weight of the prior in documents: its part by the token's share, and its part for every token.
PRIOR, EVEN_PRIOR = 4.0, 0.5
#: What every token's score is lowered by; a word of which nothing is known scores minus this.
DRIFT = 1.5
#: Documents a token must stand in to have a score of its own.
LEAST_DOCUMENTS = 3
#: Numbers of first letters that stand for a word that is not known; the first known ones count.
PREFIXES = (6, 5, 4)
#: Expected chance segments in a text up to which a segment is significant.
MOST_EXPECTED = 0.5
THRESHOLD = 0.3
BATCH_BYTES = 4 << 20
_WORD = re.compile(r"[^\W\d_]+")
_EULER = 0.5772156649


@dataclass(frozen=True)
class Model:
    words: dict[str, float]
    prefixes: dict[str, float]
    rate: float  # lambda of the extreme-value distribution
    size: float  # log K
    weights: tuple[float, float, float]  # of the calibration: sum, best, bias

    def scores(self, text: str) -> list[float]:
        """The score of each word of the text."""
        words, prefixes = self.words, self.prefixes
        out = []
        for word in _WORD.findall(text.lower()):
            score = words.get(word)
            if score is None:
                score = -DRIFT
                for letters in PREFIXES:
                    if len(word) > letters and (known := prefixes.get(word[:letters])) is not None:
                        score = known
                        break
            out.append(score)
        return out

    def measures(self, text: str) -> tuple[float, float, list[tuple[int, int, float]]]:
        """The sum and the largest of -log E over the significant segments, and these segments."""
        scores = self.scores(text)
        total = best = 0.0
        significant = []
        for first, last, score in segments(scores):
            surprise = self.rate * score - self.size - math.log(max(len(scores), 1))  # -log E
            if surprise >= -math.log(MOST_EXPECTED):
                total += surprise
                best = max(best, surprise)
                significant.append((first, last, surprise))
        return total, best, significant


def segments(scores: list[float]) -> list[tuple[int, int, float]]:
    """(first word, last word, score) of all maximal-scoring segments, in one pass.

    The list of candidates holds for each the running total before and after it; a new one joins
    the last that began lower, if its end is higher than that one's, and else stands alone.
    """
    stack: list[list] = []  # first word, last word, total before, total after, previous of lower start
    total = 0.0
    for number, score in enumerate(scores):
        before = total
        total += score
        if score <= 0:
            continue
        first = number
        while True:
            k = len(stack) - 1
            while k >= 0 and stack[k][2] >= before:
                k = stack[k][4]
            if k < 0 or stack[k][3] >= total:
                stack.append([first, number, before, total, k])
                break
            first, before = stack[k][0], stack[k][2]
            del stack[k:]
    return [(s[0], s[1], s[3] - s[2]) for s in stack]


def _tokens(text: str) -> set[str]:
    words = set(_WORD.findall(text.lower()))
    return words.union(w[:n] + "*" for n in PREFIXES for w in words if len(w) > n)


def _log_odds(counts: Counter, toxic: Counter, n_toxic: int, n: int, drift: float) -> dict[str, float]:
    """Scores by token from document counts; the prior has a token's share in all documents.

    Log-odds that lie within a standard error of zero count as zero."""
    out = {}
    for token, all_ in counts.items():
        share = (all_ + 0.5) / (n + 1)
        a, b = PRIOR * share + EVEN_PRIOR, PRIOR * (1 - share) + EVEN_PRIOR
        yes, no = toxic[token] + a, n_toxic - toxic[token] + b
        clean, rest = all_ - toxic[token] + a, n - n_toxic - all_ + toxic[token] + b
        odds = math.log(yes / no) - math.log(clean / rest)
        out[token] = math.copysign(max(abs(odds) - math.sqrt(1 / yes + 1 / clean), 0.0), odds) - drift
    return out


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from at most ``sample_rows`` labelled rows outside the held-out quarter (runs two jobs).

    Rows without doc_id or toxic are no examples; of a doc_id labelled twice the higher label counts.
    """
    chosen = (
        labels.where(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).where(split_of(F.col("doc_id")) != 2)
        .groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
        .withColumn("late", F.pmod(F.xxhash64("doc_id", F.lit(9)), F.lit(3)) == 0)
    )
    rows = examples(docs, chosen).where(F.col("text").isNotNull())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        every: Counter[str] = Counter({"": 0})
        toxic: Counter[str] = Counter()
        for batch in pieces(batches, BATCH_BYTES):
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                tokens = _tokens(text) | {""}  # the empty token counts documents
                every.update(tokens)
                if label == 1:
                    toxic.update(tokens)
        yield pa.RecordBatch.from_arrays(
            [pa.array(every.keys(), pa.string()), pa.array(every.values(), pa.int64()),
             pa.array([toxic[t] for t in every], pa.int64())],
            ["token", "n", "n_toxic"],
        )

    counted = (
        rows.where("not late").select("text", "toxic").mapInArrow(count, "token string, n long, n_toxic long")
        .groupBy("token").agg(F.sum("n").alias("n"), F.sum("n_toxic").alias("n_toxic"))
        .where((F.col("token") == "") | (F.col("n") >= LEAST_DOCUMENTS)).toArrow()  # bounded by the sample
    )
    every = Counter(dict(zip(counted["token"].to_pylist(), counted["n"].to_pylist())))
    toxic = Counter(dict(zip(counted["token"].to_pylist(), counted["n_toxic"].to_pylist())))
    n, n_toxic = every.pop("", 0), toxic.pop("", 0)
    scores = _log_odds(every, toxic, n_toxic, n, DRIFT)
    words = {t: s for t, s in scores.items() if not t.endswith("*")}
    prefixes = {t[:-1]: s for t, s in scores.items() if t.endswith("*")}
    draft = Model(words, prefixes, 1.0, 0.0, (0.0, 0.0, 0.0))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, BATCH_BYTES):
            rows = []
            for text, label in zip(batch.column("text").to_pylist(), batch.column("toxic").to_pylist()):
                each = draft.scores(text)
                rows.append((int(label == 1), len(each), [s for *_, s in segments(each)]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
                 pa.array([r[2] for r in rows], pa.list_(pa.float64()))],
                ["toxic", "length", "scores"],
            )

    late = rows.where("late").select("text", "toxic").mapInArrow(
        scan, "toxic int, length long, scores array<double>"
    ).collect()  # bounded by the sample
    best = np.array([(max(r.scores), math.log(max(r.length, 1))) for r in late if r.toxic == 0 and r.scores])
    clean = [r for r in late if r.toxic == 0]
    if len(best) >= 10:
        # The clean documents without any segment are left out, so this errs to the cautious side.
        rate = math.pi / math.sqrt(6) / max(float((best[:, 0]).std()), 0.5)
        rate = min(rate, 2.0)
        share = math.log(len(best) / len(clean))
        size = rate * float(best[:, 0].mean()) - _EULER - float(best[:, 1].mean()) + share
    else:
        rate, size = 0.7, -6.0  # too few to fit: as on larger samples
    x = np.zeros((len(late), 2))
    for i, r in enumerate(late):
        found = [rate * s - size - math.log(max(r.length, 1)) for s in r.scores]
        found = [s for s in found if s >= -math.log(MOST_EXPECTED)]
        x[i] = np.log1p(sum(found)), np.log1p(max(found, default=0.0))
    y = np.array([r.toxic for r in late], float)
    weights, bias = fit_logistic(x, y, 1e-3, 500) if len(y) else (np.zeros(2), -2.0)
    return Model(words, prefixes, rate, size, (float(weights[0]), float(weights[1]), bias))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score, predicted and segments (first word, last word, -log E) of each row.

    One row out for each row in.  A null or empty text has no segment and the score that goes
    with none.  Only the text counts; doc_id is passed on, null or not.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, BATCH_BYTES):
            found = [model.measures(t or "") for t in batch.column("text").to_pylist()]
            x = np.log1p(np.array([(a, b) for a, b, _ in found]).reshape(-1, 2))
            a, b, bias = model.weights
            p = sigmoid(x[:, 0] * a + x[:, 1] * b + bias)
            kind = pa.struct([("first", pa.int64()), ("last", pa.int64()), ("surprise", pa.float64())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(p),
                 pa.array((p >= threshold).astype(np.int32)),
                 pa.array([[{"first": f, "last": e, "surprise": s} for f, e, s in r] for *_, r in found], pa.list_(kind))],
                ["doc_id", "held_out", "score", "predicted", "segments"],
            )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (split_of(F.col("doc_id")) == 2).alias("held_out"), "text"
    )
    return rows.mapInArrow(
        run,
        "doc_id long, held_out boolean, score double, predicted int, "
        "segments array<struct<first: long, last: long, surprise: double>>",
    )


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Fit on the labelled rows and score every document; see ``fit`` and ``score``."""
    return score(docs, fit(docs, labels), threshold)
