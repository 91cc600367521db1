"""Quality rules: counts that reject at once, then a calibrated classifier on hashed n-grams.

The classifier is logistic regression on the relative frequencies of hashed word 1-grams,
word 2-grams and character 3-grams, fitted on a bounded sample of labelled rows and calibrated
(Platt) on a quarter of the sample that the fit has not seen.  No n-gram reaches from one text
into another, so a verdict does not depend on the rows beside it.  Rows are scored in Arrow
batches, vectorised over all texts of a batch.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from leadtide.llm.common import examples, fit_logistic, pieces, restored, sheltered, sigmoid, split_of, sums_by_row, text_bytes

#: Most labelled rows the classifier is fitted on, taken in the order of a hash of doc_id.
SAMPLE_ROWS = 4000
#: Hash slots of each kind of n-gram.
SLOTS = 2048
#: Rejected below this calibrated probability of good quality.
LEAST_PROBABILITY = 0.5
#: A document needs so many words, and at most this share of them in repeated windows.
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
SYMBOLS = b"#*$%&|<>"
BATCH_BYTES = 2 << 20

_SPACE = np.zeros(256, bool)
_SPACE[list(b" \t\n\r\x0b\x0c")] = True
_MIX = np.random.default_rng(5).integers(0, 1 << 32, (32, 256), dtype=np.uint32)


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # one for each slot
    bias: float
    slope: float  # of the calibration
    shift: float

    def probability(self, margin: np.ndarray) -> np.ndarray:
        return sigmoid(self.slope * margin + self.shift)


def _following(items: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Each item's next one in its text; 0 after the last."""
    out = np.zeros_like(items)
    out[:-1] = items[1:]
    out[starts[1:][np.diff(starts) > 0] - 1] = 0
    return out


def _characters(raw: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of each code point as one number, and each row's first code point."""
    if not (raw > 127).any():
        return raw.astype(np.uint32), starts
    at = np.flatnonzero(raw & 0xC0 != 0x80)
    length = np.diff(at, append=len(raw))
    chars = raw[at].astype(np.uint32)
    for k in (1, 2, 3):
        longer = np.flatnonzero(length > k)
        chars[longer] |= raw[at[longer] + k].astype(np.uint32) << np.uint32(8 * k)
    return chars, np.searchsorted(at, starts)


def _slots(raw: np.ndarray, starts: np.ndarray) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each kind of n-gram: the slot of every n-gram, and each row's first n-gram."""
    out = []
    inside = ~_SPACE[raw]
    head = inside.copy()
    head[1:] &= ~inside[:-1]
    cuts = starts[:-1][starts[:-1] < len(raw)]
    head[cuts] |= inside[cuts]  # a text's first word does not go on from the text before
    first = np.flatnonzero(head)
    where = np.arange(len(raw))
    begun = np.zeros(len(raw), np.int64)
    begun[first] = first
    begun = np.maximum.accumulate(begun) if len(raw) else begun
    mixed = np.where(inside, _MIX[(where - begun) & 31, raw], 0).astype(np.uint32)
    words = np.add.reduceat(mixed, first, dtype=np.uint32) if len(first) else np.zeros(0, np.uint32)
    of_row = np.searchsorted(first, starts)
    shift = np.uint32(32 - SLOTS.bit_length() + 1)
    out.append((words * np.uint32(0x9E3779B1) >> shift, of_row))
    pairs = words * np.uint32(0x85EBCA6B) + _following(words, of_row)
    out.append(((pairs * np.uint32(0x9E3779B1) >> shift) + np.uint32(SLOTS), of_row))
    chars, of_char = _characters(raw, starts)
    second = _following(chars, of_char)
    grams = (chars * np.uint32(0x85EBCA6B) + second) * np.uint32(0xC2B2AE35) + _following(second, of_char)
    out.append(((grams * np.uint32(0x9E3779B1) >> shift) + np.uint32(2 * SLOTS), of_char))
    return out


def margins(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    """The weighted n-gram frequencies of each text, without the bias."""
    total = np.zeros(len(texts))
    for slots, starts in _slots(*text_bytes(texts)):
        total += sums_by_row(weights[slots], starts) / np.maximum(np.diff(starts), 1)
    return total


def sparse(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """The slots each text uses, and its n-gram frequencies there."""
    kinds = _slots(*text_bytes(texts))
    for i in range(len(texts)):
        row = np.zeros(3 * SLOTS, np.float32)
        for slots, starts in kinds:
            own = slots[starts[i] : starts[i + 1]]
            if len(own):
                row += np.bincount(own, minlength=3 * SLOTS) / np.float32(len(own))
        used = np.flatnonzero(row).astype(np.uint16)
        yield used, row[used]


def dense(rows: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    out = np.zeros((len(rows), 3 * SLOTS), np.float32)
    for own, (slots, values) in zip(out, rows):
        own[slots] = values
    return out


def features(texts: pa.Array) -> np.ndarray:
    return dense(list(sparse(texts)))


def counts(text: str) -> tuple[int, int, int, int, int]:
    """n_words, word_chars, n_symbols, n_dup_lines and n_repeat_words of a text."""
    raw = text.encode()
    words = raw.split()
    word_chars = len(text) - sum(raw.count(c) for c in b" \t\n\r\x0b\x0c")
    symbols = sum(raw.count(c) for c in SYMBOLS)
    lines = [line for line in raw.split(b"\n") if line.strip()]
    windows = list(zip(words, words[1:], words[2:]))
    repeated = 0
    if len(set(windows)) < len(windows):
        times = Counter(windows)
        covered = bytearray(len(words))
        for i, window in enumerate(windows):
            if times[window] > 1:
                covered[i : i + 3] = b"\1\1\1"
        repeated = sum(covered)
    return len(words), word_chars, symbols, len(lines) - len(set(lines)), repeated


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, held_back: bool = False) -> Model:
    """Fit and calibrate on at most ``sample_rows`` labelled rows (runs a job).

    Rows without doc_id or quality are no examples.  Of a doc_id labelled twice the lower
    label counts.  ``held_back`` leaves out the rows that ``split_of`` marks, for measuring.
    """
    chosen = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    if held_back:
        chosen = chosen.where(split_of(F.col("doc_id")) != 2)
    chosen = (
        chosen.groupBy("doc_id").agg(F.min("quality").alias("quality"))
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    )

    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, BATCH_BYTES):
            slots, values = zip(*sparse(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("quality").cast(pa.int32()),
                 pa.array([s.tobytes() for s in slots], pa.binary()), pa.array([v.tobytes() for v in values], pa.binary())],
                ["doc_id", "quality", "slots", "freqs"],
            )

    rows = (
        examples(docs, chosen).select("doc_id", "quality", "text")
        # bounded by sample_rows; a row has at most 3 * SLOTS slots
        .mapInArrow(grams, "doc_id long, quality int, slots binary, freqs binary").toArrow()
    )
    order = np.argsort(rows["doc_id"].to_numpy())  # unique
    y = rows["quality"].to_numpy().astype(np.float32)[order]
    late = np.arange(len(y)) % 4 == 3

    def chosen_rows(at: np.ndarray) -> np.ndarray:
        return dense([
            (np.frombuffer(rows["slots"][i].as_buffer(), np.uint16), np.frombuffer(rows["freqs"][i].as_buffer(), np.float32))
            for i in at.tolist()
        ])

    weights, bias = fit_logistic(chosen_rows(order[~late]), y[~late], own=True)
    margin = chosen_rows(order[late]) @ weights + bias
    slope, shift = fit_logistic(margin[:, None], y[late], 1e-4)
    return Model(weights.astype(np.float32), bias, float(slope[0]), shift)


def judge(docs: DataFrame, model: Model, least_probability: float = LEAST_PROBABILITY) -> DataFrame:
    """The docs with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
    probability and kept.  Columns of those names in ``docs`` are replaced.

    One row out for each row in, repeated rows too.  A null or empty text has no words and
    fails the base rules.  Only ``text`` is read; nulls elsewhere do not matter.
    """
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    added = [*names, "base_failed", "probability", "kept"]
    others = docs.drop(*added)
    wide = sheltered(others, "text")
    schema = StructType([
        *wide.schema.fields, *[StructField(n, LongType()) for n in names],
        StructField("base_failed", BooleanType()), StructField("probability", DoubleType()),
        StructField("kept", BooleanType()),
    ])

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, BATCH_BYTES):
            texts = batch.column("text")
            found = np.array([counts(t or "") for t in texts.to_pylist()], np.int64).reshape(-1, 5)
            n_words, repeated = found[:, 0], found[:, 4]
            failed = (n_words < LEAST_WORDS) | (100 * repeated > MOST_REPEATED_PERCENT * n_words)
            p = model.probability(margins(texts, model.weights) + model.bias)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(c) for c in found.T],
                 pa.array(failed), pa.array(p), pa.array(~failed & (p >= least_probability))],
                [*batch.schema.names, *added],
            )

    judged = wide.mapInArrow(score, schema)
    return judged.select(*restored(judged, others, "text"), *added)


def quality_rules(docs: DataFrame, labels: DataFrame, least_probability: float = LEAST_PROBABILITY) -> DataFrame:
    """Fit on the labelled rows and judge every document; see ``fit`` and ``judge``."""
    return judge(docs, fit(docs, labels), least_probability)
