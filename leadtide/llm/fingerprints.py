"""Quartile bucket digests of documents.

In every window of five bytes the six triplets that hold its first byte are hashed into 256
buckets.  A digest tells for each bucket in which quarter of all counts its count lies (two
bits), and the length on a logarithmic scale.  Two digests differ by the sum of the steps
between quarters, the farthest step weighing double, and of the steps in length; the
likeness falls from 1 at no difference to 0 at ``BOUND`` and beyond.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from leadtide.llm.common import pieces, row_key, stored

BUCKETS = 256
#: Unrelated digests differ by about this much: 1.6 for each bucket.
BOUND = 416
LENGTH_STEP = 2
BATCH_BYTES = 4 << 20
_TRIPLETS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
_TABLES = np.stack([np.random.default_rng(k).permutation(256) for k in range(13)]).astype(np.uint8)
_STEPS = np.array([0, 1, 2, 6])


def digest(raw: bytes) -> bytes:
    """65 bytes: the length, and the quarters of the 256 buckets; of equal bytes equal."""
    bytes_ = np.frombuffer(raw, np.uint8)
    counts = np.zeros(BUCKETS, np.int64)
    for first in range(0, max(0, len(bytes_) - 4), 1 << 20):  # bounded memory for long texts
        part = bytes_[first : first + (1 << 20) + 4]
        n = len(part) - 4
        lead = _TABLES[0][part[:n]]
        for k, (i, j) in enumerate(_TRIPLETS):
            bucket = lead ^ _TABLES[1 + k][part[i : i + n]]
            bucket ^= _TABLES[7 + k][part[j : j + n]]
            counts += np.bincount(bucket, minlength=BUCKETS)
    ordered = np.sort(counts)
    quarters = ordered[[63, 127, 191]]
    code = (counts[:, None] > quarters).sum(axis=1).astype(np.uint8)
    packed = code[0::4] | code[1::4] << 2 | code[2::4] << 4 | code[3::4] << 6
    length = min(255, int(10 * np.log1p(len(raw))))
    return bytes([length]) + packed.astype(np.uint8).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    """From 0 (BOUND or more apart) to 1 (equal)."""
    if a == b:
        return 1.0
    x, y = np.frombuffer(a, np.uint8), np.frombuffer(b, np.uint8)
    far = LENGTH_STEP * abs(int(x[0]) - int(y[0]))
    for shift in (0, 2, 4, 6):
        far += int(_STEPS[np.abs((x[1:] >> shift & 3).astype(np.int8) - (y[1:] >> shift & 3).astype(np.int8))].sum())
    return 1.0 - min(far, BOUND) / BOUND


def edited(text: str, next_text: str) -> str:
    """The last third of the text replaced by as much of the next one's beginning, or all of it."""
    third = len(text) // 3
    return text[: len(text) - third] + next_text[:third]


_RESULT = ("n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next")
_SCHEMA = (
    "part int, kind int, doc_id long, text string, n_chars long, edited_sha256 string, "
    "fingerprint string, edited_fingerprint string, near_edited double, near_next double"
)


def _row(text: str, own: bytes, next_text: str, next_digest: bytes) -> tuple:
    changed = edited(text, next_text).encode()
    of_changed = digest(changed)
    return (
        len(text), hashlib.sha256(changed).hexdigest(), own.hex(), of_changed.hex(),
        likeness(own, of_changed), likeness(own, next_digest),
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string(),
             pa.float64(), pa.float64())
    return pa.RecordBatch.from_arrays(
        [pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)],
        ["part", "kind", "doc_id", "text", *_RESULT],
    )


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next.

    The next document is the one of the next smaller doc_id, after the smallest the largest;
    rows that repeat a doc_id follow each other by a hash of their text, and null doc_ids come
    last.  Null texts count as empty.  One row out for each row in; a table of one row is its
    own next.  Only doc_id and text are read.

    Rows are range-partitioned by doc_id, so that all but the last row of a partition find
    their next in the same task; the first and last rows of partitions meet in a small join.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"), "text")
    order = F.col("doc_id").desc_nulls_last()
    ranged = rows.repartitionByRange(order).sortWithinPartitions(order, "key").select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        before = None  # doc_id, text and digest of the row before
        none = (None,) * len(_RESULT)
        for batch in pieces(batches, BATCH_BYTES):
            out = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist()):
                text = text or ""
                own = digest(text.encode())
                if before is None:
                    out.append((part, 1, doc, text, *none))
                else:
                    out.append((part, 0, before[0], None, *_row(*before[1:], text, own)))
                before = (doc, text, own)
            yield _batch(out)
        if before is not None:
            yield _batch([(part, 2, *before[:2], *none)])

    found = stored(ranged.mapInArrow(run, _SCHEMA), "fingerprints")
    heads = found.where("kind = 1").select("part", F.col("text").alias("next_text"))
    parts = sorted(r[0] for r in heads.select("part").collect())  # one number for each partition
    after = dict(zip(parts, parts[1:] + parts[:1]))
    tails = found.where("kind = 2")
    following = docs.sparkSession.createDataFrame(sorted(after.items()), "part int, next_part int")
    pairs = (
        tails.join(following, "part").join(heads.withColumnRenamed("part", "next_part"), "next_part")
        .select("part", "kind", "doc_id", "text", "next_text")
    )

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield _batch([
                (part, kind, doc, None, *_row(text, digest(text.encode()), after, digest(after.encode())))
                for part, kind, doc, text, after in zip(*(c.to_pylist() for c in batch.columns))
            ])

    return found.where("kind = 0").union(pairs.mapInArrow(join, _SCHEMA)).select("doc_id", *_RESULT)
