"""Helpers the corpus operators share."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F


#: What batches of a task bring beside their buckets goes to groups so far apart.
STRIDE = 7919


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors reach; a local session without one (as in tests) gets its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        folder = tempfile.mkdtemp(prefix="corpus-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table below the shared folder and read it back, so that nothing above runs again."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """128 bits that tell rows apart which repeat a doc_id; rows equal in both columns share them."""
    kind = F.when(F.col(text).isNull(), "n").otherwise("t")
    parts = [F.coalesce(F.col(doc_id).cast("string"), F.lit("")), kind, F.coalesce(F.col(text), F.lit(""))]
    return F.unhex(F.md5(F.concat(*parts)))


def sheltered(docs: DataFrame, *used: str) -> DataFrame:
    """The columns ``used``, and all others as fields of the column _rest, where no name can clash."""
    rest = [F.col("`" + c.replace("`", "``") + "`").alias(c) for c in docs.columns if c not in used]
    return docs.select(*used, (F.struct(*rest) if rest else F.lit(None).cast("string")).alias("_rest"))


def restored(df: DataFrame, docs: DataFrame, *used: str) -> list[Column]:
    """The columns of ``docs`` in their order, from what ``sheltered`` made of them."""
    return [df[c] if c in used else df["_rest"].getField(c).alias(c) for c in docs.columns]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in a row, and where each begins (one more entry than texts)."""
    texts = column.cast(pa.large_binary()).fill_null(b"")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], most: int, column: str = "text") -> Iterator[pa.RecordBatch]:
    """Cut batches so that each holds at most ``most`` bytes of text, or one longer text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, starts = text_bytes(batch.column(column))
        first = 0
        while first < batch.num_rows:
            last = int(np.searchsorted(starts, starts[first] + most, "right")) - 1
            last = max(first + 1, last)
            yield batch.slice(first, last - first)
            first = last


def once(batch: pa.RecordBatch) -> pa.RecordBatch:
    """The batch without rows that repeat a key (which doc_id and text give)."""
    first: dict[bytes, int] = {}
    for i, key in enumerate(batch.column("key").to_pylist()):
        first.setdefault(key, i)
    return batch if len(first) == batch.num_rows else batch.take(pa.array(first.values(), pa.int64()))


def sums_by_row(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sum of the values of each row; starts has one more entry than rows."""
    total = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return total[starts[1:]] - total[starts[:-1]]


def fit_logistic(
    x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, steps: int = 300, own: bool = False
) -> tuple[np.ndarray, float]:
    """L2-regularised logistic regression by accelerated gradient descent on scaled columns.

    ``own`` lets it work in ``x`` itself, without a copy."""
    n = len(y)
    if n == 0 or y.min() == y.max():
        rate = (float(y.sum()) + 1) / (n + 2)
        return np.zeros(x.shape[1]), float(np.log(rate / (1 - rate)))
    z = x.astype(np.float32, copy=not own)
    mean = z.mean(axis=0)
    z -= mean
    scale = np.sqrt(np.einsum("ij,ij->j", z, z) / np.float32(n))
    scale[scale == 0] = np.inf
    z /= scale
    limit = 0.25 * float(np.linalg.norm(z, axis=1).max() ** 2)
    spread = np.ones(z.shape[1], np.float32)
    for _ in range(12):  # the largest curvature, by power iteration
        spread = z.T @ (z @ spread)
        spread /= np.linalg.norm(spread) + 1e-12
    limit = min(limit, 0.26 * float(np.linalg.norm(z @ spread) ** 2) / n + 0.25) + penalty
    w, b = np.zeros(z.shape[1], np.float32), 0.0
    w0, b0 = w, b
    for k in range(steps):
        pull = k / (k + 3)
        v, c = w + pull * (w - w0), b + pull * (b - b0)
        error = 1 / (1 + np.exp(-np.clip(z @ v + c, -30, 30))) - y
        w0, b0 = w, b
        w, b = v - (z.T @ error / n + penalty * v) / limit, c - float(error.mean()) / limit
    weights = w / scale
    return weights, b - float(mean @ weights)


def examples(docs: DataFrame, chosen: DataFrame) -> DataFrame:
    """(doc_id, text, the columns of ``chosen``) of a bounded set of documents, unique by doc_id.

    A doc_id that ``docs`` repeats gives one row, with its least text, so the bound holds.
    """
    found = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
    return found.groupBy("doc_id", *[c for c in chosen.columns if c != "doc_id"]).agg(F.min("text").alias("text"))


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def split_of(doc_id: Column) -> Column:
    """crc32 of the doc_id as text, modulo 4; 2 marks the rows held out of all learning."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)), F.lit(0)).cast("int")


def byte_runs(
    raw: np.ndarray, starts: np.ndarray, inside: np.ndarray, cut: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes that the table ``inside`` (256 flags) marks, as (row, begin, end).

    No run goes across rows, nor across a place where ``cut`` (a flag for each byte) tells to begin anew.
    """
    keep = np.zeros(len(raw) + 2, bool)
    keep[1:-1] = inside[raw]
    anew = np.zeros(len(raw) + 1, bool)
    if cut is not None:
        anew[:-1] = cut
    anew[starts] = True
    begin = np.flatnonzero(keep[1:-1] & (~keep[:-2] | anew[:-1]))
    end = np.flatnonzero(keep[1:-1] & (~keep[2:] | anew[1:])) + 1
    return np.searchsorted(starts, begin, "right") - 1, begin, end


def spread_ranges(begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All positions of the ranges that begin at ``begin``, one range after the other."""
    ends = np.cumsum(length)
    total = int(ends[-1]) if len(ends) else 0
    return np.repeat(begin - ends + length, length) + np.arange(total)


def strings_at(raw: np.ndarray, begin: np.ndarray, length: np.ndarray) -> pa.Array:
    """The strings whose UTF-8 bytes lie at the given ranges."""
    offsets = np.concatenate([[0], np.cumsum(length)]).astype(np.int64)
    held = np.ascontiguousarray(raw[spread_ranges(begin, length)])
    return pa.Array.from_buffers(pa.large_string(), len(begin), [None, pa.py_buffer(offsets), pa.py_buffer(held)])


def lower_ascii(raw: np.ndarray) -> np.ndarray:
    """A copy with the bytes A-Z in lower case."""
    return raw + ((raw >= 65) & (raw <= 90)).astype(np.uint8) * np.uint8(32)
