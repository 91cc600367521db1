"""Deduplication of content-defined chunks.

A gear hash rolls over the bytes of a text; a chunk ends where the top bits of the hash are
zero, so chunks find their ends again after insertions.  Chunks travel as packed records
(digest, document, start, length) by digest, each digest once from each batch; of equal
chunks all but the earliest go.  Those that a batch finds in itself need no comparison: they
travel beside the buckets, dealt over as many groups by task and batch.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from leadtide.llm.common import STRIDE, once, pieces, row_key, text_bytes

#: A chunk ends with one in 2 ** CUT_BITS bytes on average, and has LEAST to MOST bytes.
CUT_BITS, LEAST, MOST = 5, 32, 512
#: Text whose chunks meet in one task, and text taken at a time.
BUCKET_BYTES, BATCH_BYTES, HASH_BYTES = 24 << 20, 8 << 20, 1 << 20
_GEAR = np.random.default_rng(8).integers(0, 1 << 32, 256, dtype=np.uint32)
_RECORD = np.dtype([("high", "<u8"), ("low", "<u8"), ("doc", "<i4"), ("start", "<i8"), ("length", "<i4")])
_NONE = np.int64(2**63 - 1)  # a null doc_id comes last
SPANS = "doc_id long, key binary, starts array<long>, ends array<long>"


def gear(raw: np.ndarray) -> np.ndarray:
    """The hash after each byte, h = 2 * h + gear of the byte in 32 bits; so 32 bytes back count."""
    h = _GEAR[raw]
    for step in (1, 2, 4, 8, 16):
        if len(h) > step:
            h[step:] = h[step:] + (h[:-step] << np.uint32(step))
    return h


def cuts(ends: list[int], size: int, least: int = LEAST, most: int = MOST) -> list[int]:
    """Where the chunks of a text of ``size`` bytes end, from the places after which its hash
    cuts.  A rest shorter than ``least`` belongs to the chunk before it."""
    out = []
    start = 0
    for end in ends:
        while end - start > most:
            start += most
            out.append(start)
        if end - start >= least:
            out.append(end)
            start = end
    while size - start > most:
        start += most
        out.append(start)
    if start < size:
        if out and size - start < least:
            out[-1] = size
        else:
            out.append(size)
    return out


def _chunks(raw: np.ndarray, starts: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(text, start, end) of each chunk; places count from the start of ``raw``."""
    limit = np.uint32(1 << (32 - CUT_BITS))
    first = 0
    while first < len(starts) - 1:  # some texts at a time
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + HASH_BYTES, "right")) - 1)
        low = starts[first]
        part = raw[low : starts[last]]
        if len(part):
            # A text's hash must not hang on the text before: its first 32 bytes never cut,
            # since a chunk has 32 bytes at least and the hash reaches back no further.
            places = np.flatnonzero(gear(part) < limit) + 1 + low
            of = np.searchsorted(places, starts[first : last + 1], "right")
            places = places.tolist()
            for text in range(first, last):
                begin, end = int(starts[text]), int(starts[text + 1])
                at = 0
                own = [p - begin for p in places[of[text - first] : of[text - first + 1]]]
                for cut in cuts(own, end - begin):
                    yield text, begin + at, begin + cut
                    at = cut
        first = last


def _packed(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """Records of each batch: first ones by bucket (new), repeats with a negative bucket (old)."""
    from pyspark import TaskContext

    press = zstandard.ZstdCompressor(level=1)
    context = TaskContext.get()
    task = context.partitionId() if context else 0
    for turn, batch in enumerate(pieces(batches, BATCH_BYTES)):
        batch = once(batch)
        raw, starts = text_bytes(batch.column("text"))
        held = raw.tobytes()
        ids = batch.column("doc_id").fill_null(_NONE).to_numpy()
        keys = batch.column("key").to_pylist()
        rows = sorted(range(len(ids)), key=lambda i: (ids[i], keys[i]))
        rank = np.empty(len(rows), np.int64)
        rank[rows] = np.arange(len(rows))
        found = np.array(list(_chunks(raw, starts)), np.int64).reshape(-1, 3)
        digest = hashlib.blake2b
        digests = b"".join([digest(held[s:e], digest_size=16).digest() for s, e in found[:, 1:].tolist()])
        record = np.zeros(len(found), _RECORD)
        both = np.frombuffer(digests, "<u8").reshape(-1, 2)
        record["high"], record["low"] = both[:, 0], both[:, 1]
        record["doc"] = found[:, 0]
        record["start"] = found[:, 1] - starts[found[:, 0]]
        record["length"] = found[:, 2] - found[:, 1]
        order = np.lexsort((record["start"], rank[found[:, 0]], record["low"], record["high"]))
        record = record[order]
        again = np.zeros(len(record), bool)
        again[1:] = (record["high"][1:] == record["high"][:-1]) & (record["low"][1:] == record["low"][:-1])
        done, record = record[again], record[~again]
        bucket = (record["high"] % np.uint64(buckets)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        record, bucket = record[order], bucket[order]
        parts = np.split(record, np.flatnonzero(np.diff(bucket)) + 1) if len(record) else []
        out: list[list] = [[], [], [], [], []]
        sent = [(int(part["high"][0] % np.uint64(buckets)), part, done[:0]) for part in parts]
        if len(done):
            sent.append((-1 - (task + turn * STRIDE) % buckets, done[:0], done))
        for number, new, old in sent:
            docs, place = np.unique(np.concatenate([new["doc"], old["doc"]]), return_inverse=True)
            new, old = new.copy(), old.copy()
            new["doc"], old["doc"] = place[: len(new)], place[len(new) :]
            values = (
                ids[docs].tobytes(), b"".join([keys[d] for d in docs.tolist()]),
                b"".join([new[c].tobytes() for c in _RECORD.names]), b"".join([old[c].tobytes() for c in _RECORD.names]),
            )
            out[0].append(number)
            for column, value in zip(out[1:], values):
                column.append(press.compress(value))
        yield pa.RecordBatch.from_arrays(
            [pa.array(out[0], pa.int32()), *[pa.array(c, pa.binary()) for c in out[1:]]],
            ["bucket", "docs", "keys", "new", "old"],
        )


def _records(packed: bytes) -> np.ndarray:
    out = np.empty(len(packed) // _RECORD.itemsize, _RECORD)
    at = 0
    for name in _RECORD.names:
        size = len(out) * _RECORD[name].itemsize
        out[name] = np.frombuffer(packed[at : at + size], _RECORD[name])
        at += size
    return out


def _repeated(table: pa.Table) -> pa.Table:
    """The chunks of a bucket that are not the earliest of their digest, by document."""
    unpress = zstandard.ZstdDecompressor()
    ids, keys, new, old = [], [], [], []
    count = 0
    for row in zip(*(table[c].to_pylist() for c in ("docs", "keys", "new", "old"))):
        docs, key, fresh, known = (unpress.decompress(v) for v in row)
        for part, into in ((_records(fresh), new), (_records(known), old)):
            part["doc"] += count
            into.append(part)
        ids.append(np.frombuffer(docs, np.int64))
        keys.append(np.frombuffer(key, ">u8").reshape(-1, 2))
        count += len(ids[-1])
    ids, keys, new, old = np.concatenate(ids), np.concatenate(keys), np.concatenate(new), np.concatenate(old)
    by = np.lexsort((keys[:, 1], keys[:, 0], ids))
    fresh = np.ones(len(by), bool)
    fresh[1:] = (ids[by][1:] != ids[by][:-1]) | (keys[by][1:] != keys[by][:-1]).any(axis=1)
    rank = np.empty(len(by), np.int64)
    rank[by] = np.cumsum(fresh) - 1
    ids, keys = ids[by][fresh], keys[by][fresh]
    new["doc"], old["doc"] = rank[new["doc"]], rank[old["doc"]]
    new = new[np.lexsort((new["start"], new["doc"], new["low"], new["high"]))]
    same = (new["high"][1:] == new["high"][:-1]) & (new["low"][1:] == new["low"][:-1])
    first = np.concatenate([[True], ~same]) if len(new) else np.zeros(0, bool)
    earliest = np.flatnonzero(first)[np.cumsum(first) - 1] if len(new) else np.zeros(0, np.int64)
    itself = (new["doc"] == new["doc"][earliest]) & (new["start"] == new["start"][earliest])  # rows that repeat a row
    gone = np.concatenate([new[~itself], old])
    gone = gone[np.lexsort((gone["start"], gone["doc"]))]
    begins = np.flatnonzero(np.concatenate([[True], gone["doc"][1:] != gone["doc"][:-1]])) if len(gone) else np.zeros(0, int)
    docs = gone["doc"][begins]
    offsets = pa.array(np.append(begins, len(gone)).astype(np.int32))
    return pa.table(
        [
            pa.array(ids[docs], pa.int64(), mask=ids[docs] == _NONE),
            pa.array([k.tobytes() for k in keys[docs].astype(">u8")], pa.binary()),
            pa.ListArray.from_arrays(offsets, pa.array(gone["start"])),
            pa.ListArray.from_arrays(offsets, pa.array(gone["start"] + gone["length"])),
        ],
        names=["doc_id", "key", "starts", "ends"],
    )


def deduplicate_chunks(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_chunks, n_repeated, n_removed, kept_sha256 and kept (the bytes left) of each row.

    Of equal chunks the one in the smallest doc_id stays (nulls last; rows that repeat a
    doc_id in the order of their key), the first one in that text.  Rows equal in doc_id and
    text are one document, and each of them gets its result.  Null and empty texts have no
    chunks.  Only doc_id and text are read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"), "text")
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(1, -(-size // BUCKET_BYTES))

    def repeated(table: pa.Table) -> pa.Table:
        return _repeated(table)

    packed = rows.mapInArrow(
        lambda batches: _packed(batches, buckets), "bucket int, docs binary, keys binary, new binary, old binary"
    )
    spans = packed.groupBy("bucket").applyInArrow(repeated, SPANS).groupBy("key").agg(  # of one text
        F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends")
    )
    joined = rows.join(spans, "key", "left").select("doc_id", "text", "starts", "ends")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, BATCH_BYTES):
            raw, starts = text_bytes(batch.column("text"))
            held = raw.tobytes()
            chunks = np.bincount(
                np.fromiter((t for t, _, _ in _chunks(raw, starts)), np.int64), minlength=batch.num_rows
            )
            out = []
            for i, (begins, ends) in enumerate(zip(batch.column("starts").to_pylist(), batch.column("ends").to_pylist())):
                text = held[starts[i] : starts[i + 1]]
                gone = sorted(set(zip(begins or (), ends or ())))
                kept, at = [], 0
                for s, e in gone:
                    kept.append(text[at:s])
                    at = e
                kept = b"".join([*kept, text[at:]])
                out.append((len(text), int(chunks[i]), len(gone), len(text) - len(kept), hashlib.sha256(kept).hexdigest(), kept))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]],
                ["doc_id", "n_bytes", "n_chunks", "n_repeated", "n_removed", "kept_sha256", "kept"],
            )

    return joined.mapInArrow(
        cut, "doc_id long, n_bytes long, n_chunks long, n_repeated long, n_removed long, kept_sha256 string, kept binary"
    )
