"""Removal of repeated passages by sorting suffixes.

Any two equal strings of ``LENGTH`` bytes hold the same anchor at the same place: the gram of
``GRAM`` bytes with the least hash among those inside (the leftmost of equal ones).  So only
the suffixes that begin at anchors are sorted.  An anchor travels as a block: the bytes of all
strings it is the anchor of.  Equal blocks of one batch travel once; what they repeat is known in the batch and
travels beside the ranges, dealt over as many groups by task and batch.

Splitters sampled from the anchors' leading eight bytes deal the blocks over ranges.  In a
range the suffixes are sorted by multikey quicksort, eight bytes at a time and only where
they still tie, and so are the reversed bytes before the anchors.  The common prefix lengths
of neighbours then say which strings are equal, byte by byte; of equal strings all but the
earliest are repeats.  Leading bytes so frequent that they fill several ranges are dealt over
all of these by document, and what is left of their strings meets again across these ranges.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from leadtide.llm.common import STRIDE, once, pieces, row_key, stored, text_bytes

LENGTH = 100
GRAM = 20
#: Text of a range of suffixes, and of what a task hashes at a time and merges at a time.
RANGE_BYTES, HASH_BYTES, MERGE_BYTES = 6 << 20, 1 << 20, 4 << 20
#: One block of so many is sampled for the splitters, and the bytes of a block.
SAMPLE_OF, SAMPLE_BYTES = 64, 4096
_NONE = np.int64(2**63 - 1)  # a null doc_id comes last

PAYLOAD = (
    "bucket int, docs binary, keys binary, doc binary, pos binary, left binary, count binary, hot binary, text binary, "
    "done binary"
)
SPANS = "doc_id long, key binary, starts array<long>, ends array<long>, digests array<binary>, strings array<long>"


def _u64(raw: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on, as a number."""
    x = raw.astype(np.uint64)
    for step in (1, 2, 4):
        x = x[:-step] | (x[step:] << np.uint64(8 * step))
    return x


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if width > have else x


def anchors(raw: np.ndarray, starts: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(text, place, first, last, hash) of each anchor: which text, where, the first and last
    start of the strings it is the anchor of, and the hash of its gram; places count from the
    start of ``raw``."""
    none = np.zeros(0, np.int64)
    grams = len(raw) - GRAM + 1
    if len(raw) < length:
        return none, none, none, none, none.astype(np.uint64)
    words = _u64(raw)
    mixed = words[:grams] * np.uint64(0x9E3779B97F4A7C15)
    mixed ^= mixed >> np.uint64(29)
    mixed += words[8 : 8 + grams]
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(32)
    mixed += words[12 : 12 + grams]
    mixed *= np.uint64(0x94D049BB133111EB)
    mixed ^= mixed >> np.uint64(29)
    low = np.uint64(31)
    least = _sliding_min((mixed >> low << low) | np.arange(grams, dtype=np.uint64), length - GRAM + 1)
    text = np.repeat(np.arange(len(starts) - 1, dtype=np.int32), np.diff(starts))
    at = np.flatnonzero(text[: len(least)] == text[length - 1 : length - 1 + len(least)])
    place = (least[at] & np.uint64((1 << 31) - 1)).astype(np.int64)
    if not len(at):
        return none, none, none, none, none.astype(np.uint64)
    begins = np.flatnonzero(np.concatenate([[True], place[1:] != place[:-1]]))
    ends = np.concatenate([begins[1:], [len(at)]]) - 1
    return text[at[begins]].astype(np.int64), place[begins], at[begins], at[ends], mixed[place[begins]]


def _leading(raw: np.ndarray, place: np.ndarray) -> np.ndarray:
    """The eight bytes from each place on as a number that sorts like them."""
    rows = raw[place[:, None] + np.arange(8)]
    return np.ascontiguousarray(rows).view(">u8").ravel().astype(np.uint64)


def _ordered(lead: np.ndarray) -> np.ndarray:
    return (lead ^ np.uint64(1 << 63)).view(np.int64)


def _sample(docs: DataFrame, length: int, sample_of: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, HASH_BYTES):
            raw, starts = text_bytes(batch.column("text"))
            _, place, *_ = anchors(raw, starts, length)
            yield pa.RecordBatch.from_arrays([pa.array(_ordered(_leading(raw, place)))], ["lead"])

    # Blocks of a text, not whole documents: the sample grows with the bytes, however few the documents.
    # A block goes with the bytes its last string reaches into, so each string lies in one block.
    last = F.floor((F.octet_length("text") - length) / SAMPLE_BYTES).cast("int")
    chosen = F.filter(F.sequence(F.lit(0), last), lambda k: F.pmod(F.xxhash64("key", k), F.lit(sample_of)) == 0)
    parts = F.transform(
        chosen,
        lambda k: F.substring(F.col("text").cast("binary"), k * SAMPLE_BYTES + 1, F.lit(SAMPLE_BYTES + length - 1)),
    )
    some = docs.where(F.octet_length("text") >= length).select(F.explode_outer(parts).alias("text"))
    return some.where(F.col("text").isNotNull()).mapInArrow(run, "lead long")


def splitters(docs: DataFrame, length: int = LENGTH, sample_of: int = SAMPLE_OF) -> np.ndarray:
    """Where the ranges of leading bytes end (runs two jobs; gathers quantiles only)."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    ranges = -(-size // RANGE_BYTES)
    if ranges < 2:
        return np.zeros(0, np.int64)
    shares = [i / ranges for i in range(1, ranges)]
    found = _sample(docs, length, sample_of).agg(F.percentile_approx("lead", shares, max(10_000, 4 * ranges))).first()[0]
    return np.array(found or [], np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], cuts: np.ndarray, length: int) -> Iterator[pa.RecordBatch]:
    """Blocks of each batch, packed by range; repeats of equal blocks as spans (done), with a negative bucket."""
    from pyspark import TaskContext

    press = zstandard.ZstdCompressor(level=1)
    context = TaskContext.get()
    task = context.partitionId() if context else 0
    for turn, batch in enumerate(pieces(batches, MERGE_BYTES)):
        batch = once(batch)
        raw, starts = text_bytes(batch.column("text"))
        ids = batch.column("doc_id").fill_null(_NONE).to_numpy()
        keys = np.frombuffer(b"".join(batch.column("key").to_pylist()), ">u8").reshape(-1, 2)
        order = np.lexsort((keys[:, 1], keys[:, 0], ids))
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        parts = []
        first = 0
        while first < len(starts) - 1:
            last = max(first + 1, int(np.searchsorted(starts, starts[first] + HASH_BYTES, "right")) - 1)
            text, *rest = anchors(raw[starts[first] : starts[last]], starts[first : last + 1] - starts[first], length)
            parts.append([text + first, *[x + starts[first] for x in rest[:3]], rest[3]])
            first = last
        text, place, begin, end, gram = (np.concatenate(x) for x in zip(*parts))
        # Equal blocks: the earliest goes on, the others are repeats as a whole.
        _, inverse, times = np.unique(gram, return_inverse=True, return_counts=True)
        often = np.flatnonzero(times[inverse] > 1)
        often = often[np.lexsort((place[often], rank[text[often]]))]
        held = raw.tobytes()
        seen: set[tuple[int, bytes]] = set()
        going = np.ones(len(text), bool)
        for i, p, b, e in zip(often.tolist(), place[often].tolist(), begin[often].tolist(), end[often].tolist()):
            block = (p - b, held[b : e + length])
            if block in seen:
                going[i] = False
            else:
                seen.add(block)
        gone = np.flatnonzero(~going)
        stay = np.flatnonzero(going)
        lead = _ordered(_leading(raw, place))
        low, high = np.searchsorted(cuts, lead, "left"), np.searchsorted(cuts, lead, "right")
        width = np.maximum(high - low, 1)
        bucket = high - (keys[text, 1] % width.astype(np.uint64)).astype(np.int64)
        hot = high - low > 1
        stay = stay[np.argsort(bucket[stay], kind="stable")]
        rows = np.split(stay, np.flatnonzero(np.diff(bucket[stay])) + 1) if len(stay) else []
        columns: list[list] = [[] for _ in range(10)]

        def add(number: int, own: np.ndarray, done: tuple[np.ndarray, ...]) -> None:
            doc, which = np.unique(np.concatenate([text[own], done[0]]), return_inverse=True)
            from_start = starts[text]
            join = b"".join([held[b : e + length] for b, e in zip(begin[own].tolist(), end[own].tolist())])
            values = (
                ids[doc].tobytes(), keys[doc].tobytes(), which[: len(own)].astype(np.int32).tobytes(),
                (place - from_start)[own].astype(np.int64).tobytes(), (place - begin)[own].astype(np.uint8).tobytes(),
                (end - begin)[own].astype(np.uint8).tobytes(), hot[own].tobytes(), join,
                np.stack([which[len(own) :], done[1], done[2]]).astype(np.int64).tobytes(),
            )
            columns[0].append(number)
            for column, value in zip(columns[1:], values):
                column.append(press.compress(value))

        nothing = np.zeros(0, np.int64)
        for own in rows:
            add(int(bucket[own[0]]), own, (nothing, nothing, nothing))
        if len(gone):
            begins = starts[text[gone]]
            add(
                -1 - (task + turn * STRIDE) % (len(cuts) + 1), nothing,
                _union(text[gone], begin[gone] - begins, end[gone] - begins + length),
            )
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), *[pa.array(c, pa.binary()) for c in columns[1:]]],
            ["bucket", "docs", "keys", "doc", "pos", "left", "count", "hot", "text", "done"],
        )


def sort_suffixes(raw: np.ndarray, at: np.ndarray, have: np.ndarray, step: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Multikey quicksort: (order, common) of the strings of ``have`` bytes from ``at`` on, forwards
    (step 1) or backwards (step -1); common is how many bytes each shares with the one before it,
    of ``most`` at most.  Missing bytes count as zero."""
    n = len(at)
    order = np.arange(n)
    common = np.zeros(n + 1, np.int64)
    group = np.zeros(n, np.int64)  # by place in the order
    live = np.arange(n)
    depth = 0
    while len(live) and depth < most:
        rows = order[live]
        offsets = depth + np.arange(8)
        inside = offsets[None, :] < have[rows, None]
        where = np.where(inside, at[rows, None] + step * offsets[None, :], 0)
        letters = np.where(inside, raw[where] if len(raw) else 0, 0).astype(np.uint8)
        letter = np.ascontiguousarray(letters).view(">u8").ravel().astype(np.uint64)
        by = np.lexsort((letter, group[live]))
        order[live] = rows[by]
        letter = letter[by]
        same = np.zeros(len(live), bool)
        same[1:] = group[live[1:]] == group[live[:-1]]
        differs = np.zeros(len(live), np.uint64)
        differs[1:] = letter[1:] ^ letter[:-1]
        new = same & (differs != 0)
        shared = sum((differs[new] < np.uint64(1 << (8 * k))).astype(np.int64) for k in range(1, 8))
        common[live[new]] = depth + shared
        begins = np.flatnonzero(~same | new)
        sizes = np.diff(np.append(begins, len(live)))
        group[live] = np.repeat(live[begins], sizes)
        live = live[np.repeat(sizes > 1, sizes)]
        depth += 8
    if len(live):
        tied = np.zeros(len(live), bool)
        tied[1:] = group[live[1:]] == group[live[:-1]]
        common[live[tied]] = depth
    return order, np.minimum(common, most)


def _union(doc: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Overlapping or touching spans of a document made one; sorted."""
    by = np.lexsort((start, doc))
    doc, start, end = doc[by], start[by], end[by]
    if not len(doc):
        return doc, start, end
    base = doc * (int(end.max()) + 2)
    reach = np.maximum.accumulate(base + end)
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (start[1:] + base[1:] > reach[:-1])])
    begins = np.flatnonzero(new)
    lasts = np.append(begins[1:], len(doc)) - 1
    return doc[begins], start[begins], reach[lasts] - base[lasts]


def _compare(table: pa.Table, length: int) -> pa.Table:
    """The repeats among the blocks of one range, as spans of each document."""
    unpress = zstandard.ZstdDecompressor()
    read = [[unpress.decompress(v) for v in table[c].to_pylist()] for c in table.column_names[1:]]
    docs = np.concatenate([np.frombuffer(b, np.int64) for b in read[0]])
    keys = np.concatenate([np.frombuffer(b, ">u8").reshape(-1, 2) for b in read[1]])
    shift = np.cumsum([0, *[len(b) // 8 for b in read[0]]])
    doc = np.concatenate([np.frombuffer(b, np.int32) + s for b, s in zip(read[2], shift)]).astype(np.int64)
    pos = np.concatenate([np.frombuffer(b, np.int64) for b in read[3]])
    left = np.concatenate([np.frombuffer(b, np.uint8) for b in read[4]]).astype(np.int64)
    count = np.concatenate([np.frombuffer(b, np.uint8) for b in read[5]]).astype(np.int64)
    hot = np.concatenate([np.frombuffer(b, bool) for b in read[6]])
    raw = np.frombuffer(b"".join(read[7]), np.uint8)
    done = [np.frombuffer(b, np.int64).reshape(3, -1) + np.array([[s], [0], [0]]) for b, s in zip(read[8], shift)]
    done = np.concatenate(done, axis=1)
    # Documents in order; one that came in several rows is one document.
    by = np.lexsort((keys[:, 1], keys[:, 0], docs))
    fresh = np.ones(len(by), bool)
    fresh[1:] = (docs[by][1:] != docs[by][:-1]) | (keys[by][1:] != keys[by][:-1]).any(axis=1)
    rank = np.empty(len(by), np.int64)
    rank[by] = np.cumsum(fresh) - 1
    docs, keys = docs[by][fresh], keys[by][fresh]
    doc = rank[doc]
    at = np.cumsum(count + length) - (count + length) + left
    earliest = np.lexsort((pos, doc))
    repeated_row = np.zeros(len(earliest), bool)
    repeated_row[1:] = (doc[earliest][1:] == doc[earliest][:-1]) & (pos[earliest][1:] == pos[earliest][:-1])
    earliest = earliest[~repeated_row]
    doc, pos, left, count, hot, at = (x[earliest] for x in (doc, pos, left, count, hot, at))
    order, common = sort_suffixes(raw, at, count - left + length, 1, length)
    partner = np.zeros(len(order), bool)
    partner[order] = np.maximum(common[:-1], common[1:]) >= GRAM
    lone_hot = hot & ~partner
    found_doc, found_start = [], []
    left_over: list[tuple[int, int, int]] = []

    def leave(rows: np.ndarray, before: int) -> None:
        left_over.extend(zip(doc[rows].tolist(), (pos[rows] - before).tolist(), (at[rows] - before).tolist()))

    for row in np.flatnonzero(lone_hot).tolist():
        for before in range(int(left[row] - count[row]), int(left[row]) + 1):
            leave(np.array([row]), before)
    kept = np.flatnonzero(partner)
    if len(kept):
        doc_, pos_, left_, count_, hot_, at_ = (x[kept] for x in (doc, pos, left, count, hot, at))
        order, common = sort_suffixes(raw, at_, count_ - left_ + length, 1, length)
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        order2, common2 = sort_suffixes(raw, at_ - 1, left_, -1, length - GRAM)
        place2 = np.empty(len(order2), np.int64)
        place2[order2] = np.arange(len(order2))
        for before in range(length - GRAM + 1):  # bytes of the string before the anchor
            rows = np.flatnonzero((left_ >= before) & (left_ - count_ <= before))
            if not len(rows):
                continue
            same = np.cumsum(common[:-1] < length - before)[place[rows]]
            same = same * len(kept) + np.cumsum(common2[:-1] < before)[place2[rows]] if before else same
            sorted_rows = np.argsort(same, kind="stable")  # rows are in order of document and place
            same = same[sorted_rows]
            later = np.zeros(len(rows), bool)
            later[sorted_rows[1:]] = same[1:] == same[:-1]
            found_doc.append(doc_[rows[later]])
            found_start.append(pos_[rows[later]] - before)
            if hot_.any():
                leave(kept[rows[~later & hot_[rows]]], before)
    start = np.concatenate([*found_start, done[1]])
    end = np.concatenate([*[s + length for s in found_start], done[2]])
    spans = _union(np.concatenate([*found_doc, rank[done[0]]]).astype(np.int64), start, end)
    held = raw.tobytes()
    strings: dict[int, list[tuple[bytes, int]]] = {}
    for d, s, a in left_over:
        strings.setdefault(d, []).append((hashlib.blake2b(held[a : a + length], digest_size=16).digest(), s))
    return _table(docs, keys, *spans, strings)


def _table(docs, keys, doc, start, end, strings) -> pa.Table:
    touched = np.union1d(doc, np.array(sorted(strings), np.int64)).astype(np.int64)
    low, high = np.searchsorted(doc, touched, "left"), np.searchsorted(doc, touched, "right")
    ids = docs[touched]
    return pa.table(
        [
            pa.array(ids, pa.int64(), mask=ids == _NONE),
            pa.array([k.tobytes() for k in keys[touched].astype(">u8")], pa.binary()),
            pa.array([start[a:b] for a, b in zip(low, high)], pa.list_(pa.int64())),
            pa.array([end[a:b] for a, b in zip(low, high)], pa.list_(pa.int64())),
            pa.array([[x for x, _ in strings.get(int(d), ())] for d in touched], pa.list_(pa.binary())),
            pa.array([[x for _, x in strings.get(int(d), ())] for d in touched], pa.list_(pa.int64())),
        ],
        names=["doc_id", "key", "starts", "ends", "digests", "strings"],
    )


def repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """(key, starts, ends): byte spans of each row's text that repeat earlier strings; docs has doc_id, key, text."""
    cuts = splitters(docs, length)

    def compare(table: pa.Table) -> pa.Table:
        return _compare(table, length)

    blocks = docs.mapInArrow(lambda batches: _blocks(batches, cuts, length), PAYLOAD)
    found = stored(blocks.groupBy("bucket").applyInArrow(compare, SPANS), "suffix-spans")
    # Strings with very frequent leading bytes that came first in their range: which came first of all?
    single = (
        found.where(F.size("digests") > 0)
        .select("doc_id", "key", F.explode(F.arrays_zip("digests", "strings")).alias("at"))
        .select("doc_id", "key", F.col("at.digests").alias("digest"), F.col("at.strings").alias("start"))
    )
    place = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key", "start")
    first = single.groupBy("digest").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    across = (
        single.join(first.drop("n"), "digest").where(place != F.col("first"))
        .groupBy("key").agg(F.collect_list("start").alias("starts"))  # of one text
        .select("key", "starts", F.transform("starts", lambda s: s + length).alias("ends"))
    )
    spans = found.where(F.size("starts") > 0).select("key", "starts", "ends").union(across)
    return spans.groupBy("key").agg(  # of one text
        F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("ends")).alias("ends")
    )


def remove_repeats(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the bytes left) of each row.

    Every byte goes that a string of ``length`` bytes covers which also starts earlier: in a
    row of a smaller doc_id (nulls last; rows that repeat a doc_id in the order of their key)
    or before in the same text.  Rows equal in doc_id and text are one document, and each of
    them gets its result.  Null and empty texts, and texts shorter than ``length``, lose
    nothing.  Only doc_id and text are read.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), row_key().alias("key"), "text")
    joined = rows.join(repeats(rows, length), "key", "left").select("doc_id", "text", "starts", "ends")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, MERGE_BYTES):
            out = []
            for text, starts, ends in zip(*(batch.column(c).to_pylist() for c in ("text", "starts", "ends"))):
                raw = (text or "").encode()
                if not starts:
                    out.append((len(raw), 0, 0, hashlib.sha256(raw).hexdigest(), raw))
                    continue
                zero = np.zeros(len(starts), np.int64)
                _, starts, ends = _union(zero, np.array(starts, np.int64), np.array(ends, np.int64))
                kept, at = [], 0
                for s, e in zip(starts.tolist(), ends.tolist()):
                    kept.append(raw[at:s])
                    at = e
                kept = b"".join([*kept, raw[at:]])
                out.append((len(raw), len(raw) - len(kept), len(starts), hashlib.sha256(kept).hexdigest(), kept))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *[pa.array([r[i] for r in out], k) for i, k in enumerate(kinds)]],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"],
            )

    return joined.mapInArrow(
        cut, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary"
    )
