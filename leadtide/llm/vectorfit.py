"""Packing of whole documents into sequences by vector best fit.

A document asks for three things: tokens, a place among the documents of a sequence, and
attention cost (the square of its length, since documents attend to themselves only).  A
sequence has a capacity of each.  Documents go, largest weighted demand first, into the
sequence that can hold them under every capacity and whose weighted residual afterwards has
the least norm, or, with ``rule="dot"``, whose residual has the largest weighted dot product
with the demand.  A capacity weighs as much as documents ask of it on average.

Tasks pack groups of ``GROUP_TOKENS`` tokens; the emptiest sequences of a group are opened again
for the next one.  The few that a task leaves open at its end are packed once more, together
with those of the ``TASKS`` tasks beside it, so that tasks cost no padding.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from leadtide.llm.common import byte_runs, lower_ascii, pieces, spread_ranges, stored, strings_at, text_bytes

CAPACITY = 4096
END_ID = 1
#: Documents of one sequence.
MOST_DOCUMENTS = 512
#: Tokens that are packed together.
GROUP_TOKENS = 4 << 20
#: Sequences of a group that may be opened again, and of a task that are left for the second pass.
REOPENED = 64
LEFT_OPEN = 4
#: Tasks whose open sequences meet.
TASKS = 64
#: A sequence is full when less than this share of some capacity is left.
FULL = 1 / 128
BATCH_BYTES = 8 << 20
#: Parts of texts whose ids a worker keeps.
MOST_PARTS = 300_000

_INSIDE = np.ones(256, bool)
_INSIDE[[9, 10, 13, 32]] = False
_LETTER = np.zeros(256, bool)
_LETTER[[*range(65, 91), *range(97, 123)]] = True
#: ASCII characters that never share a part of the pattern with a letter (the apostrophe may).
_MARK = np.zeros(256, bool)
_MARK[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) != "'"]] = True
#: Lowered words of Latin letters, which neither the normalizer nor the pattern changes.
_PLAIN = re.compile(r"[a-z\u00df-\u00f6\u00f8-\u017f]+")


def _letter_edges(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes that begin, and that end, a Latin letter of one or two bytes (U+00C0 to U+017F, but not
    U+0130, which becomes a letter and a mark)."""
    begins, ends = _LETTER[raw], _LETTER[raw]
    lead = np.flatnonzero((raw[:-1] >= 0xC3) & (raw[:-1] <= 0xC5))
    pair = raw[lead].astype(np.int64) << 8 | raw[lead + 1]
    lead = lead[~np.isin(pair, [0xC397, 0xC3B7, 0xC4B0])]
    begins[lead] = ends[lead + 1] = True
    return begins, ends


class PartIds:
    """The ids of whole texts, by the tokenizer file.

    Its pattern never joins the two sides of a blank, tab or line end, nor a Latin letter and a
    mark of ASCII; its normalizer lowers letters and turns blanks into one that gives no id; its
    added tokens begin with ``<|``.  So a text is cut there, each different part of a batch is
    encoded once, and the ids of all places are gathered.  A batch that holds ``<|`` is cut at
    blanks only, and not lowered before.  (Files of another kind are not for this class.)
    """

    def __init__(self, tokenizer_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.known: dict[bytes, bytes] = {}
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        self.symbols = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def _encode(self, parts: list[bytes]) -> list[bytes]:
        """Lowered Latin words go to the model at once, other parts through the whole tokenizer."""
        found: list[bytes] = [b""] * len(parts)
        others, texts, symbols, model = [], [], self.symbols, self.tokenizer.model
        for k, part in enumerate(parts):
            text = part.decode("utf-8")
            low = text.lower()
            if _PLAIN.fullmatch(low):
                word = low if len(low) == len(part) else "".join([symbols[b] for b in low.encode("utf-8")])
                found[k] = array("I", [t.id for t in model.tokenize(word)]).tobytes()
            else:
                others.append(k)
                texts.append(text)
        for k, e in zip(others, self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)):
            found[k] = array("I", e.ids).tobytes()
        return found

    def _parts(self, parts: list[bytes]) -> list[bytes]:
        known = self.known
        ids = [known.get(p) for p in parts]
        missing = [k for k, held in enumerate(ids) if held is None]
        for k, found in zip(missing, self._encode([parts[k] for k in missing])):
            ids[k] = found
            if len(known) < MOST_PARTS:
                known[parts[k]] = found
        return ids

    def of(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts in a row, each closed by ``END_ID``, and where each text's begin."""
        raw, starts = text_bytes(texts)
        cut = None
        if not np.any((raw[:-1] == 60) & (raw[1:] == 124)):
            raw = lower_ascii(raw)
            (begins, ends), mark = _letter_edges(raw), _MARK[raw]
            cut = np.zeros(len(raw), bool)
            cut[1:] = ends[:-1] & mark[1:] | mark[:-1] & begins[1:]
        row, begin, end = byte_runs(raw, starts, _INSIDE, cut)
        coded = strings_at(raw, begin, end - begin).dictionary_encode()
        by_part = self._parts(coded.dictionary.cast(pa.large_binary()).to_pylist())
        size = np.array([len(b) // 4 for b in by_part], np.int64)
        at = np.cumsum(size) - size
        # one more part, the closing id, after the last part of every text
        closing = np.searchsorted(row, np.arange(len(texts)), "right")
        code = np.insert(coded.indices.to_numpy(), closing, len(size)).astype(np.int64)
        flat = np.frombuffer(b"".join(by_part) + np.array([END_ID], "<u4").tobytes(), "<u4")
        size, at = np.append(size, 1), np.append(at, len(flat) - 1)
        size_at = size[code]
        ids = flat[spread_ranges(at[code], size_at)]
        total = np.concatenate([[0], np.cumsum(size_at)])
        return ids, np.concatenate([[0], total[closing + np.arange(len(texts)) + 1]])


@lru_cache(maxsize=2)
def part_ids(tokenizer_path: str) -> PartIds:
    """One for each worker process, so that later tasks find the parts known."""
    return PartIds(tokenizer_path)


def demands_of(lengths: np.ndarray) -> np.ndarray:
    """(tokens, documents, attention cost) of each piece."""
    lengths = np.asarray(lengths, np.int64)
    return np.stack([lengths, np.ones_like(lengths), lengths * lengths], axis=1)


def best_fit(demands: np.ndarray, capacities: np.ndarray, rule: str = "norm") -> np.ndarray:
    """The bin of each item.  An item beyond a capacity by itself gets a bin of its own.

    Items of equal demand are placed together: a bin that one of them made fuller is still the
    one of least residual norm for the next, as long as that fits.  With ``dot`` they go one
    by one.
    """
    if rule not in ("norm", "dot"):
        raise ValueError(f"rule is norm or dot, not {rule}")
    n = len(demands)
    bins = np.zeros(n, np.int64)
    if not n:
        return bins
    capacities = np.asarray(capacities, np.int64)
    share = demands / capacities
    weight = share.mean(axis=0)
    order = np.lexsort((np.arange(n), *demands.T, -(share @ weight)))
    edges = np.flatnonzero(np.any(np.diff(demands[order], axis=0) != 0, axis=1)) + 1
    left = np.zeros((64, demands.shape[1]), np.int64)  # of the open bins
    name = np.zeros(64, np.int64)
    many = made = 0
    least = demands.min(axis=0)
    for items in np.split(order, edges):
        asked = demands[items[0]]
        if np.any(asked > capacities):
            bins[items] = made + np.arange(len(items))
            made += len(items)
            continue
        done = 0
        while done < len(items):
            fits = np.flatnonzero(np.all(left[:many] >= asked, axis=1))
            if len(fits):
                after = (left[fits] - asked) / capacities
                if rule == "norm":
                    at = fits[np.argmin((after * after) @ weight)]
                else:
                    at = fits[np.argmax((left[fits] / capacities * (asked / capacities)) @ weight)]
            else:
                if many == len(left):
                    open_ = np.flatnonzero(np.all(left[:many] >= least, axis=1))
                    if len(open_) > many // 2:
                        left, name = np.concatenate([left, left * 0]), np.concatenate([name, name * 0])
                    else:  # bins that nothing fits any more are done with
                        left[: len(open_)], name[: len(open_)] = left[open_], name[open_]
                        many = len(open_)
                at, left[many], name[many] = many, capacities, made
                many, made = many + 1, made + 1
            times = int((left[at][asked > 0] // asked[asked > 0]).min()) if rule == "norm" else 1
            times = min(times, len(items) - done)
            bins[items[done : done + times]] = name[at]
            left[at] -= times * asked
            done += times
    return bins


def emptiest(demands: np.ndarray, bins: np.ndarray, capacities: np.ndarray, most: int) -> np.ndarray:
    """The items in the at most ``most`` emptiest bins, full ones left out (a flag for each item)."""
    used = np.zeros((int(bins.max()) + 1 if len(bins) else 0, demands.shape[1]), np.int64)
    np.add.at(used, bins, demands)
    share = (used / capacities).max(axis=1) if len(used) else np.zeros(0)
    chosen = np.argsort(share, kind="stable")[:most]
    flag = np.zeros(len(used), bool)
    flag[chosen[share[chosen] < 1 - FULL]] = True
    return flag[bins]


def _offsets(lengths: np.ndarray, bins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An order of the items by bin, and the offset of each item in its bin."""
    order = np.argsort(bins, kind="stable")
    before = np.cumsum(lengths[order]) - lengths[order]
    first = np.concatenate([[True], np.diff(bins[order]) != 0])
    base = np.maximum.accumulate(np.where(first, before, 0))
    offset = np.empty_like(lengths)
    offset[order] = before - base
    return order, offset


def pack(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, most_documents: int = MOST_DOCUMENTS,
    most_attention: int | None = None, rule: str = "norm", tokens: bool = True,
) -> DataFrame:
    """The pieces of all documents: doc_id, piece, start, length, ids_crc32, sequence_id, offset, and
    ids (with ``tokens``).

    A document is its ids and then the id 1; a null or empty text is the id 1 alone.  Only
    documents longer than ``capacity`` are cut.  ``most_attention`` defaults to the cost of one
    whole sequence.  Rows that repeat a doc_id, or are equal, are packed each on its own; other
    columns are not read; an empty table gives no rows.  Sequences have any numbers.  The pieces
    of the first pass are written to the shared folder once.
    """
    capacities = np.array([capacity, most_documents, most_attention or capacity * capacity], np.int64)
    names = ["doc_id", "piece", "start", "length", "ids_crc32", *(["ids"] if tokens else [])]
    schema = "doc_id long, piece int, start long, length long, ids_crc32 long"
    schema += ", ids array<int>" if tokens else ""

    def cut(batch: pa.RecordBatch, encoder: PartIds) -> pa.Table:
        """The pieces of a batch, without a place."""
        ids, starts = encoder.of(batch.column("text"))
        total = np.diff(starts)
        many = -(-total // capacity)
        doc = np.repeat(np.arange(len(total)), many)
        piece = np.arange(len(doc)) - np.repeat(np.cumsum(many) - many, many)
        start = piece * capacity
        length = np.minimum(capacity, total[doc] - start)
        at = starts[doc] + start
        data = memoryview(np.ascontiguousarray(ids)).cast("B")
        crc = [zlib.crc32(data[4 * a : 4 * (a + n)]) for a, n in zip(at.tolist(), length.tolist())]
        columns = [
            batch.column("doc_id").take(pa.array(doc)), pa.array(piece, pa.int32()), pa.array(start, pa.int64()),
            pa.array(length, pa.int64()), pa.array(crc, pa.int64()),
        ]
        if tokens:  # the pieces lie one after the other
            edges = np.append(at, len(ids)).astype(np.int32)
            columns.append(pa.ListArray.from_arrays(pa.array(edges), pa.array(ids.view("<i4"))))
        return pa.Table.from_arrays(columns, names)

    def placed(items: pa.Table, bins: np.ndarray, base: int) -> pa.Table:
        lengths = items.column("length").to_numpy()
        order, offset = _offsets(lengths, bins)
        out = items.append_column("sequence_id", pa.array(base + bins, pa.int64()))
        out = out.append_column("offset", pa.array(offset, pa.int64()))
        return out.take(pa.array(order))

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        encoder, part = part_ids(tokenizer_path), TaskContext.get().partitionId()
        sequence, waiting, many = part << 32, [], 0

        def settle(most: int) -> Iterator[pa.RecordBatch]:
            """Pack what waits; all but the emptiest sequences are given out."""
            nonlocal sequence, waiting, many
            items = pa.concat_tables(waiting).combine_chunks()
            demands = demands_of(items.column("length").to_numpy())
            bins = best_fit(demands, capacities, rule)
            again = emptiest(demands, bins, capacities, most)
            done = items.filter(pa.array(~again))
            if done.num_rows:
                _, renumbered = np.unique(bins[~again], return_inverse=True)
                out = placed(done, renumbered, sequence).append_column("part", pa.nulls(done.num_rows, pa.int64()))
                sequence += int(renumbered.max()) + 1
                yield from out.to_batches()
            waiting = [items.filter(pa.array(again))]
            many = int(demands[again, 0].sum())

        for batch in pieces(batches, BATCH_BYTES):
            waiting.append(cut(batch, encoder))
            many += int(np.sum(waiting[-1].column("length").to_numpy()))
            if many >= GROUP_TOKENS:
                yield from settle(REOPENED)
        if waiting:
            yield from settle(LEFT_OPEN)
            left = waiting[0]
            none = pa.nulls(left.num_rows, pa.int64())
            held = pa.array(np.full(left.num_rows, part // TASKS), pa.int64())
            left = left.append_column("sequence_id", none).append_column("offset", none).append_column("part", held)
            yield from left.to_batches()

    def second(key: tuple, items: pa.Table) -> pa.Table:
        bins = best_fit(demands_of(items.column("length").to_numpy()), capacities, rule)
        base = (1 << 62) | (key[0].as_py() << 32)
        return placed(items.select(names), bins, base)

    columns = [F.col("doc_id").cast("long").alias("doc_id"), "text"]
    places = "sequence_id long, offset long"
    found = docs.select(*columns).mapInArrow(first, f"{schema}, {places}, part long")
    found = stored(found, "pieces")
    rest = found.where("part IS NOT NULL").groupBy("part").applyInArrow(second, f"{schema}, {places}")
    last = ["sequence_id", "offset"]
    out = [c for c in names if c != "ids"] + last + (["ids"] if tokens else [])
    return found.where("part IS NULL").select(*out).unionByName(rest.select(*out))
