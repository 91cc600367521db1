"""Packing of tokenised documents into windows by Karmarkar-Karp multiway differencing.

Every whole window a document fills is a sequence of its own; what is left of it, cut into
shares of at most ``SHARE`` tokens, is dealt over windows in groups of about ``GROUP`` shares.
The differencing keeps a heap of partial partitions and merges the two of the largest
imbalance, the fullest window of one with the emptiest of the other, until one partition is
left.  If a window exceeds the capacity, the number of windows rises.
"""

from __future__ import annotations

import heapq
import json
import re
import zlib
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, functions as F

from leadtide.llm.common import pieces

CAPACITY = 1024
END_ID = 0
#: Shares of a document's rest have at most so many tokens.
SHARE = 256
#: Shares that are partitioned together.
GROUP = 600
#: Words whose ids a worker keeps.
MOST_WORDS = 300_000
BATCH_BYTES = 8 << 20

#: Fixed value: the pattern of byte-level pre-tokenizers.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_SPACES = re.compile(r"\s ")


class TokenIds:
    """The ids of whole texts as little-endian bytes, equal to those of the tokenizer file.

    Ids come from the vocabulary of the file by tiktoken, which is several times quicker
    than ``tokenizers`` and gives the same ids (tests compare them).  Added tokens of the file
    are cut out of a text first and give their own ids; texts with one whose match takes more
    than its string (such as the blanks beside it) are left to ``tokenizers``.  The pattern
    never joins the two sides of a blank that stands between other characters, so a blank and
    what follows it up to the next one is encoded by itself, and the ids of the first
    ``MOST_WORDS`` such parts are kept.
    """

    def __init__(self, tokenizer_path: str):
        with open(tokenizer_path, encoding="utf-8") as file:
            held = json.load(file)
        vocabulary = held["model"]["vocab"]
        symbols = _byte_symbols()
        ranks = {bytes(symbols[c] for c in token): i for token, i in vocabulary.items()}
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.parts: dict[str, bytes] = {}
        added = [t for t in held.get("added_tokens") or [] if t["content"]]
        self.added = {t["content"]: array("I", [t["id"]]).tobytes() for t in added}
        longest = sorted(self.added, key=len, reverse=True)
        self.at_added = re.compile("(" + "|".join(map(re.escape, longest)) + ")") if added else None
        self.whole = None  # the tokenizer of the file, where the strings alone do not tell
        if any(t[flag] for t in added for flag in ("single_word", "lstrip", "rstrip")):
            from tokenizers import Tokenizer

            self.whole = Tokenizer.from_file(tokenizer_path)

    def encode(self, text: str) -> bytes:
        return array("I", self.encoding.encode_ordinary(text)).tobytes()

    def _new(self, part: str) -> bytes:
        ids = self.encode(" " + part)
        if len(self.parts) < MOST_WORDS:
            self.parts[part] = ids
        return ids

    def of(self, text: str) -> bytes:
        if self.at_added is None or not self.at_added.search(text):
            return self._plain(text)
        if self.whole is not None:
            return array("I", self.whole.encode(text, add_special_tokens=False).ids).tobytes()
        parts = self.at_added.split(text)  # every second one is an added token
        return b"".join([self.added[p] if k % 2 else self._plain(p) for k, p in enumerate(parts) if p])

    def _plain(self, text: str) -> bytes:
        if _SPACES.search(text) or text.endswith(" "):
            return self.encode(text)
        head, *parts = text.split(" ")
        known, new = self.parts.get, self._new
        return self.encode(head) + b"".join([known(p) or new(p) for p in parts])


def _byte_symbols() -> dict[str, int]:
    """The byte of each symbol that byte-level vocabularies write for it."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


@lru_cache(maxsize=2)
def token_ids(tokenizer_path: str) -> TokenIds:
    """One for each worker process, so that later tasks find the parts known."""
    return TokenIds(tokenizer_path)


def differencing(sizes: list[int], windows: int) -> list[list[int]]:
    """Deal items of the given sizes over ``windows`` by the largest differencing method.

    A partial partition is a list of (sum, items) in falling order, its smallest sum taken
    off all; only the windows that hold something beyond that are listed.
    """
    heap: list[tuple[int, int, list[tuple[int, list[int]]]]] = []
    for i, size in enumerate(sizes):
        heap.append((-size, i, [(size, [i])]))
    heapq.heapify(heap)
    turn = len(sizes)
    while len(heap) > 1:
        _, _, a = heapq.heappop(heap)
        _, _, b = heapq.heappop(heap)
        # The fullest of one meets the emptiest of the other; unlisted windows are empty.
        free = windows - len(a)
        merged = list(a)
        if len(b) <= free:
            merged += b
        else:
            merged += b[:free]
            for k, (size, items) in enumerate(b[free:]):
                at = len(a) - 1 - k
                merged[at] = (a[at][0] + size, a[at][1] + items)
        merged.sort(key=lambda w: -w[0])
        if len(merged) == windows and (least := merged[-1][0]):
            merged = [(size - least, items) for size, items in merged]
        spread = merged[0][0] - (merged[-1][0] if len(merged) == windows else 0)
        heapq.heappush(heap, (-spread, turn, merged))
        turn += 1
    return [items for _, items in heap[0][2]] if heap else []


def near_equal_windows(sizes: list[int], capacity: int = CAPACITY) -> list[list[int]]:
    """As few windows as differencing manages without exceeding the capacity."""
    windows = max(1, -(-sum(sizes) // capacity))
    while True:
        found = differencing(sizes, windows)
        if all(sum(sizes[i] for i in items) <= capacity for items in found):
            return found
        windows += 1


def pack(
    docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, carry: list[str] | None = None,
    tokens: bool = True,
) -> DataFrame:
    """The pieces of all documents: doc_id, start, length, ids_crc32, doc_tokens, sequence_id,
    offset, ids (the token ids, with ``tokens``), and the columns named in ``carry``.

    A document is its ids and then the id 0; a null or empty text is the id 0 alone.  Each
    row is packed on its own, so rows that repeat a doc_id give pieces that repeat it.
    Sequences hold at most ``capacity`` ids and are numbered by task; readers pad them to the
    capacity, but for those whose length is a power of two.
    """
    carry = [c for c in carry or [] if c != "doc_id"]
    share = max(1, capacity // (CAPACITY // SHARE))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        ids_of = token_ids(tokenizer_path).of
        sequence = TaskContext.get().partitionId() << 40
        waiting: list[tuple] = []  # shares not yet dealt

        def deal(rows: list[tuple], out: list[tuple]) -> None:
            nonlocal sequence
            for items in near_equal_windows([len(r[2]) // 4 for r in rows], capacity):
                at = 0
                for i in items:
                    doc, start, ids, total = rows[i]
                    out.append((doc, start, ids, total, sequence, at))
                    at += len(ids) // 4
                sequence += 1

        def table(out: list[tuple], carried: list[pa.Array]) -> pa.RecordBatch:
            lengths = [len(r[2]) // 4 for r in out]
            columns = [
                pa.array([r[0][0] for r in out], pa.int64()), pa.array([r[1] for r in out], pa.int64()),
                pa.array(lengths, pa.int64()), pa.array([zlib.crc32(r[2]) for r in out], pa.int64()),
                pa.array([r[3] for r in out], pa.int64()), pa.array([r[4] for r in out], pa.int64()),
                pa.array([r[5] for r in out], pa.int64()),
            ]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if tokens:
                ends = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
                values = np.frombuffer(b"".join(r[2] for r in out), "<u4").astype(np.int32)
                columns.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(values)))
                names.append("ids")
            for k, name in enumerate(carry):
                columns.append(pa.array([r[0][1 + k] for r in out], kinds[k]))
                names.append(name)
            return pa.RecordBatch.from_arrays(columns, names)

        kinds: list[pa.DataType] = []
        whole = 4 * capacity
        for batch in pieces(batches, BATCH_BYTES):
            kinds = [batch.column(c).type for c in carry]
            texts = [t or "" for t in batch.column("text").to_pylist()]
            docs_of = zip(batch.column("doc_id").to_pylist(), *(batch.column(c).to_pylist() for c in carry))
            out: list[tuple] = []
            for doc, text in zip(docs_of, texts):
                ids = ids_of(text) + b"\0\0\0\0"
                total = len(ids) // 4
                full = len(ids) // whole * whole
                for start in range(0, full, whole):
                    out.append((doc, start // 4, ids[start : start + whole], total, sequence, 0))
                    sequence += 1
                for start in range(full, len(ids), 4 * share):
                    waiting.append((doc, start // 4, ids[start : min(start + 4 * share, len(ids))], total))
                while len(waiting) >= GROUP:
                    deal(waiting[:GROUP], out)
                    del waiting[:GROUP]
            if out:
                yield table(out, kinds)
        if waiting:
            out = []
            deal(waiting, out)
            yield table(out, kinds)

    schema = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
    if tokens:
        schema += ", ids array<int>"
    for name in carry:
        schema += f", `{name}` {docs.schema[name].dataType.simpleString()}"
    columns = [F.col("doc_id").cast("long").alias("doc_id"), "text", *carry]
    return docs.select(*columns).mapInArrow(run, schema)
