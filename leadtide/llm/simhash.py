"""SimHash near-duplicates: exact comparison of all fingerprints, tile by tile.

A fingerprint has four 16-bit words.  Two fingerprints at d bits differ by at most d in the
sum over the words of the differences of their population counts.  Distinct fingerprints are
therefore dealt into tiles of equal population counts, large ones into several tiles of about
``TILE`` fingerprints, and a tile meets only the tiles within reach.  A pair of tiles is
compared in numpy by exclusive-or and bit counts, and gives a spanning forest of its links,
not the links themselves.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F

from leadtide.llm.common import pieces, restored, row_key, sheltered, stored
from leadtide.llm.components import components

SHINGLE_WORDS = 3
MOST_BITS = 2
SEED = 42
#: Fingerprints of a tile, about.
TILE = 2048
#: Population counts of a 16-bit word.
_COUNTS = 17
BATCH_BYTES = 4 << 20


def fingerprint(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """Of the words of a text, A-Z lower-cased; 0 if it has none."""
    words = text.encode().lower().split()
    if not words:
        return 0
    runs = zip(*(words[i:] for i in range(shingle_words))) if len(words) >= shingle_words else [words]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(b" ".join(run), SEED) for run in runs], "<u8")
    ones = np.zeros(64, np.int64)
    for first in range(0, len(hashes), 1 << 14):  # bounded memory for long texts
        part = hashes[first : first + (1 << 14)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """(key, doc_id, bits) of each row; key tells apart rows that repeat a doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, BATCH_BYTES):
            bits = np.array([fingerprint(t or "", shingle_words) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), batch.column("doc_id"), pa.array(bits.view(np.int64))], ["key", "doc_id", "bits"]
            )

    return docs.select(row_key().alias("key"), F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "key binary, doc_id long, bits long"
    )


def _population(bits: Column) -> list[Column]:
    return [F.bit_count(F.shiftrightunsigned(bits, 16 * i).bitwiseAND(F.lit(0xFFFF))) for i in range(4)]


def _forest(a: np.ndarray, b: np.ndarray, most_bits: int) -> list[tuple[int, int]]:
    """Links between a and b at ``most_bits`` or fewer, without those that close a ring."""
    above: dict[int, int] = {}

    def top(x: int) -> int:
        while (up := above.get(x, x)) != x:
            above[x] = above.get(up, up)
            x = up
        return x

    out = []
    step = max(1, (1 << 20) // max(1, len(b)))
    for first in range(0, len(a), step):
        differing = (a[first : first + step, None] ^ b[None, :]).view(np.uint64)  # bit counts of signed numbers drop the sign
        near = np.bitwise_count(differing) <= most_bits
        for i, j in zip(*(x.tolist() for x in np.nonzero(near))):
            u, v = int(a[first + i]), int(b[j])
            if u != v and (x := top(u)) != (y := top(v)):
                above[x] = y
                out.append((u, v))
    return out


def links(distinct: DataFrame, most_bits: int = MOST_BITS, tile: int = TILE) -> DataFrame:
    """Links (a, b) that connect all of ``distinct`` (bits) within ``most_bits``; a forest per pair of tiles."""
    counts = _population(F.col("bits"))
    tiled = distinct.withColumn("class", sum((c * _COUNTS**i for i, c in enumerate(counts)), F.lit(0)))
    sizes = tiled.groupBy("class").count().select("class", F.ceil(F.col("count") / tile).cast("int").alias("n"))
    sizes = stored(sizes, "tile-sizes")  # at most 17 ** 4 rows of 8 bytes, however many documents
    tiles = stored(
        tiled.join(F.broadcast(sizes), "class")
        .withColumn("part", F.pmod(F.xxhash64("bits"), F.col("n")).cast("int"))
        .groupBy("class", "part").agg(F.array_sort(F.collect_list("bits")).alias("rows")),  # about `tile` values
        "tiles",
    )
    reach = [
        step for step in product(range(-most_bits, most_bits + 1), repeat=4)
        if sum(map(abs, step)) <= most_bits and step[::-1] >= (0, 0, 0, 0)
    ]  # each pair of classes from one side only
    parts = [F.floor(F.col("class") / _COUNTS**i) % _COUNTS for i in range(4)]
    near = F.array(*[
        F.when(
            F.lit(True) if not any(step) else
            sum(((p + s < 0) | (p + s >= _COUNTS)).cast("int") for p, s in zip(parts, step)) == 0,
            F.col("class") + sum(s * _COUNTS**i for i, s in enumerate(step)),
        )
        for step in reach
    ])
    other = sizes.select(F.col("class").alias("class2"), F.col("n").alias("n2"))
    pairs = (
        tiles.select("class", "part", F.explode(F.array_compact(near)).alias("class2"))
        .join(F.broadcast(other), "class2")
        .select("class", "part", "class2", F.explode(F.sequence(
            F.when(F.col("class") == F.col("class2"), F.col("part")).otherwise(F.lit(0)), F.col("n2") - 1
        )).alias("part2"))
    )
    against = tiles.select(F.col("class").alias("class2"), F.col("part").alias("part2"), F.col("rows").alias("rows2"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for a, b in zip(batch.column("rows"), batch.column("rows2")):
                found += _forest(a.values.to_numpy(), b.values.to_numpy(), most_bits)
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[i] for x in found], pa.int64()) for i in (0, 1)], ["a", "b"]
            )

    return (
        pairs.join(tiles, ["class", "part"]).join(against, ["class2", "part2"])
        .select("rows", "rows2").mapInArrow(compare, "a long, b long")
    )


def near_duplicates(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, most_bits: int = MOST_BITS) -> DataFrame:
    """(key, doc_id, fingerprint, group, component_id) for each row of ``docs``.

    component_id is the smallest doc_id that can be reached over links of ``most_bits`` or
    fewer differing bits, its own included; group is the same for all rows of a component.
    Null and empty texts have fingerprint zero and link like any other.  A null doc_id is
    never the smallest unless a whole component has none.  Repeated rows give as many rows.
    """
    rows = stored(fingerprints(docs, shingle_words), "fingerprints")
    distinct = stored(rows.groupBy("bits").agg(F.min("doc_id").alias("least")), "distinct")
    roots = components(links(distinct.select("bits"), most_bits))
    grouped = distinct.join(roots.withColumnRenamed("node", "bits"), "bits", "left").select(
        "bits", "least", F.coalesce("root", "bits").alias("group")
    )
    least = grouped.groupBy("group").agg(F.min("least").alias("component_id"))
    of_bits = grouped.select("bits", "group").join(least, "group")
    return rows.join(of_bits, "bits").select(
        "key", "doc_id", F.lower(F.lpad(F.hex("bits"), 16, "0")).alias("fingerprint"), "group", "component_id"
    )


def one_of_each_group(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, most_bits: int = MOST_BITS) -> DataFrame:
    """The rows of ``docs`` without near-duplicates: of each group the row of the smallest
    doc_id stays (nulls last; rows that repeat it: the smallest key; equal rows: one of them)."""
    rows = near_duplicates(docs, shingle_words, most_bits)
    chosen = rows.groupBy("group").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")).alias("first")
    ).select(F.col("first.key").alias("_key"))
    wide = sheltered(docs, "doc_id", "text").withColumn("_key", row_key()).join(chosen, "_key", "left_semi")
    # Only equal rows share a key now; the partitioning by key is that of the join.
    first = Window.partitionBy("_key").orderBy("doc_id")
    one = wide.withColumn("_nth", F.row_number().over(first)).where("_nth = 1")
    return one.select(*restored(one, docs, "doc_id", "text"))
