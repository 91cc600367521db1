"""How far sources of a language differ in their terms, counted by length-bucketed packing.

In a batch every term becomes numbers: of up to eight bytes one uint64 word, of up to sixteen two.
Terms of a group (lang and source) are brought together by a radix sort of these words in
16-bit digits, and counted as runs.  Longer terms go to buckets by length, a power of two
each, whose terms are sorted by their bytes.  The counts of a batch are summed in Spark.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from leadtide.llm.common import byte_runs, lower_ascii, pieces, spread_ranges, stored, strings_at, text_bytes

LEAST_DOCUMENTS = 30
MOST_RANK = 50
BATCH_BYTES = 8 << 20
SALTS = 16
#: Counts of sources that are compared in one group, and cells of a block of terms by sources.
GROUP_ROWS = 200_000
BLOCK_CELLS = 1 << 20

_INSIDE = np.zeros(256, bool)
_INSIDE[[*range(65, 91), *range(97, 123), *range(128, 256)]] = True


def radix_order(*words: np.ndarray) -> np.ndarray:
    """A stable order by the given arrays of whole numbers, the last one first in rank.

    One pass for each 16-bit digit (numpy sorts these by counting); digits that all share are skipped.
    """
    order = np.arange(len(words[0]))
    for word in words:
        digits = np.ascontiguousarray(word).view(np.uint16).reshape(len(word), -1)
        for k in range(digits.shape[1]):  # from the least significant on
            digit = digits[:, k]
            if len(digit) and np.any(digit != digit[0]):
                order = order[np.argsort(digit[order], kind="stable")]
    return order


def packed(raw: np.ndarray, begin: np.ndarray, length: np.ndarray, words: int) -> list[np.ndarray]:
    """The terms at the given ranges, of at most 8 * ``words`` bytes, as that many uint64 arrays."""
    out = np.zeros((len(begin), 8 * words), np.uint8)
    row = np.repeat(np.arange(len(begin)), length)
    at = spread_ranges(begin, length)
    out[row, at - begin[row]] = raw[at]
    found = out.view(">u8").astype(np.uint64)
    return [found[:, k] for k in range(words)]


def _runs(edge: np.ndarray, order: np.ndarray, row: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of each run of equal terms: one place, its count, and the number of its rows; rows rise in a run."""
    first = np.flatnonzero(edge)
    new_row = edge | np.concatenate([[True], np.diff(row[order]) != 0])
    counts = np.diff(np.append(first, len(order)))
    return order[first], counts, np.add.reduceat(new_row.astype(np.int64), first)


def term_counts(
    raw: np.ndarray, row: np.ndarray, begin: np.ndarray, length: np.ndarray, group: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One occurrence of each (group, term), its count, and the number of rows that hold it.

    Occurrences come with rising row; ``group`` is that of each occurrence.
    """
    found = []
    for words in (1, 2):
        chosen = np.flatnonzero(length <= 8) if words == 1 else np.flatnonzero((length > 8) & (length <= 16))
        if len(chosen):
            keys = packed(raw, begin[chosen], length[chosen], words)
            order = radix_order(group[chosen].astype(np.uint64), *keys[::-1])
            edge = np.ones(len(chosen), bool)
            edge[1:] = np.any([np.diff(k[order]) != 0 for k in (group[chosen], *keys)], axis=0)
            at, n, docs = _runs(edge, order, row[chosen])
            found.append((chosen[at], n, docs))
    long = np.flatnonzero(length > 16)
    width = np.ceil(np.log2(np.maximum(length[long], 1))).astype(np.int64)
    for w in np.unique(width):
        chosen = long[width == w]
        held = np.zeros((len(chosen), 1 << int(w)), np.uint8)
        inner = np.repeat(np.arange(len(chosen)), length[chosen])
        at = spread_ranges(begin[chosen], length[chosen])
        held[inner, at - begin[chosen][inner]] = raw[at]
        terms = held.view(f"S{1 << int(w)}")[:, 0]
        by_bytes = np.argsort(terms, kind="stable")
        order = by_bytes[np.argsort(group[chosen][by_bytes], kind="stable")]
        edge = np.ones(len(chosen), bool)
        edge[1:] = (terms[order][1:] != terms[order][:-1]) | (np.diff(group[chosen][order]) != 0)
        at, n, docs = _runs(edge, order, row[chosen])
        found.append((chosen[at], n, docs))
    if not found:
        return (np.zeros(0, np.int64),) * 3
    return tuple(np.concatenate(part) for part in zip(*found))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in pieces(batches, BATCH_BYTES):
        raw, starts = text_bytes(batch.column("text"))
        raw = lower_ascii(raw)
        row, begin, end = byte_runs(raw, starts, _INSIDE)
        lang = batch.column("lang").dictionary_encode()
        source = batch.column("source").dictionary_encode()
        many = len(source.dictionary)
        of_row = lang.indices.to_numpy().astype(np.int64) * many + source.indices.to_numpy()
        _, of_row = np.unique(of_row, return_inverse=True)  # small numbers have fewer digits
        at, n, docs = term_counts(raw, row, begin, end - begin, of_row[row])
        if len(at):
            rows = pa.array(row[at])
            yield pa.RecordBatch.from_arrays(
                [batch.column("lang").take(rows), batch.column("source").take(rows),
                 strings_at(raw, begin[at], (end - begin)[at]).cast(pa.string()),
                 pa.array(n, pa.int64()), pa.array(docs, pa.int64())],
                ["lang", "source", "term", "n", "docs"],
            )


def kept_terms(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS) -> DataFrame:
    """(lang, source, term, n, lang_n, first): counts of the terms in at least ``least_documents`` of a lang.

    ``lang_n`` counts the term in the whole lang; ``first`` is true in one row of each (lang, term).
    """
    counts = docs.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    summed = counts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    term = Window.partitionBy("lang", "term")  # one row for each source at most
    whole = summed.select(
        "lang", "source", "term", "n", F.sum("docs").over(term).alias("in_docs"), F.sum("n").over(term).alias("lang_n"),
        (F.min("source").over(term) == F.col("source")).alias("first"),
    )
    return whole.where(F.col("in_docs") >= least_documents).drop("in_docs")


def _share(n: str, total: str) -> Column:
    """1 + floor(1000000000 * (n + 5) / (total + 5 * terms)), in whole numbers of up to 38 digits."""
    return F.expr(
        f"1 + (cast(1000000000 AS decimal(10,0)) * (cast({n} AS decimal(20,0)) + cast(5 AS decimal(1,0))))"
        f" div (cast({total} AS decimal(20,0)) + cast(5 AS decimal(1,0)) * cast(terms AS decimal(20,0)))"
    )


def _differences(key: tuple, terms: pa.Table, groups: pa.Table) -> pa.Table:
    """Sums of the differences of shares between all sources of a lang, over some of its terms."""
    sources = groups.column("source").to_pylist()
    order = {s: k for k, s in enumerate(sources)}
    none = np.array(groups.column("none").to_pylist(), np.int64)
    many = len(sources)
    coded = terms.column("term").combine_chunks().dictionary_encode()
    number = coded.indices.to_numpy()
    source = np.array([order[s] for s in terms.column("source").to_pylist()], np.int64)
    share = terms.column("p").to_numpy()
    by_term = np.argsort(number, kind="stable")
    total = np.zeros((many, many), np.int64)
    block = max(1, BLOCK_CELLS // max(1, many))
    for low in range(0, len(coded.dictionary), block):
        a, b = np.searchsorted(number[by_term], [low, low + block])
        chosen = by_term[a:b]
        cells = np.tile(none, (min(block, len(coded.dictionary) - low), 1))
        cells[number[chosen] - low, source[chosen]] = share[chosen]
        for i in range(many - 1):
            total[i, i + 1 :] += np.abs(cells[:, i + 1 :] - cells[:, i : i + 1]).sum(axis=0)
    total += total.T
    i, j = np.nonzero(~np.eye(many, dtype=bool))
    names = np.array(sources, object)
    return pa.table({
        "lang": pa.array([key[0].as_py()] * len(i), pa.string()), "source": pa.array(names[i], pa.string()),
        "item": pa.array(names[j], pa.string()), "value": pa.array(total[i, j], pa.int64()),
    })


def divergence(
    docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, most_rank: int = MOST_RANK, group_rows: int = GROUP_ROWS
) -> DataFrame:
    """lang, source, part, item, value, rank of the sources of each lang.

    Part ``pair``: how far the source's shares of the kept terms lie from those of each other source,
    summed.  Part ``term``: the terms it uses more than its lang, by the difference, down to
    ``most_rank``.  Nulls in text, lang and source count as empty text and as the name ''.  A
    source without kept terms, or of a lang without any, has its pairs too.  Ties go by the item's
    bytes; equal rows count each; an empty table gives no rows.  Counts of kept terms are written
    to the shared folder once.
    """
    empty = F.lit("")
    read = docs.select(*[F.coalesce(c, empty).alias(c) for c in ("lang", "source", "text")])
    kept = stored(kept_terms(read, least_documents), "terms")
    of_lang = kept.groupBy("lang").agg(
        F.sum("n").alias("lang_total"), F.count_if("first").alias("terms"), F.count("*").alias("rows")
    )
    of_source = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = stored(
        read.select("lang", "source").distinct().join(of_source, ["lang", "source"], "left").join(of_lang, "lang", "left")
        .select("lang", "source", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("total", "lang_total", "terms", "rows")])
        .withColumn("none", F.when(F.col("terms") > 0, _share("0", "total")).otherwise(0)),
        "groups",
    )
    # a source may have a large part of all rows: both sides carry a salt
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    salted = kept.withColumn("salt", F.pmod(F.xxhash64("term"), F.lit(SALTS)).cast("int"))
    known = salted.join(groups.drop("none").withColumn("salt", salts), ["lang", "source", "salt"]).select(
        "lang", "source", "term", _share("n", "total").alias("p"), _share("lang_n", "lang_total").alias("q"), "rows"
    )
    order = [F.desc("value"), F.asc("item")]
    by_source = Window.partitionBy("lang", "source").orderBy(*order)
    terms = (
        known.select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                     (F.col("p") - F.col("q")).alias("value"))
        .where(F.col("value") > 0).withColumn("rank", F.row_number().over(by_source)).where(F.col("rank") <= most_rank)
    )
    parts = F.expr(f"1 + rows div {int(group_rows)}")
    of_terms = known.select("lang", F.pmod(F.xxhash64("term"), parts).alias("some"), "source", "term", "p")
    of_groups = groups.select("lang", F.explode(F.sequence(F.lit(0).cast("long"), parts - 1)).alias("some"), "source", "none")
    pairs = (
        of_terms.groupBy("lang", "some").cogroup(of_groups.groupBy("lang", "some"))
        .applyInArrow(_differences, "lang string, source string, item string, value long")
        .groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
        .withColumn("rank", F.row_number().over(by_source))
        .select("lang", "source", F.lit("pair").alias("part"), "item", "value", "rank")
    )
    return pairs.unionByName(terms)
