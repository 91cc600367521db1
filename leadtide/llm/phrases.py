"""Collocations by Toivonen's mining of a sample and its negative border.

A sample of the documents proposes what may be frequent: words and word pairs whose count in it
reaches a lowered bound.  A pass over all documents then counts exactly every word, every pair of
proposed words and every triple of proposed pairs: the proposals and their negative border, the
phrases that are not proposed although all their parts are.  If the border turns out to hold
frequent phrases, these join the proposals, and a further pass counts what the larger border
holds beyond the former one, until no border phrase is frequent.  Then every frequent phrase
has been counted: its parts are frequent, so they are proposed.

Proposals are kept as bitmaps of a fixed size, in which phrases are found by a hash.  Chance hits
make the border larger, never smaller, so the counts stay exact at any size; they are sums over
all documents, combined in the tasks, of phrases as text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame, Window, functions as F

from leadtide.llm.common import byte_runs, lower_ascii, pieces, stored, strings_at, text_bytes

LEAST = 10
MOST_RANK = 2000
LONGER_SHARE = 50
#: One document of so many is in the sample, and so often a phrase must stand there to be proposed
#: (a phrase of ten stands there 2.5 times on average).
SAMPLE_OF = 4
LEAST_IN_SAMPLE = 2
#: Bits of a bitmap of proposals, 8 MB: a power of two and a multiple of the bits of one bucket.
BITS = 1 << 26
BUCKET_BITS = 32768
BATCH_BYTES = 4 << 20
#: Rows of a batch that a task gives out.
OUT_ROWS = 1 << 16
#: Cells of the table that numbers the words of a batch.
MOST_CELLS = 8 << 20
SALTS = 16

_BLANK, _LINE_END = pa.scalar(" ", pa.large_string()), pa.scalar("\n", pa.large_string())
_SPACE = np.zeros(256, bool)
_SPACE[[9, 32]] = True
_STOP = np.zeros(256, bool)
_STOP[[*b".,;:!?", 10, 11, 12, 13]] = True


@dataclass
class Proposals:
    """Bitmaps of words and of pairs."""

    words: np.ndarray
    pairs: np.ndarray

    @staticmethod
    def none() -> Proposals:
        return Proposals(np.zeros(BITS // 8, np.uint8), np.zeros(BITS // 8, np.uint8))

    def __or__(self, other: Proposals) -> Proposals:
        return Proposals(self.words | other.words, self.pairs | other.pairs)


def _held(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(BITS - 1)
    return (bitmap[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(langs: pa.Array, words: pa.Array) -> np.ndarray:
    """A hash of each (lang, word); words are not empty."""
    if not len(words):
        return np.zeros(0, np.uint64)
    coded = langs.dictionary_encode()
    seeds = [xxhash.xxh64_intdigest(lang.encode("utf-8")) for lang in coded.dictionary.to_pylist()]
    raw, starts = text_bytes(words)
    length = np.diff(starts)
    powers = np.cumprod(np.full(int(length.max()), 0x9E3779B97F4A7C15, np.uint64))
    terms = (raw.astype(np.uint64) + np.uint64(1)) * powers[np.arange(len(raw)) - np.repeat(starts[:-1], length)]
    return _mixed(np.add.reduceat(terms, starts[:-1]) ^ np.array(seeds, np.uint64)[coded.indices.to_numpy()])


def pair_hashes(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """A hash of each pair from those of its words."""
    return _mixed(first * np.uint64(0x9E3779B97F4A7C15) + second)


class Words:
    """The words of a batch: for each occurrence the number of its (lang, word) and of its piece."""

    def __init__(self, batch: pa.RecordBatch):
        raw, starts = text_bytes(batch.column("text"))
        raw = lower_ascii(raw)
        stop = _STOP[raw]
        row, begin, end = byte_runs(raw, starts, ~(_SPACE | _STOP))
        stops = np.cumsum(stop)
        self.piece = row + (stops[begin] if len(begin) else begin)  # grows with each stop and each row
        langs = batch.column("lang").fill_null("und").dictionary_encode()
        words = strings_at(raw, begin, end - begin).dictionary_encode()
        many = max(1, len(words.dictionary))
        key = langs.indices.to_numpy()[row].astype(np.int64) * many + words.indices.to_numpy()
        if len(langs.dictionary) * many <= MOST_CELLS:  # numbered by a table, without a sort
            seen = np.zeros(len(langs.dictionary) * many, bool)
            seen[key] = True
            keys = np.flatnonzero(seen)
            self.number = (np.cumsum(seen) - 1)[key]
        else:
            keys, self.number = np.unique(key, return_inverse=True)
        self.langs = langs.dictionary.take(pa.array(keys // many)).cast(pa.large_string())
        self.texts = words.dictionary.take(pa.array(keys % many))
        self.hashes = word_hashes(self.langs, self.texts)

    def after(self) -> np.ndarray:
        """Places of words that the next word follows in the same piece."""
        return np.flatnonzero(self.piece[1:] == self.piece[:-1])


def _counted(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The different keys, how often each stands, and for each place the number of its key."""
    found, number, counts = np.unique(keys, return_inverse=True, return_counts=True)
    return found, counts, number


def _sample_rows(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """(kind, hash, n) of the words and pairs of a batch."""
    w = Words(batch)
    at = w.after()
    pairs, counts, _ = _counted(pair_hashes(w.hashes[w.number[at]], w.hashes[w.number[at + 1]]))
    for kind, hashes, n in ((1, w.hashes, np.bincount(w.number, minlength=len(w.hashes))), (2, pairs, counts)):
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(n), kind, np.int32)), pa.array(hashes.view(np.int64)), pa.array(n.astype(np.int64))],
            ["kind", "hash", "n"],
        )


def _count_rows(batch: pa.RecordBatch, now: Proposals, before: Proposals | None) -> Iterator[pa.RecordBatch]:
    """(key, n) of what ``now`` has counted and ``before`` has not (None: not even words).

    A key is the lang, a line end, which no phrase holds, and the phrase; none stands for all words."""
    w = Words(batch)

    def out(keys: pa.Array, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        for low in range(0, len(counts), OUT_ROWS):
            part = slice(low, low + OUT_ROWS)
            yield pa.RecordBatch.from_arrays([keys[part].cast(pa.string()), pa.array(counts[part], pa.int64())], ["key", "n"])

    if not len(w.number):
        return
    words = pc.binary_join_element_wise(w.langs, w.texts, _LINE_END)
    if before is None:
        counts = np.bincount(w.number, minlength=len(w.hashes))
        yield from out(words, counts)
        lang = w.langs.dictionary_encode().indices.to_numpy()  # rises, as entries are in order of lang
        first = np.flatnonzero(np.diff(lang, prepend=-1))
        none = pa.array([""] * len(first), pa.large_string())
        langs = pc.binary_join_element_wise(w.langs.take(pa.array(first)), none, _LINE_END)
        yield from out(langs, np.add.reduceat(counts, first))
    many = len(w.hashes)
    at = w.after()

    def proposed(p: Proposals) -> np.ndarray:
        word = _held(p.words, w.hashes)
        return word[w.number[at]] & word[w.number[at + 1]]

    inside = proposed(now)
    beyond = inside & ~proposed(before) if before is not None else inside
    at_in = at[inside]
    keys, counts, number = _counted(w.number[at_in].astype(np.int64) * many + w.number[at_in + 1])
    first, second = keys // many, keys % many
    hashes = pair_hashes(w.hashes[first], w.hashes[second])
    texts = pc.binary_join_element_wise(words.take(pa.array(first)), w.texts.take(pa.array(second)), _BLANK)
    fresh = np.zeros(len(keys), bool)
    fresh[number[beyond[inside]]] = True
    new = np.flatnonzero(fresh)
    yield from out(texts if len(new) == len(texts) else texts.take(pa.array(new)), counts[new])
    # triples of two proposed pairs, one after the other
    ok = _held(now.pairs, hashes)[number]
    next_ = np.flatnonzero((at_in[1:] == at_in[:-1] + 1) & ok[1:] & ok[:-1])
    if before is not None:
        was = (_held(before.pairs, hashes) & ~fresh)[number]
        next_ = next_[~(was[next_] & was[next_ + 1])]
    triples, counts, _ = _counted(number[next_].astype(np.int64) * many + w.number[at_in[next_] + 2])
    pair, third = triples // many, triples % many
    yield from out(
        pc.binary_join_element_wise(texts.take(pa.array(pair)), w.texts.take(pa.array(third)), _BLANK), counts
    )


def _hash_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(kind, hash) of frequent words and pairs."""
    for batch in batches:
        langs, parts = batch.column("lang"), [p.split(" ") for p in batch.column("phrase").to_pylist()]
        hashes = word_hashes(langs, pa.array([p[0] for p in parts], pa.string()))
        last = word_hashes(langs, pa.array([p[-1] for p in parts], pa.string()))
        size = batch.column("size").to_numpy()
        hashes = np.where(size == 2, pair_hashes(hashes, last), hashes) if len(size) else hashes
        yield pa.RecordBatch.from_arrays(
            [batch.column("size"), pa.array(hashes.view(np.int64))], ["kind", "hash"]
        )


def _proposals(hashes: DataFrame) -> Proposals:
    """The bitmaps of (kind, hash) rows: at most 2 * BITS / BUCKET_BITS rows of one bucket each come back."""
    at = F.pmod("hash", F.lit(BITS)) + 1
    buckets = (
        hashes.groupBy("kind", F.bitmap_bucket_number(at).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).collect()
    )
    found = Proposals.none()
    for kind, bucket, bits in buckets:
        place = (bucket - 1) * (BUCKET_BITS // 8)
        (found.words if kind == 1 else found.pairs)[place : place + len(bits)] = np.frombuffer(bytes(bits), np.uint8)
    return found


def propose(texts: DataFrame, sample_of: int, least_in_sample: int) -> Proposals:
    """What the sample, one document of ``sample_of`` by a hash of its text, has often enough."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, BATCH_BYTES):
            yield from _sample_rows(batch)

    sample = texts.where(F.pmod(F.xxhash64("text"), F.lit(sample_of)) == 0)
    counts = sample.mapInArrow(run, "kind int, hash long, n long").groupBy("kind", "hash").agg(F.sum("n").alias("n"))
    return _proposals(counts.where(F.col("n") >= least_in_sample))


def _missed(frequent: DataFrame, now: Proposals, shared: Broadcast) -> Proposals | None:
    """The frequent words and pairs that are not proposed; None if there are none."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, _ = shared.value
        for batch in _hash_rows(batches):
            hashes = batch.column("hash").to_numpy().view(np.uint64)
            kind = batch.column("kind").to_numpy()
            held = np.where(kind == 1, _held(now.words, hashes), _held(now.pairs, hashes))
            yield batch.filter(pa.array(~held))

    found = _proposals(frequent.where("size IN (1, 2)").mapInArrow(run, "kind int, hash long"))
    return found if found.words.any() or found.pairs.any() else None


def frequent_phrases(
    docs: DataFrame, least: int = LEAST, sample_of: int = SAMPLE_OF, least_in_sample: int = LEAST_IN_SAMPLE
) -> DataFrame:
    """(lang, size, phrase, n): all phrases of one to three words that stand at least ``least`` times in a
    lang, and for each lang the number of all its words, as size 0.

    Null texts count as empty and a null lang as ``und``.  Phrases stay within the pieces between
    stops; equal rows count each.  An empty table gives no rows.  What each pass finds is written
    to the shared folder; the bitmaps are broadcast.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))

    def counted(shared: Broadcast) -> DataFrame:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, before = shared.value
            for batch in pieces(batches, BATCH_BYTES):
                yield from _count_rows(batch, now, before)

        # what a batch has counted hardly repeats in a task, so it is dealt out before it is summed
        sums = texts.mapInArrow(run, "key string, n long").repartition("key").groupBy("key").agg(F.sum("n").alias("n"))
        phrase = F.substring_index("key", "\n", -1)
        frequent = sums.withColumn("phrase", phrase).where((F.col("n") >= least) | (F.col("phrase") == ""))
        blanks = F.length("phrase") - F.length(F.replace("phrase", F.lit(" "), F.lit("")))
        return stored(frequent.select(
            F.expr("left(key, length(key) - length(phrase) - 1)").alias("lang"),
            F.when(F.col("phrase") == "", 0).otherwise(blanks + 1).alias("size"), "phrase", "n",
        ), "phrases")

    now, before = propose(texts, sample_of, least_in_sample), None
    found = None
    while True:
        shared = spark.sparkContext.broadcast((now, before))
        new = counted(shared)
        found = new if found is None else found.unionByName(new)
        missed = _missed(new, now, shared)
        shared.destroy()
        if missed is None:
            return found
        before, now = now, now | missed


def collocations(
    docs: DataFrame, least: int = LEAST, most_rank: int = MOST_RANK, longer_share: int = LONGER_SHARE, **sampling
) -> DataFrame:
    """The best phrases of two and three words of each lang: lang, rank, phrase, a, l, r, n, score.

    ``a`` counts the phrase, ``l`` and ``r`` its two parts at the cut that scores least,
    floor(1000000 * a * a / (l * r)), the first of equal cuts.  A pair whose words stand in a
    triple that makes up at least ``longer_share`` per cent of its count is left out.  Ranks go
    by score, count and phrase (bytes), so there are no ties.  See ``frequent_phrases`` for
    nulls, repeated rows and empty tables.
    """
    found = stored(frequent_phrases(docs, least, **sampling), "frequent")
    words = found.where("size = 0").select("lang", F.col("n").alias("words"))
    counts = found.where("size > 0")
    longer = counts.where("size > 1")
    x = "substring_index(phrase, ' ', 1)"
    rest = f"substring(phrase, length({x}) + 2)"
    two, last = "substring_index(phrase, ' ', 2)", "substring_index(phrase, ' ', -1)"
    cuts = F.expr(
        f"if(size = 2, array(struct(1 AS k, {x} AS head, {rest} AS tail)),"
        f" array(struct(1 AS k, {x} AS head, {rest} AS tail), struct(2 AS k, {two} AS head, {last} AS tail)))"
    )
    # heads and tails may be one word for a large part of all phrases, so they meet salted
    salted = counts.where("size < 3").select("lang", F.col("phrase").alias("part"), F.col("n").alias("part_n")).withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
    )
    heads = salted.select("lang", "salt", F.col("part").alias("head"), F.col("part_n").alias("l"))
    tails = salted.select("lang", "salt", F.col("part").alias("tail"), F.col("part_n").alias("r"))
    cut = (
        longer.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int"))
        .select("lang", "size", "phrase", "salt", F.col("n").alias("a"), F.explode(cuts).alias("cut"))
        .select("lang", "size", "phrase", "salt", "a", "cut.*")
        .join(heads, ["lang", "salt", "head"]).join(tails, ["lang", "salt", "tail"])
    )
    score = F.expr(
        "(cast(a AS decimal(15,0)) * cast(a AS decimal(15,0)) * cast(1000000 AS decimal(7,0)))"
        " div (cast(l AS decimal(15,0)) * cast(r AS decimal(15,0)))"
    )
    scored = (
        cut.withColumn("score", score).groupBy("lang", "size", "phrase", "a")
        .agg(F.min(F.struct("score", "k", "l", "r")).alias("least"))
        .select("lang", "size", "phrase", "a", "least.l", "least.r", "least.score")
    )
    holders = (
        counts.where("size = 3").select("lang", "n", F.explode(F.expr(f"array({two}, {rest})")).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("n").alias("holder"))
    )
    free = scored.join(holders, ["lang", "phrase"], "left").where(
        "size = 3 OR holder IS NULL OR 100 * cast(holder AS decimal(20,0)) < "
        f"{int(longer_share)} * cast(a AS decimal(20,0))"
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # the best of each of some shares of a lang first, so that no task sorts a whole lang
    share = F.pmod(F.xxhash64("phrase"), F.lit(4 * SALTS))
    some = Window.partitionBy("lang", "share").orderBy(*order)
    best = free.withColumn("share", share).withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= most_rank)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)))
    return ranked.where(F.col("rank") <= most_rank).join(words, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", F.col("words").alias("n"), "score"
    )
