"""Which of many needles occur in which texts, by an index of the needles' rarest grams.

A needle that occurs in a text brings all its grams (runs of five characters) along, so it is
enough to look for it in texts that hold the one of its grams that texts hold least.  Needles
are keyed by that gram; texts give out those of their grams that are keys, and meet the
needles there; what meets is tested.  Everything is a join or an aggregation of built-in
expressions, so needles and texts may both be of any number.  Both are read several times:
needles are written to the shared folder for that, and callers pass a stored table of texts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from leadtide.sources.tables import store

GRAM = 5
#: Grams in use are looked up in a bitmap of so many bits (128 KB) before texts are dealt out by
#: them; chance hits find no needle in the join.
BITS = 1 << 20
#: Texts are cut into blocks of so many characters, which overlap by the length of a gram less one.
BLOCK = 1 << 16
#: One text of so many is asked how common grams are; that decides the key of a needle, not the result.
ASKED_OF = 8
SALTS = 16
#: Needles up to this many, and bytes of needles and of ``what``, are sent to the texts instead of dealing both out by
#: gram.  This chooses the plan only.
BROADCAST_NEEDLES = 500_000
BROADCAST_BYTES = 32_000_000
#: Where counts are known, only keys of more rows are salted when these meet what was found.
HOT_ROWS = 1_000


def _place(name: str) -> tuple[Column, Column]:
    """The word of the hash of a column in the bitmap, and its bit there."""
    at = f"pmod(xxhash64({name}), {BITS}L)"
    return F.expr(f"cast({at} div 64 AS int)"), F.expr(f"shiftleft(1L, cast({at} % 64 AS int))")


def text_key(*parts: Column) -> Column:
    """128 bits of the texts; equal texts are sought once."""
    whole = F.concat_ws("\u0001", *[F.concat(F.length(p).cast("string"), F.lit(":"), p) for p in parts])
    return F.unhex(F.md5(whole))


def _runs_of(text: Column, length: int) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?s)(?=(.{{{length}}}))"), F.lit(1))


def _keys_of(needle: Column) -> Column:
    """The grams that a needle may be keyed by; one shorter than a gram is its own."""
    return F.when(F.length(needle) < GRAM, F.array(needle)).otherwise(F.array_distinct(_runs_of(needle, GRAM)))


def _bitmap(held: DataFrame, name: str) -> Column:
    """The hashes of a column as BITS / 64 longs, a scalar subquery."""
    word, bit = _place(name)
    held = held.groupBy(word.alias("word")).agg(F.bit_or(bit).alias("bits"))
    every = held.sparkSession.range(BITS // 64).withColumnRenamed("id", "word").join(held, "word", "left")
    row = F.array_sort(F.collect_list(F.struct("word", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    return every.agg(F.transform(row, lambda w: w["bits"]).alias("bits")).scalar()


def _in_bitmap(bits: Column, name: str) -> Column:
    """Whether the bit of a column is set."""
    word, bit = _place(name)
    return F.element_at(bits, word + 1).bitwiseAND(bit) != 0


def _grams_in(texts: DataFrame, used: DataFrame) -> DataFrame:
    """(key, gram) of the grams in use, with chance hits, once for each block of a text."""
    at = F.explode_outer(F.sequence(F.lit(0), F.greatest(F.length("part") - 1, F.lit(0)), F.lit(BLOCK)))
    blocks = (
        texts.select("key", F.explode_outer("parts").alias("part")).select("key", "part", at.alias("at"))
        .select("key", F.expr(f"substring(part, at + 1, {BLOCK + GRAM - 1})").alias("block"))
    )
    lengths = used.agg(F.collect_set(F.length("gram"))).scalar()  # GRAM + 1 at most
    grams = F.concat(*[
        F.when(F.array_contains(lengths, n), _runs_of(F.col("block"), n) if n else F.array(F.lit("")))
        .otherwise(F.array().cast("array<string>")) for n in range(GRAM + 1)
    ])
    # the outer form: a plain explode computes the array twice, once to see whether it is empty
    rows = blocks.select("key", F.explode_outer(F.array_distinct(grams)).alias("gram"))
    return rows.where(F.col("gram").isNotNull() & _in_bitmap(_bitmap(used, "gram"), "gram"))


def _few(needles: DataFrame) -> bool:
    """Whether the needles are within the limits of a broadcast."""
    size = F.octet_length("needle") + F.coalesce(F.octet_length(F.col("what").cast("string")), F.lit(0))
    n, chars = needles.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    return n <= BROADCAST_NEEDLES and chars <= BROADCAST_BYTES


def substring_hits(texts: DataFrame, needles: DataFrame) -> DataFrame:
    """(key, found): for each text the ``what`` of all needles that are substrings of some part of it.

    ``texts`` has (key, parts), unique by key, parts without nulls, and is read several times; ``needles`` (needle, what),
    where ``what`` can be compared.  Texts without a hit have no row.  An empty needle is in every text.

    Needles within the limits are broadcast, and texts give out what they hold, once.  More meet the grams of the
    texts in a join by gram.  The texts themselves move only if a needle is longer than its gram.
    """
    needles = store(needles.where(F.col("needle").isNotNull()).distinct(), "needles")
    grams = needles.select("needle", F.explode(_keys_of(F.col("needle"))).alias("gram"))
    asked = texts.where(F.pmod(F.xxhash64("key"), F.lit(ASKED_OF)) == 0)
    common = _grams_in(asked, grams).groupBy("gram").agg(F.count("*").alias("texts"))
    rarest = store(
        grams.join(common, "gram", "left").groupBy("needle")
        .agg(F.min(F.struct(F.coalesce("texts", F.lit(0)).alias("texts"), "gram")).alias("best"))
        .select("needle", F.col("best.gram").alias("gram")),
        "rarest",
    )
    # a needle that is its own gram is in all texts that give the gram out, so it needs no test and does not travel (a
    # replacement character may stand for bytes that are no UTF-8)
    unsure = (F.col("needle") != F.col("gram")) | F.contains("needle", F.lit("\ufffd"))
    keyed = needles.join(rarest, "needle").select("gram", F.when(unsure, F.col("needle")).alias("needle"), "what")
    held = _grams_in(texts, rarest)
    pair = F.struct("needle", "what")
    if _few(needles):
        # a text's rows are combined by hash in the task; collect_set would sort, and spill, all that it gives out
        met = held.join(F.broadcast(keyed), "gram").select("key", "needle", "what").distinct()
        near = met.groupBy("key").agg(F.collect_list(pair).alias("near"))
    else:
        # a gram may stand in a large part of all texts
        salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))
        held = held.withColumn("salt", F.pmod(F.xxhash64("key"), F.lit(SALTS)).cast("int"))
        met = held.join(keyed.withColumn("salt", salts), ["gram", "salt"])
        near = met.groupBy("key").agg(F.collect_set(pair).alias("near"))
    if rarest.where(unsure).isEmpty():
        sure = F.col("near")
    else:
        near = texts.join(near, "key")
        sure = F.filter("near", lambda n: F.exists("parts", lambda p: n["needle"].isNull() | F.contains(p, n["needle"])))
    found = F.array_distinct(F.transform(sure, lambda n: n["what"]))
    return near.select("key", found.alias("found")).where(F.size("found") > 0)


def with_found(
    rows: DataFrame, key: Column, found: DataFrame, name: str, spread: list[str], hot: DataFrame | None = None
) -> DataFrame:
    """``rows`` with ``found`` of their key as the column ``name`` (NULL where none).

    One key may belong to a large part of all rows, so both sides carry a salt, by a hash of the
    columns ``spread``; if the keys of many rows are given in ``hot``, only these (and chance hits).
    """
    salt, salts = F.pmod(F.xxhash64(*spread), F.lit(SALTS)).cast("int"), F.sequence(F.lit(0), F.lit(SALTS - 1))
    if hot is not None:
        is_hot = _in_bitmap(_bitmap(hot.select(F.col("key").alias("_key")), "_key"), "_key")
        salt, salts = F.when(is_hot, salt).otherwise(0), F.when(is_hot, salts).otherwise(F.array(F.lit(0)))
    salted = found.select(F.col("key").alias("_key"), F.col("found").alias(name)).withColumn("_salt", F.explode(salts))
    keyed = rows.withColumn("_key", key).withColumn("_salt", salt)
    return keyed.join(salted, ["_key", "_salt"], "left").drop("_key", "_salt")
