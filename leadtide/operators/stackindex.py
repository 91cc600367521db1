"""Bitmap index of technology lists: searches and counts by technology without testing the lists.

Rows get numbers, and each technology one bitmap of 4 KB for each block of 32,768 numbers in
which it occurs.  A searched name is looked up in the names of technologies only; bitmaps of the
names it stands in are united, those of all searched names intersected, and rows of blocks
with a hit are read and picked by their bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leadtide.operators.report import has_techs

NUMBER, BLOCK = "_number", "_block"


def build_index(rows: DataFrame, folder: str, column: str = "tech_stack") -> None:
    """Number and write ``rows`` and the bitmaps of the technologies in ``column`` (comma-separated).

    Numbers go on within a task, so a task of few rows has blocks of its own.  Bitmaps combine before
    the shuffle, so a technology of a third of all rows is one bitmap for each block.
    """
    spark = rows.sparkSession
    number = F.monotonically_increasing_id() + 1
    numbered = rows.withColumn(NUMBER, number).withColumn(BLOCK, F.bitmap_bucket_number(NUMBER))
    numbered.write.mode("overwrite").parquet(f"{folder}/rows")
    kept = spark.read.schema(numbered.schema).parquet(f"{folder}/rows")
    named = kept.where(F.col(column) != "").select(F.explode(F.split(column, ",")).alias("tech"), NUMBER, BLOCK)
    bits = named.groupBy("tech", BLOCK).agg(F.bitmap_construct_agg(F.bitmap_bit_position(NUMBER)).alias("bits"))
    bits.write.mode("overwrite").option("compression", "zstd").parquet(f"{folder}/bits")


def _bits(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(f"tech string, {BLOCK} bigint, bits binary").parquet(f"{folder}/bits")


def _indexed(techs: list[str]) -> list[str]:
    """Names that the names of technologies decide; others are looked for in the lists themselves."""
    return sorted({t for t in techs if t and "," not in t})


def hit_bits(spark: SparkSession, folder: str, techs: list[str]) -> DataFrame:
    """Block and bitmap of the rows whose technologies name all of ``techs``, of which none is empty or has a comma."""
    wanted = F.filter(F.array(*map(F.lit, techs)), lambda t: F.contains(F.col("tech"), t))
    found = _bits(spark, folder).select(BLOCK, F.explode(wanted).alias("wanted"), "bits")
    each = found.groupBy(BLOCK, "wanted").agg(F.bitmap_or_agg("bits").alias("bits"))
    every = each.groupBy(BLOCK).agg(F.bitmap_and_agg("bits").alias("bits"), F.count("*").alias("n"))
    return every.where((F.col("n") == len(techs)) & (F.bitmap_count("bits") > 0)).select(BLOCK, "bits")


def _has_bit(number: Column, bits: Column) -> Column:
    place = F.bitmap_bit_position(number)
    byte = F.conv(F.hex(F.substring(bits, (place / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.getbit(byte, (place % 8).cast("int")) == 1


def search(rows: DataFrame, folder: str, techs: list[str], column: str = "tech_stack") -> DataFrame:
    """The rows whose list names all of ``techs``, as ``has_techs`` does.  ``rows`` is ``indexed_rows``, or a filter of it."""
    spark = rows.sparkSession
    known = _indexed(techs)
    others = [t for t in techs if t not in known]
    if others:
        rows = rows.where(has_techs(others, column=column))
    if known:
        hits = hit_bits(spark, folder, known).withColumnRenamed("bits", "_bits")
        rows = rows.join(hits, BLOCK).where(_has_bit(F.col(NUMBER), F.col("_bits"))).drop("_bits")
    return rows.drop(NUMBER, BLOCK)


def indexed_rows(spark: SparkSession, folder: str) -> DataFrame:
    """The rows of an index, with their numbers."""
    return spark.read.parquet(f"{folder}/rows")


def hit_count(spark: SparkSession, folder: str, techs: list[str]) -> DataFrame:
    """One row: how many rows name all of ``techs``; no row is read unless a name is empty or has a comma."""
    if not techs or len(_indexed(techs)) < len(set(techs)):
        return search(indexed_rows(spark, folder), folder, techs).agg(F.count("*").alias("found"))
    total = F.sum(F.bitmap_count("bits"))
    return hit_bits(spark, folder, _indexed(techs)).agg(F.coalesce(total, F.lit(0)).alias("found"))


def tech_counts(spark: SparkSession, folder: str) -> DataFrame:
    """Rows of each technology (see ``tech_distribution``), by the bits that are set."""
    return _bits(spark, folder).groupBy(F.trim("tech").alias("tech")).agg(
        F.sum(F.bitmap_count("bits")).alias("company_count")
    )
