"""Normalisation and deduplication of postings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from leadtide.functions.scores import share
from leadtide.functions.text import normalise, packed, percent_text, unpacked

# "First" in a total order, so that the kept row does not depend on the partitioning.
FIRST_ORDER = [
    "first_scraped_at", "job_id", "title", "description", "location", "url", "source",
    "company", "last_scraped_at", "posting_date",
]
# The texts among them, which follow one another and travel as one text in the same order.
TEXTS = FIRST_ORDER[1:8]


def with_normalised(raw: DataFrame) -> DataFrame:
    return raw.withColumns(
        {"company_normalized": normalise("company"), "title_normalized": normalise("title")}
    )


def clean_key() -> Column:
    """128 bits for each key of the cleaned table."""
    place = F.coalesce("location", F.lit(""))
    return F.unhex(F.md5(packed("company_normalized", "title_normalized", place)))


def clean_postings(raw: DataFrame) -> DataFrame:
    """One row per normalised company, normalised title and location (NULL = empty).

    The smallest row in ``FIRST_ORDER`` is kept.
    """
    return merge_postings(raw, spans=False).drop("kept_at")


def merge_postings(rows: DataFrame, *, spans: bool = True) -> DataFrame:
    """The same of raw postings that stand for others too: seen from ``first_seen`` to ``last_seen``
    (without ``spans`` from their first to their last scrape).

    ``kept_at`` tells the first scrape of the row that is kept; with it as ``first_scraped_at``
    a cleaned row meets further postings of its key as all rows would that it stands for.

    ``min`` over the whole row as a struct combines before the shuffle, so a key that holds a
    large part of the table reaches its reducer as one row per map task; a window would bring
    all its rows there.  This aggregation sorts and spills what it is given, so it gets narrow
    rows: 128 bits in place of the three texts of the key, and one text in place of seven, which
    compares as these do.  The normalised texts are those of the kept row.
    """
    return _widened(_grouped(rows, spans)).drop("clean_key")


def merge_into(held: DataFrame, rows: DataFrame) -> DataFrame:
    """``clean_key`` and the same of raw postings and of held cleaned rows (one a key) together, for the keys of ``rows``.

    The postings are combined first and meet the held rows by key: these are not shuffled where they
    lie in buckets of ``clean_key``.
    """
    new = _grouped(rows, spans=False).withColumnRenamed("_key", "clean_key")
    as_raw = held.withColumns({"first_scraped_at": F.col("kept_at"), "last_scraped_at": F.col("last_seen")})
    old = as_raw.select(
        "clean_key", _narrow_row().alias("_held"), F.col("first_seen").alias("_from"), F.col("last_seen").alias("_to")
    )
    both = new.join(old, "clean_key", "left").select(
        F.col("clean_key").alias("_key"),
        F.least("_first", "_held").alias("_first"),
        F.least("first_seen", "_from").alias("first_seen"),
        F.greatest("last_seen", "_to").alias("last_seen"),
    )
    return _widened(both)


def _narrow_row() -> Column:
    rest = [c for c in FIRST_ORDER if c not in TEXTS]
    return F.struct(rest[0], packed(*TEXTS).alias("texts"), *rest[1:])


def _grouped(rows: DataFrame, spans: bool) -> DataFrame:
    """For each key its smallest row, narrow, and its span."""
    narrow = with_normalised(rows).select(
        clean_key().alias("_key"),
        _narrow_row().alias("_row"),
        *(["first_seen", "last_seen"] if spans else []),
    )
    return narrow.groupBy("_key").agg(
        F.min("_row").alias("_first"),
        F.min("first_seen" if spans else "_row.first_scraped_at").alias("first_seen"),
        F.max("last_seen" if spans else "_row.last_scraped_at").alias("last_seen"),
    )


def _widened(grouped: DataFrame) -> DataFrame:
    """The columns of narrow rows again."""
    kept = {name: F.col(f"_first.{name}") for name in FIRST_ORDER if name not in TEXTS}
    kept |= dict(zip(TEXTS, unpacked(F.col("_first.texts"), len(TEXTS))))
    first = grouped.select(
        F.col("_key").alias("clean_key"), *[kept[name].alias(name) for name in FIRST_ORDER], "first_seen", "last_seen"
    )
    return with_normalised(first).select(
        "clean_key",
        "job_id",
        "company",
        "company_normalized",
        "title",
        "title_normalized",
        "description",
        "location",
        "posting_date",
        "url",
        "source",
        "first_seen",
        "last_seen",
        F.col("first_scraped_at").alias("kept_at"),
    )


def dedup_accounting(raw: DataFrame, cleaned: DataFrame) -> DataFrame:
    """One row: rows before and after, rows removed, and their share as text."""
    before = raw.agg(F.count("*").alias("raw_job_count"))
    return accounted(before.withColumn("cleaned_job_count", cleaned.agg(F.count("*")).scalar()))


def accounted(counts: DataFrame) -> DataFrame:
    """The same from the two counts."""
    removed = F.col("raw_job_count") - F.col("cleaned_job_count")
    return counts.select(
        "raw_job_count",
        "cleaned_job_count",
        removed.alias("duplicates_removed"),
        percent_text(share(removed, F.col("raw_job_count")), 1).alias("deduplication_rate"),
    )
