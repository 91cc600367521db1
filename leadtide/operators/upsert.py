"""Keyed table maintenance: insert unseen keys, touch seen ones, insert-or-ignore.

Nothing here overwrites what it reads; each function returns the new rows or the new
snapshot, to be written to a new path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

# Batches up to this many keys, and bytes of keys, are sent to the snapshot instead of shuffling it.
# This chooses the plan only; the ledger in sources/ledger.py does without.
BROADCAST_KEYS = 200_000
BROADCAST_BYTES = 16_000_000

PAYLOAD = ["company", "title", "description", "location", "posting_date", "url", "source"]
RAW = ["job_id", *PAYLOAD, "first_scraped_at", "last_scraped_at"]
BATCH_ORDER = [
    "scraped_at", "title", "description", "location", "url", "source", "company", "posting_date",
]


def one_per_job(batch: DataFrame) -> DataFrame:
    """A typed batch as table rows, one per job_id: the first in a total order.

    Seen first at the earliest scrape of the batch, last at the latest.  Repeats combine
    before the shuffle.
    """
    return (
        batch.groupBy("job_id")
        .agg(F.min(F.struct(*BATCH_ORDER)).alias("_first"), F.max("scraped_at").alias("_last"))
        .select(
            "job_id",
            *[F.col(f"_first.{name}").alias(name) for name in PAYLOAD],
            F.col("_first.scraped_at").alias("first_scraped_at"),
            F.col("_last").alias("last_scraped_at"),
        )
    )


def first_per_key(rows: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """One row per key, the smallest by ``order`` (all other columns break ties)."""
    rest = [c for c in rows.columns if c not in key and c not in order]
    first = rows.groupBy(*key).agg(F.min(F.struct(*order, *rest)).alias("_first"))
    return first.select(
        *[F.col(c) if c in key else F.col(f"_first.{c}").alias(c) for c in rows.columns]
    )


def is_small(batch: DataFrame, limit: int = BROADCAST_KEYS) -> bool:
    """Whether a batch has at most ``limit`` records, of at most BROADCAST_BYTES of keys; reads no
    more than it must, and nothing where the limit is zero."""
    if limit <= 0:
        return False
    n, size = batch.select(F.octet_length("job_id").alias("size")).limit(limit + 1).agg(
        F.count("*"), F.coalesce(F.sum("size"), F.lit(0))
    ).first()
    return n <= limit and size <= BROADCAST_BYTES


def _hint(df: DataFrame, small: bool) -> DataFrame:
    return F.broadcast(df) if small else df


def known_keys(
    table: DataFrame, batch: DataFrame, limit: int = BROADCAST_KEYS, small: bool | None = None
) -> DataFrame:
    """Keys of the batch that the table holds.

    Here and below, ``small`` tells the outcome of ``is_small`` when it is known already.
    """
    small = is_small(batch, limit) if small is None else small
    keys = batch.select("job_id").distinct()
    return table.select("job_id").join(_hint(keys, small), "job_id", "left_semi")


def new_postings(
    table: DataFrame, batch: DataFrame, limit: int = BROADCAST_KEYS, small: bool | None = None
) -> DataFrame:
    """Rows of the batch whose key the table does not hold.

    For a small batch the table is scanned for its keys only, and stays where it is; what
    it holds of the batch is no larger than the batch.
    """
    small = is_small(batch, limit) if small is None else small
    known = known_keys(table, batch, small=True).distinct() if small else table.select("job_id")
    return one_per_job(batch).join(_hint(known, small), "job_id", "left_anti")


def touch(
    table: DataFrame, batch: DataFrame, limit: int = BROADCAST_KEYS, small: bool | None = None
) -> DataFrame:
    """The table with ``last_scraped_at`` taken from the batch where the key occurs in it."""
    small = is_small(batch, limit) if small is None else small
    seen = batch.groupBy("job_id").agg(F.max("scraped_at").alias("_seen"))
    return table.join(_hint(seen, small), "job_id", "left").select(
        *[c for c in RAW if c != "last_scraped_at"],
        F.coalesce("_seen", "last_scraped_at").alias("last_scraped_at"),
    )


def _merged(table: DataFrame, new: DataFrame) -> DataFrame:
    """The table with the last sightings of ``new``, which is unique by key, and the rows of its other keys.

    As in a join, a NULL key is like no other.
    """
    of_key = Window.partitionBy("job_id")
    rows = table.select(*RAW, F.lit(False).alias("_new")).union(new.select(*RAW, F.lit(True)))
    rows = rows.withColumns({
        "_known": F.max(~F.col("_new")).over(of_key),
        "_seen": F.max(F.when(F.col("_new"), F.col("last_scraped_at"))).over(of_key),
    })
    no_key, last = F.col("job_id").isNull(), F.col("last_scraped_at")
    return rows.where(~F.col("_new") | ~F.col("_known") | no_key).select(
        *[c for c in RAW if c != "last_scraped_at"],
        F.when(no_key, last).otherwise(F.coalesce("_seen", last)).alias("last_scraped_at"),
    )


def upsert_postings(
    table: DataFrame, batch: DataFrame, limit: int = BROADCAST_KEYS, *, keyed: bool = False
) -> DataFrame:
    """The snapshot after a batch: new keys inserted, known keys keep all but the last sighting.

    A small batch is broadcast and the table is not shuffled.  A large one meets it in one
    full outer join; with a table bucketed by job_id only the batch moves.  Spark does not know
    how such a join's result is partitioned; where the table is partitioned by job_id and a step by
    job_id follows, ``keyed`` lets them meet in a union, whose result need not be shuffled for it.
    """
    if is_small(batch, limit):
        touched = touch(table, batch, small=True)
        return touched.unionByName(new_postings(table, batch, small=True))
    if keyed:
        return _merged(table, one_per_job(batch))
    old = table.select(F.col("job_id"), F.struct(*RAW[1:]).alias("_old"))
    new = one_per_job(batch).select(F.col("job_id"), F.struct(*RAW[1:]).alias("_new"))
    kept = F.coalesce("_old", "_new")
    return old.join(new, "job_id", "full_outer").select(
        "job_id",
        *[kept[name].alias(name) for name in [*PAYLOAD, "first_scraped_at"]],
        F.coalesce("_new.last_scraped_at", "_old.last_scraped_at").alias("last_scraped_at"),
    )


def insert_or_ignore(
    table: DataFrame, rows: DataFrame, key: list[str], order: list[str]
) -> DataFrame:
    """The table plus the rows with new keys, one per key; conflicts are dropped."""
    fresh = first_per_key(rows, key, order).join(table.select(*key), key, "left_anti")
    return table.unionByName(fresh.select(table.columns))


def split_batch(table: DataFrame, batch: DataFrame) -> DataFrame:
    """The batch with ``status``: new or existing."""
    known = table.select("job_id", F.lit(True).alias("_known"))
    return batch.join(known, "job_id", "left").select(
        *batch.columns, F.when(F.col("_known"), "existing").otherwise("new").alias("status")
    )


def ingest_accounting(table: DataFrame, batch: DataFrame) -> DataFrame:
    """One row: records in the batch, keys inserted, keys already present."""
    keys = batch.groupBy("job_id").agg(F.count("*").alias("n"))
    known = table.select("job_id", F.lit(True).alias("_known"))
    return keys.join(known, "job_id", "left").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_jobs_scraped"),
        F.count_if(F.col("_known").isNull()).alias("jobs_inserted"),
        F.count_if("_known").alias("existing_jobs_updated"),
    )
