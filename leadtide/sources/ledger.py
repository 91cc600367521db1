"""raw_jobs as a ledger: what a batch reads and writes follows the batch, not the table.

``<folder>/postings`` holds the rows whose key a batch brought first, and ``<folder>/sightings`` the
known keys it saw again, with the latest scrape.  Both are laid out by batch, by bucket (a hash
of ``job_id``) and, within, as Spark's bucketed tables, whose buckets are the same: a batch is
joined with the table bucket by bucket, so the table is not shuffled, and of the table only
the buckets that the batch touches are read.  The number of buckets is fixed when a ledger
begins (``<folder>/layout``); at least as many as there are shuffle partitions keep Spark from
shuffling the table after all.

The table is the postings with the latest sighting of each; ``fold`` writes it out anew when the
sightings have grown long.  Batch N reads what earlier batches wrote and replaces what it
wrote itself, so a batch that is repeated after a failure leaves the same.
"""

from __future__ import annotations

import hashlib

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from leadtide.operators.upsert import PAYLOAD, RAW, one_per_job
from leadtide.schemas import CLEANED_JOBS, RAW_JOBS, require_columns
from leadtide.sources.tables import discard, make_folder, new_path

def _ddl(schema: StructType) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in schema)


COLUMNS = {
    "postings": _ddl(RAW_JOBS),
    "sightings": "job_id string, seen timestamp_ntz",
    # written by sources/maintained.py
    "cleaned": f"clean_key binary, {_ddl(CLEANED_JOBS)}, kept_at timestamp_ntz",
    "companies": "company_normalized string, newest array<struct<week_start: date, jobs_posted: int>>",
}
#: What a part is bucketed by.
KEYED_BY = {"postings": "job_id", "sightings": "job_id", "cleaned": "clean_key", "companies": "company_normalized"}


def begin(spark: SparkSession, folder: str, buckets: int | None = None) -> int:
    """Lay out a new ledger; an existing one is refused.  By default as many buckets as shuffle partitions."""
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    spark.range(1).select(F.lit(buckets).alias("buckets")).coalesce(1).write.json(f"{folder}/layout")
    for name in COLUMNS:
        make_folder(spark, f"{folder}/{name}")
    return buckets


def _buckets(spark: SparkSession, folder: str) -> int | None:
    try:
        return spark.read.schema("buckets int").json(f"{folder}/layout").first()["buckets"]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def _table(spark: SparkSession, folder: str, name: str, buckets: int) -> str:
    """The name under which the session knows a part of the ledger, with all its partitions."""
    table = f"ledger_{hashlib.md5(folder.encode()).hexdigest()[:16]}_{name}"
    place = f"{folder}/{name}".replace("'", "\\'")
    key = KEYED_BY[name]
    if not spark.catalog.tableExists(table):
        make_folder(spark, f"{folder}/{name}")
        spark.sql(
            f"CREATE TABLE {table} ({COLUMNS[name]}, batch bigint, bucket int) USING parquet "
            f"PARTITIONED BY (batch, bucket) CLUSTERED BY ({key}) SORTED BY ({key}) INTO {buckets} BUCKETS "
            f"LOCATION '{place}'"
        )
    spark.sql(f"ALTER TABLE {table} RECOVER PARTITIONS")  # what other sessions have written
    return table


def _part(spark: SparkSession, folder: str, name: str, before: int | None) -> DataFrame:
    buckets = _buckets(spark, folder)
    if buckets is None:
        return spark.createDataFrame([], f"{COLUMNS[name]}, batch bigint, bucket int")
    rows = spark.table(_table(spark, folder, name, buckets))
    return rows if before is None else rows.where(F.col("batch") < before)


def bucket_of(buckets: int, key: str = "job_id") -> Column:
    """The bucket of a key, as Spark's bucketed tables have it."""
    return F.expr(f"cast(pmod(hash({key}), {buckets}) AS int)")


def touched_buckets(rows: DataFrame, folder: str, key: str = "job_id") -> list[int]:
    """The buckets that the keys of ``rows`` lie in; at most as many numbers as there are buckets."""
    buckets = _buckets(rows.sparkSession, folder)
    return [r[0] for r in rows.select(bucket_of(buckets, key)).distinct().collect()]


def _replace(rows: DataFrame, folder: str, name: str, number: int, buckets: int) -> None:
    """Write a batch's part, in place of what an earlier attempt has written."""
    spark = rows.sparkSession
    table = _table(spark, folder, name, buckets)
    spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (batch = {number})")
    discard(spark, f"{folder}/{name}/batch={number}")
    placed = rows.withColumns({"batch": F.lit(number).cast("long"), "bucket": bucket_of(buckets, KEYED_BY[name])})
    # one task, and one file, for each bucket
    placed.repartition(buckets, KEYED_BY[name]).write.mode("append").insertInto(table)


def current(
    spark: SparkSession, folder: str, before: int | None = None, buckets: list[int] | None = None
) -> DataFrame:
    """The raw_jobs table, as of all batches or of those before a number; nothing is shuffled.

    ``buckets`` reads these only."""
    postings, sightings = (_part(spark, folder, name, before) for name in ("postings", "sightings"))
    if buckets is not None:
        postings, sightings = (rows.where(F.col("bucket").isin(buckets)) for rows in (postings, sightings))
    seen = sightings.groupBy("job_id").agg(F.max_by("seen", "batch").alias("_seen"))
    return postings.join(seen, "job_id", "left").select(
        "job_id", *PAYLOAD, "first_scraped_at", F.coalesce("_seen", "last_scraped_at").alias("last_scraped_at")
    )


def known_of(batch: DataFrame, folder: str, number: int) -> DataFrame:
    """The rows of ``batch``, unique by job_id, with ``known``: whether an earlier batch brought the key."""
    spark = batch.sparkSession
    touched = touched_buckets(batch, folder)
    table = _part(spark, folder, "postings", number).where(F.col("bucket").isin(touched))
    held = table.select("job_id", F.lit(True).alias("known")).join(batch, "job_id", "right")
    return held.select(*batch.columns, F.coalesce("known", F.lit(False)).alias("known"))


def take_in(batch: DataFrame, folder: str, number: int) -> None:
    """Append a typed batch, which is read once.  Of the table only the keys of touched buckets are read.

    The batch is shuffled once and stored in buckets, from which sightings and new postings are taken."""
    spark = batch.sparkSession
    buckets = _buckets(spark, folder) or begin(spark, folder)
    kept = new_path(spark, "batch")
    checked = require_columns(batch, RAW_JOBS, ["job_id", "company", "title", "source"])
    staged = f"batch_{hashlib.md5(kept.encode()).hexdigest()}"
    placed = one_per_job(checked).select(*RAW).repartition(buckets, "job_id")
    placed.write.option("path", kept).bucketBy(buckets, "job_id").sortBy("job_id").format("parquet").saveAsTable(staged)
    rows = known_of(spark.table(staged), folder, number)
    seen = rows.where("known").select("job_id", F.col("last_scraped_at").alias("seen"))
    _replace(seen, folder, "sightings", number, buckets)
    _replace(rows.where("NOT known").select(*RAW), folder, "postings", number, buckets)
    spark.sql(f"DROP TABLE {staged}")
    discard(spark, kept)


def batch_rows(spark: SparkSession, folder: str, number: int) -> DataFrame:
    """The keys that batch ``number`` brought or saw again."""
    parts = [_part(spark, folder, name, None).where(F.col("batch") == number) for name in ("postings", "sightings")]
    return parts[0].select("job_id").union(parts[1].select("job_id"))


def accounting(batch: DataFrame, folder: str, number: int) -> DataFrame:
    """One row: records of batch ``number``, keys it inserted, keys that were there (see ``ingest_accounting``).

    The keys are counted in what the batch has written."""
    spark = batch.sparkSession

    def written(name: str) -> Column:
        rows = _part(spark, folder, name, None).where(F.col("batch") == number)
        return rows.agg(F.count("*")).scalar()

    return batch.agg(F.count("*").alias("total_jobs_scraped")).select(
        "total_jobs_scraped", written("postings").alias("jobs_inserted"), written("sightings").alias("existing_jobs_updated")
    )


def withdraw(spark: SparkSession, folder: str, number: int) -> None:
    """Take a batch out again."""
    buckets = _buckets(spark, folder)
    for name in COLUMNS if buckets else []:
        spark.sql(f"ALTER TABLE {_table(spark, folder, name, buckets)} DROP IF EXISTS PARTITION (batch = {number})")
        discard(spark, f"{folder}/{name}/batch={number}")


def fold(spark: SparkSession, folder: str, into: str) -> None:
    """Write the table to a new ledger ``into``, as its batch 0, without sightings and without cleaned rows
    (``maintained.take_in_cleaned`` writes these anew)."""
    buckets = begin(spark, into, _buckets(spark, folder))
    _replace(current(spark, folder), into, "postings", 0, buckets)


def seed(table: DataFrame, folder: str, buckets: int | None = None) -> None:
    """Begin a ledger with an existing raw_jobs table, as its batch 0; an existing ledger is refused."""
    rows = require_columns(table, RAW_JOBS).select(*RAW)
    _replace(rows, folder, "postings", 0, begin(table.sparkSession, folder, buckets))
