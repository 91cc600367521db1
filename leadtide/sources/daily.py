"""raw_jobs laid out by the day of the last sighting: recency filters read recent days only."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leadtide.functions.dates import within_days
from leadtide.schemas import RAW_JOBS, conform
from leadtide.sources.ledger import batch_rows, current, touched_buckets
from leadtide.sources.tables import discard, make_folder, new_path

DAY = "last_day"


def _write(rows: DataFrame, path: str) -> None:
    placed = conform(rows, RAW_JOBS).withColumn(DAY, F.to_date("last_scraped_at"))
    # a large day becomes several files, small ones are put together
    placed.hint("rebalance", DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        DAY
    ).parquet(path)


def write_by_day(raw: DataFrame, path: str) -> None:
    """Lay a table out anew; ``path`` must not be one that ``raw`` reads.  Postings without a last
    sighting are a day of their own."""
    discard(raw.sparkSession, path)
    make_folder(raw.sparkSession, path)
    _write(raw, path)


def read_by_day(spark: SparkSession, path: str) -> DataFrame:
    """The table with the column ``last_day``."""
    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_JOBS)
    return spark.read.schema(f"{fields}, {DAY} date").parquet(path)


def days(spark: SparkSession, path: str) -> list[date]:
    """The days there are, newest first, by the names of their folders; no file is opened."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    names = [f.getPath().getName() for f in where.getFileSystem(spark._jsc.hadoopConfiguration()).listStatus(where)]
    found = [n.removeprefix(f"{DAY}=") for n in names if n.startswith(f"{DAY}=")]
    return sorted((date.fromisoformat(d) for d in found if not d.startswith("__")), reverse=True)


def newest_sighting(spark: SparkSession, path: str) -> Column:
    """The last sighting of all, as a scalar; the newest day alone is read."""
    rows = read_by_day(spark, path)
    last = days(spark, path)[:1]
    return rows.where(F.col(DAY).isin(last)).agg(F.max("last_scraped_at")).scalar()


def recent(table: DataFrame, as_of: Column, within: int) -> DataFrame:
    """Postings seen in the last ``within`` days before ``as_of``; days before are not read."""
    since = F.to_date(as_of - F.make_dt_interval(F.lit(within)))
    return table.where(F.col(DAY) >= since).where(within_days(F.col("last_scraped_at"), as_of, within))


def last_seen(spark: SparkSession, path: str, n: int = 5) -> DataFrame:
    """The ``n`` postings seen last (see ``report.recent_postings``), read from the newest days that hold as many."""
    rows = read_by_day(spark, path)
    known = days(spark, path)
    take = 1
    while take < len(known) and rows.where(F.col(DAY) >= known[take - 1]).limit(n).count() < n:
        take *= 2
    # of all days, only those without a date may be left out
    enough = take < len(known) or rows.where(F.col(DAY).isNotNull()).limit(n).count() == n
    chosen = rows.where(F.col(DAY) >= known[min(take, len(known)) - 1]) if known and enough else rows
    return chosen.orderBy(F.desc("last_scraped_at"), "job_id", "title", "company").limit(n).drop(DAY)


def take_in_days(spark: SparkSession, ledger: str, path: str, number: int) -> None:
    """Bring the layout up to batch ``number`` of a ledger: postings move to the day the batch saw them.

    Only days that a posting comes to or leaves are read and written.  They come to the driver;
    there is one for each calendar day.  A batch that is repeated leaves the same.
    """
    keys = batch_rows(spark, ledger, number)
    touched = touched_buckets(keys, ledger)
    rows = current(spark, ledger, number + 1, touched).join(keys, "job_id", "left_semi")
    was = current(spark, ledger, number, touched).join(keys, "job_id", "left_semi")
    day = F.to_date("last_scraped_at").alias(DAY)
    moved = {r[0] for r in rows.select(day).union(was.select(day)).distinct().collect()}
    dated = [d for d in moved if d is not None]
    held = read_by_day(spark, path)
    here = F.col(DAY).isin(dated)
    held = held.where(here | F.col(DAY).isNull() if None in moved else here)
    kept = new_path(spark, "days")
    stay = conform(held.join(keys, "job_id", "left_anti"), RAW_JOBS)
    stay.unionByName(conform(rows, RAW_JOBS)).write.parquet(kept)
    after = spark.read.schema(RAW_JOBS).parquet(kept)
    left = {r[0] for r in after.select(day).distinct().collect()}
    _write(after, path)
    for gone in moved - left:
        discard(spark, f"{path}/{DAY}={gone.isoformat() if gone else '__HIVE_DEFAULT_PARTITION__'}")
    discard(spark, kept)
