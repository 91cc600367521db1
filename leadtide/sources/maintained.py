"""cleaned_jobs, company_stats and lead scores kept up to date by what a batch of the ledger changes.

The part ``cleaned`` of a ledger holds, for each batch, the cleaned rows of the keys the batch touched,
as they are after it, in buckets of ``clean_key``: held rows and changed postings meet bucket by
bucket, and only buckets that the batch touches are read.  Old and new rows of a batch are its
feed of changes.

``<folder>/weekly/facts`` holds, by batch and week, what statistics need of a cleaned row (company,
title, location, technologies) with a signed count: a row that comes adds one, a row that goes or
changes takes one away.  Sums of these over all batches are the rows there are now, so a week is
rolled up again without the texts; keywords are sought in changed rows only.  ``<folder>/weekly/stats`` is
company_stats by week; only weeks with changes are written.

The part ``companies`` holds each company's two newest weeks with their counts, and
``<folder>/weekly/maxima`` the largest count of each week, both by the batch that changed them:
scores need no more of the weeks before the newest one.

Batches are taken in order.  One that is repeated after a failure replaces what it wrote.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from leadtide.operators.clean import clean_key, merge_into, with_normalised
from leadtide.operators.detect import with_techs
from leadtide.operators.score import leads_of_week
from leadtide.operators.stats import stats_of_detected, weekly_jobs
from leadtide.operators.upsert import RAW
from leadtide.schemas import CLEANED_JOBS, COMPANY_STATS, conform
from leadtide.sources.ledger import _buckets, _part, _replace, current, touched_buckets
from leadtide.sources.tables import discard, make_folder, new_path

#: What the statistics need of a cleaned row.
NEEDED = ["company_normalized", "company", "title", "description", "location", "posting_date"]
FACT = ["company_normalized", "company", "title", "location", "techs"]
FACTS = "company_normalized string, company string, title string, location string, techs array<string>, n bigint"
HELD = [*CLEANED_JOBS.names, "kept_at"]


def cleaned_rows(
    spark: SparkSession, folder: str, before: int | None = None, buckets: list[int] | None = None
) -> DataFrame:
    """clean_key and the cleaned row, as of all batches or of those before a number; not shuffled."""
    rows = _part(spark, folder, "cleaned", before)
    if buckets is not None:
        rows = rows.where(F.col("bucket").isin(buckets))
    newest = rows.groupBy("clean_key").agg(F.max_by(F.struct(*HELD), "batch").alias("_row"))
    return newest.select("clean_key", "_row.*")


def cleaned_jobs(spark: SparkSession, folder: str, before: int | None = None) -> DataFrame:
    """The cleaned table; equals ``clean_postings`` of the ledger."""
    return conform(cleaned_rows(spark, folder, before), CLEANED_JOBS)


def _keyed(raw: DataFrame) -> DataFrame:
    return with_normalised(raw).withColumn("clean_key", clean_key())


def _changed(spark: SparkSession, folder: str, number: int) -> DataFrame:
    """Postings that batch ``number`` brought or saw again, with ``back``: seen before the last sighting."""
    brought = _part(spark, folder, "postings", None).where(F.col("batch") == number)
    seen = _part(spark, folder, "sightings", None).where(F.col("batch") == number).select("job_id", "seen")
    known = current(spark, folder, number, touched_buckets(seen, folder)).join(seen, "job_id")
    back = F.coalesce(F.col("seen") < F.col("last_scraped_at"), F.lit(True))
    again = known.withColumn("back", back).withColumn("last_scraped_at", F.coalesce("seen", "last_scraped_at"))
    return brought.select(*RAW, F.lit(False).alias("back")).unionByName(again.select(*RAW, "back"))


def take_in_cleaned(spark: SparkSession, folder: str, number: int) -> None:
    """Bring the cleaned rows up to batch ``number``, which the ledger has taken in.

    The changed postings are shuffled once, to the buckets of their keys, where they meet the held rows
    and are written.  A posting seen again at an earlier time than before can shorten the span of its key, which
    merging can't; such keys are cleaned anew from the ledger.
    """
    kept = new_path(spark, "changed")
    _changed(spark, folder, number).write.parquet(kept)
    rows = _keyed(spark.read.parquet(kept))
    held = cleaned_rows(spark, folder, number, touched_buckets(rows, folder, "clean_key"))
    late = rows.where("back").select("clean_key").distinct()
    if not late.isEmpty():
        held = held.join(late, "clean_key", "left_anti")
        anew = _keyed(current(spark, folder, number + 1)).join(late, "clean_key", "left_semi")
        rows = rows.join(late, "clean_key", "left_anti").select(*RAW).unionByName(anew.select(*RAW))
    after = merge_into(held, rows.select(*RAW)).select("clean_key", *HELD)
    _replace(after, folder, "cleaned", number, _buckets(spark, folder))
    discard(spark, kept)


def changes(spark: SparkSession, folder: str, number: int) -> DataFrame:
    """What batch ``number`` changed of the cleaned rows: ``sign`` -1 for a row that was, 1 for one that is.

    Rows that are the same in all that statistics need are left out."""
    new = _part(spark, folder, "cleaned", None).where(F.col("batch") == number)
    old = cleaned_rows(spark, folder, number, touched_buckets(new, folder, "clean_key"))
    was = old.select("clean_key", F.struct(*NEEDED).alias("was"))
    both = new.select("clean_key", F.struct(*NEEDED).alias("is")).join(was, "clean_key", "left")

    def side(name: str, sign: int) -> DataFrame:
        return both.where("NOT (is <=> was)").where(F.col(name).isNotNull()).select(f"{name}.*", F.lit(sign).alias("sign"))

    return side("was", -1).unionByName(side("is", 1))


def _facts(spark: SparkSession, folder: str) -> DataFrame:
    make_folder(spark, f"{folder}/weekly/facts")
    return spark.read.schema(f"{FACTS}, batch bigint, week_start date").parquet(f"{folder}/weekly/facts")


def _weeks(rows: DataFrame) -> set:
    return {r[0] for r in rows.select("week_start").distinct().collect()}


def _config_print(config: DataFrame) -> str:
    """Tells configs apart; the order of rows does not count."""
    words = F.xxhash64("tech_name", "keywords")
    row = config.agg(F.count("*"), F.sum(words.cast("decimal(38,0)")), F.bit_xor(words)).first()
    return "/".join(map(str, row))


def take_in_stats(spark: SparkSession, folder: str, number: int, config: DataFrame) -> list:
    """Bring the weekly statistics up to batch ``number``, whose cleaned rows are there; the weeks written.

    Technologies are those of ``config``; if it is another one than before, all facts are written
    anew.  The weeks of one batch come to the driver.
    """
    facts, stats = f"{folder}/weekly/facts", f"{folder}/weekly/stats"
    used = _config_print(config)
    known, since = _known_config(spark, folder)
    anew = known != used or since == number
    before = _facts(spark, folder)
    if anew:
        touched = _weeks(before)
        discard(spark, facts)
        rows = cleaned_rows(spark, folder, number + 1).select(*NEEDED, F.lit(1).alias("sign"))
    else:
        touched = _weeks(before.where(F.col("batch") == number))  # an earlier attempt's
        discard(spark, f"{facts}/batch={number}")
        rows = changes(spark, folder, number)
    own = with_techs(weekly_jobs(rows), config).select("week_start", *FACT, F.col("sign").cast("long").alias("n"))
    if not anew:  # else there is one row of each already, as company, title and location tell the key
        own = own.groupBy("week_start", *FACT).agg(F.sum("n").alias("n")).where("n <> 0")
    own.hint("rebalance", "week_start").write.partitionBy("week_start").parquet(f"{facts}/batch={number}")
    if anew:
        row = spark.range(1).select(F.lit(used).alias("print"), F.lit(number).alias("since"))
        row.write.mode("overwrite").json(f"{folder}/weekly/config")

    held = _facts(spark, folder).where(F.col("batch") <= number)
    weeks = sorted(touched | _weeks(held.where(F.col("batch") == number)))
    touching = held.where(F.col("week_start").isin(weeks))
    if anew:  # all facts are this batch's, each once
        now = touching.where("n > 0")
    else:
        now = touching.groupBy("week_start", *FACT).agg(F.sum("n").alias("n")).where("n > 0")
    out = conform(stats_of_detected(now), COMPANY_STATS)
    if config.isEmpty():  # detects nothing and reports nothing
        out = out.where(F.lit(False))
    out.hint("rebalance", "week_start").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(
        "week_start"
    ).parquet(stats)
    # no fact is fewer than none in sum, so the sums by week tell which are left
    left = set() if config.isEmpty() else _weeks(touching.groupBy("week_start").agg(F.sum("n").alias("n")).where("n > 0"))
    for week in set(weeks) - left:  # no row is left; nothing was written in place of the old ones
        discard(spark, f"{stats}/week_start={week}")
    return weeks


def _known_config(spark: SparkSession, folder: str) -> tuple[str | None, int | None]:
    """The config of the facts, and the batch as which all of them were written anew."""
    try:
        row = spark.read.schema("print string, since bigint").json(f"{folder}/weekly/config").first()
        return row["print"], row["since"]
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None, None


def weekly_stats(spark: SparkSession, folder: str) -> DataFrame:
    """company_stats as kept; equals ``company_stats`` of the cleaned table."""
    make_folder(spark, f"{folder}/weekly/stats")
    return conform(spark.read.schema(COMPANY_STATS).parquet(f"{folder}/weekly/stats"), COMPANY_STATS)


def company_state(spark: SparkSession, folder: str, before: int | None = None) -> DataFrame:
    """company_normalized and ``newest``: its two newest weeks with their counts, newest first; not shuffled."""
    rows = _part(spark, folder, "companies", before)
    return rows.groupBy("company_normalized").agg(F.max_by("newest", "batch").alias("newest"))


def _two_newest(weeks: Column) -> Column:
    return F.slice(F.sort_array(weeks, asc=False), 1, 2)


def _by_company(stats: DataFrame) -> DataFrame:
    """Company and its weeks; a company has one row a week."""
    return stats.groupBy("company_normalized").agg(F.collect_list(F.struct("week_start", "jobs_posted")).alias("found"))


def week_maxima(spark: SparkSession, folder: str, before: int | None = None) -> DataFrame:
    """week_start and the largest ``jobs_posted`` of each week that has rows."""
    make_folder(spark, f"{folder}/weekly/maxima")
    rows = spark.read.schema("week_start date, jobs_posted int, batch bigint").parquet(f"{folder}/weekly/maxima")
    if before is not None:
        rows = rows.where(F.col("batch") < before)
    newest = rows.groupBy("week_start").agg(F.max_by("jobs_posted", "batch").alias("jobs_posted"))
    return newest.where("jobs_posted IS NOT NULL")


def take_in_scores(spark: SparkSession, folder: str, number: int, weeks: list) -> None:
    """Bring what scores need up to batch ``number``; ``weeks`` is what ``take_in_stats`` wrote for it.

    Weeks may come late, change and go.  Of the statistics, the weeks written are read.  Where a
    company loses a week, so that one older than the two held may have moved up, its weeks are
    looked up in the statistics again.
    """
    buckets = _buckets(spark, folder)
    stats = weekly_stats(spark, folder)
    if week_maxima(spark, folder, number).isEmpty():  # nothing is held yet
        weeks = sorted({*weeks, *_weeks(stats)})
    written = stats.where(F.col("week_start").isin(weeks))
    week = spark.createDataFrame([(w,) for w in weeks], "week_start date")
    most = written.groupBy("week_start").agg(F.max("jobs_posted").alias("jobs_posted"))
    maxima = f"{folder}/weekly/maxima/batch={number}"
    week.join(F.broadcast(most), "week_start", "left").coalesce(1).write.mode("overwrite").parquet(maxima)

    both = company_state(spark, folder, number).join(_by_company(written), "company_normalized", "full")
    left = F.filter("newest", lambda e: ~e["week_start"].isin(weeks))
    none = F.array().cast(both.schema["newest"].dataType)
    merged = _two_newest(F.concat(F.coalesce("left", none), F.coalesce("found", none)))
    # weeks that are not held are older than both that are
    since = F.when(F.size("newest") == 2, F.col("newest")[1]["week_start"])
    sure = F.size(F.filter("merged", lambda e: e["week_start"] >= F.col("since"))) == 2
    kept = new_path(spark, "companies")
    changed = both.withColumns({"left": left, "since": since}).where("found IS NOT NULL OR size(left) < size(newest)")
    changed.withColumn("merged", merged).select(
        "company_normalized", "merged", F.coalesce(F.col("since").isNull() | sure, F.lit(False)).alias("sure")
    ).write.parquet(kept)
    rows = spark.read.parquet(kept)
    after = rows.where("sure").select("company_normalized", F.col("merged").alias("newest"))
    unsure = rows.where("NOT sure").select("company_normalized")
    if not unsure.isEmpty():
        again = unsure.join(_by_company(stats.join(unsure, "company_normalized", "left_semi")), "company_normalized", "left")
        newest = F.coalesce(_two_newest(F.col("found")), none)
        after = after.unionByName(again.select("company_normalized", newest.alias("newest")))
    _replace(after, folder, "companies", number, buckets)
    discard(spark, kept)


def maintained_leads(spark: SparkSession, folder: str, config: DataFrame, **options) -> DataFrame:
    """Scores of the newest week; equals ``lead_scores`` of the statistics, of which one week is read."""
    maxima = week_maxima(spark, folder)
    newest = F.lit(maxima.agg(F.max("week_start")).first()[0]).cast("date")
    earlier = F.filter("newest", lambda e: e["week_start"] < newest)
    last = F.try_element_at(earlier, F.lit(1))["jobs_posted"]
    before = company_state(spark, folder).select("company_normalized", last.alias("jobs_last_week"))
    rows = weekly_stats(spark, folder).where(F.col("week_start") == newest)
    return leads_of_week(rows.join(before, "company_normalized", "left"), maxima, config, **options)
