"""The pipeline: batch -> raw_jobs -> cleaned_jobs -> company_stats -> lead_scores -> exports.

Every stage is stored and the next one reads the stored table, so a lost executor never
costs more than the running stage, and a stage can be run again on its own.  raw_jobs is a
ledger, to which a run adds what its batch brings.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from leadtide.operators.clean import accounted, clean_postings
from leadtide.operators.quality import all_checks
from leadtide.operators.report import export_bundle, overview_figures, scores_overview
from leadtide.operators.score import lead_scores
from leadtide.operators.stats import company_stats
from leadtide.sources import ledger
from leadtide.sources.batches import accepted, refused
from leadtide.sources.publish import Publication
from leadtide.sources.tables import discard, new_path, read_table, require_unique, store


def stored_stats(raw: DataFrame, config: DataFrame, **options) -> DataFrame:
    """Clean and roll up; stored, because scoring reads it several times."""
    return store(company_stats(clean_postings(raw), config, **options), "company_stats")


def leads_of(raw: DataFrame, config: DataFrame) -> DataFrame:
    """From raw postings to scored leads."""
    return lead_scores(stored_stats(raw, config), config)


def run(
    spark: SparkSession,
    batch: DataFrame,
    config: DataFrame,
    folder: str,
    version: str,
    previous: str | None = None,
    as_of: Column | None = None,
) -> dict[str, str]:
    """Run all stages into ``folder/version``, going on from ``folder/previous``.

    ``batch`` holds typed records, or lines (``read_lines``): then lines without a record go to
    the table ``refusals``, with the reason, and the rest is taken in.  The batch is stored
    first, since it is read several times.  ``folder/ledger`` takes it in after the batch of the
    previous run; a run that is repeated, or another one from the same previous run, replaces
    what its batch wrote there.  A NULL in a required column or a second row of a key in any
    table stops the run: its batch is taken out again and nothing is published.  Returns the path of each table, export and accounting.
    """
    require_unique(config, "tech_config")  # before anything is written
    number = 1
    if previous is not None:
        number += spark.read.schema("number long").json(f"{folder}/{previous}/batch_number").first()["number"]
    postings = f"{folder}/ledger"
    kept = new_path(spark, "batch")
    batch.write.parquet(kept)
    batch = spark.read.schema(batch.schema).parquet(kept)
    out = Publication(spark, f"{folder}/{version}")
    if batch.columns == ["line"]:
        out.add("refusals", refused(batch))
        batch = accepted(batch)
    try:
        ledger.take_in(batch, postings, number)
        out.add("ingest", ledger.accounting(batch, postings, number))
        _tables(out, ledger.current(spark, postings, number + 1), config)
    except Exception:
        ledger.withdraw(spark, postings, number)
        raise
    finally:
        discard(spark, kept)
    at = {"ledger": postings, **out.publish(), "batch_number": f"{folder}/{version}/batch_number"}
    spark.range(1).select(F.lit(number).alias("number")).write.mode("overwrite").json(at["batch_number"])

    leads, stats = (read_table(spark, at[name], name) for name in ("lead_scores", "company_stats"))
    if as_of is None:
        as_of = ledger.current(spark, postings, number + 1).agg(F.max("last_scraped_at")).scalar()
    return {**at, **export_bundle(leads, stats, f"{folder}/{version}/exports", as_of)}


def _tables(out: Publication, raw: DataFrame, config: DataFrame) -> None:
    """Stage the tables, the checks and, from figures observed while writing, the accounts of a run."""
    spark = out.spark
    require_unique(raw, "raw_jobs")
    read = Observation("raw_jobs")
    cleaned = out.write("cleaned_jobs", clean_postings(raw.observe(read, F.count("*").alias("rows"))))
    counts = spark.range(1).select(
        F.lit(read.get["rows"]).alias("raw_job_count"), F.lit(cleaned["rows"]).alias("cleaned_job_count")
    )
    out.add("dedup_accounting", accounted(counts))
    out.write("company_stats", company_stats(out.read("cleaned_jobs"), config), by_week=True)
    leads = lead_scores(out.read("company_stats"), config)
    seen = out.write("lead_scores", leads, figures=overview_figures())
    overview = scores_overview(leads).schema
    out.add("scores_overview", spark.createDataFrame([tuple(seen[name] for name in overview.names)], overview))
    out.add("checks", all_checks(out.read("cleaned_jobs"), config, out.read("lead_scores")))
