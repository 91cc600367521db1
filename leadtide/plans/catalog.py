"""Registry of the runnable queries and the SQL each is checked against."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession, functions as F

from leadtide.functions import scores
from leadtide.operators.clean import clean_postings
from leadtide.operators.score import lead_scores, score_all_weeks
from leadtide.operators.stats import company_stats
from leadtide.operators.upsert import one_per_job
from leadtide.sources import bindings
from leadtide.sources.tables import store

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


class Base:
    """The tables a query starts from, built when asked for."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    @cached_property
    def config(self) -> DataFrame:
        return bindings.part_config(self.spark)

    @cached_property
    def postings(self) -> DataFrame:
        return bindings.postings(self.spark, self.folder)

    @cached_property
    def documents(self) -> DataFrame:
        return bindings.documents(self.spark, self.folder)

    @cached_property
    def cleaned(self) -> DataFrame:
        return clean_postings(self.postings)

    @cached_property
    def stored_cleaned(self) -> DataFrame:
        return store(self.cleaned, "cleaned_jobs")

    @cached_property
    def stats(self) -> DataFrame:
        return company_stats(self.cleaned, self.config)

    @cached_property
    def stored_stats(self) -> DataFrame:
        return store(self.stats, "company_stats")

    @cached_property
    def leads(self) -> DataFrame:
        return lead_scores(self.stored_stats, self.config)

    @cached_property
    def stored_leads(self) -> DataFrame:
        return store(self.leads, "lead_scores")

    @cached_property
    def scored(self) -> DataFrame:
        """Rounded scores of every company-week, not only of the newest week."""
        raw = score_all_weeks(self.stored_stats, self.config)
        parts = [F.col(c) for c in ("velocity_score", "tech_match_score", "volume_score")]
        return raw.select(
            "company_normalized", "company", "week_start", "jobs_this_week", "jobs_last_week",
            *[scores.round_to(c).alias(n) for c, n in zip(
                parts, ("velocity_score", "tech_match_score", "volume_score"))],
            scores.round_to(scores.composite(*parts)).alias("composite_score"),
            F.col("tech_stack").alias("score_metadata"),
        )

    def _batch(self, condition: str) -> DataFrame:
        return self.postings.where(condition).select(
            "job_id", "company", "title", "description", "location", "posting_date", "url",
            "source", F.col("first_scraped_at").alias("scraped_at"),
        )

    @cached_property
    def batch(self) -> DataFrame:
        """A new batch: lines 3 and up.  It overlaps the snapshot in lines 3 and 4."""
        return self._batch("line >= 3")

    @cached_property
    def snapshot(self) -> DataFrame:
        """What earlier batches left: lines 1 to 4."""
        return one_per_job(self._batch("line <= 4"))


def query(name: str, sql: str | None = None):
    """Register ``fn(base)`` as a query."""

    def register(fn):
        QUERIES[name] = lambda spark, folder: fn(Base(spark, folder))
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def load() -> None:
    """Import the modules that register queries."""
    from leadtide.plans import (  # noqa: F401
        queries_aggregate,
        queries_composite,
        queries_function,
        queries_quality,
        queries_relational,
        queries_table,
    )
