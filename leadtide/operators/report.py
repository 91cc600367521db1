"""Summaries, boards, trends and search over the stored tables."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from leadtide.functions import scores
from leadtide.functions.dates import iso_date, iso_timestamp, within_days
from leadtide.functions.text import preview, range_text

COMPONENTS = ["velocity_score", "tech_match_score", "volume_score"]


def by_score() -> list[Column]:
    return [F.desc("composite_score"), F.asc("company_normalized")]


def group_counts(df: DataFrame, column: str, name: str = "job_count") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias(name))


def top_groups(df: DataFrame, column: str, n: int, name: str = "job_count") -> DataFrame:
    return group_counts(df, column, name).orderBy(F.desc(name), column).limit(n)


def date_range(df: DataFrame, column: str = "posting_date") -> DataFrame:
    return df.agg(F.min(column).alias("earliest"), F.max(column).alias("latest"))


# --- technology distribution -------------------------------------------------------------


def stack_techs(stats: DataFrame) -> DataFrame:
    """One row per company-week and technology of its stack."""
    return stats.where("tech_stack <> ''").withColumn(
        "tech", F.explode(F.split("tech_stack", ","))
    ).withColumn("tech", F.trim("tech"))


def tech_distribution(stats: DataFrame) -> DataFrame:
    return group_counts(stack_techs(stats), "tech", "company_count")


def tech_shares(stats: DataFrame, leads: DataFrame) -> DataFrame:
    """Company-weeks per technology against the number of scored companies."""
    total = leads.agg(F.count("*")).scalar()
    return tech_distribution(stats).withColumn(
        "share_pct", scores.round_to(scores.share(F.col("company_count"), total))
    )


# --- lead summaries ------------------------------------------------------------------------


def band_counts() -> list[Column]:
    band = scores.band(F.col("composite_score"))
    known = F.col("composite_score").isNotNull()
    return [
        F.count_if(known & (band == name)).alias(f"{name}_leads") for name in ["hot", "warm", "cold"]
    ]


def lead_summary(leads: DataFrame) -> DataFrame:
    """One row, also for no leads: zeros and ``N/A``."""
    return leads.agg(
        F.count("*").alias("total_companies"),
        *band_counts(),
        scores.round_to(F.coalesce(F.avg("composite_score"), F.lit(0.0))).alias(
            "avg_composite_score"
        ),
        F.coalesce(iso_date(F.max("week_start")), F.lit("N/A")).alias("latest_week"),
    )


def overview_figures() -> list[Column]:
    """Band counts, the four averages and the top lead, as aggregates over leads."""
    # fixed values: the names of the fields
    order = F.struct((-F.col("composite_score")).alias("s"), F.col("company_normalized"))
    averages = [
        scores.round_to(F.avg(name)).alias(f"avg_{name}") for name in [*COMPONENTS, "composite_score"]
    ]
    return [
        F.count("*").alias("total_companies_scored"),
        F.coalesce(iso_date(F.max("week_start")), F.lit("N/A")).alias("scoring_date"),
        *band_counts(),
        *averages,
        F.coalesce(F.min_by("company", order), F.lit("None")).alias("top_lead_company"),
        F.coalesce(F.max("composite_score"), F.lit(0.0)).alias("top_lead_score"),
    ]


def scores_overview(leads: DataFrame) -> DataFrame:
    """One row: band counts, the four averages, the top lead."""
    return leads.agg(*overview_figures())


def summary_document(leads: DataFrame, stats: DataFrame, generated_at: Column) -> DataFrame:
    """The export's summary: ``lead_summary`` with the technology counts as a map.

    The map has one entry per configured technology.
    """
    counts = tech_distribution(stats).agg(
        F.map_from_entries(
            F.transform(
                F.array_sort(
                    F.collect_list(F.struct((-F.col("company_count")).alias("n"), F.col("tech")))
                ),
                lambda e: F.struct(e.tech, -e.n),
            )
        )
    )
    return lead_summary(leads).select(
        iso_timestamp(generated_at).alias("generated_at"), "*",
        counts.scalar().alias("tech_distribution"),
    )


def stats_overview(stats: DataFrame) -> DataFrame:
    """One row: companies, weeks, mean jobs per row, range of weeks, technologies found."""
    return stats.agg(
        F.count_distinct("company_normalized").alias("total_companies"),
        F.count_distinct("week_start").alias("total_weeks"),
        scores.round_to(F.avg("jobs_posted")).alias("avg_jobs_per_week"),
        range_text(F.min("week_start"), F.max("week_start")).alias("date_range"),
    ).withColumn(
        "technologies_detected",
        stack_techs(stats).agg(F.count_distinct("tech")).scalar(),
    )


def score_histogram(leads: DataFrame, bins: int = 20) -> DataFrame:
    """Counts in equal bins over 0..100, empty bins included."""
    counts = group_counts(
        leads.where(F.col("composite_score").isNotNull()).withColumn(
            "bin", scores.histogram_bin(F.col("composite_score"), bins)
        ),
        "bin", "leads",
    )
    all_bins = leads.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    width = 100.0 / bins
    return all_bins.join(counts, "bin", "left").select(
        "bin",
        (F.col("bin") * width).alias("from_score"),
        ((F.col("bin") + 1) * width).alias("to_score"),
        F.coalesce("leads", F.lit(0)).alias("leads"),
    )


# --- boards ----------------------------------------------------------------------------------


def top_leads(leads: DataFrame, n: int) -> DataFrame:
    return leads.orderBy(*by_score()).limit(n)


def leads_board(leads: DataFrame, n: int = 20) -> DataFrame:
    return top_leads(leads, n).select(
        "company", "composite_score", *COMPONENTS, "jobs_this_week",
        F.col("score_metadata").alias("tech_stack"),
        scores.band(F.col("composite_score")).alias("score_band"),
    )


def ranked_leads(leads: DataFrame, n: int = 10) -> DataFrame:
    """The top ``n`` with their rank; the window sees those ``n`` rows only."""
    rank = F.row_number().over(Window.orderBy(*by_score()))
    return top_leads(leads, n).select(
        rank.alias("rank"), "company", "composite_score", *COMPONENTS, "jobs_this_week",
        preview("score_metadata").alias("tech_preview"),
    )


def score_components(leads: DataFrame, n: int = 10) -> DataFrame:
    """The three components of the top ``n``, one row each."""
    return top_leads(leads, n).unpivot(["company"], COMPONENTS, "component", "value")


# --- trends, search, warehouse ---------------------------------------------------------------


def default_companies(stats: DataFrame, n: int = 5) -> DataFrame:
    return stats.select("company").distinct().orderBy("company").limit(n)


def company_trend(stats: DataFrame, chosen: DataFrame) -> DataFrame:
    """Weekly rows of the companies listed in ``chosen``."""
    return stats.join(chosen, "company", "left_semi").select(
        "company", "week_start", "jobs_posted"
    ).orderBy("company", "week_start")


def has_techs(techs: list[str], regex: bool = False, column: str = "tech_stack") -> Column:
    """All of the technologies are named; as regular expressions on request."""
    tests = [
        F.rlike(column, F.lit(t)) if regex else F.contains(F.col(column), F.lit(t)) for t in techs
    ]
    return reduce(lambda a, b: a & b, tests, F.lit(True))


def search_leads(
    feed: DataFrame, min_score: float = 50, min_jobs: int = 0, techs=(), regex: bool = False
) -> DataFrame:
    return feed.where(
        (F.col("composite_score") >= min_score)
        & (F.col("jobs_this_week") >= min_jobs)
        & has_techs(list(techs), regex)
    )


def recent_postings(raw: DataFrame, n: int = 5) -> DataFrame:
    return raw.orderBy(F.desc("last_scraped_at"), "job_id", "title", "company").limit(n)


def recent_count(raw: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """Postings seen in the last ``days`` days before ``as_of``."""
    return raw.where(within_days(F.col("last_scraped_at"), as_of, days)).agg(
        F.count("*").alias("job_count")
    )


def warehouse_report(raw: DataFrame) -> DataFrame:
    """Total, range of dates, top ten companies and the five newest postings, as rows."""
    def lines(df, section, rank, label, value):
        return df.select(
            F.lit(section).alias("section"), rank.cast("int").alias("rank"),
            label.alias("label"), value.cast("bigint").alias("value"),
        )

    none = F.lit(None)
    totals = raw.agg(
        F.count("*").alias("n"), F.min("posting_date").alias("a"), F.max("posting_date").alias("b")
    )
    companies = top_groups(raw, "company", 10)
    recent = recent_postings(raw)
    by_count = F.row_number().over(Window.orderBy(F.desc("job_count"), "company"))
    by_time = F.row_number().over(Window.orderBy(F.desc("last_scraped_at"), "job_id", "title", "company"))
    posting = F.concat(
        "company", F.lit(": "), "title", F.lit(" ("), iso_date("posting_date"), F.lit(")")
    )
    def entry(section, label, value):
        return F.struct(
            F.lit(section).alias("section"), F.lit(1).alias("rank"), label.alias("label"),
            value.cast("bigint").alias("value"),
        )

    weeks = range_text(F.col("a"), F.col("b"))
    head = totals.select(
        F.inline(F.array(entry("total", F.lit("jobs"), F.col("n")), entry("range", weeks, none)))
    )
    return head.unionByName(
        lines(companies, "company", by_count, F.col("company"), F.col("job_count"))
    ).unionByName(lines(recent, "recent", by_time, posting, none))


# The names of the exports and of their files.
EXPORTS = {
    "lead_scores_path": "lead_scores_latest.csv",
    "trends_path": "company_trends.csv",
    "summary_path": "summary.json",
}


def export_bundle(leads: DataFrame, stats: DataFrame, folder: str, generated_at: Column) -> dict:
    """Write the lead and trend CSVs and the summary JSON, side by side; returns their paths."""
    from leadtide.sources.tables import lead_feed, trend_feed, write_csv, write_json

    paths = {name: f"{folder}/{file}" for name, file in EXPORTS.items()}
    with ThreadPoolExecutor(3) as pool:
        writes = [
            pool.submit(write_csv, lead_feed(leads), paths["lead_scores_path"]),
            pool.submit(write_csv, trend_feed(stats), paths["trends_path"]),
            pool.submit(write_json, summary_document(leads, stats, generated_at), paths["summary_path"]),
        ]
        for write in writes:
            write.result()
    return paths
