"""Queries: the composed operators users run (c*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadtide.functions import scores
from leadtide.operators import report
from leadtide.operators.clean import clean_postings
from leadtide.operators.score import score_all_weeks
from leadtide.operators.stats import GROUP, company_stats
from leadtide.operators.upsert import upsert_postings
from leadtide.plans.catalog import query
from leadtide.plans.oracle import band, config_cte, normal, rounded, sql
from leadtide.plans.queries_table import FEED, SUMMARY, SUMMARY_SQL, TREND
from leadtide.sources import bindings, daily, ledger, maintained
from leadtide.sources.tables import lead_rows, new_path, read_csv, trend_rows

DETAIL = "company_normalized, company, week_start, jobs_posted, tech_stack, locations, "
CLASSES = "senior_count, junior_count, lead_count, mid_count"


@query("c1_upsert", sql("SELECT * FROM touched UNION ALL SELECT * FROM fresh", "touched", "fresh"))
def c1(b):
    return upsert_postings(b.snapshot, b.batch)


@query(
    "c1_upsert_twice",
    sql("SELECT * FROM touched UNION ALL SELECT * FROM fresh", "touched", "fresh"),
)
def c1_twice(b):
    """The same batch again changes nothing."""
    return upsert_postings(upsert_postings(b.snapshot, b.batch, limit=0, keyed=True), b.batch)


@query("c2_clean_postings", sql("SELECT * FROM cleaned", "cleaned"))
def c2(b):
    return b.cleaned


AFTER_TWO = (
    f"SELECT *, {normal('company')} AS company_normalized, {normal('title')} AS title_normalized, "
    "coalesce(location, '') AS place FROM (SELECT * FROM touched UNION ALL SELECT * FROM fresh) AS t"
)


def two_batches(b) -> str:
    """A ledger that began with the snapshot and took the batch in, with its cleaned rows."""
    folder = new_path(b.spark, "ledger")
    ledger.seed(b.snapshot, folder)
    maintained.take_in_cleaned(b.spark, folder, 0)
    ledger.take_in(b.batch, folder, 1)
    return folder


@query(
    "c2_maintained_postings",
    sql("SELECT * FROM cleaned", "touched", "fresh", "cleaned", normalised=AFTER_TWO),
)
def c2_maintained(b):
    """Cleaned rows brought up to a second batch by what it changes."""
    folder = two_batches(b)
    maintained.take_in_cleaned(b.spark, folder, 1)
    return maintained.cleaned_jobs(b.spark, folder)


@query(
    "c3_maintained_stats",
    sql(
        "SELECT company_normalized, company, week_start, jobs_posted, tech_stack FROM stats",
        "touched", "fresh", "stats", normalised=AFTER_TWO,
    ),
)
def c3_maintained(b):
    """Weekly statistics brought up to a second batch; only weeks it changes are written."""
    folder = two_batches(b)
    maintained.take_in_stats(b.spark, folder, 0, b.config)
    maintained.take_in_cleaned(b.spark, folder, 1)
    maintained.take_in_stats(b.spark, folder, 1, b.config)
    return maintained.weekly_stats(b.spark, folder)


@query(
    "c8_maintained_leads",
    sql("SELECT * FROM leads", "touched", "fresh", "leads", normalised=AFTER_TWO),
)
def c8_maintained(b):
    """Scores after a second batch, with late weeks, from each company's two newest weeks."""
    folder = two_batches(b)
    maintained.take_in_scores(b.spark, folder, 0, maintained.take_in_stats(b.spark, folder, 0, b.config))
    maintained.take_in_cleaned(b.spark, folder, 1)
    maintained.take_in_scores(b.spark, folder, 1, maintained.take_in_stats(b.spark, folder, 1, b.config))
    return maintained.maintained_leads(b.spark, folder, b.config)


def detail_rows(df):
    return df.withColumn("locations", F.array_join("locations", "|")).drop("tech_array")


@query("c3_company_stats", sql(f"SELECT {DETAIL}{CLASSES} FROM stats", "stats"))
def c3(b):
    return detail_rows(company_stats(b.cleaned, b.config, detail=True))


@query("c3_company_stats_large_config", sql(f"SELECT {DETAIL}{CLASSES} FROM stats", "stats"))
def c3_large(b):
    """The plan for configs too large to fold in, forced by a limit of zero."""
    return detail_rows(company_stats(b.stored_cleaned, b.config, detail=True, max_techs=0))


@query(
    "c3_document_stats",
    sql(
        f"SELECT {DETAIL}{CLASSES} FROM stats",
        "stats",
        tech=config_cte(bindings.DOCUMENT_TECHS),
        cleaned="SELECT *, lower(company) AS company_normalized FROM (SELECT CAST(doc_id AS VARCHAR) "
        "AS job_id, source AS company, 'Document ' || CAST(doc_id AS VARCHAR) AS title, "
        "text AS description, lang AS location, "
        "DATE '2024-01-01' + CAST(doc_id % 56 AS INTEGER) AS posting_date FROM documents) AS d",
    ),
)
def c3_documents(b):
    cleaned = clean_postings(b.documents)
    return detail_rows(company_stats(cleaned, bindings.document_config(b.spark), detail=True))


ALL_WEEKS = "company_normalized, week_start, "


@query("c4_velocity", sql(f"SELECT {ALL_WEEKS}jobs_this_week, jobs_last_week, velocity_score FROM scored", "scored"))
def c4(b):
    return b.scored.select(*GROUP, "jobs_this_week", "jobs_last_week", "velocity_score")


@query("c5_tech_match", sql(f"SELECT {ALL_WEEKS}score_metadata, tech_match_score FROM scored", "scored"))
def c5(b):
    return b.scored.select(*GROUP, "score_metadata", "tech_match_score")


@query("c6_volume", sql(f"SELECT {ALL_WEEKS}jobs_this_week, volume_score FROM scored", "scored"))
def c6(b):
    return b.scored.select(*GROUP, "jobs_this_week", "volume_score")


@query(
    "c7_composite",
    sql(
        f"SELECT {ALL_WEEKS}{rounded('v * 0.4 + t * 0.35 + m * 0.25')} AS composite_score "
        "FROM scored_raw",
        "scored_raw",
    ),
)
def c7(b):
    rows = score_all_weeks(b.stored_stats, b.config)
    parts = [F.col(c) for c in ("velocity_score", "tech_match_score", "volume_score")]
    return rows.select(*GROUP, scores.round_to(scores.composite(*parts)).alias("composite_score"))


@query("c8_lead_scores", sql("SELECT * FROM leads", "leads"))
def c8(b):
    return b.leads


@query(
    "c9_export_bundle",
    sql(
        "SELECT 'lead_scores' AS export, count(*) AS n, "
        f"{rounded('sum(composite_score)')} AS total FROM leads UNION ALL "
        "SELECT 'company_trends', count(*), CAST(sum(jobs_posted) AS DOUBLE) FROM stats UNION ALL "
        "SELECT 'summary', count(*), CAST(sum(company_count) AS DOUBLE) FROM dist",
        "leads", "dist",
    ),
)
def c9(b):
    folder = new_path(b.spark, "exports")
    as_of = b.stored_stats.agg(F.max("week_start").cast("timestamp_ntz")).scalar()
    paths = report.export_bundle(b.stored_leads, b.stored_stats, folder, as_of)
    leads = read_csv(b.spark, paths["lead_scores_path"], FEED)
    trends = read_csv(b.spark, paths["trends_path"], TREND)
    techs = b.spark.read.schema(SUMMARY).json(paths["summary_path"]).select(
        F.explode("tech_distribution").alias("tech", "n_weeks")
    )

    def line(df, name, total):
        return df.agg(F.count("*").alias("n"), total.alias("total")).select(
            F.lit(name).alias("export"), "n", "total"
        )

    return (
        line(leads, "lead_scores", scores.round_to(F.sum("composite_score")))
        .unionByName(line(trends, "company_trends", F.sum("jobs_posted").cast("double")))
        .unionByName(line(techs, "summary", F.sum("n_weeks").cast("double")))
    )


@query(
    "c10_dashboard_load",
    sql(
        "SELECT 'lead' AS part, company AS name, week_start, composite_score AS value FROM leads "
        "UNION ALL SELECT 'trend', company, week_start, CAST(jobs_posted AS DOUBLE) FROM stats "
        "UNION ALL SELECT 'tech', tech, NULL, CAST(company_count AS DOUBLE) FROM dist "
        f"UNION ALL SELECT 'summary', latest_week, NULL, avg_composite_score FROM ({SUMMARY_SQL}) AS s",
        "leads", "dist",
    ),
)
def c10(b):
    no_week = F.lit(None).cast("date").alias("week_start")

    def part(df, label, name, week, value):
        return df.select(
            F.lit(label).alias("part"), F.col(name).alias("name"), week,
            F.col(value).cast("double").alias("value"),
        )

    week = F.col("week_start")
    leads, stats = b.stored_leads, b.stored_stats
    return (
        part(lead_rows(leads), "lead", "company", week, "composite_score")
        .unionByName(part(trend_rows(stats), "trend", "company", week, "jobs_posted"))
        .unionByName(part(report.tech_distribution(stats), "tech", "tech", no_week, "company_count"))
        .unionByName(
            part(report.lead_summary(leads), "summary", "latest_week", no_week, "avg_composite_score")
        )
    )


TOP = "ORDER BY composite_score DESC, company_normalized LIMIT"


@query(
    "c11_leads_board",
    sql(
        "SELECT company, composite_score, velocity_score, tech_match_score, volume_score, "
        f"jobs_this_week, score_metadata AS tech_stack, {band('composite_score')} AS score_band "
        f"FROM leads {TOP} 20",
        "leads",
    ),
)
def c11(b):
    return report.leads_board(b.leads)


@query(
    "c12_score_components",
    sql(
        f"SELECT * FROM (SELECT company, unnest(['velocity_score', 'tech_match_score', "
        "'volume_score']) AS component, unnest([velocity_score, tech_match_score, volume_score]) "
        f"AS value FROM (SELECT * FROM leads {TOP} 10) AS t) AS u",
        "leads",
    ),
)
def c12(b):
    return report.score_components(b.leads)


@query(
    "c13_company_trend",
    sql("SELECT company, week_start, jobs_posted FROM stats WHERE company IN "
        "(SELECT DISTINCT company FROM stats ORDER BY company LIMIT 5)", "stats"),
)
def c13(b):
    return report.company_trend(b.stored_stats, report.default_companies(b.stored_stats))


@query(
    "c14_warehouse_report",
    sql(
        "SELECT 'total' AS section, 1 AS rank, 'jobs' AS label, count(*) AS value FROM postings "
        "UNION ALL SELECT 'range', 1, CAST(min(posting_date) AS VARCHAR) || ' to ' || "
        "CAST(max(posting_date) AS VARCHAR), NULL FROM postings UNION ALL "
        "SELECT 'company', CAST(row_number() OVER (ORDER BY n DESC, company) AS INTEGER), company, n "
        "FROM (SELECT company, count(*) AS n FROM postings GROUP BY 1 ORDER BY n DESC, company "
        "LIMIT 10) AS t UNION ALL SELECT 'recent', CAST(row_number() OVER (ORDER BY last_scraped_at "
        "DESC, job_id, title, company) AS INTEGER), company || ': ' || title || ' (' || "
        "CAST(posting_date AS VARCHAR) || ')', NULL FROM (SELECT * FROM postings ORDER BY "
        "last_scraped_at DESC, job_id, title, company LIMIT 5) AS r",
        "postings",
    ),
)
def c14(b):
    return report.warehouse_report(b.postings)


@query(
    "c15_recent_count",
    sql("SELECT count(*) AS job_count FROM postings WHERE last_scraped_at >= "
        "(SELECT max(last_scraped_at) FROM postings) - INTERVAL 7 DAY", "postings"),
)
def c15(b):
    return report.recent_count(b.postings, b.postings.agg(F.max("last_scraped_at")).scalar())


@query(
    "c15_recent_count_by_day",
    sql("SELECT count(*) AS job_count FROM postings WHERE last_scraped_at >= "
        "(SELECT max(last_scraped_at) FROM postings) - INTERVAL 7 DAY", "postings"),
)
def c15_by_day(b):
    path = new_path(b.spark, "by_day")
    daily.write_by_day(b.postings, path)
    rows = daily.recent(daily.read_by_day(b.spark, path), daily.newest_sighting(b.spark, path), 7)
    return rows.agg(F.count("*").alias("job_count"))


@query(
    "c16_top_leads_table",
    sql(
        "SELECT CAST(row_number() OVER (ORDER BY composite_score DESC, company_normalized) AS "
        "INTEGER) AS rank, company, composite_score, velocity_score, tech_match_score, volume_score, "
        "jobs_this_week, CASE WHEN length(score_metadata) > 30 THEN substr(score_metadata, 1, 30) || "
        f"'...' ELSE score_metadata END AS tech_preview FROM (SELECT * FROM leads {TOP} 10) AS t",
        "leads",
    ),
)
def c16(b):
    return report.ranked_leads(b.leads)


@query(
    "c17_batch_company_counts",
    sql("SELECT company, count(*) AS job_count FROM postings GROUP BY 1 "
        "ORDER BY job_count DESC, company LIMIT 10", "postings"),
)
def c17(b):
    return report.top_groups(b.postings, "company", 10)


@query(
    "c3_stats_overview",
    sql(
        "SELECT count(DISTINCT company_normalized) AS total_companies, count(DISTINCT week_start) AS "
        f"total_weeks, {rounded('avg(jobs_posted)')} AS avg_jobs_per_week, "
        "CAST(min(week_start) AS VARCHAR) || ' to ' || CAST(max(week_start) AS VARCHAR) AS date_range, "
        "(SELECT count(*) FROM dist) AS technologies_detected FROM stats",
        "stats", "dist",
    ),
)
def c3_overview(b):
    return report.stats_overview(b.stored_stats)
