"""Queries: scans and sources (s*), sinks and table maintenance (k*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadtide.operators import report
from leadtide.operators.detect import tech_matches
from leadtide.operators.quality import constraint_report
from leadtide.operators.score import lead_scores
from leadtide.operators.upsert import (
    ingest_accounting, insert_or_ignore, new_postings, touch, upsert_postings,
)
from leadtide.plans.catalog import query
from leadtide.plans.oracle import RAW_COLUMNS, config_cte, rounded, sql
from leadtide.schemas import COMPANY_STATS, RAW_JOBS
from leadtide.sources import bindings
from leadtide.sources.batches import accepted, read_batch, read_lines, refused, typed
from leadtide.sources.ledger import current, seed, take_in
from leadtide.sources.config import add_techs, set_target, target_list, tech_config, tech_names
from leadtide.sources.tables import (
    lead_feed, new_path, read_csv, read_table, refresh_table, trend_feed, write_csv, write_json,
)

FEED = (
    "company string, composite_score double, velocity_score double, tech_match_score double, "
    "volume_score double, jobs_this_week int, jobs_last_week int, tech_stack string, week_start date"
)
TREND = "company_normalized string, company string, week_start date, jobs_posted int, tech_stack string"
SUMMARY = (
    "generated_at string, total_companies bigint, hot_leads bigint, warm_leads bigint, "
    "cold_leads bigint, avg_composite_score double, latest_week string, "
    "tech_distribution map<string,bigint>"
)
SUMMARY_SQL = (
    "SELECT count(*) AS total_companies, "
    "count(*) FILTER (WHERE composite_score >= 80) AS hot_leads, "
    "count(*) FILTER (WHERE composite_score >= 50 AND composite_score < 80) AS warm_leads, "
    "count(*) FILTER (WHERE composite_score < 50) AS cold_leads, "
    f"{rounded('coalesce(avg(composite_score), 0)')} AS avg_composite_score, "
    "coalesce(CAST(max(week_start) AS VARCHAR), 'N/A') AS latest_week FROM leads"
)


def matched_per_tech(jobs, config):
    """Postings per configured technology, 0 where none names it."""
    counts = report.group_counts(tech_matches(jobs, config), "tech_name", "postings")
    return config.join(counts, "tech_name", "left").withColumn(
        "postings", F.coalesce("postings", F.lit(0))
    )


COUNTS_SQL = (
    "(SELECT count(*) FROM posting_hits h WHERE h.tech_name = t.tech_name) AS postings FROM tech t"
)


@query("s1_raw_scan", sql(f"SELECT {RAW_COLUMNS} FROM postings", "postings"))
def s1(b):
    path = new_path(b.spark, "raw_jobs")
    refresh_table(b.postings, path, "raw_jobs")
    return read_table(b.spark, path, "raw_jobs")


@query("s2_lead_feed", sql("SELECT * FROM feed", "feed"))
def s2(b):
    return lead_feed(b.leads)


@query(
    "s3_trend_feed",
    sql("SELECT company_normalized, company, week_start, jobs_posted, tech_stack FROM stats", "stats"),
)
def s3(b):
    return trend_feed(b.stats)


LINES_PER_FILE = 1_000_000


def text_batch(b):
    """The postings as they would arrive: JSON lines, dates as ISO text, NULL fields absent, compressed.

    A compressed file is read by one task, so its rows are bounded.
    """
    path = new_path(b.spark, "batch")
    b.postings.select(
        "job_id", "company", "title", "description", "location",
        F.date_format("posting_date", "yyyy-MM-dd").alias("posting_date"), "url", "source",
        F.date_format("first_scraped_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("scraped_at"),
    ).write.option("maxRecordsPerFile", LINES_PER_FILE).json(path, compression="gzip")
    return read_batch(b.spark, path)


@query(
    "s4_batch_ingest",
    sql(
        "SELECT job_id, company, title, description, location, posting_date, url, source, "
        "first_scraped_at AS scraped_at FROM postings",
        "postings",
    ),
)
def s4(b):
    return typed(text_batch(b))


@query(
    "s4_lines_accepted_and_refused",
    sql(
        "SELECT CASE WHEN line = 2 THEN 'not a JSON record' WHEN line = 3 THEN 'missing: company, title' "
        "WHEN line = 4 THEN 'scraped_at cannot be read' END AS reason, count(*) AS lines FROM postings GROUP BY 1",
        "postings",
    ),
)
def s4_lines(b):
    """Every line is accepted or refused for a reason; some lines are spoilt first."""
    record = F.struct(
        "job_id", F.when(F.col("line") != 3, F.col("company")).alias("company"),
        F.when(F.col("line") != 3, F.col("title")).alias("title"), "source",
        F.when(F.col("line") == 4, F.lit("soon")).otherwise(F.col("first_scraped_at").cast("string")).alias("scraped_at"),
    )
    text = F.to_json(record)
    path = new_path(b.spark, "lines")
    b.postings.select(F.when(F.col("line") == 2, F.concat(F.lit("{"), text)).otherwise(text)).write.text(path)
    lines = read_lines(b.spark, path)
    taken = accepted(lines).select(F.lit(None).cast("string").alias("reason"))
    return taken.unionAll(refused(lines).select("reason")).groupBy("reason").agg(F.count("*").alias("lines"))


@query(
    "s5_iso_text_cast",
    sql(
        "SELECT job_id, CASE WHEN line = 7 THEN NULL ELSE posting_date END AS posting_date, "
        "first_scraped_at AS scraped_at FROM postings",
        "postings",
    ),
)
def s5(b):
    unreadable = F.col("job_id").endswith("-7")
    batch = text_batch(b).withColumn(
        "posting_date", F.when(unreadable, F.lit("soon")).otherwise(F.col("posting_date"))
    )
    return typed(batch).select("job_id", "posting_date", "scraped_at")


@query(
    "s6_inline_config",
    sql(
        "SELECT tech_name, category, array_to_string(keywords, ',') AS keywords, is_target, "
        f"score_weight, {COUNTS_SQL}",
        "posting_hits",
    ),
)
def s6(b):
    return matched_per_tech(b.postings, b.config).select(
        "tech_name", "category", F.array_join("keywords", ",").alias("keywords"), "is_target",
        "score_weight", "postings",
    )


@query("s7_config_listing", sql(f"SELECT tech_name, {COUNTS_SQL}", "posting_hits"))
def s7(b):
    names = tech_names(b.config)
    return matched_per_tech(b.postings, b.config).join(names, "tech_name").select(
        "tech_name", "postings"
    ).orderBy("tech_name")


@query(
    "s8_target_listing",
    sql(f"SELECT tech_name, score_weight, {COUNTS_SQL} WHERE is_target", "posting_hits"),
)
def s8(b):
    counts = matched_per_tech(b.postings, b.config).select("tech_name", "postings")
    return target_list(b.config).join(counts, "tech_name").orderBy("tech_name")


@query("k1_insert_unseen", sql("SELECT * FROM fresh", "fresh"))
def k1(b):
    return new_postings(b.snapshot, b.batch)


@query("k2_touch_seen", sql("SELECT * FROM touched", "touched"))
def k2(b):
    return touch(b.snapshot, b.batch)


@query(
    "k3_upsert_large_batch",
    sql("SELECT * FROM touched UNION ALL SELECT * FROM fresh", "touched", "fresh"),
)
def k3(b):
    return upsert_postings(b.snapshot, b.batch, limit=0)


@query(
    "k3_upsert_ledger",
    sql("SELECT * FROM touched UNION ALL SELECT * FROM fresh", "touched", "fresh"),
)
def k3_ledger(b):
    """The upsert that writes what follows the batch only; taken in twice, as after a failure."""
    folder = new_path(b.spark, "ledger")
    seed(b.snapshot, folder)
    for _ in range(2):
        take_in(b.batch, folder, 1)
    return current(b.spark, folder)


@query(
    "k4_insert_or_ignore",
    sql(
        f"SELECT {RAW_COLUMNS} FROM snapshot UNION ALL SELECT job_id, company, title, description, "
        "location, posting_date, url, source, first_scraped_at, last_scraped_at FROM (SELECT *, "
        "row_number() OVER (PARTITION BY job_id ORDER BY first_scraped_at NULLS FIRST, "
        "company NULLS FIRST, title NULLS FIRST, description NULLS FIRST, location NULLS FIRST, "
        "posting_date NULLS FIRST, url NULLS FIRST, source NULLS FIRST, "
        "last_scraped_at NULLS FIRST) AS rn FROM postings WHERE line >= 3) AS p "
        "WHERE rn = 1 AND job_id NOT IN (SELECT job_id FROM snapshot)",
        "snapshot",
    ),
)
def k4(b):
    rows = b.postings.where("line >= 3").select(*RAW_JOBS.names)
    return insert_or_ignore(b.snapshot, rows, ["job_id"], ["first_scraped_at"])


@query(
    "k5_ingest_accounting",
    sql(
        "SELECT (SELECT count(*) FROM batch) AS total_jobs_scraped, "
        "(SELECT count(*) FROM fresh) AS jobs_inserted, (SELECT count(*) FROM incoming "
        "WHERE job_id IN (SELECT job_id FROM snapshot)) AS existing_jobs_updated",
        "fresh",
    ),
)
def k5(b):
    return ingest_accounting(b.snapshot, b.batch)


@query("k6_full_refresh", sql("SELECT * FROM cleaned", "cleaned"))
def k6(b):
    path = new_path(b.spark, "cleaned_jobs")
    cleaned = b.stored_cleaned  # read by both runs
    for _ in range(2):  # the second run replaces the first
        refresh_table(cleaned, path, "cleaned_jobs")
    return read_table(b.spark, path, "cleaned_jobs")


@query(
    "k6_refresh_by_week",
    sql("SELECT company_normalized, company, week_start, jobs_posted, tech_stack FROM stats", "stats"),
)
def k6_weeks(b):
    path = new_path(b.spark, "company_stats")
    refresh_table(b.stats, path, "company_stats", by_week=True)
    return read_table(b.spark, path, "company_stats").select(*COMPANY_STATS.names)


@query(
    "k7_seed_config", sql(f"SELECT tech_name, score_weight, {COUNTS_SQL}", "posting_hits")
)
def k7(b):
    heavier = b.config.withColumn("score_weight", F.col("score_weight") + 1)
    seeded = insert_or_ignore(b.config, heavier, ["tech_name"], ["score_weight"])
    return matched_per_tech(b.postings, seeded).select("tech_name", "score_weight", "postings")


BOLT_TARGET = [(n, k, c, t or n == "Bolt", w) for n, k, c, t, w in bindings.PART_TECHS]


@query("k8_set_target", sql("SELECT * FROM leads", "leads", tech=config_cte(BOLT_TARGET)))
def k8(b):
    return lead_scores(b.stored_stats, set_target(b.config, "Bolt"))


NEW_TECH = ("FirstBrands", ["brand#1"], "brand", True, 1.0)


@query(
    "k9_add_tech",
    sql(
        f"SELECT tech_name, is_target, {COUNTS_SQL}",
        "posting_hits",
        tech=config_cte([*bindings.PART_TECHS, NEW_TECH]),
    ),
)
def k9(b):
    grown = add_techs(b.config, tech_config(b.spark, [NEW_TECH, bindings.PART_TECHS[0]]))
    return matched_per_tech(b.postings, grown).select("tech_name", "is_target", "postings")


@query("k10_lead_csv", sql("SELECT * FROM feed", "feed"))
def k10(b):
    path = new_path(b.spark, "lead_scores_latest.csv")
    write_csv(lead_feed(b.leads), path)
    return read_csv(b.spark, path, FEED)


@query(
    "k11_trend_csv",
    sql("SELECT company_normalized, company, week_start, jobs_posted, tech_stack FROM stats", "stats"),
)
def k11(b):
    path = new_path(b.spark, "company_trends.csv")
    write_csv(trend_feed(b.stats), path)
    return read_csv(b.spark, path, TREND)


@query(
    "k12_summary_json",
    sql(
        "SELECT s.*, '2001-11-07T00:00:00' AS generated_at, tech, company_count "
        f"FROM ({SUMMARY_SQL}) AS s, dist",
        "leads", "dist",
    ).replace("'2001-11-07T00:00:00'", "strftime((SELECT max(last_scraped_at) FROM postings), "
              "'%Y-%m-%dT%H:%M:%S')"),
)
def k12(b):
    path = new_path(b.spark, "summary.json")
    as_of = b.postings.agg(F.max("last_scraped_at")).scalar()
    write_json(report.summary_document(b.stored_leads, b.stored_stats, as_of), path)
    document = b.spark.read.schema(SUMMARY).json(path)
    return document.select(
        *[c for c in document.columns if c != "tech_distribution"],
        F.explode("tech_distribution").alias("tech", "company_count"),
    )


@query(
    "k13_constraints",
    sql(
        "SELECT 'not_null' AS \"constraint\", c AS columns, v AS violations FROM (SELECT "
        "unnest(['job_id', 'company', 'title', 'source']) AS c, unnest([count(*) - count(job_id), "
        "count(*) - count(company), count(*) - count(title), count(*) - count(source)]) AS v "
        "FROM postings) AS n UNION ALL SELECT 'primary_key', 'job_id', (SELECT count(*) FROM "
        "(SELECT job_id FROM postings GROUP BY job_id HAVING count(*) > 1) AS d)",
        "postings",
    ),
)
def k13(b):
    return constraint_report(b.postings, "raw_jobs")
