"""Queries: scalar functions (f*), each projected over all postings or company-weeks."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadtide.functions import scores
from leadtide.functions.dates import iso_date, iso_timestamp, week_start, within_days
from leadtide.functions.text import (
    dedup_key, normalise, percent_text, posting_key, posting_text, posting_url, preview, range_text,
)
from leadtide.operators import report
from leadtide.operators.detect import tech_matches
from leadtide.operators.score import with_previous
from leadtide.operators.stats import GROUP
from leadtide.plans.catalog import query
from leadtide.plans.oracle import normal, rounded, sql


def over_postings(name: str, expression: str, build, keep=("job_id",)):
    """Register ``value`` computed for every posting."""

    @query(name, sql(f"SELECT {', '.join(keep)}, {expression} AS value FROM postings", "postings"))
    def run(b):
        return b.postings.select(*keep, build().alias("value"))


over_postings("f1_lower", "lower(company)", lambda: F.lower("company"))
over_postings("f2_strip", normal("company"), lambda: normalise("company"))
over_postings(
    "f3_concat_separator",
    "lower(company) || '|' || lower(title) || '|' || coalesce(location, '')",
    lambda: dedup_key(F.lower("company"), F.lower("title"), F.col("location")),
)
over_postings(
    "f4_null_fill", "coalesce(location, '')", lambda: F.coalesce("location", F.lit(""))
)
over_postings(
    "f5_concat", "'%' || source || '%' || title",
    lambda: F.concat(F.lit("%"), "source", F.lit("%"), "title"),
)
over_postings(
    "f6_contains", "contains(lower(title), 'ring')",
    lambda: F.contains(F.lower("title"), F.lit("ring")),
)
over_postings(
    "f7_regex_contains", "regexp_matches(title, '(red|blue) .*t$')",
    lambda: F.rlike("title", F.lit("(red|blue) .*t$")),
)
over_postings(
    "f8_case", "CASE WHEN line = 1 THEN 'first' WHEN line < 4 THEN 'early' ELSE 'late' END",
    lambda: F.when(F.col("line") == 1, "first").when(F.col("line") < 4, "early").otherwise("late"),
)
over_postings(
    "f9_week_start", "CAST(date_trunc('week', posting_date) AS DATE)",
    lambda: week_start("posting_date"), keep=("job_id", "posting_date"),
)
over_postings(
    "f10_cap", "least(line * 20, 100)", lambda: F.least(F.col("line") * 20, F.lit(100))
)
over_postings(
    "f11_round", rounded("line::DOUBLE / 7 * 100"),
    lambda: scores.round_to(F.col("line").cast("double") / 7 * 100), keep=("job_id", "line"),
)
# Just below, at and just above the half, and beyond any decimal(18, 6).
over_postings(
    "f11_round_near_half",
    rounded("line::DOUBLE + CASE line % 4 WHEN 0 THEN 0.0049999996 WHEN 1 THEN 0.005 WHEN 2 THEN 0.0050000004 ELSE 3e12 END"),
    lambda: scores.round_to(
        F.col("line").cast("double")
        + F.when(F.col("line") % 4 == 0, 0.0049999996).when(F.col("line") % 4 == 1, 0.005)
        .when(F.col("line") % 4 == 2, 0.0050000004).otherwise(3e12)
    ),
    keep=("job_id", "line"),
)
over_postings(
    "f12_cast", rounded("CAST(line AS DOUBLE) / 3"),
    lambda: scores.round_to(F.col("line").cast("double") / 3), keep=("job_id", "line"),
)
over_postings(
    "f14_split", "split_part(description, ' ', 2)",
    lambda: F.element_at(F.split("description", " "), 2),
)
over_postings(
    "f15_join_list", "array_to_string(list_sort([title, source]), ',')",
    lambda: F.array_join(F.array_sort(F.array("title", "source")), ","),
)
over_postings(
    "f18_trim", "trim(company)", lambda: F.trim("company"), keep=("job_id", "company")
)
over_postings(
    "f20_posting_key",
    "substr(sha256(company || '_' || title || '_' || CAST(posting_date AS VARCHAR) || '_' || "
    "CAST(line AS VARCHAR)), 1, 16)",
    lambda: posting_key("company", "title", "posting_date", "line"),
    keep=("job_id", "company", "title"),
)
over_postings(
    "f21_days_before", "CAST(posting_date - line AS DATE)",
    lambda: F.date_sub("posting_date", F.col("line")),
)
over_postings(
    "f23_iso", "CAST(posting_date AS VARCHAR) || ' ' || strftime(first_scraped_at, '%Y-%m-%dT%H:%M:%S')",
    lambda: F.concat_ws(" ", iso_date("posting_date"), iso_timestamp("first_scraped_at")),
)


@query(
    "f13_guarded_ratio",
    sql(
        "SELECT company_normalized, week_start, "
        f"{rounded('CASE WHEN prev IS NULL OR prev = 0 THEN 100.0 ELSE least((jobs_posted - prev) * 100.0 / prev, 100.0) END')} "
        "AS velocity, "
        f"{rounded('CAST(jobs_posted AS DOUBLE) / greatest(coalesce(prev, 0), 1) * 100')} AS share "
        "FROM scored_raw",
        "scored_raw",
    ),
)
def f13(b):
    now, before = F.col("jobs_posted"), F.col("jobs_last_week")
    return with_previous(b.stats).select(
        *GROUP,
        scores.round_to(scores.velocity(now, before)).alias("velocity"),
        scores.round_to(scores.share(now, F.coalesce(before, F.lit(0)))).alias("share"),
    )


@query(
    "f16_unnest",
    sql("SELECT tech_name, keyword, (SELECT count(*) FROM postings WHERE contains(lower(title), "
        "keyword)) AS titles FROM (SELECT tech_name, unnest(keywords) AS keyword FROM tech) AS k",
        "postings", "tech"),
)
def f16(b):
    words = b.config.select("tech_name", F.explode("keywords").alias("keyword"))
    titles = report.group_counts(b.postings, "title", "n")
    by_word = tech_matches(
        titles.withColumn("description", F.lit(None).cast("string")),
        words.select(
            F.col("keyword").alias("tech_name"), F.array("keyword").alias("keywords"),
            F.lit(False).alias("is_target"), F.lit(1.0).alias("score_weight"),
        ),
    )
    counts = by_word.groupBy(F.col("tech_name").alias("keyword")).agg(F.sum("n").alias("titles"))
    return words.join(counts, "keyword", "left").select(
        "tech_name", "keyword", F.coalesce("titles", F.lit(0)).alias("titles")
    )


@query(
    "f17_array_literal",
    sql("SELECT job_id, list_contains(['A', 'R'], source) AS listed, CAST(len(['A', 'R', 'N']) "
        "AS INTEGER) AS size FROM postings", "postings"),
)
def f17(b):
    return b.postings.select(
        "job_id",
        F.array_contains(F.array(F.lit("A"), F.lit("R")), F.col("source")).alias("listed"),
        F.size(F.array(F.lit("A"), F.lit("R"), F.lit("N"))).alias("size"),
    )


@query(
    "f19_preview",
    sql("SELECT company_normalized, week_start, CASE WHEN length(tech_stack) > 20 THEN "
        "substr(tech_stack, 1, 20) || '...' ELSE tech_stack END AS value FROM stats", "stats"),
)
def f19(b):
    return b.stats.select(*GROUP, preview("tech_stack", 20).alias("value"))


@query(
    "f22_interval",
    sql("SELECT job_id, first_scraped_at - INTERVAL 7 DAY AS value, first_scraped_at >= "
        "(SELECT max(first_scraped_at) FROM postings) - INTERVAL 365 DAY AS recent FROM postings",
        "postings"),
)
def f22(b):
    newest = b.postings.agg(F.max("first_scraped_at")).scalar()
    return b.postings.withColumn("newest", newest).select(
        "job_id",
        (F.col("first_scraped_at") - F.make_dt_interval(F.lit(7))).alias("value"),
        within_days(F.col("first_scraped_at"), F.col("newest"), 365).alias("recent"),
    )


SKILLS = ["writes and speaks clearly", "a degree or as much practice"]
BENEFITS = ["fair pay", "time to learn"]
LINES = "E'\\n'"


@query(
    "f24_templates",
    sql(
        "SELECT job_id, 'https://example.com/jobs/' || job_id AS link, company || ' is hiring a ' || "
        f"title || '.' || {LINES} || {LINES} || 'Requirements:' || {LINES} || '- Strong experience with ' || source "
        f"|| ', ' || url || {LINES} || '- Experience with ' || url || ' is a plus' || "
        + " || ".join(f"{LINES} || '- {x}'" for x in SKILLS)
        + f" || {LINES} || {LINES} || 'Tech Stack:' || {LINES} || source || ', ' || url || {LINES} || {LINES} || 'Benefits:' || "
        + " || ".join(f"{LINES} || '- {x}'" for x in BENEFITS)
        + f" || {LINES} || {LINES} || 'Location: anywhere' AS text FROM postings",
        "postings",
    ),
)
def f24(b):
    return b.postings.withColumn("techs", F.array("source", "url")).select(
        "job_id",
        posting_url(F.col("job_id")).alias("link"),
        posting_text("company", "title", "techs", SKILLS, BENEFITS, "anywhere").alias("text"),
    )


@query(
    "f25_percent_text",
    sql(
        "SELECT company_normalized, week_start, "
        + ", ".join(
            f"printf('%.{d}f%%', {rounded('CAST(jobs_posted AS DOUBLE) / most * 100', d)}) AS pct{d}"
            for d in (0, 1, 2)
        )
        + " FROM scored_raw",
        "scored_raw",
    ),
)
def f25(b):
    most = b.stored_stats.agg(F.max("jobs_posted")).scalar()
    rows = b.stored_stats.withColumn("most", most)
    value = F.col("jobs_posted").cast("double") / F.col("most") * 100
    return rows.select(*GROUP, *[percent_text(value, d).alias(f"pct{d}") for d in (0, 1, 2)])


@query(
    "f26_range_text",
    sql("SELECT company_normalized, CAST(min(week_start) AS VARCHAR) || ' to ' || "
        "CAST(max(week_start) AS VARCHAR) AS weeks FROM stats GROUP BY 1", "stats"),
)
def f26(b):
    return b.stats.groupBy("company_normalized").agg(
        range_text(F.min("week_start"), F.max("week_start")).alias("weeks")
    )
