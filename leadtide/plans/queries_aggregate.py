"""Queries: aggregations (a*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadtide.functions import scores
from leadtide.functions.titles import CLASSES, seniority
from leadtide.operators import report
from leadtide.operators.clean import dedup_accounting, with_normalised
from leadtide.operators.detect import tech_matches, with_techs
from leadtide.operators.quality import duplicate_groups
from leadtide.operators.score import latest_week
from leadtide.operators.stackindex import build_index, tech_counts
from leadtide.operators.stats import company_stats
from leadtide.plans.catalog import query
from leadtide.plans.oracle import rounded, sql, wide_class
from leadtide.plans.queries_table import SUMMARY_SQL
from leadtide.sources.tables import new_path


@query(
    "a1_first_row_per_group",
    sql("SELECT job_id, company, company_normalized, title, title_normalized, description, "
        "location, posting_date, url, source FROM cleaned", "cleaned"),
)
def a1(b):
    return b.cleaned.drop("first_seen", "last_seen")


@query(
    "a2_seen_span",
    sql("SELECT company_normalized, title_normalized, place, first_seen, last_seen FROM spans", "spans"),
)
def a2(b):
    place = F.coalesce("location", F.lit("")).alias("place")
    return with_normalised(b.postings).groupBy("company_normalized", "title_normalized", place).agg(
        F.min("first_scraped_at").alias("first_seen"), F.max("last_scraped_at").alias("last_seen")
    )


@query(
    "a3_count_distinct",
    sql("SELECT company_normalized, count(DISTINCT title) AS titles FROM normalised GROUP BY 1",
        "normalised"),
)
def a3(b):
    return with_normalised(b.postings).groupBy("company_normalized").agg(
        F.count_distinct("title").alias("titles")
    )


@query(
    "a4_filtered_count_distinct",
    sql(
        "SELECT company_normalized, "
        + ", ".join(
            f"count(DISTINCT title) FILTER (WHERE {wide_class('title')} = '{c}') AS {c[:3].lower()}"
            for c in CLASSES
        )
        + " FROM normalised GROUP BY 1",
        "normalised",
    ),
)
def a4(b):
    """A title fixes its class: make titles distinct once, then count by class."""
    titles = with_normalised(b.postings).select("company_normalized", "title").distinct()
    return titles.groupBy("company_normalized").agg(
        *[F.count_if(seniority(F.col("title")) == c).alias(c[:3].lower()) for c in CLASSES]
    )


@query(
    "a5_distinct_list",
    sql("SELECT company_normalized, string_agg(DISTINCT tech_name, ',' ORDER BY tech_name) AS techs "
        "FROM hits GROUP BY 1", "hits"),
)
def a5(b):
    return tech_matches(b.cleaned, b.config).groupBy("company_normalized").agg(
        F.array_join(F.array_sort(F.collect_set("tech_name")), ",").alias("techs")
    )


@query(
    "a6_distinct_list_not_null",
    sql("SELECT title, string_agg(DISTINCT location, ',' ORDER BY location) "
        "FILTER (WHERE location IS NOT NULL) AS places FROM postings GROUP BY 1", "postings"),
)
def a6(b):
    places = b.postings.select("title", "location").distinct()
    return places.groupBy("title").agg(
        F.array_join(F.array_sort(F.collect_list("location")), ",").alias("places")
    )


@query(
    "a7_empty_list_default",
    sql("SELECT company_normalized, week_start, tech_stack, locations, "
        "CAST(CASE WHEN tech_stack = '' THEN 0 ELSE len(string_split(tech_stack, ',')) END "
        "AS INTEGER) AS n_techs FROM stats", "stats"),
)
def a7(b):
    detail = company_stats(b.cleaned, b.config, detail=True)
    return detail.select(
        "company_normalized", "week_start", "tech_stack",
        F.array_join("locations", "|").alias("locations"), F.size("tech_array").alias("n_techs"),
    )


@query(
    "a8_any_true",
    sql("SELECT title, title IN (SELECT title FROM posting_hits) AS any_tech FROM postings GROUP BY 1",
        "posting_hits"),
)
def a8(b):
    return with_techs(b.postings, b.config).groupBy("title").agg(
        F.bool_or(F.size("techs") > 0).alias("any_tech")
    )


@query(
    "a9_counts",
    sql("SELECT (SELECT count(*) FROM postings) AS raw_jobs, (SELECT count(*) FROM cleaned) AS "
        "cleaned_jobs, (SELECT count(*) FROM stats) AS company_stats, (SELECT count(*) FROM leads) "
        "AS lead_scores", "leads"),
)
def a9(b):
    n = F.count("*")
    return b.postings.agg(n.alias("raw_jobs")).select(
        "raw_jobs",
        b.cleaned.agg(n).scalar().alias("cleaned_jobs"),
        b.stored_stats.agg(n).scalar().alias("company_stats"),
        b.leads.agg(n).scalar().alias("lead_scores"),
    )


@query(
    "a10_filtered_count",
    sql("SELECT count(*) FILTER (WHERE location IS NULL) AS without_place, count(*) FILTER "
        "(WHERE source = 'R') AS from_r, (SELECT count(*) FROM tech WHERE is_target) AS targets "
        "FROM postings", "postings", "tech"),
)
def a10(b):
    return b.postings.agg(
        F.count_if(F.col("location").isNull()).alias("without_place"),
        F.count_if(F.col("source") == "R").alias("from_r"),
    ).withColumn("targets", b.config.agg(F.count_if("is_target")).scalar())


@query(
    "a11_top_companies",
    sql("SELECT company, count(*) AS job_count FROM postings GROUP BY 1 "
        "ORDER BY job_count DESC, company LIMIT 10", "postings"),
)
def a11(b):
    return report.top_groups(b.postings, "company", 10)


@query(
    "a12_top_normalised_companies",
    sql("SELECT company_normalized, count(*) AS job_count FROM cleaned GROUP BY 1 "
        "ORDER BY job_count DESC, company_normalized LIMIT 10", "cleaned"),
)
def a12(b):
    return report.top_groups(b.cleaned, "company_normalized", 10)


@query(
    "a13_sources", sql("SELECT source, count(*) AS n FROM cleaned GROUP BY 1", "cleaned")
)
def a13(b):
    return report.group_counts(b.cleaned, "source", "n")


@query(
    "a14_date_range",
    sql("SELECT min(posting_date) AS earliest, max(posting_date) AS latest FROM cleaned", "cleaned"),
)
def a14(b):
    return report.date_range(b.cleaned)


BANDS_SQL = (
    "count(*) FILTER (WHERE composite_score >= 80) AS hot_leads, "
    "count(*) FILTER (WHERE composite_score >= 50 AND composite_score < 80) AS warm_leads, "
    "count(*) FILTER (WHERE composite_score < 50) AS cold_leads"
)


@query(
    "a15_band_counts",
    sql(f"SELECT week_start, {BANDS_SQL} FROM scored GROUP BY 1", "scored"),
)
def a15(b):
    return b.scored.groupBy("week_start").agg(*report.band_counts())


@query(
    "a16_averages",
    sql(
        "SELECT "
        + ", ".join(
            f"{rounded(f'avg({c})')} AS avg_{c}"
            for c in ("velocity_score", "tech_match_score", "volume_score", "composite_score",
                      "jobs_this_week")
        )
        + " FROM scored",
        "scored",
    ),
)
def a16(b):
    names = ["velocity_score", "tech_match_score", "volume_score", "composite_score", "jobs_this_week"]
    return b.scored.agg(*[scores.round_to(F.avg(c)).alias(f"avg_{c}") for c in names])


@query("a17_latest_week", sql("SELECT max(week_start) AS latest_week FROM stats", "stats"))
def a17(b):
    return b.stats.agg(F.max("week_start").alias("latest_week"))


@query(
    "a18_distinct_counts",
    sql("SELECT count(DISTINCT company_normalized) AS companies, count(DISTINCT week_start) AS weeks "
        "FROM stats", "stats"),
)
def a18(b):
    return b.stats.agg(
        F.count_distinct("company_normalized").alias("companies"),
        F.count_distinct("week_start").alias("weeks"),
    )


@query(
    "a19_top_totals",
    sql("SELECT company_normalized, CAST(sum(jobs_posted) AS BIGINT) AS total_jobs FROM stats "
        "GROUP BY 1 ORDER BY total_jobs DESC, company_normalized LIMIT 5", "stats"),
)
def a19(b):
    return b.stats.groupBy("company_normalized").agg(F.sum("jobs_posted").alias("total_jobs")).orderBy(
        F.desc("total_jobs"), "company_normalized"
    ).limit(5)


@query(
    "a20_weight_sum",
    sql(f"SELECT {rounded('sum(t.score_weight)')} AS matched_weight, {rounded('max(p.w)')} AS "
        "possible_weight FROM posting_hits h JOIN tech t USING (tech_name), (SELECT sum(score_weight) "
        "AS w FROM tech WHERE is_target) AS p WHERE t.is_target", "posting_hits"),
)
def a20(b):
    targets = b.config.where("is_target")
    possible = targets.agg(F.sum("score_weight")).scalar()
    matched = tech_matches(b.postings, targets).join(targets, "tech_name")
    return matched.agg(
        scores.round_to(F.sum("score_weight")).alias("matched_weight")
    ).withColumn("possible_weight", scores.round_to(possible))


@query("a21_tech_distribution", sql("SELECT * FROM dist", "dist"))
def a21(b):
    return report.tech_distribution(b.stats)


@query("a21_tech_distribution_indexed", sql("SELECT * FROM dist", "dist"))
def a21_indexed(b):
    """Counted by the bits of the index."""
    folder = new_path(b.spark, "stack_index")
    build_index(b.stats, folder)
    return tech_counts(b.spark, folder)


@query(
    "a22_tech_distribution_latest_week",
    sql("SELECT tech, count(*) AS company_count FROM stack_techs WHERE week_start = "
        "(SELECT max(week_start) FROM stats) GROUP BY 1", "stack_techs"),
)
def a22(b):
    return report.tech_distribution(latest_week(b.stored_stats))


@query(
    "a23_techs_detected",
    sql("SELECT count(DISTINCT tech) AS technologies_detected FROM stack_techs", "stack_techs"),
)
def a23(b):
    return report.stack_techs(b.stats).agg(F.count_distinct("tech").alias("technologies_detected"))


@query(
    "a24_duplicate_groups",
    sql("SELECT company_normalized, title_normalized, count(*) AS duplicate_count FROM cleaned "
        "GROUP BY ALL HAVING count(*) > 1", "cleaned"),
)
def a24(b):
    return duplicate_groups(b.cleaned)


@query(
    "a25_dedup_accounting",
    sql(
        "SELECT raw AS raw_job_count, kept AS cleaned_job_count, raw - kept AS duplicates_removed, "
        f"printf('%.1f%%', {rounded('(raw - kept)::DOUBLE / greatest(raw, 1) * 100', 1)}) "
        "AS deduplication_rate FROM (SELECT (SELECT count(*) FROM postings) AS raw, "
        "(SELECT count(*) FROM cleaned) AS kept) AS x",
        "cleaned",
    ),
)
def a25(b):
    return dedup_accounting(b.postings, b.cleaned)


@query(
    "a26_tech_share",
    sql(
        "SELECT tech, company_count, "
        f"{rounded('company_count::DOUBLE / greatest((SELECT count(*) FROM leads), 1) * 100')} "
        "AS share_pct FROM dist",
        "dist", "leads",
    ),
)
def a26(b):
    return report.tech_shares(b.stored_stats, b.leads)


HISTOGRAM_SQL = (
    "SELECT CAST(bin AS INTEGER) AS bin, bin * 5.0::DOUBLE AS from_score, "
    "(bin + 1) * 5.0::DOUBLE AS to_score, (SELECT count(*) FROM {0} WHERE "
    "greatest(0, least(floor(composite_score / 5), 19)) = bin) AS leads FROM range(20) AS r(bin)"
)


@query("a27_histogram", sql(HISTOGRAM_SQL.format("leads"), "leads"))
def a27(b):
    return report.score_histogram(b.leads)


@query("a27_histogram_all_weeks", sql(HISTOGRAM_SQL.format("scored"), "scored"))
def a27_all(b):
    return report.score_histogram(b.scored)


@query("a28_summary", sql(SUMMARY_SQL, "leads"))
def a28(b):
    return report.lead_summary(b.leads)


@query(
    "a29_scores_overview",
    sql(
        "SELECT count(*) AS total_companies_scored, "
        f"coalesce(CAST(max(week_start) AS VARCHAR), 'N/A') AS scoring_date, {BANDS_SQL}, "
        + ", ".join(
            f"{rounded(f'avg({c})')} AS avg_{c}"
            for c in ("velocity_score", "tech_match_score", "volume_score", "composite_score")
        )
        + ", (SELECT company FROM leads ORDER BY composite_score DESC, company_normalized LIMIT 1) "
        "AS top_lead_company, max(composite_score) AS top_lead_score FROM leads",
        "leads",
    ),
)
def a29(b):
    return report.scores_overview(b.leads)
