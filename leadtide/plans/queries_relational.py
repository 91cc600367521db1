"""Queries: projections and filters (p*), joins (j*), windows (w*), sorts (o*), union (u*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from leadtide.functions import scores
from leadtide.functions.dates import within_days
from leadtide.functions.text import dedup_key
from leadtide.functions.titles import seniority, seniority_narrow
from leadtide.operators import report, stackindex
from leadtide.operators.clean import with_normalised
from leadtide.operators.detect import tech_matches, with_techs
from leadtide.operators.quality import duplicate_groups, invalid_scores, null_or_empty
from leadtide.operators.score import latest_week, with_matched_weight, with_previous
from leadtide.operators.stackindex import build_index
from leadtide.operators.stats import GROUP, weekly_jobs
from leadtide.operators.upsert import known_keys, split_batch
from leadtide.plans.catalog import query
from leadtide.plans.oracle import (
    RAW_COLUMNS, band, config_cte, matches, narrow_class, rounded, sql, wide_class,
)
from leadtide.sources import daily, ledger
from leadtide.sources.bindings import document_config
from leadtide.sources.config import DEFAULT_TECHS, tech_config
from leadtide.sources.tables import lead_feed, lead_rows, new_path

STATS_COLUMNS = "company_normalized, company, week_start, jobs_posted, tech_stack"
KEY_SQL = "company_normalized || '|' || title_normalized || '|' || place"


# --- projections and filters ---------------------------------------------------------------


@query(
    "p1_normalise",
    sql("SELECT job_id, company, company_normalized, title_normalized FROM normalised", "normalised"),
)
def p1(b):
    return with_normalised(b.postings).select(
        "job_id", "company", "company_normalized", "title_normalized"
    )


def keyed(b):
    return with_normalised(b.postings).withColumn(
        "dedup_key", dedup_key("company_normalized", "title_normalized", "location")
    )


@query(
    "p2_dedup_key",
    sql(f"SELECT {KEY_SQL} AS dedup_key, count(*) AS n FROM normalised GROUP BY 1", "normalised"),
)
def p2(b):
    return report.group_counts(keyed(b), "dedup_key", "n")


@query(
    "p3_drop_column",
    sql(
        "SELECT DISTINCT company_normalized, title_normalized, location FROM normalised",
        "normalised",
    ),
)
def p3(b):
    rows = keyed(b).select("company_normalized", "title_normalized", "location", "dedup_key")
    return rows.distinct().drop("dedup_key")


@query(
    "p4_rename",
    sql(
        "SELECT company_normalized, week_start, jobs_posted AS jobs_this_week, "
        "tech_stack AS score_metadata FROM stats",
        "stats",
    ),
)
def p4(b):
    return b.stats.select(
        "company_normalized", "week_start", F.col("jobs_posted").alias("jobs_this_week"),
        F.col("tech_stack").alias("score_metadata"),
    )


@query(
    "p5_seniority",
    sql(f"SELECT job_id, title, {wide_class('title')} AS seniority FROM postings", "postings"),
)
def p5(b):
    return b.postings.select("job_id", "title", seniority(F.col("title")).alias("seniority"))


@query(
    "p6_seniority_narrow",
    sql(f"SELECT job_id, title, {narrow_class('title')} AS seniority FROM postings", "postings"),
)
def p6(b):
    return b.postings.select("job_id", "title", seniority_narrow(F.col("title")).alias("seniority"))


@query(
    "p7_not_null",
    sql("SELECT job_id, location FROM postings WHERE location IS NOT NULL", "postings"),
)
def p7(b):
    return b.postings.where(F.col("location").isNotNull()).select("job_id", "location")


@query(
    "p8_boolean_filter",
    sql("SELECT job_id, tech_name FROM posting_hits JOIN (SELECT tech_name FROM tech "
        "WHERE is_target) AS t USING (tech_name)", "posting_hits"),
)
def p8(b):
    targets = b.config.where("is_target")
    return tech_matches(b.postings, targets).select("job_id", "tech_name")


@query("p9_non_empty", sql(f"SELECT {STATS_COLUMNS} FROM stats WHERE tech_stack <> ''", "stats"))
def p9(b):
    return b.stats.where("tech_stack <> ''")


@query(
    "p10_latest_week",
    sql(
        f"SELECT {STATS_COLUMNS} FROM stats WHERE week_start = (SELECT max(week_start) FROM stats)",
        "stats",
    ),
)
def p10(b):
    return latest_week(b.stored_stats)


@query(
    "p11_key_membership",
    sql("SELECT job_id FROM snapshot WHERE job_id IN (SELECT job_id FROM batch)", "snapshot", "batch"),
)
def p11(b):
    return known_keys(b.snapshot, b.batch)


@query(
    "p12_split_batch",
    sql(
        "SELECT *, CASE WHEN job_id IN (SELECT job_id FROM snapshot) THEN 'existing' "
        "ELSE 'new' END AS status FROM batch",
        "snapshot", "batch",
    ),
)
def p12(b):
    return split_batch(b.snapshot, b.batch)


@query(
    "p13_recent",
    sql(
        "SELECT job_id, last_scraped_at FROM postings WHERE last_scraped_at >= "
        "(SELECT max(last_scraped_at) FROM postings) - INTERVAL 30 DAY",
        "postings",
    ),
)
def p13(b):
    as_of = b.postings.agg(F.max("last_scraped_at")).scalar()
    rows = b.postings.withColumn("as_of", as_of)
    return rows.where(within_days(F.col("last_scraped_at"), F.col("as_of"), 30)).select(
        "job_id", "last_scraped_at"
    )


def by_day(b) -> str:
    """The postings laid out by the day of their last sighting."""
    path = new_path(b.spark, "by_day")
    daily.write_by_day(b.postings, path)
    return path


@query(
    "p13_recent_by_day",
    sql(
        "SELECT job_id, last_scraped_at FROM postings WHERE last_scraped_at >= "
        "(SELECT max(last_scraped_at) FROM postings) - INTERVAL 30 DAY",
        "postings",
    ),
)
def p13_by_day(b):
    path = by_day(b)
    rows = daily.recent(daily.read_by_day(b.spark, path), daily.newest_sighting(b.spark, path), 30)
    return rows.select("job_id", "last_scraped_at")


@query(
    "p13_recent_by_day_after_batch",
    sql(
        "SELECT job_id, last_scraped_at FROM after WHERE last_scraped_at >= "
        "(SELECT max(last_scraped_at) FROM after) - INTERVAL 30 DAY",
        "touched", "fresh", "tech",
        tech="SELECT 1 AS one), after AS (SELECT * FROM touched UNION ALL SELECT * FROM fresh",
    ),
)
def p13_by_day_after_batch(b):
    """A second batch moves the postings it sees again to their new day."""
    folder, path = new_path(b.spark, "ledger"), new_path(b.spark, "by_day")
    ledger.seed(b.snapshot, folder)
    daily.write_by_day(ledger.current(b.spark, folder), path)
    ledger.take_in(b.batch, folder, 1)
    daily.take_in_days(b.spark, folder, path, 1)
    rows = daily.recent(daily.read_by_day(b.spark, path), daily.newest_sighting(b.spark, path), 30)
    return rows.select("job_id", "last_scraped_at")


WEEK_SCORE = "company_normalized, week_start, composite_score"


@query(
    "p14_band_filters",
    sql(
        f"SELECT {WEEK_SCORE}, 'hot' AS kept FROM scored WHERE composite_score >= 80 UNION ALL "
        f"SELECT {WEEK_SCORE}, 'warm' FROM scored WHERE composite_score >= 50 "
        f"AND composite_score < 80 UNION ALL "
        f"SELECT {WEEK_SCORE}, 'cold' FROM scored WHERE composite_score < 50",
        "scored",
    ),
)
def p14(b):
    score = F.col("composite_score")
    rows = b.scored.select("company_normalized", "week_start", "composite_score")
    return rows.where(score.isNotNull()).withColumn("kept", scores.band(score))


@query(
    "p15_score_band",
    sql(f"SELECT {WEEK_SCORE}, {band('composite_score')} AS score_band FROM scored", "scored"),
)
def p15(b):
    return b.scored.select(
        "company_normalized", "week_start", "composite_score",
        scores.band(F.col("composite_score")).alias("score_band"),
    )


@query("p16_min_score", sql("SELECT * FROM scored WHERE composite_score >= 50", "scored"))
def p16(b):
    return b.scored.where(F.col("composite_score") >= 50)


@query("p17_min_jobs", sql("SELECT * FROM scored WHERE jobs_this_week >= 3", "scored"))
def p17(b):
    return b.scored.where(F.col("jobs_this_week") >= 3)


@query(
    "p18_all_techs",
    sql(
        f"SELECT {STATS_COLUMNS} FROM stats WHERE contains(tech_stack, 'Widget') "
        "AND contains(tech_stack, 'Promo')",
        "stats",
    ),
)
def p18(b):
    return b.stats.where(report.has_techs(["Widget", "Promo"]))


def stack_index(b, rows) -> str:
    folder = new_path(b.spark, "stack_index")
    build_index(rows, folder)
    return folder


@query(
    "p18_all_techs_indexed",
    sql(
        f"SELECT {STATS_COLUMNS} FROM stats WHERE contains(tech_stack, 'Widget') "
        "AND contains(tech_stack, 'Promo')",
        "stats",
    ),
)
def p18_indexed(b):
    folder = stack_index(b, b.stats)
    return stackindex.search(stackindex.indexed_rows(b.spark, folder), folder, ["Widget", "Promo"])


@query(
    "p18_all_techs_regex",
    sql(
        f"SELECT {STATS_COLUMNS} FROM stats WHERE regexp_matches(tech_stack, 'W.dget') "
        "AND regexp_matches(tech_stack, '^Bolt')",
        "stats",
    ),
)
def p18_regex(b):
    return b.stats.where(report.has_techs(["W.dget", "^Bolt"], regex=True))


@query(
    "p19_chosen_companies",
    sql(
        f"SELECT {STATS_COLUMNS} FROM stats WHERE company IN "
        "('Supplier#000000001', 'Supplier#000000002', '  SUPPLIER#000000003 ')",
        "stats",
    ),
)
def p19(b):
    chosen = ["Supplier#000000001", "Supplier#000000002", "  SUPPLIER#000000003 "]
    return b.stats.where(F.col("company").isin(chosen))


@query(
    "p20_invalid_scores",
    sql(
        "SELECT * FROM scored WHERE "
        + " OR ".join(
            f"{c} < 0 OR {c} > 100 OR {c} IS NULL"
            for c in ("velocity_score", "tech_match_score", "volume_score", "composite_score")
        ),
        "scored",
    ),
)
def p20(b):
    return invalid_scores(b.scored)


@query(
    "p21_null_or_empty",
    sql(
        "SELECT company_normalized, title_normalized, place FROM normalised "
        "WHERE place IS NULL OR place = ''",
        "normalised",
    ),
)
def p21(b):
    rows = with_normalised(b.postings).withColumn("place", F.coalesce("location", F.lit("")))
    return rows.where(null_or_empty("place")).select(
        "company_normalized", "title_normalized", "place"
    )


@query("p22_distinct", sql("SELECT DISTINCT company FROM stats", "stats"))
def p22(b):
    return b.stats.select("company").distinct()


SEARCH_SQL = (
    "FROM (SELECT company, composite_score, velocity_score, tech_match_score, volume_score, "
    "jobs_this_week, jobs_last_week, score_metadata AS tech_stack, week_start FROM scored) AS f "
    "WHERE composite_score >= 40 AND jobs_this_week >= 2 AND contains(tech_stack, 'Widget') "
    "AND contains(tech_stack, 'Gear')"
)


def search(b):
    return report.search_leads(lead_feed(b.scored), 40, 2, ["Widget", "Gear"])


@query("p23_search_leads", sql(f"SELECT * {SEARCH_SQL}", "scored"))
def p23(b):
    return search(b)


@query("p23_search_hit_count", sql(f"SELECT count(*) AS found {SEARCH_SQL}", "scored"))
def p23_count(b):
    return search(b).agg(F.count("*").alias("found"))


@query("p23_search_leads_indexed", sql(f"SELECT * {SEARCH_SQL}", "scored"))
def p23_indexed(b):
    folder = stack_index(b, lead_rows(b.scored))
    rows = report.search_leads(stackindex.indexed_rows(b.spark, folder), 40, 2)
    return stackindex.search(rows, folder, ["Widget", "Gear"])


# --- joins -------------------------------------------------------------------------------------


@query(
    "j1_posting_tech_pairs",
    sql(
        "SELECT tech_name, count(*) AS pairs, count(*) FILTER (WHERE has_tech) AS matched FROM "
        f"(SELECT t.tech_name, {matches('p', 't')} AS has_tech FROM postings p CROSS JOIN tech t) "
        "AS x GROUP BY tech_name",
        "postings", "tech",
    ),
)
def j1(b):
    """Every posting against every technology, counted without forming the pairs."""
    every = b.postings.agg(F.count("*")).scalar()
    hits = report.group_counts(tech_matches(b.postings, b.config), "tech_name", "matched")
    return b.config.join(hits, "tech_name", "left").select(
        "tech_name", every.alias("pairs"), F.coalesce("matched", F.lit(0)).alias("matched")
    )


MATCH_SQL = sql("SELECT job_id, title, tech_name FROM posting_hits", "posting_hits")


@query("j2_keyword_match", MATCH_SQL)
def j2(b):
    return tech_matches(b.postings, b.config).select("job_id", "title", "tech_name")


@query("j2_keyword_match_large_config", MATCH_SQL)
def j2_large(b):
    """The index of grams that long configs are joined by, chosen by a limit of zero."""
    return tech_matches(b.postings, b.config, max_techs=0).select("job_id", "title", "tech_name")


@query(
    "j2_document_match",
    sql(
        f"SELECT d.job_id, t.tech_name FROM docs d JOIN doc_tech t ON {matches('d', 't')}",
        "docs", "doc_tech",
    ),
)
def j2_documents(b):
    return tech_matches(b.documents, document_config(b.spark)).select("job_id", "tech_name")


@query(
    "j2_document_match_default_config",
    sql(
        f"SELECT d.job_id, t.tech_name FROM docs d JOIN tech t ON {matches('d', 't')}",
        "docs", "tech",
        tech=config_cte(DEFAULT_TECHS),
    ),
)
def j2_default(b):
    return tech_matches(b.documents, tech_config(b.spark)).select("job_id", "tech_name")


# Names on two rows, rows without a name, and keywords that are absent or repeated.
UNTIDY = [
    ("Widget", ["widget"], "part", True, 1.0), ("Widget", ["gizmo", "bolt", None], "part", True, 0.5),
    (None, ["gear"], "part", True, 9.0), ("Gear", ["gear", "gear"], "part", True, None), ("Gear", None, "part", True, 0.8),
    ("Ring", [], "part", False, 0.3),
]
UNTIDY_CTE = (
    "SELECT * FROM (VALUES " + ", ".join(
        "({}, {}, 'part', {}, CAST({} AS DOUBLE))".format(
            "NULL" if n is None else f"'{n}'",
            "CAST(NULL AS VARCHAR[])" if k is None
            else "CAST([" + ", ".join("NULL" if w is None else f"'{w}'" for w in k) + "] AS VARCHAR[])",
            t, "NULL" if w is None else w,
        ) for n, k, _, t, w in UNTIDY
    ) + ") AS v(tech_name, keywords, category, is_target, score_weight)"
)
UNTIDY_SQL = sql(
    f"SELECT DISTINCT p.job_id, p.title, t.tech_name FROM postings p JOIN tech t ON {matches('p', 't')} "
    "WHERE t.tech_name IS NOT NULL",
    "postings", "tech", tech=UNTIDY_CTE,
)


def untidy_config(b):
    kinds = "tech_name string, keywords array<string>, category string, is_target boolean, score_weight double"
    return b.spark.createDataFrame(UNTIDY, kinds)


@query("j2_keyword_match_untidy_config", UNTIDY_SQL)
def j2_untidy(b):
    return tech_matches(b.postings, untidy_config(b)).select("job_id", "title", "tech_name").distinct()


@query("j2_keyword_match_untidy_config_long", UNTIDY_SQL)
def j2_untidy_long(b):
    return tech_matches(b.postings, untidy_config(b), max_techs=0).select("job_id", "title", "tech_name").distinct()


def word_config(b):
    """A config of the five-letter beginnings of all words of the documents, some thousand, by first letter."""
    words = b.documents.select(F.explode(F.expr("regexp_extract_all(lower(description), '[a-z]{5}', 0)")).alias("word"))
    return words.distinct().groupBy(F.substring("word", 1, 1).alias("tech_name")).agg(
        F.sort_array(F.collect_list("word")).alias("keywords")  # at most 26 ** 5 words in all
    ).withColumns({"category": F.lit("word"), "is_target": F.lit(True), "score_weight": F.lit(1.0)})


@query(
    "j2_document_match_thousands_of_keywords",
    sql(
        "SELECT d.job_id, w.tech_name FROM docs d JOIN (SELECT DISTINCT substr(k, 1, 1) AS tech_name, k FROM "
        "(SELECT unnest(regexp_extract_all(lower(description), '[a-z]{5}')) AS k FROM docs) AS x) AS w "
        "ON contains(lower(d.title), w.k) OR contains(lower(d.description), w.k) GROUP BY ALL",
        "docs",
    ),
)
def j2_thousands(b):
    return tech_matches(b.documents, word_config(b)).select("job_id", "tech_name")


@query(
    "j3_weeks_without_tech",
    sql(
        "SELECT company_normalized, week_start, count(*) AS postings FROM weekly w "
        "LEFT JOIN (SELECT DISTINCT company_normalized AS c, week_start AS d FROM hits) AS h "
        "ON company_normalized = c AND week_start = d WHERE c IS NULL GROUP BY ALL",
        "hits",
    ),
)
def j3(b):
    """Both sides of the anti-join come from one table, so one aggregation tells both."""
    weekly = with_techs(weekly_jobs(b.cleaned), b.config)
    counts = weekly.groupBy(*GROUP).agg(
        F.count("*").alias("postings"), F.bool_or(F.size("techs") > 0).alias("found")
    )
    return counts.where(~F.col("found")).drop("found")


WEIGHTS_SQL = sql(
    "SELECT company_normalized, week_start, "
    f"{rounded('matched_weight')} AS matched_weight FROM scored_raw",
    "scored_raw",
)


@query("j4_matched_weight", WEIGHTS_SQL)
def j4(b):
    return with_matched_weight(b.stats, b.config).select(
        *GROUP, scores.round_to(F.col("matched_weight")).alias("matched_weight")
    )


@query("j4_matched_weight_many_targets", WEIGHTS_SQL)
def j4_many(b):
    """Each different technology list weighed once, as for long target lists; chosen by a limit of zero."""
    return with_matched_weight(b.stored_stats, b.config, max_targets=0).select(
        *GROUP, scores.round_to(F.col("matched_weight")).alias("matched_weight")
    )


UNTIDY_WEIGHTS = sql(
    "SELECT company_normalized, week_start, "
    + rounded("w") + " AS matched_weight FROM (SELECT s.company_normalized, s.week_start, (SELECT "
    f"coalesce(sum(score_weight), 0) FROM ({UNTIDY_CTE}) AS u WHERE is_target AND "
    "contains(s.tech_stack, u.tech_name)) AS w FROM stats s) AS x",
    "stats",
)


@query("j4_matched_weight_untidy_targets", UNTIDY_WEIGHTS)
def j4_untidy(b):
    return with_matched_weight(b.stats, untidy_config(b)).select(
        *GROUP, scores.round_to(F.col("matched_weight")).alias("matched_weight")
    )


@query("j4_matched_weight_untidy_targets_many", UNTIDY_WEIGHTS)
def j4_untidy_many(b):
    return with_matched_weight(b.stored_stats, untidy_config(b), max_targets=0).select(
        *GROUP, scores.round_to(F.col("matched_weight")).alias("matched_weight")
    )


@query(
    "j4_matched_weight_exact",
    sql(
        f"SELECT company_normalized, week_start, {rounded('coalesce(w, 0)')} AS matched_weight "
        "FROM (SELECT s.*, (SELECT sum(score_weight) FROM tech WHERE is_target AND "
        "list_contains(string_split(s.tech_stack, ','), tech_name)) AS w FROM stats s) AS x",
        "stats",
    ),
)
def j4_exact(b):
    return with_matched_weight(b.stats, b.config, exact=True).select(
        *GROUP, scores.round_to(F.col("matched_weight")).alias("matched_weight")
    )


@query(
    "j5_scalar_column",
    sql(
        "SELECT company_normalized, week_start, jobs_posted, (SELECT sum(score_weight) FROM tech "
        "WHERE is_target) AS possible_weight FROM stats",
        "stats",
    ),
)
def j5(b):
    possible = b.config.where("is_target").agg(F.sum("score_weight")).scalar()
    return b.stats.select(*GROUP, "jobs_posted", possible.alias("possible_weight"))


@query(
    "j6_semi_join",
    sql(
        f"SELECT {RAW_COLUMNS} FROM snapshot WHERE job_id IN (SELECT job_id FROM batch)",
        "snapshot", "batch",
    ),
)
def j6(b):
    return b.snapshot.join(b.batch.select("job_id"), "job_id", "left_semi")


@query(
    "j7_anti_join",
    sql("SELECT job_id, company, title, scraped_at FROM batch WHERE job_id NOT IN "
        "(SELECT job_id FROM snapshot)", "snapshot", "batch"),
)
def j7(b):
    return b.batch.join(b.snapshot.select("job_id"), "job_id", "left_anti").select(
        "job_id", "company", "title", "scraped_at"
    )


@query(
    "j8_known_key_count",
    sql("SELECT count(*) AS known FROM snapshot WHERE job_id IN (SELECT job_id FROM batch)",
        "snapshot", "batch"),
)
def j8(b):
    return known_keys(b.snapshot, b.batch, limit=0).agg(F.count("*").alias("known"))


@query("j9_unnest", sql("SELECT * FROM stack_techs", "stack_techs"))
def j9(b):
    return report.stack_techs(b.stats).select(*GROUP, "tech")


# --- windows ---------------------------------------------------------------------------------


@query(
    "w1_previous_row",
    sql("SELECT company_normalized, week_start, jobs_posted, prev AS jobs_last_week FROM scored_raw",
        "scored_raw"),
)
def w1(b):
    return with_previous(b.stats).select(*GROUP, "jobs_posted", "jobs_last_week")


@query(
    "w2_global_max",
    sql("SELECT company_normalized, week_start, jobs_posted, CAST(max(jobs_posted) OVER () "
        "AS INTEGER) AS most FROM stats", "stats"),
)
def w2(b):
    most = b.stored_stats.agg(F.max("jobs_posted")).scalar()
    return b.stored_stats.select(*GROUP, "jobs_posted", most.alias("most"))


@query(
    "w3_rank",
    sql(
        "SELECT CAST(row_number() OVER (ORDER BY composite_score DESC, company_normalized) "
        "AS INTEGER) AS rank, company, composite_score FROM leads QUALIFY rank <= 10",
        "leads",
    ),
)
def w3(b):
    return report.ranked_leads(b.leads).select("rank", "company", "composite_score")


# --- sorts and limits --------------------------------------------------------------------------


@query("o1_multi_key_sort", sql(f"SELECT {STATS_COLUMNS} FROM stats", "stats"))
def o1(b):
    return b.stats.orderBy(F.desc("week_start"), F.desc("jobs_posted"), "company_normalized")


@query("o2_score_sort", sql("SELECT * FROM scored", "scored"))
def o2(b):
    return b.scored.orderBy(F.desc("composite_score"), "company_normalized", "week_start")


@query(
    "o3_top_leads",
    sql(
        "SELECT * FROM (SELECT 10 AS k, * FROM (SELECT * FROM leads ORDER BY composite_score DESC, "
        "company_normalized LIMIT 10) AS a UNION ALL SELECT 20, * FROM (SELECT * FROM leads "
        "ORDER BY composite_score DESC, company_normalized LIMIT 20) AS b) AS u",
        "leads",
    ),
)
def o3(b):
    ten, twenty = [
        report.top_leads(b.stored_leads, k).select(F.lit(k).alias("k"), "*") for k in (10, 20)
    ]
    return ten.unionByName(twenty)


@query(
    "o4_recent_postings",
    sql("SELECT job_id, company, title, posting_date FROM postings ORDER BY last_scraped_at DESC, "
        "job_id, title, company LIMIT 5", "postings"),
)
def o4(b):
    return report.recent_postings(b.postings).select("job_id", "company", "title", "posting_date")


@query(
    "o4_recent_postings_by_day",
    sql("SELECT job_id, company, title, posting_date FROM postings ORDER BY last_scraped_at DESC, "
        "job_id, title, company LIMIT 5", "postings"),
)
def o4_by_day(b):
    return daily.last_seen(b.spark, by_day(b)).select("job_id", "company", "title", "posting_date")


@query("o5_top_techs", sql("SELECT * FROM dist ORDER BY company_count DESC, tech LIMIT 10", "dist"))
def o5(b):
    return report.tech_distribution(b.stats).orderBy(F.desc("company_count"), "tech").limit(10)


@query("o6_trend_sort", sql(f"SELECT {STATS_COLUMNS} FROM stats", "stats"))
def o6(b):
    return b.stats.orderBy("company_normalized", "week_start")


@query(
    "o7_default_companies",
    sql("SELECT DISTINCT company FROM stats ORDER BY company LIMIT 5", "stats"),
)
def o7(b):
    return report.default_companies(b.stats)


@query(
    "o8_first_examples",
    sql("SELECT company_normalized, title_normalized, count(*) AS duplicate_count FROM cleaned "
        "GROUP BY ALL HAVING count(*) > 1 ORDER BY company_normalized, title_normalized LIMIT 3",
        "cleaned"),
)
def o8(b):
    return duplicate_groups(b.cleaned).orderBy("company_normalized", "title_normalized").limit(3)


@query(
    "o9_sorted_subquery",
    sql("SELECT company_normalized, week_start, prev AS jobs_last_week FROM "
        "(SELECT * FROM scored_raw ORDER BY week_start DESC) AS s", "scored_raw"),
)
def o9(b):
    """A sort below a projection changes nothing, so there is none."""
    return with_previous(b.stats).select(*GROUP, "jobs_last_week")


# --- union -------------------------------------------------------------------------------------


@query(
    "u1_union_all",
    sql("SELECT company_normalized, week_start, tech_stack, 'found' AS part FROM stats_hit "
        "UNION ALL SELECT company_normalized, week_start, tech_stack, 'none' FROM stats_none",
        "stats_hit", "stats_none"),
)
def u1(b):
    rows = b.stored_stats.select(*GROUP, "tech_stack")
    with_tech = rows.where("tech_stack <> ''").withColumn("part", F.lit("found"))
    without = rows.where("tech_stack = ''").withColumn("part", F.lit("none"))
    return with_tech.unionByName(without)
