"""Queries: data-quality checks (q*)."""

from __future__ import annotations

from leadtide.operators import quality
from leadtide.operators.detect import tech_matches
from leadtide.operators.report import group_counts
from leadtide.plans.catalog import query
from leadtide.plans.oracle import rounded, sql
from leadtide.sources.tables import store


def verdict(check, passed, severity, measured, limit, note="NULL") -> str:
    return (
        f"SELECT '{check}' AS \"check\", {passed} AS passed, "
        f"CASE WHEN NOT ({passed}) THEN '{severity}' END AS severity, "
        f"CAST({measured} AS BIGINT) AS measured, CAST({limit} AS BIGINT) AS \"limit\", "
        f"CAST({note} AS VARCHAR) AS note "
    )


EMPTY = "count(*) FILTER (WHERE company_normalized IS NULL OR company_normalized = '')"
Q1 = verdict(
    "no_null_companies", f"{EMPTY} = 0", "ERROR", EMPTY, "count(*)",
    f"printf('%.2f%%', {rounded(f'CAST({EMPTY} AS DOUBLE) / greatest(count(*), 1) * 100')})",
) + "FROM cleaned"
Q2 = verdict("reasonable_job_count", "count(*) >= 50", "WARN", "count(*)", "50") + "FROM cleaned"
Q3 = verdict(
    "deduplication_effective", "count(*) = 0", "ERROR", "count(*)", "0",
    "coalesce((SELECT string_agg(text, '; ' ORDER BY company_normalized, title_normalized) FROM "
    "(SELECT *, company_normalized || '|' || title_normalized || '|' || CAST(n AS VARCHAR) AS text "
    "FROM dup ORDER BY company_normalized, title_normalized LIMIT 3) AS e), 'None')",
) + (
    "FROM dup"
)
DUP = (
    "(SELECT company_normalized, title_normalized, count(*) AS n FROM cleaned GROUP BY ALL "
    "HAVING count(*) > 1)"
)
Q3 = Q3.replace("FROM dup", f"FROM {DUP} AS dup")
Q4 = verdict(
    "targets_configured", "count(*) FILTER (WHERE is_target) >= 1", "ERROR",
    "count(*) FILTER (WHERE is_target)", "1",
) + "FROM tech"
Q5 = verdict("minimum_leads", "count(*) >= 5", "WARN", "count(*)", "5") + "FROM leads"
BAD = "(SELECT * FROM {0} WHERE " + " OR ".join(
    f"{c} IS NULL OR {c} NOT BETWEEN 0 AND 100" for c in quality.SCORES
) + ")"
Q6 = verdict(
    "scores_valid", "count(*) = 0", "ERROR", "count(*)", "0",
    "coalesce((SELECT string_agg(company, '; ' ORDER BY company_normalized, week_start) FROM "
    f"(SELECT * FROM {BAD} AS b2 ORDER BY company_normalized, week_start LIMIT 3) AS e), 'None')",
) + f"FROM {BAD} AS bad"


@query("q1_no_null_companies", sql(Q1, "cleaned"))
def q1(b):
    return quality.no_null_companies(b.cleaned)


@query("q2_reasonable_job_count", sql(Q2, "cleaned"))
def q2(b):
    return quality.reasonable_job_count(b.cleaned)


@query("q3_deduplication_effective", sql(Q3, "cleaned"))
def q3(b):
    return quality.deduplication_effective(b.stored_cleaned)


@query("q4_targets_configured", sql(Q4 + " WHERE tech_name IN (SELECT tech_name FROM posting_hits)",
                                    "tech", "posting_hits"))
def q4(b):
    """Targets among the technologies that occur in the postings."""
    seen = tech_matches(b.postings, b.config).select("tech_name").distinct()
    return quality.targets_configured(b.config.join(seen, "tech_name", "left_semi"))


@query("q5_minimum_leads", sql(Q5, "leads"))
def q5(b):
    return quality.minimum_leads(b.leads)


@query("q6_score_validity", sql(Q6.replace("{0}", "leads"), "leads"))
def q6(b):
    return quality.scores_valid(b.stored_leads)


@query("q6_score_validity_all_weeks", sql(Q6.replace("{0}", "scored"), "scored"))
def q6_all(b):
    """The invalid rows, which alone the check looks at, are stored: it reads them twice."""
    return quality.scores_valid(store(quality.invalid_scores(b.scored), "invalid_scores"))


def guard(check, severity, source) -> str:
    n = f"least((SELECT count(*) FROM {source}), 1)"
    return verdict(check, f"{n} > 0", severity, n, "1")


def config_with_postings(b):
    """The config, and how many postings each technology was found in."""
    return b.config.join(group_counts(tech_matches(b.postings, b.config), "tech_name", "postings"), "tech_name", "left")


@query("q7_config_present", sql(guard("config_present", "ERROR", "tech"), "tech"))
def q7(b):
    return quality.config_present(config_with_postings(b))


@query("q8_target_present", sql(guard("target_present", "ERROR", "(SELECT * FROM tech WHERE is_target)"), "tech"))
def q8(b):
    return quality.target_present(config_with_postings(b))


@query("q9_batch_present", sql(guard("batch_present", "WARN", "batch"), "batch"))
def q9(b):
    return quality.batch_present(b.batch)


@query("q10_anything_scored", sql(guard("anything_scored", "WARN", "leads"), "leads"))
def q10(b):
    return quality.anything_scored(b.leads)


@query(
    "q_all_checks",
    sql(
        " UNION ALL ".join([Q1, Q2, Q3, Q4, Q5, Q6.replace("{0}", "leads")]),
        "cleaned", "leads", "tech",
    ),
)
def q_all(b):
    b.cleaned = b.stored_cleaned  # the leads start from the stored table too
    return quality.all_checks(b.cleaned, b.config, b.stored_leads)
