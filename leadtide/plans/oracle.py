"""Building blocks of the SQL that the registered queries are checked against."""

from __future__ import annotations

from leadtide.sources import bindings


def rounded(x: str, digits: int = 2) -> str:
    """Half up, once, on the decimal text of the double."""
    return (
        f"CASE WHEN abs({x}) >= 1e15 THEN CAST({x} AS DOUBLE) ELSE "
        f"CAST(ROUND(CAST(CAST(({x}) AS VARCHAR) AS DECIMAL(38,20)), {digits}) AS DOUBLE) END"
    )


def _config_rows(rows) -> str:
    return ", ".join(
        "('{}', [{}], '{}', {}, CAST({} AS DOUBLE))".format(
            name, ", ".join(f"'{k}'" for k in keywords), category, str(flag).lower(), weight
        )
        for name, keywords, category, flag, weight in rows
    )


def config_cte(rows) -> str:
    return (
        "SELECT * FROM (VALUES " + _config_rows(rows)
        + ") AS v(tech_name, keywords, category, is_target, score_weight)"
    )


WS = "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '"


def normal(column: str) -> str:
    return f"trim(lower({column}), {WS})"


def first_row(table: str, key: list[str], order: list[str]) -> str:
    ordered = ", ".join(f"{c} NULLS FIRST" for c in order)
    return (
        f"SELECT *, row_number() OVER (PARTITION BY {', '.join(key)} ORDER BY {ordered}) AS rn "
        f"FROM {table}"
    )


def matches(jobs: str, tech: str) -> str:
    """Condition: some keyword of the tech row occurs in the posting."""
    return (
        f"EXISTS (SELECT 1 FROM (SELECT unnest({tech}.keywords) AS k) AS words "
        f"WHERE contains(lower({jobs}.title), k) "
        f"OR contains(lower(coalesce({jobs}.description, '')), k))"
    )


def wide_class(title: str) -> str:
    t = f"lower({title})"
    return (
        f"CASE WHEN contains({t}, 'senior') OR contains({t}, 'sr.') THEN 'Senior' "
        f"WHEN contains({t}, 'junior') OR contains({t}, 'jr.') THEN 'Junior' "
        f"WHEN contains({t}, 'lead') OR contains({t}, 'principal') THEN 'Lead' "
        "ELSE 'Mid-Level' END"
    )


def narrow_class(title: str) -> str:
    t = f"lower({title})"
    return (
        f"CASE WHEN contains({t}, 'senior') THEN 'Senior' WHEN contains({t}, 'junior') "
        f"THEN 'Junior' WHEN contains({t}, 'lead') THEN 'Lead' ELSE 'Mid-Level' END"
    )


def band(score: str) -> str:
    return f"CASE WHEN {score} >= 80 THEN 'hot' WHEN {score} >= 50 THEN 'warm' ELSE 'cold' END"


def _classes(kind) -> str:
    names = [("Senior", "senior"), ("Junior", "junior"), ("Lead", "lead"), ("Mid-Level", "mid")]
    return ", ".join(
        f"count(DISTINCT title) FILTER (WHERE {kind('title')} = '{cls}') AS {short}_count"
        for cls, short in names
    )


FIRST = [
    "first_scraped_at", "job_id", "title", "description", "location", "url", "source", "company",
    "last_scraped_at", "posting_date",
]
BATCH_FIRST = [
    "scraped_at", "title", "description", "location", "url", "source", "company", "posting_date",
]
BATCH_COLUMNS = (
    "job_id, company, title, description, location, posting_date, url, source, "
    "first_scraped_at AS scraped_at"
)
RAW_COLUMNS = (
    "job_id, company, title, description, location, posting_date, url, source, "
    "first_scraped_at, last_scraped_at"
)
PAYLOAD = ["company", "title", "description", "location", "posting_date", "url", "source"]


def _one_per_job(source: str) -> str:
    return (
        f"SELECT job_id, {', '.join(PAYLOAD)}, scraped_at AS first_scraped_at, "
        f"latest AS last_scraped_at FROM (SELECT *, max(scraped_at) OVER (PARTITION BY job_id) "
        f"AS latest FROM ({first_row(source, ['job_id'], BATCH_FIRST)}) AS r) AS q WHERE rn = 1"
    )


_prefixes = " ".join(f"WHEN {n} THEN '{text}'" for n, text in bindings.PREFIXES.items())

# name -> (other parts it needs, SELECT)
PARTS: dict[str, tuple[list[str], str]] = {
    "tech": ([], config_cte(bindings.PART_TECHS)),
    "doc_tech": ([], config_cte(bindings.DOCUMENT_TECHS)),
    "postings": (
        [],
        "SELECT CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS job_id, "
        "CASE WHEN l_linenumber % 3 = 0 THEN '  ' || upper(s_name) || ' ' ELSE s_name END AS company, "
        f"CASE l_linenumber {_prefixes} ELSE '' END || p_name AS title, "
        "p_type || ' ' || p_brand AS description, "
        "CASE WHEN l_linenumber = 5 THEN NULL ELSE n_name END AS location, "
        "CAST(l_shipdate AS DATE) AS posting_date, s_name || '/u' AS url, l_returnflag AS source, "
        "l_shipdate AS first_scraped_at, l_shipdate + INTERVAL 3 DAY AS last_scraped_at, "
        "l_linenumber AS line "
        "FROM lineitem JOIN part ON l_partkey = p_partkey "
        "JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey",
    ),
    "docs": (
        [],
        "SELECT CAST(doc_id AS VARCHAR) AS job_id, source AS company, "
        "'Document ' || CAST(doc_id AS VARCHAR) AS title, text AS description, lang AS location, "
        "DATE '2024-01-01' + CAST(doc_id % 56 AS INTEGER) AS posting_date, source FROM documents",
    ),
    "normalised": (
        ["postings"],
        f"SELECT *, {normal('company')} AS company_normalized, {normal('title')} AS title_normalized, "
        "coalesce(location, '') AS place FROM postings",
    ),
    "ranked": (
        ["normalised"],
        first_row("normalised", ["company_normalized", "title_normalized", "place"], FIRST),
    ),
    "spans": (
        ["normalised"],
        "SELECT company_normalized, title_normalized, place, min(first_scraped_at) AS first_seen, "
        "max(last_scraped_at) AS last_seen FROM normalised GROUP BY ALL",
    ),
    "cleaned": (
        ["ranked", "spans"],
        "SELECT job_id, company, r.company_normalized, title, r.title_normalized, description, "
        "location, posting_date, url, source, first_seen, last_seen FROM ranked r JOIN spans s "
        "ON r.company_normalized = s.company_normalized "
        "AND r.title_normalized = s.title_normalized AND r.place = s.place WHERE rn = 1",
    ),
    "weekly": (
        ["cleaned"],
        "SELECT *, CAST(date_trunc('week', posting_date) AS DATE) AS week_start FROM cleaned "
        "WHERE posting_date IS NOT NULL",
    ),
    "hits": (
        ["weekly", "tech"],
        f"SELECT w.*, t.tech_name FROM weekly w JOIN tech t ON {matches('w', 't')}",
    ),
    "posting_hits": (
        ["postings", "tech"],
        f"SELECT p.*, t.tech_name FROM postings p JOIN tech t ON {matches('p', 't')}",
    ),
    "stats_hit": (
        ["hits"],
        "SELECT company_normalized, min(company) AS company, week_start, "
        "CAST(count(DISTINCT title) AS INTEGER) AS jobs_posted, "
        "string_agg(DISTINCT tech_name, ',' ORDER BY tech_name) AS tech_stack, "
        "coalesce(string_agg(DISTINCT location, '|' ORDER BY location), '') AS locations, "
        f"{_classes(wide_class)} FROM hits GROUP BY company_normalized, week_start",
    ),
    "stats_none": (
        ["hits"],
        "SELECT company_normalized, min(company) AS company, week_start, "
        "CAST(count(DISTINCT title) AS INTEGER) AS jobs_posted, '' AS tech_stack, "
        "coalesce(string_agg(DISTINCT location, '|' ORDER BY location), '') AS locations, "
        f"{_classes(narrow_class)} FROM weekly w WHERE NOT EXISTS (SELECT 1 FROM hits h "
        "WHERE h.company_normalized = w.company_normalized AND h.week_start = w.week_start) "
        "GROUP BY company_normalized, week_start",
    ),
    "stats": (
        ["stats_hit", "stats_none"],
        "SELECT * FROM stats_hit UNION ALL SELECT * FROM stats_none",
    ),
    "scored_raw": (
        ["stats", "tech"],
        "SELECT *, CASE WHEN prev IS NULL OR prev = 0 THEN 100.0 "
        "ELSE least(CAST(jobs_posted - prev AS DOUBLE) / prev * 100, 100.0) END AS v, "
        "matched_weight / possible_weight * 100 AS t, "
        "CAST(jobs_posted AS DOUBLE) / most * 100 AS m FROM (SELECT s.*, "
        "lag(jobs_posted) OVER (PARTITION BY company_normalized ORDER BY week_start) AS prev, "
        "coalesce((SELECT sum(score_weight) FROM tech WHERE is_target "
        "AND contains(s.tech_stack, tech_name)), 0.0) AS matched_weight, "
        "(SELECT sum(score_weight) FROM tech WHERE is_target) AS possible_weight, "
        "(SELECT max(jobs_posted) FROM stats) AS most FROM stats s) AS x",
    ),
    "scored": (
        ["scored_raw"],
        "SELECT company_normalized, company, week_start, jobs_posted AS jobs_this_week, "
        "coalesce(prev, 0) AS jobs_last_week, "
        f"{rounded('v')} AS velocity_score, {rounded('t')} AS tech_match_score, "
        f"{rounded('m')} AS volume_score, "
        f"{rounded('v * 0.4 + t * 0.35 + m * 0.25')} AS composite_score, "
        "tech_stack AS score_metadata FROM scored_raw",
    ),
    "leads": (
        ["scored"],
        "SELECT * FROM scored WHERE week_start = (SELECT max(week_start) FROM stats)",
    ),
    "feed": (
        ["leads"],
        "SELECT company, composite_score, velocity_score, tech_match_score, volume_score, "
        "jobs_this_week, jobs_last_week, score_metadata AS tech_stack, week_start FROM leads",
    ),
    "stack_techs": (
        ["stats"],
        "SELECT company_normalized, week_start, trim(tech) AS tech FROM (SELECT *, "
        "unnest(string_split(tech_stack, ',')) AS tech FROM stats WHERE tech_stack <> '') AS x",
    ),
    "dist": (
        ["stack_techs"],
        "SELECT tech, count(*) AS company_count FROM stack_techs GROUP BY tech",
    ),
    "old_batch": (["postings"], f"SELECT {BATCH_COLUMNS} FROM postings WHERE line <= 4"),
    "batch": (["postings"], f"SELECT {BATCH_COLUMNS} FROM postings WHERE line >= 3"),
    "snapshot": (["old_batch"], _one_per_job("old_batch")),
    "incoming": (["batch"], _one_per_job("batch")),
    "fresh": (
        ["incoming", "snapshot"],
        f"SELECT {RAW_COLUMNS} FROM incoming WHERE job_id NOT IN (SELECT job_id FROM snapshot)",
    ),
    "touched": (
        ["incoming", "snapshot"],
        f"SELECT s.job_id, {', '.join('s.' + c for c in PAYLOAD)}, s.first_scraped_at, "
        "coalesce(i.last_scraped_at, s.last_scraped_at) AS last_scraped_at "
        "FROM snapshot s LEFT JOIN incoming i ON s.job_id = i.job_id",
    ),
}


def sql(body: str, *roots: str, **extra: str) -> str:
    """``body`` behind a WITH clause of the parts it needs; ``extra`` replaces parts."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for need in PARTS[name][0]:
            visit(need)
        ordered.append(name)

    for root in roots:
        visit(root)
    if not ordered:
        return body
    parts = ", ".join(
        f"{name} AS MATERIALIZED ({extra.get(name, PARTS[name][1])})" for name in ordered
    )
    return f"WITH {parts} {body}"
