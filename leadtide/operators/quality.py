"""Data-quality checks.  Each gives one row: check, passed, severity, measured, limit, note.

``severity`` is NULL when the check passes.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from leadtide.functions.scores import share
from leadtide.functions.text import percent_text
from leadtide.schemas import KEYS, SCHEMAS

# Limits of the checks.
MIN_JOBS = 50
MIN_LEADS = 5
MIN_TARGETS = 1
EXAMPLES = 3
SCORES = ["velocity_score", "tech_match_score", "volume_score", "composite_score"]


def _verdict(counts: DataFrame, check, passed: Column, severity, measured, limit, note) -> DataFrame:
    return counts.select(*_columns(check, passed, severity, measured, limit, note))


def _columns(check, passed, severity, measured, limit, note) -> list[Column]:
    return [
        F.lit(check).alias("check"),
        passed.alias("passed"),
        F.when(~passed, severity).alias("severity"),
        measured.cast("bigint").alias("measured"),
        limit.cast("bigint").alias("limit"),
        note.cast("string").alias("note"),
    ]


def _verdicts(counts: DataFrame, *checks: tuple) -> DataFrame:
    """Several verdicts on one row of counts."""
    return counts.select(F.inline(F.array(*[F.struct(*_columns(*c)) for c in checks])))


def null_or_empty(column: str) -> Column:
    return F.col(column).isNull() | (F.col(column) == "")


def no_null_companies(cleaned: DataFrame) -> DataFrame:
    counts = cleaned.agg(
        F.count_if(null_or_empty("company_normalized")).alias("bad"), F.count("*").alias("n")
    )
    bad, n = F.col("bad"), F.col("n")
    return _verdict(
        counts, "no_null_companies", bad == 0, "ERROR", bad, n, percent_text(share(bad, n), 2)
    )


def reasonable_job_count(cleaned: DataFrame, minimum: int = MIN_JOBS) -> DataFrame:
    n = F.col("n")
    return _verdict(
        cleaned.agg(F.count("*").alias("n")),
        "reasonable_job_count", n >= minimum, "WARN", n, F.lit(minimum), F.lit(None),
    )


def duplicate_groups(cleaned: DataFrame) -> DataFrame:
    """Company and title pairs that more than one row has (locations may differ)."""
    return (
        cleaned.groupBy("company_normalized", "title_normalized")
        .agg(F.count("*").alias("duplicate_count"))
        .where("duplicate_count > 1")
    )


def _examples(rows: DataFrame, order: list[str], text: Column) -> Column:
    """The first three rows as one text; only those three are gathered."""
    first = rows.orderBy(*order).limit(EXAMPLES).select(
        F.struct(*order).alias("o"), text.alias("text")
    )
    joined = F.array_join(
        F.transform(F.array_sort(F.collect_list(F.struct("o", "text"))), lambda e: e.text), "; "
    )
    return first.agg(F.nullif(joined, F.lit(""))).scalar()


def deduplication_effective(cleaned: DataFrame) -> DataFrame:
    groups = duplicate_groups(cleaned)
    n = F.col("n")
    text = F.concat_ws("|", "company_normalized", "title_normalized", F.col("duplicate_count").cast("string"))
    note = F.coalesce(
        _examples(groups, ["company_normalized", "title_normalized"], text), F.lit("None")
    )
    return _verdict(
        groups.agg(F.count("*").alias("n")),
        "deduplication_effective", n == 0, "ERROR", n, F.lit(0), note,
    )


def targets_configured(config: DataFrame) -> DataFrame:
    n = F.col("n")
    return _verdict(
        config.agg(F.count_if("is_target").alias("n")),
        "targets_configured", n >= MIN_TARGETS, "ERROR", n, F.lit(MIN_TARGETS), F.lit(None),
    )


def minimum_leads(leads: DataFrame, minimum: int = MIN_LEADS) -> DataFrame:
    n = F.col("n")
    return _verdict(
        leads.agg(F.count("*").alias("n")),
        "minimum_leads", n >= minimum, "WARN", n, F.lit(minimum), F.lit(None),
    )


def invalid_scores(leads: DataFrame) -> DataFrame:
    return leads.where(_invalid())


def _invalid() -> Column:
    bad = [F.col(s).isNull() | ~F.col(s).between(0, 100) for s in SCORES]
    return reduce(lambda a, b: a | b, bad)


def _invalid_note(leads: DataFrame) -> Column:
    order = ["company_normalized", "week_start"]
    return F.coalesce(_examples(invalid_scores(leads), order, F.col("company")), F.lit("None"))


def scores_valid(leads: DataFrame) -> DataFrame:
    n = F.col("n")
    return _verdict(
        invalid_scores(leads).agg(F.count("*").alias("n")),
        "scores_valid", n == 0, "ERROR", n, F.lit(0), _invalid_note(leads),
    )


# Guards on empty input: the pipeline yields no rows there; these say why.


def not_empty(df: DataFrame, check: str, severity: str) -> DataFrame:
    """Passes when there is a row; ``measured`` is 0 or 1, only one row is looked for."""
    n = F.col("n")
    return _verdict(
        df.limit(1).agg(F.count("*").alias("n")), check, n > 0, severity, n, F.lit(1), F.lit(None)
    )


def config_present(config: DataFrame) -> DataFrame:
    return not_empty(config, "config_present", "ERROR")


def target_present(config: DataFrame) -> DataFrame:
    return not_empty(config.where("is_target"), "target_present", "ERROR")


def batch_present(batch: DataFrame) -> DataFrame:
    return not_empty(batch, "batch_present", "WARN")


def anything_scored(leads: DataFrame) -> DataFrame:
    return not_empty(leads, "anything_scored", "WARN")


def all_checks(cleaned: DataFrame, config: DataFrame, leads: DataFrame) -> DataFrame:
    """The verdicts of all checks; cleaned jobs and leads are each counted in one pass."""
    of_cleaned = cleaned.agg(
        F.count("*").alias("n"), F.count_if(null_or_empty("company_normalized")).alias("bad")
    )
    of_leads = leads.agg(F.count("*").alias("n"), F.count_if(_invalid()).alias("bad"))
    n, bad = F.col("n"), F.col("bad")
    parts = [
        _verdicts(
            of_cleaned,
            ("no_null_companies", bad == 0, "ERROR", bad, n, percent_text(share(bad, n), 2)),
            ("reasonable_job_count", n >= MIN_JOBS, "WARN", n, F.lit(MIN_JOBS), F.lit(None)),
        ),
        deduplication_effective(cleaned),
        targets_configured(config),
        _verdicts(
            of_leads,
            ("minimum_leads", n >= MIN_LEADS, "WARN", n, F.lit(MIN_LEADS), F.lit(None)),
            ("scores_valid", bad == 0, "ERROR", bad, F.lit(0), _invalid_note(leads)),
        ),
    ]
    return reduce(DataFrame.unionByName, parts)


def constraint_report(df: DataFrame, name: str) -> DataFrame:
    """Violations of the declared NOT NULL columns and of the primary key of a table."""
    required = [f.name for f in SCHEMAS[name].fields if not f.nullable]
    key = KEYS[name]
    needed = list(dict.fromkeys([*required, *key]))
    nulls = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in needed])
    null_rows = nulls.unpivot([], needed, "columns", "violations").select(
        F.lit("not_null").alias("constraint"), "columns", "violations"
    )
    repeated = (
        df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1")
        .agg(F.count("*").alias("violations"))
        .select(
            F.lit("primary_key").alias("constraint"), F.lit(",".join(key)).alias("columns"),
            "violations",
        )
    )
    return null_rows.unionByName(repeated)
