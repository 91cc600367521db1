"""Table schemas and the checks made at table boundaries.

Timestamps carry no time zone, so they are TIMESTAMP_NTZ throughout.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T


TEXT, DATE, MOMENT, INT, REAL, FLAG = (
    T.StringType(), T.DateType(), T.TimestampNTZType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
)


# The columns of a batch as it arrives (dates and timestamps are ISO-8601 text)
# and of the five tables.
BATCH_COLUMNS = [
    "job_id", "company", "title", "description", "location", "posting_date", "url", "source", "scraped_at",
]
BATCH = T.StructType([T.StructField(name, TEXT) for name in BATCH_COLUMNS])
BATCH_REQUIRED = ["job_id", "company", "title", "source", "scraped_at"]

RAW_JOBS = T.StructType([
    T.StructField("job_id", TEXT, False),
    T.StructField("company", TEXT, False),
    T.StructField("title", TEXT, False),
    T.StructField("description", TEXT),
    T.StructField("location", TEXT),
    T.StructField("posting_date", DATE),
    T.StructField("url", TEXT),
    T.StructField("source", TEXT, False),
    T.StructField("first_scraped_at", MOMENT),
    T.StructField("last_scraped_at", MOMENT),
])
CLEANED_JOBS = T.StructType([
    T.StructField("job_id", TEXT, False),
    T.StructField("company", TEXT, False),
    T.StructField("company_normalized", TEXT),
    T.StructField("title", TEXT, False),
    T.StructField("title_normalized", TEXT),
    T.StructField("description", TEXT),
    T.StructField("location", TEXT),
    T.StructField("posting_date", DATE),
    T.StructField("url", TEXT),
    T.StructField("source", TEXT),
    T.StructField("first_seen", MOMENT),
    T.StructField("last_seen", MOMENT),
])
TECH_CONFIG = T.StructType([
    T.StructField("tech_name", TEXT, False),
    T.StructField("keywords", T.ArrayType(TEXT)),
    T.StructField("category", TEXT),
    T.StructField("is_target", FLAG),
    T.StructField("score_weight", REAL),
])
COMPANY_STATS = T.StructType([
    T.StructField("company_normalized", TEXT),
    T.StructField("company", TEXT),
    T.StructField("week_start", DATE),
    T.StructField("jobs_posted", INT),
    T.StructField("tech_stack", TEXT),
])
LEAD_SCORES = T.StructType([
    T.StructField("company_normalized", TEXT),
    T.StructField("company", TEXT),
    T.StructField("week_start", DATE),
    T.StructField("jobs_this_week", INT),
    T.StructField("jobs_last_week", INT),
    T.StructField("velocity_score", REAL),
    T.StructField("tech_match_score", REAL),
    T.StructField("volume_score", REAL),
    T.StructField("composite_score", REAL),
    T.StructField("score_metadata", TEXT),
])

KEYS = {
    "raw_jobs": ["job_id"],
    "cleaned_jobs": ["job_id"],
    "tech_config": ["tech_name"],
    "company_stats": ["company_normalized", "week_start"],
    "lead_scores": ["company_normalized", "week_start"],
}
SCHEMAS = {
    "raw_jobs": RAW_JOBS,
    "cleaned_jobs": CLEANED_JOBS,
    "tech_config": TECH_CONFIG,
    "company_stats": COMPANY_STATS,
    "lead_scores": LEAD_SCORES,
}


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Project to the schema's columns, order and types; refuse a missing column."""
    missing = [name for name in schema.names if name not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")
    return df.select([F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def require_columns(df: DataFrame, schema: T.StructType, columns: list[str] | None = None) -> DataFrame:
    """``df``, whose rows stop the run where a required column is NULL; checked as rows pass by."""
    required = columns or [f.name for f in schema.fields if not f.nullable]
    checked = {
        name: F.when(F.col(name).isNull(), F.raise_error(F.lit(f"{name} is NULL")).cast(df.schema[name].dataType))
        .otherwise(F.col(name))
        for name in required
    }
    return df.withColumns(checked)
