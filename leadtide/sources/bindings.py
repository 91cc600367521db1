"""Views that give the benchmark tables the shape of job postings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from leadtide.sources.config import tech_config
from leadtide.sources.tables import folder_size

# Technologies found in the benchmark tables: name, keywords, category, target, weight.
PART_TECHS = [
    ("Widget", ["widget", "gizmo"], "part", True, 1.0),
    ("Bolt", ["bolt"], "part", False, 0.5),
    ("Gear", ["gear"], "part", True, 0.8),
    ("Ring", ["ring"], "part", False, 0.3),
    ("GearBox", ["gearbox"], "part", False, 0.2),
    ("Promo", ["promo"], "type", True, 1.0),
]
DOCUMENT_TECHS = [
    ("Data", ["data"], "text", True, 1.0),
    ("Suffix", ["tion", "ing "], "text", True, 0.5),
    ("License", ["license"], "text", False, 0.7),
    ("Water", ["eau"], "text", False, 0.3),
]
PREFIXES = {1: "Senior ", 2: "Sr. ", 3: "Junior ", 4: "Principal ", 6: "Lead "}


# The columns read; a declared schema spares a job per table to infer it.
COLUMNS = {
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
    "l_returnflag string, l_shipdate timestamp_ntz",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int",
    "nation": "n_nationkey int, n_name string",
    "documents": "doc_id bigint, text string, lang string, source string",
}


#: Bytes of a file in one partition above which its rows are dealt out, and what a partition has then.
LARGE_PIECE, SMALL_PIECE = 32 << 20, 8 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.schema(COLUMNS[name]).parquet(f"{folder}/{name}.parquet")


def spread(df: DataFrame, *by: str) -> DataFrame:
    """Deal the rows out when the files give fewer partitions than there are cores.

    A file with one row group is one partition however large it is.  Dealing by a hash
    of ``by`` spares the sort of a round-robin deal.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *by) if df.rdd.getNumPartitions() < cores else df


def dealt(df: DataFrame, path: str, *by: str) -> DataFrame:
    """The same for narrow rows that are widened and sorted next, where a partition would be a large piece of
    the file at ``path``: so many tasks that none has to spill its rows."""
    size, parts = folder_size(df.sparkSession, path), df.rdd.getNumPartitions()
    if size <= LARGE_PIECE * parts:
        return spread(df, *by)
    return df.repartition(max(-(-size // SMALL_PIECE), df.sparkSession.sparkContext.defaultParallelism), *by)


def part_config(spark: SparkSession) -> DataFrame:
    return tech_config(spark, PART_TECHS)


def document_config(spark: SparkSession) -> DataFrame:
    return tech_config(spark, DOCUMENT_TECHS)


def postings(spark: SparkSession, folder: str) -> DataFrame:
    """Line items as scraped postings; ``line`` is kept to tell batches apart."""
    joined = (
        dealt(
            table(spark, folder, "lineitem"), f"{folder}/lineitem.parquet", "l_orderkey", "l_partkey", "l_linenumber"
        )
        .join(table(spark, folder, "part"), F.expr("l_partkey = p_partkey"))
        .join(table(spark, folder, "supplier"), F.expr("l_suppkey = s_suppkey"))
        .join(table(spark, folder, "nation"), F.expr("s_nationkey = n_nationkey"))
    )
    line = F.col("l_linenumber")
    prefix = F.lit("")
    for number, text in PREFIXES.items():
        prefix = F.when(line == number, F.lit(text)).otherwise(prefix)
    return joined.select(
        F.concat_ws("-", F.col("l_orderkey").cast("string"), line.cast("string")).alias("job_id"),
        F.when(line % 3 == 0, F.concat(F.lit("  "), F.upper("s_name"), F.lit(" ")))
        .otherwise(F.col("s_name"))
        .alias("company"),
        F.concat(prefix, "p_name").alias("title"),
        F.concat_ws(" ", "p_type", "p_brand").alias("description"),
        F.when(line == 5, F.lit(None)).otherwise(F.col("n_name")).alias("location"),
        F.col("l_shipdate").cast("date").alias("posting_date"),
        F.concat("s_name", F.lit("/u")).alias("url"),
        F.col("l_returnflag").alias("source"),
        F.col("l_shipdate").alias("first_scraped_at"),
        (F.col("l_shipdate") + F.expr("INTERVAL 3 DAYS")).alias("last_scraped_at"),
        line.alias("line"),
    )


def documents(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as postings with long descriptions."""
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("doc_id") % 56).cast("int"))
    return spread(table(spark, folder, "documents"), "doc_id").select(
        F.col("doc_id").cast("string").alias("job_id"),
        F.col("source").alias("company"),
        F.concat(F.lit("Document "), F.col("doc_id").cast("string")).alias("title"),
        F.col("text").alias("description"),
        F.col("lang").alias("location"),
        day.alias("posting_date"),
        F.lit(None).cast("string").alias("url"),
        F.col("source").alias("source"),
        day.cast("timestamp_ntz").alias("first_scraped_at"),
        day.cast("timestamp_ntz").alias("last_scraped_at"),
    )
