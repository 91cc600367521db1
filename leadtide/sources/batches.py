"""Posting batches as they arrive: text fields in, typed rows out."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from leadtide.schemas import BATCH, BATCH_REQUIRED


def read_batch(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines; absent fields are NULL, unknown fields are ignored."""
    return spark.read.schema(BATCH).json(path)


def is_complete() -> Column:
    """All required fields are present and the scrape time can be read."""
    present = [F.col(name).isNotNull() for name in BATCH_REQUIRED]
    return reduce(
        lambda a, b: a & b, present, F.col("scraped_at").try_cast("timestamp_ntz").isNotNull()
    )


def typed(batch: DataFrame) -> DataFrame:
    """Complete records with dates and timestamps read; an unreadable date is NULL."""
    return batch.where(is_complete()).withColumns(
        {
            "posting_date": F.col("posting_date").try_cast("date"),
            "scraped_at": F.col("scraped_at").try_cast("timestamp_ntz"),
        }
    )


def rejected(batch: DataFrame) -> DataFrame:
    return batch.where(~is_complete())


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines of a batch as text, in ``line``; blank lines hold no record and are left out."""
    lines = spark.read.text(path).select(F.col("value").alias("line"))
    return lines.where(F.trim("line") != "")


def _records(lines: DataFrame) -> DataFrame:
    schema = StructType([*BATCH.fields, StructField("_bad", StringType())])
    parsed = F.from_json("line", schema, {"columnNameOfCorruptRecord": "_bad"})
    return lines.withColumn("_record", parsed).select("line", "_record.*")


def accepted(lines: DataFrame) -> DataFrame:
    """The typed records of the lines that hold one."""
    records = _records(lines)
    return typed(records.where(F.col("_bad").isNull()).drop("_bad", "line"))


def refused(lines: DataFrame) -> DataFrame:
    """(line, reason) of all other lines: with ``accepted`` each line is told once."""
    records = _records(lines)
    missing = F.concat_ws(", ", *[F.when(F.col(c).isNull(), F.lit(c)) for c in BATCH_REQUIRED])
    reason = (
        F.when(F.col("_bad").isNotNull(), "not a JSON record")
        .when(missing != "", F.concat(F.lit("missing: "), missing))
        .otherwise("scraped_at cannot be read")
    )
    return records.where(F.col("_bad").isNotNull() | ~is_complete()).select("line", reason.alias("reason"))
