"""Write, audit, publish: tables of a run become visible together, and only if all are clean.

A table is written to a staging folder, with its figures observed as the rows pass by; its keys
are checked there.  When all tables of a run have passed, their folders get their names.
What an earlier run has published is not touched before that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from leadtide.schemas import SCHEMAS, conform, require_columns
from leadtide.sources.tables import discard, move, read_table, refresh_table, require_unique


class Publication:
    """The tables of one run, on their way to ``folder``."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder
        self.staging = f"{folder}/_staging"
        self.names: list[str] = []
        discard(spark, self.staging)  # what a failed run has left

    def path(self, name: str) -> str:
        return f"{self.staging}/{name}"

    def write(self, name: str, df: DataFrame, by_week: bool = False, figures: list[Column] | None = None) -> dict:
        """Stage one of the five tables and check it; returns ``rows`` and the figures (aggregates).

        A NULL in a required column or a second row of a key stops the run."""
        seen = Observation(name)
        rows = require_columns(conform(df, SCHEMAS[name]), SCHEMAS[name])
        rows = rows.observe(seen, F.count("*").alias("rows"), *(figures or []))
        refresh_table(rows, self.path(name), name, by_week=by_week)
        require_unique(self.read(name), name)
        self.names.append(name)
        return seen.get

    def add(self, name: str, df: DataFrame) -> None:
        """Stage a report, which has no key."""
        df.write.mode("overwrite").parquet(self.path(name))
        self.names.append(name)

    def read(self, name: str) -> DataFrame:
        return read_table(self.spark, self.path(name), name)

    def publish(self) -> dict[str, str]:
        """Give all that is staged its name; returns the paths."""
        at = {name: f"{self.folder}/{name}" for name in self.names}
        for name, path in at.items():
            move(self.spark, self.path(name), path)
        discard(self.spark, self.staging)
        return at
