"""The technology config: default rows and edits."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from leadtide.operators.upsert import insert_or_ignore
from leadtide.schemas import TECH_CONFIG

# Name, keywords, category, target flag, weight.  Trailing blanks count.
DEFAULT_TECHS = [
    ("Python", ["python", "django", "flask", "fastapi"], "language", True, 1.0),
    ("Java", ["java", "spring", "springboot"], "language", False, 0.5),
    ("JavaScript", ["javascript", "js ", "node.js", "nodejs"], "language", False, 0.5),
    ("TypeScript", ["typescript", "ts "], "language", True, 0.8),
    ("React", ["react", "reactjs", "react.js"], "framework", True, 1.0),
    ("Vue", ["vue", "vuejs", "vue.js"], "framework", False, 0.5),
    ("Angular", ["angular", "angularjs"], "framework", False, 0.3),
    ("AWS", ["aws", "amazon web services", "ec2", "s3", "lambda"], "cloud", False, 0.7),
    ("Azure", ["azure", "microsoft azure"], "cloud", False, 0.5),
    ("GCP", ["gcp", "google cloud", "bigquery"], "cloud", False, 0.7),
    ("Kubernetes", ["kubernetes", "k8s"], "devops", False, 0.8),
    ("Docker", ["docker", "containerization"], "devops", False, 0.6),
    ("Go", ["golang", "go "], "language", False, 0.6),
    ("Rust", ["rust"], "language", False, 0.7),
    ("PostgreSQL", ["postgresql", "postgres", "psql"], "database", False, 0.5),
    ("MongoDB", ["mongodb", "mongo"], "database", False, 0.4),
]


def tech_config(spark: SparkSession, rows=None) -> DataFrame:
    """Config rows as a local relation: reading it starts no job, and its size is known."""
    rows = DEFAULT_TECHS if rows is None else rows
    columns = list(zip(*rows)) or [[]] * len(TECH_CONFIG)
    arrays = [
        pa.array(list(values), to_arrow_type(field.dataType))
        for values, field in zip(columns, TECH_CONFIG)
    ]
    return spark.createDataFrame(pa.table(arrays, names=TECH_CONFIG.names), TECH_CONFIG)


def with_defaults(config: DataFrame) -> DataFrame:
    """Declared defaults: not a target, weight 1."""
    return config.withColumns(
        {
            "is_target": F.coalesce("is_target", F.lit(False)),
            "score_weight": F.coalesce("score_weight", F.lit(1.0)),
        }
    )


def set_target(config: DataFrame, tech_name: str, flag: bool = True) -> DataFrame:
    return config.withColumn(
        "is_target",
        F.when(F.col("tech_name") == tech_name, F.lit(flag)).otherwise(F.col("is_target")),
    )


def add_techs(config: DataFrame, rows: DataFrame) -> DataFrame:
    """Insert rows whose name is new, of each name the first in a total order; names already
    present stay as they are."""
    return config.unionByName(with_defaults(
        insert_or_ignore(config.limit(0), rows.select(config.columns), ["tech_name"], ["category", "score_weight"])
        .join(config, "tech_name", "left_anti").select(config.columns)
    ))


def tech_names(config: DataFrame) -> DataFrame:
    return config.select("tech_name").orderBy("tech_name")


def target_list(config: DataFrame) -> DataFrame:
    return config.where("is_target").select("tech_name", "score_weight").orderBy("tech_name")
