"""Stored tables: typed scans, projecting feeds, stage boundaries, file sinks."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from leadtide.schemas import KEYS, SCHEMAS, conform, require_columns


def read_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Typed scan of one of the five tables; the declared schema is used, none inferred."""
    return spark.read.schema(SCHEMAS[name]).parquet(path)


def refresh_table(df: DataFrame, path: str, name: str, *, by_week: bool = False) -> None:
    """Replace a table.  ``path`` must not be one that ``df`` reads.

    A NULL in a required column stops the run; ``require_unique`` looks for repeated keys.

    ``by_week`` partitions the files by week.  The rebalance hint lets adaptive execution
    cut a large week into several files and put small ones together.
    """
    out = require_columns(conform(df, SCHEMAS[name]), SCHEMAS[name])
    if by_week:
        out.hint("rebalance", "week_start").write.mode("overwrite").partitionBy(
            "week_start"
        ).parquet(path)
    else:
        out.write.mode("overwrite").parquet(path)


def require_unique(df: DataFrame, name: str) -> None:
    """Stop the run if a key of the table has two rows; only keys are read, and one is reported."""
    key = KEYS[name]
    repeated = df.groupBy(*key).agg(F.count("*").alias("n")).where("n > 1").first()
    if repeated is not None:
        raise ValueError(f"{name} has {repeated['n']} rows of one key: {repeated.asDict()}")


def save_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Keep a table bucketed and sorted by its key, so keyed joins need not shuffle it.

    Take at least as many buckets as there are shuffle partitions, or Spark will prefer
    to shuffle it.
    """
    df.write.mode("overwrite").bucketBy(buckets, key).sortBy(key).format("parquet").saveAsTable(
        table
    )


_local_folder: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors can reach: ``spark.checkpoint.dir``.

    Only a single-machine session without that setting gets a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_folder:
        _local_folder[app] = tempfile.mkdtemp(prefix="leadtide-")
    return _local_folder[app]


def new_path(spark: SparkSession, name: str) -> str:
    return os.path.join(shared_folder(spark), "leadtide", uuid.uuid4().hex, name)


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    A stage boundary: what follows may read the rows several times without computing them
    again, also after losing executors.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def make_folder(spark: SparkSession, path: str) -> None:
    """Make an empty folder; any file system Spark knows."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(where)


def folder_size(spark: SparkSession, path: str) -> int:
    """The bytes of a file or folder; any file system Spark knows."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(where).getLength()


def discard(spark: SparkSession, path: str) -> None:
    """Delete what ``new_path`` gave, when a run is done with it; any file system Spark knows."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def move(spark: SparkSession, path: str, to: str) -> None:
    """Rename a file or folder, in place of what has the name."""
    source, target = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (path, to))
    files = source.getFileSystem(spark._jsc.hadoopConfiguration())
    files.delete(target, True)
    if not files.rename(source, target):
        raise OSError(f"{path} could not be moved to {to}")


def lead_rows(leads: DataFrame) -> DataFrame:
    return leads.select(
        "company", "composite_score", "velocity_score", "tech_match_score", "volume_score",
        "jobs_this_week", "jobs_last_week", F.col("score_metadata").alias("tech_stack"),
        "week_start",
    )


def lead_feed(leads: DataFrame) -> DataFrame:
    return lead_rows(leads).orderBy(F.desc("composite_score"), "company")


def trend_rows(stats: DataFrame) -> DataFrame:
    return stats.select("company_normalized", "company", "week_start", "jobs_posted", "tech_stack")


def trend_feed(stats: DataFrame) -> DataFrame:
    return trend_rows(stats).orderBy("company_normalized", "week_start")


# Values are kept as they are: no trimming, an empty field is an empty string, quotes are doubled.
CSV = {
    "header": True,
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def _one_file(df: DataFrame, path: str, kind: str, options: dict, head: bytes) -> None:
    """Write ``df``, in its order, as the one file ``path``: tasks write the parts, which are then joined.

    A file system that can join files does it itself; others copy the parts' bytes in order, in a small
    buffer.  The file gets its name only when it is whole; readers never see a part of it.
    """
    spark = df.sparkSession
    hadoop, conf = spark._jvm.org.apache.hadoop, spark._jsc.hadoopConfiguration()
    parts = f"{path}.parts-{uuid.uuid4().hex}"
    getattr(df.write.options(**options), kind)(parts)
    whole = hadoop.fs.Path(f"{parts}/whole")
    files = whole.getFileSystem(conf)
    found = sorted(
        (f.getPath() for f in files.listStatus(hadoop.fs.Path(parts)) if f.getPath().getName().startswith("part-")),
        key=lambda p: p.getName(),
    )
    out = files.create(whole, True)
    try:
        out.write(bytearray(head))
        joins = bool(head) and files.getScheme() == "hdfs"
        for part in [] if joins else found:
            source = files.open(part)
            try:
                hadoop.io.IOUtils.copyBytes(source, out, 1 << 16, False)
            finally:
                source.close()
    finally:
        out.close()
    if joins and found:
        array = spark.sparkContext._gateway.new_array(hadoop.fs.Path, len(found))
        for k, part in enumerate(found):
            array[k] = part
        files.concat(whole, array)
    move(spark, f"{parts}/whole", path)
    discard(spark, parts)


def write_csv(df: DataFrame, path: str) -> None:
    """One CSV file of the rows in their order, with one header."""
    head = ",".join(df.columns) + "\n"
    _one_file(df, path, "csv", {**CSV, "header": False}, head.encode())


def read_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).options(**CSV, nullValue="\\N").csv(path)


def write_json(df: DataFrame, path: str) -> None:
    """One file of JSON lines."""
    _one_file(df, path, "json", {}, b"")
