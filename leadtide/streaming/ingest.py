"""The keyed upsert, run for every batch of files that arrives in a folder."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from leadtide.sources.batches import accepted, refused
from leadtide.sources.ledger import take_in


def arriving(spark: SparkSession, folder: str, files_per_batch: int | None = None) -> DataFrame:
    """The lines of JSON-lines files of ``folder`` as a stream."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(folder).select(F.col("value").alias("line")).where(F.trim("line") != "")


def upsert_arriving(
    stream: DataFrame, ledger: str, refusals: str, checkpoint: str, first: int = 1
) -> StreamingQuery:
    """Take in what has arrived, then stop.  Batch n is batch ``first`` + n of the ledger.

    A ledger that exists already (see ``seed``; batch 0) is gone on from.  Lines that hold no
    record go to ``refusals``, with the reason.  A batch that is repeated after a failure
    leaves the same result.  With a new checkpoint pass a ``first`` beyond the ledger's batches.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch = batch.persist()
        try:
            refused(batch).write.mode("overwrite").parquet(f"{refusals}/batch={first + number}")
            take_in(accepted(batch), ledger, first + number)
        finally:
            batch.unpersist()

    return (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
