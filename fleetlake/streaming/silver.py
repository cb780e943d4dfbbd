"""Silver kept up to date by a stream of readings."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from fleetlake.settings import Settings
from fleetlake.streaming.tails import GATHER_AFTER, refresh_silver


def grow_silver(
    spark: SparkSession,
    readings: str,
    path: str,
    settings: Settings = Settings(),
    now: datetime | None = None,
    max_files: int | None = None,
    gather_after: int = GATHER_AFTER,
) -> StreamingQuery:
    """Bring the silver below ``path`` up to date with all files of readings that are new, then stop.

    ``readings`` is a folder of Parquet files with the columns of bronze to which
    files are only added. A batch has at most ``max_files`` of them. The
    checkpoint lies beside silver, since its numbers are those of silver's
    batches. A batch that failed is repeated with the same files and number and
    replaces what it left. A folder read while further files arrive shows units
    built anew more rows than the batch has: they come again, as late ones, and
    their unit is built once more. An empty folder is an error of Spark's, for
    want of a schema; a run without new files changes nothing.
    """
    schema = spark.read.parquet(readings).schema

    def refresh(new: DataFrame, batch: int) -> None:
        known = new.sparkSession.read.schema(schema).parquet(readings)
        refresh_silver(new, known, path, batch, settings, now, gather_after=gather_after)

    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    query = (
        reader.parquet(readings)
        .writeStream.foreachBatch(refresh)
        .option("checkpointLocation", f"{path}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
