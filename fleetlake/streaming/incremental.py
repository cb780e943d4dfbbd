"""Incremental ingest: pick up new source files once, across runs."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from fleetlake.operators.ledger import Ledger
from fleetlake.plans.lakehouse import land_sources
from fleetlake.settings import READING_COLUMNS, Paths

#: A source's path, a file's own or that of the folder its parts are in.
SOURCE = r"^(.*/((?:train|test|RUL)_FD\d{3}\.txt))(?:/[^/]*)?$"
BINARY_FILE = "path string, modificationTime timestamp, length bigint, content binary"


def stream_sources(spark: SparkSession, source_dir: str, pattern: str = "*") -> DataFrame:
    """Names and paths of sources with a file not seen before; files of other names are passed over.

    Only paths are read here. A source that is a folder of parts is named by
    each of its new parts.
    """
    reader = (
        spark.readStream.format("binaryFile")
        .schema(BINARY_FILE)
        .option("pathGlobFilter", pattern)
        .option("recursiveFileLookup", "true")
    )
    name, path = (F.regexp_extract("path", SOURCE, i) for i in (2, 1))
    return reader.load(source_dir).select(name.alias("source_file"), path.alias("source_path")).filter("source_file <> ''")


def incremental_ingest(
    spark: SparkSession,
    source_dir: str,
    paths: Paths,
    ledger: Ledger,
    checkpoint: str,
    run_id: str = "",
    pattern: str = "*",
    columns: Sequence[str] = READING_COLUMNS,
) -> StreamingQuery:
    """Ingest everything that is new, then stop.

    A batch says which sources were touched; each of them lands whole, the way
    the batch ingest lands it and with the same manifest. So a source to which
    parts are added keeps its earlier rows, a repeated batch changes nothing,
    and a later batch ingest finds all of it done. The checkpoint remembers
    paths: a file changed under its old name is left to the batch ingest, whose
    manifest compares contents.
    """

    def land(batch: DataFrame, _: int) -> None:
        touched = batch.groupBy("source_file").agg(F.min("source_path").alias("path")).orderBy("source_file")
        sources = {r.source_file: r.path for r in touched.collect()}  # a row per source
        land_sources(spark, sources, paths, ledger, run_id, columns)

    query = (
        stream_sources(spark, source_dir, pattern)
        .writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
