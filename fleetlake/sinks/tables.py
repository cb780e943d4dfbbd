"""Writers of the layers and of the quarantine."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.session import COMPACT, shuffles_dropped
from fleetlake.settings import Paths
from fleetlake.sinks.bucketed import write_bucketed_layer, write_buckets
from fleetlake.sources.layers import delete_path, replace_partitions

BRONZE_PARTITIONS = ("dataset_id", "source_file")


def write_layer(df: DataFrame, path: str, partition_by: Sequence[str] = (), mode: str = "overwrite") -> str:
    """Write Parquet. With partition columns only the partitions at hand are replaced."""
    writer = df.write.mode(mode).options(**COMPACT)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
        if mode == "overwrite":
            writer = writer.option("partitionOverwriteMode", "dynamic")
    with shuffles_dropped(df.sparkSession):
        writer.parquet(path)
    return path


def write_bronze(readings: DataFrame, paths: Paths) -> str:
    """One partition per data set and source, so a repeated ingest replaces instead of adding."""
    return write_layer(readings.drop("split"), f"{paths.bronze_dir}/sensor_readings", BRONZE_PARTITIONS)


def write_bronze_rul(rul: DataFrame, paths: Paths) -> str:
    return write_layer(rul, f"{paths.bronze_dir}/rul", BRONZE_PARTITIONS)


def write_silver(silver: DataFrame, paths: Paths) -> str:
    return write_layer(silver, f"{paths.silver_dir}/sensor_readings", ["dataset_id"])


def write_features(features: DataFrame, paths: Paths, buckets: int | None = None) -> str:
    """By data set, and within one in buckets of units where ``buckets`` says how many."""
    path = f"{paths.gold_dir}/ml_features"
    return write_bucketed_layer(features, path, buckets) if buckets else write_layer(features, path, ["dataset_id"])


def write_gold(tables: Mapping[str, DataFrame], paths: Paths) -> dict[str, str]:
    """Write gold tables and hand back their paths."""
    return {name: write_layer(df, f"{paths.gold_dir}/analytics/{name}") for name, df in tables.items()}


def quarantine(
    df: DataFrame, paths: Paths, name: str, found: bool | None = None, dataset_ids: Sequence[str] | None = None
) -> str | None:
    """Write quarantined rows, only if there are any; other data sets keep theirs.

    ``dataset_ids`` are the data sets that were looked at: what an earlier run
    left of them is cleared, also where this one finds nothing. A caller that
    has the check's result at hand passes ``found`` and saves the look at the
    data.
    """
    path = f"{paths.quarantine_dir}/{name}"
    if found is None:
        found = not df.isEmpty()
    for dataset_id in dataset_ids or ():
        delete_path(df.sparkSession, f"{path}/dataset_id={dataset_id}")
    return write_layer(df, path, [c for c in ("dataset_id",) if c in df.columns]) if found else None


def quarantine_duplicates(copies: DataFrame, paths: Paths, found: bool | None = None, dataset_ids=None) -> str | None:
    return quarantine(copies, paths, "duplicates", found, dataset_ids)


def quarantine_range_violations(violations: DataFrame, paths: Paths, found: bool | None = None, dataset_ids=None) -> str | None:
    return quarantine(violations, paths, "sensor_range_violations", found, dataset_ids)


def write_outcomes(rows: DataFrame, paths: Paths, dataset_ids: Sequence[str], buckets: int | None = None) -> str:
    """Silver and the quarantine of duplicates from one write of rows with their ``outcome``.

    The write goes to a hidden folder beside silver, by outcome and data set.
    Then its folders take the place of those they replace, the quarantine's
    first, so that no row is in silver before its copies are in quarantine. What
    an earlier run quarantined of ``dataset_ids`` is cleared. After a failure in
    between the step can simply be repeated. With ``buckets`` both are stored in
    buckets of units.
    """
    spark = rows.sparkSession
    staged = f"{paths.silver_dir}/_outcomes-{uuid.uuid4().hex}"
    if buckets:
        write_buckets(rows, staged, buckets, ("outcome", "dataset_id"))
    else:
        with shuffles_dropped(spark):
            rows.write.options(**COMPACT).partitionBy("outcome", "dataset_id").parquet(staged)
    quarantined = replace_partitions(spark, f"{staged}/outcome=quarantined", f"{paths.quarantine_dir}/duplicates")
    for folder in {f"dataset_id={d}" for d in dataset_ids} - set(quarantined):
        delete_path(spark, f"{paths.quarantine_dir}/duplicates/{folder}")
    silver = f"{paths.silver_dir}/sensor_readings"
    replace_partitions(spark, f"{staged}/outcome=clean", silver)
    delete_path(spark, staged)
    return silver


def file_row_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("source_file").agg(F.count(F.lit(1)).alias("row_count"))
