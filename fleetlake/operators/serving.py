"""Queries that serve gold tables to people."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.operators.ranks import global_rank


def fleet_metrics(summary: DataFrame, digits: int = 1) -> DataFrame:
    """One row: units, mean score, high-or-critical units, critical units; zeros when empty."""
    risk = F.col("risk_level")
    return summary.agg(
        F.count(F.lit(1)).alias("total_units"),
        F.round(F.coalesce(F.avg("health_score"), F.lit(0.0)), digits).alias("avg_health_score"),
        F.count_if(risk.isin("HIGH", "CRITICAL")).alias("high_risk_count"),
        F.count_if(risk == "CRITICAL").alias("critical_count"),
    )


def health_histogram(summary: DataFrame, bins: int = 20, low: float = 0.0, high: float = 100.0) -> DataFrame:
    """(bin, bin_start, units) over equal bins; the top edge belongs to the last one.

    Scores below ``low`` are in bin 0, those above ``high`` in bin ``bins`` + 1.
    """
    score = F.col("health_score")
    placed = F.width_bucket(score, F.lit(low), F.lit(high), F.lit(bins))
    bucket = F.when(score == high, F.lit(bins)).otherwise(placed)
    counted = summary.filter(F.col("health_score").isNotNull()).groupBy(bucket.cast("bigint").alias("bin"))
    width = (high - low) / bins
    return counted.agg(F.count(F.lit(1)).alias("units")).select(
        "bin", (F.lit(low) + (F.col("bin") - 1) * width).alias("bin_start"), "units"
    )


def round_steps(least: int = -9, most: int = 12) -> list[float]:
    """1, 2 and 5 times the powers of ten."""
    return [float(f"{m}e{e}") for e in range(least, most + 1) for m in (1, 2, 5)]


def auto_histogram(df: DataFrame, column: str = "health_score", bins: int = 20) -> DataFrame:
    """(bin_start, bin_end, units): at most ``bins`` bins whose width is the least round one, from the data's range.

    Edges are multiples of the width; a value on an edge belongs to the bin
    above it, empty bins are left out. Widths go from 1e-9 to 5e12; a single
    value has a bin of the least width. NULL, NaN and infinite values do not
    count; without others there are no rows.
    """
    value = F.col(column).cast("double")
    finite = df.filter(value.isNotNull() & ~F.isnan(value) & (F.abs(value) < float("inf"))).select(value.alias("x"))
    ends = finite.agg(F.min("x").alias("low"), F.max("x").alias("high"))
    widths = F.array(*(F.lit(s) for s in round_steps()))
    fitting = F.filter(widths, lambda w: F.floor(F.col("high") / w) - F.floor(F.col("low") / w) + 1 <= bins)
    width = ends.select(F.array_min(fitting)).scalar()
    placed = finite.withColumn("__width", width).withColumn("__n", F.floor(F.col("x") / F.col("__width")))
    counted = placed.groupBy("__n", "__width").agg(F.count(F.lit(1)).alias("units"))
    edge = F.col("__n").cast("double")
    return counted.select((edge * F.col("__width")).alias("bin_start"), ((edge + 1) * F.col("__width")).alias("bin_end"), "units")


PRIORITY_COLUMNS = (
    "priority_rank",
    "unit_id",
    "health_score",
    "estimated_rul",
    "risk_level",
    "sensors_in_warning_state",
)


def _least_healthy() -> list[Column]:
    return [F.col("health_score").asc_nulls_first(), F.col("unit_id"), F.col("equipment_key")]


def maintenance_priority(summary: DataFrame, partitions: int | None = None) -> DataFrame:
    """Every unit with its rank, least healthy first."""
    ranked = global_rank(summary, _least_healthy(), "priority_rank", partitions)
    return ranked.select(*(c for c in PRIORITY_COLUMNS if c in ranked.columns))


def maintenance_topk(summary: DataFrame, k: int = 10) -> DataFrame:
    return summary.orderBy(*_least_healthy()).limit(k)


def unit_readings(df: DataFrame, unit_id: int, dataset_id: str | None = None) -> DataFrame:
    """One unit's rows in order. Both filters reach the scan."""
    rows = df.filter(F.col("unit_id") == unit_id)
    if dataset_id is not None:
        rows = rows.filter(F.col("dataset_id") == dataset_id)
    return rows.orderBy("cycle")


def units_with_prefix(health: DataFrame, prefix: str) -> DataFrame:
    """Rows whose equipment key starts with a text: unit 1 finds 10 and 100 as well."""
    return health.filter(F.col("equipment_key").startswith(prefix)).orderBy("equipment_key", "cycle")


def with_status(results: DataFrame, status: str) -> DataFrame:
    return results.filter(F.col("status") == status)


def status_counts(results: DataFrame) -> DataFrame:
    return results.groupBy("status").agg(F.count(F.lit(1)).alias("checks"))


def raw_sensor_columns(columns: Sequence[str], limit: int | None = None) -> list[str]:
    """The sensor columns that are readings and not features; a view that shows few passes ``limit``."""
    raw = [c for c in columns if c.startswith("sensor_") and "_rolling" not in c and "_rate" not in c]
    return raw[:limit]


def select_sensors(df: DataFrame, limit: int | None = None) -> DataFrame:
    return df.select("unit_id", "cycle", *raw_sensor_columns(df.columns, limit))


def unit_grouped_stats(df: DataFrame, mean_of: str = "sensor_02", std_of: str = "sensor_03") -> DataFrame:
    """Mean of one sensor and deviation of another per unit, combined map-side."""
    return df.groupBy("unit_id").agg(
        F.avg(mean_of).alias(f"{mean_of}_mean"), F.stddev_samp(std_of).alias(f"{std_of}_std")
    )
