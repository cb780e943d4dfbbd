"""Health scores, risk, and the gold tables built from them."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.functions.columns import (
    clip,
    degradation_score,
    equipment_key,
    risk_level,
    total_of,
)
from fleetlake.operators.partials import moment_stats
from fleetlake.operators.skew import GroupProfile, join_on, with_group_totals
from fleetlake.settings import EQUIPMENT_TYPE, SENSOR_COLUMNS, HealthWeights, Series, SkewLimits

# --- Fixed values: the scale of each penalty before its weight is applied ---
MAX_DEVIATION = 50.0
SPIKE_PENALTY = 10.0
DEGRADATION_PENALTY = 30.0
QUALITY_PENALTY = 15.0
# --- end of fixed values ---


def _stamp(now: datetime | None) -> Column:
    return F.lit(now).cast("timestamp") if now else F.current_timestamp()


def sensor_stats(df: DataFrame, sensors: Sequence[str] = SENSOR_COLUMNS, by: Sequence[str] = ()) -> DataFrame:
    """Mean and sample deviation of every sensor present, in one pass."""
    moments = _moments([s for s in sensors if s in df.columns])
    return df.groupBy(*by).agg(*(moment.alias(name) for name, moment in moments.items()))


def with_sensor_stats(
    df: DataFrame,
    sensors: Sequence[str],
    by: Sequence[str] = (),
    limits: SkewLimits = SkewLimits(),
    source: DataFrame | None = None,
    moments: DataFrame | None = None,
) -> DataFrame:
    """Every row with a ``__stats`` struct: the global (or per-``by``) moments of
    each sensor, and how many sensors vary at all.

    The global row is a scalar subquery, computed once and shipped as a value,
    from ``source`` where ``df`` is the same rows behind a join, or merged from
    stored ``moments`` without reading rows at all.
    """
    stored = moments
    moments = _moments([s for s in sensors if s in df.columns])
    varying = total_of(F.coalesce(F.col(c) > 0, F.lit(False)).cast("int") for c in moments if c.endswith("_std"))
    packed = F.struct(*moments, varying.alias("__varying"))
    if by:
        return with_group_totals(df, moments, by, limits).withColumn("__stats", packed).drop(*moments)
    if stored is not None:
        one = moment_stats(stored, [s for s in sensors if s in df.columns])
    else:
        one = (source if source is not None else df).agg(*(moment.alias(name) for name, moment in moments.items()))
    return df.withColumn("__stats", one.select(packed).scalar())


def _moments(sensors: Sequence[str]) -> dict[str, Column]:
    return {f"{s}_{n}": f(s) for s in sensors for n, f in (("mean", F.avg), ("std", F.stddev_samp))}


def health_score(
    df: DataFrame,
    weights: HealthWeights = HealthWeights(),
    series: Series = Series(),
    stats_by: Sequence[str] = (),
    sensors: Sequence[str] = SENSOR_COLUMNS,
    limits: SkewLimits = SkewLimits(),
    profile: GroupProfile | None = None,
) -> DataFrame:
    """Add ``health_score`` in 0..100: 100 minus four weighted penalties.

    Sensors that never vary do not count; with none left the score is 100.
    A ``profile`` of the units at hand, or of a table these rows are part of,
    saves the look at their sizes.
    """
    return _scored(df, weights, series.on(df), stats_by, sensors, limits, profile=profile).drop("__last")


def _scored(df, weights, series, stats_by, sensors, limits, moments=None, profile=None) -> DataFrame:
    """``health_score`` and the last cycle of the unit as ``__last``."""
    dated = with_group_totals(df, {"__last": F.max(series.clock)}, series.keys, limits, profile)
    present = [s for s in sensors if s in df.columns]
    if not present:
        return dated.withColumn("health_score", F.lit(100.0))
    prepared = with_sensor_stats(dated, present, stats_by, limits, df, moments)

    def deviation(sensor: str) -> Column:
        mean, std = F.col(f"__stats.{sensor}_mean"), F.col(f"__stats.{sensor}_std")
        return F.when(std > 0, F.abs((F.col(sensor) - mean) / std)).otherwise(0.0)

    # Added up over an array: as one sum the code of all sensors is too long a method for the JVM to compile.
    total = F.aggregate(F.array(*(deviation(s) for s in present)), F.lit(0.0), lambda found, x: found + x)
    # each step names its result, so that none is computed once per use
    measured = prepared.withColumns({"__deviation": total, "__counted": F.col("__stats.__varying")}).drop("__stats")
    averaged = measured.withColumn("__average", F.try_divide(F.col("__deviation"), F.col("__counted")))
    life_used = F.try_divide(F.col(series.clock), F.col("__last"))
    penalties = [
        clip(F.col("__average"), 0, MAX_DEVIATION) * weights.sensor_deviation_weight,
        _flag_penalty(df, "has_sensor_spike", SPIKE_PENALTY * weights.spike_penalty_weight),
        life_used * DEGRADATION_PENALTY * weights.degradation_penalty_weight,
        _flag_penalty(df, "has_sensor_range_violation", QUALITY_PENALTY * weights.quality_penalty_weight),
    ]
    raw = F.lit(100.0)
    for penalty in penalties:
        raw = raw - penalty
    score = F.when(F.col("__counted") == 0, 100.0).otherwise(clip(F.col("__raw"), 0, 100))
    return (
        averaged.withColumn("__raw", raw)
        .withColumn("health_score", score)
        .drop("__deviation", "__counted", "__average", "__raw")
    )


def _flag_penalty(df: DataFrame, flag: str, amount: float) -> Column:
    """NULL for a NULL flag, nothing where the table has no such flag."""
    return F.col(flag).cast("int") * F.lit(amount) if flag in df.columns else F.lit(0.0)


def equipment_health(
    silver: DataFrame,
    weights: HealthWeights = HealthWeights(),
    series: Series = Series(),
    now: datetime | None = None,
    stats_by: Sequence[str] = (),
    limits: SkewLimits = SkewLimits(),
    moments: DataFrame | None = None,
    profile: GroupProfile | None = None,
) -> DataFrame:
    """The health fact: score, degradation, remaining life and risk per (unit, cycle).

    With ``moments`` (see :mod:`fleetlake.operators.partials`) the global
    statistics come from what is stored instead of another read of silver.
    ``profile`` is as in :func:`health_score`.
    """
    series = series.on(silver)
    scored = _scored(silver, weights, series, stats_by, SENSOR_COLUMNS, limits, moments, profile)
    score = F.col("health_score")
    return scored.select(
        equipment_key(silver.columns).alias("equipment_key"),
        "unit_id",
        "cycle",
        score,
        degradation_score(score).alias("degradation_score"),
        (F.col("__last") - F.col(series.clock)).alias("remaining_useful_life"),
        risk_level(score, weights.risk_thresholds).alias("risk_level"),
        _stamp(now).alias("calculated_at"),
    )


def violation_counts(silver: DataFrame) -> DataFrame:
    """Rows with a range violation per unit."""
    return silver.groupBy(equipment_key(silver.columns).alias("equipment_key")).agg(
        F.coalesce(F.sum(F.col("has_sensor_range_violation").cast("int")), F.lit(0)).alias("sensors_in_warning_state")
    )


def equipment_summary(health: DataFrame, silver: DataFrame, now: datetime | None = None) -> DataFrame:
    """One row per unit: its newest score, and how many of its rows violate a range."""
    latest = health.groupBy("equipment_key", "unit_id").agg(
        F.max("cycle").alias("latest_cycle"),
        F.max_by(F.struct("health_score", "remaining_useful_life", "risk_level"), "cycle").alias("__last"),
    )
    summary = latest.select(
        "equipment_key",
        "unit_id",
        "latest_cycle",
        F.col("__last.health_score").alias("health_score"),
        F.col("__last.remaining_useful_life").alias("estimated_rul"),
        F.col("__last.risk_level").alias("risk_level"),
    )
    if "has_sensor_range_violation" in silver.columns:
        summary = join_on(summary, violation_counts(silver), ["equipment_key"]).withColumn(
            "sensors_in_warning_state", F.coalesce("sensors_in_warning_state", F.lit(0))
        )
    else:
        summary = summary.withColumn("sensors_in_warning_state", F.lit(0).cast("bigint"))
    return summary.withColumn("last_updated_at", _stamp(now))


def dim_equipment(silver: DataFrame, equipment_type: str = EQUIPMENT_TYPE, count_rows: bool = False) -> DataFrame:
    """One row per unit and data set, with its first and last cycle.

    Its cycles are counted, or with ``count_rows`` its rows, those without a cycle included.
    """
    keys = [k for k in ("unit_id", "dataset_id") if k in silver.columns]
    return (
        silver.groupBy(*keys)
        .agg(
            F.min("cycle").alias("first_observed_cycle"),
            F.max("cycle").alias("last_observed_cycle"),
            F.count(F.lit(1) if count_rows else F.col("cycle")).alias("total_operational_cycles"),
        )
        .withColumn("equipment_key", equipment_key(keys))
        .withColumn("equipment_type", F.lit(equipment_type))
    )


def all_health_tables(
    silver: DataFrame,
    weights: HealthWeights = HealthWeights(),
    series: Series = Series(),
    now: datetime | None = None,
    limits: SkewLimits = SkewLimits(),
) -> dict[str, DataFrame]:
    health = equipment_health(silver, weights, series, now, limits=limits)
    return {
        "dim_equipment": dim_equipment(silver),
        "fact_equipment_health": health,
        "equipment_health_summary": equipment_summary(health, silver, now),
    }
