"""The SQL marts: one temp view per model, some of them stored, built on the skew-safe operators."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.functions.columns import equipment_key
from fleetlake.functions.windows import next_value, rate_of_change, rolling
from fleetlake.operators.health import dim_equipment
from fleetlake.operators.ranks import global_rank
from fleetlake.operators.series import over_series
from fleetlake.operators.skew import profile_groups, split_hot
from fleetlake.session import cut_lineage
from fleetlake.settings import (
    READING_COLUMNS,
    SETTING_COLUMNS,
    SENSOR_COLUMNS,
    UNIQUE_SERIES,
    Paths,
    Series,
    SkewLimits,
)
from fleetlake.sinks.tables import write_layer

# --- Fixed values: which sensors the marts follow, and how ---
ROLLING = {
    "sensor_02": (("mean", 10), ("std", 10), ("min", 20), ("max", 20)),
    "sensor_03": (("mean", 10), ("std", 10)),
    "sensor_04": (("mean", 10),),
    "sensor_07": (("mean", 10),),
    "sensor_11": (("mean", 10),),
    "sensor_12": (("mean", 10),),
}
CHANGING = ("sensor_02", "sensor_03", "sensor_04", "sensor_07", "sensor_11", "sensor_12")
TRENDING = ("sensor_02", "sensor_04")
TREND_WINDOW = 10
# --- end of fixed values ---

STAGED = (
    *READING_COLUMNS,
    "dataset_id",
    "record_quality_status",
    "has_cycle_gap",
    "has_sensor_range_violation",
    "has_sensor_spike",
    "ingested_at",
    "silver_processed_at",
)


def stage_readings(silver: DataFrame) -> DataFrame:
    """Silver readings that are not quarantined; rows without a status go, too."""
    return silver.filter(F.col("record_quality_status") != "QUARANTINED").select(
        *(c for c in STAGED if c in silver.columns)
    )


def rolling_metrics(staged: DataFrame, series: Series = UNIQUE_SERIES, **options) -> DataFrame:
    """Rolling statistics that count partial windows from the first row on."""
    followed = {s: pairs for s, pairs in ROLLING.items() if s in staged.columns}
    slim = staged.select("unit_id", "cycle", "dataset_id", *followed)

    def stage(w):
        return {
            f"{s}_rolling_{stat}_{n}": rolling(s, stat, n, w, full=False) for s, pairs in followed.items() for stat, n in pairs
        }

    return over_series(slim, stage, series=series, before=20, **options).drop(*followed)


def equipment_degradation(staged: DataFrame, series: Series = UNIQUE_SERIES, **options) -> DataFrame:
    """Rates of change, their rolling trend, the next value, and the share of life used."""
    followed = [s for s in CHANGING if s in staged.columns]
    trending = [s for s in TRENDING if s in followed]
    slim = staged.select("unit_id", "cycle", "dataset_id", *followed)

    def changes(w):
        found = {f"{s}_rate_of_change": rate_of_change(s, w) for s in followed}
        return {**found, "sensor_02_next_value": next_value("sensor_02", w)} if "sensor_02" in followed else found

    def trends(w):
        return {
            f"{s}_degradation_trend": rolling(f"{s}_rate_of_change", "mean", TREND_WINDOW, w, full=False)
            for s in trending
        }

    found = over_series(
        slim,
        changes,
        trends,
        series=series,
        before=TREND_WINDOW + 1,
        after=1,
        totals={"__last": F.max("cycle")},
        **options,
    )
    ratio = F.try_divide(F.col("cycle").cast("double"), F.col("__last").cast("double"))
    return found.withColumn("lifecycle_ratio", ratio).drop("__last", *(s for s in followed if s != "sensor_02"))


def fact_sensor_readings(staged: DataFrame, dim: DataFrame, limits: SkewLimits = SkewLimits()) -> DataFrame:
    """Readings of known equipment with its key.

    The dimension is broadcast while it has few rows. Beyond that only hot
    units meet a broadcast (of their few dimension rows), the rest is joined
    by shuffle. It is stored first, since it may be made of the readings and
    both its size and its rows are asked for.
    """
    keys = ["unit_id", "dataset_id"]
    keyed = cut_lineage(dim.select(*keys, "equipment_key"))
    if keyed.limit(limits.broadcast_groups + 1).count() <= limits.broadcast_groups:
        joined = staged.join(F.broadcast(keyed), keys, "inner")
    elif not (profile := profile_groups(staged, keys, limits)).hot_groups:
        joined = staged.join(keyed, keys, "inner")
    else:
        rest, hot = split_hot(staged, profile, keys)
        hot_dim = keyed.join(F.broadcast(profile.hot_keys), keys, "left_semi")
        joined = rest.join(keyed, keys, "inner").unionByName(hot.join(F.broadcast(hot_dim), keys, "inner"))
    facts = (
        "equipment_key",
        *keys,
        "cycle",
        *SETTING_COLUMNS,
        *SENSOR_COLUMNS,
        "record_quality_status",
        "ingested_at",
        "silver_processed_at",
    )
    return joined.select(*(c for c in facts if c in joined.columns))


def ranked_health(health: DataFrame, partitions: int | None = None) -> DataFrame:
    """The health fact with a maintenance priority over all its rows."""
    order = [F.col("health_score").asc_nulls_last(), F.col("equipment_key"), F.col("cycle")]
    ranked = global_rank(
        health.withColumnRenamed("remaining_useful_life", "estimated_rul"),
        order,
        "maintenance_priority_rank",
        partitions,
    )
    return ranked.select(
        "equipment_key",
        "cycle",
        "health_score",
        "degradation_score",
        "estimated_rul",
        "risk_level",
        "maintenance_priority_rank",
        "calculated_at",
    )


def dataset_quality_counts(staged: DataFrame) -> DataFrame:
    """Per data set: rows by status, rows by flag, share of valid rows."""
    status = F.col("record_quality_status")
    counts = staged.groupBy("dataset_id").agg(
        F.count(F.lit(1)).alias("total_records"),
        F.count_if(status == "VALID").alias("valid_records"),
        F.count_if(status == "WARNING").alias("warning_records"),
        F.count_if(status == "QUARANTINED").alias("quarantined_records"),
        F.count_if("has_cycle_gap").alias("cycle_gap_count"),
        F.count_if("has_sensor_range_violation").alias("range_violation_count"),
        F.count_if("has_sensor_spike").alias("spike_count"),
    )
    total = F.nullif(F.col("total_records").cast("double"), F.lit(0.0))
    return counts.withColumn(
        "quality_pass_percentage", F.round(F.col("valid_records").cast("double") / total * 100.0, 2)
    )


def attach_fleet(counts: DataFrame, summary: DataFrame) -> DataFrame:
    """The same four fleet figures on every row, read from the summary once."""
    risk = F.col("risk_level")
    fleet = summary.agg(
        F.struct(
            F.count(F.lit(1)).alias("total_equipment_units"),
            F.avg("health_score").alias("avg_health_score"),
            F.count_if(risk.isin("HIGH", "CRITICAL")).alias("high_risk_equipment_count"),
            F.count_if(risk == "CRITICAL").alias("critical_equipment_count"),
        ).alias("fleet")
    )
    return counts.withColumn("__fleet", fleet.scalar()).select(*counts.columns, "__fleet.*")


def build_marts(
    silver: DataFrame, health: DataFrame, summary: DataFrame, limits: SkewLimits = SkewLimits()
) -> dict[str, DataFrame]:
    """All models by name, each registered as a temp view for SQL users."""
    staged = stage_readings(silver)
    dim = dim_equipment(staged, count_rows=True)
    marts = {
        "stg_sensor_readings": staged,
        "int_sensor_rolling_metrics": rolling_metrics(staged, limits=limits),
        "int_equipment_degradation": equipment_degradation(staged, limits=limits),
        "dim_equipment": dim,
        "fact_sensor_readings": fact_sensor_readings(staged, dim, limits),
        "fact_equipment_health": ranked_health(health),
        "dataset_quality_health_summary": attach_fleet(dataset_quality_counts(staged), summary),
    }
    for name, frame in marts.items():
        frame.createOrReplaceTempView(name)
    return marts


#: Models that are stored; the others are views.
STORED = ("dim_equipment", "fact_sensor_readings", "fact_equipment_health", "dataset_quality_health_summary")


def write_marts(marts: Mapping[str, DataFrame], paths: Paths) -> dict[str, str]:
    """Write the stored models below gold and hand back their paths."""
    return {name: write_layer(marts[name], f"{paths.gold_dir}/marts/{name}") for name in STORED}


def keyed(df: DataFrame) -> DataFrame:
    return df.withColumn("equipment_key", equipment_key(df.columns))
