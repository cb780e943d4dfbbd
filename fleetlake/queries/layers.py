"""Queries for the silver, feature and health operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlake.functions.columns import (
    degradation_score,
    null_if_nan,
    quality_status,
    range_violation,
    risk_level,
    violated_sensor_count,
)
from fleetlake.operators import health as H
from fleetlake.operators.features import COUNTED_FLAGS, ml_features
from fleetlake.operators.silver import (
    enforce_types,
    flag_ranges,
    flag_spikes,
    quarantined_duplicates,
    sort_timeseries,
    split_duplicates,
    to_silver,
)
from fleetlake.queries import views as V
from fleetlake.queries.registry import query
from fleetlake.queries.views import r, rounded, with_ctes
from fleetlake.settings import (
    READING_COLUMNS,
    SENSOR_COLUMNS,
    SETTING_COLUMNS,
    UNIQUE_SERIES,
    HealthWeights,
    RiskThresholds,
    Settings,
    SkewLimits,
    default_features,
    default_ranges,
)

SETTINGS = Settings(ranges=V.RANGES, spikes=V.SPIKES)
FLAGS = ("has_cycle_gap", "has_sensor_range_violation", "has_sensor_spike", "record_quality_status")
NUMBERS = (*SETTING_COLUMNS, *SENSOR_COLUMNS)
READ_SQL = ", ".join(["unit_id", "cycle", *(r(c, c) for c in NUMBERS)])
SILVER = V.sql_silver("daily")
SILVER_CTES = (V.DAILY, SILVER)


def silver(spark, sf, settings=SETTINGS):
    return to_silver(V.daily(spark, sf), settings)


@query(
    "enforce_types",
    "SELECT CAST(l_suppkey AS BIGINT) AS unit_id, CAST(l_linenumber AS BIGINT) AS cycle, "
    "CAST(l_partkey AS DOUBLE) AS operational_setting_1, l_quantity AS sensor_01, "
    "CAST(l_orderkey AS DOUBLE) AS sensor_02 FROM lineitem",
)
def enforce_types_query(spark, sf):
    text = V.table(spark, sf, "lineitem").select(
        F.col("l_suppkey").cast("string").alias("unit_id"),
        F.col("l_linenumber").alias("cycle"),
        F.col("l_partkey").alias("operational_setting_1"),
        F.col("l_quantity").cast("string").alias("sensor_01"),
        F.col("l_orderkey").alias("sensor_02"),
    )
    return enforce_types(text)


@query("sort_timeseries", with_ctes(V.CLEAN) + "SELECT unit_id, cycle, source_row_number FROM clean ORDER BY ALL")
def sort_timeseries_query(spark, sf):
    return sort_timeseries(V.clean(spark, sf)).select("unit_id", "cycle", "source_row_number")


@query(
    "range_violation_flag",
    with_ctes(V.NULLS)
    + "SELECT dataset_id, unit_id, cycle, sensor_02 < 2.0 OR sensor_02 > 40.0 OR sensor_04 < 0.0 OR sensor_04 > 9.5 "
    "OR sensor_07 < 0.0 OR sensor_07 > 7.5 AS has_sensor_range_violation FROM nulls",
)
def range_violation_flag(spark, sf):
    from fleetlake.settings import SensorRange

    ranges = {"sensor_02": SensorRange(2, 40), "sensor_04": SensorRange(0, 9.5), "sensor_07": SensorRange(0, 7.5)}
    return flag_ranges(V.nulls(spark, sf), ranges).drop(*V.FOUR)


def _default_range_sql() -> str:
    outside = [V.sql_outside(s, b) for s, b in default_ranges().items()]
    count = " + ".join(f"CAST(coalesce({o}, false) AS INTEGER)" for o in outside)
    return (
        with_ctes(V.DAILY)
        + f"SELECT unit_id, cycle, source_row_number, {' OR '.join(outside)} AS has_sensor_range_violation, "
        f"CAST({count} AS INTEGER) AS violated_sensor_count FROM daily"
    )


@query("load_sensor_ranges", _default_range_sql())
def load_sensor_ranges_query(spark, sf):
    """The configured ranges applied to every reading."""
    df = V.daily(spark, sf)
    ranges = default_ranges()
    return df.select(
        "unit_id",
        "cycle",
        "source_row_number",
        range_violation(df.columns, ranges).alias("has_sensor_range_violation"),
        violated_sensor_count(df.columns, ranges).alias("violated_sensor_count"),
    )


@query(
    "quality_status",
    f"""SELECT event_id, {V.sql_status()} AS record_quality_status FROM (
  SELECT event_id, event_id % 3 = 0 AS has_cycle_gap,
    CASE WHEN value > 20 THEN value > 60 END AS has_sensor_range_violation,
    CASE WHEN user_id > 9 THEN user_id % 2 = 0 END AS has_sensor_spike FROM events)""",
)
def quality_status_query(spark, sf):
    value, user = F.col("value"), F.col("user_id")
    status = quality_status(
        F.col("event_id") % 3 == 0, F.when(value > 20, value > 60), F.when(user > 9, user % 2 == 0)
    )
    return V.table(spark, sf, "events").select("event_id", status.alias("record_quality_status"))


@query(
    "risk_level",
    """SELECT event_id, CASE WHEN score <= 25 THEN 'CRITICAL' WHEN score <= 50 THEN 'HIGH'
  WHEN score <= 75 THEN 'MEDIUM' ELSE 'LOW' END AS risk_level,
  round(100.0 - score, 6) + 0.0 AS degradation_score
FROM (SELECT event_id, CASE WHEN event_id % 7 > 0 THEN floor(value) END AS score FROM events)""",
)
def risk_level_query(spark, sf):
    score = F.when(F.col("event_id") % 7 > 0, F.floor("value").cast("double"))
    scored = V.table(spark, sf, "events").select("event_id", score.alias("score"))
    return rounded(
        scored.select(
            "event_id",
            risk_level(F.col("score"), RiskThresholds()).alias("risk_level"),
            degradation_score(F.col("score")).alias("degradation_score"),
        )
    )


@query(
    "nan_to_null",
    "SELECT event_id, CASE WHEN event_id % 5 > 0 THEN value END AS reading FROM events",
)
def nan_to_null(spark, sf):
    value = F.when(F.col("event_id") % 5 > 0, F.col("value")).otherwise(float("nan"))
    return V.table(spark, sf, "events").select("event_id", null_if_nan(value).alias("reading"))


@query(
    "spike_any_flag",
    with_ctes(V.MULTI)
    + f"SELECT dataset_id, unit_id, cycle, {' OR '.join(V.sql_spike(s) for s in V.FOUR)} AS has_sensor_spike FROM multi",
)
def spike_any_flag(spark, sf):
    return flag_spikes(V.multi(spark, sf), rule=V.SPIKES, series=UNIQUE_SERIES).drop(*V.FOUR)


DUPLICATES = "(PARTITION BY unit_id, cycle, dataset_id)"


@query(
    "quarantine_duplicates",
    with_ctes(V.HOURLY)
    + f"""SELECT unit_id, cycle, source_row_number, n > 1 AS quarantined
FROM (SELECT *, count(*) OVER {DUPLICATES} AS n FROM hourly)""",
)
def quarantine_duplicates_query(spark, sf):
    clean, copies = split_duplicates(V.hourly(spark, sf))
    columns = ("unit_id", "cycle", "source_row_number")
    return clean.select(*columns, F.lit(False).alias("quarantined")).unionByName(
        copies.select(*columns, F.lit(True).alias("quarantined"))
    )


@query(
    "drop_later_duplicates",
    with_ctes(V.HOURLY)
    + """SELECT unit_id, cycle, source_row_number FROM (SELECT *, row_number() OVER (
  PARTITION BY unit_id, cycle, dataset_id ORDER BY source_file, source_row_number) AS n FROM hourly) WHERE n = 1""",
)
def drop_later_duplicates(spark, sf):
    clean, _ = split_duplicates(V.hourly(spark, sf), keep="first")
    return clean.select("unit_id", "cycle", "source_row_number")


TO_SILVER_SQL = with_ctes(*SILVER_CTES) + f"SELECT dataset_id, {READ_SQL}, {', '.join(FLAGS)} FROM silver"


def _silver_columns(df):
    return rounded(df.select("dataset_id", "unit_id", "cycle", *NUMBERS, *FLAGS))


@query("to_silver", TO_SILVER_SQL)
def to_silver_query(spark, sf):
    return _silver_columns(silver(spark, sf))


@query("to_silver_hot_units", TO_SILVER_SQL)
def to_silver_hot_units(spark, sf):
    """The same table with the larger units split into chunks."""
    limits = SkewLimits(hot_rows=600, chunk_rows=250)
    return _silver_columns(silver(spark, sf, Settings(ranges=V.RANGES, spikes=V.SPIKES, limits=limits)))


@query(
    "silver_quarantine",
    with_ctes(V.DAILY)
    + f"SELECT dataset_id, {READ_SQL} FROM (SELECT *, count(*) OVER {DUPLICATES} AS n FROM daily) WHERE n > 1",
)
def silver_quarantine(spark, sf):
    return rounded(quarantined_duplicates(V.daily(spark, sf)).select("dataset_id", *READING_COLUMNS))


# --- features ---------------------------------------------------------------


def _feature_sql() -> str:
    spec = default_features()
    rolled = [
        r(V.sql_rolling(c, stat, n), f"{c}_rolling_{stat}_{n}")
        for c, f in spec.items()
        for n in f.rolling_windows
        for stat in f.statistics
    ]
    changed = [r(V.sql_change(c), f"{c}_rate_of_change") for c, f in spec.items() if f.rate_of_change]
    first = [f"cycle - min(cycle) OVER ({V.UNIT}) AS cycles_since_first_observation"]
    counted = [
        f"CAST(sum(CAST({flag} AS INTEGER)) OVER ({V.SERIES} ROWS UNBOUNDED PRECEDING) AS INTEGER) AS {name}"
        for name, flag in COUNTED_FLAGS.items()
    ]
    columns = ",\n ".join(["dataset_id", "unit_id", "cycle", *rolled, *changed, *first, *counted])
    return with_ctes(*SILVER_CTES) + f"SELECT {columns} FROM silver"


FEATURE_SQL = _feature_sql()


def _features(spark, sf, limits=SkewLimits()):
    return feature_columns(ml_features(silver(spark, sf), limits=limits, profile=V.daily_units(spark, sf, limits)))


def feature_columns(built):
    dropped = [*NUMBERS, *FLAGS, "silver_processed_at", "source_file", "ingested_at", "pipeline_run_id"]
    return rounded(built.drop(*dropped, "source_row_number"))


@query("ml_features", FEATURE_SQL)
def ml_features_query(spark, sf):
    return _features(spark, sf)


# --- health -----------------------------------------------------------------

HEALTH_CTES = (*SILVER_CTES, V.sql_health("silver", SENSOR_COLUMNS))
HEALTH_COLUMNS = (
    "equipment_key, unit_id, cycle, round(health_score, 6) + 0.0 AS health_score, "
    "round(degradation_score, 6) + 0.0 AS degradation_score, remaining_useful_life, risk_level"
)


def health_table(spark, sf, **options):
    return H.equipment_health(silver(spark, sf), profile=V.daily_units(spark, sf), **options).drop("calculated_at")


@query("health_score", with_ctes(*HEALTH_CTES) + f"SELECT unit_id, cycle, dataset_id, {r('health_score', 'health_score')} FROM health")
def health_score_query(spark, sf):
    scored = H.health_score(silver(spark, sf), profile=V.daily_units(spark, sf))
    return rounded(scored.select("unit_id", "cycle", "dataset_id", "health_score"))


@query("fact_equipment_health", with_ctes(*HEALTH_CTES) + f"SELECT {HEALTH_COLUMNS} FROM health")
def fact_equipment_health(spark, sf):
    return rounded(health_table(spark, sf))


HARSH = HealthWeights(20.0, 3.0, 1.5, 1.0, RiskThresholds(60, 70, 80))
HARSH_CTES = (
    *SILVER_CTES,
    V.sql_health("silver", SENSOR_COLUMNS, w=(20.0, 3.0, 1.5, 1.0), cuts=(60, 70, 80)),
)


@query("fact_equipment_health_all_risks", with_ctes(*HARSH_CTES) + f"SELECT {HEALTH_COLUMNS} FROM health")
def fact_equipment_health_all_risks(spark, sf):
    """Weights and cutoffs under which every risk level and both clips occur."""
    return rounded(health_table(spark, sf, weights=HARSH))


@query(
    "health_score_null_readings",
    with_ctes(
        V.NULLS,
        """flagged AS (SELECT *, sensor_07 > 7.0 AS has_sensor_range_violation, false AS has_sensor_spike FROM nulls)""",
        V.sql_health("flagged", V.FOUR),
    )
    + f"SELECT dataset_id, unit_id, cycle, {r('health_score', 'health_score')}, risk_level FROM health",
)
def health_score_null_readings(spark, sf):
    flagged = V.nulls(spark, sf).withColumns(
        {"has_sensor_range_violation": F.col("sensor_07") > 7.0, "has_sensor_spike": F.lit(False)}
    )
    scored = H.health_score(flagged)
    return rounded(
        scored.select(
            "dataset_id", "unit_id", "cycle", "health_score", risk_level(F.col("health_score")).alias("risk_level")
        )
    )


STATS_SQL = ", ".join(f"{r(f'avg({s})', f'{s}_mean')}, {r(f'stddev_samp({s})', f'{s}_std')}" for s in SENSOR_COLUMNS)


@query("global_sensor_stats", with_ctes(V.DAILY) + f"SELECT {STATS_SQL} FROM daily")
def global_sensor_stats(spark, sf):
    return rounded(H.sensor_stats(V.daily(spark, sf)))


@query(
    "attach_global_stats",
    with_ctes(V.MULTI)
    + "SELECT dataset_id, unit_id, cycle, "
    + ", ".join(r(f"({s} - avg({s}) OVER ()) / stddev_samp({s}) OVER ()", f"{s}_z") for s in V.FOUR)
    + " FROM multi",
)
def attach_global_stats(spark, sf):
    attached = H.with_sensor_stats(V.multi(spark, sf), tuple(V.FOUR))
    z = [((F.col(s) - F.col(f"__stats.{s}_mean")) / F.col(f"__stats.{s}_std")).alias(f"{s}_z") for s in V.FOUR]
    return rounded(attached.select("dataset_id", "unit_id", "cycle", *z))


@query(
    "attach_dataset_stats",
    with_ctes(V.MULTI)
    + "SELECT dataset_id, unit_id, cycle, "
    + ", ".join(
        r(f"({s} - avg({s}) OVER d) / stddev_samp({s}) OVER d", f"{s}_z") for s in V.FOUR
    )
    + " FROM multi WINDOW d AS (PARTITION BY dataset_id)",
)
def attach_dataset_stats(spark, sf):
    attached = H.with_sensor_stats(V.multi(spark, sf), tuple(V.FOUR), by=["dataset_id"])
    z = [((F.col(s) - F.col(f"__stats.{s}_mean")) / F.col(f"__stats.{s}_std")).alias(f"{s}_z") for s in V.FOUR]
    return rounded(attached.select("dataset_id", "unit_id", "cycle", *z))


DIM_SQL = """SELECT unit_id || '_' || dataset_id AS equipment_key, unit_id, dataset_id,
  'turbofan_engine' AS equipment_type, min(cycle) AS first_observed_cycle, max(cycle) AS last_observed_cycle,
  count(cycle) AS total_operational_cycles FROM {} GROUP BY unit_id, dataset_id"""


@query("dim_equipment", with_ctes(V.HOURLY) + DIM_SQL.format("hourly"))
def dim_equipment(spark, sf):
    return H.dim_equipment(V.hourly(spark, sf))


SUMMARY = """summary AS (
  SELECT l.equipment_key, l.unit_id, l.cycle AS latest_cycle, l.health_score,
         l.remaining_useful_life AS estimated_rul, l.risk_level, w.sensors_in_warning_state
  FROM health l
  JOIN (SELECT equipment_key, max(cycle) AS cycle FROM health GROUP BY equipment_key) m
    ON l.equipment_key = m.equipment_key AND l.cycle = m.cycle
  JOIN (SELECT unit_id || '_' || dataset_id AS equipment_key,
               CAST(coalesce(sum(CAST(has_sensor_range_violation AS INTEGER)), 0) AS BIGINT) AS sensors_in_warning_state
        FROM silver GROUP BY ALL) w ON l.equipment_key = w.equipment_key)"""
SUMMARY_CTES = (*HEALTH_CTES, SUMMARY)


def summary_table(spark, sf, **options):
    clean = silver(spark, sf)
    health = H.equipment_health(clean, profile=V.daily_units(spark, sf), **options)
    return H.equipment_summary(health, clean).drop("last_updated_at")


@query(
    "equipment_health_summary",
    with_ctes(*SUMMARY_CTES)
    + "SELECT equipment_key, unit_id, latest_cycle, round(health_score, 6) + 0.0 AS health_score, estimated_rul, "
    "risk_level, sensors_in_warning_state FROM summary",
)
def equipment_health_summary(spark, sf):
    return rounded(summary_table(spark, sf))


@query(
    "unit_violation_count",
    with_ctes(*SILVER_CTES)
    + "SELECT unit_id || '_' || dataset_id AS equipment_key, "
    "CAST(sum(CAST(has_sensor_range_violation AS INTEGER)) AS BIGINT) AS sensors_in_warning_state "
    "FROM silver GROUP BY ALL",
)
def unit_violation_count(spark, sf):
    return H.violation_counts(silver(spark, sf))


@query(
    "min_rul_per_unit",
    with_ctes(V.CLEAN)
    + f"""SELECT dataset_id, unit_id, min(rul) AS min_rul FROM (
  SELECT *, max(cycle) OVER ({V.UNIT}) - cycle AS rul FROM clean) GROUP BY dataset_id, unit_id""",
)
def min_rul_per_unit(spark, sf):
    from fleetlake.operators.series import remaining_useful_life

    dated = remaining_useful_life(V.clean(spark, sf))
    return dated.groupBy("dataset_id", "unit_id").agg(F.min("remaining_useful_life").alias("min_rul"))
