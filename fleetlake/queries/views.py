"""Reading-shaped views of the driver's tables, in Spark and as SQL text.

The tables hold no sensor readings, so each view maps one of them onto the
reading schema over all of its rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions.batches import rounded_struct
from fleetlake.operators.series import numbered_series
from fleetlake.operators.skew import GroupProfile, profile_groups
from fleetlake.settings import SENSOR_COLUMNS, SETTING_COLUMNS, UNIQUE_SERIES, SensorRange, SkewLimits, SpikeRule

MEASURES = ("l_quantity", "l_extendedprice / 997.0", "l_discount * 100.0 + 0.0", "l_tax * 100.0 + 0.0")
SHIP_ORDER = ("l_shipdate", "l_orderkey", "l_linenumber", "l_partkey")

RANGES = {
    "sensor_01": SensorRange(0.0, 100.0),
    "sensor_02": SensorRange(1.5, 104.0),
    "sensor_03": SensorRange(0.0, 9.5),
    "sensor_04": SensorRange(0.0, 7.5),
}
SPIKES = SpikeRule(20, 2.0)
SMALL_LIMITS = SkewLimits(hot_rows=600, chunk_rows=250, broadcast_groups=20)
"""Limits low enough that the larger units of the small test tables are hot."""


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def _dataset(unit: str) -> Column:
    return F.concat(F.lit("FD00"), (F.col(unit) % 4 + 1).cast("string")).alias("dataset_id")


def _sql_dataset(unit: str) -> str:
    return f"'FD00' || CAST({unit} % 4 + 1 AS VARCHAR) AS dataset_id"


# --- events -----------------------------------------------------------------


def clean(spark: SparkSession, sf: str, limits: SkewLimits = SkewLimits()) -> DataFrame:
    """One sensor per user, cycles counted without gaps in event order."""
    events = table(spark, sf, "events").select("user_id", "ts", "event_id", "value")
    numbered = numbered_series(events, ["ts", "event_id"], ["user_id"], "cycle", limits)
    return numbered.select(
        _dataset("user_id"),
        F.col("user_id").alias("unit_id"),
        "cycle",
        F.col("value").alias("sensor_02"),
        F.col("event_id").alias("source_row_number"),
    )


CLEAN = f"""clean AS (
  SELECT {_sql_dataset("user_id")}, user_id AS unit_id,
         row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS cycle,
         value AS sensor_02, event_id AS source_row_number
  FROM events)"""


def hourly(spark: SparkSession, sf: str) -> DataFrame:
    """Cycles are whole hours: with gaps, and shared by several rows."""
    hours = F.expr("timestampdiff(HOUR, timestamp_ntz'2024-01-01 00:00:00', ts)")
    return table(spark, sf, "events").select(
        _dataset("user_id"),
        F.col("user_id").alias("unit_id"),
        hours.alias("cycle"),
        F.col("value").alias("sensor_02"),
        F.col("event_id").alias("source_row_number"),
        F.lit("train_FD001.txt").alias("source_file"),
    )


HOURLY = f"""hourly AS (
  SELECT {_sql_dataset("user_id")}, user_id AS unit_id,
         date_diff('hour', TIMESTAMP '2024-01-01 00:00:00', ts) AS cycle,
         value AS sensor_02, event_id AS source_row_number, 'train_FD001.txt' AS source_file
  FROM events)"""


# --- lineitem ---------------------------------------------------------------


def _sensor_sql(i: int) -> str:
    """The i-th sensor: one of the four measures on its own level."""
    return f"{MEASURES[(i - 1) % 4]} + {(i - 1) // 4 * 10.0}"


SETTINGS = dict(
    zip(
        SETTING_COLUMNS,
        ("CAST(l_linenumber AS DOUBLE)", "CAST(l_partkey % 3 AS DOUBLE)", "CAST(100 AS DOUBLE)"),
    )
)
SENSORS = {s: _sensor_sql(i) for i, s in enumerate(SENSOR_COLUMNS, 1)}


def _readings(lines: DataFrame, cycle: Column, sensors: dict[str, str], settings: dict[str, str]) -> DataFrame:
    return lines.select(
        F.col("l_suppkey").alias("unit_id"),
        cycle.alias("cycle"),
        *(F.expr(text).alias(name) for name, text in {**settings, **sensors}.items()),
        _dataset("l_suppkey"),
        F.concat(F.lit("train_FD00"), (F.col("l_suppkey") % 4 + 1).cast("string"), F.lit(".txt")).alias("source_file"),
        F.col("l_shipdate").cast("timestamp").alias("ingested_at"),
        F.lit("run-1").alias("pipeline_run_id"),
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).alias("source_row_number"),
    )


def _sql_readings(name: str, cycle: str, sensors: dict[str, str], settings: dict[str, str]) -> str:
    columns = ",\n         ".join(f"{text} AS {c}" for c, text in {**settings, **sensors}.items())
    return f"""{name} AS (
  SELECT l_suppkey AS unit_id, {cycle} AS cycle,
         {columns},
         {_sql_dataset("l_suppkey")},
         'train_FD00' || CAST(l_suppkey % 4 + 1 AS VARCHAR) || '.txt' AS source_file,
         l_shipdate AS ingested_at, 'run-1' AS pipeline_run_id,
         l_orderkey * 8 + l_linenumber AS source_row_number
  FROM lineitem)"""


def full(spark: SparkSession, sf: str, limits: SkewLimits = SkewLimits()) -> DataFrame:
    """The whole reading schema, cycles without gaps or copies."""
    return _readings(_numbered_lines(spark, sf, limits), F.col("__cycle"), SENSORS, SETTINGS)


def _numbered_lines(spark: SparkSession, sf: str, limits: SkewLimits = SkewLimits()) -> DataFrame:
    lines = table(spark, sf, "lineitem").select(*SHIP_ORDER, "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    return numbered_series(lines, list(SHIP_ORDER), ["l_suppkey"], "__cycle", limits)


def full_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of :func:`full` by their keys, still as narrow as the table; :func:`spread_out` makes readings of them."""
    return _keyed_lines(_numbered_lines(spark, sf), F.col("__cycle"))


def _keyed_lines(lines: DataFrame, cycle: Column) -> DataFrame:
    unit = F.col("l_suppkey").alias("unit_id")
    return lines.select(
        _dataset("l_suppkey"), unit, cycle.alias("cycle"), "l_linenumber", "l_partkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax"
    )


def spread_out(lines: DataFrame) -> DataFrame:
    """Keys and numbers of the readings that :func:`full_lines` and :func:`daily_lines` stand for."""
    numbers = (F.expr(text).alias(name) for name, text in {**SETTINGS, **SENSORS}.items())
    return lines.select("dataset_id", "unit_id", "cycle", *numbers)


_DENSE = f"row_number() OVER (PARTITION BY l_suppkey ORDER BY {', '.join(SHIP_ORDER)})"
FULL = _sql_readings("full_readings", _DENSE, SENSORS, SETTINGS)

FOUR = {s: MEASURES[i] for i, s in enumerate(("sensor_02", "sensor_03", "sensor_04", "sensor_07"))}


def multi(spark: SparkSession, sf: str, limits: SkewLimits = SkewLimits()) -> DataFrame:
    """Four sensors, cycles without gaps or copies."""
    lines = table(spark, sf, "lineitem").select(*SHIP_ORDER, "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    numbered = numbered_series(lines, list(SHIP_ORDER), ["l_suppkey"], "__cycle", limits)
    return _readings(numbered, F.col("__cycle"), FOUR, {}).select("dataset_id", "unit_id", "cycle", *FOUR)


MULTI = _sql_readings("multi", _DENSE, FOUR, {})

NULLED = {
    "sensor_02": "nullif(l_quantity, 7.0)",
    "sensor_03": "nullif(l_extendedprice / 997.0, -1.0)",
    "sensor_04": "nullif(l_discount, 0.05) * 100.0 + 0.0",
    "sensor_07": "nullif(l_tax, 0.02) * 100.0 + 0.0",
}


def nulls(spark: SparkSession, sf: str) -> DataFrame:
    """:func:`multi` with NULL readings in three of the sensors."""
    lines = table(spark, sf, "lineitem").select(*SHIP_ORDER, "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    numbered = numbered_series(lines, list(SHIP_ORDER), ["l_suppkey"], "__cycle")
    return _readings(numbered, F.col("__cycle"), NULLED, {}).select("dataset_id", "unit_id", "cycle", *NULLED)


NULLS = _sql_readings("nulls", _DENSE, NULLED, {})

def daily(spark: SparkSession, sf: str) -> DataFrame:
    """The whole reading schema with days as cycles: gaps and copies occur."""
    return _readings(table(spark, sf, "lineitem"), _days(), SENSORS, SETTINGS)


def _days() -> Column:
    return F.date_diff(F.to_date("l_shipdate"), F.lit("1992-01-01").cast("date")).cast("bigint")


def daily_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The rows of :func:`daily` as :func:`full_lines` has those of :func:`full`."""
    return _keyed_lines(table(spark, sf, "lineitem"), _days())


def daily_units(spark: SparkSession, sf: str, limits: SkewLimits = SkewLimits()) -> GroupProfile:
    """Sizes of the units of :func:`daily`. Units of any table made of some of its rows are no larger."""
    return profile_groups(daily(spark, sf), UNIQUE_SERIES.keys, limits)


DAILY = _sql_readings(
    "daily", "CAST(date_diff('day', DATE '1992-01-01', CAST(l_shipdate AS DATE)) AS BIGINT)", SENSORS, SETTINGS
)


# --- SQL building blocks ----------------------------------------------------

UNIT = "PARTITION BY dataset_id, unit_id"
SERIES = f"{UNIT} ORDER BY cycle"
SQL_STATS = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}


def frame(n: int, order: str = SERIES) -> str:
    return f"OVER ({order} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def sql_rolling(column: str, stat: str, n: int, full_window: bool = True, order: str = SERIES) -> str:
    value = f"{SQL_STATS[stat]}({column}) {frame(n, order)}"
    return f"CASE WHEN count({column}) {frame(n, order)} >= {n} THEN {value} END" if full_window else value


def sql_spike(column: str, rule: SpikeRule = SPIKES, order: str = SERIES) -> str:
    n = rule.window
    f = (
        f"OVER ({order} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)" if rule.exclude_current else frame(n, order)
    )
    return (
        f"coalesce(count({column}) {f} >= {n} AND max({column}) {f} > min({column}) {f} "
        f"AND abs({column} - avg({column}) {f}) > {rule.sigma} * stddev_samp({column}) {f} "
        f"+ {rule.tolerance} * greatest(abs({column}), abs(avg({column}) {f})), false)"
    )


def sql_change(column: str, order: str = SERIES) -> str:
    return f"{column} - lag({column}, 1) OVER ({order})"


def sql_gap(order: str = SERIES) -> str:
    return f"coalesce(cycle - lag(cycle, 1) OVER ({order}) > 1, false)"


def sql_outside(sensor: str, bounds: SensorRange) -> str:
    return f"({sensor} < {bounds.min} OR {sensor} > {bounds.max})"


def r(expression: str, alias: str) -> str:
    """Rounded double; ``+ 0.0`` turns a negative zero into zero."""
    return f"round({expression}, 6) + 0.0 AS {alias}"


#: From so many doubles on a table is rounded in numpy: Spark's round makes a decimal number of every value.
MANY_DOUBLES = 8


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """All doubles rounded, so that the order of additions does not show."""
    doubles = [c for c, t in df.dtypes if t == "double"]
    if len(doubles) < MANY_DOUBLES:
        return df.select(*(F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes))
    whole = df.select(*(c for c in df.columns if c not in doubles), rounded_struct(doubles, digits).alias("__rounded"))
    return whole.select(*(F.col(f"__rounded.{c}").alias(c) if c in doubles else F.col(c) for c in df.columns))


def sql_status() -> str:
    return """CASE WHEN has_sensor_range_violation AND has_sensor_spike THEN 'QUARANTINED'
         WHEN has_cycle_gap OR has_sensor_range_violation OR has_sensor_spike THEN 'WARNING' ELSE 'VALID' END"""


def sql_silver(source: str, name: str = "silver", sensors=SENSOR_COLUMNS, ranges=RANGES, rule: SpikeRule = SPIKES) -> str:
    """CTEs from a bronze view to its silver table."""
    violation = " OR ".join(sql_outside(s, b) for s, b in ranges.items())
    spikes = "\n OR ".join(sql_spike(s, rule) for s in sensors)
    return f"""{name}_counted AS (
  SELECT *, count(*) OVER (PARTITION BY unit_id, cycle, dataset_id) AS copies FROM {source}),
{name}_flagged AS (
  SELECT * EXCLUDE (copies), {sql_gap()} AS has_cycle_gap, ({violation}) AS has_sensor_range_violation,
         ({spikes}) AS has_sensor_spike
  FROM {name}_counted WHERE copies = 1),
{name} AS (SELECT *, {sql_status()} AS record_quality_status FROM {name}_flagged)"""


def sql_health(source: str, sensors, name: str = "health", w=(0.4, 0.2, 0.3, 0.1), cuts=(25, 50, 75)) -> str:
    """CTEs from a silver view to the scored one."""
    stats = ", ".join(f"avg({s}) AS {s}_m, stddev_samp({s}) AS {s}_s" for s in sensors)
    count = " + ".join(f"(CASE WHEN {s}_s > 0 THEN 1 ELSE 0 END)" for s in sensors)
    deviations = "\n + ".join(f"(CASE WHEN {s}_s > 0 THEN abs(({s} - {s}_m) / {s}_s) ELSE 0.0 END)" for s in sensors)
    return f"""{name}_stats AS (SELECT {stats} FROM {source}),
{name}_raw AS (
  SELECT s.*, max(cycle) OVER (PARTITION BY dataset_id, unit_id) AS last_cycle,
         {count} AS counted, ({deviations}) AS deviation
  FROM {source} s, {name}_stats),
{name}_penalised AS (
  SELECT *, 100.0
     - CASE WHEN deviation IS NULL THEN NULL ELSE least(greatest(deviation / nullif(counted, 0), 0.0), 50.0) END * {w[0]}
     - CAST(has_sensor_spike AS INTEGER) * 10.0 * {w[1]}
     - CAST(cycle AS DOUBLE) / last_cycle * 30.0 * {w[2]}
     - CAST(has_sensor_range_violation AS INTEGER) * 15.0 * {w[3]} AS raw_score
  FROM {name}_raw),
{name}_scored AS (
  SELECT *, CASE WHEN counted = 0 THEN 100.0 WHEN raw_score IS NULL THEN NULL
              ELSE least(greatest(raw_score, 0.0), 100.0) END AS health_score
  FROM {name}_penalised),
{name} AS (
  SELECT unit_id || '_' || dataset_id AS equipment_key, dataset_id, unit_id, cycle, health_score,
         100.0 - health_score AS degradation_score, last_cycle - cycle AS remaining_useful_life,
         CASE WHEN health_score <= {cuts[0]} THEN 'CRITICAL' WHEN health_score <= {cuts[1]} THEN 'HIGH'
              WHEN health_score <= {cuts[2]} THEN 'MEDIUM' ELSE 'LOW' END AS risk_level
  FROM {name}_scored)"""


def with_ctes(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
