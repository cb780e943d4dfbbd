"""Queries over stored partial statistics, limits as a table, and automatic bins."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlake.operators import partials as P
from fleetlake.operators import serving as S
from fleetlake.operators.silver import CLEAN, with_outcome
from fleetlake.queries import layers as L
from fleetlake.queries import views as V
from fleetlake.queries.files import _lake
from fleetlake.queries.registry import query
from fleetlake.queries.views import r, rounded, with_ctes
from fleetlake.session import scratch_path
from fleetlake.settings import SENSOR_COLUMNS
from fleetlake.sinks import tables as K
from fleetlake.sources import layers as R


@query(
    "unit_sketches",
    "SELECT 'FD00' || CAST(user_id % 4 + 1 AS VARCHAR) AS dataset_id, count(DISTINCT user_id) AS units, "
    "true AS within_error FROM events GROUP BY ALL UNION ALL SELECT 'all', count(DISTINCT user_id), true FROM events",
)
def unit_sketches(spark, sf):
    """Sketches stored by data set: whether their estimates, and that of their union, are within four standard errors."""
    readings = V.hourly(spark, sf)
    path = K.write_layer(P.unit_sketches(readings), scratch_path(spark, "sketches"), ["dataset_id"])
    stored = R.read_layer(spark, path)
    both = P.estimated_units(stored).unionByName(
        P.estimated_units(P.merge_sketches(stored)).withColumn("dataset_id", F.lit("all"))
    )
    exact = P.distinct_units(readings, ["dataset_id"]).unionByName(
        P.distinct_units(readings).withColumn("dataset_id", F.lit("all"))
    )
    error = 4 * 1.04 / 2 ** (P.LOG_K / 2)
    near = F.abs(F.col("estimate") - F.col("units")) <= F.col("units") * error + 1
    return exact.join(both.withColumnRenamed("units", "estimate"), "dataset_id").select(
        "dataset_id", "units", near.alias("within_error")
    )


@query(
    "merged_moments",
    with_ctes(V.DAILY) + " UNION ALL ".join(
        f"SELECT '{s}' AS sensor, count({s}) AS n, {r(f'avg({s})', 'mean')}, {r(f'stddev_samp({s})', 'std')} FROM daily"
        for s in SENSOR_COLUMNS
    ),
)
def merged_moments(spark, sf):
    """Means and deviations over all rows from moments stored by data set, one of which a second run replaced."""
    readings = V.daily(spark, sf)
    path = scratch_path(spark, "moments")
    for rows in (readings.limit(500), readings.filter("dataset_id <> 'FD002'"), readings.filter("dataset_id = 'FD002'")):
        K.write_layer(P.sensor_moments(rows), path, ["dataset_id"])
    merged = P.merge_moments(R.read_layer(spark, path))
    return rounded(merged.select("sensor", "n", "mean", P.sample_std().alias("std")))


LIMITS = [
    ("sensor_02", 1.5, 104.0, None, None, None),
    ("sensor_02", 5.0, 90.0, "FD002", None, 3.0),
    ("sensor_03", None, 9.0, "FD001", 2.0, 5.0),
    ("sensor_03", 1.0, None, None, 5.0, None),
    ("sensor_04", 2.0, 6.0, "FD003", 1.0, 2.0),
]


def _limit_sql() -> str:
    def literal(x) -> str:
        return "NULL" if x is None else f"'{x}'" if isinstance(x, str) else repr(x)

    rows = ", ".join("(" + ", ".join(map(literal, row)) + ")" for row in LIMITS)
    reading = " UNION ALL ".join(
        f"SELECT unit_id, cycle, dataset_id, source_row_number AS n, operational_setting_1 AS setting, '{s}' AS violated_sensor, {s} AS value FROM daily"
        for s in SENSOR_COLUMNS
    )
    return (
        with_ctes(V.DAILY)[:-1]
        + f""", limits(sensor, range_min, range_max, d, setting_from, setting_below) AS (VALUES {rows}),
  readings AS ({reading})
SELECT unit_id, cycle, dataset_id, violated_sensor, {r('value', 'value')}, CAST(range_min AS DOUBLE) AS range_min,
       CAST(range_max AS DOUBLE) AS range_max
FROM readings JOIN limits ON violated_sensor = sensor AND (d IS NULL OR d = dataset_id)
 AND (setting_from IS NULL OR setting >= setting_from) AND (setting_below IS NULL OR setting < setting_below)
 AND (value < range_min OR value > range_max)"""
    )


@query("limit_violations", _limit_sql())
def limit_violations(spark, sf):
    """Readings against limits that differ by data set and band of a setting."""
    limits = spark.createDataFrame(LIMITS, P.LIMIT_SCHEMA)
    return rounded(P.limit_violations(V.daily(spark, sf), limits))


@query(
    "auto_histogram",
    f"""WITH widths AS (SELECT unnest({S.round_steps()}::DOUBLE[]) AS w),
ends AS (SELECT min(value) AS low, max(value) AS high FROM events),
chosen AS (SELECT min(w) AS w FROM widths, ends WHERE floor(high / w) - floor(low / w) + 1 <= 20)
SELECT floor(value / w) * w AS bin_start, (floor(value / w) + 1) * w AS bin_end, count(*) AS units
FROM events, chosen GROUP BY ALL""",
)
def auto_histogram(spark, sf):
    return S.auto_histogram(V.table(spark, sf, "events"), "value")


@query(
    "write_outcomes",
    with_ctes(V.DAILY)
    + """SELECT dataset_id, CASE WHEN n > 1 THEN 'quarantined' ELSE 'clean' END AS outcome, unit_id, cycle, source_row_number
FROM (SELECT *, count(*) OVER (PARTITION BY unit_id, cycle, dataset_id) AS n FROM daily)""",
)
def write_outcomes(spark, sf):
    """Both folders of the one write, a second run's over the first's."""
    settings, _ = _lake(spark, "outcomes")
    bronze = V.daily(spark, sf)
    for rows in (bronze.filter("cycle % 2 = 0"), bronze):
        silver = K.write_outcomes(with_outcome(rows, L.SETTINGS), settings.paths, settings.dataset_ids)
    columns = ["dataset_id", "unit_id", "cycle", "source_row_number"]
    clean = R.read_layer(spark, silver, columns).withColumn("outcome", F.lit(CLEAN))
    copies = f"{settings.paths.quarantine_dir}/duplicates"
    if not R.path_exists(spark, copies):
        return clean
    return clean.unionByName(R.read_layer(spark, copies, columns).withColumn("outcome", F.lit("quarantined")))
