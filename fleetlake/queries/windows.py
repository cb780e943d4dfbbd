"""Queries for the window operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlake.functions.columns import equipment_key
from fleetlake.functions.windows import FullRolling, Spikes, cycle_gap
from fleetlake.operators import series as S
from fleetlake.operators.features import COUNTED_FLAGS
from fleetlake.operators.skew import flag_copies
from fleetlake.queries import views as V
from fleetlake.queries.registry import query
from fleetlake.queries.views import r, rounded, with_ctes
from fleetlake.settings import UNIQUE_SERIES, SpikeRule

FOUR = tuple(V.FOUR)
HOURLY_ORDER = f"{V.UNIT} ORDER BY cycle, source_file, source_row_number"


@query(
    "cycle_gap_flag",
    with_ctes(V.HOURLY)
    + f"SELECT dataset_id, unit_id, cycle, source_row_number, {V.sql_gap(HOURLY_ORDER)} AS has_cycle_gap FROM hourly",
)
def cycle_gap_flag(spark, sf):
    return S.flag_gaps(V.hourly(spark, sf)).drop("sensor_02", "source_file")


@query(
    "cycle_gap_list",
    with_ctes(V.HOURLY)
    + f"""SELECT dataset_id, unit_id, current_cycle, previous_cycle, current_cycle - previous_cycle AS gap_size
FROM (SELECT dataset_id, unit_id, cycle AS current_cycle,
             lag(cycle, 1) OVER ({HOURLY_ORDER}) AS previous_cycle FROM hourly)
WHERE current_cycle - previous_cycle > 1""",
)
def cycle_gap_list(spark, sf):
    return S.gap_list(V.hourly(spark, sf))


STATS = ("mean", "std", "min", "max")
FULL_PAIRS = {c: [(stat, n) for n in (5, 10, 20) for stat in STATS] for c in ("sensor_02", "sensor_04")}


def _rolled_sql(pairs, full, view, order=V.SERIES):
    columns = ", ".join(
        r(V.sql_rolling(c, stat, n, full, order), f"{c}_rolling_{stat}_{n}") for c, p in pairs.items() for stat, n in p
    )
    return f"SELECT dataset_id, unit_id, cycle, {columns} FROM {view}"


@query("rolling_full", with_ctes(V.NULLS) + _rolled_sql(FULL_PAIRS, True, "nulls"))
def rolling_full(spark, sf):
    rolled = S.rolling_columns(V.nulls(spark, sf), FULL_PAIRS, UNIQUE_SERIES)
    return rounded(rolled.drop(*FOUR))


PARTIAL_PAIRS = {c: [("mean", 10), ("std", 10), ("min", 20), ("max", 20)] for c in FOUR}


@query("rolling_partial", with_ctes(V.MULTI) + _rolled_sql(PARTIAL_PAIRS, False, "multi"))
def rolling_partial(spark, sf):
    rolled = S.rolling_columns(V.multi(spark, sf), PARTIAL_PAIRS, UNIQUE_SERIES, full=False)
    return rounded(rolled.drop(*FOUR))


@query(
    "rate_of_change",
    with_ctes(V.NULLS)
    + "SELECT dataset_id, unit_id, cycle, "
    + ", ".join(r(V.sql_change(c), f"{c}_rate_of_change") for c in FOUR)
    + " FROM nulls",
)
def rate_of_change(spark, sf):
    return rounded(S.change_columns(V.nulls(spark, sf), FOUR, UNIQUE_SERIES).drop(*FOUR))


@query(
    "next_value",
    with_ctes(V.MULTI)
    + f"SELECT dataset_id, unit_id, cycle, {r(f'lead(sensor_02, 1) OVER ({V.SERIES})', 'sensor_02_next_value')} FROM multi",
)
def next_value(spark, sf):
    return rounded(S.next_columns(V.multi(spark, sf), ["sensor_02"], UNIQUE_SERIES).drop(*FOUR))


TREND_SQL = (
    with_ctes(V.MULTI)
    + f"""SELECT dataset_id, unit_id, cycle,
  {r(f"avg(d2) {V.frame(10)}", "sensor_02_degradation_trend")}, {r(f"avg(d4) {V.frame(10)}", "sensor_04_degradation_trend")}
FROM (SELECT *, {V.sql_change("sensor_02")} AS d2, {V.sql_change("sensor_04")} AS d4 FROM multi)"""
)


def _trend(spark, sf, **options):
    found = S.trend_columns(V.multi(spark, sf), ["sensor_02", "sensor_04"], 10, UNIQUE_SERIES, **options)
    return rounded(
        found.select("dataset_id", "unit_id", "cycle", "sensor_02_degradation_trend", "sensor_04_degradation_trend")
    )


@query("degradation_trend", TREND_SQL)
def degradation_trend(spark, sf):
    return _trend(spark, sf)


@query("degradation_trend_hot_units", TREND_SQL)
def degradation_trend_hot_units(spark, sf):
    return _trend(spark, sf, limits=V.SMALL_LIMITS)


@query(
    "remaining_useful_life",
    with_ctes(V.CLEAN)
    + f"SELECT dataset_id, unit_id, cycle, max(cycle) OVER ({V.UNIT}) - cycle AS remaining_useful_life FROM clean",
)
def remaining_useful_life(spark, sf):
    return S.remaining_useful_life(V.clean(spark, sf)).drop("sensor_02", "source_row_number")


@query(
    "cycles_since_first",
    with_ctes(V.HOURLY)
    + f"SELECT dataset_id, unit_id, cycle, source_row_number, "
    f"cycle - min(cycle) OVER ({V.UNIT}) AS cycles_since_first_observation FROM hourly",
)
def cycles_since_first(spark, sf):
    return S.cycles_since_first(V.hourly(spark, sf)).drop("sensor_02", "source_file")


@query(
    "lifecycle_ratio",
    with_ctes(V.CLEAN)
    + "SELECT dataset_id, unit_id, cycle, "
    + r(f"CAST(cycle AS DOUBLE) / CAST(max(cycle) OVER ({V.UNIT}) AS DOUBLE)", "lifecycle_ratio")
    + " FROM clean",
)
def lifecycle_ratio(spark, sf):
    return rounded(S.lifecycle_ratio(V.clean(spark, sf)).drop("sensor_02", "source_row_number"))


COUNT_FLAGS = """counted AS (
  SELECT *, cycle % 5 = 0 AS has_cycle_gap, sensor_04 > 7.0 AS has_sensor_range_violation,
         sensor_07 = 0.0 AS has_sensor_spike FROM nulls)"""


def _with_count_flags(df):
    return df.withColumns(
        {
            "has_cycle_gap": F.col("cycle") % 5 == 0,
            "has_sensor_range_violation": F.col("sensor_04") > 7.0,
            "has_sensor_spike": F.col("sensor_07") == 0.0,
        }
    )


RUNNING_SQL = (
    with_ctes(V.NULLS, COUNT_FLAGS)
    + "SELECT dataset_id, unit_id, cycle, "
    + ", ".join(
        f"CAST(CASE WHEN {flag} IS NOT NULL THEN sum(CAST({flag} AS INTEGER)) "
        f"OVER ({V.SERIES} ROWS UNBOUNDED PRECEDING) END AS INTEGER) AS {name}"
        for name, flag in COUNTED_FLAGS.items()
    )
    + " FROM counted"
)


def _running(spark, sf, **options):
    flagged = _with_count_flags(V.nulls(spark, sf))
    counted = S.running_counts(flagged, COUNTED_FLAGS, UNIQUE_SERIES, **options)
    return counted.select("dataset_id", "unit_id", "cycle", *COUNTED_FLAGS)


@query("running_quality_counts", RUNNING_SQL)
def running_quality_counts(spark, sf):
    return _running(spark, sf)


@query("running_quality_counts_hot_units", RUNNING_SQL)
def running_quality_counts_hot_units(spark, sf):
    return _running(spark, sf, limits=V.SMALL_LIMITS)


CLEAN_RULE = SpikeRule(20, 3.0)
SPIKE_SQL = (
    with_ctes(V.CLEAN)
    + f"SELECT dataset_id, unit_id, cycle, {V.sql_spike('sensor_02', CLEAN_RULE)} AS spike_sensor_02 FROM clean"
)


@query("spike_flag", SPIKE_SQL)
def spike_flag(spark, sf):
    return S.spike_columns(V.clean(spark, sf), ["sensor_02"], CLEAN_RULE).drop("sensor_02", "source_row_number")


BEFORE_RULE = SpikeRule(10, 3.0, exclude_current=True)


@query(
    "spike_flag_exclude_current",
    with_ctes(V.CLEAN)
    + f"SELECT dataset_id, unit_id, cycle, {V.sql_spike('sensor_02', BEFORE_RULE)} AS spike_sensor_02 FROM clean",
)
def spike_flag_exclude_current(spark, sf):
    return S.spike_columns(V.clean(spark, sf), ["sensor_02"], BEFORE_RULE).drop("sensor_02", "source_row_number")


@query(
    "series_window_hot_units",
    with_ctes(V.MULTI)
    + "SELECT dataset_id, unit_id, cycle, "
    + ", ".join(r(V.sql_rolling(c, stat, 20), f"{c}_{stat}") for c in FOUR for stat in ("mean", "std"))
    + ", "
    + ", ".join(f"{V.sql_spike(c)} AS {c}_spike" for c in FOUR)
    + f", {V.sql_gap()} AS has_cycle_gap, max(cycle) OVER ({V.UNIT}) AS last_cycle FROM multi",
)
def series_window_hot_units(spark, sf):
    """The flag and rolling windows with the larger units split into chunks."""

    windows = FullRolling({c: [(stat, 20) for stat in ("mean", "std")] for c in FOUR})
    spikes = Spikes(FOUR, V.SPIKES)

    def columns(w):
        rolled = {f"{c}_{stat}": windows.text(c, stat, 20) for c in FOUR for stat in ("mean", "std")}
        return {**rolled, "has_cycle_gap": cycle_gap("cycle", w)}

    found = S.over_series(
        V.multi(spark, sf, V.SMALL_LIMITS),
        *windows.stages,
        columns,
        series=UNIQUE_SERIES,
        before=20,
        totals={"last_cycle": F.max("cycle")},
        limits=V.SMALL_LIMITS,
    )
    found = S.over_series(
        found,
        *spikes.stages,
        lambda _: {f"{c}_spike": spikes.text(c) for c in FOUR},
        series=UNIQUE_SERIES,
        before=spikes.before,
        limits=V.SMALL_LIMITS,
    )
    return rounded(found.drop(*FOUR))


RANK_SQL = (
    with_ctes(V.CLEAN)
    + """SELECT dataset_id, unit_id, cycle,
  row_number() OVER (ORDER BY sensor_02 ASC NULLS LAST, unit_id, cycle) AS maintenance_priority_rank FROM clean"""
)


@query("maintenance_priority_rank", RANK_SQL)
def maintenance_priority_rank(spark, sf):
    order = [F.col("sensor_02").asc_nulls_last(), F.col("unit_id"), F.col("cycle")]
    ranked = S.global_rank(V.clean(spark, sf), order, "maintenance_priority_rank")
    return ranked.drop("sensor_02", "source_row_number")


@query(
    "latest_reading_per_unit",
    with_ctes(V.CLEAN)
    + f"""SELECT dataset_id, unit_id, cycle, sensor_02, source_row_number
FROM (SELECT *, row_number() OVER ({V.UNIT} ORDER BY cycle DESC) AS cycle_rank FROM clean) WHERE cycle_rank = 1""",
)
def latest_reading_per_unit(spark, sf):
    return S.latest_reading_per_unit(V.clean(spark, sf))


ORDER_LINE_KEYS = ["l_orderkey", "l_linenumber"]
COPIES_SQL = """SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate::VARCHAR AS shipped,
  count(*) OVER (PARTITION BY l_orderkey, l_linenumber) > 1 AS is_duplicate FROM lineitem"""


def _copies(spark, sf, **options):
    lines = V.table(spark, sf, "lineitem").select(*ORDER_LINE_KEYS, "l_partkey", F.col("l_shipdate"))
    flagged = flag_copies(lines, ORDER_LINE_KEYS, **options)
    return flagged.select(
        *ORDER_LINE_KEYS, "l_partkey", F.col("l_shipdate").cast("string").alias("shipped"), "is_duplicate"
    )


@query("duplicate_flag", COPIES_SQL)
def duplicate_flag(spark, sf):
    return _copies(spark, sf)


@query(
    "duplicate_flag_hot_keys",
    """SELECT l_suppkey, CAST(l_quantity AS BIGINT) AS quantity, l_orderkey,
  count(*) OVER (PARTITION BY l_suppkey, l_quantity) > 1 AS is_duplicate FROM lineitem""",
)
def duplicate_flag_hot_keys(spark, sf):
    """Keys held by more rows than the limit are flagged without meeting."""
    lines = V.table(spark, sf, "lineitem").select(
        "l_suppkey", F.col("l_quantity").cast("bigint").alias("quantity"), "l_orderkey"
    )
    from fleetlake.settings import SkewLimits

    return flag_copies(lines, ["l_suppkey", "quantity"], limits=SkewLimits(hot_rows=12))


@query(
    "rolling_benchmark",
    with_ctes(V.MULTI)
    + "SELECT dataset_id, unit_id, cycle, "
    + ", ".join(r(V.sql_rolling("sensor_02", stat, 10), f"rolling_{stat}") for stat in ("mean", "std"))
    + " FROM multi",
)
def rolling_benchmark(spark, sf):
    rolled = S.rolling_columns(V.multi(spark, sf), {"sensor_02": [("mean", 10), ("std", 10)]}, UNIQUE_SERIES)
    named = rolled.withColumnsRenamed({f"sensor_02_rolling_{stat}_10": f"rolling_{stat}" for stat in ("mean", "std")})
    return rounded(named.drop(*FOUR))


@query(
    "equipment_key",
    with_ctes(V.CLEAN) + "SELECT unit_id || '_' || dataset_id AS equipment_key, cycle FROM clean",
)
def equipment_key_query(spark, sf):
    df = V.clean(spark, sf)
    return df.select(equipment_key(df.columns).alias("equipment_key"), "cycle")
