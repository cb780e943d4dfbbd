"""Queries for the data-quality operators."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from fleetlake.operators import quality as Q
from fleetlake.queries import layers as L
from fleetlake.queries import views as V
from fleetlake.queries.registry import query
from fleetlake.queries.views import r, with_ctes
from fleetlake.settings import SENSOR_COLUMNS, SensorRange, Settings, SpikeRule

NOW = datetime(2002, 1, 1)
NOW_SQL = "TIMESTAMP '2002-01-01 00:00:00'"
RESULT = "check_name, check_type, status, records_checked, failed_records, failure_percentage"
FOUR = tuple(V.FOUR)


def _plain(results):
    """Results without the run's stamp; the details are text for people."""
    return results.select(*RESULT.split(", "))


def _graded(failed: str, total: str, fail: str) -> str:
    return f"CASE WHEN {failed} = 0 THEN 'PASS' WHEN 100.0 * {failed} / {total} < {fail} THEN 'WARN' ELSE 'FAIL' END"


def _result(name: str, kind: str, status: str, checked: str, failed: str) -> str:
    pct = f"coalesce(round(CAST({failed} AS DOUBLE) / nullif({checked}, 0) * 100.0, 4), 0.0) + 0.0"
    return (
        f"SELECT '{name}' AS check_name, '{kind}' AS check_type, {status} AS status, "
        f"CAST({checked} AS BIGINT) AS records_checked, CAST({failed} AS BIGINT) AS failed_records, "
        f"{pct} AS failure_percentage"
    )


def _schema(view: str, status: str = "'PASS'", names=("required_columns", "column_types", "unexpected_columns")) -> list[str]:
    return [
        _result(n, "schema", status, f"(SELECT count(*) FROM {view})" if status == "'PASS'" else "0", "0") for n in names
    ]


def _aggregated(view: str, column: str, select: str) -> str:
    return f"{select} FROM (SELECT count(*) AS n, count_if({column}) AS bad FROM {view})"


def _nulls(view: str, column: str) -> str:
    row = _result(f"null_{column}", "completeness", "CASE WHEN bad = 0 THEN 'PASS' ELSE 'FAIL' END", "n", "bad")
    return _aggregated(view, f"{column} IS NULL", row)


def _completeness(view: str, column: str) -> str:
    status = (
        "CASE WHEN n = 0 OR 1.0 - bad / CAST(n AS DOUBLE) < 0.95 THEN 'FAIL' "
        "WHEN 1.0 - bad / CAST(n AS DOUBLE) < 1.0 THEN 'WARN' ELSE 'PASS' END"
    )
    return _aggregated(view, f"{column} IS NULL", _result(f"completeness_{column}", "completeness", status, "n", "bad"))


def _range(view: str, sensor: str, bounds: SensorRange) -> str:
    row = _result(f"range_{sensor}", "range", _graded("bad", "n", "5.0"), "n", "bad")
    return _aggregated(view, V.sql_outside(sensor, bounds), row)


def _duplicate(view: str, keys: str) -> str:
    row = _result("duplicate_records", "duplicate", "CASE WHEN bad = 0 THEN 'PASS' ELSE 'FAIL' END", "n", "bad")
    return (
        f"{row} FROM (SELECT count(*) AS n, count_if(c > 1) AS bad "
        f"FROM (SELECT count(*) OVER (PARTITION BY {keys}) AS c FROM {view}))"
    )


def _gap(view: str, order: str) -> str:
    row = _result("cycle_gaps", "cycle_gap", "CASE WHEN bad = 0 THEN 'PASS' ELSE 'WARN' END", "n", "bad")
    return f"{row} FROM (SELECT count(*) AS n, count_if(g) AS bad FROM (SELECT {V.sql_gap(order)} AS g FROM {view}))"


def _spikes(view: str, sensors, rule: SpikeRule, order: str) -> list[str]:
    flags = ", ".join(f"{V.sql_spike(s, rule, order)} AS {s}" for s in sensors)
    counts = ", ".join(f"count_if({s}) AS {s}" for s in sensors)
    source = f"(SELECT count(*) AS n, {counts} FROM (SELECT {flags} FROM {view}))"
    return [f"{_result(f'spike_{s}', 'spike', _graded(s, 'n', '2.0'), 'n', s)} FROM {source}" for s in sensors]


def _freshness(view: str, layer: str, hours: int, column: str = "ingested_at", now: str = NOW_SQL) -> str:
    age = f"(epoch_us({now}) - epoch_us(newest)) / 3600000000.0"
    status = f"CASE WHEN newest IS NULL THEN 'FAIL' WHEN {age} <= {hours} THEN 'PASS' WHEN {age} <= {2 * hours} THEN 'WARN' ELSE 'FAIL' END"
    row = _result(f"freshness_{layer}", "freshness", status, "CASE WHEN newest IS NULL THEN 0 ELSE n END", "0")
    return f"{row} FROM (SELECT count(*) AS n, max({column}) AS newest FROM {view})"


def _all(*selects: str) -> str:
    return "\nUNION ALL\n".join(selects)


CRITICAL = ("unit_id", "cycle", "operational_setting_1", "operational_setting_2", "operational_setting_3")


@query("required_columns", with_ctes(V.DAILY) + _schema("daily")[0])
def required_columns(spark, sf):
    df = V.daily(spark, sf)
    return _plain(Q.collect_results(df, [Q.required_columns(df)]))


@query("column_types", "WITH lines AS (SELECT * FROM lineitem) " + _schema("lines", "'FAIL'", ["column_types"])[0])
def column_types(spark, sf):
    lines = V.table(spark, sf, "lineitem").select(F.col("l_quantity").alias("unit_id"), "l_orderkey")
    return _plain(Q.collect_results(lines, [Q.column_types(lines)]))


@query("unexpected_columns", "WITH lines AS (SELECT * FROM lineitem) " + _schema("lines", "'WARN'", ["unexpected_columns"])[0])
def unexpected_columns(spark, sf):
    lines = V.table(spark, sf, "lineitem")
    return _plain(Q.collect_results(lines, [Q.unexpected_columns(lines)]))


@query("null_counts", with_ctes(V.NULLS) + "SELECT " + ", ".join(f"CAST(count_if({c} IS NULL) AS BIGINT) AS {c}" for c in FOUR) + " FROM nulls")
def null_counts(spark, sf):
    return V.nulls(spark, sf).agg(*(F.count_if(F.col(c).isNull()).alias(c) for c in FOUR))


@query("null_critical", with_ctes(V.NULLS) + _all(*(_nulls("nulls", c) for c in ("unit_id", "cycle", "sensor_04"))))
def null_critical(spark, sf):
    df = V.nulls(spark, sf)
    return _plain(Q.collect_results(df, [Q.null_check(df, c) for c in ("unit_id", "cycle", "sensor_04")]))


@query("sensor_completeness", with_ctes(V.NULLS) + _all(*(_completeness("nulls", c) for c in FOUR)))
def sensor_completeness(spark, sf):
    return _plain(Q.collect_results(V.nulls(spark, sf), [Q.completeness_check(c) for c in FOUR]))


@query(
    "label_completeness",
    "WITH left_labels AS (SELECT d.doc_id, l.quality, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)) "
    + _all(_completeness("left_labels", "quality"), _completeness("left_labels", "doc_id")),
)
def label_completeness(spark, sf):
    joined = V.table(spark, sf, "documents").select("doc_id").join(V.table(spark, sf, "labels"), "doc_id", "left")
    return _plain(Q.collect_results(joined, [Q.completeness_check(c) for c in ("quality", "doc_id")]))


@query("duplicates", with_ctes(V.HOURLY) + _duplicate("hourly", "unit_id, cycle, dataset_id"))
def duplicates(spark, sf):
    return _plain(Q.duplicate_check(V.hourly(spark, sf)))


@query(
    "duplicate_rows",
    "SELECT l_orderkey, l_linenumber, l_partkey FROM (SELECT *, count(*) OVER (PARTITION BY l_orderkey, l_linenumber) AS n "
    "FROM lineitem) WHERE n > 1",
)
def duplicate_rows(spark, sf):
    lines = V.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    return Q.duplicate_rows(lines, ["l_orderkey", "l_linenumber"])


@query("sensor_ranges", with_ctes(V.DAILY) + _all(*(_range("daily", s, b) for s, b in V.RANGES.items())))
def sensor_ranges(spark, sf):
    return _plain(Q.collect_results(V.daily(spark, sf), Q.range_checks(V.daily(spark, sf), V.RANGES)))


def _violations_sql(columns) -> str:
    return with_ctes(V.DAILY) + _all(
        *(
            f"SELECT unit_id, cycle, dataset_id, '{s}' AS violated_sensor, {columns(s, b)} FROM daily WHERE {V.sql_outside(s, b)}"
            for s, b in V.RANGES.items()
        )
    )


@query(
    "range_violations",
    _violations_sql(
        lambda s, b: f"{r(s, 'value')}, CAST({b.min} AS DOUBLE) AS range_min, CAST({b.max} AS DOUBLE) AS range_max"
    ),
)
def range_violations(spark, sf):
    return V.rounded(Q.range_violations(V.daily(spark, sf), V.RANGES))


@query(
    "range_violations_wide",
    _violations_sql(
        lambda s, _: ", ".join(r(o, o) if o == s else f"CAST(NULL AS DOUBLE) AS {o}" for o in V.RANGES)
    ),
)
def range_violations_wide(spark, sf):
    return V.rounded(Q.range_violations(V.daily(spark, sf), V.RANGES, shape="wide"))


@query("violations_filter", with_ctes(V.MULTI) + "SELECT unit_id, cycle, dataset_id FROM multi WHERE sensor_03 < 1.5 OR sensor_03 > 104.0")
def violations_filter(spark, sf):
    from fleetlake.functions.columns import outside

    return V.multi(spark, sf).filter(outside("sensor_03", SensorRange(1.5, 104.0))).drop(*FOUR)


@query("cycle_gaps", with_ctes(V.HOURLY) + _gap("hourly", f"{V.UNIT} ORDER BY cycle, source_file, source_row_number"))
def cycle_gaps(spark, sf):
    return _plain(Q.cycle_gaps(V.hourly(spark, sf))[0])


@query(
    "units_with_gaps",
    with_ctes(V.HOURLY) + f"SELECT DISTINCT unit_id FROM (SELECT unit_id, {V.sql_gap()} AS g FROM hourly) WHERE g",
)
def units_with_gaps(spark, sf):
    return Q.units_with_gaps(Q.cycle_gaps(V.hourly(spark, sf))[1])


@query("freshness", with_ctes(V.DAILY) + _all(_freshness("daily", "bronze", 24), _freshness("daily", "gold", 48)))
def freshness(spark, sf):
    df = V.daily(spark, sf)
    return _plain(Q.collect_results(df, [Q.freshness_check(df, "bronze", NOW), Q.freshness_check(df, "gold", NOW)]))


@query(
    "freshness_of_events",
    _all(*(_freshness("events", layer, h, "ts", "TIMESTAMP '2024-02-01 00:00:00'") for layer, h in (("bronze", 24), ("gold", 48)))),
)
def freshness_of_events(spark, sf):
    df, now = V.table(spark, sf, "events"), datetime(2024, 2, 1)
    return _plain(Q.collect_results(df, [Q.freshness_check(df, x, now, column="ts") for x in ("bronze", "gold")]))


SPIKE_CHECKS = _spikes("multi", FOUR, V.SPIKES, V.SERIES)


@query("spikes", with_ctes(V.MULTI) + _all(*SPIKE_CHECKS))
def spikes(spark, sf):
    return _plain(Q.series_results(V.multi(spark, sf), FOUR, V.SPIKES, gaps=False))


@query(
    "any_spike_filter",
    with_ctes(V.CLEAN)
    + f"SELECT dataset_id, unit_id, cycle, spike_sensor_02 FROM (SELECT *, {V.sql_spike('sensor_02', SpikeRule(20, 3.0))} "
    "AS spike_sensor_02 FROM clean) WHERE spike_sensor_02",
)
def any_spike_filter(spark, sf):
    found = Q.spike_rows(V.clean(spark, sf), ["sensor_02"], SpikeRule(20, 3.0))
    return found.select("dataset_id", "unit_id", "cycle", "spike_sensor_02")


SUITE = Settings(ranges=V.RANGES, spikes=V.SPIKES)
DAILY_KEYS = "unit_id, cycle, dataset_id"


BRONZE_SQL = with_ctes(V.FULL) + _all(
    *_schema("full_readings"),
    *(_nulls("full_readings", c) for c in CRITICAL),
    *(_completeness("full_readings", s) for s in SENSOR_COLUMNS),
    _duplicate("full_readings", DAILY_KEYS),
    _gap("full_readings", V.SERIES),
    *(_range("full_readings", s, b) for s, b in V.RANGES.items()),
    _freshness("full_readings", "bronze", 24),
    *_spikes("full_readings", SENSOR_COLUMNS, V.SPIKES, V.SERIES),
)


@query("validate_bronze", BRONZE_SQL)
def validate_bronze(spark, sf):
    return _plain(Q.validate_bronze(V.full(spark, sf), "run-1", NOW, SUITE))


@query(
    "validate_silver",
    with_ctes(*L.SILVER_CTES, f"stamped AS (SELECT *, {NOW_SQL} AS silver_processed_at FROM silver)")
    + _all(
        *_schema("silver"),
        *(_nulls("silver", c) for c in CRITICAL),
        *(_completeness("silver", s) for s in SENSOR_COLUMNS),
        _freshness("stamped", "silver", 24, "silver_processed_at"),
    ),
)
def validate_silver(spark, sf):
    from fleetlake.operators.silver import to_silver

    clean = to_silver(V.daily(spark, sf), L.SETTINGS, NOW)
    return _plain(Q.validate_silver(clean, "run-1", NOW))


GOLD_ROW = _result("gold_not_empty", "completeness", "CASE WHEN n > 0 THEN 'PASS' ELSE 'FAIL' END", "n", "0")


SHARED_CTE = """shared AS (SELECT dataset_id, unit_id, cycle FROM clean
  UNION ALL SELECT 'FD009' AS dataset_id, unit_id, cycle FROM clean)"""


@query(
    "validate_gold",
    with_ctes(V.CLEAN, SHARED_CTE)
    + _all(f"{GOLD_ROW} FROM (SELECT count(*) AS n FROM shared)", _duplicate("shared", "unit_id, cycle, dataset_id")),
)
def validate_gold(spark, sf):
    """A table in which every unit id belongs to two data sets, as unit ids do."""
    clean = V.clean(spark, sf)
    return _plain(Q.validate_gold(clean.unionByName(clean.withColumn("dataset_id", F.lit("FD009"))), "run-1", NOW))


STATUS_SQL = "CASE WHEN value < 100 THEN 'PASS' WHEN value < 300 THEN 'WARN' ELSE 'FAIL' END"


def event_results(spark, sf):
    """Check results of many runs: one per event, its user being the run."""
    value = F.col("value")
    status = F.when(value < 100, "PASS").when(value < 300, "WARN").otherwise("FAIL")
    return V.table(spark, sf, "events").select(
        F.concat(F.lit("result-"), F.col("event_id").cast("string")).alias("quality_result_id"),
        F.concat(F.lit("run-"), F.col("user_id").cast("string")).alias("pipeline_run_id"),
        F.col("event_type").alias("check_name"),
        status.alias("status"),
        F.col("ts").cast("timestamp").alias("checked_at"),
    )


RESULTS_CTE = f"""results AS (
  SELECT 'result-' || event_id AS quality_result_id, 'run-' || user_id AS pipeline_run_id, event_type AS check_name,
         {STATUS_SQL} AS status, ts AS checked_at FROM events)"""


@query(
    "status_tally",
    with_ctes(RESULTS_CTE)
    + "SELECT count(*) AS total_checks, CAST(count_if(status = 'PASS') AS BIGINT) AS passed, "
    "CAST(count_if(status = 'WARN') AS BIGINT) AS warned, CAST(count_if(status = 'FAIL') AS BIGINT) AS failed, "
    "round(count_if(status = 'PASS') / CAST(count(*) AS DOUBLE) * 100.0, 2) AS pass_percentage FROM results",
)
def status_tally(spark, sf):
    return Q.status_tally(event_results(spark, sf))


@query(
    "model_tests",
    """SELECT 'not_null' AS test_name, 'o_orderkey' AS column_name, count_if(o_orderkey IS NULL) AS failures FROM orders
UNION ALL SELECT 'unique', 'o_orderkey', (SELECT count(*) FROM (SELECT o_orderkey FROM orders GROUP BY ALL HAVING count(*) > 1))
UNION ALL SELECT 'unique', 'o_custkey', (SELECT count(*) FROM (SELECT o_custkey FROM orders GROUP BY ALL HAVING count(*) > 1))""",
)
def model_tests(spark, sf):
    return Q.model_tests(V.table(spark, sf, "orders"), ["o_orderkey"], ["o_orderkey", "o_custkey"])
