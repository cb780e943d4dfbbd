"""Queries for the marts, the ledger and the serving reads."""

from __future__ import annotations

from pyspark.sql import functions as F

from fleetlake.operators import ledger as G
from fleetlake.operators import serving as S
from fleetlake.plans import marts as M
from fleetlake.queries import checks as C
from fleetlake.queries import layers as L
from fleetlake.queries import views as V
from fleetlake.queries.registry import query
from fleetlake.queries.views import r, rounded, with_ctes
from fleetlake.session import scratch_path
from fleetlake.settings import SENSOR_COLUMNS, SETTING_COLUMNS

STAGED = "staged AS (SELECT * FROM silver WHERE record_quality_status <> 'QUARANTINED')"
STAGED_CTES = (*L.SILVER_CTES, STAGED)


def staged(spark, sf):
    return M.stage_readings(L.silver(spark, sf))


@query("stage_readings", with_ctes(*STAGED_CTES) + f"SELECT dataset_id, {L.READ_SQL}, {', '.join(L.FLAGS)} FROM staged")
def stage_readings(spark, sf):
    return L._silver_columns(staged(spark, sf))


ROLLED = ", ".join(
    r(V.sql_rolling(s, stat, n, False), f"{s}_rolling_{stat}_{n}") for s, pairs in M.ROLLING.items() for stat, n in pairs
)


@query("int_sensor_rolling_metrics", with_ctes(*STAGED_CTES) + f"SELECT unit_id, cycle, dataset_id, {ROLLED} FROM staged")
def int_sensor_rolling_metrics(spark, sf):
    return rounded(M.rolling_metrics(staged(spark, sf), profile=V.daily_units(spark, sf)))


CHANGED = ", ".join(f"{V.sql_change(s)} AS {s}_rate_of_change" for s in M.CHANGING)
TRENDS = ", ".join(r(f"avg({s}_rate_of_change) {V.frame(10)}", f"{s}_degradation_trend") for s in M.TRENDING)


@query(
    "int_equipment_degradation",
    with_ctes(*STAGED_CTES, f"changed AS (SELECT *, {CHANGED}, lead(sensor_02, 1) OVER ({V.SERIES}) AS next_02 FROM staged)")
    + f"SELECT unit_id, cycle, dataset_id, {r('sensor_02', 'sensor_02')}, "
    + ", ".join(r(f"{s}_rate_of_change", f"{s}_rate_of_change") for s in M.CHANGING)
    + f", {r('next_02', 'sensor_02_next_value')}, {TRENDS}, "
    + r(f"CAST(cycle AS DOUBLE) / CAST(max(cycle) OVER ({V.UNIT}) AS DOUBLE)", "lifecycle_ratio")
    + " FROM changed",
)
def int_equipment_degradation(spark, sf):
    return rounded(M.equipment_degradation(staged(spark, sf), profile=V.daily_units(spark, sf)))


DIM_CTE = f"dim AS ({L.DIM_SQL.format('staged')})"


@query(
    "fact_sensor_readings",
    with_ctes(*STAGED_CTES, DIM_CTE)
    + "SELECT e.equipment_key, s.unit_id, s.dataset_id, s.cycle, "
    + ", ".join(r(f"s.{c}", c) for c in (*SETTING_COLUMNS, *SENSOR_COLUMNS))
    + ", s.record_quality_status FROM staged s JOIN dim e ON s.unit_id = e.unit_id AND s.dataset_id = e.dataset_id",
)
def fact_sensor_readings(spark, sf):
    from fleetlake.operators.health import dim_equipment

    readings = staged(spark, sf)
    return rounded(M.fact_sensor_readings(readings, dim_equipment(readings)).drop("ingested_at", "silver_processed_at"))


@query(
    "ranked_equipment_health",
    with_ctes(V.MULTI, "scored AS (SELECT *, CASE WHEN unit_id % 9 > 0 THEN sensor_03 END AS health_score FROM multi)")
    + f"""SELECT unit_id || '_' || dataset_id AS equipment_key, cycle, {r('health_score', 'health_score')},
  {r('100.0 - health_score', 'degradation_score')}, max(cycle) OVER ({V.UNIT}) - cycle AS estimated_rul,
  'LOW' AS risk_level, row_number() OVER (ORDER BY health_score ASC NULLS LAST, unit_id || '_' || dataset_id, cycle)
  AS maintenance_priority_rank FROM scored""",
)
def ranked_equipment_health(spark, sf):
    from fleetlake.operators.series import remaining_useful_life

    score = F.when(F.col("unit_id") % 9 > 0, F.col("sensor_03"))
    health = M.keyed(remaining_useful_life(V.multi(spark, sf))).select(
        "equipment_key",
        "cycle",
        score.alias("health_score"),
        (100.0 - score).alias("degradation_score"),
        "remaining_useful_life",
        F.lit("LOW").alias("risk_level"),
        F.lit(None).cast("timestamp").alias("calculated_at"),
    )
    return rounded(M.ranked_health(health).drop("calculated_at"))


COUNTS_CTE = """counts AS (
  SELECT dataset_id, count(*) AS total_records,
    CAST(count_if(record_quality_status = 'VALID') AS BIGINT) AS valid_records,
    CAST(count_if(record_quality_status = 'WARNING') AS BIGINT) AS warning_records,
    CAST(count_if(record_quality_status = 'QUARANTINED') AS BIGINT) AS quarantined_records,
    CAST(count_if(has_cycle_gap) AS BIGINT) AS cycle_gap_count,
    CAST(count_if(has_sensor_range_violation) AS BIGINT) AS range_violation_count,
    CAST(count_if(has_sensor_spike) AS BIGINT) AS spike_count,
    round(count_if(record_quality_status = 'VALID') / nullif(CAST(count(*) AS DOUBLE), 0) * 100.0, 2) + 0.0
      AS quality_pass_percentage
  FROM silver GROUP BY dataset_id)"""


@query("dataset_quality_counts", with_ctes(*L.SILVER_CTES, COUNTS_CTE) + "SELECT * FROM counts")
def dataset_quality_counts(spark, sf):
    return M.dataset_quality_counts(L.silver(spark, sf))


@query(
    "quality_pass_pct",
    with_ctes(*L.SILVER_CTES, COUNTS_CTE) + "SELECT dataset_id, quality_pass_percentage FROM counts",
)
def quality_pass_pct(spark, sf):
    return M.dataset_quality_counts(L.silver(spark, sf)).select("dataset_id", "quality_pass_percentage")


FLEET_SQL = """count(*) AS total_equipment_units, round(avg(health_score), 6) + 0.0 AS avg_health_score,
  CAST(count_if(risk_level IN ('HIGH', 'CRITICAL')) AS BIGINT) AS high_risk_equipment_count,
  CAST(count_if(risk_level = 'CRITICAL') AS BIGINT) AS critical_equipment_count"""


@query(
    "dataset_quality_health_summary",
    with_ctes(*L.SUMMARY_CTES, COUNTS_CTE) + f"SELECT counts.*, f.* FROM counts, (SELECT {FLEET_SQL} FROM summary) f",
)
def dataset_quality_health_summary(spark, sf):
    return rounded(
        M.attach_fleet(M.dataset_quality_counts(L.silver(spark, sf)), L.summary_table(spark, sf))
    )


# A summary of units over events: cheap, with scores over the whole scale
UNIT_SUMMARY = """unit_summary AS (
  SELECT user_id || '_FD00' || CAST(user_id % 4 + 1 AS VARCHAR) AS equipment_key, user_id AS unit_id,
         least(max(value), 100.0) AS health_score, count(*) AS estimated_rul,
         CASE WHEN max(value) < 60 THEN 'CRITICAL' WHEN max(value) < 80 THEN 'HIGH' ELSE 'LOW' END AS risk_level,
         CAST(count_if(value > 50) AS BIGINT) AS sensors_in_warning_state FROM events GROUP BY user_id)"""


def unit_summary(spark, sf):
    value = F.max("value")
    return (
        V.table(spark, sf, "events")
        .groupBy(F.col("user_id").alias("unit_id"))
        .agg(
            F.least(value, F.lit(100.0)).alias("health_score"),
            F.count(F.lit(1)).alias("estimated_rul"),
            F.when(value < 60, "CRITICAL").when(value < 80, "HIGH").otherwise("LOW").alias("risk_level"),
            F.count_if(F.col("value") > 50).alias("sensors_in_warning_state"),
        )
        .withColumn("dataset_id", F.concat(F.lit("FD00"), (F.col("unit_id") % 4 + 1).cast("string")))
        .transform(M.keyed)
        .drop("dataset_id")
    )


@query(
    "fleet_metrics",
    with_ctes(UNIT_SUMMARY)
    + """SELECT count(*) AS total_units, round(avg(health_score), 1) AS avg_health_score,
  CAST(count_if(risk_level IN ('HIGH', 'CRITICAL')) AS BIGINT) AS high_risk_count,
  CAST(count_if(risk_level = 'CRITICAL') AS BIGINT) AS critical_count FROM unit_summary""",
)
def fleet_metrics(spark, sf):
    return S.fleet_metrics(unit_summary(spark, sf))


@query(
    "health_histogram",
    """SELECT bin, (bin - 1) * 5.0::DOUBLE AS bin_start, count(*) AS units FROM (
  SELECT least(CAST(floor(least(value, 100.0) / 5.0) AS BIGINT) + 1, 20) AS bin FROM events) GROUP BY bin""",
)
def health_histogram(spark, sf):
    scored = V.table(spark, sf, "events").select(F.least(F.col("value"), F.lit(100.0)).alias("health_score"))
    return S.health_histogram(scored)


@query(
    "priority_rank",
    with_ctes(UNIT_SUMMARY)
    + f"""SELECT row_number() OVER (ORDER BY health_score ASC NULLS FIRST, unit_id, equipment_key) AS priority_rank,
  unit_id, {r('health_score', 'health_score')}, estimated_rul, risk_level, sensors_in_warning_state FROM unit_summary""",
)
def priority_rank(spark, sf):
    return rounded(S.maintenance_priority(unit_summary(spark, sf)))


@query(
    "maintenance_topk",
    with_ctes(UNIT_SUMMARY)
    + f"SELECT unit_id, {r('health_score', 'health_score')}, risk_level FROM unit_summary "
    "ORDER BY health_score NULLS FIRST, unit_id LIMIT 10",
)
def maintenance_topk(spark, sf):
    return rounded(S.maintenance_topk(unit_summary(spark, sf), 10).select("unit_id", "health_score", "risk_level"))


@query(
    "unit_drilldown",
    with_ctes(V.DAILY) + f"SELECT {L.READ_SQL}, source_row_number FROM daily WHERE unit_id = 7 AND dataset_id = 'FD004'",
)
def unit_drilldown(spark, sf):
    rows = S.unit_readings(V.daily(spark, sf), 7, "FD004")
    return rounded(rows.select("unit_id", "cycle", *L.NUMBERS, "source_row_number"))


@query(
    "unit_key_prefix",
    with_ctes(V.CLEAN)
    + "SELECT unit_id || '_' || dataset_id AS equipment_key, cycle FROM clean WHERE (unit_id || '_' || dataset_id) LIKE '1%'",
)
def unit_key_prefix(spark, sf):
    return S.units_with_prefix(M.keyed(V.clean(spark, sf)), "1").select("equipment_key", "cycle")


@query("sensor_columns_select", with_ctes(V.MULTI) + "SELECT unit_id, cycle, " + ", ".join(r(s, s) for s in V.FOUR) + " FROM multi")
def sensor_columns_select(spark, sf):
    return rounded(S.select_sensors(V.multi(spark, sf)))


@query(
    "grouped_mean_std",
    "SELECT l_suppkey AS unit_id, " + r("avg(l_quantity)", "sensor_02_mean") + ", "
    + r("stddev_samp(l_extendedprice / 997.0)", "sensor_03_std")
    + " FROM lineitem GROUP BY l_suppkey",
)
def grouped_mean_std(spark, sf):
    return rounded(S.unit_grouped_stats(V.multi(spark, sf)))


@query("status_filter", with_ctes(C.RESULTS_CTE) + "SELECT quality_result_id, check_name FROM results WHERE status = 'FAIL'")
def status_filter(spark, sf):
    return S.with_status(C.event_results(spark, sf), "FAIL").select("quality_result_id", "check_name")


@query("status_counts", with_ctes(C.RESULTS_CTE) + "SELECT status, count(*) AS checks FROM results GROUP BY status")
def status_counts(spark, sf):
    return S.status_counts(C.event_results(spark, sf))


@query("max_timestamp", "SELECT epoch_us(max(ts)) AS newest FROM events")
def max_timestamp(spark, sf):
    return V.table(spark, sf, "events").agg(F.unix_micros(F.max(F.col("ts").cast("timestamp"))).alias("newest"))


@query("distinct_units", "SELECT count(DISTINCT user_id) AS units FROM events")
def distinct_units(spark, sf):
    return V.table(spark, sf, "events").agg(F.count_distinct("user_id").alias("units"))


@query("distinct_unit_list", "SELECT DISTINCT user_id AS unit_id FROM events")
def distinct_unit_list(spark, sf):
    return V.table(spark, sf, "events").select(F.col("user_id").alias("unit_id")).distinct().orderBy("unit_id")


@query(
    "concat_vertical",
    with_ctes(V.HOURLY) + "SELECT unit_id, cycle, source_row_number FROM hourly WHERE dataset_id = 'FD001' "
    "UNION ALL SELECT unit_id, cycle, source_row_number FROM hourly WHERE dataset_id <> 'FD001'",
)
def concat_vertical(spark, sf):
    df = V.hourly(spark, sf)
    one, rest = df.filter("dataset_id = 'FD001'"), df.filter("dataset_id <> 'FD001'")
    return one.unionByName(rest).select("unit_id", "cycle", "source_row_number")


@query(
    "concat_diagonal",
    "SELECT user_id AS unit_id, value AS sensor_02, CAST(NULL AS DOUBLE) AS sensor_03 FROM events "
    "UNION ALL SELECT l_suppkey, NULL, l_quantity FROM lineitem",
)
def concat_diagonal(spark, sf):
    one = V.table(spark, sf, "events").select(F.col("user_id").alias("unit_id"), F.col("value").alias("sensor_02"))
    other = V.table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("unit_id"), F.col("l_quantity").alias("sensor_03"))
    return one.unionByName(other, allowMissingColumns=True)


# --- ledger -----------------------------------------------------------------


def order_runs(spark, sf):
    """Run events: every order starts a run, and most of them end it."""
    orders = V.table(spark, sf, "orders")
    run = F.concat(F.lit("run-"), F.col("o_orderkey").cast("string")).alias("pipeline_run_id")
    start = F.col("o_orderdate").cast("timestamp")
    end = F.timestamp_micros(F.unix_micros(start) + (F.col("o_custkey") % 5000 + 1) * 1_000_000)
    begun = orders.select(
        run,
        F.col("o_orderpriority").alias("pipeline_name"),
        start.alias("started_at"),
        F.lit("RUNNING").alias("status"),
        start.alias("event_at"),
    )
    ended = orders.filter("o_orderstatus <> 'O'").select(
        run,
        end.alias("completed_at"),
        F.when(F.col("o_orderstatus") == "F", "SUCCESS").otherwise("FAILED").alias("status"),
        F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderkey") % 1000).alias("records_ingested"),
        F.when(F.col("o_orderstatus") == "P", "stopped").alias("error_message"),
        end.alias("event_at"),
    )
    return begun.unionByName(ended, allowMissingColumns=True)


RUNS_CTE = """runs AS (
  SELECT 'run-' || o_orderkey AS pipeline_run_id, o_orderpriority AS pipeline_name, epoch_us(o_orderdate) AS started,
    CASE WHEN o_orderstatus <> 'O' THEN epoch_us(o_orderdate) + (o_custkey % 5000 + 1) * 1000000 END AS completed,
    CASE o_orderstatus WHEN 'O' THEN 'RUNNING' WHEN 'F' THEN 'SUCCESS' ELSE 'FAILED' END AS status,
    CASE WHEN o_orderstatus <> 'O' AND o_orderkey % 3 > 0 THEN o_orderkey % 1000 ELSE 0 END AS records_ingested,
    CASE WHEN o_orderstatus = 'P' THEN 'stopped' END AS error_message FROM orders)"""


def _run_columns(runs):
    return runs.select(
        "pipeline_run_id",
        "pipeline_name",
        F.unix_micros("started_at").alias("started"),
        F.unix_micros("completed_at").alias("completed"),
        "status",
        "records_ingested",
        "error_message",
    )


@query("run_states", with_ctes(RUNS_CTE) + "SELECT * FROM runs")
def run_states(spark, sf):
    return _run_columns(G.run_states(order_runs(spark, sf)))


@query("ledger_compaction", with_ctes(RUNS_CTE) + "SELECT * FROM runs")
def ledger_compaction(spark, sf):
    """Run events in many files, compacted twice while others arrive."""
    ledger = G.Ledger(spark, scratch_path(spark, "ledger"))
    events = order_runs(spark, sf)
    for part in range(3):
        mine = F.pmod(F.xxhash64(*events.columns), F.lit(3)) == part
        ledger.append("pipeline_runs", events.filter(mine).repartition(20))
        if part < 2:
            ledger.compact("pipeline_runs")
    return _run_columns(ledger.runs())


@query("recent_runs", with_ctes(RUNS_CTE) + "SELECT * FROM runs ORDER BY started DESC, pipeline_run_id LIMIT 50")
def recent_runs(spark, sf):
    return _run_columns(G.recent_runs(G.run_states(order_runs(spark, sf))))


def line_tasks(spark, sf):
    """Task events: line numbers of an order are tasks, some started twice."""
    lines = V.table(spark, sf, "lineitem")
    start = F.col("l_shipdate").cast("timestamp")
    end = F.timestamp_micros(F.unix_micros(start) + (F.col("l_quantity") * 60_000_000).cast("bigint") + F.col("l_partkey"))
    keys = [
        F.concat(F.lit("run-"), F.col("l_orderkey").cast("string")).alias("pipeline_run_id"),
        F.concat(F.lit("task-"), F.col("l_linenumber").cast("string")).alias("task_name"),
    ]
    begun = lines.select(
        *keys, start.alias("started_at"), F.lit("RUNNING").alias("status"),
        start.alias("event_at"), F.lit(G.BEGUN).alias("sequence"),
    )
    ended = lines.select(
        *keys, end.alias("completed_at"), F.lit("SUCCESS").alias("status"), F.col("l_partkey").alias("records_processed"),
        end.alias("event_at"), F.lit(G.ENDED).alias("sequence"),
    )
    return begun.unionByName(ended, allowMissingColumns=True)


TASKS_CTE = """line_events AS (
  SELECT 'run-' || l_orderkey AS pipeline_run_id, 'task-' || l_linenumber AS task_name, epoch_us(l_shipdate) AS s,
    epoch_us(l_shipdate) + CAST(l_quantity * 60000000 AS BIGINT) + l_partkey AS e, l_partkey FROM lineitem),
ended AS (SELECT pipeline_run_id, task_name, e, l_partkey FROM (SELECT *, row_number() OVER (
    PARTITION BY pipeline_run_id, task_name ORDER BY e DESC, l_partkey DESC) AS n FROM line_events) WHERE n = 1),
begun AS (SELECT pipeline_run_id, task_name, max(s) AS s FROM line_events GROUP BY ALL),
tasks AS (
  SELECT pipeline_run_id, task_name, b.s AS started, CASE WHEN e.e >= b.s THEN e.e END AS completed,
    CASE WHEN e.e >= b.s THEN 'SUCCESS' ELSE 'RUNNING' END AS status, l_partkey AS records_processed,
    round(CASE WHEN e.e >= b.s THEN (e.e - b.s) / 1000000.0 END, 6) + 0.0 AS duration_seconds
  FROM ended e JOIN begun b USING (pipeline_run_id, task_name))"""


def _task_columns(tasks):
    return rounded(
        tasks.select(
            "pipeline_run_id",
            "task_name",
            F.unix_micros("started_at").alias("started"),
            F.unix_micros("completed_at").alias("completed"),
            "status",
            "records_processed",
            "duration_seconds",
        )
    )


@query("task_states", with_ctes(TASKS_CTE) + "SELECT * FROM tasks")
def task_states(spark, sf):
    return _task_columns(G.task_states(line_tasks(spark, sf)))


@query("task_metrics", with_ctes(TASKS_CTE) + "SELECT * FROM tasks ORDER BY started DESC, pipeline_run_id, task_name LIMIT 100")
def task_metrics(spark, sf):
    return _task_columns(G.recent_task_metrics(G.task_states(line_tasks(spark, sf))))


@query("task_metrics_of_run", with_ctes(TASKS_CTE) + "SELECT * FROM tasks WHERE pipeline_run_id = 'run-7'")
def task_metrics_of_run(spark, sf):
    return _task_columns(G.recent_task_metrics(G.task_states(line_tasks(spark, sf)), "run-7"))


RECENT = "SELECT quality_result_id, pipeline_run_id, check_name, status FROM results"


def _recent(df):
    return df.select("quality_result_id", "pipeline_run_id", "check_name", "status")


@query("recent_quality_results", with_ctes(C.RESULTS_CTE) + f"{RECENT} ORDER BY checked_at DESC, quality_result_id LIMIT 200")
def recent_quality_results(spark, sf):
    return _recent(G.recent_quality_results(C.event_results(spark, sf)))


@query("quality_results_of_run", with_ctes(C.RESULTS_CTE) + f"{RECENT} WHERE pipeline_run_id = 'run-7'")
def quality_results_of_run(spark, sf):
    return _recent(G.recent_quality_results(C.event_results(spark, sf), "run-7"))


@query(
    "run_quality_rollup",
    with_ctes(C.RESULTS_CTE, RUNS_CTE)
    + """SELECT r.pipeline_run_id, r.status, coalesce(p, 0) AS quality_checks_passed, coalesce(f, 0) AS quality_checks_failed
FROM runs r LEFT JOIN (SELECT pipeline_run_id, CAST(count_if(status = 'PASS') AS BIGINT) AS p,
  CAST(count_if(status = 'FAIL') AS BIGINT) AS f FROM results GROUP BY pipeline_run_id) q USING (pipeline_run_id)""",
)
def run_quality_rollup(spark, sf):
    rolled = G.with_quality_rollup(G.run_states(order_runs(spark, sf)), C.event_results(spark, sf))
    return rolled.select("pipeline_run_id", "status", "quality_checks_passed", "quality_checks_failed")


@query(
    "skip_ingested",
    """WITH candidates AS (SELECT 'doc-' || doc_id AS source_file, sha256(text) AS file_checksum, doc_id FROM documents),
manifest AS (SELECT 'doc-' || l.doc_id AS source_file, sha256(CASE WHEN l.toxic = 1 THEN d.text || '!' ELSE d.text END)
    AS file_checksum, CASE WHEN l.quality = 1 THEN 'SUCCESS' ELSE 'FAILED' END AS status
  FROM labels l JOIN documents d USING (doc_id))
SELECT source_file, file_checksum FROM candidates c WHERE NOT EXISTS (SELECT 1 FROM manifest m
  WHERE m.source_file = c.source_file AND m.file_checksum = c.file_checksum AND m.status = 'SUCCESS')""",
)
def skip_ingested(spark, sf):
    documents, labels = V.table(spark, sf, "documents").select("doc_id", "text"), V.table(spark, sf, "labels")
    name = F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("source_file")
    candidates = documents.select(name, F.sha2("text", 256).alias("file_checksum"))
    changed = F.when(F.col("toxic") == 1, F.concat("text", F.lit("!"))).otherwise(F.col("text"))
    manifest = labels.join(documents, "doc_id").select(
        name,
        F.sha2(changed, 256).alias("file_checksum"),
        F.when(F.col("quality") == 1, "SUCCESS").otherwise("FAILED").alias("status"),
    )
    return G.skip_ingested(candidates, manifest)
