from __future__ import annotations

import json
from datetime import datetime, timedelta

import pytest
from test_layers import NOW, bronze

from fleetlake.operators import quality as Q
from fleetlake.operators.silver import to_silver
from fleetlake.settings import SensorRange, SpikeRule


def one(df, check):
    return Q.collect_results(df, [check]).first()


def test_schema_checks(spark):
    df = bronze(spark)
    assert [r.status for r in Q.collect_results(df, Q.schema_checks(df)).collect()] == ["PASS"] * 3
    missing = one(df, Q.required_columns(df.drop("sensor_01")))
    assert missing.status == "FAIL" and "sensor_01" in missing.details and missing.records_checked == 0
    bare = df.drop("source_file", "dataset_id", "ingested_at", "pipeline_run_id", "source_row_number")
    assert one(bare, Q.required_columns(bare, include_metadata=False)).status == "PASS"
    text = df.withColumn("unit_id", df.unit_id.cast("string"))
    assert one(text, Q.column_types(text)).status == "FAIL"
    extra = df.withColumn("other", df.unit_id)
    assert one(extra, Q.unexpected_columns(extra)).status == "WARN"


@pytest.mark.parametrize("nulls,status", [(0, "PASS"), (4, "WARN"), (5, "WARN"), (6, "FAIL")])
def test_completeness_thresholds(spark, nulls, status):
    df = spark.createDataFrame([(None if i < nulls else 1.0,) for i in range(100)], "sensor_01 double")
    row = one(df, Q.completeness_check("sensor_01"))
    assert (row.status, row.failed_records, row.failure_percentage) == (status, nulls, float(nulls))


def test_completeness_of_nothing_fails(spark):
    empty = spark.createDataFrame([], "sensor_01 double, unit_id long")
    assert one(empty, Q.completeness_check("sensor_01")).status == "FAIL"
    assert one(empty, Q.null_check(empty, "unit_id")).status == "PASS"
    assert one(empty, Q.null_check(empty, "cycle")).status == "FAIL"


def test_duplicate_check(spark):
    rows = [(1, 1, "FD001"), (1, 1, "FD001"), (1, 2, "FD001"), (2, 1, "FD001"), (2, 2, "FD001")]
    df = spark.createDataFrame(rows, "unit_id long, cycle long, dataset_id string")
    row = Q.duplicate_check(df).first()
    assert (row.status, row.failed_records, row.records_checked, row.failure_percentage) == ("FAIL", 2, 5, 40.0)
    assert Q.duplicate_check(df.dropDuplicates()).first().status == "PASS"
    assert Q.duplicate_check(df, ["other"]).first().status == "WARN"
    assert Q.duplicate_rows(df).count() == 2


def test_gap_check(spark):
    rows = [(1, 1), (1, 2), (1, 5), (2, 1), (2, 4)]
    result, gaps = Q.cycle_gaps(spark.createDataFrame(rows, "unit_id long, cycle long"))
    row = result.first()
    assert (row.status, row.failed_records, row.records_checked) == ("WARN", 2, 5)
    assert json.loads(row.details) == {"gaps": 2, "units": 2}
    assert [r.unit_id for r in Q.units_with_gaps(gaps).collect()] == [1, 2]
    whole = spark.createDataFrame([(1, 1), (1, 2)], "unit_id long, cycle long")
    assert Q.cycle_gaps(whole)[0].first().status == "PASS"
    assert Q.series_results(whole.drop("cycle"), spikes=False).first().status == "FAIL"


@pytest.mark.parametrize("bad,status", [(0, "PASS"), (4, "WARN"), (5, "FAIL")])
def test_range_check(spark, bad, status):
    rows = [(1, i, 700.0 if i < bad else 640.0) for i in range(100)]
    df = spark.createDataFrame(rows, "unit_id long, cycle long, sensor_02 double")
    ranges = {"sensor_02": SensorRange(630, 640), "sensor_99": SensorRange(0, 1)}
    (row,) = Q.collect_results(df, Q.range_checks(df, ranges)).collect()
    assert (row.status, row.failed_records) == (status, bad)
    assert Q.range_violations(df, ranges).count() == bad
    assert Q.range_violations(df, {}).count() == 0


def test_spike_check_grades(spark):
    rows = [(1, i, 100.0 if i == 60 else float(i % 3)) for i in range(1, 101)]
    df = spark.createDataFrame(rows, "unit_id long, cycle long, sensor_02 double")
    row = Q.series_results(df, ["sensor_02"], SpikeRule(20, 3.0), gaps=False).first()
    assert (row.check_name, row.status, row.failed_records) == ("spike_sensor_02", "WARN", 1)
    assert Q.spike_rows(df, ["sensor_02"], SpikeRule(20, 3.0)).first().cycle == 60


@pytest.mark.parametrize("hours,status", [(0, "PASS"), (1, "PASS"), (30, "WARN"), (48, "WARN"), (72, "FAIL")])
@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_freshness(spark, hours, status, kind):
    df = spark.createDataFrame([(NOW - timedelta(hours=hours),)], "ingested_at timestamp")
    df = df.withColumn("ingested_at", df.ingested_at.cast(kind))
    assert one(df, Q.freshness_check(df, "bronze", NOW)).status == status
    spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
    try:
        if kind == "timestamp_ntz":
            stamp = datetime(2024, 4, 30, 23)
            naive = spark.sql(f"SELECT timestamp_ntz'{stamp}' AS ingested_at")
            now = datetime.fromisoformat("2024-05-01T00:00:00+00:00")
            assert json.loads(one(naive, Q.freshness_check(naive, "bronze", now)).details)["age_hours"] == 1.0
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_freshness_without_timestamps(spark):
    empty = spark.createDataFrame([], "ingested_at timestamp, name string")
    assert json.loads(one(empty, Q.freshness_check(empty, "bronze", NOW)).details)["rows"] == 0
    assert one(empty, Q.freshness_check(empty, "bronze", NOW, column="other")).status == "FAIL"
    nulls = spark.createDataFrame([(None, "x")], "ingested_at timestamp, name string")
    assert not json.loads(one(nulls, Q.freshness_check(nulls, "bronze", NOW)).details)["stamped"]
    assert one(nulls, Q.freshness_check(nulls, "bronze", NOW, column="name")).status == "WARN"


def test_suites(spark):
    df = bronze(spark)
    results = Q.validate_bronze(df, "run-1", NOW)
    assert results.count() == 74
    assert {r.pipeline_run_id for r in results.collect()} == {"run-1"}
    silver = to_silver(df, now=NOW)
    assert Q.validate_silver(silver, "run-1", NOW).count() == 30
    gold = Q.validate_gold(silver, "run-1", NOW).collect()
    assert [(r.check_name, r.status) for r in gold] == [("gold_not_empty", "PASS"), ("duplicate_records", "PASS")]
    assert Q.validate_gold(silver.limit(0), "run-1", NOW).first().status == "FAIL"
    tally = Q.status_tally(results).first()
    assert tally.total_checks == tally.passed + tally.warned + tally.failed == 74


def test_fail_on(spark):
    with pytest.raises(Q.QualityFailure):
        Q.validate(bronze(spark), "bronze", fail_on="FAIL")
    assert Q.validate(bronze(spark), "gold", fail_on="FAIL").count() == 2
