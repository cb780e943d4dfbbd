from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fleetlake.functions.columns import clip, quality_status, risk_level
from fleetlake.operators import health as H
from fleetlake.operators.features import ml_features
from fleetlake.operators.silver import enforce_types, split_duplicates, to_silver
from fleetlake.operators.skew import flag_copies
from fleetlake.plans.marts import build_marts
from fleetlake.settings import (
    SENSOR_COLUMNS,
    Feature,
    HealthWeights,
    RiskThresholds,
    SensorRange,
    Settings,
    SkewLimits,
    SpikeRule,
)

NOW = datetime(2024, 5, 1)


def bronze(spark, units=2, cycles=3, start=0.0):
    rows = [
        (u, c, 0.0, 0.0, 100.0, *(i * 100.0 + start + c for i in range(1, 22)), "train_FD001.txt", "FD001", NOW, "run", c)
        for u in range(1, units + 1)
        for c in range(1, cycles + 1)
    ]
    schema = (
        "unit_id long, cycle long, operational_setting_1 double, operational_setting_2 double, "
        "operational_setting_3 double, "
        + ", ".join(f"{s} double" for s in SENSOR_COLUMNS)
        + ", source_file string, dataset_id string, ingested_at timestamp, pipeline_run_id string, source_row_number long"
    )
    return spark.createDataFrame(rows, schema)


def test_silver_adds_flags_and_status(spark):
    silver = to_silver(bronze(spark), now=NOW)
    for column in ("has_cycle_gap", "has_sensor_range_violation", "has_sensor_spike", "record_quality_status"):
        assert column in silver.columns
    rows = silver.collect()
    assert len(rows) == 6 and not any(r.has_cycle_gap or r.has_sensor_spike for r in rows)
    assert {r.record_quality_status for r in rows} == {"WARNING"}
    assert {r.silver_processed_at for r in rows} == {NOW}


def test_silver_without_violations_is_valid(spark):
    ranges = {s: SensorRange(0, 1e9) for s in SENSOR_COLUMNS}
    rows = to_silver(bronze(spark), Settings(ranges=ranges), NOW).collect()
    assert {r.record_quality_status for r in rows} == {"VALID"}


def test_silver_has_one_exchange(spark, tmp_path):
    bronze(spark).write.parquet(str(tmp_path / "b"))
    plan = to_silver(spark.read.parquet(str(tmp_path / "b")), now=NOW)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1 and plan.count("Sort [") == 1


def test_silver_of_hot_units_and_hot_copies(spark):
    df = bronze(spark, 2, 60).unionByName(bronze(spark, 1, 5)).unionByName(bronze(spark, 1, 1))
    settings = {"spikes": SpikeRule(10, 2.0)}
    plain = to_silver(df, Settings(**settings), NOW)
    split = to_silver(df, Settings(**settings, limits=SkewLimits(hot_rows=30, chunk_rows=15)), NOW)
    assert plain.exceptAll(split).count() == 0 and split.count() == plain.count() == 115


@pytest.mark.parametrize("limits", [SkewLimits(), SkewLimits(hot_rows=2)])
def test_duplicates_lose_every_copy(spark, limits):
    rows = [(1, 1, "FD001"), (1, 1, "FD001"), (1, 1, "FD001"), (1, 2, "FD001"), (2, 1, "FD001"), (None, 1, "FD001"), (None, 1, "FD001")]
    df = spark.createDataFrame(rows, "unit_id long, cycle long, dataset_id string")
    clean, copies = split_duplicates(df, limits=limits)
    assert clean.count() == 2 and copies.count() == 5
    kept, later = split_duplicates(df, keep="first", limits=limits)
    assert kept.count() == 4 and later.count() == 3
    assert flag_copies(df, ["unit_id"], limits=limits).filter("is_duplicate").count() == 6


def test_duplicates_without_keys_are_clean(spark):
    clean, copies = split_duplicates(spark.createDataFrame([(1,), (1,)], "x long"))
    assert clean.count() == 2 and copies.count() == 0


def test_bad_literal_raises(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|cannot be cast"):
        enforce_types(spark.createDataFrame([("x", "1")], "unit_id string, cycle string")).collect()


def test_null_conditions_fall_through(spark):
    cases = [(None, None, None, "VALID"), (True, None, False, "WARNING"), (False, None, True, "WARNING"),
             (False, True, True, "QUARANTINED"), (None, None, False, "VALID")]
    df = spark.createDataFrame(cases, "gap boolean, violation boolean, spike boolean, want string")
    got = df.select(quality_status(F.col("gap"), F.col("violation"), F.col("spike")).alias("got"), "want").collect()
    assert all(r.got == r.want for r in got)


def test_clip_keeps_null(spark):
    df = spark.createDataFrame([(None,), (-1.0,), (5.0,), (99.0,)], "x double")
    assert [r[0] for r in df.select(clip(F.col("x"), 0, 50)).collect()] == [None, 0.0, 5.0, 50.0]


@pytest.mark.parametrize(
    "score,want",
    [(10, "CRITICAL"), (25, "CRITICAL"), (40, "HIGH"), (50, "HIGH"), (60, "MEDIUM"), (75, "MEDIUM"), (76, "LOW"), (None, "LOW")],
)
def test_risk_levels(spark, score, want):
    df = spark.createDataFrame([(None if score is None else float(score),)], "s double")
    assert df.select(risk_level(F.col("s"))).first()[0] == want


def silver(spark, **options):
    return to_silver(bronze(spark, **options), now=NOW)


def test_health_score_by_hand(spark):
    rows = [(1, 1, 1.0, 5.0, False, True), (1, 2, 3.0, 5.0, True, None)]
    df = spark.createDataFrame(
        rows,
        "unit_id long, cycle long, sensor_02 double, sensor_03 double, has_sensor_spike boolean, "
        "has_sensor_range_violation boolean",
    )
    got = {r.cycle: r.health_score for r in H.health_score(df).collect()}
    # deviation 1/sqrt(2) of the one sensor that varies, half the life used, one violation
    assert got[1] == pytest.approx(100 - 0.4 * 2**-0.5 - 0.5 * 30 * 0.3 - 1.5)
    assert got[2] is None


def test_constant_sensors_score_full_marks(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (1, 2, 5.0)], "unit_id long, cycle long, sensor_02 double")
    assert {r.health_score for r in H.health_score(df).collect()} == {100.0}
    bare = df.drop("sensor_02")
    assert {r.health_score for r in H.health_score(bare).collect()} == {100.0}


def test_health_tables(spark):
    tables = H.all_health_tables(silver(spark, units=3, cycles=4), now=NOW)
    assert tables["dim_equipment"].count() == 3
    health = tables["fact_equipment_health"].collect()
    assert all(0 <= r.health_score <= 100 for r in health)
    assert {r.remaining_useful_life for r in health} == {0, 1, 2, 3}
    summary = tables["equipment_health_summary"].collect()
    assert {(r.latest_cycle, r.estimated_rul, r.sensors_in_warning_state) for r in summary} == {(4, 0, 4)}


def test_every_risk_is_reachable_with_other_weights(spark):
    weights = HealthWeights(40.0, 0.0, 1.0, 0.0, RiskThresholds(30, 50, 70))
    levels = H.equipment_health(silver(spark, units=2, cycles=20), weights, now=NOW).select("risk_level").distinct()
    assert {"CRITICAL", "LOW"} <= {r[0] for r in levels.collect()}


def test_features_follow_the_specification(spark):
    spec = {"sensor_02": Feature((5,), ("mean", "std"), True), "absent": Feature((5,), ("mean",), True)}
    features = ml_features(silver(spark, units=1, cycles=30), spec)
    assert {"sensor_02_rolling_mean_5", "sensor_02_rolling_std_5", "sensor_02_rate_of_change"} <= set(features.columns)
    assert not any(c.startswith("absent") or c.startswith("__") for c in features.columns)
    rows = features.orderBy("cycle").collect()
    assert [r.sensor_02_rolling_mean_5 for r in rows[:4]] == [None] * 4
    assert rows[4].sensor_02_rolling_mean_5 == pytest.approx(203.0)
    assert rows[0].cycles_since_first_observation == 0 and rows[-1].cycles_since_first_observation == 29
    assert rows[-1].sensor_warning_count == 30 and rows[-1].cycle_gap_count == 0
    assert dict(features.dtypes)["sensor_warning_count"] == "int"


def test_features_of_hot_units(spark):
    table = silver(spark, units=2, cycles=120)
    plain, split = ml_features(table), ml_features(table, limits=SkewLimits(hot_rows=50, chunk_rows=30))
    assert plain.columns == split.columns
    rounded = [F.round(c, 6).alias(c) if t == "double" else F.col(c) for c, t in plain.dtypes]
    assert plain.select(*rounded).exceptAll(split.select(*rounded)).count() == 0


def test_marts_are_views(spark):
    table = silver(spark, units=2, cycles=12)
    tables = H.all_health_tables(table, now=NOW)
    marts = build_marts(table, tables["fact_equipment_health"], tables["equipment_health_summary"])
    for name in marts:
        assert spark.sql(f"SELECT count(*) FROM {name}").first()[0] > 0
    row = spark.sql("SELECT * FROM dataset_quality_health_summary").first()
    assert (row.total_records, row.total_equipment_units) == (24, 2)
