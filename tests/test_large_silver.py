"""What keeps silver and its readers cheap on large tables: short methods, one look at each table, numpy rounding."""

from __future__ import annotations

import contextlib
import io
import re
import uuid

import numpy as np
from pyspark.sql import functions as F

from fleetlake.functions.batches import half_up
from fleetlake.operators.features import ml_features
from fleetlake.operators.health import dim_equipment, health_score
from fleetlake.operators.skew import profile_groups
from fleetlake.plans.marts import fact_sensor_readings
from fleetlake.queries.views import rounded
from fleetlake.settings import SENSOR_COLUMNS, UNIQUE_SERIES, SkewLimits

#: From here on the JVM leaves a method to its interpreter.
HUGE = 8000


def readings(spark, units=4, cycles=30):
    rows = spark.range(units * cycles).select(
        F.lit("FD001").alias("dataset_id"),
        (F.col("id") % units).alias("unit_id"),
        F.floor(F.col("id") / units).alias("cycle"),
        *((F.sin(F.col("id") * i) * 50 + i).alias(s) for i, s in enumerate(SENSOR_COLUMNS, 1)),
    )
    spike = F.col("cycle") % 7 == 0
    return rows.withColumns({"has_sensor_spike": spike, "has_sensor_range_violation": ~spike, "record_quality_status": F.lit("VALID")})


def shown(df, mode="simple"):
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain(mode)
    return text.getvalue()


def longest_method(spark, df):
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # adaptive plans show no code before they run
    try:
        return max(map(int, re.findall(r"maxMethodCodeSize:(\d+)", shown(df, "codegen"))))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def jobs_of(spark, build):
    group = uuid.uuid4().hex
    spark.sparkContext.setJobGroup(group, group)
    found = build()
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return found, len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


def test_half_up_is_sparks_round(spark):
    rng = np.random.default_rng(3)
    ties = [k / 1e7 for k in range(-45, 50, 5)] + [0.1234565, 2.0000005, -7.0000015, 1.0000005]
    edges = [0.0, -0.0, -1e-9, 1e-300, 1e300, -123456789.1234565, 9007199254.7409915, float("inf"), float("-inf"), float("nan")]
    values = [*ties, *edges, *rng.normal(0, 100, 3000), *rng.normal(0, 1e9, 300), *np.round(rng.normal(0, 9, 3000), 7)]
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(values)], "i long, v double").coalesce(1)
    want = np.array([r.v for r in df.orderBy("i").select(F.round("v", 6).alias("v")).collect()])
    got = half_up(np.array(values), 6)
    np.testing.assert_array_equal(got, want)
    assert not np.signbit(got[np.array(values) == 0]).any()


def test_wide_tables_are_rounded_without_decimals_and_keep_nulls(spark):
    names = [f"x{i}" for i in range(10)]
    df = spark.createDataFrame([(1, *(i + 0.1234565 for i in range(9)), None), (2, *[None] * 10)], "id long, " + ", ".join(f"{c} double" for c in names))
    want = df.select("id", *(F.round(c, 6).alias(c) for c in names)).collect()
    got = rounded(df.select(*names[:5], "id", *names[5:]))
    assert got.columns == [*names[:5], "id", *names[5:]]
    assert got.select("id", *names).orderBy("id").collect() == want
    assert "round(" not in shown(got)


def test_health_scores_of_all_sensors_are_compiled(spark):
    assert longest_method(spark, health_score(readings(spark))) < HUGE


def test_features_rounded_are_compiled(spark):
    assert longest_method(spark, rounded(ml_features(readings(spark)))) < HUGE


def test_dimension_made_of_the_readings_is_worked_out_once(spark):
    staged = readings(spark)
    facts = fact_sensor_readings(staged, dim_equipment(staged))
    assert "Aggregate" not in shown(facts)
    assert facts.count() == staged.count()


def test_profile_given_saves_the_look_and_keeps_the_rows(spark):
    df = readings(spark)
    profile = profile_groups(df, UNIQUE_SERIES.keys)
    part = df.filter("cycle > 3")
    for build in (ml_features, health_score):
        given, jobs = jobs_of(spark, lambda: build(part, profile=profile))
        assert jobs == 0
        assert sorted(map(str, rounded(given).collect())) == sorted(map(str, rounded(build(part)).collect()))


def test_profile_of_more_rows_keeps_the_rows_where_units_are_hot(spark):
    df, limits = readings(spark, cycles=60), SkewLimits(hot_rows=50, chunk_rows=25)
    profile = profile_groups(df, UNIQUE_SERIES.keys, limits)
    part = df.filter("cycle > 20")  # no unit of these is hot
    assert profile.hot_groups == 4
    given = rounded(ml_features(part, limits=limits, profile=profile))
    assert sorted(map(str, given.collect())) == sorted(map(str, rounded(ml_features(part)).collect()))
