"""Batch columns against the same windows as Spark expressions."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from fleetlake.functions.batches import BatchColumns
from fleetlake.functions.windows import FullRolling, Spikes
from fleetlake.operators.features import ml_features
from fleetlake.operators.series import over_series, rolling_columns
from fleetlake.operators.silver import to_silver
from fleetlake.settings import READING_COLUMNS, UNIQUE_SERIES, Feature, Settings, SkewLimits, SpikeRule


def readings(spark, sizes, seed=3):
    rng = random.Random(seed)
    rows = []
    for unit, size in enumerate(sizes, 1):
        for cycle in range(size):
            x = None if rng.random() < 0.03 else float("nan") if rng.random() < 0.02 else rng.gauss(100, 5)
            y = rng.choice((1.0, 1.0, 1.0, 1.0, 1.0, 9.0))
            rows.append(("FD001", unit, cycle, x, y))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "dataset_id string, unit_id long, cycle long, x double, y double")


@pytest.mark.parametrize("rule", [SpikeRule(5, 1.2), SpikeRule(20, 2.0), SpikeRule(10, 1.5, exclude_current=True)])
@pytest.mark.parametrize("batch", [3, 7, 10_000])
@pytest.mark.parametrize("limits", [SkewLimits(), SkewLimits(hot_rows=40, chunk_rows=25, broadcast_groups=2)])
def test_batches_give_what_windows_give(spark, rule, batch, limits):
    df = readings(spark, [60, 9, 1, 130])
    pairs = [(c, stat, n) for c in ("x", "y") for stat in ("mean", "std", "min", "max") for n in (1, 5, 10, 20)]
    names = {f"{c}_{stat}_{n}": (c, stat, n) for c, stat, n in pairs}
    windows, spikes = FullRolling({c: [p[1:] for p in pairs if p[0] == c] for c in ("x", "y")}), Spikes(["x", "y"], rule)
    flags = {"any": spikes.any(["x", "y"]), "of_x": spikes.text("x")}
    texts = {name: windows.text(*what) for name, what in names.items()}
    options = {"series": UNIQUE_SERIES, "limits": limits, "before": 24}
    want = over_series(df, *windows.stages, *spikes.stages, lambda _: {**texts, **flags}, **options)
    found = BatchColumns(names, {"any": ["x", "y"], "of_x": ["x"]}, rule)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        got = over_series(df, found, **options)
        assert got.columns == want.columns
        assert sorted(map(repr, got.collect())) == sorted(map(repr, want.collect()))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_extremes_keep_the_type_of_their_column(spark):
    df = readings(spark, [30]).withColumn("n", F.col("cycle").cast("int"))
    found = rolling_columns(df, {"n": [("min", 5), ("mean", 5)]}, UNIQUE_SERIES)
    assert dict(found.dtypes)["n_rolling_min_5"] == "int" and found.columns[-2:] == ["n_rolling_min_5", "n_rolling_mean_5"]
    assert found.filter("n_rolling_min_5 = n - 4 AND n_rolling_mean_5 = n - 2").count() == 26


def test_silver_and_features_carry_no_windows_of_sensors(spark):
    lit = {c: F.lit(1.0) for c in READING_COLUMNS[2:]}
    bronze = spark.range(9).select(
        F.lit("FD001").alias("dataset_id"), F.lit(1).cast("long").alias("unit_id"), F.col("id").alias("cycle"), *(c.alias(n) for n, c in lit.items())
    )
    silver = to_silver(bronze, Settings())
    made = ml_features(silver, {"sensor_02": Feature((5, 10), ("mean", "std"), True)})
    for frame, lags in ((silver, 1), (made, 2)):
        plan = frame._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("lag(") == lags and "__sum" not in plan


def test_filters_stay_above_batch_columns(spark):
    df = readings(spark, [40])
    found = rolling_columns(df, {"y": [("mean", 10)]}, UNIQUE_SERIES)
    late = found.filter("cycle >= 20").select("cycle", "y_rolling_mean_10").collect()
    assert len(late) == 20 and all(r.y_rolling_mean_10 is not None for r in late)
