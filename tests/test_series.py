from __future__ import annotations

import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fleetlake.functions.windows import FullRolling, Spikes, cycle_gap, next_value, rolling
from fleetlake.operators import series as S
from fleetlake.settings import UNIQUE_SERIES, Series, SkewLimits, SpikeRule

TINY = SkewLimits(hot_rows=40, chunk_rows=25, broadcast_groups=2)


def readings(spark, sizes, seed=7, null_share=0.1):
    rng = random.Random(seed)
    rows = []
    for unit, size in enumerate(sizes, 1):
        cycle = 0
        for i in range(size):
            cycle += rng.choice((1, 1, 1, 4))
            value = None if rng.random() < null_share else round(rng.gauss(100, 5), 3)
            rows.append(("FD001", unit, cycle, value, rng.random() < 0.2))
    rng.shuffle(rows)
    return spark.createDataFrame(rows, "dataset_id string, unit_id long, cycle long, x double, flag boolean")


def in_order(df):
    return df.orderBy("unit_id", "cycle").toPandas()


@pytest.mark.parametrize("n", [1, 2, 5, 7, 10, 11, 12, 20, 22])
@pytest.mark.parametrize("stat", ["mean", "std", "min", "max"])
def test_full_rolling_equals_pandas(spark, n, stat):
    df = readings(spark, [60, 9], null_share=0.02)
    got = in_order(S.rolling_columns(df, {"x": [(stat, n)]}, UNIQUE_SERIES))
    want = got.groupby("unit_id")["x"].transform(lambda x: getattr(x.rolling(n), stat)())
    pd.testing.assert_series_equal(got[f"x_rolling_{stat}_{n}"].astype(float), want, check_names=False)


def test_levels_are_shared():
    windows = FullRolling({"x": [("mean", 5), ("mean", 10), ("mean", 20)]})
    assert windows._parts == {5: 5, 10: 2, 20: 2}
    assert FullRolling({"x": [("mean", 11)]})._framed == [("x", "mean", 11)]


def test_partial_windows_count_from_the_first_row(spark):
    df = readings(spark, [30], null_share=0)
    got = in_order(S.rolling_columns(df, {"x": [("mean", 10), ("std", 10)]}, UNIQUE_SERIES, full=False))
    want = got["x"].rolling(10, min_periods=1)
    pd.testing.assert_series_equal(got["x_rolling_mean_10"], want.mean(), check_names=False)
    assert pd.isna(got["x_rolling_std_10"][0]) and not pd.isna(got["x_rolling_std_10"][1])


def everything(df, limits):
    windows = FullRolling({"x": [("mean", 10), ("std", 5)]})
    spikes = Spikes(["x"], SpikeRule(5, 1.2))

    def columns(w):
        return {
            "mean": F.round(F.expr(windows.text("x", "mean", 10)), 6),
            "std": F.round(F.expr(windows.text("x", "std", 5)), 6),
            "partial": F.round(rolling("x", "mean", 10, w, full=False), 6),
            "gap": cycle_gap("cycle", w),
            "next": next_value("x", w),
            "spike": spikes.text("x"),
        }

    return S.over_series(
        df,
        *windows.stages,
        *spikes.stages,
        columns,
        series=UNIQUE_SERIES,
        before=20,
        after=1,
        totals={"first": F.min("cycle"), "last": F.max("cycle")},
        running={"flags": F.when(F.col("x").isNotNull(), F.col("flag").cast("int"))},
        limits=limits,
    )


@pytest.mark.parametrize("sizes", [[30, 30], [300, 5], [41, 40, 39], [500, 250, 1]])
def test_hot_units_give_the_same_rows(spark, sizes):
    df = readings(spark, sizes)
    plain, split = everything(df, SkewLimits()), everything(df, TINY)
    assert plain.columns == split.columns
    assert plain.exceptAll(split).count() == 0 and split.exceptAll(plain).count() == 0
    assert plain.count() == sum(sizes)


def test_ties_are_ordered_by_source_row(spark):
    rows = [("FD001", 1, 5, float(i), "a.txt", i) for i in range(90)]
    df = spark.createDataFrame(
        rows, "dataset_id string, unit_id long, cycle long, x double, source_file string, source_row_number long"
    )
    for limits in (SkewLimits(), TINY):
        changed = S.change_columns(df, ["x"], limits=limits)
        assert {r[0] for r in changed.select("x_rate_of_change").distinct().collect()} == {None, 1.0}


def test_plain_route_has_one_exchange(spark, tmp_path):
    readings(spark, [50, 50]).write.parquet(str(tmp_path / "t"))
    plan = everything(spark.read.parquet(str(tmp_path / "t")), SkewLimits())._jdf.queryExecution().executedPlan()
    assert plan.toString().count("Exchange ") == 1 and plan.toString().count("Sort [") == 1


def test_numbered_series_with_hot_keys(spark):
    df = readings(spark, [200, 3], null_share=0)
    plain = S.numbered_series(df, ["cycle"], ["unit_id"], "n")
    split = S.numbered_series(df, ["cycle"], ["unit_id"], "n", TINY)
    assert plain.exceptAll(split).count() == 0 and split.count() == 203


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.one_of(st.none(), st.integers(-3, 3)), min_size=1, max_size=60))
def test_global_rank_is_a_row_number(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "id long, score long")
    ranked = S.global_rank(df, [F.col("score").asc_nulls_last(), F.col("id")], "rank", 5).orderBy("rank").collect()
    assert [r.rank for r in ranked] == list(range(1, len(values) + 1))
    want = sorted(enumerate(values), key=lambda p: (p[1] is None, p[1] or 0, p[0]))
    assert [r.id for r in ranked] == [i for i, _ in want]


@pytest.mark.parametrize(
    "cycles,want", [([1, 2, 3, 4, 5], [4, 3, 2, 1, 0]), ([10, 20, 35], [25, 15, 0]), ([7], [0])]
)
def test_remaining_useful_life(spark, cycles, want):
    df = spark.createDataFrame([(1, c) for c in cycles], "unit_id long, cycle long")
    got = S.remaining_useful_life(df).orderBy("cycle").collect()
    assert [r.remaining_useful_life for r in got] == want


def test_remaining_useful_life_needs_its_columns(spark):
    with pytest.raises(ValueError):
        S.remaining_useful_life(spark.createDataFrame([(1,)], "unit_id long"))


def test_unit_totals_by_every_route(spark):
    df = readings(spark, [80, 3, 5, 7])
    want = S.remaining_useful_life(df)
    for limits in (TINY, SkewLimits(hot_rows=1000, broadcast_groups=1)):
        assert want.exceptAll(S.remaining_useful_life(df, limits=limits)).count() == 0


def test_gap_list(spark):
    rows = [(1, 1), (1, 2), (1, 5), (2, 1), (2, 4), (2, 4)]
    gaps = S.gap_list(spark.createDataFrame(rows, "unit_id long, cycle long"), Series(keys=("unit_id",)))
    assert sorted(tuple(r) for r in gaps.collect()) == [(1, 5, 2, 3), (2, 4, 1, 3)]


def test_running_counts_stay_null_on_null(spark):
    rows = [(1, 1, True), (1, 2, None), (1, 3, True), (1, 4, False)]
    df = spark.createDataFrame(rows, "unit_id long, cycle long, has_cycle_gap boolean")
    flags = {"cycle_gap_count": "has_cycle_gap", "absent_count": "absent"}
    got = S.running_counts(df, flags).orderBy("cycle")
    assert [r.cycle_gap_count for r in got.collect()] == [1, None, 2, 2]
    assert "absent_count" not in got.columns


def test_constant_windows_never_spike(spark):
    rows = [(1, i, 0.1) for i in range(1, 40)] + [(1, 40, 9.0)]
    df = spark.createDataFrame(rows, "unit_id long, cycle long, x double")
    got = S.spike_columns(df, ["x"], SpikeRule(20, 3.0)).filter("spike_x").collect()
    assert [r.cycle for r in got] == [40]
    # a window of ten that holds the point itself bounds its deviation below three
    assert S.spike_columns(df, ["x"], SpikeRule(10, 3.0)).filter("spike_x").count() == 0


def test_latest_per_unit(spark):
    df = readings(spark, [20, 4])
    latest = S.latest_reading_per_unit(df).select("unit_id", "cycle").collect()
    want = df.groupBy("unit_id").agg(F.max("cycle").alias("cycle")).collect()
    assert sorted(map(tuple, latest)) == sorted(map(tuple, want))


def test_many_small_hot_units_share_tasks(spark):
    from fleetlake.operators import series
    from fleetlake.operators.skew import GroupProfile

    few = spark.range(1)
    limits = SkewLimits(hot_rows=600, chunk_rows=250)
    assert series._range_partitions(few, GroupProfile(9, 36_000_000, 9, 36_000_000, few), limits) == 36
    assert series._range_partitions(few, GroupProfile(1, 6_000, 1, 6_000, few), limits) == 8
    assert series._range_partitions(few, GroupProfile(1, 90_000_000, 1, 90_000_000, few), SkewLimits()) == 23
