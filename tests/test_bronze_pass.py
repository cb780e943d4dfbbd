"""Copies, gaps and spikes of bronze out of one pass over the series."""

from __future__ import annotations

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from fleetlake.functions.batches import BatchColumns
from fleetlake.functions.windows import cycle_gap
from fleetlake.operators import quality as Q
from fleetlake.operators.series import over_series
from fleetlake.settings import READING_COLUMNS, Series, SkewLimits, SpikeRule

KEYS = ("unit_id", "cycle", "dataset_id")
RULE = SpikeRule(5, 1.2)


def readings(spark, seed=5):
    """Units with gaps, with up to four copies of a key, with NULL units, data sets and cycles."""
    rng = random.Random(seed)
    rows = []
    for unit, size in ((1, 70), (2, 1), (3, 140), (None, 25), (5, 2), (6, 40)):
        cycle = 0
        for i in range(size):
            cycle += rng.choice((0, 0, 1, 1, 1, 3))
            shown = None if unit in (5, 6) and cycle < 5 else cycle
            x = None if rng.random() < 0.05 else float("nan") if rng.random() < 0.03 else rng.gauss(100, 5)
            rows.append((None if unit == 6 else "FD001", unit, shown, x, rng.choice((1.0, 1.0, 1.0, 9.0)), f"f{rng.randint(0, 1)}", i))
    rng.shuffle(rows)
    kinds = "dataset_id string, unit_id long, cycle long, sensor_01 double, sensor_02 double, source_file string, source_row_number long"
    return spark.createDataFrame(rows, kinds)


@pytest.mark.parametrize("batch", [1, 4, 10_000])
@pytest.mark.parametrize("limits", [SkewLimits(), SkewLimits(hot_rows=30, chunk_rows=9, broadcast_groups=2)])
def test_one_pass_counts_what_flags_of_rows_say(spark, batch, limits):
    df, series = readings(spark), Series()
    renamed = df.withColumnsRenamed({s: f"v_{s}" for s in ("sensor_01", "sensor_02")})
    flags = BatchColumns(spikes={s: [f"v_{s}"] for s in ("sensor_01", "sensor_02")}, rule=RULE)
    flagged = over_series(renamed, flags, lambda w: {"gap": cycle_gap("cycle", w)}, series=series, before=8, limits=limits)
    gaps, first, second, total = flagged.agg(*(F.count_if(c) for c in ("gap", "sensor_01", "sensor_02")), F.count(F.lit(1))).first()
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", batch)
    try:
        copies, *rest = Q.series_results(df, rule=RULE, limits=limits, copies=KEYS).collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert copies == Q.duplicate_check(df, KEYS).first() and copies.failed_records > 50
    assert [(r.check_name, r.records_checked, r.failed_records) for r in rest] == [
        ("cycle_gaps", total, gaps),
        ("spike_sensor_01", total, first),
        ("spike_sensor_02", total, second),
    ]
    assert rest == Q.series_results(df, rule=RULE).collect() and '"units":6' in rest[0].details


def test_bronze_is_read_once_for_columns_and_once_for_series(spark, tmp_path):
    lit = {c: F.lit(1.0) for c in READING_COLUMNS[2:]}
    rows = spark.range(9).select(
        F.lit("FD001").alias("dataset_id"), F.lit(1).cast("long").alias("unit_id"), F.col("id").alias("cycle"), *(c.alias(n) for n, c in lit.items())
    )
    rows.write.parquet(f"{tmp_path}/bronze")
    results = Q.validate_bronze(spark.read.parquet(f"{tmp_path}/bronze"), "run-1", datetime(2024, 5, 1))
    plan = results._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Relation [") == 2
    assert plan.count("lag(") == 3  # one for gaps, two for copies


def test_copies_of_other_keys_are_counted_by_themselves(spark):
    df = readings(spark)
    assert Q.copies_in_series(df, KEYS, Series())
    assert not Q.copies_in_series(df, ("unit_id", "cycle"), Series())
    assert not Q.copies_in_series(df, KEYS, Series(keys=("unit_id",)))
    assert not Q.copies_in_series(df.drop("cycle"), KEYS, Series())
    lone = df.drop("dataset_id")
    assert Q.copies_in_series(lone, KEYS, Series())
    assert Q.series_results(lone, (), copies=("unit_id", "cycle")).first() == Q.duplicate_check(lone).first()


def test_nothing_has_no_copies(spark):
    empty = readings(spark).limit(0)
    found = Q.series_results(empty, rule=RULE, copies=KEYS).collect()
    assert [(r.status, r.records_checked, r.failed_records) for r in found] == [("PASS", 0, 0)] * 4


def test_sensors_go_to_a_worker_as_one_column(spark):
    """Spark sums up the sizes of all columns of a batch with every row."""
    plan = Q.series_results(readings(spark), rule=RULE, copies=KEYS)._jdf.queryExecution().optimizedPlan().toString()
    (line,) = [x for x in plan.splitlines() if "MapInArrow" in x]
    assert line.partition("compute(")[2].partition(")")[0].count("#") == 3
