"""Clean and quarantined rows from one pass, and checks that come out of their write."""

from __future__ import annotations

import dataclasses
import random
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from fleetlake.operators import quality as Q
from fleetlake.operators.silver import CLEAN, QUARANTINED, quarantined_duplicates, to_silver, with_outcome
from fleetlake.settings import METADATA_COLUMNS, READING_COLUMNS, Paths, Settings, SkewLimits
from fleetlake.sinks import tables as K
from fleetlake.sources import layers as R

NOW = datetime(2024, 5, 1, tzinfo=UTC)


@pytest.fixture(scope="module")
def bronze(spark):
    rng = random.Random(5)
    rows = []
    for dataset in ("FD001", "FD002"):
        for unit in (1, 2, None):
            for cycle in range(1, 60):
                copies = 1 if rng.random() < 0.9 or dataset == "FD002" else rng.choice([2, 3])
                rows += [(unit, cycle, *(rng.choice([None, rng.uniform(500, 700)]) if i == 5 else rng.uniform(0, 700) for i in range(24)),
                          f"train_{dataset}.txt", dataset, NOW, "run", len(rows) + k) for k in range(copies)]
    kinds = {"unit_id": "long", "cycle": "long", "ingested_at": "timestamp", "source_row_number": "long"}
    kinds |= dict.fromkeys(("source_file", "dataset_id", "pipeline_run_id"), "string")
    schema = ", ".join(f"{c} {kinds.get(c, 'double')}" for c in (*READING_COLUMNS, *METADATA_COLUMNS))
    return spark.createDataFrame(rows, schema).repartition(5)


def as_set(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("hot", [False, True])
def test_outcomes_are_silver_and_its_quarantine(spark, bronze, hot):
    limits = SkewLimits(hot_rows=50, chunk_rows=25) if hot else SkewLimits()
    settings = dataclasses.replace(Settings(), limits=limits)
    both = with_outcome(bronze, settings, NOW)
    clean = both.filter(F.col("outcome") == CLEAN).drop("outcome")
    assert as_set(clean) == as_set(to_silver(bronze, settings, NOW))
    quarantined = both.filter(F.col("outcome") == QUARANTINED)
    assert as_set(quarantined.select(*bronze.columns)) == as_set(quarantined_duplicates(bronze, limits=limits))
    assert quarantined.filter("has_cycle_gap IS NOT NULL OR record_quality_status IS NOT NULL").count() == 0
    if not hot:
        plan = both._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1


def test_checks_of_a_write_are_those_of_a_read(spark, bronze, tmp_path):
    rows = with_outcome(bronze, Settings(), NOW)
    checks = Q.silver_checks(rows.drop("outcome"), NOW)
    observed = Q.ObservedChecks(checks, F.col("outcome") == CLEAN)
    written = K.write_outcomes(observed.watch(rows), Paths.below(str(tmp_path)), ["FD001", "FD002"])
    silver = R.read_layer(spark, written).select(*(c for c in rows.columns if c != "outcome"))
    expected = Q.validate_silver(silver, "run", NOW)
    assert as_set(observed.results(spark, "run", NOW)) == as_set(expected) and expected.count() == 30
    assert observed.rows() == (silver.count(), bronze.count())


def test_one_write_is_repeatable_after_a_failure(spark, bronze, tmp_path, monkeypatch):
    paths = Paths.below(str(tmp_path))
    ids = ["FD001", "FD002"]
    K.write_outcomes(with_outcome(bronze, Settings(), NOW), paths, ids)
    copies = f"{paths.quarantine_dir}/duplicates"
    before = R.read_layer(spark, copies).count()
    assert before == quarantined_duplicates(bronze).count() > 0

    moved = []

    def broken(spark, staged, target):
        if moved:
            raise OSError("lost")
        moved.append(target)
        return R.replace_partitions(spark, staged, target)

    fewer = bronze.filter("dataset_id = 'FD002' OR cycle > 30")
    monkeypatch.setattr(K, "replace_partitions", broken)
    with pytest.raises(OSError):
        K.write_outcomes(with_outcome(fewer, Settings(), NOW), paths, ids)
    assert moved == [copies] and R.read_layer(spark, f"{paths.silver_dir}/sensor_readings").count() > 0
    monkeypatch.undo()
    K.write_outcomes(with_outcome(fewer, Settings(), NOW), paths, ids)
    assert R.read_layer(spark, copies).count() == quarantined_duplicates(fewer).count() < before
    silver = R.read_layer(spark, f"{paths.silver_dir}/sensor_readings")
    assert silver.count() == to_silver(fewer, Settings(), NOW).count()
    assert K.write_outcomes(with_outcome(bronze.filter("dataset_id = 'FD002'"), Settings(), NOW), paths, ["FD001"])
    assert not R.path_exists(spark, f"{copies}/dataset_id=FD001")
