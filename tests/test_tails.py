"""Silver that grows by batches equals silver built at once."""

from __future__ import annotations

import dataclasses
import random
from datetime import UTC, datetime

import pytest
from pyspark.sql import functions as F

from fleetlake.operators.silver import to_silver
from fleetlake.settings import METADATA_COLUMNS, READING_COLUMNS, Settings, SkewLimits, SpikeRule
from fleetlake.sources.layers import delete_path
from fleetlake.streaming.silver import grow_silver
from fleetlake.streaming.tails import gather_tails, latest_tails, read_growing_silver, refresh_silver

NOW = datetime(2024, 5, 1, tzinfo=UTC)
SETTINGS = dataclasses.replace(Settings(), spikes=SpikeRule(8, 2.0))


@pytest.fixture(scope="module")
def bronze(spark):
    """Batch 0 to 3 of each row: unit 3 has late cycles, unit 4 begins late, unit 5 stops, NULL is a unit."""
    rng = random.Random(11)
    rows = []
    for unit in (1, 2, 3, 4, 5, None):
        for cycle in range(0 if unit != 4 else 45, 80 if unit != 5 else 25):
            if rng.random() < 0.05:
                continue
            batch = cycle // 20 if unit != 3 or cycle != 10 else 2
            readings = [rng.choice([None, 5.0, rng.gauss(100, 5)]) for _ in range(24)]
            rows += [(batch, unit, cycle, *readings, "train_FD001.txt", "FD001", NOW, "run", len(rows) + k)
                     for k in range(1 if rng.random() < 0.9 else 2)]
    # A cycle again, after it was thought single; and a cycle that is unknown.
    rows += [(3, 2, 5, *[1.0] * 24, "train_FD001.txt", "FD001", NOW, "run", 9001), (1, 1, None, *[1.0] * 24, "train_FD001.txt", "FD001", NOW, "run", 9002)]
    kinds = {"batch": "int", "unit_id": "long", "cycle": "long", "ingested_at": "timestamp", "source_row_number": "long"}
    kinds |= dict.fromkeys(("source_file", "dataset_id", "pipeline_run_id"), "string")
    schema = ", ".join(f"{c} {kinds.get(c, 'double')}" for c in ("batch", *READING_COLUMNS, *METADATA_COLUMNS))
    return spark.createDataFrame(rows, schema).repartition(4).cache()


def as_set(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("hot", [False, True])
def test_batches_give_what_one_run_gives(spark, bronze, tmp_path, hot):
    settings = dataclasses.replace(SETTINGS, limits=SkewLimits(hot_rows=30, chunk_rows=15)) if hot else SETTINGS
    path = str(tmp_path)
    for batch in range(4):
        new, known = (bronze.filter(F.col("batch") == batch).drop("batch"), bronze.filter(F.col("batch") <= batch).drop("batch"))
        if hot and batch in (1, 2):
            continue
        if hot and batch:
            new = bronze.filter("batch > 0").drop("batch")
        refresh_silver(new, known, path, batch, settings, NOW)
        if hot or batch in (1, 3):
            assert as_set(read_growing_silver(spark, path)) == as_set(to_silver(known, settings, NOW))
    assert as_set(read_growing_silver(spark, path, 1)) == as_set(to_silver(bronze.filter("batch = 0").drop("batch"), settings, NOW))


def test_the_past_is_not_read_and_batches_can_be_repeated(spark, bronze, tmp_path):
    path, nothing = str(tmp_path), bronze.drop("batch").limit(0)
    plain = bronze.filter("unit_id IN (2, 4, 5)").filter("cycle <> 5")
    first, second = plain.filter("batch < 2").drop("batch"), plain.filter("batch >= 2").drop("batch")
    refresh_silver(first, first, path, 0, SETTINGS, NOW)
    # Unit 4 begins in the second batch and is built from bronze; the others' past is withheld.
    known = second.filter("unit_id = 4")
    refresh_silver(second, known, path, 1, SETTINGS, NOW)
    expected = as_set(to_silver(plain.drop("batch"), SETTINGS, NOW))
    assert as_set(read_growing_silver(spark, path)) == expected
    # Broken off between its two writes, the batch does not count yet; repeated it does.
    delete_path(spark, f"{path}/tails/batch=1")
    assert as_set(read_growing_silver(spark, path)) == as_set(to_silver(first, SETTINGS, NOW))
    refresh_silver(second, known, path, 1, SETTINGS, NOW)
    assert as_set(read_growing_silver(spark, path)) == expected
    refresh_silver(nothing, nothing, path, 2, SETTINGS, NOW)
    assert as_set(read_growing_silver(spark, path)) == expected
    assert latest_tails(spark, path).selectExpr("max(size(rows))").first()[0] <= 8

    # Unit 2's source is read again with fewer rows, unit 5's is gone.
    units = spark.createDataFrame([("FD001", 2), ("FD001", 5)], "dataset_id string, unit_id long")
    left = plain.drop("batch").filter("unit_id = 4 OR (unit_id = 2 AND cycle < 30)")
    refresh_silver(nothing, left, path, 3, SETTINGS, NOW, units)
    assert as_set(read_growing_silver(spark, path)) == as_set(to_silver(left, SETTINGS, NOW))


def test_gathered_tails_say_the_same(spark, bronze, tmp_path):
    path = str(tmp_path)
    for batch in range(3):
        new, known = (bronze.filter(F.col("batch") == batch).drop("batch"), bronze.filter(F.col("batch") <= batch).drop("batch"))
        refresh_silver(new, known, path, batch, SETTINGS, NOW, gather_after=99)
    gather_tails(spark, path, 9)  # nothing is lost by a number beyond the last
    delete_path(spark, f"{path}/all-tails")
    single = as_set(latest_tails(spark, path))
    gather_tails(spark, path, 1)
    assert as_set(latest_tails(spark, path)) == single
    assert not any("/tails/batch=1" in f or "/tails/batch=0" in f for f in latest_tails(spark, path).inputFiles())
    # Earlier states do not see it; a repeated batch takes its own away.
    assert as_set(latest_tails(spark, path, 1)) == as_set(spark.read.parquet(f"{path}/tails/batch=0"))
    last = [bronze.filter(c).drop("batch") for c in ("batch = 3", "batch <= 3")]
    refresh_silver(*last, path, 3, SETTINGS, NOW, gather_after=2)
    assert as_set(read_growing_silver(spark, path)) == as_set(to_silver(last[1], SETTINGS, NOW))
    assert all("all-tails/batch=3" in f for f in latest_tails(spark, path).inputFiles())
    refresh_silver(*last, path, 3, SETTINGS, NOW, gather_after=99)
    assert not any("all-tails/batch=3" in f for f in latest_tails(spark, path).inputFiles())
    assert as_set(read_growing_silver(spark, path)) == as_set(to_silver(last[1], SETTINGS, NOW))


def test_stream_of_readings(spark, bronze, tmp_path, monkeypatch):
    from fleetlake.streaming import silver as stream

    path, feed = str(tmp_path / "lake"), str(tmp_path / "feed")
    add = lambda batch: bronze.filter(F.col("batch") == batch).drop("batch").coalesce(1).write.mode("append").parquet(feed)
    upto = lambda batch: as_set(to_silver(bronze.filter(F.col("batch") <= batch).drop("batch"), SETTINGS, NOW))
    add(0)
    grow_silver(spark, feed, path, SETTINGS, NOW)
    grow_silver(spark, feed, path, SETTINGS, NOW)  # nothing new
    assert as_set(read_growing_silver(spark, path)) == upto(0)
    # The batch fails after its rows were written: silver stays as it was until the batch is repeated.
    add(1)
    whole = stream.refresh_silver

    def broken(new, known, path, batch, *rest, **more):
        whole(new, known, path, batch, *rest, **more)
        delete_path(spark, f"{path}/tails/batch={batch}")
        raise RuntimeError("lost")

    monkeypatch.setattr(stream, "refresh_silver", broken)
    with pytest.raises(Exception, match="lost"):
        grow_silver(spark, feed, path, SETTINGS, NOW)
    assert as_set(read_growing_silver(spark, path)) == upto(0)
    monkeypatch.setattr(stream, "refresh_silver", whole)
    # Two more files come before it is; one file a batch, and the first batch already sees them in the folder.
    add(2)
    add(3)
    grow_silver(spark, feed, path, SETTINGS, NOW, max_files=1, gather_after=2)
    assert as_set(read_growing_silver(spark, path)) == upto(3)
