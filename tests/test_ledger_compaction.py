from __future__ import annotations

import random
from datetime import UTC, datetime, timedelta

from pyspark.sql import functions as F

from fleetlake.operators import ledger as G
from fleetlake.sources import layers as R

NOW = datetime(2024, 5, 1, tzinfo=UTC)


def states(df):
    return sorted(map(str, df.collect()))


def filled(spark, root, runs=4, seed=1):
    rng = random.Random(seed)
    ledger = G.Ledger(spark, root)
    for i in range(runs):
        at = NOW + timedelta(seconds=rng.randint(0, 50))
        run = ledger.create_run(f"p{i}", "FD001", at)
        ledger.complete_run(run, rng.choice(["SUCCESS", "FAILED"]), at + timedelta(seconds=rng.randint(-3, 9)), records_gold=i)
        ledger.start_task(run, "t", at)
        if i % 2:
            ledger.complete_task(run, "t", "SUCCESS", i, at + timedelta(seconds=2))
    return ledger


def test_same_states_before_during_and_after(spark, tmp_path):
    ledger = filled(spark, str(tmp_path / "l"))
    path = str(tmp_path / "l" / "pipeline_runs")
    before, tasks = states(ledger.runs()), states(ledger.tasks())
    files = [n for n in R.list_names(spark, path) if n.startswith("part")]
    reader = ledger.runs()  # has listed the files, and reads them later
    assert ledger.compact("pipeline_runs") == len(files) and ledger.compact("pipeline_task_metrics") > 0
    assert states(reader) == states(ledger.runs()) == before and states(ledger.tasks()) == tasks
    # A writer that comes later, or came while it ran, is in the tail.
    late = ledger.create_run("late", "FD002", NOW)
    assert len(states(ledger.runs())) == len(before) + 1
    assert ledger.compact("pipeline_runs") == 1
    assert [n for n in R.list_names(spark, path) if n in files] == []
    ledger.complete_run(late, "SUCCESS", NOW + timedelta(seconds=5), records_silver=3)
    row = ledger.runs().filter(F.col("pipeline_run_id") == late).first()
    assert (row.status, row.records_silver, row.pipeline_name) == ("SUCCESS", 3, "late")
    assert ledger.compact("pipeline_runs") == 1 and ledger.compact("pipeline_runs") == 0
    assert set(before) < set(states(ledger.runs()))
    assert len(R.list_names(spark, str(tmp_path / "l" / G.COMPACTED / "pipeline_runs"))) == 2


def test_a_compaction_that_died_does_not_count(spark, tmp_path):
    ledger = filled(spark, str(tmp_path / "l"), 2)
    before = states(ledger.runs())
    ledger.compact("pipeline_runs")
    version = ledger._versions("pipeline_runs")[0]
    R.delete_path(spark, f"{version}/files")
    assert states(ledger.runs()) == before
    assert ledger.compact("pipeline_runs") == 4 and states(ledger.runs()) == before


def test_two_compactions_at_once(spark, tmp_path, monkeypatch):
    ledger = filled(spark, str(tmp_path / "l"), 2)
    other = G.Ledger(spark, str(tmp_path / "l"))
    before = states(ledger.runs())
    monkeypatch.setattr(ledger, "_versions", lambda table: [])
    other.compact("pipeline_runs")
    ledger.compact("pipeline_runs")
    assert states(other.runs()) == before


def test_rows_of_results_are_kept_once(spark, tmp_path):
    ledger = G.Ledger(spark, str(tmp_path / "l"))
    columns = "source_file string, file_checksum string, dataset_id string, row_count long, ingested_at timestamp, pipeline_run_id string"
    for i in range(3):
        ledger.record_ingestion(spark.createDataFrame([(f"f{i}", "c", "FD001", 1, NOW, "r")], columns))
    before = states(ledger.manifest())
    ledger.compact("ingestion_manifest")
    assert states(ledger.manifest()) == before and ledger.already_ingested("f1", "c")
    ledger.record_ingestion(spark.createDataFrame([("f9", "c", "FD001", 1, NOW, "r")], columns))
    assert ledger.manifest().count() == 4
    assert G.Ledger(spark, str(tmp_path / "none")).compact("pipeline_runs") == 0


def test_deciding_events_decide(spark):
    rng = random.Random(2)
    rows = [
        (rng.choice("ab"), rng.choice("xy"), *(rng.choice([None, NOW + timedelta(seconds=rng.randint(0, 5))]) for _ in range(2)),
         rng.choice([None, 1, 2]), rng.choice(["RUNNING", "SUCCESS"]), NOW + timedelta(seconds=rng.randint(0, 3)), rng.choice([None, 0, 1]))
        for _ in range(300)
    ]
    events = spark.createDataFrame(rows, G.TASK_SCHEMA)
    keys = G.STATE_KEYS["pipeline_task_metrics"]
    kept = G.deciding_events(events, keys)
    assert states(G.latest(kept, keys)) == states(G.latest(events, keys)) and kept.count() <= 4 * 6


def test_large_tables_are_compacted_by_several_tasks(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(G, "FILE_BYTES", 2_000)
    ledger = G.Ledger(spark, str(tmp_path / "ledger"))
    at = F.timestamp_seconds(F.col("id") % 7)
    rows = spark.range(900).select(F.concat(F.lit("run-"), F.col("id") % 300).alias("pipeline_run_id"), at.alias("event_at"), F.col("id").cast("string").alias("status"))
    empty = spark.createDataFrame([], G.SCHEMAS["pipeline_runs"])
    ledger.append("pipeline_runs", empty.unionByName(rows, allowMissingColumns=True).repartition(3))
    before = {tuple(r) for r in ledger.runs().collect()}
    size = sum(p.stat().st_size for p in (tmp_path / "ledger" / "pipeline_runs").glob("part-*"))
    ledger.compact("pipeline_runs")
    files = list((tmp_path / "ledger").glob("_compacted/pipeline_runs/*/events/part-*"))
    assert len(files) > 3 and len(files) <= -(-size // 2_000)
    assert {tuple(r) for r in ledger.runs().collect()} == before and len(before) == 300
