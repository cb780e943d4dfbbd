from __future__ import annotations

import dataclasses
import hashlib
import random
from datetime import UTC, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from fleetlake.functions.columns import source_name
from fleetlake.operators import ledger as G
from fleetlake.plans import lakehouse
from fleetlake.plans.marts import STORED
from fleetlake.queries.files import write_sources
from fleetlake.settings import READING_COLUMNS, Paths, Settings, load_features, load_sensor_ranges
from fleetlake.sinks import tables as K
from fleetlake.sources import layers as R
from fleetlake.sources import text as T
from fleetlake.streaming.incremental import incremental_ingest

NOW = datetime(2024, 5, 1, tzinfo=UTC)


def line(unit, cycle, rng):
    return "  ".join([str(unit), str(cycle), *(f"{rng.uniform(1, 100):.4f}" for _ in range(24))])


@pytest.fixture
def lake(spark, tmp_path):
    """Three units of 20 to 40 cycles in each of the three files."""
    rng = random.Random(3)
    paths = Paths.below(str(tmp_path))
    source = tmp_path / "data" / "source"
    source.mkdir(parents=True)
    for kind in ("train", "test"):
        rows = [line(u, c, rng) for u in (1, 2, 3) for c in range(1, rng.randint(20, 40))]
        (source / f"{kind}_FD001.txt").write_text("\n".join(rows) + " \n\n")
    (source / "RUL_FD001.txt").write_text("5\n\n 7 \n9\n")
    return dataclasses.replace(Settings(), paths=paths)


def test_scan_types_and_numbers(spark, lake):
    df = T.scan_sensor_text(spark, f"{lake.paths.source_dir}/train_FD001.txt", "run", NOW)
    assert dict(df.dtypes)["unit_id"] == "bigint" and dict(df.dtypes)["sensor_21"] == "double"
    rows = df.orderBy("source_row_number").collect()
    assert [r.source_row_number for r in rows] == list(range(1, len(rows) + 1))
    assert {(r.source_file, r.dataset_id, r.split) for r in rows} == {("train_FD001.txt", "FD001", "train")}
    assert [(r.unit_id, r.cycle) for r in rows] == sorted((r.unit_id, r.cycle) for r in rows)


def test_numbers_over_many_splits(spark, tmp_path):
    for name in ("train_FD001.txt", "train_FD002.txt"):
        (tmp_path / name).write_text("".join(f"{i} line\n\n" for i in range(1, 3001)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        numbered = T.with_row_numbers(T.read_lines(spark, str(tmp_path)))
        assert T.read_lines(spark, str(tmp_path)).rdd.getNumPartitions() > 5
        wrong = numbered.filter(F.concat(F.col("source_row_number").cast("string"), F.lit(" line")) != F.col("line"))
        assert numbered.count() == 6000 and wrong.count() == 0
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_bad_lines(spark, tmp_path):
    rng = random.Random(1)
    good = line(1, 1, rng)
    path = tmp_path / "train_FD001.txt"
    path.write_text("\n".join([good, "1 2 3", good.replace("1  1", "1  x", 1), good + "  extra"]))
    tolerant = T.scan_sensor_text(spark, str(path), mode="tolerant")
    assert tolerant.count() == 2
    assert T.malformed_lines(T.read_lines(spark, str(path))).count() == 2
    with pytest.raises(Exception, match="expected at least 26|not a bigint"):
        T.scan_sensor_text(spark, str(path)).collect()


def test_nan_becomes_null(spark, tmp_path):
    values = line(1, 1, random.Random(1)).split()
    path = tmp_path / "train_FD001.txt"
    path.write_text(" ".join([*values[:-1], "NaN"]))
    assert T.scan_sensor_text(spark, str(path)).first().sensor_21 is None


@pytest.mark.parametrize("name,split,dataset", [("train_FD001.txt", "train", "FD001"), ("RUL_FD003.txt", "RUL", "FD003")])
def test_dataset_names(spark, name, split, dataset):
    row = T.with_dataset(spark.createDataFrame([(name,)], "source_file string")).first()
    assert (row.split, row.dataset_id) == (split, dataset)


def test_unknown_dataset_raises(spark):
    with pytest.raises(Exception, match="Cannot detect"):
        T.with_dataset(spark.createDataFrame([("random.txt",)], "source_file string")).collect()


def test_checksums(spark, tmp_path):
    path = tmp_path / "train_FD001.txt"
    path.write_bytes(b"hello world")
    whole = T.file_checksums(spark, str(path), "bytes").first()
    assert whole.file_checksum == hashlib.sha256(b"hello world").hexdigest()
    seen = set()
    for content in (b"hello world", b"hello there", b" hello there", b"hello there\n\n", b"\nhello there", b"there\nhello", b"hello\nthere"):
        path.write_bytes(content)
        by_lines = T.file_checksums(spark, str(path)).first().file_checksum
        assert T.source_checksums(spark, str(path)).first().file_checksum == by_lines
        seen.add(by_lines)
    assert len(seen) == 7
    with pytest.raises(ValueError, match="unknown checksum"):
        T.file_checksums(spark, str(path), "size")


def test_checksum_of_a_source_does_not_depend_on_its_parts(spark, tmp_path):
    lines = [f"{i} {i * i}" for i in range(1000)]
    whole, parts = tmp_path / "a" / "train_FD001.txt", tmp_path / "b" / "train_FD001.txt"
    whole.parent.mkdir()
    parts.mkdir(parents=True)
    whole.write_text("\n".join(lines) + "\n")
    for n in range(4):
        (parts / f"part-{n}").write_text("\n".join(lines[n * 250 : n * 250 + 250]) + "\n")
    found = {T.source_checksums(spark, str(p)).first().file_checksum for p in (whole, parts)}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1k")
    found |= {T.source_checksums(spark, str(p)).first().file_checksum for p in (whole, parts)}
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert len(found) == 1


def test_empty_source_is_named(spark, lake):
    open(f"{lake.paths.source_dir}/train_FD002.txt", "w").close()
    ledger = G.Ledger(spark, lake.paths.metadata_dir)
    with pytest.raises(lakehouse.EmptySource, match="train_FD002"):
        lakehouse.ingest(spark, lake, ledger, "run-1", ["FD002"], NOW)


def test_equal_stamps_and_a_future_run(spark, lake):
    later = datetime(2100, 1, 1)
    run = lakehouse.end_to_end(spark, lake, ["FD001"], later)
    ledger = G.Ledger(spark, lake.paths.metadata_dir)
    assert ledger.runs().filter(F.col("pipeline_run_id") == run).first().status == "SUCCESS"
    marts = lake.paths.gold_dir + "/marts"
    rows = {name: R.read_layer(spark, f"{marts}/{name}").count() for name in STORED}
    assert rows["dim_equipment"] == 3 and rows["dataset_quality_health_summary"] == 1
    assert rows["fact_equipment_health"] == R.read_layer(spark, f"{lake.paths.silver_dir}/sensor_readings").count()
    ledger.start_task("r", "t", later)
    ledger.complete_task("r", "t", "SUCCESS", 3, later)
    task = ledger.tasks().filter("pipeline_run_id = 'r'").first()
    assert (task.status, task.records_processed, task.duration_seconds) == ("SUCCESS", 3, 0.0)


def test_ingest_is_idempotent(spark, lake):
    ledger = G.Ledger(spark, lake.paths.metadata_dir)
    first = lakehouse.ingest(spark, lake, ledger, "run-1", now=NOW)
    assert set(first) == {"train_FD001.txt", "test_FD001.txt", "RUL_FD001.txt"} and first["RUL_FD001.txt"] == 3
    assert set(lakehouse.ingest(spark, lake, ledger, "run-2", now=NOW).values()) == {0}
    bronze = f"{lake.paths.bronze_dir}/sensor_readings"
    before = R.read_layer(spark, bronze).count()
    with open(f"{lake.paths.source_dir}/train_FD001.txt", "a") as handle:
        handle.write(line(9, 1, random.Random(1)) + "\n")
    changed = lakehouse.ingest(spark, lake, ledger, "run-3", now=NOW)
    assert changed["train_FD001.txt"] == first["train_FD001.txt"] + 1 and changed["test_FD001.txt"] == 0
    assert R.read_layer(spark, bronze).count() == before + 1
    assert ledger.manifest().count() == 4
    lives = R.read_layer(spark, f"{lake.paths.bronze_dir}/rul").orderBy("unit_id").collect()
    assert [(r.unit_id, r.remaining_useful_life) for r in lives] == [(1, 5), (2, 7), (3, 9)]


def test_missing_source(spark, lake):
    with pytest.raises(FileNotFoundError):
        R.require_source(spark, f"{lake.paths.source_dir}/train_FD009.txt")
    assert R.list_files(spark, f"{lake.paths.gold_dir}").count() == 0
    assert lakehouse.ingest(spark, lake, G.Ledger(spark, lake.paths.metadata_dir), "run", ["FD009"]) == {}


def test_end_to_end(spark, lake):
    run_id = lakehouse.end_to_end(spark, lake, now=NOW)
    ledger = G.Ledger(spark, lake.paths.metadata_dir)
    run = ledger.runs().filter(F.col("pipeline_run_id") == run_id).first()
    assert run.status == "SUCCESS" and run.records_ingested > 0 and run.records_silver == run.records_gold > 0
    results = ledger.quality_results()
    assert run.quality_checks_passed == results.filter("status = 'PASS'").count() > 0
    # 74 for bronze, 30 for silver, and for gold one or two per table
    assert results.count() == 74 + 30 + (2 + 1 + 2 + 1) + (1 + 2 + 1 + 1)
    assert {t.status for t in ledger.tasks().collect()} == {"SUCCESS"}
    gold = f"{lake.paths.gold_dir}/analytics"
    health = R.read_layer(spark, f"{gold}/fact_equipment_health")
    assert health.filter("NOT health_score BETWEEN 0 AND 100").count() == 0
    lowest = health.groupBy("unit_id").agg(F.min("remaining_useful_life").alias("rul")).collect()
    assert len(lowest) == 3 and {r.rul for r in lowest} == {0}
    assert R.read_layer(spark, f"{gold}/equipment_health_summary").count() == 3
    assert R.read_layer(spark, f"{lake.paths.quarantine_dir}/sensor_range_violations").count() > 0
    assert not R.path_exists(spark, f"{lake.paths.quarantine_dir}/duplicates")


def test_failed_run_is_recorded(spark, lake):
    with pytest.raises(RuntimeError):
        lakehouse.end_to_end(spark, lake, now=NOW, fail_on="FAIL")
    run = G.Ledger(spark, lake.paths.metadata_dir).runs().first()
    assert run.status == "FAILED" and "FAIL" in run.error_message and run.records_ingested > 0


def test_stream_reads_each_file_once(spark, lake, tmp_path):
    ledger = G.Ledger(spark, lake.paths.metadata_dir)
    arguments = (spark, lake.paths.source_dir, lake.paths, ledger, str(tmp_path / "checkpoint"))
    incremental_ingest(*arguments, "run-1")
    assert ledger.manifest().count() == 3
    incremental_ingest(*arguments, "run-2")
    assert ledger.manifest().count() == 3
    with open(f"{lake.paths.source_dir}/train_FD002.txt", "w") as handle:
        handle.write(line(1, 1, random.Random(1)) + "\n")
    incremental_ingest(*arguments, "run-3")
    manifest = ledger.manifest().filter("source_file = 'train_FD002.txt'").first()
    assert (manifest.row_count, manifest.dataset_id, manifest.pipeline_run_id) == (1, "FD002", "run-3")
    stored = R.read_layer(spark, f"{lake.paths.bronze_dir}/sensor_readings")
    assert stored.groupBy("source_file", "source_row_number").count().filter("count > 1").count() == 0


def test_ledger_states(spark, tmp_path):
    ledger = G.Ledger(spark, str(tmp_path / "ledger"))
    later = NOW + timedelta(seconds=90)
    run = ledger.create_run("nightly", "FD001", NOW)
    assert ledger.runs().first().status == "RUNNING"
    ledger.complete_run(run, "SUCCESS", later, records_silver=5)
    ledger.complete_run(run, "SUCCESS", later + timedelta(seconds=1), quality_checks_passed=7)
    state = ledger.runs().first()
    assert (state.records_silver, state.quality_checks_passed, state.records_gold) == (5, 7, 0)
    ledger.start_task(run, "ingest", NOW)
    ledger.complete_task(run, "ingest", "FAILED", 3, later)
    task = ledger.tasks().first()
    assert (task.status, task.duration_seconds, task.records_processed) == ("FAILED", 90.0, 3)
    ledger.start_task(run, "ingest", later + timedelta(seconds=5))
    again = ledger.tasks().first()
    assert (again.status, again.completed_at, again.duration_seconds) == ("RUNNING", None, None)
    assert ledger.tasks().count() == 1 and not ledger.already_ingested("a", "b")


def test_quarantine_writes_only_findings(spark, lake):
    rows = spark.createDataFrame([(1,)], "x long")
    assert K.quarantine(rows.limit(0), lake.paths, "none") is None
    assert K.quarantine(rows, lake.paths, "some").endswith("quarantine/some")


def test_settings_from_yaml(tmp_path):
    pytest.importorskip("yaml")
    main, ranges, features = (tmp_path / n for n in ("main.yaml", "ranges.yaml", "features.yaml"))
    main.write_text(
        "dataset: {default_id: FD002}\npipeline: {spike_detection_window: 20}\n"
        "health_score: {sensor_deviation_weight: 0.5, risk_thresholds: {high: 60}}\nfreshness: {gold_max_age_hours: 12}\n"
    )
    ranges.write_text("sensor_02: {min: 1, max: 2, description: d}\n")
    features.write_text("features: {sensor_02: {rolling_windows: [5], statistics: [mean], rate_of_change: true}}\n")
    s = Settings.from_yaml(str(main), str(ranges), str(features))
    assert (s.default_dataset_id, s.spikes.window, s.spikes.sigma) == ("FD002", 20, 3.0)
    assert (s.health.sensor_deviation_weight, s.health.risk_thresholds.high, s.health.risk_thresholds.medium) == (0.5, 60, 75)
    assert s.freshness.hours("gold") == 12 and s.freshness.hours("other") == 24
    assert load_sensor_ranges(str(ranges))["sensor_02"].max == 2.0
    assert load_features(str(features))["sensor_02"].rolling_windows == (5,)
    with pytest.raises(ValueError):
        Settings(column_names=READING_COLUMNS[:-1])


def write(path, lines):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")


def _names_lines(df) -> int:
    """Times the plan takes a source's name from a path below the first aggregate, that is for each line."""
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    found, below = 0, None
    for text in plan.split("\n"):
        depth = len(text) - len(text.lstrip(" :+-"))
        below = depth if "Aggregate" in text and below is None else below if below is None or depth > below else None
        found += "(?:train|test|RUL)_FD" in text and (below is not None and depth > below)
    return found


def test_sources_are_named_once_per_split(spark, tmp_path):
    write(tmp_path / "train_FD001.txt" / "part-0", ["1 1", "", "1 2"])
    write(tmp_path / "train_FD002.txt" / "part-0", ["2 1"])
    numbered = T.with_row_numbers(T.read_lines(spark, str(tmp_path / "*")))
    rows = {(r.source_file, r.line, r.source_row_number) for r in numbered.collect()}
    assert rows == {("train_FD001.txt", "1 1", 1), ("train_FD001.txt", "1 2", 2), ("train_FD002.txt", "2 1", 1)}
    assert _names_lines(numbered) == 0
    stored = T.store_lines(spark, str(tmp_path / "*"), str(tmp_path / "_stored"))
    T.split_shifts(stored).write.parquet(str(tmp_path / "_shifts"))
    second = T.numbered_lines(stored, spark.read.parquet(str(tmp_path / "_shifts")), 4).filter("source_file LIKE '%2.txt'")
    assert [(r.line, r.line_number) for r in second.collect()] == [("2 1", 1)]
    assert "(?:train|test|RUL)_FD" not in second._jdf.queryExecution().optimizedPlan().toString()


def test_name_of_a_source_in_a_long_path(spark):
    paths = ["file:/a/train_b/x-train_FD001.txt.gz/part-0", "file:/x/RUL_FD004.txt", "train_FD002.txt", "file:/" + "train_" * 9 + "/plain"]
    rows = spark.createDataFrame([(p,) for p in paths], "p string").select(source_name(F.col("p")).alias("n")).collect()
    assert [r.n for r in rows] == ["x-train_FD001.txt.gz", "RUL_FD004.txt", "train_FD002.txt", "plain"]


def test_sources_come_from_one_write(spark, tmp_path):
    rows = [(f"FD00{u % 3 + 1}", u, c, *[float(u * c)] * 24) for u in range(1, 7) for c in range(1, 30)]
    df = spark.createDataFrame(rows, ["dataset_id", *READING_COLUMNS])
    whole = [str(tmp_path / n) for n in "ab"]
    for folder, parts in zip(whole, (3, 11)):
        paths = write_sources(df, folder, parts=parts)
        assert [p.rsplit("/", 1)[1] for p in paths] == [f"train_FD00{n}.txt" for n in (1, 2, 3, 4)]
        read = T.scan_sensor_text(spark, paths)
        got = sorted((r.dataset_id, r.source_row_number, r.unit_id, r.cycle) for r in read.collect())
        want = [(f"FD00{n}", i, u, c) for n in (1, 2, 3) for i, (u, c) in enumerate(sorted((r[1], r[2]) for r in rows if r[0] == f"FD00{n}"), 1)]
        assert got == want
    sums = [{tuple(r) for r in T.source_checksums(spark, f"{f}/*").collect()} for f in whole]
    assert sums[0] == sums[1] and len(sums[0]) == 3
    assert len(list((tmp_path / "b" / "train_FD001.txt").glob("part-*"))) > len(list((tmp_path / "a" / "train_FD001.txt").glob("part-*")))
