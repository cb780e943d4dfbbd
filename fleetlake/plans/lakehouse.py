"""The batch run from source files to gold tables, with its ledger."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from datetime import UTC, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions.columns import dataset_of
from fleetlake.operators.features import ml_features
from fleetlake.operators.health import dim_equipment, equipment_health, equipment_summary
from fleetlake.operators.ledger import Ledger, skip_ingested
from fleetlake.operators.partials import sensor_moments, unit_sketches
from fleetlake.operators.quality import ObservedChecks, range_violations, silver_checks, validate
from fleetlake.operators.silver import CLEAN, enforce_types, with_outcome
from fleetlake.operators.skew import profile_groups
from fleetlake.plans.marts import STORED, build_marts, write_marts
from fleetlake.session import scratch_path, shuffles_dropped
from fleetlake.settings import Paths, Settings
from fleetlake.sinks.bucketed import bucket_number, buckets_of, read_bucketed
from fleetlake.sinks.tables import (
    quarantine_range_violations,
    write_bronze,
    write_bronze_rul,
    write_features,
    write_gold,
    write_layer,
    write_outcomes,
)
from fleetlake.sources.layers import delete_path, discover_sources, read_layer, read_split
from fleetlake.sources.text import (
    describe_sources,
    filled_lines,
    numbered_lines,
    rul_rows,
    sensor_rows,
    split_shifts,
    store_lines,
)


class EmptySource(ValueError):
    """A source without a line, or with blank lines only."""


def ingest(
    spark: SparkSession,
    settings: Settings,
    ledger: Ledger,
    run_id: str,
    dataset_ids: Sequence[str] | None = None,
    now: datetime | None = None,
) -> dict[str, int]:
    """Land new or changed source files as bronze; ``{file: rows}``, 0 for skipped ones.

    Bronze is written first and the manifest last, and a file replaces its own
    partition only, so a run that died in between can simply be repeated.
    """
    paths = settings.paths
    sources = discover_sources(spark, paths.source_dir, dataset_ids or [settings.default_dataset_id])
    return land_sources(spark, sources, paths, ledger, run_id, settings.column_names, now)


def land_sources(
    spark: SparkSession,
    sources: Mapping[str, str],
    paths: Paths,
    ledger: Ledger,
    run_id: str,
    columns: Sequence[str],
    now: datetime | None = None,
) -> dict[str, int]:
    """Land whole sources, ``{name: path of a file or a folder of parts}``, that the manifest does not hold yet."""
    now = now or datetime.now(UTC)
    if not sources:
        return {}
    places = list(sources.values())
    folder = scratch_path(spark, "lines")

    splits = spark.read.text(places).rdd.getNumPartitions() + len(places)
    stored = store_lines(spark, places, folder)
    numbered = numbered_lines(stored, _kept(split_shifts(stored), f"{folder}-splits"), splits)
    found = _kept(describe_sources(numbered), f"{folder}-sources")
    _complain_of_empty(spark, sources, found)
    new = _kept(skip_ingested(found, ledger.manifest()), f"{folder}-new")
    is_life = F.startswith("source_file", F.lit("RUL"))
    kinds = new.agg(F.count_if(~is_life).alias("readings"), F.count_if(is_life).alias("lives"), F.max("blank_count").alias("blanks")).first()
    lines = filled_lines(numbered.join(new.select("source_file"), ["source_file"], "left_semi"), bool(kinds.blanks))
    if kinds.readings:
        write_bronze(sensor_rows(lines.filter(~is_life), run_id, now, columns), paths)
    if kinds.lives:
        write_bronze_rul(rul_rows(lines.filter(is_life), run_id, now), paths)
    counted = new.withColumn("row_count", F.col("line_count") - F.col("blank_count"))
    if kinds.readings or kinds.lives:
        described = counted.withColumns(
            {
                "dataset_id": dataset_of(F.col("source_file"))["dataset_id"],
                "ingested_at": F.lit(now).cast("timestamp"),
                "pipeline_run_id": F.lit(run_id),
            }
        )
        ledger.record_ingestion(described.coalesce(1))
    rows = {r.source_file: r.row_count for r in counted.select("source_file", "row_count").collect()}  # a row per new source
    for path in (folder, f"{folder}-splits", f"{folder}-sources", f"{folder}-new"):
        delete_path(spark, path)
    return {**dict.fromkeys(sources, 0), **rows}


def _kept(df: DataFrame, path: str) -> DataFrame:
    """A small table, written so that later steps agree on it."""
    with shuffles_dropped(df.sparkSession):
        df.coalesce(1).write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _complain_of_empty(spark: SparkSession, sources: Mapping[str, str], found: DataFrame) -> None:
    named = spark.createDataFrame([(name,) for name in sources], "source_file string")
    filled = found.filter("line_count > blank_count")
    if empty := sorted(r.source_file for r in named.join(filled, ["source_file"], "left_anti").limit(20).collect()):
        raise EmptySource(f"no lines in {', '.join(empty)}")


def health_tables(
    silver: DataFrame, settings: Settings, now: datetime, moments: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Dimension and health fact; the summary follows from the written fact."""
    health = equipment_health(silver, settings.health, settings.series, now, limits=settings.limits, moments=moments)
    return {"dim_equipment": dim_equipment(silver), "fact_equipment_health": health}


def refresh_partials(spark: SparkSession, own: DataFrame, paths: Paths) -> dict[str, DataFrame]:
    """Moments and unit sketches of the run's data sets, stored beside those of the others; all of them, read back."""
    made = {"sensor_moments": sensor_moments(own), "unit_sketches": unit_sketches(own)}
    written = {name: write_layer(df, f"{paths.gold_dir}/partials/{name}", ["dataset_id"]) for name, df in made.items()}
    return {name: read_layer(spark, path) for name, path in written.items()}


def end_to_end(
    spark: SparkSession,
    settings: Settings,
    dataset_ids: Sequence[str] | None = None,
    now: datetime | None = None,
    split: str | None = "train",
    fail_on: str | None = None,
) -> str:
    """Ingest, validate, clean, validate, derive, validate; the run id.

    Every step reads what the one before wrote, so a lost executor costs no
    more than the tasks at hand. Quality results are recorded and do not stop
    the run unless ``fail_on`` names a status.
    """
    began = datetime.now(UTC)
    now = now or began

    def clock() -> datetime:
        """The caller's time, running."""
        return now + (datetime.now(UTC) - began)

    paths = settings.paths
    ids = list(dataset_ids or [settings.default_dataset_id])
    ledger = Ledger(spark, paths.metadata_dir)
    run_id = ledger.create_run("sensor_lakehouse", ",".join(ids), now)

    def step(name: str, work: Callable[[], int]) -> int:
        ledger.start_task(run_id, name, clock())
        try:
            records = work()
        except Exception:
            ledger.complete_task(run_id, name, "FAILED", now=clock())
            raise
        ledger.complete_task(run_id, name, "SUCCESS", records, clock())
        return records

    def bronze() -> DataFrame:
        known = F.col("dataset_id").isin(ids)
        return read_split(spark, f"{paths.bronze_dir}/sensor_readings", split).filter(known)

    def silver(own: Sequence[str] | None = None) -> DataFrame:
        return read_bucketed(spark, f"{paths.silver_dir}/sensor_readings", own)

    def check(frame: DataFrame, layer: str, name: str) -> int:
        return record(validate(frame, layer, run_id, now, settings), layer, name)

    def record(results: DataFrame, layer: str, name: str) -> int:
        ledger.record_results(results, layer, name)
        if fail_on:
            failed = ledger.quality_results().filter(
                (F.col("pipeline_run_id") == run_id) & (F.col("dataset_layer") == layer) & (F.col("status") == fail_on)
            )
            if not failed.isEmpty():
                raise RuntimeError(f"{layer} checks are {fail_on}")
        return 0

    def failures(kind: str) -> bool:
        recorded = ledger.quality_results().filter(
            (F.col("pipeline_run_id") == run_id) & (F.col("check_type") == kind) & (F.col("dataset_layer") == "bronze")
        )
        return not recorded.filter("failed_records > 0").isEmpty()

    def validate_bronze() -> int:
        check(bronze(), "bronze", "sensor_readings")
        found = failures("range")
        quarantine_range_violations(range_violations(bronze(), settings.ranges), paths, found, ids)
        return 0

    def clean() -> int:
        # Layers are bucketed by unit, so that features, health and marts need no exchange of readings. A hot unit
        # would be one bucket, so data sets with one are stored as they come.
        readings = bronze()
        profile = profile_groups(enforce_types(readings), settings.series.on(readings).keys, settings.limits)
        buckets = None if profile.hot_groups else bucket_number(spark, profile.rows)
        rows = with_outcome(readings, settings, now, buckets=buckets)
        # Silver's checks are measured while it is written. Other data sets' rows were checked by their own runs.
        checks = silver_checks(rows.drop("outcome"), now, settings)
        observed["silver"] = ObservedChecks(checks, F.col("outcome") == CLEAN, "silver")
        write_outcomes(observed["silver"].watch(rows), paths, ids, buckets)
        return observed["silver"].rows()[0]

    def derive() -> int:
        # Features are partitioned by data set: those of other runs stay. Scores rest on statistics over all.
        own = silver(ids)
        buckets = buckets_of(spark, f"{paths.silver_dir}/sensor_readings", ids)
        write_features(ml_features(own, settings.features, limits=settings.limits), paths, buckets)
        moments = refresh_partials(spark, own, paths)["sensor_moments"]
        written = write_gold(health_tables(silver(), settings, now, moments), paths)
        health = read_layer(spark, written["fact_equipment_health"])
        write_gold({"equipment_health_summary": equipment_summary(health, silver(), now)}, paths)
        return read_layer(spark, f"{paths.gold_dir}/ml_features").count()

    def marts() -> int:
        tables = {n: read_layer(spark, f"{paths.gold_dir}/analytics/{n}") for n in ("fact_equipment_health", "equipment_health_summary")}
        written = write_marts(build_marts(silver(), *tables.values(), settings.limits), paths)
        return read_layer(spark, written["fact_sensor_readings"]).count()

    def validate_gold() -> int:
        check(read_bucketed(spark, f"{paths.gold_dir}/ml_features"), "gold", "ml_features")
        for name in ("dim_equipment", "fact_equipment_health", "equipment_health_summary"):
            check(read_layer(spark, f"{paths.gold_dir}/analytics/{name}"), "gold", name)
        for name in STORED:
            check(read_layer(spark, f"{paths.gold_dir}/marts/{name}"), "gold", f"marts/{name}")
        return 0

    def rollup() -> int:
        counts = ledger.quality_results().filter(F.col("pipeline_run_id") == run_id).agg(
            F.count_if(F.col("status") == "PASS").alias("passed"),
            F.count_if(F.col("status") == "FAIL").alias("failed"),
        ).first()
        ledger.complete_run(
            run_id,
            "SUCCESS",
            clock(),
            quality_checks_passed=counts.passed,
            quality_checks_failed=counts.failed,
            **totals,
        )
        return 0

    totals: dict[str, int] = {}
    observed: dict[str, ObservedChecks] = {}
    try:
        ingested = step("ingest_bronze", lambda: sum(ingest(spark, settings, ledger, run_id, ids, now).values()))
        totals["records_ingested"] = ingested
        step("validate_bronze", validate_bronze)
        totals["records_silver"] = step("transform_silver", clean)
        step("validate_silver", lambda: record(observed["silver"].results(spark, run_id, now), "silver", "sensor_readings"))
        totals["records_gold"] = step("generate_ml_features", derive)
        step("build_marts", marts)
        step("validate_gold", validate_gold)
        step("update_metrics", rollup)
    except Exception as error:
        ledger.complete_run(run_id, "FAILED", clock(), error_message=str(error), **totals)
        raise
    return run_id
