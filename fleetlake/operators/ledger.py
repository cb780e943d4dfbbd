"""The run ledger: append-only event tables and views of their latest state.

Parquet has no UPDATE, so every change of a run or task is an event. The state
of a key is, field by field, the newest value that any of its events carries.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from datetime import UTC, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.operators.skew import join_on
from fleetlake.sources.layers import delete_path, list_names, path_exists, size_of

SEQUENCE = "sequence"
#: Where an event stands among those of the same instant.
BEGUN, ENDED = 0, 1

# --- Fixed values: tables and columns of the ledger ---
RUN_COUNTERS = (
    "records_ingested",
    "records_silver",
    "records_gold",
    "quality_checks_passed",
    "quality_checks_failed",
)
RUN_SCHEMA = (
    "pipeline_run_id string, pipeline_name string, dataset_id string, started_at timestamp, "
    "completed_at timestamp, status string, "
    + ", ".join(f"{c} bigint" for c in RUN_COUNTERS)
    + ", error_message string, event_at timestamp, sequence int"
)
TASK_SCHEMA = (
    "pipeline_run_id string, task_name string, started_at timestamp, completed_at timestamp, "
    "records_processed bigint, status string, event_at timestamp, sequence int"
)
QUALITY_SCHEMA = (
    "quality_result_id string, pipeline_run_id string, dataset_layer string, dataset_name string, "
    "check_name string, check_type string, status string, records_checked bigint, failed_records bigint, "
    "failure_percentage double, checked_at timestamp, details string"
)
MANIFEST_SCHEMA = (
    "source_file string, file_checksum string, dataset_id string, row_count bigint, "
    "ingested_at timestamp, pipeline_run_id string, status string"
)
# --- end of fixed values ---
SCHEMAS = {
    "pipeline_runs": RUN_SCHEMA,
    "pipeline_task_metrics": TASK_SCHEMA,
    "data_quality_results": QUALITY_SCHEMA,
    "ingestion_manifest": MANIFEST_SCHEMA,
}


def latest(events: DataFrame, keys: Sequence[str], by: str = "event_at", drop_by: bool = True) -> DataFrame:
    """Newest non-NULL value of every field per key, combined before the shuffle.

    Events of one instant follow their ``sequence``; what is equal in both too
    is settled by the value, the greatest, so that every run agrees.
    """
    fields = [c for c in events.columns if c not in keys and c not in (by, SEQUENCE)]
    place = [F.col(by)] + ([F.coalesce(SEQUENCE, F.lit(0))] if SEQUENCE in events.columns else [])
    newest = [F.max_by(c, F.when(F.col(c).isNotNull(), F.struct(*place, F.col(c)))).alias(c) for c in fields]
    if not drop_by:
        newest.append(F.max(by).alias(by))
    return events.groupBy(*keys).agg(*newest)


def deciding_events(events: DataFrame, keys: Sequence[str], by: str = "event_at") -> DataFrame:
    """The events that some field of ``latest`` comes from, at most one for each field of a key; equal ones once."""
    fields = [c for c in events.columns if c not in keys and c not in (by, SEQUENCE)]
    place = [F.col(by)] + ([F.coalesce(SEQUENCE, F.lit(0))] if SEQUENCE in events.columns else [])
    whole = F.struct(*events.columns)
    winners = [F.max_by(whole, F.when(F.col(c).isNotNull(), F.struct(*place, F.col(c)))) for c in fields]
    newest = F.max_by(whole, F.struct(*place))
    kept = events.groupBy(*keys).agg(F.array_distinct(F.array_compact(F.array(*winners, newest))).alias("__kept"))
    return kept.select(F.inline("__kept")).select(*events.columns)


#: Tables of states, and the keys of a state.
STATE_KEYS = {"pipeline_runs": ["pipeline_run_id"], "pipeline_task_metrics": ["pipeline_run_id", "task_name"]}


def run_states(events: DataFrame) -> DataFrame:
    """Current state of every run; counters nobody reported are 0."""
    state = latest(events, ["pipeline_run_id"])
    return state.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in RUN_COUNTERS if c in state.columns})


def task_states(events: DataFrame) -> DataFrame:
    """Current state of every (run, task) with its duration in seconds.

    A task that was started again has no end until it completes again.
    """
    state = latest(events, ["pipeline_run_id", "task_name"])
    ended = F.when(F.col("completed_at") >= F.col("started_at"), F.col("completed_at"))
    return state.withColumns(
        {
            "completed_at": ended,
            "records_processed": F.coalesce(F.col("records_processed"), F.lit(0)),
            "duration_seconds": seconds_between(F.col("started_at"), ended),
        }
    )


def seconds_between(start: Column, end: Column) -> Column:
    return (F.unix_micros(end) - F.unix_micros(start)) / 1_000_000


def skip_ingested(candidates: DataFrame, manifest: DataFrame) -> DataFrame:
    """Candidate files whose (name, checksum) was not ingested successfully before."""
    done = manifest.filter("status = 'SUCCESS'").select("source_file", "file_checksum")
    return candidates.join(done, ["source_file", "file_checksum"], "left_anti")


def quality_rollup(results: DataFrame) -> DataFrame:
    """PASS and FAIL counts per run."""
    return results.groupBy("pipeline_run_id").agg(
        F.count_if(F.col("status") == "PASS").alias("quality_checks_passed"),
        F.count_if(F.col("status") == "FAIL").alias("quality_checks_failed"),
    )


def with_quality_rollup(runs: DataFrame, results: DataFrame) -> DataFrame:
    """Runs with their counts replaced by those of the recorded results."""
    kept = runs.drop("quality_checks_passed", "quality_checks_failed")
    joined = join_on(kept, quality_rollup(results), ["pipeline_run_id"])
    counts = ("quality_checks_passed", "quality_checks_failed")
    return joined.withColumns({c: F.coalesce(F.col(c), F.lit(0)) for c in counts})


# --- serving reads ----------------------------------------------------------


def newest(df: DataFrame, by: str, tie: str, limit: int) -> DataFrame:
    return df.orderBy(F.col(by).desc(), F.col(tie)).limit(limit)


def recent_runs(runs: DataFrame, limit: int = 50) -> DataFrame:
    return newest(runs, "started_at", "pipeline_run_id", limit)


def recent_quality_results(results: DataFrame, run_id: str | None = None, limit: int = 200) -> DataFrame:
    """All results of one run, or the newest ones of any run."""
    if run_id is not None:
        return results.filter(F.col("pipeline_run_id") == run_id).orderBy(F.col("checked_at").desc())
    return newest(results, "checked_at", "quality_result_id", limit)


def recent_task_metrics(tasks: DataFrame, run_id: str | None = None, limit: int = 100) -> DataFrame:
    """Tasks of one run in the order they started, or the newest ones of any run."""
    if run_id is not None:
        return tasks.filter(F.col("pipeline_run_id") == run_id).orderBy("started_at")
    return tasks.orderBy(F.col("started_at").desc(), "pipeline_run_id", "task_name").limit(limit)


# --- the stored ledger ------------------------------------------------------


#: Folder of the compacted events of each table, a version each, below the ledger's.
COMPACTED = "_compacted"
#: Bytes of events, as they are stored, that a compaction folds into one file.
FILE_BYTES = 16 << 20


class Ledger:
    """Event tables below one folder. Each change appends one small file.

    ``compact`` writes the events of a table anew as few files, with the names
    of the files it took them from. Readers take the newest version that is
    complete, and the files it does not name. Nothing that a reader or another
    writer may be using is changed: what a version has taken over is deleted by
    the compaction after the next, and a version is complete once the list of
    names, written last, is there.
    """

    def __init__(self, spark: SparkSession, root: str) -> None:
        self._spark = spark
        self._root = root.rstrip("/")

    def events(self, table: str) -> DataFrame:
        """All events: those of the newest compacted version and those after it."""
        path = f"{self._root}/{table}"
        version, taken = self._newest(table)
        if version is None:
            if path_exists(self._spark, path):
                return self._spark.read.schema(SCHEMAS[table]).parquet(path)
            return self._spark.createDataFrame([], SCHEMAS[table])
        later = [f"{path}/{name}" for name in list_names(self._spark, path) if name not in taken and not name.startswith(("_", "."))]
        return self._spark.read.schema(SCHEMAS[table]).parquet(f"{version}/events", *later)

    def append(self, table: str, rows: DataFrame) -> None:
        rows.write.mode("append").parquet(f"{self._root}/{table}")

    def _versions(self, table: str) -> list[str]:
        """Complete versions, oldest first."""
        folder = f"{self._root}/{COMPACTED}/{table}"
        names = sorted(n for n in list_names(self._spark, folder) if path_exists(self._spark, f"{folder}/{n}/files/_SUCCESS"))
        return [f"{folder}/{n}" for n in names]

    def _newest(self, table: str) -> tuple[str | None, set[str]]:
        versions = self._versions(table)
        return (versions[-1], self._taken(versions[-1])) if versions else (None, set())

    def _taken(self, version: str) -> set[str]:
        """Names of the files whose events a version holds: those between two compactions."""
        return {r.name for r in self._spark.read.schema("name string").parquet(f"{version}/files").collect()}

    def compact(self, table: str, now: datetime | None = None) -> int:
        """Fold a table's files into one version; how many files it replaces from now on.

        Of runs and tasks only events stay that decide a field of their state.
        Another compaction at the same time makes a version of its own; the
        one with the later name holds, and either is complete.
        """
        path = f"{self._root}/{table}"
        names = [n for n in list_names(self._spark, path) if not n.startswith(("_", "."))]
        versions = self._versions(table)
        known = self._taken(versions[-1]) if versions else set()
        later = [n for n in names if n not in known]
        if not later:
            return 0
        sources = [f"{path}/{n}" for n in later] + ([f"{versions[-1]}/events"] if versions else [])
        events = self._spark.read.schema(SCHEMAS[table]).parquet(*sources)
        if table in STATE_KEYS:
            events = deciding_events(events, STATE_KEYS[table])
        stamp = (now or datetime.now(UTC)).strftime("%Y%m%dT%H%M%S%f")
        # Versions sort by their number, which grows even after old ones are gone.
        number = int(versions[-1].rsplit("/", 1)[1].split("-")[0]) + 1 if versions else 0
        version = f"{self._root}/{COMPACTED}/{table}/{number:06}-{stamp}-{uuid.uuid4().hex[:8]}"
        self._in_files(events, table, max(1, -(-size_of(self._spark, sources) // FILE_BYTES))).write.parquet(f"{version}/events")
        taken = self._spark.createDataFrame([(n,) for n in sorted(known | set(later))], "name string")
        taken.coalesce(1).write.parquet(f"{version}/files")
        self._clear(path, versions)
        return len(later)

    def _in_files(self, events: DataFrame, table: str, files: int) -> DataFrame:
        """As many partitions as files are wanted, so that no task holds more than a file's share of the events."""
        if files <= int(self._spark.conf.get("spark.sql.shuffle.partitions")):
            return events.coalesce(files)
        return events.repartition(files, *STATE_KEYS.get(table, ()))

    def _clear(self, path: str, before: list[str]) -> None:
        """Delete what readers have had a whole compaction to leave: versions before the last one, and its files."""
        if not before:
            return
        for name in self._taken(before[-1]):
            delete_path(self._spark, f"{path}/{name}")
        for version in before[:-1]:
            delete_path(self._spark, version)

    def _event(self, table: str, **values) -> None:
        names = [part.split()[0] for part in SCHEMAS[table].split(", ")]
        row = tuple(values.get(name) for name in names)
        self.append(table, self._spark.createDataFrame([row], SCHEMAS[table]).coalesce(1))

    def create_run(self, name: str, dataset_id: str, now: datetime | None = None) -> str:
        run_id, now = str(uuid.uuid4()), now or datetime.now(UTC)
        self._event(
            "pipeline_runs",
            pipeline_run_id=run_id,
            pipeline_name=name,
            dataset_id=dataset_id,
            started_at=now,
            status="RUNNING",
            event_at=now,
            sequence=BEGUN,
        )
        return run_id

    def complete_run(self, run_id: str, status: str, now: datetime | None = None, **fields) -> None:
        """Close a run; counters that are not passed keep what was reported before."""
        now = now or datetime.now(UTC)
        self._event("pipeline_runs", pipeline_run_id=run_id, status=status, completed_at=now, event_at=now, sequence=ENDED, **fields)

    def start_task(self, run_id: str, task: str, now: datetime | None = None) -> None:
        now = now or datetime.now(UTC)
        self._event(
            "pipeline_task_metrics",
            pipeline_run_id=run_id,
            task_name=task,
            started_at=now,
            status="RUNNING",
            event_at=now,
            sequence=BEGUN,
        )

    def complete_task(
        self, run_id: str, task: str, status: str, records: int = 0, now: datetime | None = None
    ) -> None:
        now = now or datetime.now(UTC)
        self._event(
            "pipeline_task_metrics",
            pipeline_run_id=run_id,
            task_name=task,
            completed_at=now,
            records_processed=records,
            status=status,
            event_at=now,
            sequence=ENDED,
        )

    def record_results(self, results: DataFrame, layer: str, dataset_name: str) -> None:
        """Append a whole suite's results at once."""
        names = [part.split()[0] for part in QUALITY_SCHEMA.split(", ")]
        described = results.withColumns(
            {
                "quality_result_id": F.uuid(),
                "dataset_layer": F.lit(layer),
                "dataset_name": F.lit(dataset_name),
            }
        )
        self.append("data_quality_results", described.select(*names).coalesce(1))

    def record_ingestion(self, files: DataFrame) -> None:
        names = [part.split()[0] for part in MANIFEST_SCHEMA.split(", ")]
        self.append("ingestion_manifest", files.withColumn("status", F.lit("SUCCESS")).select(*names))

    def already_ingested(self, source_file: str, file_checksum: str) -> bool:
        same = (F.col("source_file") == source_file) & (F.col("file_checksum") == file_checksum)
        return not self.events("ingestion_manifest").filter(same & (F.col("status") == "SUCCESS")).isEmpty()

    def runs(self) -> DataFrame:
        return run_states(self.events("pipeline_runs"))

    def tasks(self) -> DataFrame:
        return task_states(self.events("pipeline_task_metrics"))

    def quality_results(self) -> DataFrame:
        return self.events("data_quality_results")

    def manifest(self) -> DataFrame:
        return self.events("ingestion_manifest")
