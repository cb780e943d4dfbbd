"""Data-quality checks. Each yields rows of one result table; suites share passes.

A suite runs at most three aggregations whatever the number of checks: one over
the columns, one over the unit series, and one over the duplicate keys where
these are not a series and its clock, whose copies lie side by side.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.functions.columns import any_of, outside, percentage
from fleetlake.functions.batches import BatchColumns
from fleetlake.functions.windows import cycle_gap
from fleetlake.operators.series import counted_series, gap_list, over_series, spike_columns
from fleetlake.operators.silver import DUPLICATE_KEYS
from fleetlake.operators.skew import flag_copies
from fleetlake.settings import (
    KEY_COLUMNS,
    METADATA_COLUMNS,
    READING_COLUMNS,
    SENSOR_COLUMNS,
    SETTING_COLUMNS,
    SILVER_COLUMNS,
    Freshness,
    SensorRange,
    Series,
    SeriesWindow,
    Settings,
    SkewLimits,
    SpikeRule,
    default_ranges,
)

# --- Fixed values: the shares at which a check turns from WARN to FAIL ---
COMPLETENESS_THRESHOLD = 0.95
RANGE_FAIL_PERCENT = 5.0
SPIKE_FAIL_PERCENT = 2.0
# --- end of fixed values ---

WHOLE, REAL = (T.LongType, T.IntegerType), (T.DoubleType, T.FloatType)
EXPECTED_TYPES = {c: WHOLE if c in KEY_COLUMNS else REAL for c in READING_COLUMNS}

RESULT_FIELDS = (
    "check_name",
    "check_type",
    "status",
    "records_checked",
    "failed_records",
    "failure_percentage",
    "details",
)


@dataclass(frozen=True)
class Check:
    """One future result row: the aggregates it needs, and the row they make.

    ``measures`` go into the shared aggregation; ``row`` turns their columns
    into the result struct.
    """

    measures: Mapping[str, Column]
    row: Column


def _row(
    name: str,
    kind: str,
    status: Column | str,
    checked: Column | int = 0,
    failed: Column | int = 0,
    details: Column | str = "",
) -> Column:
    def column(value) -> Column:
        return value if isinstance(value, Column) else F.lit(value)

    checked, failed = column(checked).cast("bigint"), column(failed).cast("bigint")
    return F.struct(
        F.lit(name).alias("check_name"),
        F.lit(kind).alias("check_type"),
        column(status).alias("status"),
        checked.alias("records_checked"),
        failed.alias("failed_records"),
        percentage(failed, checked, 4).alias("failure_percentage"),
        column(details).alias("details"),
    )


def _sql_row(name: str, kind: str, status: str, failed: str, **facts: str) -> Column:
    """:func:`_row` over all rows from SQL text, which Spark takes in one call; suites have dozens of such rows."""
    share = f"CAST({failed} AS DOUBLE) / nullif(CAST(__total AS DOUBLE), 0.0D) * 100.0D"
    details = ", ".join(f"'{fact}', {text}" for fact, text in facts.items())
    details = f"to_json(named_struct({details}))" if facts else "''"
    return F.expr(
        f"named_struct('check_name', '{name}', 'check_type', '{kind}', 'status', {status}, "
        f"'records_checked', CAST(__total AS BIGINT), 'failed_records', CAST({failed} AS BIGINT), "
        f"'failure_percentage', round(coalesce({share}, 0.0D), 4), 'details', {details})"
    )


def _sql_graded(failed: str, fail_percent: float) -> str:
    share = f"coalesce(try_divide({failed}, __total) * 100, 0.0D)"
    return f"CASE WHEN {failed} = 0 THEN 'PASS' WHEN {share} < {_number(fail_percent)} THEN 'WARN' ELSE 'FAIL' END"


def _number(value: float) -> str:
    return f"{float(value)!r}D" if isinstance(value, float) else str(value)


def _facts(**values) -> Column:
    """What a check measured and against what, as JSON that ``from_json`` reads back; NULL facts are left out."""

    def column(value) -> Column:
        if isinstance(value, (list, tuple)):
            return F.array(*(F.lit(v) for v in value))
        return value if isinstance(value, Column) else F.lit(value)

    return F.to_json(F.struct(*(column(v).alias(name) for name, v in values.items())))


NULLS = "__null_"


def _total() -> Column:
    return F.col("__total")


def _count() -> dict[str, Column]:
    return {"__total": F.count(F.lit(1))}


def collect_results(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """Run the checks in a single aggregation, one result row per check."""
    measures: dict[str, Column] = {}
    for check in checks:
        measures.update(check.measures)
    one = df.agg(*(column.alias(name) for name, column in measures.items()))
    return one.select(F.inline(F.array(*(check.row for check in checks))))


class ObservedChecks:
    """Checks that come out of the write of a table instead of another read of it.

    ``watch`` the frame, write what it returns once, then ask for the results.
    ``only`` restricts the checks to rows of a frame that holds others too;
    such frames take checks of counts, NULLs and newest values, the last being
    NULL on the other rows.
    """

    def __init__(self, checks: Sequence[Check], only: Column | None = None, name: str = "checks"):
        self._checks, self._only = list(checks), only
        self._observation, self._name = Observation(name), name
        self._kinds: T.StructType | None = None

    def _measures(self) -> dict[str, Column]:
        measures: dict[str, Column] = {**_count(), "__all": F.count(F.lit(1))}
        for check in self._checks:
            measures.update(check.measures)
        if self._only is None:
            return measures
        for name in measures:
            if name == "__total":
                measures[name] = F.count_if(self._only)
            elif name.startswith(NULLS):
                measures[name] = F.count_if(self._only & F.col(name.removeprefix(NULLS)).isNull())
        return measures

    def watch(self, df: DataFrame) -> DataFrame:
        columns = [column.alias(name) for name, column in self._measures().items()]
        self._kinds = df.agg(*columns).schema
        return df.observe(self._observation, *columns)

    def rows(self) -> tuple[int, int]:
        """(rows the checks looked at, all rows) of the write."""
        return self._observation.get["__total"], self._observation.get["__all"]

    def results(self, spark: SparkSession, run_id: str = "", now: datetime | None = None) -> DataFrame:
        """The suite's rows; waits for the write."""
        measured = self._observation.get
        one = spark.createDataFrame([tuple(measured[f.name] for f in self._kinds)], self._kinds)
        return _stamped([one.select(F.inline(F.array(*(c.row for c in self._checks))))], run_id, now)


# --- schema: decided while the plan is built --------------------------------


def required_columns(df: DataFrame, include_metadata: bool = True) -> Check:
    required = READING_COLUMNS + (METADATA_COLUMNS if include_metadata else ())
    missing = [c for c in required if c not in df.columns]
    return _schema_check("required_columns", "FAIL", missing)


def column_types(df: DataFrame) -> Check:
    wrong = [
        f"{f.name} {f.dataType.simpleString()}"
        for f in df.schema.fields
        if f.name in EXPECTED_TYPES and not isinstance(f.dataType, EXPECTED_TYPES[f.name])
    ]
    return _schema_check("column_types", "FAIL", wrong)


def unexpected_columns(df: DataFrame, include_metadata: bool = True) -> Check:
    known = {*READING_COLUMNS, *SILVER_COLUMNS, *(METADATA_COLUMNS if include_metadata else ())}
    extra = [c for c in df.columns if c not in known]
    return _schema_check("unexpected_columns", "WARN", extra)


def _schema_check(name: str, bad_status: str, columns: list[str]) -> Check:
    if columns:
        return Check(_count(), _row(name, "schema", bad_status, details=_facts(columns=columns)))
    return Check(_count(), _row(name, "schema", "PASS", _total()))


def schema_checks(df: DataFrame, include_metadata: bool = True) -> list[Check]:
    return [required_columns(df, include_metadata), column_types(df), unexpected_columns(df, include_metadata)]


# --- completeness -----------------------------------------------------------


def _nulls(column: str) -> dict[str, Column]:
    return {f"{NULLS}{column}": F.expr(f"count_if(`{column}` IS NULL)")}


def null_check(df: DataFrame, column: str) -> Check:
    name = f"null_{column}"
    if column not in df.columns:
        return Check(_count(), _row(name, "completeness", "FAIL", details=_facts(absent=[column])))
    nulls = f"`{NULLS}{column}`"
    status = f"CASE WHEN {nulls} = 0 THEN 'PASS' ELSE 'FAIL' END"
    return Check({**_count(), **_nulls(column)}, _sql_row(name, "completeness", status, nulls))


def completeness_check(column: str, threshold: float = COMPLETENESS_THRESHOLD) -> Check:
    """An empty table counts as incomplete."""
    nulls = f"`{NULLS}{column}`"
    share = f"coalesce(1.0D - try_divide({nulls}, __total), 0.0D)"
    status = f"CASE WHEN {share} < {_number(threshold)} THEN 'FAIL' WHEN {share} < 1.0D THEN 'WARN' ELSE 'PASS' END"
    facts = {"share": f"round({share}, 6)", "least": _number(threshold)}
    row = _sql_row(f"completeness_{column}", "completeness", status, nulls, **facts)
    return Check({**_count(), **_nulls(column)}, row)


def completeness_checks(
    df: DataFrame,
    critical: Sequence[str] = KEY_COLUMNS + SETTING_COLUMNS,
    sensors: Sequence[str] = SENSOR_COLUMNS,
    threshold: float = COMPLETENESS_THRESHOLD,
) -> list[Check]:
    return [null_check(df, c) for c in critical] + [
        completeness_check(s, threshold) for s in sensors if s in df.columns
    ]


# --- duplicates -------------------------------------------------------------


def duplicate_check(df: DataFrame, keys: Sequence[str] = DUPLICATE_KEYS) -> DataFrame:
    """One result row. Counts every copy; keys are combined before the shuffle."""
    keys_present = [k for k in keys if k in df.columns]
    if not keys_present:
        missing = _row("duplicate_records", "duplicate", "WARN", details=_facts(absent=list(keys)))
        return collect_results(df, [Check(_count(), missing)])
    copies = df.groupBy(*keys_present).agg(F.count(F.lit(1)).alias("__n"))
    measures = {
        "__total": F.coalesce(F.sum("__n"), F.lit(0)),
        "copies": F.coalesce(F.sum(F.when(F.col("__n") > 1, F.col("__n"))), F.lit(0)),
    }
    return collect_results(copies, [Check(measures, _duplicate_row(keys_present))])


def _duplicate_row(keys: Sequence[str]) -> Column:
    failed = F.col("copies")
    status = F.when(failed == 0, "PASS").otherwise("FAIL")
    return _row("duplicate_records", "duplicate", status, _total(), failed, _facts(keys=list(keys)))


def duplicate_rows(
    df: DataFrame, keys: Sequence[str] = DUPLICATE_KEYS, limits: SkewLimits = SkewLimits()
) -> DataFrame:
    """All copies of repeated keys."""
    present = [k for k in keys if k in df.columns]
    if not present:
        return df.limit(0)
    return flag_copies(df, present, "__copy", limits).filter("__copy").drop("__copy")


# --- ranges -----------------------------------------------------------------


def range_check(sensor: str, bounds: SensorRange) -> Check:
    name = f"__outside_{sensor}"
    facts = {"low": _number(bounds.min), "high": _number(bounds.max)}
    row = _sql_row(f"range_{sensor}", "range", _sql_graded(name, RANGE_FAIL_PERCENT), name, **facts)
    beyond = f"count_if(`{sensor}` < {_number(float(bounds.min))} OR `{sensor}` > {_number(float(bounds.max))})"
    return Check({**_count(), name: F.expr(beyond)}, row)


def range_checks(df: DataFrame, ranges: Mapping[str, SensorRange] | None = None) -> list[Check]:
    ranges = default_ranges() if ranges is None else ranges
    return [range_check(s, r) for s, r in ranges.items() if s in df.columns]


def range_violations(
    df: DataFrame, ranges: Mapping[str, SensorRange] | None = None, shape: str = "long"
) -> DataFrame:
    """One row per offending value.

    ``long`` has (violated_sensor, value, range_min, range_max); ``wide`` keeps
    one column per sensor, NULL but for the one that violates. Both read the
    table once; a row without violations produces nothing.
    """
    ranges = {s: r for s, r in (default_ranges() if ranges is None else ranges).items() if s in df.columns}
    context = [c for c in ("unit_id", "cycle", "dataset_id") if c in df.columns]
    if not ranges:
        return df.select(*context, F.lit(None).cast("string").alias("violated_sensor")).limit(0)
    found = F.array_compact(F.array(*(_violation(s, r) for s, r in ranges.items())))
    long = df.filter(any_of(outside(s, r) for s, r in ranges.items())).select(*context, F.inline(found))
    if shape == "long":
        return long
    return long.select(
        *context,
        *(F.when(F.col("violated_sensor") == s, F.col("value")).alias(s) for s in ranges),
        "violated_sensor",
    )


def _violation(sensor: str, bounds: SensorRange) -> Column:
    entry = F.struct(
        F.lit(sensor).alias("violated_sensor"),
        F.col(sensor).cast("double").alias("value"),
        F.lit(float(bounds.min)).alias("range_min"),
        F.lit(float(bounds.max)).alias("range_max"),
    )
    return F.when(outside(sensor, bounds), entry)


# --- freshness --------------------------------------------------------------


def freshness_check(
    df: DataFrame,
    layer: str,
    now: datetime | None = None,
    freshness: Freshness = Freshness(),
    column: str = "ingested_at",
) -> Check:
    """PASS up to the layer's age limit, WARN up to twice that, FAIL beyond.

    Timestamps without a zone count as UTC.
    """
    name, limit = f"freshness_{layer}", freshness.hours(layer)
    if column not in df.columns:
        return Check(_count(), _row(name, "freshness", "FAIL", details=_facts(absent=[column])))
    kind = df.schema[column].dataType
    newest = F.col("__newest")
    if not isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        details = _facts(rows=_total(), stamped=newest.isNotNull(), type=kind.simpleString())
        status = F.when((_total() == 0) | newest.isNull(), "FAIL").otherwise("WARN")
        row = _row(name, "freshness", status, details=details)
        return Check({**_count(), "__newest": F.max(column)}, row)
    moment = F.col(column)
    if isinstance(kind, T.TimestampNTZType):
        micros = F.unix_micros(F.convert_timezone(F.lit("UTC"), F.current_timezone(), moment).cast("timestamp"))
    else:
        micros = F.unix_micros(moment)
    present = F.unix_micros(F.lit(now).cast("timestamp") if now else F.current_timestamp())
    age = (present - newest) / 3_600_000_000
    status = (
        F.when((_total() == 0) | newest.isNull(), "FAIL")
        .when(age <= limit, "PASS")
        .when(age <= 2 * limit, "WARN")
        .otherwise("FAIL")
    )
    details = _facts(rows=_total(), stamped=newest.isNotNull(), age_hours=F.round(age, 4), limit_hours=limit)
    checked = F.when(newest.isNotNull(), _total()).otherwise(0)
    return Check({**_count(), "__newest": F.max(micros)}, _row(name, "freshness", status, checked, 0, details))


# --- series: gaps and spikes ------------------------------------------------


def _gap_row(units: Column) -> Column:
    failed = F.col("gaps")
    details = _facts(gaps=failed, units=units)
    status = F.when(failed == 0, "PASS").otherwise("WARN")
    return _row("cycle_gaps", "cycle_gap", status, _total(), failed, details)


def _spike_row(sensor: str, rule: SpikeRule) -> Column:
    failed = f"spikes_{sensor}"
    facts = {"window": _number(rule.window), "sigma": _number(rule.sigma)}
    return _sql_row(failed.replace("spikes", "spike", 1), "spike", _sql_graded(failed, SPIKE_FAIL_PERCENT), failed, **facts)


def series_results(
    df: DataFrame,
    sensors: Sequence[str] = SENSOR_COLUMNS,
    rule: SpikeRule = SpikeRule(),
    series: Series = Series(),
    gaps: bool = True,
    spikes: bool = True,
    limits: SkewLimits = SkewLimits(),
    copies: Sequence[str] = (),
) -> DataFrame:
    """Gap and spike results in one pass over the series, after the result on copies if their keys are given.

    Flags are counted per unit where the windows left them, then added up.
    Keys of copies have to be those of :func:`copies_in_series`.
    """
    if any(c not in df.columns for c in (series.clock, "unit_id")):
        rows = [_row("cycle_gaps", "cycle_gap", "FAIL", details="Required columns unit_id and cycle not found")]
        return collect_results(df, [Check(_count(), row) for row in rows if gaps])
    series = series.on(df)
    present = [s for s in sensors if s in df.columns] if spikes else []

    tests = BatchColumns(spikes={f"spikes_{s}": [s] for s in present}, rule=rule)

    def gap(w: SeriesWindow) -> dict[str, Column]:
        return {"gaps": cycle_gap(series.clock, w).cast("int")}

    sums = [*([gap] if gaps else []), *(copy_stages(series.clock) if copies else [])]
    slim = df.select(*series.keys, *series.order, *series.ties, *present)
    summed = [*(["gaps"] if gaps else []), *(["copies"] if copies else [])]
    if present:
        per_unit = counted_series(slim, tests, *sums, unit="unit_id", series=series, before=COPY_ROWS, limits=limits)
    else:
        flagged = over_series(slim, *sums, series=series, before=COPY_ROWS, limits=limits)
        per_unit = flagged.groupBy(*series.keys).agg(F.count(F.lit(1)).alias("__total"), *(F.sum(c).alias(c) for c in summed))
    measures = {c: F.expr(f"coalesce(sum({c}), 0)") for c in ("__total", *(f"spikes_{s}" for s in present), *summed)}
    units = {"__units": F.count_distinct("unit_id") + F.max(F.col("unit_id").isNull().cast("int"))} if gaps else {}
    rows = [_duplicate_row(copies)] if copies else []
    rows += [_gap_row(F.coalesce("__units", F.lit(0)))] if gaps else []
    rows += [_spike_row(s, rule) for s in present]
    # The measures are the same for all; one check brings them.
    return collect_results(per_unit, [Check({} if i else {**measures, **units}, row) for i, row in enumerate(rows)])


#: So many rows back a row sees whether it is a copy, and whether the row before it was one.
COPY_ROWS = 2


def copy_stages(clock: str) -> list[Callable[[SeriesWindow], dict[str, Column]]]:
    """``copies``: how many a row adds to those before it, two where it is the first to repeat a clock value, then one each.

    NULL clock values are equal.
    """
    back = range(1, COPY_ROWS + 1)

    def look(w: SeriesWindow) -> dict[str, Column]:
        return {"__row": F.row_number().over(w.spec), **{f"__clock_{n}": F.lag(clock, n).over(w.spec) for n in back}}

    def count(_: SeriesWindow) -> dict[str, Column]:
        again = [(F.col("__row") > n) & F.col(clock).eqNullSafe(F.col(f"__clock_{n}")) for n in back]
        return {"copies": F.when(again[0], F.when(again[1], 1).otherwise(2)).otherwise(0)}

    return [look, count]


def copies_in_series(df: DataFrame, keys: Sequence[str], series: Series) -> bool:
    """Whether rows with the same keys are those of one unit at one clock value, which come one after the other."""
    if any(c not in df.columns for c in (series.clock, "unit_id")) or len(series.order) > 1:
        return False
    return {k for k in keys if k in df.columns} == {*series.on(df).keys, series.clock}


def cycle_gaps(df: DataFrame, series: Series = Series(), **options) -> tuple[DataFrame, DataFrame]:
    """(result row, the gaps)."""
    return series_results(df, series=series, spikes=False, **options), gap_list(df, series, **options)


def units_with_gaps(gaps: DataFrame) -> DataFrame:
    return gaps.select("unit_id").distinct().orderBy("unit_id")


def spike_rows(
    df: DataFrame, sensors: Sequence[str] = SENSOR_COLUMNS, rule: SpikeRule = SpikeRule(), **options
) -> DataFrame:
    """Rows on which any sensor spikes, with the flag of each sensor."""
    present = [s for s in sensors if s in df.columns]
    return spike_columns(df, present, rule, **options).filter(any_of(F.col(f"spike_{s}") for s in present))


# --- suites -----------------------------------------------------------------


def _stamped(results: Iterable[DataFrame], run_id: str, now: datetime | None) -> DataFrame:
    checked_at = F.lit(now).cast("timestamp") if now else F.current_timestamp()
    together = reduce(DataFrame.unionByName, results)
    return together.select(
        *RESULT_FIELDS[:-1], checked_at.alias("checked_at"), F.lit(run_id).alias("pipeline_run_id"), "details"
    )


def validate_bronze(
    df: DataFrame, run_id: str = "", now: datetime | None = None, settings: Settings = Settings()
) -> DataFrame:
    wide = [
        *schema_checks(df),
        *completeness_checks(df),
        *range_checks(df, settings.ranges),
        freshness_check(df, "bronze", now, settings.freshness),
    ]
    series = {"rule": settings.spikes, "series": settings.series, "limits": settings.limits}
    if copies_in_series(df, DUPLICATE_KEYS, settings.series):
        keys = [k for k in DUPLICATE_KEYS if k in df.columns]
        ordered = [series_results(df, copies=keys, **series)]
    else:
        ordered = [duplicate_check(df), series_results(df, **series)]
    return _stamped([collect_results(df, wide), *ordered], run_id, now)


def silver_checks(df: DataFrame, now: datetime | None = None, settings: Settings = Settings()) -> list[Check]:
    return [
        *schema_checks(df),
        *completeness_checks(df),
        freshness_check(df, "silver", now, settings.freshness, "silver_processed_at"),
    ]


def validate_silver(
    df: DataFrame, run_id: str = "", now: datetime | None = None, settings: Settings = Settings()
) -> DataFrame:
    return _stamped([collect_results(df, silver_checks(df, now, settings))], run_id, now)


def not_empty_check() -> Check:
    details = _facts(rows=_total())
    status = F.when(_total() > 0, "PASS").otherwise("FAIL")
    return Check(_count(), _row("gold_not_empty", "completeness", status, _total(), details=details))


def validate_gold(
    df: DataFrame,
    run_id: str = "",
    now: datetime | None = None,
    settings: Settings = Settings(),
    keys: Sequence[str] | None = None,
) -> DataFrame:
    """Rows at all, and none twice. Unit ids repeat across data sets, so by
    default a row is known by unit, cycle, and equipment key or data set where
    the table has one.
    """
    if keys is None:
        place = next((c for c in ("equipment_key", "dataset_id") if c in df.columns), None)
        keys = [*KEY_COLUMNS, *([place] if place else [])]
    results = [collect_results(df, [not_empty_check()])]
    if all(k in df.columns for k in KEY_COLUMNS):
        results.append(duplicate_check(df, keys))
    return _stamped(results, run_id, now)


SUITES = {"bronze": validate_bronze, "silver": validate_silver, "gold": validate_gold}


class QualityFailure(RuntimeError):
    """Raised by :func:`validate` when asked to stop on a status."""


def validate(
    df: DataFrame,
    layer: str,
    run_id: str = "",
    now: datetime | None = None,
    settings: Settings = Settings(),
    fail_on: str | None = None,
) -> DataFrame:
    """Run a layer's suite. Results are recorded, not gating, unless ``fail_on`` is set."""
    results = SUITES[layer](df, run_id, now, settings)
    if fail_on:
        bad = results.filter(F.col("status") == fail_on).select("check_name").collect()  # a row per check
        if bad:
            raise QualityFailure(f"{layer}: {[r.check_name for r in bad]} are {fail_on}")
    return results


def status_tally(results: DataFrame, digits: int = 2) -> DataFrame:
    """One row: total_checks, passed, warned, failed, pass_percentage."""
    counts = results.agg(
        F.count(F.lit(1)).alias("total_checks"),
        *(
            F.count_if(F.col("status") == status).alias(name)
            for status, name in (("PASS", "passed"), ("WARN", "warned"), ("FAIL", "failed"))
        ),
    )
    return counts.withColumn("pass_percentage", percentage(F.col("passed"), F.col("total_checks"), digits))


def model_tests(df: DataFrame, not_null: Sequence[str] = (), unique: Sequence[str] = ()) -> DataFrame:
    """(test_name, column_name, failures): NULLs, and values that occur more than once."""
    nulls = [
        F.struct(
            F.lit("not_null").alias("test_name"),
            F.lit(c).alias("column_name"),
            F.col(f"__null_{c}").alias("failures"),
        )
        for c in not_null
    ]
    parts = []
    if nulls:
        counted = df.agg(*(column.alias(name) for c in not_null for name, column in _nulls(c).items()))
        parts.append(counted.select(F.inline(F.array(*nulls))))
    for c in unique:
        repeated = df.filter(F.col(c).isNotNull()).groupBy(c).count().filter("count > 1")
        parts.append(
            repeated.agg(F.count(F.lit(1)).alias("failures")).select(
                F.lit("unique").alias("test_name"), F.lit(c).alias("column_name"), "failures"
            )
        )
    return reduce(DataFrame.unionByName, parts)
