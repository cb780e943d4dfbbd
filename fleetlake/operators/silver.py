"""Bronze to silver: types, duplicate quarantine, flags, quality status."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fleetlake.functions.columns import quality_status, range_violation
from fleetlake.functions.batches import BatchColumns
from fleetlake.functions.windows import cycle_gap
from fleetlake.operators.series import numbered_series, over_series, over_split_series
from fleetlake.operators.skew import flag_copies, profile_groups, split_hot
from fleetlake.settings import (
    KEY_COLUMNS,
    SENSOR_COLUMNS,
    SETTING_COLUMNS,
    SensorRange,
    Series,
    SeriesWindow,
    Settings,
    SkewLimits,
    SpikeRule,
)

DUPLICATE_KEYS = ("unit_id", "cycle", "dataset_id")


def enforce_types(df: DataFrame) -> DataFrame:
    """Keys as bigint, settings and sensors as double; what cannot be read as that raises, in any ANSI mode."""
    wanted = {**dict.fromkeys(KEY_COLUMNS, "bigint"), **dict.fromkeys(SETTING_COLUMNS + SENSOR_COLUMNS, "double")}
    have = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    return df.withColumns({c: _as(c, have[c], t) for c, t in wanted.items() if have.get(c, t) != t})


def _as(column: str, have: str, wanted: str) -> Column:
    value = F.col(column)
    if have in ("tinyint", "smallint", "int", "bigint", "float") and wanted == "double" or have in ("tinyint", "smallint", "int"):
        return value.cast(wanted)
    message = F.concat(F.lit(f"{column} cannot be cast to {wanted}: "), value.cast("string"))
    return F.when(value.isNotNull(), F.coalesce(value.try_cast(wanted), F.raise_error(message).cast(wanted)))


def sort_timeseries(df: DataFrame, series: Series = Series()) -> DataFrame:
    """Cluster units and order their rows, for files whose row groups can be skipped."""
    series = series.on(df)
    by = [*series.keys, *series.order, *series.ties]
    return df.repartitionByRange(*by).sortWithinPartitions(*by)


def flag_ranges(df: DataFrame, ranges: Mapping[str, SensorRange]) -> DataFrame:
    return df.withColumn("has_sensor_range_violation", range_violation(df.columns, ranges))


def flag_spikes(
    df: DataFrame,
    sensors: Sequence[str] = SENSOR_COLUMNS,
    rule: SpikeRule = SpikeRule(),
    series: Series = Series(),
    **options,
) -> DataFrame:
    present = [s for s in sensors if s in df.columns]
    spikes = BatchColumns(spikes={"has_sensor_spike": present}, rule=rule)
    return over_series(df, spikes, series=series, before=spikes.before, **options)


def assign_quality_status(df: DataFrame) -> DataFrame:
    flags = (F.col(c) for c in ("has_cycle_gap", "has_sensor_range_violation", "has_sensor_spike"))
    return df.withColumn("record_quality_status", quality_status(*flags))


def split_duplicates(
    df: DataFrame,
    keys: Sequence[str] = DUPLICATE_KEYS,
    keep: str = "none",
    order: Sequence[str] = ("source_file", "source_row_number"),
    limits: SkewLimits = SkewLimits(),
) -> tuple[DataFrame, DataFrame]:
    """(clean, quarantined). ``keep="none"`` removes every copy, ``"first"`` all but one.

    Keys the table lacks are ignored; with none left everything is clean.
    """
    keys = [k for k in keys if k in df.columns]
    if not keys:
        return df, df.limit(0)
    if keep == "first":
        return _split_after_first(df, keys, [c for c in order if c in df.columns], limits)
    flagged = flag_copies(df, keys, "__copy", limits)
    return flagged.filter(~F.col("__copy")).drop("__copy"), flagged.filter("__copy").drop("__copy")


def _split_after_first(df, keys, order, limits) -> tuple[DataFrame, DataFrame]:
    numbered = numbered_series(df, order or [c for c in df.columns if c not in keys] or keys, keys, "__copy", limits)
    return numbered.filter("__copy = 1").drop("__copy"), numbered.filter("__copy > 1").drop("__copy")


CLEAN, QUARANTINED = "clean", "quarantined"


def to_silver(
    bronze: DataFrame,
    settings: Settings = Settings(),
    now: datetime | None = None,
    duplicate_keys: Sequence[str] = DUPLICATE_KEYS,
) -> DataFrame:
    """The cleaned and flagged readings. See :func:`quarantined_duplicates` for the rest.

    One exchange: rows are placed by unit once, and both the duplicate test
    and the series windows work on that placement and one sort.
    """
    return _flagged(bronze, settings, now, duplicate_keys, False)


def with_outcome(
    bronze: DataFrame,
    settings: Settings = Settings(),
    now: datetime | None = None,
    duplicate_keys: Sequence[str] = DUPLICATE_KEYS,
    buckets: int | None = None,
) -> DataFrame:
    """Every row of bronze with its ``outcome``, ``clean`` or ``quarantined``.

    Clean rows are those of :func:`to_silver`, with their flags; the flags,
    status and time of quarantined ones are NULL. Both come out of the same
    exchange, so that one write can store them. ``buckets`` makes that exchange
    place rows by unit into as many partitions, one for each bucket to be
    written, unless there are hot units.
    """
    return _flagged(bronze, settings, now, duplicate_keys, True, buckets)


def _flagged(
    bronze: DataFrame,
    settings: Settings,
    now: datetime | None,
    duplicate_keys: Sequence[str],
    both: bool,
    buckets: int | None = None,
) -> DataFrame:
    typed = flag_ranges(enforce_types(bronze), settings.ranges)
    limits = settings.limits
    series = settings.series.on(typed)
    # without duplicates the clock alone orders a unit, and the sort is shared
    unique = Series(series.keys, series.order, ())
    keys = [k for k in duplicate_keys if k in typed.columns]
    within_units = set(series.keys) <= set(keys)
    profile = profile_groups(typed, series.keys, limits)
    sensors = [s for s in SENSOR_COLUMNS if s in typed.columns]
    spikes = BatchColumns(spikes={"has_sensor_spike": sensors}, rule=settings.spikes)

    def gaps(w: SeriesWindow) -> dict[str, Column | str]:
        return {"has_cycle_gap": cycle_gap(series.clock, w)}

    stages = (gaps, spikes)
    window = {"series": unique, "before": spikes.before, "limits": limits, "profile": profile}
    copies = None
    if not within_units:
        clean, copies = split_duplicates(typed, keys, limits=limits)
        flagged = over_series(clean, *stages, **window)
    elif not profile.hot_groups:
        placed = _with_copies(typed, series, keys, buckets)
        if both:
            # A unit's copies are a series of their own, beside that of its single rows.
            apart = {**window, "series": Series((*series.keys, "__copy"), series.order, ())}
            flagged = over_series(placed, *stages, **apart)
        else:
            flagged = over_series(placed.filter(~F.col("__copy")).drop("__copy"), *stages, **window)
    else:
        rest, hot = split_hot(typed, profile, series.keys)
        clean, copies = split_duplicates(hot, keys, limits=limits)
        placed = _with_copies(rest, series, keys)
        flagged = over_split_series(placed.filter(~F.col("__copy")).drop("__copy"), clean, *stages, **window)
        copies = placed.filter("__copy").drop("__copy").unionByName(copies)
    stamped = F.lit(now).cast("timestamp") if now else F.current_timestamp()
    silver = assign_quality_status(flagged).withColumn("silver_processed_at", stamped)
    if not both:
        return silver.select(*bronze.columns, *SILVER_COLUMNS)
    if "__copy" in silver.columns:
        own = {c: F.when(~F.col("__copy"), F.col(c)) for c in SILVER_COLUMNS}
        outcome = F.when(F.col("__copy"), QUARANTINED).otherwise(CLEAN)
        return silver.withColumns({**own, "outcome": outcome}).select(*bronze.columns, *SILVER_COLUMNS, "outcome")
    empty = {c: F.lit(None).cast(silver.schema[c].dataType) for c in SILVER_COLUMNS if c != "has_sensor_range_violation"}
    rest = copies.withColumns({**empty, "has_sensor_range_violation": F.lit(None).cast("boolean"), "outcome": F.lit(QUARANTINED)})
    columns = [*bronze.columns, *SILVER_COLUMNS, "outcome"]
    return silver.withColumn("outcome", F.lit(CLEAN)).select(*columns).unionByName(rest.select(*columns))


SILVER_COLUMNS = (
    "has_cycle_gap",
    "has_sensor_range_violation",
    "has_sensor_spike",
    "record_quality_status",
    "silver_processed_at",
)


def _with_copies(df: DataFrame, series: Series, keys: Sequence[str], buckets: int | None = None) -> DataFrame:
    """``__copy`` marks rows whose key is not single. Their units fit a task, so all copies do."""
    by = [*series.keys, *(k for k in keys if k not in series.keys)]
    copies = F.count(F.lit(1)).over(W.partitionBy(*by))
    placed = df.repartition(buckets, "unit_id") if buckets else df.repartition(*series.keys)
    return placed.withColumn("__copy", copies > 1)


def quarantined_duplicates(
    bronze: DataFrame, keys: Sequence[str] = DUPLICATE_KEYS, limits: SkewLimits = SkewLimits()
) -> DataFrame:
    """Every row that :func:`to_silver` leaves out."""
    return split_duplicates(enforce_types(bronze), keys, limits=limits)[1]
