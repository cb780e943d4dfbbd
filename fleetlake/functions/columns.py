"""Scalar column expressions of the reading domain."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce
from operator import add, or_

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlake.settings import RiskThresholds, SensorRange


def any_of(flags: Iterable[Column]) -> Column:
    """Three-valued OR; ``false`` when there is nothing to test."""
    flags = list(flags)
    return reduce(or_, flags) if flags else F.lit(False)


def total_of(terms: Iterable[Column]) -> Column:
    return reduce(add, terms)


def clip(value: Column, low: float, high: float) -> Column:
    """Bound a value; NULL stays NULL (``least``/``greatest`` would skip it)."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(float(low))), F.lit(float(high))))


def null_if_nan(value: Column) -> Column:
    return F.when(~F.isnan(value), value)


def outside(sensor: str, bounds: SensorRange) -> Column:
    """True beyond the inclusive bounds, NULL for a NULL reading."""
    value = F.col(sensor)
    return (value < F.lit(float(bounds.min))) | (value > F.lit(float(bounds.max)))


def range_violation(columns: Iterable[str], ranges: Mapping[str, SensorRange]) -> Column:
    have = set(columns)
    return any_of(outside(s, r) for s, r in ranges.items() if s in have)


def violated_sensor_count(columns: Iterable[str], ranges: Mapping[str, SensorRange]) -> Column:
    have = set(columns)
    flags = [F.coalesce(outside(s, r), F.lit(False)).cast("int") for s, r in ranges.items() if s in have]
    return total_of(flags) if flags else F.lit(0)


def quality_status(gap: Column, violation: Column, spike: Column) -> Column:
    """A NULL condition falls through to the next branch."""
    return (
        F.when(violation & spike, "QUARANTINED")
        .when(gap | violation | spike, "WARNING")
        .otherwise("VALID")
    )


def risk_level(score: Column, cutoffs: RiskThresholds = RiskThresholds()) -> Column:
    """NULL scores are LOW, like any score above the last cutoff."""
    return (
        F.when(score <= cutoffs.critical, "CRITICAL")
        .when(score <= cutoffs.high, "HIGH")
        .when(score <= cutoffs.medium, "MEDIUM")
        .otherwise("LOW")
    )


def degradation_score(score: Column) -> Column:
    return F.lit(100.0) - score


def equipment_key(columns: Iterable[str]) -> Column:
    """``unit_dataset``, or the unit alone where there is no data set column."""
    unit = F.col("unit_id").cast("string")
    return F.concat(unit, F.lit("_"), F.col("dataset_id")) if "dataset_id" in set(columns) else unit


def percentage(part: Column, whole: Column, digits: int) -> Column:
    """Rounded ``part / whole * 100``, 0.0 for an empty whole."""
    share = part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0)) * 100.0
    return F.round(F.coalesce(share, F.lit(0.0)), digits)


def dataset_of(file_name: Column) -> Column:
    """``struct(split, dataset_id)`` from a file name; both '' when it does not match."""
    pattern = r"(train|test|RUL)_FD(\d{3})"
    split = F.regexp_extract(file_name, pattern, 1)
    digits = F.regexp_extract(file_name, pattern, 2)
    return F.struct(
        split.alias("split"),
        F.when(digits != "", F.concat(F.lit("FD"), digits)).otherwise("").alias("dataset_id"),
    )


def source_name(path: Column) -> Column:
    """Name of the source a file belongs to.

    The folder named like a source, for one written as a folder of parts;
    the file's own name otherwise. A match begins where a folder's name does,
    so that the time for a path does not grow with the square of its length.
    """
    named = F.regexp_extract(path, r"(?:^|/)([^/]*(?:train|test|RUL)_FD\d{3}[^/]*)", 1)
    return F.when(named != "", named).otherwise(F.element_at(F.split(path, "/"), -1))
