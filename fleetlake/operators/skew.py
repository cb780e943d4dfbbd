"""Finding groups too large for one task, and keeping them out of plain shuffles.

A group counts as hot above ``SkewLimits.hot_rows``. A table can hold at most
``rows / hot_rows`` hot groups, so the list of their keys is small by
construction and safe to broadcast; every other group is known to fit a task.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fleetlake.session import shuffles_dropped
from fleetlake.settings import SkewLimits


@dataclass(frozen=True)
class GroupProfile:
    """Group sizes of a table, from one map-side-combined count."""

    groups: int
    rows: int
    hot_groups: int
    hot_rows: int
    hot_keys: DataFrame


def profile_groups(df: DataFrame, keys: Sequence[str], limits: SkewLimits = SkewLimits()) -> GroupProfile:
    """Count rows per group. Reads only the key columns and returns one row."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("__n"))
    hot = F.col("__n") > limits.hot_rows
    totals = counts.agg(
        F.count(F.lit(1)).alias("groups"),
        F.coalesce(F.sum("__n"), F.lit(0)).alias("rows"),
        F.count_if(hot).alias("hot_groups"),
        F.coalesce(F.sum(F.when(hot, F.col("__n"))), F.lit(0)).alias("hot_rows"),
    )
    with shuffles_dropped(df.sparkSession):
        sizes = totals.first()
    return GroupProfile(sizes.groups, sizes.rows, sizes.hot_groups, sizes.hot_rows, counts.filter(hot).select(*keys))


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "left") -> DataFrame:
    """Equi-join in which NULL keys match each other, keeping the left key columns."""
    renamed = right.select(
        *(F.col(k).alias(f"__right_{k}") for k in keys),
        *(F.col(c) for c in right.columns if c not in keys),
    )
    same = reduce(and_, (F.col(k).eqNullSafe(F.col(f"__right_{k}")) for k in keys))
    return left.join(renamed, same, how).drop(*(f"__right_{k}" for k in keys))


def split_hot(df: DataFrame, profile: GroupProfile, keys: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary groups, rows of hot groups), without a shuffle."""
    hot = F.broadcast(profile.hot_keys)
    return join_on(df, hot, keys, "left_anti"), join_on(df, hot, keys, "left_semi")


def flag_copies(
    df: DataFrame, keys: Sequence[str], name: str = "is_duplicate", limits: SkewLimits = SkewLimits()
) -> DataFrame:
    """Flag every row whose key occurs more than once. NULL keys are equal.

    Rows of a hot group are copies by definition, so they are flagged where
    they stand and never meet in one task.
    """
    profile = profile_groups(df, keys, limits)
    several = F.count(F.lit(1)).over(W.partitionBy(*keys)) > 1
    if not profile.hot_groups:
        return df.withColumn(name, several)
    rest, hot = split_hot(df, profile, keys)
    return rest.withColumn(name, several).unionByName(hot.withColumn(name, F.lit(True)))


def with_group_totals(
    df: DataFrame,
    totals: dict[str, Column],
    keys: Sequence[str],
    limits: SkewLimits = SkewLimits(),
    profile: GroupProfile | None = None,
) -> DataFrame:
    """Attach per-group aggregates to every row.

    With few groups the aggregate is broadcast and the rows stay where they
    are. With many, ordinary groups use a window over one exchange and the
    few hot ones get the broadcast.
    """
    profile = profile or profile_groups(df, keys, limits)
    if profile.groups <= limits.broadcast_groups:
        return _join_totals(df, totals, keys)
    windowed = {name: total.over(W.partitionBy(*keys)) for name, total in totals.items()}
    if not profile.hot_groups:
        return df.withColumns(windowed)
    rest, hot = split_hot(df, profile, keys)
    return rest.withColumns(windowed).unionByName(_join_totals(hot, totals, keys))


def _join_totals(df: DataFrame, totals: dict[str, Column], keys: Sequence[str]) -> DataFrame:
    per_group = df.groupBy(*keys).agg(*(total.alias(name) for name, total in totals.items()))
    return join_on(df, F.broadcast(per_group), keys)
