"""Window operators over unit series that survive one unit holding much of the data.

Ordinary units take the plain route: one exchange on the series key, one sort,
every window on top of it. Rows of hot units are numbered by a range
partitioning, cut into chunks of consecutive positions, and each chunk carries
copies of the few rows before (or after) it that its frames look at. The rows
of a frame are the same either way, so the values are, too.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import partial

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fleetlake.functions.batches import BatchColumns
from fleetlake.functions.windows import FullRolling, cycle_gap, next_value, rate_of_change, rolling
from fleetlake.operators.ranks import global_rank  # noqa: F401
from fleetlake.operators.skew import (
    GroupProfile,
    join_on,
    profile_groups,
    split_hot,
    with_group_totals,
)
from fleetlake.session import cut_lineage
from fleetlake.settings import Series, SeriesWindow, SkewLimits, SpikeRule

Stage = Callable[[SeriesWindow], Mapping[str, Column | str]] | BatchColumns

# monotonically_increasing_id keeps the partition above the 33 low bits
_PARTITION_BITS = 33

SCRATCH = "__"
PLACE = "__place_in_series"

#: Rows that a task numbers at least, if there are as many.
RANGE_ROWS = 1_000_000


def _with_position(
    df: DataFrame, order: Sequence[Column | str], name: str, keys: Sequence[str], partitions: int
) -> DataFrame:
    """Dense 1-based position in a total order, overall or within few ``keys``.

    Rows are range-partitioned, so no task holds more than its share however
    the keys are distributed. The offsets broadcast back are at most one row
    per partition plus one per key; callers pass hot keys or none.
    """
    ranged = df.repartitionByRange(partitions, *keys, *order).sortWithinPartitions(*keys, *order)
    # checkpointed: the ids must be the same for the offsets and for the rows
    numbered = cut_lineage(ranged.withColumn("__id", F.monotonically_increasing_id()))
    numbered = numbered.withColumn("__block", F.shiftright("__id", _PARTITION_BITS))
    blocks = numbered.groupBy(*keys, "__block").agg(
        F.min("__id").alias("__first"), F.count(F.lit(1)).alias("__size")
    )
    before = F.sum("__size").over(
        W.partitionBy(*keys).orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
    )
    offsets = blocks.select(
        *keys, "__block", (F.coalesce(before, F.lit(0)) - F.col("__first") + 1).alias("__shift")
    )
    return (
        join_on(numbered, F.broadcast(offsets), [*keys, "__block"])
        .withColumn(name, F.col("__id") + F.col("__shift"))
        .drop("__id", "__block", "__shift")
    )


def numbered_series(
    df: DataFrame,
    order: Sequence[Column | str],
    keys: Sequence[str],
    name: str,
    limits: SkewLimits = SkewLimits(),
) -> DataFrame:
    """``row_number`` per key, with hot keys numbered by range partitioning."""
    profile = profile_groups(df, keys, limits)
    plain = F.row_number().over(W.partitionBy(*keys).orderBy(*order)).cast("long")
    if not profile.hot_groups:
        return df.withColumn(name, plain)
    rest, hot = split_hot(df, profile, keys)
    return rest.withColumn(name, plain).unionByName(
        _with_position(hot, order, name, keys, _range_partitions(hot, profile, limits))
    )


def over_series(
    df: DataFrame,
    *stages: Stage,
    series: Series = Series(),
    before: int = 1,
    after: int = 0,
    totals: Mapping[str, Column] | None = None,
    running: Mapping[str, Column] | None = None,
    limits: SkewLimits = SkewLimits(),
    profile: GroupProfile | None = None,
) -> DataFrame:
    """Add window columns to a series table in one exchange.

    ``stages`` map a window to new columns; a later stage may use the columns
    of an earlier one, and those named ``__*`` are scratch and not kept. Stages
    of batch columns use none of them and come after all windows, since Spark no
    longer knows how rows lie behind a Python function.
    Together they look at most ``before`` rows back and ``after`` rows ahead.
    ``totals`` are aggregates over the whole unit, ``running`` are sums from
    its first row on.
    """
    series = series.on(df)
    totals, running = dict(totals or {}), dict(running or {})
    profile = profile or profile_groups(df, series.keys, limits)
    if not profile.hot_groups:
        return _plain(df, stages, series, totals, running)
    parts = split_hot(df, profile, series.keys)
    return over_split_series(
        *parts,
        *stages,
        series=series,
        before=before,
        after=after,
        totals=totals,
        running=running,
        limits=limits,
        profile=profile,
    )


def over_split_series(
    rest: DataFrame,
    hot: DataFrame,
    *stages: Stage,
    series: Series,
    before: int,
    profile: GroupProfile,
    limits: SkewLimits,
    after: int = 0,
    totals: Mapping[str, Column] | None = None,
    running: Mapping[str, Column] | None = None,
) -> DataFrame:
    """:func:`over_series` for rows already split into ordinary and hot units."""
    totals, running = dict(totals or {}), dict(running or {})
    chunked = _chunked(hot, stages, series, before, after, totals, running, profile, limits)
    return _plain(rest, stages, series, totals, running).unionByName(chunked)


def counted_series(
    df: DataFrame,
    batch: BatchColumns,
    *sums: Callable[[SeriesWindow], Mapping[str, Column]],
    unit: str,
    series: Series = Series(),
    before: int = 1,
    limits: SkewLimits = SkewLimits(),
) -> DataFrame:
    """The flags of ``batch`` and the numbers ``sums`` added up where the windows leave the rows.

    One row for what a batch of rows holds of a unit (:meth:`BatchColumns.counted`), so that no flag of a single row
    leaves a Python worker. ``before`` as in :func:`over_series`.
    """
    series = series.on(df)
    profile = profile_groups(df, series.keys, limits)

    def plain(part: DataFrame) -> DataFrame:
        placed, names = _add_stages(part, [*sums, batch], series.window())
        return batch.counted(placed, PLACE, unit, [n for n in names if n not in batch.names], F.lit(True))

    if not profile.hot_groups:
        return plain(df)
    rest, hot = split_hot(df, profile, series.keys)
    _, chunked, names, own = _in_chunks(hot, [*sums, batch], series, max(before, batch.before), 0, profile, limits)
    return plain(rest).unionByName(batch.counted(chunked, PLACE, unit, [n for n in names if n not in batch.names], own))


def _plain(df, stages, series, totals, running) -> DataFrame:
    w = series.window()
    unit = W.partitionBy(*series.keys)
    columns = df.columns
    batched = _batched(stages)
    df, kept = _add_stages(df, stages, w)
    if stages:
        later = {name for stage in batched for name in stage.names}
        df = df.select(*columns, *(c for c in kept if c not in later), *([PLACE] if batched else []))
    if totals:
        df = df.withColumns({name: total.over(unit) for name, total in totals.items()})
    if running:
        cumulative = w.spec.rowsBetween(W.unboundedPreceding, 0)
        df = df.withColumns({name: _running(value, value, cumulative) for name, value in running.items()})
    return _add_batched(df, batched).select(*columns, *kept, *totals, *running) if batched else df


def _batched(stages: Sequence[Stage]) -> list[BatchColumns]:
    return [stage for stage in stages if isinstance(stage, BatchColumns) and stage.names]


def _add_batched(df: DataFrame, batched: Sequence[BatchColumns]) -> DataFrame:
    """Batch columns of rows that lie in the order of ``PLACE``, where its window left them."""
    structs = [f"__batch_{i}" for i in range(len(batched))]
    with_structs = df.select("*", *(stage.struct(F.col(PLACE)).alias(name) for stage, name in zip(batched, structs)))
    return with_structs.select(*df.columns, *(f"{name}.*" for name in structs))


def _add_stages(df: DataFrame, stages: Sequence[Stage], w: SeriesWindow) -> tuple[DataFrame, list[str]]:
    """The table with all new columns, and the names of those to keep.

    Scratch columns that two stages both define are computed once. SQL texts
    go to Spark in one call per stage.
    """
    kept: list[str] = []
    scratch: set[str] = set()
    for stage in stages:
        if isinstance(stage, BatchColumns):
            kept += stage.names
            continue
        new = {name: c for name, c in stage(w).items() if name not in scratch}
        scratch |= {name for name in new if name.startswith(SCRATCH)}
        kept += [name for name in new if not name.startswith(SCRATCH)]
        if all(isinstance(c, str) for c in new.values()):
            df = df.selectExpr("*", *(f"{text} AS {name}" for name, text in new.items()))
        else:
            df = df.select("*", *((F.expr(c) if isinstance(c, str) else c).alias(name) for name, c in new.items()))
    if _batched(stages):
        df = df.withColumn(PLACE, F.row_number().over(w.spec).cast("long"))
    return df, kept


def _running(value: Column, summed: Column, frame: WindowSpec) -> Column:
    """Running sum that skips NULL values and stays NULL on them."""
    return F.when(value.isNotNull(), F.sum(summed).over(frame))


def _in_chunks(df, stages, series, before, after, profile, limits) -> tuple[DataFrame, DataFrame, list[str], Column]:
    """(numbered rows, rows of the chunks with the stages' columns, those to keep, which rows are a chunk's own)."""
    rows = limits.chunk_rows
    if rows <= max(before, after):
        raise ValueError(f"chunks of {rows} rows cannot hold frames of {max(before, after)} rows")
    position = F.col("__position")
    numbered = _with_position(
        df, [*series.order, *series.ties], "__position", series.keys, _range_partitions(df, profile, limits)
    )
    home = F.floor((position - 1) / rows)
    offset = (position - 1) % rows
    copies = F.array_compact(
        F.array(
            home,
            F.when(offset >= rows - before, home + 1),
            F.when((offset < after) & (home > 0), home - 1),
        )
    )
    numbered = numbered.withColumn("__home", home)
    w = SeriesWindow((*series.keys, "__chunk"), ("__position",))
    chunked, kept = _add_stages(numbered.withColumn("__chunk", F.explode(copies)), stages, w)
    return numbered, chunked, kept, F.col("__home") == F.col("__chunk")


def _chunked(df, stages, series, before, after, totals, running, profile, limits) -> DataFrame:
    original = df.columns
    numbered, chunked, kept, own = _in_chunks(df, stages, series, before, after, profile, limits)
    if running:
        w = SeriesWindow((*series.keys, "__chunk"), ("__position",))
        cumulative = w.spec.rowsBetween(W.unboundedPreceding, 0)
        chunked = chunked.withColumns(
            {name: _running(value, F.when(own, value), cumulative) for name, value in running.items()}
        )
    if batched := _batched(stages):
        chunked = _add_batched(chunked, batched)
    chunked = chunked.filter(own)
    if running:
        chunked = _add_offsets(chunked, numbered.withColumnRenamed("__home", "__chunk"), running, series)
    if totals:
        chunked = with_group_totals(chunked, totals, series.keys, limits, profile=_few(profile))
    return chunked.select(*original, *kept, *totals, *running)


def _add_offsets(chunked, numbered, running, series) -> DataFrame:
    """Lift the sums within a chunk by what the unit summed up before it."""
    earlier = W.partitionBy(*series.keys).orderBy("__chunk").rowsBetween(W.unboundedPreceding, -1)
    sums = numbered.groupBy(*series.keys, "__chunk").agg(
        *(F.sum(value).alias(f"__sum_{name}") for name, value in running.items())
    )
    offsets = sums.select(
        *series.keys,
        "__chunk",
        *(F.coalesce(F.sum(f"__sum_{name}").over(earlier), F.lit(0)).alias(f"__before_{name}") for name in running),
    )
    lifted = join_on(chunked, F.broadcast(offsets), [*series.keys, "__chunk"])
    return lifted.withColumns({name: F.col(name) + F.col(f"__before_{name}") for name in running})


def _range_partitions(df: DataFrame, profile: GroupProfile, limits: SkewLimits) -> int:
    """Tasks that number the hot rows. Those of many small hot units share one: each task costs the driver the same."""
    shuffle = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return max(shuffle, -(-profile.hot_rows // max(limits.hot_rows, RANGE_ROWS)))


def _few(profile: GroupProfile) -> GroupProfile:
    """The profile of the hot part alone: few groups, so its totals broadcast."""
    return GroupProfile(profile.hot_groups, profile.hot_rows, profile.hot_groups, profile.hot_rows, profile.hot_keys)


# --- single operators -------------------------------------------------------


def flag_gaps(df: DataFrame, series: Series = Series(), name: str = "has_cycle_gap", **options) -> DataFrame:
    clock = series.on(df).clock
    return over_series(df, lambda w: {name: cycle_gap(clock, w)}, series=series, **options)


def gap_list(df: DataFrame, series: Series = Series(), **options) -> DataFrame:
    """(keys, current_cycle, previous_cycle, gap_size) of every gap.

    Works on the distinct clock values of a unit: rows sharing one differ by 0
    and are no gap, so a value held by many rows costs nothing.
    """
    series = series.on(df)
    clock = series.clock
    steps = df.select(*series.keys, clock).distinct()
    gaps = over_series(
        steps, lambda w: {"previous_cycle": F.lag(clock, 1).over(w.spec)}, series=series, **options
    ).withColumn("gap_size", F.col(clock) - F.col("previous_cycle"))
    return gaps.filter(F.col("gap_size") > 1).select(
        *series.keys, F.col(clock).alias("current_cycle"), "previous_cycle", "gap_size"
    )


def rolling_columns(
    df: DataFrame,
    spec: Mapping[str, Sequence[tuple[str, int]]],
    series: Series = Series(),
    full: bool = True,
    **options,
) -> DataFrame:
    """``{column}_rolling_{stat}_{n}`` for every (stat, n) asked for a column."""
    wanted = {c: pairs for c, pairs in spec.items() if c in df.columns}
    names = {f"{c}_rolling_{stat}_{n}": (c, stat, n) for c, pairs in wanted.items() for stat, n in pairs}
    if full:
        stages = full_windows(df, names)
    else:
        stages = [lambda w: {name: rolling(*what, w, full=False) for name, what in names.items()}]
    longest = max((n for _, _, n in names.values()), default=1)
    found = over_series(df, *stages, series=series, before=longest, **options)
    have = {*df.columns, *names}
    return found.select(*df.columns, *names, *(c for c in found.columns if c not in have))


def full_windows(df: DataFrame, names: Mapping[str, tuple[str, str, int]]) -> list[Stage]:
    """Stages for {new column: (column, stat, n)} over full windows.

    The extremes of a column keep its type, so those of other types than double
    are left to Spark's windows.
    """
    kinds = dict(df.dtypes)
    typed = {name: what for name, what in names.items() if what[1] in ("min", "max") and kinds[what[0]] != "double"}
    stages: list[Stage] = [BatchColumns({name: what for name, what in names.items() if name not in typed})]
    if typed:
        wanted: dict[str, list[tuple[str, int]]] = {}
        for column, stat, n in typed.values():
            wanted.setdefault(column, []).append((stat, n))
        windows = FullRolling(wanted)
        stages += [*windows.stages, lambda _: {name: windows.text(*what) for name, what in typed.items()}]
    return stages


def change_columns(df: DataFrame, columns: Sequence[str], series: Series = Series(), **options) -> DataFrame:
    return over_series(
        df, lambda w: {f"{c}_rate_of_change": rate_of_change(c, w) for c in columns}, series=series, **options
    )


def next_columns(df: DataFrame, columns: Sequence[str], series: Series = Series(), **options) -> DataFrame:
    return over_series(
        df, lambda w: {f"{c}_next_value": next_value(c, w) for c in columns}, series=series, after=1, **options
    )


def trend_columns(
    df: DataFrame, columns: Sequence[str], n: int = 10, series: Series = Series(), **options
) -> DataFrame:
    """Rolling mean, partial windows included, of the rate of change."""
    return over_series(
        df,
        lambda w: {f"{c}_rate_of_change": rate_of_change(c, w) for c in columns},
        lambda w: {f"{c}_degradation_trend": rolling(f"{c}_rate_of_change", "mean", n, w, full=False) for c in columns},
        series=series,
        before=n + 1,
        **options,
    )


def spike_columns(
    df: DataFrame, sensors: Sequence[str], rule: SpikeRule = SpikeRule(), series: Series = Series(), **options
) -> DataFrame:
    """One ``spike_{sensor}`` flag per sensor that is present."""
    spikes = BatchColumns(spikes={f"spike_{s}": [s] for s in sensors if s in df.columns}, rule=rule)
    return over_series(df, spikes, series=series, before=spikes.before, **options)


def running_counts(df: DataFrame, flags: Mapping[str, str], series: Series = Series(), **options) -> DataFrame:
    """``{new column: flag column}`` running totals; absent flags are skipped."""
    present = {name: F.col(flag).cast("int") for name, flag in flags.items() if flag in df.columns}
    counted = over_series(df, series=series, running=present, **options)
    return counted.withColumns({name: F.col(name).cast("int") for name in present})


def remaining_useful_life(df: DataFrame, series: Series = Series(), limits: SkewLimits = SkewLimits()) -> DataFrame:
    return _from_unit_edge(df, "remaining_useful_life", F.max, lambda c, edge: edge - c, series, limits)


def cycles_since_first(df: DataFrame, series: Series = Series(), limits: SkewLimits = SkewLimits()) -> DataFrame:
    return _from_unit_edge(df, "cycles_since_first_observation", F.min, lambda c, edge: c - edge, series, limits)


def lifecycle_ratio(df: DataFrame, series: Series = Series(), limits: SkewLimits = SkewLimits()) -> DataFrame:
    return _from_unit_edge(
        df, "lifecycle_ratio", F.max, lambda c, edge: c.cast("double") / edge.cast("double"), series, limits
    )


def _from_unit_edge(df, name, edge, combine, series, limits) -> DataFrame:
    series = series.on(df)
    attached = with_group_totals(df, {"__edge": edge(series.clock)}, series.keys, limits)
    return attached.withColumn(name, combine(F.col(series.clock), F.col("__edge"))).drop("__edge")


def latest_per_unit(df: DataFrame, keys: Sequence[str], clock: str = "cycle") -> DataFrame:
    """The newest row of every unit, combined map-side instead of ranked."""
    rest = [c for c in df.columns if c not in keys]
    latest = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), clock).alias("__row"))
    return latest.select(*keys, *(F.col(f"__row.{c}").alias(c) for c in rest)).select(*df.columns)


latest_reading_per_unit = partial(latest_per_unit, keys=("dataset_id", "unit_id"))
