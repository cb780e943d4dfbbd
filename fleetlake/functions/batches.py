"""Rolling statistics and spikes of rows in series order, worked out in numpy batch by batch.

Spark places and sorts the rows and numbers them within their series; a task
then sees them in that order, as Arrow batches. What a frame needs of the batch
before is carried over, so a task holds one batch and a few rows. The values are
those of :class:`fleetlake.functions.windows.FullRolling` and
:class:`~fleetlake.functions.windows.Spikes`, added up in the same order; a
window of hundreds of ``lag`` columns costs a multiple of this per row.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from decimal import ROUND_HALF_UP, Context, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fleetlake.functions.windows import MAX_PARTS, NOISE
from fleetlake.settings import SpikeRule

Values = np.ndarray


class Levels:
    """Windows of one column, each put together from the windows of a smaller size."""

    def __init__(self, values: Values, valid: Values | None, place: Values, sizes: Sequence[int]) -> None:
        self.values, self.valid, self.place = values, valid, place
        self._sizes = sizes
        self._known: dict[tuple[str, int], Values] = {}

    def _once(self, kind: str, n: int, build: Callable[[], Values]) -> Values:
        if (kind, n) not in self._known:
            self._known[kind, n] = build()
        return self._known[kind, n]

    def _parts(self, n: int, of: Callable[[int], Values]) -> tuple[int, list[Values]]:
        """The size of the parts of a window of ``n`` rows, and the parts, newest first."""
        below = n // parts_of(n, self._sizes)
        newest = of(below)
        return below, [newest, *(shifted(newest, j * below) for j in range(1, n // below))]

    def sums(self, n: int) -> Values:
        def build() -> Values:
            _, parts = self._parts(n, self.sums)
            return sum(parts[1:], parts[0])

        return self.values if n == 1 else self._once("sum", n, build)

    def squares(self, n: int) -> Values:
        """Squared deviations from the window's mean, added up."""

        def build() -> Values:
            below, parts = self._parts(n, self.sums)
            mean = self.sums(n) / n
            away = [part / below - mean for part in parts]
            total = sum((d * d for d in away[1:]), away[0] * away[0]) * below
            return total if below == 1 else sum(self._parts(n, self.squares)[1], total)

        return self._once("sq", n, build)

    def extreme(self, stat: str, n: int) -> Values:
        """NaN is the largest value."""
        merge = np.fmin if stat == "min" else np.maximum

        def build() -> Values:
            _, parts = self._parts(n, lambda k: self.extreme(stat, k))
            found = parts[0]
            for part in parts[1:]:
                found = merge(found, part)
            return found

        return self.values if n == 1 else self._once(stat, n, build)

    def full(self, n: int) -> Values:
        """Where the last ``n`` rows are of the series and none is NULL."""

        def build() -> Values:
            enough = self.place >= n
            return enough if self.valid is None else enough & self._filled(n)

        return self._once("full", n, build)

    def _filled(self, n: int) -> Values:
        def build() -> Values:
            _, parts = self._parts(n, self._filled)
            return np.logical_and.reduce(parts)

        return self.valid if n == 1 else self._once("filled", n, build)

    def statistic(self, stat: str, n: int) -> tuple[Values, Values]:
        """Values and where they count."""
        if stat == "mean":
            return self.sums(n) / n, self.full(n)
        if stat == "std":
            return (np.sqrt(self.squares(n) / (n - 1)), self.full(n)) if n > 1 else (self.values, np.zeros(len(self.values), bool))
        return self.extreme(stat, n), self.full(n)

    def spikes(self, rule: SpikeRule) -> Values:
        mean, known = self.statistic("mean", rule.window)
        std, varied = self.statistic("std", rule.window)
        known = known & varied
        if rule.exclude_current:
            mean, std, known = shifted(mean, 1), shifted(std, 1), shifted(known, 1) & (self.place > 1)
        if self.valid is not None:
            known = known & self.valid
        distance, limit = np.abs(self.values - mean), rule.sigma * std
        found = known & (distance > limit) & (std > NOISE * np.abs(mean))
        if found.any():
            found &= distance > limit + rule.tolerance * np.maximum(np.abs(self.values), np.abs(mean))
        return found


def parts_of(n: int, sizes: Sequence[int]) -> int:
    """Into how many parts a window of ``n`` rows is cut; parts of a size that is wanted anyway come first."""
    factors = [k for k in range(2, MAX_PARTS + 1) if n % k == 0]
    shared = [k for k in factors if n // k in sizes]
    if shared:
        return shared[0]
    return n if n <= MAX_PARTS or not factors else factors[0]


def shifted(values: Values, rows: int) -> Values:
    """The value as many rows earlier; zeros before the first."""
    out = np.zeros_like(values)
    if rows < len(values):
        out[rows:] = values[: len(values) - rows]
    return out


class BatchColumns:
    """New columns of a series table: ``rolled`` are {name: (column, stat, n)} over full windows,
    ``spikes`` are {name: columns}, true where any of them spikes.

    The columns are read as doubles, and so are the results but for the spikes.
    To be given to :func:`fleetlake.operators.series.over_series` among its stages.
    """

    def __init__(
        self,
        rolled: Mapping[str, tuple[str, str, int]] | None = None,
        spikes: Mapping[str, Sequence[str]] | None = None,
        rule: SpikeRule = SpikeRule(),
    ) -> None:
        self.rolled, self.spiking, self.rule = dict(rolled or {}), {k: list(v) for k, v in (spikes or {}).items()}, rule
        tested = list(dict.fromkeys(c for cs in self.spiking.values() for c in cs))
        self.inputs = list(dict.fromkeys([*(c for c, _, _ in self.rolled.values()), *tested]))
        self.names = [*self.rolled, *self.spiking]
        longest = max((n for _, _, n in self.rolled.values()), default=1)
        self.before = max(longest, rule.window + (1 if rule.exclude_current else 0) if tested else 1)

    def sizes(self, column: str) -> list[int]:
        sizes = {n for _, _, n in self.rolled.values()}
        return sorted(sizes | {self.rule.window} if any(column in cs for cs in self.spiking.values()) else sizes)

    def struct(self, place: Column) -> Column:
        """All of them as one struct; ``place`` is a row's number in its series, and rows come in that order.

        The function keeps rows between batches, so it counts as not deterministic: no filter is moved below it.
        """
        if not self.inputs:
            return F.struct(*(F.lit(False).alias(name) for name in self.spiking))
        found = self._found()

        def compute(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
            for _, rolled, spikes in found(batches):
                out = rolled | {name: pa.array(flags) for name, flags in spikes.items()}
                yield pa.StructArray.from_arrays(list(out.values()), list(out))

        kinds = [*(f"`{name}` double" for name in self.rolled), *(f"`{name}` boolean" for name in self.spiking)]
        function = F.arrow_udf(compute, ", ".join(kinds)).asNondeterministic()
        return function(place, _packed(map(F.col, self.inputs), "double"))

    def counted(self, df: DataFrame, place: str, unit: str, sums: Sequence[str], own: Column) -> DataFrame:
        """How many rows spike, by name, with the sums of the columns ``sums`` and the number of rows, ``__total``.

        One row for what a batch holds of a series, with its ``unit``; rows that are not ``own`` do not count.
        """
        found, spiking, sums = self._found(), list(self.spiking), list(sums)
        kinds = [df.schema[unit], *(T.StructField(name, T.LongType()) for name in ("__total", *sums, *spiking))]
        names = [kind.name for kind in kinds]

        def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            units: list[pa.Array] = []
            added: list[Values] = []

            def series() -> Iterator[tuple[pa.Array, ...]]:
                for batch in batches:
                    if batch.num_rows:
                        unit, numbers, packed = batch.columns
                        places, own, *others = (values for values, _ in _unpacked(numbers, 2 + len(sums)))
                        units[:], added[:] = [unit], [own, *(values * own for values in others)]
                        yield pa.array(places), packed

            for places, _, spikes in found(series()):
                starts = np.union1d([0], np.flatnonzero(places == 1))
                marks = [*added, *(spikes[name] * added[0] for name in spiking)]
                counts = [np.add.reduceat(values, starts) for values in marks]
                yield pa.RecordBatch.from_arrays([units[0].take(pa.array(starts)), *map(pa.array, counts)], names)

        numbers = _packed([F.col(place), own, *map(F.col, sums)], "bigint").alias("__numbers")
        inputs = _packed(map(F.col, self.inputs), "double").alias("__inputs")
        return df.select(unit, numbers, inputs).mapInArrow(compute, T.StructType(kinds))

    def _found(self) -> Callable[[Iterator[tuple[pa.Array, ...]]], Iterator[tuple[Values, dict[str, pa.Array], dict[str, Values]]]]:
        """Goes through batches of places and packed inputs; for each the places, the rolled columns and the flags."""
        rolled, spiking, rule, before = self.rolled, self.spiking, self.rule, self.before
        inputs = self.inputs
        sizes = {c: self.sizes(c) for c in inputs}

        def found(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[tuple[Values, dict[str, pa.Array], dict[str, Values]]]:
            held: list[tuple[Values, Values | None]] = []
            for places, packed in batches:
                rows = len(places)
                new = [_read(places), *_unpacked(packed, len(inputs))]
                read = [_joined(*both) for both in zip(held or [None] * len(new), new)]
                place = read[0][0]
                extra = len(place) - rows
                out: dict[str, pa.Array] = {}
                any_spike = {name: np.zeros(rows, bool) for name in spiking}
                with np.errstate(all="ignore"):
                    for column, (values, valid) in zip(inputs, read[1:]):
                        levels = Levels(values, valid, place, sizes[column])
                        for name, (c, stat, n) in rolled.items():
                            if c == column:
                                values_found, known = levels.statistic(stat, n)
                                out[name] = pa.array(values_found[extra:], pa.float64(), mask=~known[extra:], from_pandas=False)
                        tested = [name for name, cs in spiking.items() if column in cs]
                        if tested:
                            spikes = levels.spikes(rule)[extra:]
                            for name in tested:
                                any_spike[name] |= spikes
                yield place[extra:], {name: out[name] for name in rolled}, any_spike
                held = [(values[-before:].copy(), None if valid is None else valid[-before:].copy()) for values, valid in read]

        return found


_EXACT = Context(prec=700, rounding=ROUND_HALF_UP)
#: Up to this size six more digits leave a product's error far below ``_UNSURE``, the distance from a tie that is looked at twice.
_LARGE, _UNSURE = 1e6, 1e-3


def half_up(values: Values, digits: int) -> Values:
    """What Spark's ``round`` gives: the shortest decimal of each value, rounded half away from zero."""
    with np.errstate(all="ignore"):
        scaled = values * 10.0**digits
        whole = np.rint(scaled)
        out = whole / 10.0**digits + 0.0
        sure = (np.abs(np.abs(scaled - whole) - 0.5) > _UNSURE) & (np.abs(values) < _LARGE)
    unit = Decimal(1).scaleb(-digits)
    for i in np.flatnonzero(~sure):
        value = float(values[i])
        out[i] = float(Decimal(repr(value)).quantize(unit, context=_EXACT)) + 0.0 if np.isfinite(value) else value
    return out


def rounded_struct(columns: Sequence[str], digits: int) -> Column:
    """The columns, doubles, rounded to at most six digits as one struct."""

    def compute(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for arrays in batches:
            read = [_read(array) for array in arrays]
            out = [
                pa.array(half_up(values, digits), pa.float64(), mask=None if valid is None else ~valid, from_pandas=False)
                for values, valid in read
            ]
            yield pa.StructArray.from_arrays(out, list(columns))

    return F.arrow_udf(compute, ", ".join(f"`{c}` double" for c in columns))(*(F.col(c) for c in columns))


def _read(array: pa.Array) -> tuple[Values, Values | None]:
    """Values, and where they are not NULL if any is."""
    values = array.to_numpy(zero_copy_only=False)
    return values, np.asarray(array.is_valid()) if array.null_count else None


def _packed(columns: Iterable[Column], kind: str) -> Column:
    """The columns as one array. Spark asks the size of every column of a batch with each row that it adds to it."""
    return F.array(*(column.cast(kind) for column in columns))


def _unpacked(array: pa.ListArray, columns: int) -> list[tuple[Values, Values | None]]:
    """What :func:`_read` gives for each column that was packed."""
    values, valid = _read(array.flatten())
    rows = [None] * columns if valid is None else [None if v.all() else v for v in _by_column(valid, columns)]
    return list(zip(_by_column(values, columns), rows))


def _by_column(values: Values, columns: int) -> Values:
    return np.ascontiguousarray(values.reshape(-1, columns).T)


def _joined(old: tuple[Values, Values | None] | None, new: tuple[Values, Values | None]) -> tuple[Values, Values | None]:
    if old is None:
        return new
    valid = None
    if old[1] is not None or new[1] is not None:
        valid = np.concatenate([np.ones(len(v), bool) if m is None else m for v, m in (old, new)])
    return np.concatenate([old[0], new[0]]), valid
