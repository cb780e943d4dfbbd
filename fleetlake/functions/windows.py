"""Window column expressions over one ordered series."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from fleetlake.settings import SeriesWindow, SpikeRule

STATISTICS = {"mean": F.avg, "std": F.stddev_samp, "min": F.min, "max": F.max}


def rolling(column: str, stat: str, n: int, w: SeriesWindow, full: bool = True) -> Column:
    """A statistic of the last ``n`` rows.

    ``full`` gives NULL until the frame holds ``n`` values; otherwise partial
    frames count from the first row on.
    """
    frame = w.spec.rowsBetween(1 - n, 0)
    value = STATISTICS[stat](F.col(column)).over(frame)
    return F.when(F.count(column).over(frame) >= n, value) if full else value


def rate_of_change(column: str, w: SeriesWindow) -> Column:
    return F.col(column) - F.lag(column, 1).over(w.spec)


def next_value(column: str, w: SeriesWindow) -> Column:
    return F.lead(column, 1).over(w.spec)


def cycle_gap(clock: str, w: SeriesWindow) -> Column:
    """True where the clock jumps by more than one; the first row is no gap."""
    return F.coalesce(F.col(clock) - F.lag(clock, 1).over(w.spec) > 1, F.lit(False))


class FullRolling:
    """Rolling statistics over full windows, built up from smaller windows.

    A window of 20 is two windows of 10, a window of 10 is two of 5, and a
    window of 5 is five rows. Each level takes the statistics of the level
    below from earlier rows with ``lag``, which costs the same for any
    distance, and merges them: sums add, and squared deviations add up with
    the spread between the parts. NULL readings make every sum they are in
    NULL, which is just what a full window asks for.

    ``stages`` compute scratch columns for :func:`over_series`; afterwards
    :meth:`text` gives a statistic. All of it is SQL text, since it may be
    hundreds of columns.
    """

    def __init__(self, wanted: Mapping[str, Iterable[tuple[str, int]]]) -> None:
        self.before = 1
        self._parts: dict[int, int] = {}
        self._framed: list[tuple[str, str, int]] = []
        levels: dict[int, dict[str, set[str]]] = {}
        sizes = sorted({n for pairs in wanted.values() for _, n in pairs})
        for column, pairs in wanted.items():
            for stat, n in set(pairs):
                self.before = max(self.before, n)
                chain = self._chain(n, sizes)
                if chain is None:
                    self._framed.append((column, stat, n))
                for size in chain or ():
                    levels.setdefault(size, {}).setdefault(column, set()).update(_NEEDS[stat])
        self.stages = [step for size in sorted(levels) for step in self._level(size, levels[size])]
        if self._framed:
            self.stages.append(self._frames)

    def _frames(self, w: SeriesWindow) -> dict[str, Column]:
        return {_scratch(stat, n, c): rolling(c, stat, n, w) for c, stat, n in self._framed}

    def _chain(self, n: int, sizes: Sequence[int]) -> list[int] | None:
        """Window sizes leading up to ``n``; None if a step would take too many parts.

        The first step may take many rows, which are single columns; later
        steps take few parts, since each part brings all its statistics.
        """
        chain: list[int] = []
        while n > 1:
            factors = [k for k in range(2, MAX_PARTS + 1) if n % k == 0]
            shared = [k for k in factors if n // k in sizes]
            if n not in self._parts:
                if not factors:
                    return None
                self._parts[n] = shared[0] if shared else n if n <= MAX_PARTS else factors[0]
            chain.append(n)
            n //= self._parts[n]
        return chain

    def _level(self, size: int, columns: Mapping[str, set[str]]):
        """Three steps: fetch the parts, add them up, add up their spread."""
        parts = self._parts[size]
        below = size // parts

        def parts_of(c: str, kind: str) -> list[str]:
            if below == 1:
                raw = [c, *(_lagged("raw", size, parts, j, c) for j in range(1, parts))]
                return [f"CAST({p} AS DOUBLE)" for p in raw] if kind == "sum" else raw
            return [_scratch(kind, below, c), *(_lagged(kind, size, parts, j, c) for j in range(1, parts))]

        def fetch(w: SeriesWindow) -> dict[str, str]:
            if below == 1:
                return {_lagged("raw", size, parts, j, c): _lag(c, j, w) for c in columns for j in range(1, parts)}
            return {
                _lagged(kind, size, parts, j, c): _lag(_scratch(kind, below, c), j * below, w)
                for c, kinds in columns.items()
                for kind in kinds
                for j in range(1, parts)
            }

        def add_up(_: SeriesWindow) -> dict[str, str]:
            merged = {"sum": " + ".join, "min": _call("least"), "max": _call("greatest")}
            return {
                _scratch(kind, size, c): merged[kind](parts_of(c, kind))
                for c, kinds in columns.items()
                for kind in kinds
                if kind in merged
            }

        def spread(_: SeriesWindow) -> dict[str, str]:
            found = {}
            for c in (c for c, kinds in columns.items() if "sq" in kinds):
                mean = f"{_scratch('sum', size, c)} / {size}"
                apart = [f"({p} / {below} - {mean})" for p in parts_of(c, "sum")]
                away = " + ".join(f"{d} * {d}" for d in apart)
                within = "" if below == 1 else " + " + " + ".join(parts_of(c, "sq"))
                found[_scratch("sq", size, c)] = f"({away}) * {below}{within}"
            return found

        return fetch, add_up, spread

    def text(self, column: str, stat: str, n: int) -> str:
        """The statistic as SQL text over the scratch columns."""
        if (column, stat, n) in self._framed:
            return _scratch(stat, n, column)
        total = f"CAST({column} AS DOUBLE)" if n == 1 else _scratch("sum", n, column)
        if stat == "mean":
            return f"{total} / {n}"
        if stat == "std":
            return f"sqrt({_scratch('sq', n, column)} / {n - 1})" if n > 1 else "CAST(NULL AS DOUBLE)"
        extreme = column if n == 1 else _scratch(stat, n, column)
        return f"CASE WHEN {total} IS NOT NULL THEN {extreme} END"



MAX_PARTS = 7
NOISE = 1e-12
_NEEDS = {"mean": ("sum",), "std": ("sum", "sq"), "min": ("sum", "min"), "max": ("sum", "max")}


def _lag(value: str, rows: int, w: SeriesWindow) -> str:
    return f"lag({value}, {rows}) OVER ({w.sql})"


def _call(function: str):
    return lambda arguments: f"{function}({', '.join(arguments)})"


def _scratch(kind: str, n: int, column: str) -> str:
    return f"__{kind}{n}_{column}"


def _lagged(kind: str, n: int, parts: int, part: int, column: str) -> str:
    return f"__{kind}{n}_part{part}of{parts}_{column}"


class Spikes:
    """Where a value leaves the rolling mean by more than ``sigma`` deviations.

    A window of equal values never spikes: its mean may differ from the values
    by rounding noise, which is far below ``NOISE``. Missing values and
    unfilled windows are no spikes.
    """

    def __init__(self, sensors: Sequence[str], rule: SpikeRule) -> None:
        self._rule = rule
        self._rolling = FullRolling({s: [(stat, rule.window) for stat in ("mean", "std")] for s in sensors})
        self.before = self._rolling.before + (1 if rule.exclude_current else 0)
        self.stages = [*self._rolling.stages, self._tests(sensors)]

    def _tests(self, sensors: Sequence[str]):
        n = self._rule.window

        def limits(w: SeriesWindow) -> dict[str, str]:
            """Mean and deviation of the window tested against."""
            found = {}
            for s in sensors:
                mean, std = (self._rolling.text(s, stat, n) for stat in ("mean", "std"))
                tests = {"mean": mean, "std": std}
                for name, test in tests.items():
                    found[f"__{name}_{s}"] = _lag(test, 1, w) if self._rule.exclude_current else test
            return found

        return limits

    def text(self, sensor: str) -> str:
        varies = f"__std_{sensor} > {NOISE} * abs(__mean_{sensor})"
        away = f"abs({sensor} - __mean_{sensor}) > {self._rule.sigma} * __std_{sensor}"
        slack = f"{self._rule.tolerance} * greatest(abs({sensor}), abs(__mean_{sensor}))"
        # What ties need is looked at only beyond the plain limit, where few values are.
        return f"coalesce({away} AND {varies} AND {away} + {slack}, false)"

    def any(self, sensors: Sequence[str]) -> str:
        return " OR ".join(self.text(s) for s in sensors) or "false"
