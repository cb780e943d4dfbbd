"""Sharding by histogram sort: exact byte counts below probes, refined until the splitters fit.

Rows have a place in a total order: the text's hash, then the id's, then a row
number, so equal texts stand together. The wanted boundaries are at equal steps
of the total bytes. Each round sums the bytes of the sub-intervals of every
interval that still holds a boundary, in one aggregation over narrow rows, and
keeps the sub-interval the boundary falls into, until one of its ends is near
enough. Then the rows are exchanged once, by shard and place.

All of it is DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fleetlake.llm.common import spare, stored

#: Probes divide an interval by 2 ** BITS; a word of the order has 64 bits.
BITS = 8
DIGITS = 64 // BITS
WORDS = 3
#: Bytes that every row counts besides its text.
ROW_BYTES = 16
#: How far a boundary may lie from its place, in parts of a shard.
TOLERANCE = 0.002
#: Rows, and bytes, that one task sorts and numbers.
ROWS_PER_TASK, BYTES_PER_TASK = 500_000, 64_000_000
#: Tasks and shards up to which the beginnings of slots are broadcast, some fifty bytes each.
FEW_STARTS = 200_000


@dataclass(frozen=True)
class _Interval:
    """Rows whose first digits are ``prefix``, with the bytes before them and in them."""

    prefix: tuple[int, ...]
    before: int
    within: int


def text_size(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def shard_by_bytes(
    docs: DataFrame,
    n_shards: int,
    id_column: str = "doc_id",
    text_column: str = "text",
    payload: list[str] | None = None,
    tolerance: float = TOLERANCE,
) -> DataFrame:
    """``docs`` with size, shard and slot.

    Shards are 0 to ``n_shards`` - 1, near equal in bytes: a boundary is off by
    at most ``tolerance`` of a shard plus one row. Rows of equal text share a
    shard unless a boundary within the tolerance would have to part them. Slots
    number the rows of a shard without gaps from 0.

    ``payload`` names the columns to carry (all by default). A NULL text has
    size 16, a NULL id is an id like another, repeated rows get places of their
    own, an empty table gives no rows. Columns called like a result keep their
    values under the name with underscores added.
    """
    columns = docs.columns if payload is None else payload
    names = {c: spare(c + "_", docs.columns) if c in ("size", "shard", "slot") else c for c in columns}
    keyed = docs.select(
        *(F.col(c).alias(names[c]) for c in columns),
        text_size(F.col(text_column)).alias("size"),
        F.xxhash64(text_column).alias("__w0"),
        F.xxhash64(id_column).alias("__w1"),
        F.monotonically_increasing_id().alias("__row"),
    )
    # Written once: the row numbers hold from here on.
    rows = stored(keyed, "shard-rows", "zstd").withColumn("__w2", F.xxhash64("__row"))
    splitters = _splitters(rows, n_shards, tolerance)
    placed = rows.withColumn("shard", _shard(splitters))
    count, total = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    tasks = max(n_shards, -(-count // ROWS_PER_TASK), -(-total // BYTES_PER_TASK))
    order = ["shard", "__w0", "__w1", "__w2"]
    # The one exchange; a range holds part of one shard or of neighbours, in order.
    spread = placed.repartitionByRange(tasks, *order).sortWithinPartitions(*order)
    numbered = stored(
        spread.drop("__w0", "__w1", "__w2", "__row").withColumn("__n", F.monotonically_increasing_id()), "shards", "zstd"
    )
    part = F.shiftright("__n", 33)
    starts = (
        numbered.groupBy("shard", part.alias("__part"))
        .agg(F.count(F.lit(1)).alias("__rows"), F.min("__n").alias("__first"))
        .withColumn(
            "__offset",
            F.sum("__rows").over(W.partitionBy("shard").orderBy("__part").rowsBetween(W.unboundedPreceding, -1)),
        )
        .select("shard", "__part", (F.coalesce("__offset", F.lit(0)) - F.col("__first")).alias("__shift"))
    )
    # No more rows than tasks and shards together: while these are few they are sent to the texts.
    if tasks + n_shards <= FEW_STARTS:
        starts = F.broadcast(starts)
    joined = numbered.withColumn("__part", part).join(starts, ["shard", "__part"])
    return joined.select(
        *names.values(), "size", "shard", (F.col("__n") + F.col("__shift")).cast("long").alias("slot")
    )


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder a shard, each in as many files as tasks hold part of it."""
    sharded.write.partitionBy("shard").parquet(path)


def _digit(i: int) -> Column:
    """The i-th digit of the order, from the most significant; signed words count up from their least."""
    shifted = F.shiftrightunsigned(_unsigned(i // DIGITS), 64 - BITS * (i % DIGITS + 1))
    return shifted.bitwiseAND(F.lit(2**BITS - 1)).cast("int")


def _unsigned(word: int) -> Column:
    return F.col(f"__w{word}").bitwiseXOR(F.lit(-(2**63)))


def _bound(prefix: tuple[int, ...]) -> tuple[int, ...]:
    """The least words that begin with these digits."""
    padded = [*prefix, *[0] * (WORDS * DIGITS - len(prefix))]
    words = (padded[i : i + DIGITS] for i in range(0, len(padded), DIGITS))
    return tuple(reduce(lambda a, d: a << BITS | d, word, 0) - 2**63 for word in words)


def _splitters(rows: DataFrame, n_shards: int, tolerance: float) -> list[tuple[int, ...]]:
    """For each boundary, the least place at or after it, as a tuple of words."""
    total = rows.agg(F.sum("size")).first()[0] or 0
    allowed = tolerance * total / n_shards
    wanted = {j: total * j // n_shards for j in range(1, n_shards)}
    held = {j: _Interval((), 0, total) for j in wanted} if total else {}
    found: dict[int, tuple[int, tuple[int, ...]]] = {}
    depth = 0
    while held:
        bins = _histogram(rows, sorted({i.prefix for i in held.values()}), depth)
        for j, interval in list(held.items()):
            before = interval.before
            counts = bins[interval.prefix]
            for digit, (within, number) in sorted(counts.items()):
                if before + within >= wanted[j]:
                    break
                before += within
            last = number == 1 or depth + 1 == WORDS * DIGITS
            near = min(wanted[j] - before, before + within - wanted[j]) <= allowed
            if near or last:
                up = digit + (before + within - wanted[j] < wanted[j] - before)
                found[j] = _bound(_carried((*interval.prefix, up)))
                del held[j]
            else:
                held[j] = _Interval((*interval.prefix, digit), before, within)
        depth += 1
    return [found[j] for j in sorted(found)]


def _carried(prefix: tuple[int, ...]) -> tuple[int, ...]:
    """Digits in range: one past the last digit is the next number of the digit before."""
    digits = list(prefix)
    for i in range(len(digits) - 1, 0, -1):
        if digits[i] == 2**BITS:
            digits[i] = 0
            digits[i - 1] += 1
    return tuple(digits)


def _histogram(rows: DataFrame, prefixes: list[tuple[int, ...]], depth: int) -> dict[tuple[int, ...], dict[int, tuple[int, int]]]:
    """Exact bytes and rows by next digit of each interval; at most 2 ** BITS rows for each boundary."""
    # The digits so far, as one number for each word they reach into.
    heads = []
    for word in range(-(-depth // DIGITS)):
        digits = min(DIGITS, depth - word * DIGITS)
        heads.append(F.shiftrightunsigned(_unsigned(word), 64 - BITS * digits).alias(f"h{word}"))
    known = {_heads(p): p for p in prefixes}
    keyed = rows.select(*heads, _digit(depth).alias("digit"), "size")
    if heads:
        keyed = keyed.where(F.col("h0").isin(sorted({k[0] for k in known})))
    columns = [f"h{word}" for word in range(len(heads))]
    # Other words may share the first with a boundary: they cost a row each in the last depths only.
    for i, column in enumerate(columns[1:], 1):
        keyed = keyed.where(F.col(column).isin(sorted({k[i] for k in known})))
    counted = keyed.groupBy(*columns, "digit").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    out: dict[tuple[int, ...], dict[int, tuple[int, int]]] = {p: {} for p in prefixes}
    for row in counted.collect():
        if (prefix := known.get(tuple(row[: len(heads)]))) is not None:
            out[prefix][row.digit] = (row.bytes, row.n)
    return out


def _heads(prefix: tuple[int, ...]) -> tuple[int, ...]:
    """The numbers that ``_histogram`` makes of these digits, as signed words."""
    words = (prefix[i : i + DIGITS] for i in range(0, len(prefix), DIGITS))
    values = (reduce(lambda a, d: a << BITS | d, word, 0) for word in words)
    return tuple(v - 2**64 if v >= 2**63 else v for v in values)


def _shard(splitters: list[tuple[int, ...]]) -> Column:
    """How many splitters lie at or before a row's place."""
    beyond = F.lit(0)
    for words in splitters:
        at_or_after = F.lit(True)
        for i in range(WORDS - 1, -1, -1):
            mine = F.col(f"__w{i}")
            if words[i] >= 2**63:  # past the last place
                at_or_after = F.lit(False)
            elif all(w == -(2**63) for w in words[i + 1 :]):
                at_or_after = mine >= words[i]
            else:
                at_or_after = (mine > words[i]) | ((mine == words[i]) & at_or_after)
        beyond = beyond + at_or_after.cast("int")
    return beyond
