"""Silver that grows by batches: new cycles are flagged from the last rows of their unit.

Beside silver lies a table of tails: for each unit its last rows, as many as the
frames look back, and its last cycle. A batch whose cycles all come after that
is flagged over tail and new rows, and the unit's past is not read. Any other
unit (late or repeated cycles, a changed source) is built anew from bronze; its
rows of earlier batches then no longer count.

``silver/batch=N`` and ``tails/batch=N`` belong to batch N. The batch replaces
its own folders, silver first, and looks at earlier ones only, so that it can be
repeated after any failure. Batches run one after another.

After every few batches the tails of all units are written together below
``all-tails``; later batches read the newest of these and the tails since.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.functions.windows import Spikes
from fleetlake.operators.series import numbered_series
from fleetlake.operators.silver import CLEAN, with_outcome
from fleetlake.operators.skew import join_on
from fleetlake.session import COMPACT, shuffles_dropped
from fleetlake.settings import SENSOR_COLUMNS, Settings
from fleetlake.sources.layers import delete_path, list_names, path_exists, read_layer

BATCH = "batch"
#: Batches whose tails are read one by one before all are written together.
GATHER_AFTER = 16


def refresh_silver(
    new: DataFrame,
    bronze: DataFrame,
    path: str,
    batch: int,
    settings: Settings = Settings(),
    now: datetime | None = None,
    changed: DataFrame | None = None,
    gather_after: int = GATHER_AFTER,
) -> None:
    """Bring the silver below ``path`` up to date with the bronze rows of a batch.

    ``new`` are the rows that came, ``bronze`` all rows there are now, these
    included. Of ``bronze`` only the units built anew are used. ``changed`` are
    (dataset_id, unit_id) of units whose rows were replaced or taken away.
    NULL cycles count as late. A batch without rows leaves silver as it is.
    Tails are gathered once ``gather_after`` batches have left some.
    """
    spark = new.sparkSession
    keys, clock = settings.series.keys, settings.series.clock
    for name in ("all-tails", "silver", "tails"):  # what is left of a try that failed
        delete_path(spark, f"{path}/{name}/{BATCH}={batch}")

    came = new.groupBy(*keys).agg(
        F.min(clock).alias("__from"), F.max(clock).alias("__until"), F.count_if(F.col(clock).isNull()).alias("__unknown")
    )
    tails = latest_tails(spark, path, batch)
    if tails is None:
        units = came.withColumn("__anew", F.lit(True))
    else:
        ends = tails.select(*keys, "last_cycle")
        after = F.col("last_cycle").isNull() | ((F.col("__from") > F.col("last_cycle")) & (F.col("__unknown") == 0))
        units = join_on(came, ends, keys).withColumn("__anew", ~F.coalesce(after, F.lit(False)))
    if changed is not None:
        anew = changed.select(*keys).distinct().withColumn("__changed", F.lit(True))
        units = units.join(anew.withColumnsRenamed({k: f"__changed_{k}" for k in keys}), _same(keys, "__changed_"), "full").select(
            *(F.coalesce(k, f"__changed_{k}").alias(k) for k in keys), (F.col("__anew") | F.coalesce("__changed", F.lit(False))).alias("__anew")
        )
        units = units.withColumn("__anew", F.coalesce("__anew", F.lit(True)))
    # Stored, so that a unit is treated alike by every step that follows.
    staged = f"{path}/units/{BATCH}={batch}"
    with shuffles_dropped(spark):
        units.select(*keys, "__anew").write.mode("overwrite").parquet(staged)
    units = spark.read.schema(units.select(*keys, "__anew").schema).parquet(staged)
    anew, grown = units.filter("__anew"), units.filter("NOT __anew")

    columns = bronze.columns
    rows = join_on(bronze, anew.select(*keys), keys, "left_semi").withColumn("__new", F.lit(True))
    if tails is not None:
        more = join_on(new.select(*columns), grown.select(*keys), keys, "left_semi").withColumn("__new", F.lit(True))
        past = join_on(tails, grown.select(*keys), keys, "left_semi")
        # An array holds a unit's last rows; they are rows again beside the new ones.
        past = past.select(F.inline("rows")).withColumn("__new", F.lit(False)).select(*columns, "__new")
        rows = rows.unionByName(more).unionByName(past)
    # The duplicates' keys and all frames lie within a unit, so that the mark may ride along.
    flagged = with_outcome(rows, settings, now)
    fresh = flagged.filter((F.col("outcome") == CLEAN) & F.col("__new")).drop("outcome", "__new")
    with shuffles_dropped(spark):
        fresh.write.options(**COMPACT).parquet(f"{path}/silver/{BATCH}={batch}")

    present = [s for s in SENSOR_COLUMNS if s in columns]
    before = max(1, Spikes(present, settings.spikes).before)
    ordered = numbered_series(
        flagged.filter(F.col("outcome") == CLEAN).select(*columns),
        [F.col(c).desc() for c in (*settings.series.order, *settings.series.ties) if c in columns],
        keys,
        "__place",
        settings.limits,
    )
    kept = ordered.filter(F.col("__place") <= before).groupBy(*keys).agg(F.collect_list(F.struct(*columns)).alias("rows"))
    last = flagged.groupBy(*keys).agg(F.max(clock).alias("__seen"))
    made = join_on(join_on(join_on(units, last, keys), kept, keys), _ends(tails, units, keys), keys)
    made = made.select(
        *keys,
        F.greatest("__seen", F.when(~F.col("__anew"), F.col("last_cycle"))).alias("last_cycle"),
        F.when(F.col("__anew"), F.lit(batch).cast("long")).otherwise(F.coalesce("since", F.lit(batch).cast("long"))).alias("since"),
        F.coalesce("rows", F.array().cast(kept.schema["rows"].dataType)).alias("rows"),
    )
    with shuffles_dropped(spark):
        made.write.options(**COMPACT).parquet(f"{path}/tails/{BATCH}={batch}")
    if len(_tail_batches(spark, path, batch + 1)[1]) >= gather_after:
        gather_tails(spark, path, batch)


def _same(keys: Sequence[str], prefix: str):
    same = F.lit(True)
    for k in keys:
        same &= F.col(k).eqNullSafe(F.col(f"{prefix}{k}"))
    return same


def _ends(tails: DataFrame | None, units: DataFrame, keys: Sequence[str]) -> DataFrame:
    """last_cycle and since of the units, as they were."""
    if tails is not None:
        return tails.select(*keys, "last_cycle", "since")
    return units.select(*keys, F.lit(None).cast("long").alias("last_cycle"), F.lit(None).cast("long").alias("since"))


def latest_tails(spark: SparkSession, path: str, before: int | None = None) -> DataFrame | None:
    """(keys, last_cycle, since, rows) of every unit after the batches earlier than ``before``; None without any."""
    gathered, single = _tail_batches(spark, path, before)
    tables = [_table(spark, f"{path}/{name}", n) for name, n in (("all-tails", gathered), ("tails", single)) if n]
    if not tables:
        return None
    table = reduce(DataFrame.unionByName, tables)
    keys = [c for c in table.columns if c not in ("last_cycle", "since", "rows", BATCH)]
    newest = table.groupBy(*keys).agg(F.max_by(F.struct("last_cycle", "since", "rows"), BATCH).alias("t"))
    return newest.select(*keys, "t.*")


def gather_tails(spark: SparkSession, path: str, batch: int) -> None:
    """Write the tails of all units as of a finished batch together; until that write is done they are read as before."""
    tails = latest_tails(spark, path, batch + 1)
    if tails is not None:
        with shuffles_dropped(spark):
            tails.write.mode("overwrite").options(**COMPACT).parquet(f"{path}/all-tails/{BATCH}={batch}")


def _tail_batches(spark: SparkSession, path: str, before: int | None) -> tuple[list[int], list[int]]:
    """The newest batch with gathered tails, if any, and the finished batches after it."""
    done = [n for n in _batches(spark, f"{path}/tails") if before is None or n < before]
    newest = [n for n in _batches(spark, f"{path}/all-tails") if n in done][-1:]
    return newest, [n for n in done if not newest or n > newest[0]]


def read_growing_silver(spark: SparkSession, path: str, before: int | None = None) -> DataFrame:
    """Silver as of the last finished batch, or as of those earlier than ``before``."""
    done = [n for n in _batches(spark, f"{path}/tails") if before is None or n < before]
    silver = _table(spark, f"{path}/silver", done)
    ends = latest_tails(spark, path, before)
    # Units that came in the first batch and were never built anew need no look at the batch of their rows.
    keys = [c for c in ends.columns if c not in ("last_cycle", "since", "rows")]
    rebuilt = ends.filter(F.col("since") > min(done)).select(*keys, "since")
    current = join_on(silver, rebuilt, keys)
    return current.filter(F.col("since").isNull() | (F.col(BATCH) >= F.col("since"))).drop("since", BATCH)


def _batches(spark: SparkSession, path: str) -> list[int]:
    """Finished batches: a write that was broken off has no success mark."""
    found = [n for n in list_names(spark, path) if n.startswith(f"{BATCH}=")]
    return sorted(int(n.partition("=")[2]) for n in found if path_exists(spark, f"{path}/{n}/_SUCCESS"))


def _table(spark: SparkSession, path: str, batches: Sequence[int]) -> DataFrame:
    """The batches' folders as one table, others not listed."""
    places = [f"{path}/{BATCH}={n}" for n in batches]
    return spark.read.option("basePath", path).parquet(*places).withColumn(BATCH, F.col(BATCH).cast("long"))
