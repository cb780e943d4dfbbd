"""Queries for sources, sinks, ingestion and the whole run.

Each writes a view of the driver's tables below the shared folder, the way
its source would arrive, and reads it back through the operator.
"""

from __future__ import annotations

import dataclasses
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fleetlake.operators.features import ml_features
from fleetlake.operators.health import equipment_summary
from fleetlake.operators.ledger import Ledger
from fleetlake.operators.silver import split_duplicates, with_outcome
from fleetlake.plans import lakehouse
from fleetlake.queries import layers as L
from fleetlake.queries import views as V
from fleetlake.queries.registry import query
from fleetlake.queries.views import r, rounded, with_ctes
from fleetlake.session import COMPACT, scratch_path, shuffles_dropped
from fleetlake.settings import READING_COLUMNS, SENSOR_COLUMNS, SETTING_COLUMNS, Paths
from fleetlake.sinks import tables as K
from fleetlake.sinks.bucketed import bucket_number, read_bucketed
from fleetlake.sinks.text_files import write_keyed_text
from fleetlake.sources import layers as R
from fleetlake.sources import text as T
from fleetlake.sources.trees import tree_checksums
from fleetlake.streaming.incremental import incremental_ingest
from fleetlake.streaming.silver import grow_silver
from fleetlake.streaming.tails import read_growing_silver, refresh_silver

NOW = datetime(2024, 1, 1)
SOURCE = "'train_FD00' || CAST(unit_id % 4 + 1 AS VARCHAR) || '.txt'"
NUMBERS = ", ".join(["unit_id", "cycle", *(r(c, c) for c in (*SETTING_COLUMNS, *SENSOR_COLUMNS))])


#: Lines of a part at most. Its text is compressed, so that one task reads the whole of it.
PART_LINES = 500_000


def write_parts(df: DataFrame, folder: str, datasets=(1, 2, 3, 4), parts: int | None = None, spread=None) -> None:
    """Text parts by data set, in (unit, cycle) order: their paths sort like the rows. One pass writes all data sets.

    ``parts`` says how many ranges the rows are cut into, Spark does otherwise.
    ``spread`` makes readings of narrower rows once they are where they belong,
    so that the exchange carries no column twice.
    """
    order = ["dataset_id", "unit_id", "cycle"]
    rows = df.filter(F.col("dataset_id").isin([f"FD00{n}" for n in datasets]))
    rows = rows if spread else rows.select("dataset_id", *READING_COLUMNS)
    ranged = rows.repartitionByRange(*([parts] if parts else []), *order).sortWithinPartitions(*order)
    ranged = spread(ranged) if spread else ranged
    line = F.concat_ws("  ", F.lit(""), *READING_COLUMNS)
    packed = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED", "maxRecordsPerFile": PART_LINES}
    with shuffles_dropped(df.sparkSession):
        ranged.select("dataset_id", line.alias("value")).write.options(**packed).partitionBy("dataset_id").text(folder)


def write_sources(
    df: DataFrame, folder: str, kind: str = "train", datasets=(1, 2, 3, 4), parts: int | None = None, spread=None
) -> list[str]:
    """One text source per data set, rows in (unit, cycle) order. ``parts`` and ``spread`` as in :func:`write_parts`."""
    spark = df.sparkSession
    staged = scratch_path(spark, "staged")
    write_parts(df, staged, datasets, parts, spread)
    filled = set(R.list_names(spark, staged))
    written = []
    for number in datasets:
        path, name = f"{folder}/{kind}_FD00{number}.txt", f"dataset_id=FD00{number}"
        if name in filled:
            R.move_path(spark, f"{staged}/{name}", path)
        else:  # a source without a line
            spark.createDataFrame([], "value string").write.text(path)
        written.append(path)
    return written


def full_sources(spark, sf) -> list[str]:
    return write_sources(V.full_lines(spark, sf), scratch_path(spark, "sources"), spread=V.spread_out)


@query(
    "scan_sensor_text",
    with_ctes(V.FULL)
    + f"SELECT {NUMBERS}, {SOURCE} AS source_file, dataset_id, 'run-1' AS pipeline_run_id, 'train' AS split, "
    "1704067200000000 AS ingested, row_number() OVER (PARTITION BY dataset_id ORDER BY unit_id, cycle) AS source_row_number "
    "FROM full_readings",
)
def scan_sensor_text(spark, sf):
    scanned = T.scan_sensor_text(spark, full_sources(spark, sf), "run-1", NOW)
    return rounded(scanned.withColumn("ingested", F.unix_micros("ingested_at")).drop("ingested_at"))


@query(
    "source_row_number",
    """SELECT 'train_FD001.txt' AS source_file, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_shipdate)
  AS source_row_number, CAST(l_orderkey AS VARCHAR) || ' ' || CAST(l_linenumber AS VARCHAR) AS line FROM lineitem""",
)
def source_row_number(spark, sf):
    folder = scratch_path(spark, "lines")
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"]
    ordered = V.table(spark, sf, "lineitem").repartitionByRange(*order).sortWithinPartitions(*order)
    ordered.select(F.concat_ws(" ", F.lit(""), "l_orderkey", "l_linenumber")).write.text(f"{folder}/train_FD001.txt")
    return T.with_row_numbers(T.read_lines(spark, folder + "/train_FD001.txt")).drop("source_path")


@query(
    "detect_dataset",
    "SELECT 'FD' || lpad(CAST(user_id % 7 AS VARCHAR), 3, '0') AS dataset_id, "
    "['train', 'test', 'RUL'][CAST(user_id % 3 + 1 AS INTEGER)] AS split, event_id FROM events",
)
def detect_dataset(spark, sf):
    kind = F.get(F.array(F.lit("train"), F.lit("test"), F.lit("RUL")), (F.col("user_id") % 3).cast("int"))
    number = F.lpad((F.col("user_id") % 7).cast("string"), 3, "0")
    named = V.table(spark, sf, "events").select(
        "event_id", F.concat(kind, F.lit("_FD"), number, F.lit(".txt")).alias("source_file")
    )
    return T.with_dataset(named).drop("source_file")


@query(
    "scan_rul_text",
    with_ctes(V.CLEAN)
    + """SELECT row_number() OVER (ORDER BY unit) AS unit_id, lives AS remaining_useful_life, 'RUL_FD001.txt' AS source_file,
  'FD001' AS dataset_id, row_number() OVER (ORDER BY unit) AS source_row_number
FROM (SELECT unit_id AS unit, max(cycle) AS lives FROM clean GROUP BY unit_id)""",
)
def scan_rul_text(spark, sf):
    path = scratch_path(spark, "rul") + "/RUL_FD001.txt"
    lives = V.clean(spark, sf).groupBy("unit_id").agg(F.max("cycle").alias("life"))
    lives.repartitionByRange("unit_id").sortWithinPartitions("unit_id").select(F.col("life").cast("string")).write.text(path)
    return T.scan_rul_text(spark, path, "run-1", NOW).drop("ingested_at", "pipeline_run_id")


@query(
    "file_checksum",
    "SELECT user_id AS unit, sha256(string_agg(event_id || ' ' || event_type, chr(10) ORDER BY event_id) || chr(10)) "
    "AS file_checksum FROM (SELECT *, event_id // 500 AS block FROM events) GROUP BY user_id, block",
)
def file_checksum(spark, sf):
    """Files of at most 500 lines, written by Spark's tasks and hashed as bytes."""
    folder = scratch_path(spark, "hashed")
    events = V.table(spark, sf, "events").withColumn("block", F.floor(F.col("event_id") / 500))
    line = F.concat(F.col("event_id").cast("string"), F.lit(" "), F.col("event_type"))
    by = ["user_id", "block"]
    # The number is given, or the few bytes there are would be gathered in one task that opens every file.
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ordered = events.repartition(parts, *by).sortWithinPartitions(*by, "event_id")
    write_keyed_text(ordered.select(*by, line.alias("value")), folder, by)
    # The folders of the units, which Spark lists in tasks; a pattern for the files is looked up by the driver alone.
    hashed = T.file_checksums(spark, [f"{folder}/*"], "bytes")
    unit = F.regexp_extract("source_path", r"user_id=(\d+)", 1).cast("bigint")
    # Spark reads 32 small files a task, and whoever stores the result would get a file from each.
    return hashed.select(unit.alias("unit"), "file_checksum").coalesce(parts)


@query(
    "file_checksum_lines",
    "SELECT DISTINCT 'train_FD00' || CAST(l_suppkey % 4 + 1 AS VARCHAR) || '.txt' AS source_file, true AS same_in_parts, "
    "true AS own FROM lineitem",
)
def file_checksum_lines(spark, sf):
    """Each source cut into parts in two ways: whether both have one checksum that no other has."""
    folders = [scratch_path(spark, "hashed") for _ in range(2)]
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    for folder, parts in zip(folders, (ranges, 2 * ranges + 1)):
        write_sources(V.full_lines(spark, sf), folder, parts=parts, spread=V.spread_out)
    hashed = [T.source_checksums(spark, f"{folder}/*") for folder in folders]
    pairs = hashed[0].join(hashed[1].withColumnRenamed("file_checksum", "other"), "source_file")
    alike = W.partitionBy("file_checksum")
    return pairs.select(
        "source_file",
        (F.col("file_checksum") == F.col("other")).alias("same_in_parts"),
        (F.count(F.lit(1)).over(alike) == 1).alias("own"),
    )


CHUNK, FAN = 512, 64


def _tree_sql() -> str:
    """Chunks of each kind's text, then three levels; the only hash of a file stays as it is."""
    levels = "".join(
        f""",
  l{i} AS (SELECT kind, node AS n, CASE WHEN node = 0 AND count(*) = 1 THEN min(hash)
             ELSE sha256(unhex(string_agg(hash, '' ORDER BY n))) END AS hash
           FROM (SELECT *, n // {FAN} AS node FROM l{i - 1}) GROUP BY kind, node)"""
        for i in (1, 2, 3)
    )
    return f"""
  WITH texts AS (SELECT event_type AS kind, string_agg(event_id || ' ' || user_id, chr(10) ORDER BY event_id) || chr(10) AS t
                 FROM events GROUP BY event_type),
  cut AS (SELECT kind, t, unnest(generate_series(0, (length(t) - 1) // {CHUNK})) AS n FROM texts),
  l0 AS (SELECT kind, n, sha256(substr(t, n * {CHUNK} + 1, {CHUNK})) AS hash FROM cut){levels}
  SELECT kind, hash AS file_checksum FROM l3"""


@query("file_checksum_tree", _tree_sql())
def file_checksum_tree(spark, sf):
    """One file for each kind of event, hashed as a tree over its splits."""
    folder = scratch_path(spark, "trees")
    events = V.table(spark, sf, "events").withColumn("kind", F.col("event_type"))
    line = F.concat_ws(" ", "event_id", "user_id")
    events.repartition("kind").sortWithinPartitions("kind", "event_id").select("kind", line.alias("value")).write.partitionBy(
        "kind"
    ).text(folder)
    hashed = tree_checksums(spark, f"{folder}/*/*.txt", CHUNK, FAN)
    return hashed.select(F.regexp_extract("source_path", "kind=([^/]*)/", 1).alias("kind"), "file_checksum")


def _lake(spark, name: str):
    """Settings whose folders lie below a fresh scratch path."""
    base = scratch_path(spark, name)
    return dataclasses.replace(L.SETTINGS, paths=Paths.below(base)), Ledger(spark, f"{base}/ledger")


@query(
    "discover_files",
    with_ctes(V.FULL)
    + """SELECT source_file, count(*) AS first_rows, CAST(0 AS BIGINT) AS second_rows FROM full_readings GROUP BY source_file""",
)
def discover_files(spark, sf):
    """Rows per source of an ingest, and of a second one that skips them all."""
    settings, ledger = _lake(spark, "discover")
    write_sources(V.full_lines(spark, sf), settings.paths.source_dir, spread=V.spread_out)
    first = lakehouse.ingest(spark, settings, ledger, "run-1", settings.dataset_ids, NOW)
    second = lakehouse.ingest(spark, settings, ledger, "run-2", settings.dataset_ids, NOW)
    rows = [(name, first[name], second[name]) for name in first]
    return spark.createDataFrame(rows, "source_file string, first_rows bigint, second_rows bigint")


@query(
    "ingest",
    with_ctes(V.FULL)
    + f"SELECT {NUMBERS}, {SOURCE} AS source_file, dataset_id, "
    "row_number() OVER (PARTITION BY dataset_id ORDER BY unit_id, cycle) AS source_row_number FROM full_readings",
)
def ingest(spark, sf):
    settings, ledger = _lake(spark, "ingest")
    write_sources(V.full_lines(spark, sf), settings.paths.source_dir, spread=V.spread_out)
    lakehouse.ingest(spark, settings, ledger, "run-1", settings.dataset_ids, NOW)
    bronze = R.read_layer(spark, f"{settings.paths.bronze_dir}/sensor_readings")
    return rounded(bronze.select(*READING_COLUMNS, "source_file", "dataset_id", "source_row_number"))


@query(
    "incremental_ingest",
    with_ctes(V.FULL)
    + f"SELECT {NUMBERS}, {SOURCE} AS source_file, dataset_id, row_number() OVER (PARTITION BY dataset_id "
    "ORDER BY unit_id % 3 = 2, unit_id, cycle) AS source_row_number, CAST(0 AS BIGINT) AS taken_again FROM full_readings",
)
def incremental(spark, sf):
    """Sources in parts: two runs of the stream, the second after each source got
    another part and a stray file came by, then a batch ingest that finds all done.
    """
    settings, ledger = _lake(spark, "stream")
    paths, checkpoint = settings.paths, scratch_path(spark, "stream-checkpoint")
    readings = V.full_lines(spark, sf)
    for run in (1, 2):
        late = (F.col("unit_id") % 3 == 2) == F.lit(run == 2)
        written = scratch_path(spark, "part")
        write_parts(readings.filter(late), written, spread=V.spread_out)
        for number in (1, 2, 3, 4):
            # Parts sort as they arrive, and within a run as their rows do.
            folder = f"{written}/dataset_id=FD00{number}"
            names = [name for name in R.list_names(spark, folder) if name.startswith("part-")]
            for n, name in enumerate(names):
                R.move_path(spark, f"{folder}/{name}", f"{paths.source_dir}/train_FD00{number}.txt/part-{run}-{n:05}.txt.gz")
        readings.limit(3).select(F.lit("not a source")).coalesce(1).write.mode("append").text(f"{paths.source_dir}/readme.txt")
        incremental_ingest(spark, paths.source_dir, paths, ledger, checkpoint, f"run-{run}")
    again = sum(lakehouse.ingest(spark, settings, ledger, "run-3", settings.dataset_ids, NOW).values())
    bronze = R.read_layer(spark, f"{paths.bronze_dir}/sensor_readings")
    stored = bronze.select(*READING_COLUMNS, "source_file", "dataset_id", "source_row_number")
    return rounded(stored.withColumn("taken_again", F.lit(again).cast("bigint")))


@query("read_parquet", f"SELECT l_orderkey, {r('l_tax + 0.0', 'l_tax')} FROM lineitem")
def read_parquet(spark, sf):
    return rounded(R.read_layer(spark, f"{sf}/lineitem.parquet", ["l_orderkey", "l_tax"]))


@query("scan_parquet", "SELECT l_suppkey, count(*) AS lines FROM lineitem WHERE l_quantity > 30 GROUP BY l_suppkey")
def scan_parquet(spark, sf):
    lines = R.scan_layer(spark, f"{sf}/lineitem.parquet").filter("l_quantity > 30")
    return lines.groupBy("l_suppkey").agg(F.count(F.lit(1)).alias("lines"))


@query("list_layer_files", "SELECT DISTINCT o_orderpriority AS priority, true AS listed FROM orders")
def list_layer_files(spark, sf):
    """Folders of a partitioned table, found from its files."""
    path = scratch_path(spark, "listed")
    K.write_layer(V.table(spark, sf, "orders"), path, ["o_orderpriority"])
    files = R.list_files(spark, path)
    escaped = F.regexp_extract("path", r"o_orderpriority=([^/]*)/", 1)
    return files.select(F.url_decode(escaped).alias("priority"), F.lit(True).alias("listed")).distinct()


@query("read_layer", with_ctes(V.HOURLY) + "SELECT unit_id, cycle, source_row_number FROM hourly WHERE unit_id % 3 = 0")
def read_layer(spark, sf):
    """Only the train split of a bronze layer that holds three."""
    path = scratch_path(spark, "bronze")
    kind = F.get(F.array(F.lit("train"), F.lit("test"), F.lit("RUL")), (F.col("unit_id") % 3).cast("int"))
    rows = V.hourly(spark, sf).withColumn("source_file", F.concat(kind, F.lit("_FD001.txt")))
    K.write_layer(rows, path, ["source_file"])
    return R.read_split(spark, path, "train", ["unit_id", "cycle", "source_row_number"])


@query("scan_silver_glob", with_ctes(V.MULTI) + "SELECT dataset_id, unit_id, cycle FROM multi")
def scan_silver_glob(spark, sf):
    path = scratch_path(spark, "silver")
    K.write_layer(V.multi(spark, sf), path, ["dataset_id"])
    return R.read_layer(spark, path).select("dataset_id", "unit_id", "cycle")


@query("write_parquet", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderstatus = 'F'")
def write_parquet(spark, sf):
    """The second write replaces the first."""
    path, orders = scratch_path(spark, "table"), V.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    K.write_layer(orders, path)
    K.write_layer(orders.filter("o_orderstatus = 'F'").drop("o_orderstatus"), path)
    return R.read_layer(spark, path)


@query("write_partitioned", "SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F' OR o_orderkey % 2 = 0")
def write_partitioned(spark, sf):
    """A second write replaces the partitions it has and keeps the others."""
    path, orders = scratch_path(spark, "parts"), V.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    K.write_layer(orders, path, ["o_orderstatus"])
    K.write_layer(orders.filter("o_orderstatus = 'F' AND o_orderkey % 2 = 0"), path, ["o_orderstatus"])
    return R.read_layer(spark, path)


@query("silver_sink", L.TO_SILVER_SQL)
def silver_sink(spark, sf):
    settings, _ = _lake(spark, "silver")
    return L._silver_columns(R.read_layer(spark, K.write_silver(L.silver(spark, sf), settings.paths)))


@query("growing_silver", L.TO_SILVER_SQL)
def growing_silver(spark, sf):
    """Readings come in three batches by cycle, those of every seventh unit in an order that makes most of them late."""
    path, bronze = scratch_path(spark, "growing"), V.daily(spark, sf)
    third = F.least(F.floor(F.col("cycle") / 850), F.lit(2))
    when = F.when(F.col("unit_id") % 7 == 0, 2 - third).otherwise(third)
    for batch in range(3):
        refresh_silver(bronze.filter(when == batch), bronze.filter(when <= batch), path, batch, L.SETTINGS, NOW)
    return L._silver_columns(read_growing_silver(spark, path))


@query("silver_stream", L.TO_SILVER_SQL)
def silver_stream(spark, sf):
    """Readings are added to a folder in two parts, every fifth unit's in the wrong order; the stream runs after each."""
    path, folder, bronze = scratch_path(spark, "silver-stream"), scratch_path(spark, "feed"), V.daily(spark, sf)
    late = F.when(F.col("unit_id") % 5 == 0, F.col("cycle") <= 1200).otherwise(F.col("cycle") > 1200)
    for part in (~late, late):
        bronze.filter(part).write.mode("append").options(**COMPACT).parquet(folder)
        grow_silver(spark, folder, path, L.SETTINGS, NOW, gather_after=2)
    return L._silver_columns(read_growing_silver(spark, path))


@query(
    "quarantine_duplicates_sink",
    with_ctes(V.HOURLY)
    + "SELECT unit_id, cycle, source_row_number FROM (SELECT *, count(*) OVER (PARTITION BY unit_id, cycle, dataset_id) AS n "
    "FROM hourly) WHERE n > 1",
)
def quarantine_duplicates_sink(spark, sf):
    settings, _ = _lake(spark, "quarantine")
    copies = split_duplicates(V.hourly(spark, sf))[1]
    for ids in (["FD001", "FD002"], ["FD003", "FD004"]):  # two runs; the second keeps what the first found
        path = K.quarantine_duplicates(copies.filter(F.col("dataset_id").isin(ids)), settings.paths, True, ids)
    return R.read_layer(spark, path, ["unit_id", "cycle", "source_row_number"])


@query(
    "quarantine_ranges_sink",
    with_ctes(V.MULTI)
    + f"SELECT unit_id, cycle, dataset_id, {r('sensor_03', 'value')} FROM multi WHERE sensor_03 > 90.0",
)
def quarantine_ranges_sink(spark, sf):
    from fleetlake.operators.quality import range_violations
    from fleetlake.settings import SensorRange

    settings, _ = _lake(spark, "quarantine")
    violations = range_violations(V.multi(spark, sf), {"sensor_03": SensorRange(0.0, 90.0)})
    for ids in (["FD001", "FD002"], ["FD003", "FD004"]):
        path = K.quarantine_range_violations(violations.filter(F.col("dataset_id").isin(ids)), settings.paths, True, ids)
    return rounded(R.read_layer(spark, path, ["unit_id", "cycle", "dataset_id", "value"]))


@query(
    "gold_sinks",
    with_ctes(*L.SUMMARY_CTES)
    + """SELECT 'dim_equipment' AS name, unit_id || '_' || dataset_id AS equipment_key, unit_id, max(cycle) AS cycle,
  count(*)::DOUBLE AS value FROM silver GROUP BY unit_id, dataset_id
UNION ALL SELECT 'fact_equipment_health', equipment_key, unit_id, cycle, round(health_score, 6) + 0.0 FROM health
UNION ALL SELECT 'equipment_health_summary', equipment_key, unit_id, latest_cycle, round(health_score, 6) + 0.0 FROM summary
UNION ALL SELECT 'ml_features', unit_id || '_' || dataset_id, unit_id, cycle,
  round(sensor_02 - lag(sensor_02) OVER (PARTITION BY dataset_id, unit_id ORDER BY cycle), 6) + 0.0 FROM silver""",
)
def gold_sinks(spark, sf):
    """The four gold tables, written twice and read back."""
    settings, _ = _lake(spark, "gold")
    silver = R.read_layer(spark, K.write_silver(L.silver(spark, sf), settings.paths))
    for _ in range(2):
        written = K.write_gold(lakehouse.health_tables(silver, L.SETTINGS, NOW), settings.paths)
        health = R.read_layer(spark, written["fact_equipment_health"])
        written |= K.write_gold({"equipment_health_summary": equipment_summary(health, silver, NOW)}, settings.paths)
        # By data sets, so that of the widest table only one data set is there twice while it is replaced.
        for own in [r.dataset_id for r in silver.select("dataset_id").distinct().collect()]:
            features = ml_features(silver.filter(F.col("dataset_id").eqNullSafe(own)))
            written["ml_features"] = K.write_features(features, settings.paths)
    tables = {name: R.read_layer(spark, path) for name, path in written.items()}
    key = F.concat(F.col("unit_id").cast("string"), F.lit("_"), F.col("dataset_id"))
    values = {
        "dim_equipment": ("equipment_key", "last_observed_cycle", F.col("total_operational_cycles").cast("double")),
        "fact_equipment_health": ("equipment_key", "cycle", F.col("health_score")),
        "equipment_health_summary": ("equipment_key", "latest_cycle", F.col("health_score")),
        "ml_features": (key, "cycle", F.col("sensor_02_rate_of_change")),
    }
    parts = []
    for name, (own_key, cycle, value) in values.items():
        own_key = F.col(own_key) if isinstance(own_key, str) else own_key
        parts.append(
            tables[name].select(
                F.lit(name).alias("name"),
                own_key.alias("equipment_key"),
                "unit_id",
                F.col(cycle).alias("cycle"),
                value.alias("value"),
            )
        )
    return rounded(reduce(DataFrame.unionByName, parts))


@query("bucketed_layers", L.FEATURE_SQL)
def bucketed_layers(spark, sf):
    """Silver and features in buckets of units, by two runs; each is read back without an exchange."""
    settings, _ = _lake(spark, "bucketed")
    bronze = V.daily(spark, sf)
    buckets = bucket_number(spark, bronze.count())
    for ids in (["FD001", "FD002"], ["FD003", "FD004"]):
        own = bronze.filter(F.col("dataset_id").isin(ids))
        silver = K.write_outcomes(with_outcome(own, L.SETTINGS, NOW, buckets=buckets), settings.paths, ids, buckets)
        features = ml_features(read_bucketed(spark, silver, ids))
        path = K.write_features(features, settings.paths, buckets)
    return L.feature_columns(read_bucketed(spark, path))


@query(
    "end_to_end",
    with_ctes(*L.SUMMARY_CTES)
    + "SELECT equipment_key, unit_id, latest_cycle, round(health_score, 6) + 0.0 AS health_score, estimated_rul, "
    "risk_level, sensors_in_warning_state FROM summary",
)
def end_to_end(spark, sf):
    """From text to the unit summary, through every layer's table."""
    settings, _ = _lake(spark, "lake")
    write_sources(V.daily_lines(spark, sf), settings.paths.source_dir, spread=V.spread_out)
    lakehouse.end_to_end(spark, settings, settings.dataset_ids, NOW)
    summary = R.read_layer(spark, f"{settings.paths.gold_dir}/analytics/equipment_health_summary")
    return rounded(summary.drop("last_updated_at"))
