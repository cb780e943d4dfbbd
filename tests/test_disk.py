"""What the layers, the text sources and their shuffles leave on disk."""

from __future__ import annotations

import glob
import gzip
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from fleetlake.operators.skew import profile_groups
from fleetlake.plans import lakehouse
from fleetlake.queries import QUERIES, files
from fleetlake.queries import views as V
from fleetlake.session import shuffles_dropped
from fleetlake.sinks import tables as K
from fleetlake.sinks.bucketed import write_buckets
from fleetlake.sources import text as T

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_blocks(spark) -> set[str]:
    found = spark.sparkContext._jsc.sc().env().blockManager().diskBlockManager().getAllBlocks()
    names = (found.apply(i).name() for i in range(found.size()))
    return {name for name in names if name.startswith("shuffle_")}


def codecs(folder: str) -> set[str]:
    parts = [pq.ParquetFile(p).metadata for p in glob.glob(f"{folder}/**/*.parquet", recursive=True)]
    return {m.row_group(g).column(c).compression for m in parts for g in range(m.num_row_groups) for c in range(m.num_columns)}


@pytest.fixture(scope="module")
def sf(spark, tmp_path_factory):
    """360 lines of nine suppliers, with copies."""
    path = str(tmp_path_factory.mktemp("sf"))
    n = F.col("id")
    spark.range(360).select(
        F.floor(n / 3).alias("l_orderkey"),
        (n % 7).alias("l_partkey"),
        (n % 9).alias("l_suppkey"),
        (n % 3).cast("int").alias("l_linenumber"),
        (n % 50).cast("double").alias("l_quantity"),
        (n * 13.5).alias("l_extendedprice"),
        ((n % 11) / 100).alias("l_discount"),
        ((n % 9) / 100).alias("l_tax"),
        F.timestamp_seconds(F.floor(n / 12) * 86400 + 800_000_000).alias("l_shipdate"),
    ).write.parquet(f"{path}/lineitem.parquet")
    return path


def test_writes_leave_no_shuffle_files(spark, tmp_path):
    rows = spark.range(2000).select((F.col("id") % 20).alias("unit_id"), F.col("id").alias("cycle"), F.lit("FD001").alias("dataset_id"))
    before = shuffle_blocks(spark)
    K.write_layer(rows.repartition(5, "unit_id"), f"{tmp_path}/layer", ["dataset_id"])
    write_buckets(rows.repartition(4, "unit_id"), f"{tmp_path}/buckets", 4)
    files.write_parts(V.spread_out(lines_of(rows)), f"{tmp_path}/text")
    profile = profile_groups(rows, ["unit_id"])
    assert not shuffle_blocks(spark) - before
    assert (profile.groups, profile.rows) == (20, 2000) and spark.read.parquet(f"{tmp_path}/layer").count() == 2000


def lines_of(rows):
    numbers = {c: F.col("cycle").cast("double") for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")}
    return rows.withColumns({"l_linenumber": F.lit(1), "l_partkey": F.lit(2), **numbers})


def test_the_setting_is_put_back(spark):
    with pytest.raises(ValueError), shuffles_dropped(spark):
        assert spark.conf.get(CLEANUP) == "true"
        raise ValueError
    assert spark.conf.get(CLEANUP, "false") == "false"


def test_layers_are_stored_compact(spark, tmp_path):
    rows = spark.range(100).select((F.col("id") % 5).alias("unit_id"), F.col("id").alias("cycle"), F.lit("FD001").alias("dataset_id"))
    K.write_layer(rows, f"{tmp_path}/layer", ["dataset_id"])
    write_buckets(rows, f"{tmp_path}/buckets", 2)
    spark.createDataFrame([("a",), ("b",)], "value string").write.text(f"{tmp_path}/lines")
    T.store_lines(spark, f"{tmp_path}/lines", f"{tmp_path}/stored")
    assert {name: codecs(f"{tmp_path}/{name}") for name in ("layer", "buckets", "stored")} == dict.fromkeys(
        ("layer", "buckets", "stored"), {"ZSTD"}
    )


def test_text_parts_are_compressed_cut_and_in_order(spark, sf, tmp_path, monkeypatch):
    monkeypatch.setattr(files, "PART_LINES", 7)
    wide = files.write_sources(V.full(spark, sf), f"{tmp_path}/wide")
    narrow = files.write_sources(V.full_lines(spark, sf), f"{tmp_path}/narrow", spread=V.spread_out)

    def lines(source):
        parts = sorted(p for p in os.listdir(source) if p.startswith("part-"))
        assert all(p.endswith(".txt.gz") for p in parts)
        texts = [gzip.open(f"{source}/{p}", "rt").read().splitlines() for p in parts]
        assert max(map(len, texts)) <= 7
        return [line for text in texts for line in text]

    for a, b in zip(wide, narrow):
        assert lines(a) == lines(b)
        keys = [tuple(map(int, line.split()[:2])) for line in lines(b)]
        assert keys == sorted(keys) and keys
    assert sum(len(lines(p)) for p in narrow) == 360
    scanned = T.scan_sensor_text(spark, narrow, "run-1", files.NOW)
    counted = scanned.groupBy("source_file").agg(F.count(F.lit(1)).alias("n"), F.max("source_row_number").alias("last"))
    assert all(r.n == r["last"] for r in counted.collect())


@pytest.mark.parametrize("lines, readings", [(V.full_lines, V.full), (V.daily_lines, V.daily)])
def test_narrow_lines_stand_for_the_readings(spark, sf, lines, readings):
    spread = V.spread_out(lines(spark, sf))
    wide = readings(spark, sf).select(*spread.columns)
    assert spread.schema == wide.schema
    assert spread.exceptAll(wide).isEmpty() and wide.exceptAll(spread).isEmpty()


def test_the_exchange_of_a_source_is_narrow(spark, sf, tmp_path, monkeypatch):
    """The columns that go through the exchange, without those made of them."""
    seen = []

    def spread(rows):
        seen.extend(rows.columns)
        return V.spread_out(rows)

    files.write_sources(V.daily_lines(spark, sf), f"{tmp_path}/s", spread=spread)
    assert "l_quantity" in seen and not [c for c in seen if c.startswith("sensor_")]


def test_features_are_replaced_by_data_sets(spark, sf, monkeypatch):
    written = []
    write = K.write_features

    def watched(features, paths, buckets=None):
        written.append([r.dataset_id for r in features.select("dataset_id").distinct().collect()])
        return write(features, paths, buckets)

    monkeypatch.setattr(K, "write_features", watched)
    QUERIES["gold_sinks"].run(spark, sf)
    assert len(written) == 8 and sorted(map(tuple, written[4:])) == [(f"FD00{n}",) for n in (1, 2, 3, 4)]


def test_small_tables_of_an_ingest_leave_no_shuffle_files(spark, tmp_path):
    before = shuffle_blocks(spark)
    kept = lakehouse._kept(spark.range(50).groupBy((F.col("id") % 3).alias("k")).count(), f"{tmp_path}/kept")
    assert not shuffle_blocks(spark) - before and kept.count() == 3
