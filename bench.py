"""Time the headline operators and print one JSON line.

Inputs are the reading views of the test tables, written once as Parquet
layers, as the lakehouse would read them. Each operator runs over its whole
input into a sink that keeps nothing; the better of two runs counts.
"""

from __future__ import annotations

import dataclasses
import json
import os
import time
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetlake.operators.features import ml_features
from fleetlake.operators.health import equipment_health, equipment_summary
from fleetlake.operators.ledger import Ledger
from fleetlake.operators.quality import validate_bronze
from fleetlake.operators.serving import unit_grouped_stats
from fleetlake.operators.series import global_rank, rolling_columns
from fleetlake.operators.silver import to_silver
from fleetlake.plans.lakehouse import ingest as land
from fleetlake.plans.marts import equipment_degradation, rolling_metrics, stage_readings
from fleetlake.queries import views as V
from fleetlake.queries.files import write_sources
from fleetlake.queries.layers import SETTINGS
from fleetlake.session import scratch_path
from fleetlake.settings import UNIQUE_SERIES, Paths
from fleetlake.sinks.tables import write_layer

RUNS = 2
NOW = datetime(2024, 1, 1)


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("fleetlake-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def timed(build) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    spark.sparkContext.setLogLevel("ERROR")

    def layer(name: str, df: DataFrame) -> DataFrame:
        """A layer in as many files as there are cores, so that scans are parallel."""
        spread = df.repartition(spark.sparkContext.defaultParallelism)
        return spark.read.parquet(write_layer(spread, scratch_path(spark, f"bench-{name}")))

    multi = layer("multi", V.multi(spark, sf))
    clean = layer("clean", V.clean(spark, sf))
    bronze = layer("bronze", V.daily(spark, sf))
    silver = layer("silver", to_silver(bronze, SETTINGS, NOW))
    health = layer("health", equipment_health(silver, now=NOW))
    staged = stage_readings(silver)
    whole = [F.col("sensor_02").asc_nulls_last(), F.col("dataset_id"), F.col("unit_id"), F.col("cycle")]
    sources = scratch_path(spark, "bench-sources")
    write_sources(bronze, sources)

    def ingested() -> DataFrame:
        """Text to bronze and manifest, in a fresh lake; hands back what it wrote."""
        lake = scratch_path(spark, "bench-lake")
        paths = dataclasses.replace(Paths.below(lake), source_dir=sources)
        settings = dataclasses.replace(SETTINGS, paths=paths)
        land(spark, settings, Ledger(spark, paths.metadata_dir), "bench", settings.dataset_ids, NOW)
        return spark.read.parquet(f"{paths.bronze_dir}/sensor_readings")

    order = [F.col("sensor_02").asc_nulls_last(), F.col("unit_id"), F.col("cycle")]

    queries = {
        "grouped_mean_std": lambda: unit_grouped_stats(multi),
        "rolling_benchmark": lambda: rolling_columns(multi, {"sensor_02": [("mean", 10), ("std", 10)]}, UNIQUE_SERIES),
        "to_silver": lambda: to_silver(bronze, SETTINGS, NOW),
        "ml_features": lambda: ml_features(silver),
        "equipment_health": lambda: equipment_health(silver, now=NOW),
        "equipment_health_summary": lambda: equipment_summary(health, silver, NOW),
        "validate_bronze": lambda: validate_bronze(bronze, "bench", NOW, SETTINGS),
        "rolling_metrics_mart": lambda: rolling_metrics(staged),
        "degradation_mart": lambda: equipment_degradation(staged),
        "maintenance_priority_rank": lambda: global_rank(clean, order, "maintenance_priority_rank"),
        "global_rank_multi": lambda: global_rank(multi, whole, "place"),
        "global_rank_multi_single_partition": lambda: multi.withColumn("place", F.row_number().over(W.orderBy(*whole))),
        "ingest": ingested,
    }
    seconds = {name: round(min(timed(build) for _ in range(RUNS)), 3) for name, build in queries.items()}
    print(
        json.dumps(
            {
                "metric": "headline operators, total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf.rstrip("/")).removeprefix("sf"),
                "cpus": int(os.environ.get("BENCH_CPUS", "8")),
                "rows": {"multi": multi.count(), "bronze": bronze.count(), "silver": silver.count(), "clean": clean.count()},
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
