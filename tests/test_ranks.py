from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from fleetlake.operators import ranks
from fleetlake.operators.ranks import SortKey, global_rank
from fleetlake.operators.silver import enforce_types


def rows_of(kind):
    rng = random.Random(3)
    score = {
        "spread": lambda i: rng.uniform(-5, 5),
        "equal": lambda i: 1.0,
        "hot": lambda i: 2.0 if i % 3 else rng.uniform(0, 4),
        "odd": lambda i: rng.choice([None, float("nan"), float("inf"), -0.0, 0.0, 1.5]),
    }[kind]
    return [(score(i), rng.choice(["a", "é", None]), i) for i in range(4000)]


@pytest.mark.parametrize("kind", ["spread", "equal", "hot", "odd"])
@pytest.mark.parametrize("last", [True, False])
def test_as_one_sorted_list(spark, kind, last):
    df = spark.createDataFrame(rows_of(kind), "score double, word string, id long").repartition(7)
    score = F.col("score")
    order = [score.asc_nulls_last() if last else score.asc_nulls_first(), F.col("word"), "id"]
    ranked = global_rank(df, order, "place", partitions=5, bucket_rows=300)
    want = [r.id for r in df.coalesce(1).orderBy(order[0], "word", "id").collect()]
    got = ranked.orderBy("place").collect()
    assert [r.id for r in got] == want and [r.place for r in got] == list(range(1, 4001))
    assert ranked.columns == ["score", "word", "id", "place"]


def test_plan_stores_nothing_and_buckets_stay_small(spark, monkeypatch):
    df = spark.createDataFrame(rows_of("hot"), "score double, word string, id long")
    ranked = global_rank(df, ["score", "id"], "place", partitions=4, bucket_rows=200)
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert "LogicalRDD" not in plan.replace("LogicalRDD [score", "") and "Checkpoint" not in plan
    executed = ranked._jdf.queryExecution().executedPlan().toString()
    assert executed.count("Exchange hashpartitioning") == 1 and "from_json" not in executed
    sizes = ranked.withColumn("task", F.spark_partition_id()).groupBy("task").count().collect()
    assert max(r["count"] for r in sizes) < 2000


def test_empty_single_and_wrong(spark):
    df = spark.createDataFrame([], "score double, id long")
    assert global_rank(df, ["score"], "place").count() == 0
    one = spark.createDataFrame([(None, 1)], "score double, id long")
    assert global_rank(one, ["score", "id"], "place").first().place == 1
    with pytest.raises(ValueError, match="ascending"):
        global_rank(one, [F.col("score").desc()], "place")
    assert SortKey.of(F.col("a").asc_nulls_last()) == SortKey("a", True) and SortKey.of("b") == SortKey("b")
    assert ranks.MAX_BUCKETS > 0


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_types_are_enforced_in_any_mode(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        good = spark.createDataFrame([("1", 2, "3.5"), (None, 3, None)], "unit_id string, cycle int, sensor_01 string")
        assert [tuple(r) for r in enforce_types(good).collect()] == [(1, 2, 3.5), (None, 3, None)]
        bad = spark.createDataFrame([("x", 2, "3.5")], "unit_id string, cycle int, sensor_01 string")
        with pytest.raises(Exception, match="unit_id cannot be cast to bigint: x"):
            enforce_types(bad).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
