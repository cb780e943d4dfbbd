from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from fleetlake.llm import quality_model as Q
from fleetlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    got = QUERIES["op9_quality"].run(spark, SF)
    assert got.count() == 1000 and got.where("score < 0 OR score > 1").count() == 0
    judged = got.join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").where("held_out")
    rates = {r.quality: r.right for r in judged.groupBy("quality").agg(F.avg((F.col("predicted") == F.col("quality")).cast("int")).alias("right")).collect()}
    assert rates[1] > 0.97 and rates[0] > 0.85


def test_isotonic_rises_and_fits():
    rng = np.random.default_rng(2)
    x = rng.normal(size=500)
    y = (rng.random(500) < 1 / (1 + np.exp(-3 * x))).astype(float)
    knots, levels = Q.isotonic(x, y)
    assert (np.diff(knots) > 0).all() and (np.diff(levels) > 0).all()
    assert abs(np.interp(x, knots, levels).mean() - y.mean()) < 0.02


def test_features_approximate_the_kernel():
    rng = np.random.default_rng(4)
    z = rng.normal(size=(30, Q.STATISTICS))
    w = rng.normal(0, 1 / np.sqrt(Q.STATISTICS), (Q.STATISTICS, 4096))
    f = Q.fourier(z, w, rng.uniform(0, 2 * np.pi, 4096))[:, :-1]
    exact = np.exp(-((z[:, None] - z) ** 2).sum(-1) / (2 * Q.STATISTICS))
    assert np.abs(f @ f.T - exact).max() < 0.12


def test_normal_equations_do_not_depend_on_partitions(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    one = Q.train(docs, labels, F.lit(True))
    many = Q.train(docs.repartition(13), labels.repartition(5), F.lit(True))
    assert np.allclose(one.weights, many.weights)


def test_edges(spark):
    docs = spark.createDataFrame(
        [(1, None, "a"), (2, "", "b"), (2, "", "b"), (None, "words and words", None), (3, "long text " * 50_000, "c")],
        "doc_id long, text string, score string",
    )
    labels = spark.createDataFrame(
        [(1, 0), (2, 1), (3, 1), (3, 1), (None, 1), (1, None), (2, 7)], "doc_id long, quality int"
    )
    for model in (None, Q.train(docs, labels, F.lit(True))):
        got = Q.score(docs, model).collect()
        assert len(got) == 5 and all(0 <= r.score <= 1 for r in got)
        assert {r.score_ for r in got} == {"a", "b", "c", None}
    assert Q.train(docs, labels.limit(0), F.lit(True)) is None
    assert Q.train(docs.limit(0), labels, F.lit(True)) is None
    assert Q.score(docs.limit(0), None).count() == 0
