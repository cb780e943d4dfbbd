from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlake.llm import nearest as A
from fleetlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def brute(rows, asks, k):
    """Every candidate of every query."""
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = {}
    for i, v in rows:
        if asks(i):
            s = (x * np.array(v, float)).sum(axis=1)
            out[i] = sorted(((-a, b) for a, b in zip(s.tolist(), ids.tolist()) if b != i))[:k]
    return out


def recall(got, want):
    found = {}
    for r in got:
        found.setdefault(r.query_id, set()).add(r.vec_id)
    return np.mean([len(found.get(q, set()) & {i for _, i in hits}) / max(1, len(hits)) for q, hits in want.items()])


def test_recall_and_scores(spark):
    rows = [(r.vec_id, r.embedding) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
    got = QUERIES["op2_nearest"].run(spark, SF).collect()
    want = brute(rows, lambda i: i % 20 == 0, 20)
    assert recall(got, want) >= 0.9
    x = {i: np.array(v, float) for i, v in rows}
    for r in got:
        assert r.score == pytest.approx(float(x[r.query_id] @ x[r.vec_id]), abs=1e-12)
    for q in want:
        mine = sorted((r for r in got if r.query_id == q), key=lambda r: r.rank)
        assert [r.rank for r in mine] == list(range(1, 21))
        assert [(-r.score, r.vec_id) for r in mine] == sorted((-r.score, r.vec_id) for r in mine)


def test_large_lists_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(A, "PART_ROWS", 60)
    monkeypatch.setattr(A, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(6, 24)) * 3
    rows = [(i, (centres[i % 6] + rng.normal(size=24)).tolist()) for i in range(1500)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = A.nearest(df, F.col("vec_id") % 5 == 0, 10).collect()
    assert recall(got, brute(rows, lambda i: i % 5 == 0, 10)) >= 0.95


def test_hot_copies_and_ties(spark):
    rng = np.random.default_rng(2)
    hot = rng.normal(size=8).tolist()
    rows = [(i, hot if i % 3 == 0 else rng.normal(size=8).tolist()) for i in range(600)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = A.nearest(df, F.col("vec_id") % 20 == 0, 20).collect()
    want = brute(rows, lambda i: i % 20 == 0, 20)
    mine = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        mine.setdefault(r.query_id, []).append(r.vec_id)
    for q in (0, 60, 540):
        assert mine[q] == [i for _, i in want[q]]
    assert all(len(v) == 20 for v in mine.values())


def test_edges(spark):
    good = [(i, [1.0, float(i)]) for i in range(1, 6)]
    bad = [(20, None), (None, [1.0, 1.0]), (40, [0.0, 0.0]), (60, [None, 1.0]), (80, [float("nan"), 1.0]), (100, [float("inf"), 1.0]), (120, []), (140, [1.0])]
    df = spark.createDataFrame(good + good[:2] + bad, "vec_id long, embedding array<double>").withColumn("score", F.lit("x"))
    got = A.nearest(df, F.lit(True), 3).collect()
    want = brute(good, lambda i: True, 3)
    assert {(r.query_id, r.rank, r.vec_id) for r in got} == {(q, n + 1, i) for q, hits in want.items() for n, (_, i) in enumerate(hits)}
    few = A.nearest(df, F.col("vec_id") == 1, 20).collect()
    assert [r.vec_id for r in sorted(few, key=lambda r: r.rank)] == [5, 4, 3, 2]
    assert A.nearest(df.limit(0), F.lit(True)).count() == 0
    assert A.nearest(df.where("vec_id = 1"), F.lit(True)).count() == 0


def test_an_id_with_several_vectors(spark):
    rows = [(1, [1.0, 0.0]), (1, [0.0, 1.0]), (1, [0.0, 1.0]), (2, [3.0, 1.0]), (3, [1.0, 4.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = sorted((r.rank, r.vec_id, r.score) for r in A.nearest(df, F.col("vec_id") == 1, 20).collect())
    of_first = [(1, 2, 3.0), (2, 3, 1.0), (3, 1, 0.0)]
    of_second = [(1, 3, 4.0), (2, 2, 1.0), (3, 1, 0.0)]
    assert got == sorted(of_first + of_second)
