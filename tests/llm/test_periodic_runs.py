from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest

from fleetlake.llm.periodic_runs import find_in, find_runs, kept_words, overlap
from fleetlake.llm.queries import QUERIES


def brute_runs(words, least=6, times=4):
    """All maximal stretches at every lag; those with a smaller period are none of that lag."""
    n, found = len(words), {}
    for lag in range(1, n):
        i = 0
        while i + lag < n:
            if words[i] != words[i + lag]:
                i += 1
                continue
            start = i
            while i + lag < n and words[i] == words[i + lag]:
                i += 1
            length = i - start + lag
            if length >= max(least, times * lag):
                found.setdefault((start, length), lag)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    dropped = {i for s, n, q in runs for i in range(s + q, s + n)}
    return [w for i, w in enumerate(words) if i not in dropped]


def samples(n, seed=3):
    rng = random.Random(seed)
    for _ in range(n):
        words = []
        while len(words) < rng.randint(0, 120):
            root = [rng.choice("abc") for _ in range(rng.choice([1, 1, 2, 3, 5, 8, 13]))]
            words += root * rng.choice([1, 1, 2, 4, 5, 9]) + root[: rng.randint(0, len(root))]
        yield words


def searched(words, least=6, times=4):
    numbers = {w: i for i, w in enumerate(dict.fromkeys(words))}
    flat = np.array([numbers[w] for w in words] + [len(numbers)], np.int64)
    return find_in(flat, np.zeros(len(flat), np.int64), least, times)


@pytest.mark.parametrize("least, times", [(6, 4), (0, 3), (9, 3), (40, 5)])
def test_runs_as_by_brute_force(least, times):
    for words in samples(700):
        expected = brute_runs(words, least, times)
        assert searched(words, least, times) == expected, words
        mask = kept_words(len(words), expected)
        assert [w for w, k in zip(words, mask) if k] == brute_collapsed(words, expected)


@pytest.mark.parametrize("least, times", [(6, 4), (0, 3), (100, 3)])
def test_guaranteed_overlap_reaches_the_lag(least, times):
    for low in (1 << b for b in range(10)):
        size = overlap(low, least, times)
        assert size == min(max(least, times * q) - q for q in range(low, 3000)) >= 2 * low - 1


def test_one_word_all_along_takes_one_extension():
    assert searched(["x"] * 200_000) == [(0, 200_000, 1)]
    assert searched((["a", "b", "c"] * 70_000)[:-1]) == [(0, 209_999, 3)]


def test_table(spark):
    long = " ".join(["very", "long"] * 60_000)
    texts = [None, "", " \n\t", "a a a a a a", "a\x0ba\na a\ta", " b  a b a b a b a ", "x", long, long, "é é é é é é É", "a a a a"]
    rows = [(i, t, "own") for i, t in enumerate(texts)] + [(3, "twice", "own")] * 2
    df = spark.createDataFrame(rows, "doc_id long, text string, runs string").repartition(3)
    got = find_runs(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.runs_ == "own"
        words = [w.decode() for w in (r.text or "").encode().split()]
        expected = brute_runs(words) if len(words) < 1000 else [(0, len(words), 2)]
        assert [tuple(x) for x in r.runs] == expected and r.n_words == len(words)
        assert r.collapsed == " ".join(brute_collapsed(words, expected))
    assert find_runs(df.limit(0)).count() == 0


def contract(doc_id, text):
    """A row of the query, in plain Python."""
    words = [w.decode() for w in (text or "").encode().split()]
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = brute_runs(words)
    top = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
    milli = 1000 * top[1] // top[2] if runs else None
    spelled = "".join(f"{s},{n},{q}\n" for s, n, q in runs)
    digests = [hashlib.sha256(x.encode()).hexdigest() for x in (spelled, " ".join(brute_collapsed(words, runs)))]
    return (doc_id, len(runs), *top, milli, *digests)


def test_query_as_by_brute_force(spark, tmp_path):
    rng = random.Random(8)
    rows = [(i, rng.choice([" ", "\n "]).join(w)) for i, w in enumerate(samples(400, 4))]
    rows += [(i, " ".join(rng.choice("abcdefghij") for _ in range(rng.randint(0, 40)))) for i in range(400, 900)]
    rows += [(900 + i, t) for i, t in enumerate([None, "", " "] * 20)] + [rows[5]] * 2
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = QUERIES["op12_periodic_runs"].run(spark, str(tmp_path))
    assert got.columns == [
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
    ]
    assert sorted(map(tuple, got.collect()), key=str) == sorted((contract(*r) for r in rows), key=str)
