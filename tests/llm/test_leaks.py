from __future__ import annotations

import random
import re
from collections import Counter

import numpy as np
import pytest

from fleetlake.llm import leaks as K
from fleetlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def words(text):
    return re.sub(r"[\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]", " ", (text or "").lower()).split(" ")


def brute(docs, items):
    """Every window of every document against every item."""
    out = []
    for d, text in docs:
        w = [x for x in words(text) if x]
        for i, item in items:
            v = [x for x in words(item) if x]
            if not v or not w:
                continue
            size = min(5, len(v))
            grams = lambda x: Counter(tuple(x[j : j + size]) for j in range(max(1, len(x) - size + 1)))
            want, best = grams(v), (0.0, 0)
            inside = set(want)
            if inside.isdisjoint(grams(w)):
                continue
            for s in range(max(1, len(w) - len(v) + 1)):
                window = w[s : s + len(v)]
                have = grams(window)
                if not inside.isdisjoint(have):
                    shared = sum((want & have).values())
                    best = max(best, (shared / (sum(want.values()) + sum(have.values()) - shared), -s))
            if best[0] >= 0.8:
                out.append((d, i, round(best[0], 9), -best[1], min(len(v), len(w))))
    return sorted(out, key=str)


def result(df):
    return sorted(((r.doc_id, r.item_id, round(r.similarity, 9), r.start_word, r.n_words) for r in df.collect()), key=str)


def test_query_against_all_windows(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    got = result(QUERIES["op1_decontamination"].run(spark, SF))
    assert got and got == brute(docs, items)


@pytest.mark.parametrize("blocks", [1, 4])
def test_edited_passages_and_edges(spark, monkeypatch, blocks):
    rng = random.Random(2)
    vocabulary = [f"w{i}" for i in range(60)] + ["the", "of", "é"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randint(1, 50)))) for i in range(40)]
    items += [(40, items[0][1]), (7, items[7][1]), (41, None), (42, ""), (43, "!!"), (None, items[20][1]), (44, "the the the the the the the the the")]
    docs = []
    for n in range(120):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(0, 60))]
        passage = (rng.choice(items[:40])[1]).split()
        for _ in range(rng.randint(0, 3)):
            passage[rng.randrange(len(passage))] = rng.choice(vocabulary)
        if rng.random() < 0.3:
            passage = [x.upper() + "," for x in passage]
        docs.append((n, " ".join([*w[: len(w) // 2], *passage, *w[len(w) // 2 :]])))
    docs += [(200, None), (201, ""), (202, "..."), (None, items[12][1]), (203, "x " * 60_000 + items[13][1]), (5, docs[5][1]), (5, docs[5][1])]
    docs += [(204, "the " * 30), (205, " ".join(items[14][1].split()[:-1]))]
    if blocks > 1:
        monkeypatch.setattr(K, "BLOCK_BYTES", sum(len(t or "") for _, t in items) // blocks)
    df = spark.createDataFrame([(d, t, 0.5) for d, t in docs], "doc_id long, text string, similarity double")
    got = result(K.find_leaks(df, spark.createDataFrame(items, "item_id long, text string")))
    assert got == brute(docs, sorted(set(items), key=str))
    kept = K.drop_leaks(df, spark.createDataFrame(items, "item_id long, text string"))
    found = {d for d, *_ in got}
    # Rows of one id differ in text; the id that is NULL is one row.
    assert kept.columns == df.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _ in docs if d not in found)


def test_empty(spark):
    docs = spark.createDataFrame([(1, "some words of a text that is here")], "doc_id long, text string")
    items = spark.createDataFrame([(1, "some words of a text that is here")], "item_id long, text string")
    assert K.find_leaks(docs, items).count() == 1
    assert K.find_leaks(docs.limit(0), items).count() == K.find_leaks(docs, items.limit(0)).count() == 0


def test_index_finds_every_fingerprint_in_the_radius():
    rng = np.random.default_rng(0)
    group = K.Items(12, [(i, [f"{rng.integers(1e9)}".encode() for _ in range(12)]) for i in range(50)])
    prints = group.prints.copy()
    for row in prints:
        for bit in rng.choice(64, int(rng.integers(0, 40)), replace=False):
            row[bit // 8] ^= 1 << (bit % 8)
    got = set(zip(*(c.tolist() for c in group.candidates(prints))))
    far = K._ONES[prints[:, None] ^ group.prints].sum(axis=2)
    assert got == set(zip(*(c.tolist() for c in np.nonzero(far <= K.RADIUS))))
