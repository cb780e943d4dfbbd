from __future__ import annotations

import random
import re

import numpy as np
import pytest

from fleetlake.llm import near_copies as C
from fleetlake.llm.components import components, stars
from fleetlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def words(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def shingle_sets(texts, size):
    out = []
    for t in texts:
        w = words(t)
        out.append({tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set())
    return out


def brute(ids, texts, size, percent):
    """Component of each row, by comparing all pairs."""
    sets = shingle_sets(texts, size)
    label = list(range(len(ids)))

    def root(i):
        while label[i] != i:
            i = label[i]
        return i

    for i in range(len(ids)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and min(len(a), len(b)) * 100 >= percent * max(len(a), len(b)):
                shared = len(a & b)
                if shared and 100 * shared >= percent * (len(a) + len(b) - shared):
                    label[root(i)] = root(j)
    least = {}
    for i, d in enumerate(ids):
        if d is not None:
            least[root(i)] = min(d, least.get(root(i), d))
    return [(d, len(sets[i]), least.get(root(i)) if sets[i] else d) for i, d in enumerate(ids)]


def result(rows):
    return sorted(((r.doc_id, r.n_shingles, r.component_id) for r in rows), key=str)


def test_query_against_all_pairs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    got = QUERIES["op5_near_copies"].run(spark, SF).collect()
    want = brute([r.doc_id for r in docs], [r.text for r in docs], 3, 85)
    assert result(got) == sorted(want, key=str)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def chain(rng, n, vocabulary):
    """Texts each a few words away from the one before: near neighbours link, far ones do not."""
    text = [rng.choice(vocabulary) for _ in range(80)]
    for _ in range(n):
        text[rng.randrange(80)] = rng.choice(vocabulary)
        yield " ".join(text)


@pytest.mark.parametrize("blocks", [1, 0])
def test_chains_and_hot_groups(spark, monkeypatch, blocks):
    if blocks:
        monkeypatch.setattr(C, "BUCKET_BLOCK", 7)
        monkeypatch.setattr(C, "CLUSTER_BLOCK", 5)
    rng = random.Random(8)
    vocabulary = [f"w{i}" for i in range(300)]
    texts = [t for _ in range(4) for t in chain(rng, 30, vocabulary)]
    texts += ["one hot text of several words that all copies have"] * 150
    texts += [f"one hot text of several words that all copies have {i}" for i in range(30)]
    texts += [None, "", " \n", "x", "X", "two words", "two  Words", "é É", "a b a b a b a b", "a b a b"]
    texts += ["long " * 30_000, "long " * 30_001, " ".join(rng.choice(vocabulary) for _ in range(20_000))]
    ids = list(range(100, 100 + len(texts)))
    ids[-1] = None
    ids, texts = ids + [100, 101, None], texts + [texts[0], texts[1], texts[2]]
    df = spark.createDataFrame(list(zip(ids, texts, ["x"] * len(ids))), "doc_id long, text string, kept string")
    for size, percent in ((3, 85), (5, 80)):
        got = C.near_copies(df, size, percent).collect()
        assert result(got) == sorted(brute(ids, texts, size, percent), key=str)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert C.near_copies(df).count() == 0


def test_signature_estimates_similarity():
    rng = np.random.default_rng(0)
    errors = []
    for share in (0.2, 0.5, 0.8, 0.9):
        for _ in range(30):
            items = rng.integers(0, 2**63, 400).astype(np.uint64)
            n = int(400 * 2 * share / (1 + share))
            other = np.concatenate([items[:n], rng.integers(0, 2**63, 400 - n).astype(np.uint64)])
            exact = len(np.intersect1d(items, other)) / len(np.union1d(items, other))
            errors.append((C.signature(items) == C.signature(other)).mean() - exact)
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.06


def test_stars_join_what_links_join():
    rng = np.random.default_rng(3)
    a, b = rng.integers(0, 400, 300), rng.integers(0, 400, 300)
    node, least = stars(a, b)
    label = {n: n for n in [*a.tolist(), *b.tolist()]}
    for _ in range(400):
        for x, y in zip(a.tolist(), b.tolist()):
            label[x] = label[y] = min(label[x], label[y])
    assert dict(zip(node.tolist(), least.tolist())) == {n: m for n, m in label.items() if n != m}


@pytest.mark.parametrize("hub", [2, 1000])
def test_components_of_a_long_chain_and_a_hub(spark, monkeypatch, hub):
    monkeypatch.setattr("fleetlake.llm.components.HUB", hub)
    links = [(i, i + 1) for i in range(40)] + [(1000, i) for i in range(1001, 1400)] + [(5, 5)]
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.component for r in components(df).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{i: 1000 for i in range(1000, 1400)}}
