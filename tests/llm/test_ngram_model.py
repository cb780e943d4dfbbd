from __future__ import annotations

import re
import zlib
from collections import Counter
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F

from fleetlake.llm import ngram_model as N
from fleetlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def tokens(text):
    lowered = "".join(c.lower() if c.isascii() else c for c in text or "")
    return [*re.findall(r"[^\x20\x09-\x0D]+", lowered), None]


def base_of(texts, training):
    counts = Counter(t for text in training for t in tokens(text))
    total = sum(counts.values())
    below = total + len(counts) + 1
    return [
        (len(tk := tokens(t)), sum(counts[x] > 0 for x in tk), total, sum(log10((counts[x] + 1) / below) for x in tk))
        for t in texts
    ]


def exact_score(text, training, classes):
    """The model with true levels in place of the filter."""
    counts = Counter(t for x in training for t in tokens(x))
    words = sorted((w for w in counts if w is not None), key=lambda w: (-counts[w], int(N.word_hashes([w.encode()])[0])))
    own = set(words[:classes])
    kind = lambda w: "end" if w is None else w.encode() if w in own else "shared"
    pairs, totals = Counter(), Counter()
    for x in training:
        before = "start"
        totals["start"] += 1
        for w in tokens(x):
            pairs[before, kind(w)] += 1
            totals[kind(w)] += 1
            before = kind(w)
    n = sum(counts.values())
    value, before = 0.0, "start"
    for w in tokens(text):
        k, c = kind(w), pairs[before, kind(w)]
        level = int(np.floor(np.log2(c) + 1e-9)) + 1 if c else 0
        seen = min(level if level < 2 else 1.5 * 2 ** (level - 1) - 0.5, totals[before], totals[k])
        value += log10((seen + N.PRIOR * (totals[k] + 1) / (n + len(own) + 3)) / (totals[before] + N.PRIOR))
        if k == "shared":
            value += log10((counts[w] + 1) / (totals["shared"] + len(counts) - len(own) - 1 + 1))
        before = k
    return value


def test_query_against_counting(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 7 == 2 for r in docs}
    got = {r.doc_id: r for r in QUERIES["op8_lm_score"].run(spark, SF).collect()}
    want = base_of([r.text for r in docs], [r.text for r in docs if not held[r.doc_id]])
    assert len(got) == len(docs)
    for r, (n, known, total, base) in zip(docs, want):
        g = got[r.doc_id]
        assert (g.n_tokens, g.n_known, g.train_tokens, g.held_out) == (n, known, total, held[r.doc_id])
        assert g.base_score == pytest.approx(base, rel=1e-9) and g.score < 0


@pytest.mark.parametrize("head", [0, 4, 1000])
def test_rare_words_and_scores(spark, head):
    texts = [None, "", "a b a b a c", "The the THE x\x0by", "unique words only here", "a b a b " * 5000, "a b", "a b"]
    rows = [(i, t, 1.5) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score double")
    trained = N.train(df, F.col("doc_id") != 4, classes=3, head=head)
    got = {r.doc_id: r for r in N.score(df, trained).collect()}
    training = [t for i, t in enumerate(texts) if i != 4]
    own = 0 if head == 0 else None
    for i, (n, known, total, base) in enumerate(base_of(texts, training)):
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (n, known, total)
        assert got[i].base_score == pytest.approx(base, rel=1e-9) and got[i].score_ == 1.5
        if own is None and head == 1000:
            assert got[i].score == pytest.approx(exact_score(texts[i], training, 3), rel=1e-6)


def test_filter_never_forgets(spark):
    rng = np.random.default_rng(0)
    keys = rng.integers(0, 2**40, 5000).astype(np.uint64)
    width = 64 * 40
    f = N.Filter(np.zeros(N.PIECES * width // 8, np.uint8), width)
    level = rng.integers(1, 4, 5000)
    for j in (1, 2, 3):
        mine = keys[level >= j]
        for at in N.positions(mine, j, width):
            at = at + N.piece_of(mine) * width
            np.bitwise_or.at(f.bits, at >> 3, (1 << (at & 7)).astype(np.uint8))
    exact = np.where(level < 2, level, 1.5 * 2.0 ** (level - 1) - 0.5)
    got = f.counts(keys)
    assert (got >= exact).all() and (got == exact).mean() > 0.9
    assert (f.counts(rng.integers(2**41, 2**42, 5000).astype(np.uint64)) == 0).mean() > 0.9


def test_empty(spark):
    df = spark.createDataFrame([(1, "some words")], "doc_id long, text string")
    nothing = N.train(df, F.lit(False))
    r = N.score(df, nothing).first()
    assert (r.n_tokens, r.n_known, r.train_tokens) == (3, 0, 0) and r.base_score == 0.0
    assert N.score(df.limit(0), nothing).count() == 0


def test_every_word_has_its_own_pairs(spark, monkeypatch):
    """Against full bigram counts, over more words than any fixed number of classes, in many parts and batches."""
    monkeypatch.setattr(N, "PART_BYTES", 9_000)
    rng = np.random.default_rng(3)
    after = {i: rng.integers(0, 3000, 2) for i in range(3000)}
    texts = []
    for _ in range(60):
        words, w = [], int(rng.integers(0, 3000))
        for _ in range(int(rng.integers(0, 300))):
            words.append(f"w{w}")
            w = int(rng.choice(after[w])) if rng.random() < 0.9 else int(rng.integers(0, 3000))
        texts.append(" ".join(words))
    texts += [None, texts[0], "never seen before", "w1 " * 400]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    trained = N.train(df, F.col("doc_id") % 4 != 1)
    assert trained.model.parts > 3
    training = [t for i, t in enumerate(texts) if i % 4 != 1]
    got = {r.doc_id: r for r in N.score(df, trained).collect()}
    assert len(got) == len(texts)
    # A false hit of the filter, one pair in some hundreds, lifts a score a little.
    apart = [got[i].score - exact_score(t, training, 10**9) for i, t in enumerate(texts)]
    assert min(apart) > -1e-6 and sum(a < 1e-6 for a in apart) > 0.6 * len(texts)
    assert max(a / got[i].n_tokens for i, a in enumerate(apart)) < 0.05
    again = {r.doc_id: r.score for r in N.score(df.where("doc_id % 4 != 1").unionAll(df.where("doc_id % 4 = 1")), trained).collect()}
    assert again == pytest.approx({i: r.score for i, r in got.items()})


def test_model_grows_with_the_words(spark):
    """More distinct words, more entries."""
    sizes = []
    for n in (4_000, 16_000):
        rows = [(i, " ".join(f"w{j}" for j in range(i, i + 400))) for i in range(0, n, 400)]
        parts = N.train(spark.createDataFrame(rows, "doc_id long, text string"), F.lit(True)).parts
        sizes.append(parts.agg(F.sum("width")).first()[0])
    assert sizes[1] > 3 * sizes[0]


def test_packed_numbers():
    rng = np.random.default_rng(1)
    for n in (0, 1, 1000):
        x = np.sort(rng.integers(0, 2**64, n, np.uint64))
        assert (N.unpacked(N.packed(x)) == x).all() and (N.unpacked_set(N.packed_set(x)) == x).all()


def test_a_word_in_every_text_is_counted_and_asked_in_lanes(spark, monkeypatch):
    """Far more batches than rows that may meet in one group: the same counts, the hot part in several copies."""
    rng = np.random.default_rng(5)
    texts = ["the " + " ".join(f"w{j}" for j in rng.integers(0, 400, 60)) for _ in range(80)] + [None, "the", "the " * 3000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(40)
    whole = {r.doc_id: r for r in N.score(df, N.train(df, F.lit(True))).collect()}
    monkeypatch.setattr(N, "FAN", 2)
    monkeypatch.setattr(N, "PART_BYTES", 2_000)
    trained = N.train(df, F.col("doc_id") >= 0)
    the = int((N.word_hashes([b"the"])[0] >> np.uint64(32)) * np.uint64(trained.model.parts) >> np.uint64(32))
    hot = trained.parts.where(F.col("part") == the).select("batches").collect()
    assert trained.model.parts > 2 * N.FAN and hot[0].batches > 10 * N.FAN
    got = {r.doc_id: r for r in N.score(df, trained).collect()}
    want = base_of(texts, texts)
    assert len(got) == len(texts)
    for i, (n, known, total, base) in enumerate(want):
        assert (got[i].n_tokens, got[i].n_known, got[i].train_tokens) == (n, known, total)
        assert got[i].base_score == pytest.approx(base, rel=1e-9)
        # The filter is cut otherwise, so other pairs may hit by chance.
        assert got[i].score == pytest.approx(whole[i].score, abs=0.05 * n)


def test_rows_in_another_order_at_every_reading(spark):
    """Texts are stored before batches are cut: a source without an order is read once."""
    import pyarrow as pa

    runs = spark.sparkContext.accumulator(0)
    texts = [f"some words of text {i} and more" for i in range(40)]

    def shuffled(batches):
        runs.add(1)
        for batch in batches:
            yield batch.take(pa.array(np.random.default_rng().permutation(batch.num_rows)))

    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    trained = N.train(df, F.lit(True))
    scored = N.score(df.mapInArrow(shuffled, df.schema), trained)
    before = runs.value
    first, second = ({r.doc_id: r.score for r in scored.collect()} for _ in range(2))
    assert first == pytest.approx(second) and len(first) == 40 and before == runs.value == 1
