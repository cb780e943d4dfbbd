from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from fleetlake.llm import language as L
from fleetlake.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def test_windows_cover_every_byte():
    for n in (1, 2, 3, 127, 128, 129, 130, 253, 254, 1000):
        text = "".join(chr(97 + i % 26) for i in range(n))
        view, sizes = L.windows_of(text)
        raw = np.frombuffer(text.encode(), np.uint8)
        step = L.WINDOW - max(L.WIDTHS) + 1
        grams = {(i, raw[i : i + 4].tobytes()) for i in range(n - 3)}
        seen = {(k * step + i, w[i : i + 4].tobytes()) for k, w in enumerate(view) for i in range(L.WINDOW - 3)}
        assert grams <= seen and (sizes > 0).all()


def test_gradients_against_differences():
    rng = np.random.default_rng(0)
    net = L.Network.fresh(["a", "b", "c"], rng)
    x = rng.integers(97, 105, (5, L.WINDOW)).astype(np.uint8)
    y, weight = np.array([0, 1, 2, 0, 1]), np.ones(5, np.float32)
    grads = L._gradients(net, x, y, weight)
    params = [*net.tables.values(), net.bias, net.out, net.out_bias]

    def loss():
        return -np.log(net.probabilities(x)[np.arange(5), y].astype(float)).mean()

    for param, grad in zip(params, grads):
        for _ in range(4):
            at = tuple(rng.integers(0, n) for n in param.shape)
            if len(param.shape) == 3:
                at = (at[0], int(rng.integers(97, 105)), at[2])
            old = param[at]
            param[at] = old + 1e-2
            up = loss()
            param[at] = old - 1e-2
            down = loss()
            param[at] = old
            assert abs((up - down) / 2e-2 - grad[at]) < 5e-3


def test_held_out_accuracy(spark):
    got = QUERIES["op4_language"].run(spark, SF).join(spark.read.parquet(f"{SF}/documents.parquet"), "doc_id")
    held = got.where("held_out").agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert got.count() == 1000 and held > 0.98
    assert got.where("score < 0 OR score > 1").count() == 0


def test_edges(spark):
    rows = [(i, "the cat and the dog are here " * 3, "en") for i in range(40)]
    rows += [(i, "der hund und die katze sind hier " * 3, "de") for i in range(40, 80)]
    more = [(None, "and the cat", None), (90, None, "en"), (91, "", "de"), (92, "123 !!", None), (93, "é", "en"), (93, "é", "en")]
    more += [(94, "der hund und die katze " * 20_000, None)]
    df = spark.createDataFrame(rows + more, "doc_id long, text string, lang string").withColumn("score", F.lit("kept"))
    net = L.train(df, F.lit(True))
    got = L.predict(df, net).collect()
    assert len(got) == len(rows) + len(more) and {r.score_ for r in got} == {"kept"}
    by = {r.doc_id: r for r in got}
    assert by[90].lang_pred == by[91].lang_pred == by[92].lang_pred == "und" and by[90].score == 0
    assert by[94].lang_pred == "de" and by[None].lang_pred == "en"
    nothing = L.train(df.limit(0), F.lit(True))
    assert nothing is None
    assert {r.lang_pred for r in L.predict(df, nothing).collect()} == {"und"}
    assert L.predict(df.limit(0), net).count() == 0


def test_copies_take_no_share_of_the_sample(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(L, "fit", lambda x, y, languages: taken.append((x, y, languages)))
    rows = [("one and the same text", "en")] * 3000
    rows += [(f"text number {i}", "en") for i in range(200)] + [(f"der text {i}", "de") for i in range(200)]
    L.train(spark.createDataFrame(rows, "text string, lang string"), F.lit(True), per_language=300)
    x, y, languages = taken[0]
    windows = [(languages[j], bytes(w).rstrip(b"\0").decode()) for w, j in zip(x, y)]
    assert sorted(windows) == sorted({(lang, text) for text, lang in rows})


def test_rare_languages_are_learned(spark, monkeypatch):
    taken = []
    monkeypatch.setattr(L, "fit", lambda x, y, languages: taken.append(languages))
    monkeypatch.setattr(L, "TEXTS", 900)
    rows = [(f"text {i} of {i % 300}", f"l{i % 300:03}") for i in range(3000)] + [("the only one", "rare")]
    L.train(spark.createDataFrame(rows, "text string, lang string"), F.lit(True), per_language=600)
    assert len(taken[0]) == 301


def _by_loops(net, text):
    """Scores of each language: every window, width, filter and place by itself."""
    raw, step = text.lower().encode(), L.WINDOW - max(L.WIDTHS) + 1
    scores, total = [0.0] * len(net.languages), 0
    for start in range(0, max(1, len(raw) - max(L.WIDTHS) + 1), step):
        window = raw[start : start + L.WINDOW].ljust(L.WINDOW, b"\0")
        hidden = []
        for width in L.WIDTHS:
            for f in range(L.FILTERS):
                at = (sum(float(net.tables[width][j, window[p + j], f]) for j in range(width)) for p in range(L.WINDOW - width + 1))
                hidden.append(max(0.0, max(at) + float(net.bias[len(hidden)])))
        z = [sum(h * float(net.out[i, k]) for i, h in enumerate(hidden)) + float(net.out_bias[k]) for k in range(len(scores))]
        e = np.exp(np.array(z) - max(z))
        size = min(L.WINDOW, len(raw) - start)
        scores = [s + size * p for s, p in zip(scores, e / e.sum())]
        total += size
    return [s / total for s in scores]


def test_prediction_as_by_loops(spark):
    net = L.Network.fresh(["aa", "bb", "cc"], np.random.default_rng(4))
    texts = ["a", "Ein kurzer Text", "the cat and the dog are here " * 9, "éà漢字 " * 40]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in L.predict(df, net).collect():
        scores = _by_loops(net, texts[r.doc_id])
        assert r.lang_pred == net.languages[int(np.argmax(scores))]
        assert abs(r.score - max(scores)) < 1e-4
