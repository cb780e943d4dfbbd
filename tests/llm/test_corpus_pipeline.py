from __future__ import annotations

import corpus_pipeline as P
import sentencepiece
from pyspark.sql import functions as F
from test_leaks import brute as leaks
from test_near_copies import brute as components
from test_secret_ledger import spans

SF = "/root/testdata/sf0.001"


def masked(text):
    out, at = "", 0
    for _, start, end in spans(text):
        if start >= at:
            out += text[at:start] + "[secret]"
        at = max(at, end)
    return out + text[at:] if at else text


def test_stages_against_brute_force(spark):
    assert [k for k, _ in P.STAGES] == ["quality", "near_dedup", "decontaminate", "secrets", "encode"]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kept = [docs]
    for name, stage in P.STAGES[:-1]:
        out = stage(spark, kept[-1], SF)
        assert out.dtypes == docs.dtypes, name
        kept.append(P.stored(out, f"test-{name}"))
    rows = [{r.doc_id: r for r in df.collect()} for df in kept]
    # Quality: what stays is as it was; labelled rubbish goes.
    assert all(rows[0][i] == r for i, r in rows[1].items()) and len(rows[1]) > 0.7 * len(rows[0])
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    wrong = [i for i, q in labels.items() if i in rows[0] and (i in rows[1]) != bool(q)]
    assert len(wrong) <= 0.1 * len(labels)
    # Near copies: the least id of each component.
    ids = list(rows[1])
    want = {c for _, _, c in components(ids, [rows[1][i].text for i in ids], 5, 80)}
    assert set(rows[2]) == want
    # Leaks: exactly those that hold an item go.
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    held = {d for d, *_ in leaks([(i, r.text) for i, r in rows[2].items()], items)}
    assert set(rows[3]) == set(rows[2]) - held
    # Secrets: every text stays, masked.
    assert {i: r.text for i, r in rows[4].items()} == {i: masked(r.text) for i, r in rows[3].items()}
    assert all(r.n_chars == len(r.text) for i, r in rows[4].items() if r.text != rows[3][i].text)
    library = sentencepiece.SentencePieceProcessor(model_file=P.MODEL)
    got = {r.doc_id: r for r in P.encode(spark, kept[-1], SF).collect()}
    assert set(got) == set(rows[4])
    assert all(r.ids == library.encode(rows[4][i].text) and r.round_trip for i, r in got.items())


def test_edges(spark):
    rows = [(1, None, "en", None, None), (2, "", None, "s", 0), (None, "the same words again and again here", "en", "s", 5)]
    rows += [(None, "the same words again and again here", "en", "s", 5), (3, "x " * 50_000, "en", "s", 100_000)]
    rows += [(4, "token=abcdefgh é secret: 12345678", "en", "s", None)] * 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").withColumn("spans", F.lit("x"))
    deduped = P.near_dedup(spark, docs, SF)
    assert sorted(str(r.doc_id) for r in deduped.collect()) == ["1", "2", "3", "4", "None"]
    safe = P.secrets(spark, docs, SF)
    assert safe.columns == docs.columns and safe.count() == len(rows)
    assert {r.text for r in safe.where("doc_id = 4").collect()} == {"[secret] é [secret]"}
    assert P.decontaminate(spark, docs, SF).count() == len(rows)
    assert P.quality(spark, docs, SF).columns == docs.columns
    assert P.encode(spark, docs, SF).where("NOT round_trip").count() == 0
    for _, stage in P.STAGES:
        assert stage(spark, docs.limit(0), SF).count() == 0


def test_texts_go_to_a_worker_once(spark):
    from fleetlake.llm import quality_model
    from fleetlake.llm.pieces import encode_pieces

    docs = spark.createDataFrame([(1, "a few words", "x"), (2, None, "y")], "doc_id long, text string, source string")
    for taken in (quality_model.score(docs, None), encode_pieces(docs, P.MODEL, keep=["doc_id", "text"])):
        assert "__text" not in taken._jdf.queryExecution().optimizedPlan().toString()
        assert [r.text for r in taken.orderBy("doc_id").collect()] == ["a few words", None]
    apart = quality_model.score(docs, None, keep=["doc_id", "source"])
    assert apart.columns == ["doc_id", "source", "score", "predicted"]
    assert [r.doc_id for r in encode_pieces(docs, P.MODEL, keep=["doc_id"]).orderBy("doc_id").collect()] == [1, 2]
