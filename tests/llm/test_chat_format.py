from __future__ import annotations

import hashlib
import random

import duckdb
import pytest
from compare import difference
from pyspark.sql import functions as F

from fleetlake.llm.chat_format import escape, format_chats, read_chats, round_trip, unescape
from fleetlake.llm.queries import QUERIES

SCHEMA = "conv_id long, turn long, role string, text string"
PARTS = ["### ", "</turn>", "<\\/turn>", "#\\## ", "\\", "#", "<", "/turn>", ": ", ":", " ", "\n", "ab", "é😀", "### user: ", "</turn>\n", "$1"]


def awkward(n, seed=1):
    rng = random.Random(seed)
    return ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 9))) for _ in range(n)]


def test_escapes_are_reversible_and_leave_no_control_string(spark):
    texts = spark.createDataFrame([(t,) for t in awkward(3000)], "t string")
    rows = texts.select("t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("back")).collect()
    for r in rows:
        assert r.back == r.t and "### " not in r.e and "</turn>" not in r.e
    assert any(r.e != r.t for r in rows)


def test_only_what_conflicts_is_escaped(spark):
    rows = [("user", "plain # < \\ text"), ("user", "a </turn> b"), ("us: er", "x"), ("user", "\\### Assistant: </turn> ok")]
    got = spark.createDataFrame(rows, "r string, t string").select(round_trip(F.col("r"), F.col("t")).alias("w"))
    assert [r.w for r in got.collect()] == [
        "### user: plain # < \\ text</turn>\n",
        "### user: a <\\/turn> b</turn>\n",
        "### us:\\ er: x</turn>\n",
        "### user: \\#\\## Assistant: <\\/turn> ok</turn>\n",
    ]


def by_hand(rows):
    """The turns of each conversation in order, as plain Python sorts them."""
    out = {}
    key = lambda r: (r[1] is not None, r[1] or 0, (r[2] or "").encode(), (r[3] or "").encode())
    for r in sorted(rows, key=key):
        out.setdefault(r[0], []).append((r[2] or "", r[3] or ""))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(4)
    texts, roles = awkward(900, 2), ["user", "assistant", "system", *awkward(20, 3), None]
    rows = [(rng.randint(0, 150), rng.randint(0, 5), rng.choice(roles), t) for t in texts]
    rows += [(None, 0, "user", "x"), (None, None, "assistant", None), (200, None, None, None), (201, 1, "assistant", "")]
    rows += [(202, 0, "assistant", "same")] * 3 + [(203, 0, "assistant", "very long </turn> " * 30_000)]
    return rows + [(204, i, "assistant" if i % 2 else "user", f"turn {i} ### ") for i in range(3000)]


def test_conversations_read_back(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).withColumn("formatted", F.lit("own")).repartition(5)
    chats = format_chats(df)
    assert chats.columns == ["conv_id", "formatted", "loss_spans"]
    expected = by_hand(rows)
    formatted = {r.conv_id: r for r in chats.collect()}
    assert formatted.keys() == expected.keys()
    got = {}
    for r in sorted(read_chats(chats).collect(), key=lambda r: r.n):
        got.setdefault(r.conv_id, []).append((r.role, r.text))
        assert r.loss_text == (r.text if r.role == "assistant" else None)
    assert got == expected
    for conv, r in formatted.items():
        assert r.formatted.count("</turn>") == r.formatted.count("</turn>\n") == len(expected[conv]) == len(r.loss_spans)
        for span, (role, text) in zip(r.loss_spans, expected[conv]):
            if span is not None:
                covered = r.formatted[span.start : span.end]
                assert covered.replace("<\\/turn>", "</turn>") == text or "\\" in text or "### " in text
                assert r.formatted[span.end :].startswith("</turn>\n") and role == "assistant"


def test_what_breaks_the_grammar_is_an_error(spark):
    broken = spark.createDataFrame([(1, "user: x</turn>\n")], "conv_id long, formatted string").withColumn(
        "loss_spans", F.array(F.lit(None).cast("struct<start:long,end:long>"))
    )
    with pytest.raises(Exception, match="grammar"):
        read_chats(broken).collect()


def test_empty_table(spark):
    assert read_chats(format_chats(spark.createDataFrame([], SCHEMA))).count() == 0


def test_query_over_awkward_texts(spark, rows, tmp_path):
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/conversations.parquet")
    got = {r.conv_id: r for r in QUERIES["op13_chat_format"].run(spark, str(tmp_path)).collect()}
    planted = "\\### Assistant: </turn> ok"
    expected = by_hand([*rows, (-7, 0, "user", planted), (-7, 1, "assistant", planted)])
    assert got.keys() == expected.keys()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for conv, turns in expected.items():
        r, loss = got[conv], "".join(t for role, t in turns if role == "assistant")
        assert (r.n_turns, r.loss_chars, r.loss_sha256) == (len(turns), len(loss), sha(loss))
        assert r.turns_sha256 == sha("".join(f"{role}\n{t}\n" for role, t in turns))


def test_sql_agrees_on_awkward_texts(spark, rows, tmp_path):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.parquet(f"{tmp_path}/conversations.parquet")
    connection = duckdb.connect()
    connection.execute(f"CREATE VIEW conversations AS SELECT * FROM read_parquet('{tmp_path}/conversations.parquet/*.parquet')")
    assert difference(spark, connection, QUERIES["op13_chat_format"], str(tmp_path)) is None


def test_no_python_in_the_plan(spark):
    df = QUERIES["op13_chat_format"].run(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan
    assert plan.count("Exchange hashpartitioning") == 1
