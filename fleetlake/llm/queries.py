"""The numbered queries over the driver's tables, and the SQL that checks them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm import language, ngram_model, quality_model
from fleetlake.llm import secret_ledger as S
from fleetlake.llm.alignment import align_tokens, weigh_links
from fleetlake.llm.chat_format import format_chats, read_chats
from fleetlake.llm.common import id_hash, stored, table
from fleetlake.llm.leaks import find_leaks
from fleetlake.llm.near_copies import near_copies
from fleetlake.llm.nearest import nearest
from fleetlake.llm.periodic_runs import find_runs
from fleetlake.llm.pieces import encode_pieces
from fleetlake.llm.shards import shard_by_bytes
from fleetlake.llm.url_rules import judge_urls
from fleetlake.queries.registry import Query
from fleetlake.session import scratch_path

QUERIES: dict[str, Query] = {}


def query(name: str, sql: str | None = None):
    def register(run):
        QUERIES[name] = Query(run, sql)
        return run

    return register


#: Fixed values of the contract.
URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


@query(
    "op3_url_filter",
    r"""
    WITH parts AS (
      SELECT page_id,
             coalesce(translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
             coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path,
             row_number() OVER () AS n
      FROM pages),
    rules(h, p, v) AS (VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'),
                              ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')),
    fits AS (
      SELECT n, max_by({'rule': h || p, 'v': v}, length(h || p)) AS best
      FROM parts JOIN rules ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
      GROUP BY n)
    SELECT page_id, host, path, best.rule AS rule, coalesce(best.v, 'allow') AS verdict
    FROM parts LEFT JOIN fits USING (n)
    """,
)
def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url against the four rules."""
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def _secret_sql() -> str:
    """Positions from the text between the matches; the two further kinds as the method has them."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    kinds = " UNION ALL ".join(
        f"SELECT n, {rank} AS rank, {quoted(r.kind)} AS kind, {r.least} AS least, string_split_regex(t, {quoted(r.pattern)}) AS gaps, "
        f"regexp_extract_all(t, {quoted(r.pattern)}) AS hits, regexp_extract_all(t, {quoted(r.pattern)}, {r.group}) AS vals FROM docs"
        for rank, r in enumerate(S.RULES)
    )
    return f"""
    WITH docs AS (SELECT doc_id, coalesce(text, '') AS t, row_number() OVER () AS n FROM documents),
    matched AS ({kinds}),
    each AS (SELECT *, unnest(generate_series(1, len(hits))) AS i FROM matched WHERE len(hits) > 0),
    placed AS (
      SELECT n, rank, kind, hits[i] AS hit,
             (list_sum(list_transform(gaps[1:i], lambda g: length(g)))
              + coalesce(list_sum(list_transform(hits[1:i - 1], lambda h: length(h))), 0))::BIGINT AS s
      FROM each WHERE length(vals[i]) >= least),
    spelled AS (SELECT *, kind || ':' || s || ':' || (s + length(hit)) AS span FROM placed),
    joined AS (
      SELECT n, count(*) FILTER (kind = 'assign') AS n_assign, count(*) FILTER (kind = 'access') AS n_access,
             count(*) FILTER (kind = 'hex') AS n_hex,
             string_agg(span, ',' ORDER BY s, rank) FILTER (rank < 3) AS base, string_agg(span, ',' ORDER BY s, rank) AS spans
      FROM spelled GROUP BY n)
    SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM docs LEFT JOIN joined USING (n)
    """


@query("op6_secret_scan", _secret_sql())
def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document as a version of its path, scanned through a new ledger."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = scratch_path(spark, "secret-ledger")
    S.update_ledger(docs, ledger)
    found = S.findings(docs, ledger)

    def of(*kinds: str):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    return found.select(
        "doc_id",
        *(F.size(of(r.kind)).cast("long").alias(f"n_{r.kind}") for r in S.BASE),
        F.sha2(S.joined_spans(of(*(r.kind for r in S.BASE))), 256).alias("base_sha256"),
        S.joined_spans(F.col("spans")).alias("spans"),
    )


SHARDS = 40


@query("op10_sharding")
def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document in one of forty shards of near equal bytes."""
    sharded = shard_by_bytes(table(spark, sf_dir, "documents"), SHARDS)
    crc = F.crc32("text").alias("text_crc32")
    return sharded.select(
        "doc_id", "size", crc, F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


MODEL = public_tokenizers.path("piece_bpe_32k.model")


@query("op7_sentencepiece")
def op7_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's pieces and what they decode to, as digests."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = encode_pieces(docs, MODEL, keep=["doc_id"])
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op4_language")
def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's language, learned from two thirds of the ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(id_hash(F.col("doc_id"), 3) == 1, F.lit(False))
    net = language.train(docs, ~held_out)
    return language.predict(docs.withColumn("held_out", held_out), net, keep=["doc_id", "held_out"])


@query("op9_quality")
def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality, learned from the labels of four fifths of the ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(id_hash(F.col("doc_id"), 5) == 0, F.lit(False))
    model = quality_model.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    return quality_model.score(docs.withColumn("held_out", held_out), model, keep=["doc_id", "held_out"])


@query("op8_lm_score")
def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's log probability, learned from six sevenths of the ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.coalesce(id_hash(F.col("doc_id"), 7) == 2, F.lit(False))
    trained = ngram_model.train(docs, ~held_out)
    rows = docs.withColumn("held_out", held_out)
    return ngram_model.score(rows, trained, keep=["doc_id", "held_out"], from_files=True)


@query("op2_nearest")
def op2_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The twenty nearest of every twentieth vector, among all."""
    return nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@query("op5_near_copies")
def op5_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's component of near copies."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_copies(docs, size=3, percent=85).select("doc_id", "n_shingles", "component_id", "kept")


@query("op1_decontamination")
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The benchmark items that documents hold."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return find_leaks(docs, table(spark, sf_dir, "benchmark"))


def _planted(docs: DataFrame) -> DataFrame:
    """The contract's test input: in every tenth id's text the words from a place on repeat the first few of them."""
    h = F.crc32(F.col("doc_id").cast("string"))
    split = docs.withColumns(
        {
            "__g": F.floor(h / 10),
            "__words": F.when(h % 10 == 0, F.filter(F.split("text", r"[ \t-\r]+", -1), lambda w: w != "")),
        }
    )
    n, g = F.size("__words"), F.col("__g")
    placed = split.withColumn("__a", F.when(n > 0, g % n).cast("int"))
    a = F.col("__a")
    period = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    root = F.slice("__words", a + 1, period)
    again = F.slice(F.flatten(F.array_repeat(root, F.ceil((n - a) / period).cast("int"))), F.lit(1), n - a)
    text = F.concat_ws(" ", F.slice("__words", F.lit(1), a), again)
    return placed.select("doc_id", F.when(a.isNotNull(), text).otherwise(F.col("text")).alias("text"))


BYTE_LEVEL = public_tokenizers.path("byte_bpe_50k.json")


@query("op11_alignment")
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens of two tokenizers, linked where they end together."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    sizes = ["doc_id", "n_a", "n_b", "n_groups"]
    digest = F.when(F.col("groups") == "", "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    aligned = align_tokens(docs, BYTE_LEVEL, MODEL, keep=["doc_id"]).select(*sizes, digest, "links")
    return weigh_links(stored(aligned, "alignment", "zstd", 8 << 20), BYTE_LEVEL, MODEL, keep=[*sizes, "groups_sha256"])


@query("op12_periodic_runs")
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's periodic stretches of words, and its text without their repeats."""
    docs = _planted(table(spark, sf_dir, "documents").select("doc_id", "text"))
    found = find_runs(docs, keep=["doc_id"])
    line = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    longest = F.array_max(
        F.transform("runs", lambda r: F.struct(r["length"], (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    )
    return found.withColumn("longest", F.when(F.size("runs") > 0, longest)).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("longest.s")).alias("start"),
        F.col("longest.length").alias("length"),
        (-F.col("longest.p")).alias("period"),
        F.floor(1000 * F.col("longest.length") / -F.col("longest.p")).alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform(line, lambda x: F.concat(x, F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


@query(
    "op13_chat_format",
    r"""
    WITH turns AS (
      SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
      UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
      UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
    sized AS (
      SELECT *, 14 + length(role) + len(regexp_extract_all(role, '#\\*## ')) + len(regexp_extract_all(role, '<\\*/turn>'))
                + len(regexp_extract_all(role, ':\\* ')) + length(text)
                + len(regexp_extract_all(text, '#\\*## ')) + len(regexp_extract_all(text, '<\\*/turn>')) AS size
      FROM turns)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(size)::BIGINT AS formatted_chars
    FROM sized GROUP BY conv_id
    """,
)
def op13_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as one marked text, and what is read back from it."""
    own = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit("\\### Assistant: </turn> ok").alias("text"),
    )
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    turn = F.struct("n", "role", "text", "loss_text")
    of_conv = (
        read_chats(format_chats(turns))
        .groupBy("conv_id")
        .agg(F.sort_array(F.collect_list(turn)).alias("t"), F.sum("chars").alias("formatted_chars"))
    )
    spelled = F.concat_ws("", F.transform("t", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))))
    loss = F.concat_ws("", "t.loss_text")
    return of_conv.select(
        "conv_id",
        F.size("t").cast("long").alias("n_turns"),
        F.sha2(spelled, 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )
