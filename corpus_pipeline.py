"""From raw documents to encoded ones: quality, near copies, leaks, secrets, pieces.

Every stage reads all that the one before kept. All but the last return the
columns they were given.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.llm import quality_model
from fleetlake.llm import secret_ledger as S
from fleetlake.llm.common import id_hash, spare, stored, table
from fleetlake.llm.leaks import drop_leaks
from fleetlake.llm.near_copies import drop_near_copies
from fleetlake.llm.pieces import encode_pieces
from fleetlake.session import scratch_path

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def _own(docs: DataFrame, results: tuple[str, ...]) -> list[Column]:
    """The columns of ``docs`` under their own names, where an operator moved those called like its results."""
    return [F.col(spare(c + "_", docs.columns)).alias(c) if c in results else F.col(c) for c in docs.columns]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns as in the query of its own."""
    held_out = F.coalesce(id_hash(F.col("doc_id"), 5) == 0, F.lit(False))
    model = quality_model.train(docs, table(spark, sf_dir, "labels"), ~held_out)
    return quality_model.score(docs, model).where("predicted = 1").select(*_own(docs, ("score", "predicted")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies (five words, 0.8)."""
    return drop_near_copies(docs).select(*docs.columns)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return drop_leaks(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets in their texts masked; n_chars follows the text where it changes."""
    ledger = scratch_path(spark, "secret-ledger")
    S.update_ledger(docs, ledger)
    found = S.findings(docs, ledger)
    own = {c: F.col(spare("spans_", docs.columns) if c == "spans" else c) for c in docs.columns}
    masked = S.mask(F.col("text"), F.col("spans"))
    own["text"] = masked
    if "n_chars" in own:
        own["n_chars"] = F.when(F.size("spans") > 0, F.length(masked)).otherwise(F.col("n_chars")).cast(docs.schema["n_chars"].dataType)
    return found.select(*(column.alias(name) for name, column in own.items()))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids and byte spans of every document, and whether the ids decode to its text."""
    encoded = encode_pieces(docs, MODEL, keep=["doc_id", "text"])
    same = F.col("decoded") == F.coalesce("text", F.lit(""))
    return encoded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids", "starts", "ends", same.alias("round_trip")
    )


STAGES = [
    ("quality", quality),
    ("near_dedup", near_dedup),
    ("decontaminate", decontaminate),
    ("secrets", secrets),
    ("encode", encode),
]

#: SQL cannot express the trained classifier.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
