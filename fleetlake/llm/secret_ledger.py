"""Secret scan over an incremental ledger of blobs.

Every version of every path is addressed by the SHA-256 of its text. The ledger
holds, for each blob, the rules it was scanned with, by name and version, and
what they found. A scan reads only blobs for which some pair of blob and rule
version is missing, applies only the missing rules, and appends. Findings are
then joined back to all paths and versions that hold the blob.

All of it is DataFrame expressions.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from fleetlake.llm.common import spare

ENTRY = "blob_id binary, scanned array<string>, findings array<struct<kind: string, start: int, end: int>>"


@dataclass(frozen=True)
class Rule:
    """A pattern without look-around; ``group`` of a match must have ``least`` characters, or the match is dropped.

    ``hint`` is a necessary condition that costs less than the pattern.
    """

    kind: str
    pattern: str
    least: int
    group: int = 0
    version: int = 1
    hint: str | None = None

    @property
    def name(self) -> str:
        return f"{self.kind}@{self.version}"


def either_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


#: Fixed values of the contract, in its order.
KEYWORDS = ["password", "passwd", "secret", "token", "api_?key"]
ASSIGN = "(" + "|".join(map(either_case, KEYWORDS)) + r""")["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = [
    Rule("assign", ASSIGN, least=8, group=2),
    Rule("access", "AKIA[A-Z0-9]+", least=16, hint="AKIA"),
    Rule("hex", "[0-9a-f]+", least=32),
]
#: What the scan looks for besides.
MORE = [
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----", least=0, hint="-----BEGIN "),
    Rule("forge", "gh[pousr]_[A-Za-z0-9]+", least=40, hint="gh"),
]
RULES = [*BASE, *MORE]

#: A text without a run that long has no kept match: a cheaper question to ask first.
_PROBES = {"hex": "[0-9a-f]{32}"}


def _spans(text: Column, rule: Rule) -> Column:
    """Kept matches of one rule as (kind, start, end), in code points.

    The text between the matches and the matches themselves add up to the text,
    so running lengths give the positions.
    """
    gaps = F.split(text, rule.pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0))
    groups = F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)) if rule.group else matches
    none = F.array().cast("array<struct<start: int, end: int, kept: boolean>>")
    walked = F.aggregate(
        F.arrays_zip(gaps.alias("gap"), matches.alias("match"), groups.alias("value")),
        F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda acc, x: F.struct(
            (acc["at"] + F.length(x["gap"]) + F.coalesce(F.length(x["match"]), F.lit(0))).alias("at"),
            F.when(
                F.length(x["value"]) >= rule.least,
                F.concat(
                    acc["out"],
                    F.array(
                        F.struct(
                            (acc["at"] + F.length(x["gap"])).alias("start"),
                            (acc["at"] + F.length(x["gap"]) + F.length(x["match"])).alias("end"),
                            F.lit(True).alias("kept"),
                        )
                    ),
                ),
            )
            .otherwise(acc["out"])
            .alias("out"),
        ),
        lambda acc: acc["out"],
    )
    return F.transform(
        walked, lambda s: F.struct(F.lit(rule.kind).alias("kind"), s["start"].alias("start"), s["end"].alias("end"))
    )


def _found(text: Column, rule: Rule, pending: Column) -> Column:
    none = F.array().cast("array<struct<kind: string, start: int, end: int>>")
    wanted = F.array_contains(pending, rule.name)
    if rule.hint:
        wanted = wanted & F.contains(text, F.lit(rule.hint))
    wanted = wanted & text.rlike(_PROBES.get(rule.kind, rule.pattern))
    return F.when(wanted, _spans(text, rule)).otherwise(none)


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """All entries; none where nothing was written yet."""
    place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    there = place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(place)
    if there:
        return spark.read.schema(ENTRY).parquet(path)
    return spark.range(0).select(*(F.lit(None).cast(f.dataType).alias(f.name) for f in StructType.fromDDL(ENTRY)))


def blob_id(text: Column) -> Column:
    """The address of a text; NULL counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def update_ledger(versions: DataFrame, ledger: str, text: str = "text", rules: list[Rule] = RULES) -> None:
    """Scan what no earlier run has scanned and append it. A blob's copies count once."""
    spark = versions.sparkSession
    blobs = versions.select(
        blob_id(F.col(text)).alias("blob_id"), F.coalesce(text, F.lit("")).alias("text")
    )
    # Copies of a hot text meet in their map tasks; a row for each blob and task is exchanged.
    blobs = blobs.groupBy("blob_id").agg(F.first("text").alias("text"))
    known = (
        read_ledger(spark, ledger)
        .select(F.col("blob_id").alias("__blob"), F.explode("scanned").alias("rule"))
        .groupBy("__blob")
        .agg(F.collect_set("rule").alias("done"))
    )
    wanted = F.array(*(F.lit(r.name) for r in rules))
    pending = (
        blobs.join(known, F.col("blob_id") == F.col("__blob"), "left")
        .withColumn("pending", F.array_except(wanted, F.coalesce("done", F.array().cast("array<string>"))))
        .where(F.size("pending") > 0)
    )
    found = F.concat(*(_found(F.col("text"), r, F.col("pending")) for r in rules))
    pending.select("blob_id", F.col("pending").alias("scanned"), found.alias("findings")).write.mode("append").parquet(
        ledger
    )


def findings(versions: DataFrame, ledger: str, text: str = "text", rules: list[Rule] = RULES) -> DataFrame:
    """``versions`` with their spans, an array of (kind, start, end) by start, then rule order.

    The join carries addresses, not texts. Every row is kept: NULL texts count
    as empty, repeated rows each get their blob's spans, an empty table gives
    none. A column called ``spans`` keeps its values as ``spans_``.
    """
    if "spans" in versions.columns:
        versions = versions.withColumnRenamed("spans", spare("spans_", versions.columns))
    order = F.array(*(F.lit(r.kind) for r in rules))
    names = [r.name for r in rules]
    ranked = F.transform(
        F.array_sort(
            F.transform(
                "spans",
                lambda s: F.struct(
                    s["start"].alias("start"), F.array_position(order, s["kind"]).alias("rank"),
                    s["end"].alias("end"), s["kind"].alias("kind"),
                ),
            )
        ),
        lambda s: F.struct(s["kind"].alias("kind"), s["start"].alias("start"), s["end"].alias("end")),
    )
    kinds = [r.kind for r in rules]
    hits = (
        read_ledger(versions.sparkSession, ledger)
        # Only entries of these rule versions; an entry of an older one stays in the ledger unread.
        .where(F.arrays_overlap("scanned", F.array(*(F.lit(n) for n in names))) & (F.size("findings") > 0))
        .select(F.col("blob_id").alias("__hit"), F.explode("findings").alias("s"), "scanned")
        .where(
            F.col("s.kind").isin(kinds)
            & reduce(lambda a, b: a | b, ((F.col("s.kind") == r.kind) & F.array_contains("scanned", r.name) for r in rules))
        )
        .groupBy("__hit")
        .agg(F.collect_set("s").alias("spans"))
        .select("__hit", ranked.alias("spans"))
    )
    joined = versions.withColumn("__blob", blob_id(F.col(text))).join(hits, F.col("__blob") == F.col("__hit"), "left")
    empty = F.array().cast("array<struct<kind: string, start: int, end: int>>")
    return joined.withColumn("spans", F.coalesce("spans", empty)).drop("__blob", "__hit")


def joined_spans(spans: Column) -> Column:
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ","
    )


def mask(text: Column, spans: Column, by: str = "[secret]") -> Column:
    """``text`` with each stretch that spans cover replaced by ``by``; NULL stays NULL."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        ahead = F.concat(acc["out"], F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(by))
        return F.struct(
            F.greatest(acc["at"], s["end"]).alias("at"),
            # A span that begins inside the one before belongs to the same stretch.
            F.when(s["start"] >= acc["at"], ahead).otherwise(acc["out"]).alias("out"),
        )

    masked = F.aggregate(
        spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))
    )
    return F.when(F.size(spans) > 0, masked).otherwise(text)
