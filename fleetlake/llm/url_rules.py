"""URL filter: a sort-merge range join of canonical keys with prefix rules.

A rule (host, path) becomes a key, its host's labels in reverse order and then
its path, and so stands for the interval of all keys that begin with it. A url
has one key for each of its host's suffixes that may equal a rule's host. Keys
and rules are cut at common boundaries, sorted, and swept once; a stack holds
the rules whose interval is open. Intervals of prefixes nest, so the top of the
stack is the longest rule for a key.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import ascii_lower, spare

#: Keys sampled for each bucket boundary; buckets for each partition; keys in a partition.
SAMPLED, BUCKETS, KEYS = 64, 4, 2_000_000
#: Parts over which urls without a host are dealt.
SPREAD = 4096

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def url_host(url: Column) -> Column:
    return F.coalesce(ascii_lower(F.regexp_extract(url, URL, 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def _reversed(host: Column) -> Column:
    return F.array_join(F.reverse(F.split(host, r"\.", -1)), ".")


def judge_urls(urls: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """``urls`` with host, path, rule and verdict.

    ``rules`` has host, path and verdict. A rule fits its host and all hosts
    below it if the path starts with the rule's; of those that fit, the one
    with the longest string (host and path) wins, of two verdicts for one rule
    ``block``. Without a rule the verdict is ``default``.

    A NULL url, or one without ``://``, has an empty host and path and fits no
    rule. Repeated rows are all judged. Rules with a NULL in any column are no
    rules. Columns of ``urls`` that are called like a result keep their values
    under the name with an underscore added.
    """
    results = ("host", "path", "rule", "verdict")
    for name in results:
        if name in urls.columns:
            urls = urls.withColumnRenamed(name, spare(name + "_", urls.columns))
            url = spare(name + "_", []) if url == name else url
    judged = urls.withColumns({"host": url_host(F.col(url)), "path": url_path(F.col(url))})
    # Equal (host, path) meet before anything is sorted: a hot url counts once.
    places = judged.where("host <> ''").select("host", "path").distinct()
    found = _range_join(places, rules).select(
        F.col("host").alias("__host"), F.col("path").alias("__path"), "rule", "verdict"
    )
    # Urls without a host have no rule to meet and are spread out.
    nowhere = F.when(F.col("host") == "", F.pmod(F.monotonically_increasing_id(), F.lit(SPREAD)) + 1).otherwise(0)
    same = (F.col("host") == F.col("__host")) & (F.col("path") == F.col("__path")) & (F.col("__spread") == F.col("__nowhere"))
    joined = judged.withColumn("__spread", nowhere).join(found.withColumn("__nowhere", F.lit(0).cast("long")), same, "left")
    return joined.drop("__host", "__path", "__spread", "__nowhere").withColumn("verdict", F.coalesce("verdict", F.lit(default)))


def _range_join(places: DataFrame, rules: DataFrame) -> DataFrame:
    """host, path, rule, verdict for those places that a rule fits."""
    spark = places.sparkSession
    rules = (
        rules.select("host", "path", "verdict")
        .where("host IS NOT NULL AND path IS NOT NULL AND verdict IS NOT NULL")
        .groupBy("host", "path")
        .agg(F.when(F.bool_or(F.col("verdict") == "block"), "block").otherwise(F.max("verdict")).alias("verdict"))
    )
    labels = F.size(F.split("host", r"\.", -1))
    deepest = rules.agg(F.max(labels)).first()[0]
    if deepest is None:
        return places.withColumns({"rule": F.lit(None).cast("string"), "verdict": F.lit(None).cast("string")}).limit(0)
    rule_keys = rules.select(
        F.concat(_reversed(F.col("host")), "path").alias("key"), F.concat("host", "path").alias("rule"), "verdict"
    )
    # A suffix of more labels than the deepest rule's host cannot equal a rule's host.
    parts = F.reverse(F.split("host", r"\.", -1))
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(parts), F.lit(deepest))),
        lambda n: F.array_join(F.slice(parts, F.lit(1), n), "."),
    )
    url_keys = places.select("host", "path", F.explode(suffixes).alias("suffix")).select(
        F.concat("suffix", "path").alias("key"), "host", "path", F.xxhash64("host").alias("spread")
    )

    total = url_keys.count()
    partitions = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // KEYS))
    splitters = _splitters(url_keys, total, partitions * BUCKETS)
    null = F.lit(None).cast("string")
    rows = url_keys.select("key", "host", "path", null.alias("rule"), null.alias("verdict"), "spread").unionByName(
        rule_keys.select("key", null.alias("host"), null.alias("path"), "rule", "verdict", F.lit(0).cast("long").alias("spread"))
    )
    placed = rows.mapInArrow(_place(splitters), "bucket int, " + _ddl(rows))
    swept = (
        placed.repartition(partitions, "bucket")
        .sortWithinPartitions("bucket", "key", F.col("rule").isNull())
        .mapInArrow(_sweep, "host string, path string, rule string, verdict string")
    )
    best = F.max_by(F.struct("rule", "verdict"), F.struct(F.length("rule"), F.col("rule")))
    return swept.groupBy("host", "path").agg(best.alias("best")).select("host", "path", "best.rule", "best.verdict")


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in df.dtypes)


def _splitters(keys: DataFrame, total: int, buckets: int) -> list[tuple[str, int]]:
    """At most ``buckets - 1`` keys, with a hash of the host, that part a sample of ``SAMPLED`` a bucket evenly.

    Many hosts may share a key, a rule's host with a common path: the hash parts those.
    """
    wanted = SAMPLED * buckets
    if not total:
        return []
    sample = keys.select("key", "spread").sample(min(1.0, wanted / total), seed=7).limit(2 * wanted)
    sample = sorted((row.key, row.spread) for row in sample.collect())
    return sorted({sample[len(sample) * i // buckets] for i in range(1, buckets)}) if sample else []


def _place(splitters: list[tuple[str, int]]):
    """Give each url key its bucket, and each rule every bucket its interval meets."""
    least = -(2**63)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, buckets = [], []
            keys, rules, spreads = (batch.column(i).to_pylist() for i in (0, 3, 5))
            for i, (key, rule, spread) in enumerate(zip(keys, rules, spreads)):
                first = last = bisect_right(splitters, (key, spread if rule is None else least - 1))
                if rule is not None:
                    # The splitters from here on that begin with the key lie inside its interval.
                    while last < len(splitters) and splitters[last][0].startswith(key):
                        last += 1
                for bucket in range(first, last + 1):
                    rows.append(i)
                    buckets.append(bucket)
            taken = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(buckets, pa.int32()), *taken.columns], ["bucket", *taken.schema.names]
            )

    return place


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Walk sorted keys and rules; the open rules of a bucket are on a stack."""
    stack: list[tuple[str, str, str]] = []
    at = None
    for batch in batches:
        out: list[list] = [[], [], [], []]
        for bucket, key, host, path, rule, verdict, _ in zip(*(c.to_pylist() for c in batch.columns)):
            if bucket != at:
                at, stack = bucket, []
            while stack and not key.startswith(stack[-1][0]):
                stack.pop()
            if rule is not None:
                stack.append((key, rule, verdict))
            elif stack:
                for column, value in zip(out, (host, path, *stack[-1][1:])):
                    column.append(value)
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in out], ["host", "path", "rule", "verdict"])
