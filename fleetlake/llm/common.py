"""Small helpers that several text operators share."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetlake.session import scratch_path

#: The letters A-Z as bytes and what they become.
LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
UPPER_LETTERS, LOWER_LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, UPPER_LETTERS, LOWER_LETTERS)


def id_hash(doc_id: Column, divisor: int) -> Column:
    """crc32 of the id as text, modulo ``divisor``; NULL for a NULL id."""
    return F.crc32(doc_id.cast("string")) % divisor


def stored(df: DataFrame, name: str, codec: str = "snappy", row_group: int | None = None) -> DataFrame:
    """Write to a fresh folder below the shared one and read it back.

    Cuts the lineage: later passes read files, and rows numbered on the way
    keep their numbers when an executor is lost. ``row_group`` bounds the bytes
    a task holds while it writes.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write.option("parquet.block.size", row_group) if row_group else df.write
    writer.parquet(path, compression=codec)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spare(name: str, taken: list[str]) -> str:
    """``name``, lengthened until it clashes with no column of the input."""
    while name.lower() in {c.lower() for c in taken}:
        name += "_"
    return name


def carried(docs: DataFrame, columns: list[str], names: list[str], text: str) -> tuple[DataFrame, int]:
    """``columns`` under ``names``, and the place of the text: that of its own column, which is not sent twice, or one more."""
    kept = [docs[c].alias(n) for c, n in zip(columns, names)]
    if text in columns and docs.schema[text].dataType.simpleString() == "string":
        return docs.select(*kept), columns.index(text)
    return docs.select(*kept, docs[text].alias("__text")), len(names)


def by_bytes(batches: Iterator[pa.RecordBatch], text: int, limit: int) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that each holds about ``limit`` bytes of column ``text``."""
    for batch in batches:
        column = batch.column(text)
        if column.type != pa.string():
            column = column.cast(pa.string())
        size = 0
        start = 0
        for i, n in enumerate(pa.compute.binary_length(column).to_pylist()):
            size += n or 0
            if size >= limit:
                yield batch.slice(start, i + 1 - start)
                start, size = i + 1, 0
        if start < batch.num_rows:
            yield batch.slice(start)
    # A worker that waits for its next task holds no memory of this one.
    pa.default_memory_pool().release_unused()
