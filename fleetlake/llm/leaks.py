"""Benchmark decontamination: SimHash of item-sized windows, and a multi-index over the items' fingerprints.

A document's windows have as many words as an item. Only windows that share a
shingle with some item of that size can be similar to one, so only those get a
fingerprint. The fingerprint's bytes are looked up in the index: if two
fingerprints differ in at most ``RADIUS`` bits, some byte differs in at most
RADIUS / 8, so the bytes within that of an item's find every such pair. What
is found is checked by the similarity of the weighted shingles.

Items are taken in blocks of bounded size, each block in one pass over the
documents.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import by_bytes, spare, stored
from fleetlake.llm.words import shingles, word_hashes
from fleetlake.session import scratch_path

SIZE, SIMILARITY = 5, 0.8
#: At similarity 0.8 about 10 of 64 bits differ, with a deviation of 3: this is more than four deviations off.
RADIUS = 23
#: Bytes of items in a block; pairs of windows and items looked at together; windows with a fingerprint at a time.
BLOCK_BYTES, TOGETHER, WINDOWS = 1_000_000, 4_000_000, 4096
BATCH_BYTES = 4_000_000

#: Blanks and ASCII punctuation part words; all else is in them.
_PARTED = bytes(0x20 if b < 128 and not chr(b).isalnum() else b for b in range(256))
_ONES = np.array([bin(b).count("1") for b in range(256)], np.uint8)
_NEAR = _ONES[np.arange(256)[:, None] ^ np.arange(256)] <= RADIUS // 8


def normal_words(text: str) -> list[bytes]:
    """Lower-case words without ASCII punctuation."""
    return text.lower().encode().translate(_PARTED).split()


def fingerprints(items: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """SimHash of each run of ``count`` shingle hashes, as eight bytes; a shingle weighs as often as it occurs."""
    bits = np.unpackbits(items.view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32) * 2 - 1
    sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(bits, axis=0, dtype=np.int32)])
    return np.packbits(sums[starts + count] >= sums[starts], axis=1)


def similarity(a: Counter, b: Counter) -> float:
    """Shared weight over all weight, a shingle weighing as often as it occurs."""
    shared = sum((a & b).values())
    return shared / max(1, sum(a.values()) + sum(b.values()) - shared)


class Items:
    """The items of one size: fingerprints, index and weights."""

    def __init__(self, size: int, members: list[tuple[object, list[bytes]]]):
        self.ids = [i for i, _ in members]
        self.shingle = min(SIZE, size)
        self.count = size - self.shingle + 1
        hashed = [shingles(word_hashes(w), self.shingle) for _, w in members]
        self.prints = np.concatenate([fingerprints(h, np.zeros(1, np.int64), self.count) for h in hashed])
        self.weights = [Counter(h.tolist()) for h in hashed]
        self.known = np.unique(np.concatenate(hashed))
        # For each byte of a fingerprint and each value: which items have a near byte there.
        self.index = np.stack([_NEAR[:, self.prints[:, b]] for b in range(8)])

    def candidates(self, prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All (window, item) whose fingerprints differ in at most ``RADIUS`` bits."""
        out = []
        step = max(1, TOGETHER // max(1, len(self.ids)))
        for i in range(0, len(prints), step):
            part = prints[i : i + step]
            found = reduce(np.logical_or, (self.index[b][part[:, b]] for b in range(8)))
            window, item = np.nonzero(found)
            far = _ONES[part[window] ^ self.prints[item]].sum(axis=1)
            near = far <= RADIUS
            out.append((window[near] + i, item[near]))
        return tuple(np.concatenate(c) for c in zip(*out)) if out else (np.zeros(0, int),) * 2

    def hits(self, items: np.ndarray, starts: np.ndarray, count: int) -> Iterator[tuple[int, float, int]]:
        """(item, similarity, start) of windows of ``count`` shingles that are similar enough."""
        # Windows next to one another share their sums; a gap starts afresh.
        gaps = np.flatnonzero(np.diff(starts) > count) + 1
        for run in np.split(starts, gaps):
            for i in range(0, len(run), WINDOWS):
                part = run[i : i + WINDOWS]
                region = items[part[0] : part[-1] + count]
                for window, item in zip(*self.candidates(fingerprints(region, part - part[0], count))):
                    start = int(part[window])
                    alike = similarity(Counter(items[start : start + count].tolist()), self.weights[item])
                    if alike >= SIMILARITY:
                        yield int(item), alike, start


class Block:
    """Some items, by their number of words."""

    def __init__(self, members: list[tuple[object, str]]):
        by_size: dict[int, list[tuple[object, list[bytes]]]] = {}
        for item_id, text in members:
            if words := normal_words(text):
                by_size.setdefault(len(words), []).append((item_id, words))
        self.groups = {size: Items(size, group) for size, group in sorted(by_size.items())}
        #: For each length of shingles, the known ones and the sizes of the items that have each.
        self.known: dict[int, tuple[np.ndarray, list[list[int]]]] = {}
        for length in {g.shingle for g in self.groups.values()}:
            sizes: dict[int, list[int]] = {}
            for size, g in self.groups.items():
                if g.shingle == length:
                    for h in g.known.tolist():
                        sizes.setdefault(h, []).append(size)
            order = sorted(sizes)
            self.known[length] = (np.array(order, np.uint64), [sizes[h] for h in order])

    def search(self, texts: list[str]) -> Iterator[tuple[int, object, float, int, int]]:
        """(text, item id, similarity, first word, words) of the best window for each item a text holds."""
        words, cuts = [], [0]
        for text in texts:
            words += normal_words(text)
            cuts.append(len(words))
        hashes, bounds = word_hashes(words), np.array(cuts)
        anchors: dict[tuple[int, int], list[int]] = {}
        for length, (known, sizes) in self.known.items():
            for doc, at, which in self._shared(hashes, bounds, length, known):
                for size in sizes[which]:
                    anchors.setdefault((doc, size), []).append(at)
        best: dict[tuple[int, int, int], tuple[float, int, int]] = {}
        for (doc, size), places in sorted(anchors.items()):
            group, n = self.groups[size], cuts[doc + 1] - cuts[doc]
            items = shingles(hashes[cuts[doc] : cuts[doc + 1]], group.shingle)
            # A text shorter than the item is one window.
            count = min(group.count, len(items))
            at = np.array(places)
            starts = np.unique(np.concatenate([at - d for d in range(count)]))
            starts = starts[(starts >= 0) & (starts + count <= len(items))]
            for item, alike, start in group.hits(items, starts, count):
                key = (doc, size, item)
                if key not in best or (alike, -start) > (best[key][0], -best[key][1]):
                    best[key] = (alike, start, min(size, n))
        for (doc, size, item), (alike, start, n) in sorted(best.items()):
            yield doc, self.groups[size].ids[item], alike, start, n

    @staticmethod
    def _shared(hashes: np.ndarray, bounds: np.ndarray, length: int, known: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(text, place, which known shingle) of all known shingles within texts."""
        sizes = np.diff(bounds)
        if len(hashes) >= length:
            runs = shingles(hashes, length)
            mask = np.uint64((1 << 20) - 1)
            table = np.zeros(1 << 20, bool)
            table[(known & mask).astype(np.int64)] = True
            at = np.flatnonzero(table[(runs & mask).astype(np.int64)])
            which = np.minimum(np.searchsorted(known, runs[at]), len(known) - 1)
            fits = known[which] == runs[at]
            at, which = at[fits], which[fits]
            doc = np.searchsorted(bounds, at, side="right") - 1
            inside = at + length <= bounds[doc + 1]
            yield from zip(doc[inside].tolist(), (at - bounds[doc])[inside].tolist(), which[inside].tolist())


def find_leaks(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """doc_id, item_id, similarity, start_word, n_words: the items that documents hold, with the best window.

    A window of as many words as the item leaks it if their weighted five-word
    shingles are similar to 0.8 or more; of equally similar windows the first
    counts. A text of fewer words than the item is one window. Items of fewer
    than five words are one shingle. NULL, empty and wordless texts hold and are
    nothing. Each row of ``docs`` has its own result, also if repeated; repeated
    items count once, different texts of one id are different items. An empty
    table on either side gives no rows. Other columns are not read. Long texts
    are searched whole, each in one task.
    """
    kinds = [f.schema[c].dataType.simpleString() for f, c in ((docs, doc_id), (items, item_id))]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, similarity double, start_word int, n_words int"
    taken = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(text, F.lit("")).alias("text"))
    return _by_blocks(taken, items, item_id, text, schema, _search)


def _by_blocks(docs: DataFrame, items: DataFrame, item_id: str, text: str, schema: str, search: Callable) -> DataFrame:
    """What ``search`` finds in ``docs`` for each block of items.

    One block is searched when the result is asked for. Of several, each is
    searched and its findings are written before the next is fetched, so that
    neither the driver nor the plan grows with the items.
    """
    spark = docs.sparkSession
    usable, blocks = _item_blocks(items, item_id, text)
    if blocks == 0:
        return spark.createDataFrame([], schema)
    if blocks == 1:
        return docs.mapInArrow(search(_block(usable, item_id, text, blocks, 0)), schema)
    path = scratch_path(spark, "leaks")
    for b in range(blocks):
        docs.mapInArrow(search(_block(usable, item_id, text, blocks, b)), schema).write.mode("append").parquet(path)
    return spark.read.schema(schema).parquet(path)


def drop_leaks(docs: DataFrame, items: DataFrame, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that ``find_leaks`` finds nothing in, with all their columns.

    With one block of items there is no exchange. With several the documents
    are written once with a number for each row, and those that any block finds
    are taken out.
    """
    usable, blocks = _item_blocks(items, item_id, text)
    if blocks == 0:
        return docs
    if blocks == 1:
        at = docs.columns.index(text)
        members = _block(usable, item_id, text, blocks, 0)

        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            block = Block(members)
            for batch in by_bytes(batches, at, BATCH_BYTES):
                found = {hit[0] for hit in block.search([t or "" for t in batch.column(at).to_pylist()])}
                yield batch.take(pa.array([i for i in range(batch.num_rows) if i not in found], pa.int64()))

        return docs.mapInArrow(clean, docs.schema)
    row = spare("__row", docs.columns)
    kept = stored(docs.withColumn(row, F.monotonically_increasing_id()), "leak-rows")
    found = find_leaks(kept, items, row, item_id, text).select(F.col("doc_id").alias(row)).distinct()
    return kept.join(found, row, "left_anti").select(*docs.columns)


def _item_blocks(items: DataFrame, item_id: str, text: str) -> tuple[DataFrame, int]:
    """Distinct items with a text, and how many blocks of about ``BLOCK_BYTES`` they make."""
    usable = items.where(F.col(text).isNotNull()).select(item_id, text).distinct()
    size = usable.agg(F.sum(F.octet_length(text))).first()[0] or 0
    return usable, -(-size // BLOCK_BYTES)


def _block(usable: DataFrame, item_id: str, text: str, blocks: int, b: int) -> list[tuple[object, str]]:
    mine = usable.where(F.pmod(F.xxhash64(item_id, text), F.lit(blocks)) == b)
    return sorted(((r[0], r[1]) for r in mine.collect()), key=str)


def _search(members: list[tuple[object, str]]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block(members)
        for batch in by_bytes(batches, 1, BATCH_BYTES):
            found = list(block.search(batch.column(1).to_pylist()))
            rows, ids, alike, starts, words = zip(*found) if found else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())), pa.array(ids, pa.int64()) if not ids or isinstance(ids[0], int) else pa.array(ids),
                    pa.array(alike, pa.float64()), pa.array(starts, pa.int32()), pa.array(words, pa.int32()),
                ],
                ["doc_id", "item_id", "similarity", "start_word", "n_words"],
            )

    return run
