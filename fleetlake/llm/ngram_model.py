"""Language model whose n-gram counts live in a log-frequency Bloom filter.

Every word is a word of its own, known by a 64-bit hash. Words and pairs of
neighbouring words are counted over all training rows. The key space is cut into
parts, as many as the training text asks for; a part holds the exact counts of
its words and a Bloom filter of its pairs, in which a pair counted c times has
the levels 1 to 1 + log2 c. Each filter is sized by the levels counted for it.

Nothing of the model goes through the driver or to every worker. Texts are
scored in batches: the distinct words and pairs of a batch are sent to the parts
they belong to, and counts and levels come back to the batch. A pair's count is
found by probing level after level until one is missing, and is smoothed towards
the frequency of its second word.

A frequent word is in every batch, so that every batch sends a row to its part.
Beyond ``FAN`` rows such a part is counted in lanes whose sums are added up, and
stands in several copies when texts are scored. Exchanges have at least as many
partitions as there are parts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import by_bytes, spare, stored
from fleetlake.llm.words import MULTIPLIER, mixed, split_words, word_hashes

#: Words among which ``classes`` looks for the most frequent.
HEAD = 65_536
PIECES, BITS_PER_ENTRY, PROBES = 64, 12, 6
#: Bytes of training text for each part of the model.
PART_BYTES = 10_000_000
#: Weight of the word frequencies, in tokens.
PRIOR = 200.0
BATCH_BYTES, BATCH_TOKENS = 4_000_000, 3_000_000
#: Rows of batches that meet in one group; a part that more batches know of is counted, and answers, in several.
FAN = 1024
#: No word holds a blank: these stand for the end of a text, its start, and words without a class of their own.
END, START, SHARED = b" ", b"  ", b"   "
#: Head words fall into buckets of counts this many to a doubling.
STEPS = 8


@dataclass
class Filter:
    """Levels of keys in ``PIECES`` stretches of ``width`` bits."""

    bits: np.ndarray
    width: int

    def holds(self, keys: np.ndarray, level: int) -> np.ndarray:
        found = np.ones(len(keys), bool)
        base = piece_of(keys) * self.width
        for at in positions(keys, level, self.width):
            at = base + at
            found &= (self.bits[at >> 3] >> (at & 7).astype(np.uint8) & 1).astype(bool)
        return found

    def levels(self, keys: np.ndarray) -> np.ndarray:
        level = np.zeros(len(keys), np.int64)
        alive = np.arange(len(keys))
        while len(alive):
            alive = alive[self.holds(keys[alive], int(level[alive[0]]) + 1)]
            level[alive] += 1
        return level

    def counts(self, keys: np.ndarray) -> np.ndarray:
        """About the count of each key: the middle of its level, 0 if no level is there."""
        return middle(self.levels(keys))


def middle(level: np.ndarray) -> np.ndarray:
    return np.where(level < 2, level, 1.5 * 2.0 ** (level - 1) - 0.5)


def built(keys: np.ndarray, counts: np.ndarray) -> Filter:
    top = np.floor(np.log2(counts) + 1e-9).astype(np.int64) + 1
    width = -(-int(top.sum()) * BITS_PER_ENTRY // (PIECES * 64)) * 64 + 64
    bits = np.zeros(PIECES * width, bool)
    base = piece_of(keys) * width
    for level in range(1, int(top.max(initial=0)) + 1):
        mine = top >= level
        for at in positions(keys[mine], level, width):
            bits[base[mine] + at] = True
    return Filter(np.packbits(bits, bitorder="little"), width)


def piece_of(keys: np.ndarray) -> np.ndarray:
    return (mixed(keys * MULTIPLIER) % np.uint64(PIECES)).astype(np.int64)


def positions(keys: np.ndarray, level: int, width: int) -> Iterator[np.ndarray]:
    """Places of one level of each key within its piece."""
    first = mixed(keys + np.full(1, level, np.uint64) * MULTIPLIER)
    second = mixed(first ^ MULTIPLIER) | np.uint64(1)
    for i in range(PROBES):
        spread = (first + np.uint64(i) * second) >> np.uint64(32)
        yield (spread * np.uint64(width) >> np.uint64(32)).astype(np.int64)


def packed(numbers: np.ndarray) -> bytes:
    """Numbers as their bytes, plane by plane, each compressed."""
    planes = numbers.astype(np.uint64).view(np.uint8).reshape(-1, 8).T
    used = (int(numbers.max(initial=0)).bit_length() + 7) // 8
    out = [len(numbers).to_bytes(8, "little"), bytes([used])]
    for plane in planes[:used]:
        data = pa.compress(plane.tobytes(), "zstd", asbytes=True)
        out += [len(data).to_bytes(4, "little"), data]
    return b"".join(out)


def unpacked(data: bytes) -> np.ndarray:
    n, used, at = int.from_bytes(data[:8], "little"), data[8], 9
    planes = np.zeros((n, 8), np.uint8)
    for i in range(used):
        size = int.from_bytes(data[at : at + 4], "little")
        plane = pa.decompress(data[at + 4 : at + 4 + size], n, "zstd", asbytes=True)
        planes[:, i] = np.frombuffer(plane, np.uint8)
        at += 4 + size
    return planes.reshape(-1).view(np.uint64)


def packed_set(ascending: np.ndarray) -> bytes:
    return packed(np.diff(ascending, prepend=np.uint64(0)))


def unpacked_set(data: bytes) -> np.ndarray:
    return np.cumsum(unpacked(data), dtype=np.uint64)


def _one(word: bytes) -> np.uint64:
    return word_hashes([word])[0]


def _tokens(texts: list[str]) -> np.ndarray:
    """Hashes of all tokens of a batch; each text ends with the end."""
    words: list[bytes] = []
    for text in texts:
        words += split_words(text)
        words.append(END)
    return word_hashes(words)


def _gathered(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[list[pa.RecordBatch], np.ndarray]]:
    """Rows with the tokens of their texts, about ``BATCH_TOKENS`` at a time."""
    rows: list[pa.RecordBatch] = []
    hashes: list[np.ndarray] = []
    for batch in by_bytes(batches, text, BATCH_BYTES):
        rows.append(batch)
        hashes.append(_tokens(batch.column(text).to_pylist()))
        if sum(map(len, hashes)) >= BATCH_TOKENS:
            yield rows, np.concatenate(hashes)
            rows, hashes = [], []
    if rows:
        yield rows, np.concatenate(hashes)


def _classed(hashes: np.ndarray, own: np.ndarray | None) -> np.ndarray:
    """The hashes of the words that count as themselves, one hash for all others."""
    if own is None:
        return hashes
    return np.where(np.isin(hashes, own) | (hashes == _one(END)), hashes, _one(SHARED))


def _before(tokens: np.ndarray, ends: np.ndarray, start) -> np.ndarray:
    """For each token the one before it; ``start`` at the start of a text."""
    out = np.empty_like(tokens)
    out[1:] = tokens[:-1]
    out[:1] = start
    out[ends[:-1] + 1] = start
    return out


def pair_keys(hashes: np.ndarray, own: np.ndarray | None = None) -> np.ndarray:
    """For each token a key of 48 bits for the word before it and itself."""
    ends = np.flatnonzero(hashes == _one(END))
    classes = _classed(hashes, own)
    return mixed(_before(classes, ends, _one(START)) * MULTIPLIER + classes) >> np.uint64(16)


def _bounds(ascending: np.ndarray, bits: int, parts: int) -> np.ndarray:
    """Where each part's keys, of so many bits, begin, and where the last end: a part is a range of the upper 32 bits."""
    of = (ascending >> np.uint64(bits - 32)) * np.uint64(parts) >> np.uint64(32)
    return np.searchsorted(of, np.arange(parts + 1).astype(np.uint64))


@dataclass
class Model:
    """A few totals; ``own`` only if classes were asked for."""

    parts: int
    tokens: int  # N
    distinct: int  # V
    texts: int
    own: np.ndarray | None = None  # hashes, sorted
    own_tokens: int = 0

    @property
    def classes(self) -> int:
        """Words that count as themselves, without the end."""
        return self.distinct - (self.texts > 0) if self.own is None else len(self.own)

    def values(self, hashes: np.ndarray, where: np.ndarray, counts: np.ndarray, seen: np.ndarray) -> np.ndarray:
        """log10 of each token's smoothed probability; ``where`` finds its word among ``hashes`` and ``counts``."""
        ends = np.flatnonzero(hashes[where] == _one(END))
        of_class, extra = counts, np.zeros(len(counts))
        if self.own is not None:
            tokens = self.tokens - self.own_tokens - self.texts
            distinct = max(0, self.distinct - len(self.own) - (self.texts > 0))
            shared = _classed(hashes, self.own) == _one(SHARED)
            of_class = np.where(shared, tokens, counts)
            extra = np.where(shared, np.log10((counts + 1) / (tokens + distinct + 1)), 0.0)
        after = of_class[where]
        context = _before(after, ends, self.texts)
        frequency = (after + 1) / (self.tokens + self.classes + 3)
        seen = np.minimum(seen, np.minimum(context, after))
        return np.log10((seen + PRIOR * frequency) / (context + PRIOR)) + extra[where]


def _word_counts(texts: DataFrame) -> DataFrame:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 0, BATCH_BYTES):
            words, n = np.unique(_tokens(batch.column(0).to_pylist()), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(words.view(np.int64)), pa.array(n)], ["word", "n"])

    return texts.mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n"))


def _head(counts: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent words, no more than ``limit``: whole buckets of counts, from the largest down."""
    bucket = F.floor(F.log2(F.col("n").cast("double")) * STEPS)
    sizes = {r.b: r.k for r in counts.groupBy(bucket.alias("b")).agg(F.count(F.lit(1)).alias("k")).collect()}
    least, taken = None, 0
    for b in sorted(sizes, reverse=True):
        taken += sizes[b]
        if taken > limit:
            break
        least = b
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    rows = counts.where(bucket >= least).toArrow()
    words, n = rows["word"].to_numpy().view(np.uint64), rows["n"].to_numpy()
    order = np.argsort(words)
    return words[order], n[order]


@dataclass
class Trained:
    model: Model
    parts: DataFrame  # part, words, counts, bits, width, batches


def train(
    docs: DataFrame, training: Column, text: str = "text", classes: int | None = None, head: int = HEAD
) -> Trained:
    """Count over all rows where ``training`` holds; NULL texts count as empty ones.

    ``classes`` makes a coarser model: only so many of the ``head`` most
    frequent words count as themselves, all others share one class.
    """
    texts = docs.where(training).select(F.coalesce(text, F.lit("")).alias("text"))
    parts = _parts_for(texts)
    own, own_tokens = None, 0
    if classes is not None:
        words, n = _head(stored(_word_counts(texts), "word-counts"), head)
        ranked = np.lexsort((words, -n))
        ranked = ranked[words[ranked] != _one(END)][:classes]
        own, own_tokens = np.sort(words[ranked]), int(n[ranked].sum())
    table = stored(_counted(texts, parts, own), "model-parts")
    sums = (F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("tokens", "distinct", "ends"))
    total = table.agg(*sums).first()
    model = Model(parts, total.tokens, total.distinct, total.ends, own, own_tokens)
    return Trained(model, table.drop("tokens", "distinct", "ends"))


def _parts_for(texts: DataFrame) -> int:
    size = texts.agg(F.sum(F.octet_length("text").cast("long") + 1)).first()[0] or 0
    return max(1, -(-size // PART_BYTES))


_COUNTS = "part long, lane long, batches long, words binary, word_counts binary, pairs binary, pair_counts binary"
_PART = "part long, words binary, counts binary, bits binary, width long, batches long, tokens long, distinct long, ends long"


def _arrow(rows: list[tuple], fields: str) -> pa.Table:
    kinds = {"long": pa.int64(), "binary": pa.binary()}
    schema = pa.schema([(f.split()[0], kinds[f.split()[1]]) for f in fields.split(", ")])
    columns = list(zip(*rows)) or [[] for _ in schema]
    return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _partitions(df: DataFrame, parts: int) -> int:
    """A partition for each part, however many the session asks for."""
    return max(parts, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def _counted(texts: DataFrame, parts: int, own: np.ndarray | None) -> DataFrame:
    """The parts of the model. A batch sends each part one row, its keys once each."""
    lanes = -(-parts // FAN)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lane = TaskContext.get().partitionId() % lanes
        for _, hashes in _gathered(batches, 0):
            words, n = np.unique(hashes, return_counts=True)
            pairs, m = np.unique(pair_keys(hashes, own), return_counts=True)
            w, p = _bounds(words, 64, parts), _bounds(pairs, 48, parts)
            sent = []
            for i in np.flatnonzero((w[1:] > w[:-1]) | (p[1:] > p[:-1])):
                a, b = slice(w[i], w[i + 1]), slice(p[i], p[i + 1])
                sent.append((int(i), lane, 1, packed_set(words[a]), packed(n[a]), packed_set(pairs[b]), packed(m[b])))
            yield from _arrow(sent, _COUNTS).to_batches()

    def summed(group: pa.Table, keys: str, counts: str) -> tuple[np.ndarray, np.ndarray]:
        every = np.concatenate([unpacked_set(x) for x in group[keys].to_pylist()])
        n = np.concatenate([unpacked(x) for x in group[counts].to_pylist()])
        unique, where = np.unique(every, return_inverse=True)
        return unique, np.bincount(where, weights=n, minlength=len(unique)).astype(np.int64)

    def add(group: pa.Table) -> pa.Table:
        words, n = summed(group, "words", "word_counts")
        pairs, m = summed(group, "pairs", "pair_counts")
        known = group["part"][0].as_py(), group["lane"][0].as_py(), sum(group["batches"].to_pylist())
        return _arrow([(*known, packed_set(words), packed(n), packed_set(pairs), packed(m))], _COUNTS)

    def build(group: pa.Table) -> pa.Table:
        words, n = summed(group, "words", "word_counts")
        levels = built(*summed(group, "pairs", "pair_counts"))
        ends = int(n[words == _one(END)].sum())
        row = (group["part"][0].as_py(), packed_set(words), packed(n), levels.bits.tobytes(), levels.width)
        return _arrow([(*row, sum(group["batches"].to_pylist()), int(n.sum()), len(n), ends)], _PART)

    sent, partitions = texts.mapInArrow(count, _COUNTS), _partitions(texts, parts)
    if lanes > 1:
        sent = sent.repartition(partitions, "part", "lane").groupBy("part", "lane").applyInArrow(add, _COUNTS)
    return sent.repartition(partitions, "part").groupBy("part").applyInArrow(build, _PART)


RESULTS = ("n_tokens", "n_known", "train_tokens", "base_score", "score")
_ASKED = "cell long, batch long, words binary, pairs binary, tokens binary, kept binary"


def score(
    docs: DataFrame, trained: Trained, text: str = "text", keep: list[str] | None = None, from_files: bool = False
) -> DataFrame:
    """``docs`` with n_tokens, n_known, train_tokens, base_score and score.

    NULL and empty texts are one token, the end. Every word of a text is
    scored. With an empty training set all counts are 0. Rows stay as they are,
    repeated ones too. Columns called like a result keep their values under the
    name with an underscore added. ``keep`` names the columns that stay. A text
    of any length is one row of one batch.

    Texts are stored first, so that a task that runs again after a loss cuts the
    same batches; ``from_files`` says that ``docs`` are rows of files as they
    were read, which come in the same order anyway.
    """
    model = trained.model
    parts = model.parts
    columns = docs.columns if keep is None else keep
    names = [spare(c + "_", docs.columns) if c in RESULTS else c for c in columns]
    taken = docs.select(*(docs[c].alias(n) for c, n in zip(columns, names)), F.coalesce(docs[text], F.lit("")).alias("__text"))
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in taken.schema.fields[:-1])
    if not from_files:
        taken = stored(taken, "scored-texts", "zstd")
    # A part that far more text asks than it was trained on, or far more batches, answers in several lanes.
    asking = _parts_for(taken.select(F.col("__text").alias("text")))
    least = -(-asking // (2 * parts))
    by_batches = F.ceil(F.col("batches") * F.lit(asking) / F.lit(parts * FAN)).cast("int")
    held = trained.parts.withColumn("lanes", F.greatest(F.lit(least), by_batches))
    # Four bytes for every 10 MB of training text.
    lanes = np.full(parts, least, np.int32)
    for r in held.where(F.col("lanes") > least).select("part", "lanes").collect():
        lanes[r.part] = r.lanes
    most = int(lanes.max())

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get().partitionId()
        for k, (rows, hashes) in enumerate(_gathered(batches, len(names))):
            words, where = np.unique(hashes, return_inverse=True)
            pairs = np.unique(pair_keys(hashes, model.own))
            # Known by what it holds, so that answers to a batch that was cut otherwise cannot be mixed up with it.
            batch = xxhash.xxh3_64_intdigest(hashes.tobytes(), seed=task << 32 | k) >> 2
            w, p = _bounds(words, 64, parts), _bounds(pairs, 48, parts)
            sent = []
            for i in np.flatnonzero((w[1:] > w[:-1]) | (p[1:] > p[:-1])):
                keys = packed_set(words[w[i] : w[i + 1]]), packed_set(pairs[p[i] : p[i + 1]])
                sent.append((int(i) * most + batch % int(lanes[i]), batch, *keys, None, None))
            table = pa.Table.from_batches(rows).select(list(range(len(names))))
            table = table.append_column("__none", pa.nulls(table.num_rows))
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(table)
            # Passes the parts by, as a cell of its own.
            own = packed_set(words), None, packed(where), sink.getvalue().to_pybytes()
            yield from _arrow([*sent, (parts * most + batch, batch, *own)], _ASKED).to_batches()

    def answer(asked: pa.Table, part: pa.Table) -> pa.Table:
        held = part.to_pylist()
        if held:
            words, counts = unpacked_set(held[0]["words"]), unpacked(held[0]["counts"])
            levels = Filter(np.frombuffer(held[0]["bits"], np.uint8), held[0]["width"])
        out = []
        for row in asked.to_pylist():
            if row["kept"] is None:
                mine, pairs = unpacked_set(row["words"]), unpacked_set(row["pairs"])
                n, level = np.zeros(len(mine), np.uint64), np.zeros(len(pairs), np.int64)
                if held:
                    level = levels.levels(pairs)
                    if len(words):
                        at = np.minimum(np.searchsorted(words, mine), len(words) - 1)
                        n = np.where(words[at] == mine, counts[at], np.uint64(0))
                row |= {"words": packed(n), "pairs": packed(level)}
            out.append(tuple(row[c.split()[0]] for c in _ASKED.split(", ")))
        return _arrow(out, _ASKED)

    def finish(group: pa.Table) -> pa.Table:
        *answers, own = sorted(group.to_pylist(), key=lambda r: r["cell"])
        if own["kept"] is None or not answers:
            raise RuntimeError("a batch of texts was cut anew while its words were looked up: from_files does not hold")
        hashes, where = unpacked_set(own["words"]), unpacked(own["tokens"]).astype(np.int64)
        counts = np.concatenate([unpacked(r["words"]) for r in answers]).astype(np.int64)
        tokens = hashes[where]
        pairs, of = np.unique(pair_keys(tokens, model.own), return_inverse=True)
        seen = middle(np.concatenate([unpacked(r["pairs"]) for r in answers]).astype(np.int64))
        if len(counts) != len(hashes) or len(seen) != len(pairs):
            raise RuntimeError("a batch of texts was cut anew while its words were looked up: from_files does not hold")
        ends = np.flatnonzero(tokens == _one(END))
        starts = np.concatenate([[0], ends[:-1] + 1])
        base = np.log10((counts + 1) / (model.tokens + model.distinct + 1))
        table = pa.ipc.open_stream(own["kept"]).read_all().drop_columns(["__none"])
        results = (
            np.diff(np.concatenate([starts, [len(tokens)]])),
            np.add.reduceat((counts > 0)[where].astype(np.int64), starts),
            np.full(len(starts), model.tokens),
            np.add.reduceat(base[where], starts),
            np.add.reduceat(model.values(hashes, where, counts, seen[of]), starts),
        )
        for name, values in zip(RESULTS, results):
            table = table.append_column(name, pa.array(values))
        return table

    each = held.withColumn("lane", F.explode(F.sequence(F.lit(0), F.col("lanes") - 1)))
    cells = each.select((F.col("part") * most + F.col("lane")).alias("cell"), "words", "counts", "bits", "width")
    partitions = _partitions(docs, max(parts, asking))
    asked = taken.mapInArrow(ask, _ASKED).repartition(partitions, "cell").groupBy("cell")
    answered = asked.cogroup(cells.repartition(partitions, "cell").groupBy("cell")).applyInArrow(answer, _ASKED)
    schema = f"{kept}n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return answered.repartition(partitions, "batch").groupBy("batch").applyInArrow(finish, schema)
