"""Near copies by circulant MinHash, with links confirmed on the full shingle sets.

Two permutations make the whole signature: one scatters a shingle's place, the
other, shifted round by k, gives coordinate k, the least value over the set.
Bands of coordinates put documents into buckets. In a bucket, signatures that
agree in too few coordinates for the wanted similarity are told apart. What
remains similar forms clusters, and within a cluster the full sets decide.

Documents with equal sets are one class from the start, known by the hashes of
its set. Buckets and clusters are cut into blocks of bounded size, and every
pair of blocks is a group of its own; a group reports no more links than join
its documents, so neither rows nor memory grow with the square of a group.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import by_bytes, spare, stored
from fleetlake.llm.components import components, stars
from fleetlake.llm.words import MULTIPLIER, mixed, shingles, split_words, word_hashes

#: Bands of rows: a pair of similarity 0.85 misses all with a chance of 8e-7, one of 0.8 with 7e-5.
BANDS, ROWS = 24, 5
COORDINATES = BANDS * ROWS
#: Places that shingles are permuted among.
PLACES = 1 << 20
#: Coordinates that must agree, below the expected number by so many deviations.
DEVIATIONS = 5.6
#: Documents of a block, and shingles of a cluster's.
BUCKET_BLOCK, CLUSTER_BLOCK, CLUSTER_SHINGLES = 1024, 512, 1_000_000
#: Index entries looked at together.
TOGETHER = 1_000_000
BATCH_BYTES = 4_000_000
#: What a task is to compare, about.
TASK_BYTES = 64_000_000


@lru_cache(maxsize=1)
def _permutations() -> tuple[np.ndarray, np.ndarray]:
    """The scattering permutation, and the shifted ones as rows that overlap: row p holds pi(p), pi(p + 1), ..."""
    rng = np.random.default_rng(41)
    sigma = rng.permutation(PLACES).astype(np.uint32)
    pi = rng.permutation(PLACES).astype(np.uint32)
    ring = np.concatenate([pi, pi[: COORDINATES - 1]])
    return sigma, np.lib.stride_tricks.sliding_window_view(ring, COORDINATES)


def signature(items: np.ndarray) -> np.ndarray:
    """All coordinates of a nonempty set of hashes."""
    sigma, shifted = _permutations()
    places = sigma[(items % np.uint64(PLACES)).astype(np.int64)]
    out = np.full(COORDINATES, PLACES, np.uint32)
    for i in range(0, len(places), 4096):
        np.minimum(out, shifted[places[i : i + 4096]].min(axis=0), out=out)
    return out


def shingle_set(text: str, size: int) -> np.ndarray:
    """Hashes of the distinct shingles, sorted."""
    return np.unique(shingles(word_hashes(split_words(text)), size))


def _digest(items: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(items.tobytes())


def least_agreeing(similarity: float) -> int:
    """Coordinates, of a byte each, that a pair of this similarity agrees in but for a chance of about 1e-7."""
    p = similarity + (1 - similarity) / 256
    return int(COORDINATES * p - DEVIATIONS * (COORDINATES * p * (1 - p)) ** 0.5)


def near_copies(
    docs: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text"
) -> DataFrame:
    """One row for each row of ``docs``: the id, text_key, n_shingles, component_id, kept, keeper.

    Words are runs of non-blank characters in lower case (A-Z), shingles are
    ``size`` of them; a text of fewer words has one shingle, one without words
    (NULL, empty) has none and is linked with nothing. Two texts are linked if
    100 times the shared shingles reach ``percent`` times all of theirs. A
    component is known by its least id; kept is true where that is the row's
    own. Repeated rows share their component. A row with a NULL id belongs to
    its text's component but is never kept, and a component of such rows alone
    has a NULL id. ``text_key`` is a hash of the text. ``keeper`` marks one id
    and text of each component, the least id's if any has one, and every row
    without words. Other columns are not read, whatever their names.
    """
    taken = docs.select(
        F.col(id_column).alias("doc_id"), text_key(F.col(text_column)).alias("text_key"), F.coalesce(text_column, F.lit("")).alias("text")
    )

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 2, BATCH_BYTES):
            n, keys, signed = [], [], []
            for text in batch.column(2).to_pylist():
                items = shingle_set(text, size)
                n.append(len(items))
                keys.append(_digest(items) if len(items) else None)
                signed.append(signature(items).tobytes() if len(items) else None)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(n, pa.int64()), pa.array(keys, pa.binary()), pa.array(signed, pa.binary())],
                ["doc_id", "text_key", "n_shingles", "set_key", "signature"],
            )

    kind = docs.schema[id_column].dataType.simpleString()
    rows = stored(
        taken.mapInArrow(sign, f"doc_id {kind}, text_key binary, n_shingles long, set_key binary, signature binary"), "signatures"
    )
    # Classes of equal sets get numbers, written once so that they hold.
    classes = stored(
        rows.where("set_key IS NOT NULL")
        .groupBy("set_key")
        .agg(
            # The least id, NULL last, with its text.
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "text_key")).alias("first"),
            F.first("n_shingles").alias("n"), F.first("signature").alias("signature"),
        )
        .withColumn("class", F.monotonically_increasing_id()),
        "classes",
    )
    clusters = stored(components(_alike(classes, percent)), "clusters")
    linked = components(_confirmed(taken, classes, clusters, size, percent))
    named = classes.select("class", "set_key", "first").join(linked.withColumnRenamed("node", "class"), "class", "left")
    named = named.withColumn("component", F.coalesce("component", "class"))
    # One row for each component, however many documents it has.
    firsts = named.groupBy("component").agg(F.min("first").alias("chosen"))
    by_set = named.join(firsts, "component").select("set_key", "chosen")
    out = rows.drop("signature").join(by_set, "set_key", "left")
    alone = F.col("set_key").isNull()
    own = F.when(alone, F.col("doc_id")).otherwise(F.col("chosen.doc_id"))
    same = F.col("doc_id").eqNullSafe(F.col("chosen.doc_id")) & (F.col("text_key") == F.col("chosen.text_key"))
    return out.select(
        F.col("doc_id").alias(id_column), "text_key", "n_shingles", own.alias("component_id"),
        F.coalesce(own == F.col("doc_id"), F.lit(False)).alias("kept"), (alone | same).alias("keeper"),
    )


def drop_near_copies(docs: DataFrame, size: int = 5, percent: int = 80, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """``docs`` with one document of each component; rows that repeat an id and text are one document."""
    name = spare("__document", docs.columns)

    def document(key: Column) -> Column:
        return F.unhex(F.md5(F.concat_ws("/", F.hex(key), F.col(id_column).cast("string"))))

    judged = near_copies(docs, size, percent, id_column, text_column)
    keepers = judged.where("keeper").select(document(F.col("text_key")).alias(name)).distinct()
    # Repeated rows meet in their map tasks; the join needs no exchange of texts besides.
    single = docs.withColumn(name, document(text_key(F.col(text_column)))).dropDuplicates([name])
    return single.join(keepers, name, "left_semi").drop(name)


def text_key(text: Column) -> Column:
    """A hash that tells texts apart; NULL counts as empty."""
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _blocks(df: DataFrame, group: str, key: str, blocks: Column) -> DataFrame:
    """Rows of groups of two and more, once for each pair of blocks (i, j), i <= j, that their block is part of."""
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("__n"), F.ceil(blocks).cast("int").alias("__k")).where("__n > 1")
    joined = df.join(sizes, group)
    mine = F.pmod(F.xxhash64(key, F.lit(9)), F.col("__k")).cast("int")
    others = F.transform(
        F.sequence(F.lit(0), F.col("__k") - 1),
        lambda x: F.struct(F.least(x, F.col("__mine")).alias("i"), F.greatest(x, F.col("__mine")).alias("j")),
    )
    return joined.withColumn("__mine", mine).withColumn("__pair", F.explode(others)).drop("__n", "__k")


def _grouped(df: DataFrame, group: str, size: int) -> DataFrame:
    """Groups together and in order within partitions; the exchange is by group and pair of blocks.

    ``size`` is that of all rows in bytes, from which the number of partitions follows.
    """
    pair = F.xxhash64(group, "__pair").alias("pair")
    keyed = df.withColumn("__at", pair)
    n = max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // TASK_BYTES))
    return keyed.repartition(n, "__at").sortWithinPartitions("__at", group).drop("__pair", "__mine")


def _runs(batches: Iterator[pa.RecordBatch], key: int) -> Iterator[pa.Table]:
    """Whole groups of a sorted stream, as many at a time as a batch completes."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy()
        if held and held[-1].column(key)[-1].as_py() != values[0]:
            yield pa.Table.from_batches(held)
            held = []
        others = np.flatnonzero(values != values[-1])
        last = int(others[-1]) + 1 if len(others) else 0
        if last:
            yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = []
        held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held)


def _alike(classes: DataFrame, percent: int) -> DataFrame:
    """Links a, b that join what shares a bucket and agrees in enough coordinates."""
    needed = least_agreeing(percent / 100)

    def bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            signed = np.frombuffer(b"".join(batch.column(2).to_pylist()), np.uint32).reshape(-1, BANDS, ROWS)
            keys = np.broadcast_to(np.arange(BANDS, dtype=np.uint64), signed.shape[:2])
            for row in range(ROWS):
                keys = mixed(keys * MULTIPLIER + signed[:, :, row])
            small = (signed.reshape(len(signed), COORDINATES) & 0xFF).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), batch.column(1), pa.array([r.tobytes() for r in small], pa.binary()),
                    pa.array(keys.view(np.int64).tolist(), pa.list_(pa.int64())),
                ],
                ["class", "n", "small", "keys"],
            )

    signed = stored(
        classes.select("class", "n", "signature").mapInArrow(bands, "class long, n long, small binary, keys array<long>"), "bands"
    )
    # Only keys are exploded and counted; what shares a bucket is joined with its signature after that.
    members = signed.select("class", F.explode("keys").alias("bucket"))
    shared = stored(_blocks(members, "bucket", "class", F.count(F.lit(1)) / BUCKET_BLOCK), "buckets")
    rows = shared.join(signed.select("class", "n", "small"), "class")
    blocks = _grouped(rows, "bucket", shared.count() * (COORDINATES + 32)).select("__at", "class", "n", "small")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, 0):
            at, names, n = (table[c].to_numpy() for c in ("__at", "class", "n"))
            small = np.frombuffer(b"".join(table["small"].to_pylist()), np.uint8).reshape(-1, COORDINATES)
            label = np.arange(len(at))
            out: list[np.ndarray] = []
            step = 1
            i = np.arange(len(at) - 1)
            # Each row against the next, the next but one, and so on, while any group is that long.
            while len(i := i[i + step < len(at)]) and len(i := i[at[i] == at[i + step]]):
                j = i + step
                fits = (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])) & (label[i] != label[j])
                a, b = i[fits], j[fits]
                for s in range(0, len(a), 4096):
                    x, y = a[s : s + 4096], b[s : s + 4096]
                    agree = (small[x] == small[y]).sum(axis=1) >= needed
                    if agree.any():
                        out.append(np.stack([names[x[agree]], names[y[agree]]]))
                        np.minimum.at(label, y[agree], label[x[agree]])
                step += 1
            pairs = np.concatenate(out, axis=1) if out else np.zeros((2, 0), np.int64)
            # Buckets of a group name the same least members again and again: few links are left of many.
            yield pa.RecordBatch.from_arrays([pa.array(side) for side in stars(*pairs)], ["a", "b"])

    return blocks.mapInArrow(compare, "a long, b long").distinct()


def _confirmed(taken: DataFrame, classes: DataFrame, clusters: DataFrame, size: int, percent: int) -> DataFrame:
    """Links a, b that join what is linked by full sets, found within clusters."""
    # One text for each class in a cluster: the one whose key the class has kept.
    wanted = clusters.join(classes.select("class", F.col("first.text_key").alias("text_key"), "n"), clusters.node == F.col("class")).select(
        "class", F.col("component").alias("cluster"), "text_key", "n"
    )
    # Copies of a hot text meet in their map tasks, so the one exchange of texts holds few of them.
    texts = taken.groupBy("text_key").agg(F.first("text").alias("text")).join(wanted, "text_key")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, 3, BATCH_BYTES):
            items = [shingle_set(t, size).tobytes() for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(items, pa.binary())], ["class", "cluster", "n", "items"])

    full = stored(
        texts.select("class", "cluster", "n", "text").mapInArrow(sets, "class long, cluster long, n long, items binary"), "shingle-sets"
    )
    number = F.greatest(F.count(F.lit(1)) / CLUSTER_BLOCK, F.sum("n") / CLUSTER_SHINGLES)
    # Each set goes out once for each block of its cluster.
    sent = full.groupBy("cluster").agg((F.sum("n") * 8 * F.ceil(number)).alias("size")).agg(F.sum("size")).first()[0] or 0
    blocks = _grouped(_blocks(full, "cluster", "class", number), "cluster", int(sent)).select("__at", "class", "items")

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _runs(batches, 0):
            at, names, items = table["__at"].to_numpy(), table["class"].to_numpy(), table["items"]
            cuts = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1], [True]]))
            pairs: list[tuple[int, int]] = []
            for start, end in zip(cuts[:-1].tolist(), cuts[1:].tolist()):
                group = [np.frombuffer(b, np.uint64) for b in items.slice(start, end - start).to_pylist()]
                pairs += [(int(names[start + i]), int(names[start + j])) for i, j in linked_pairs(group, percent)]
            found = np.array(pairs, np.int64).reshape(-1, 2)
            yield pa.RecordBatch.from_arrays([pa.array(side) for side in stars(found[:, 0], found[:, 1])], ["a", "b"])

    return blocks.mapInArrow(confirm, "a long, b long").distinct()


def linked_pairs(group: list[np.ndarray], percent: int) -> list[tuple[int, int]]:
    """Links that join all that is linked within a group of sets, none that closes a ring.

    An inverted index from shingles to earlier sets counts what each set shares
    with all of them at once.
    """
    sizes = np.array([len(g) for g in group])
    joined = np.concatenate(group)
    owner = np.repeat(np.arange(len(group)), sizes)
    order = np.argsort(joined, kind="stable")
    joined, owner = joined[order], owner[order]
    starts = np.flatnonzero(np.concatenate([[True], joined[1:] != joined[:-1]]))
    lengths = np.diff(np.concatenate([starts, [len(joined)]]))
    # A shingle of one set alone counts for nothing.
    kept = lengths > 1
    firsts, lengths = starts[kept], lengths[kept]
    values = joined[firsts]
    label = np.arange(len(group))
    out = []
    for i in range(1, len(group)):
        at = np.searchsorted(values, group[i])
        at, items = at[at < len(values)], group[i][at < len(values)]
        mine = at[values[at] == items]
        shared = np.zeros(len(group), np.int64)
        for part in np.array_split(mine, 1 + int(lengths[mine].sum()) // TOGETHER):
            begin, many = firsts[part], lengths[part]
            steps = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
            shared += np.bincount(owner[np.repeat(begin, many) + steps], minlength=len(group))
        shared = shared[:i]
        union = sizes[:i] + sizes[i] - shared
        for j in np.flatnonzero((100 * shared >= percent * union) & (shared > 0)).tolist():
            if label[j] != label[i]:
                out.append((j, i))
                label[label == label[i]] = label[j]
    return out
