"""Nearest neighbours by inner product, with an adaptive scan of the dimensions.

Vectors are rotated at random and belong to the list of their nearest centroid.
A query probes the lists whose centroids have the largest inner products with
it. Within a list the rotated vectors are read in blocks of columns. After each
block the squared distance so far, scaled to all columns, estimates the whole
distance, and a candidate is abandoned when the hypothesis that it still beats
the query's threshold is rejected. What is left is scored exactly on the
original vectors.

Equal vectors are one class; a class can put at most k + 1 ids before all its
others, so no more are needed. Lists are packed into parts of bounded size, and
the queries of a part into blocks, so no group grows with the table.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fleetlake.llm.common import stored

#: The index is fitted on about so many classes; lists number about the root of the classes, and no more than LISTS.
SAMPLE, LISTS, ROUNDS = 16_384, 1024, 8
#: Sampled queries that decide how many lists are probed, and the share of their neighbours the probes must reach.
TRIALS, REACHED = 256, 0.97
#: Sampled vectors that give each query its first threshold, at the rank THRESHOLD * (k + 1) among them.
SEEDS, THRESHOLD = 4096, 3
#: Columns of a block, and how many deviations a rejected hypothesis is off.
BLOCK, DEVIATIONS = 16, 2.1
#: Vectors of a part and queries of a block.
PART_ROWS, BLOCK_ROWS = 8192, 4096


def usable(vector: Column) -> Column:
    """Not NULL or zero, every component a finite number."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


@dataclass
class Index:
    rotation: np.ndarray
    centroids: np.ndarray
    probes: int
    seeds: np.ndarray
    parts: list[tuple[int, int]] | None = None  # the first part of each list, and how many it has
    sizes: np.ndarray | None = None  # classes of each list


def fit(sample: np.ndarray, total: int, k: int, seed: int = 5) -> Index:
    """Rotation, centroids and number of probes from a bounded sample."""
    rng = np.random.default_rng(seed)
    dims = sample.shape[1]
    rotation = np.linalg.qr(rng.normal(size=(dims, dims)))[0]
    lists = int(max(1, min(LISTS, total**0.5, len(sample) // 8)))
    centroids = sample[rng.choice(len(sample), lists, replace=False)]
    for _ in range(ROUNDS):
        home = assign(sample, centroids)
        sums = np.zeros_like(centroids)
        np.add.at(sums, home, sample)
        count = np.bincount(home, minlength=lists)
        centroids = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centroids)
    home = assign(sample, centroids)
    trials = sample[rng.choice(len(sample), min(TRIALS, len(sample)), replace=False)]
    near = np.argsort(-(trials @ sample.T), axis=1)[:, : k + 1]
    place = np.argsort(np.argsort(-(trials @ centroids.T), axis=1), axis=1)
    needed = np.sort(np.take_along_axis(place, home[near], axis=1).ravel())
    probes = int(needed[int(np.ceil(REACHED * len(needed))) - 1]) + 1
    return Index(rotation, centroids, probes, sample[rng.permutation(len(sample))[:SEEDS]])


def assign(vectors: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    return (vectors @ centroids.T - (centroids**2).sum(axis=1) / 2).argmax(axis=1)


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def nearest(
    vectors: DataFrame, queries: Column, k: int = 20, id_column: str = "vec_id", vector_column: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: the ``k`` nearest found of each row where ``queries`` holds.

    The score is the inner product in double precision; ties go to the smaller
    id. A query's own row is no candidate. Rows with a NULL id, or a vector that
    is NULL, empty, zero, holds a NULL or non-finite component or has not the
    most frequent length (of equally frequent ones the greatest), take no part.
    Repeated rows count once; different vectors of one id are rows of their own,
    as candidates and as queries.
    With ``k`` candidates or fewer all are returned. An empty table gives no
    rows. Other columns of ``vectors`` are not read.
    """
    spark = vectors.sparkSession
    schema = "query_id long, rank int, vec_id long, score double"
    marked = vectors.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"), queries.alias("asks")
    ).where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    lengths = marked.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("c")).orderBy(F.desc("c"), F.desc("n")).first()
    if lengths is None:
        return spark.createDataFrame([], schema)
    rows = stored(
        marked.where(F.size("v") == lengths.n).groupBy("vec_id", "v").agg(F.bool_or("asks").alias("asks")),
        "vectors",
    )
    # Classes are numbered in the order of their least ids. Only a class's k + 1 least ids can matter, and they are cut before the exchange.
    first = F.row_number().over(W.partitionBy("v").orderBy("vec_id"))
    classes = stored(
        rows.select("vec_id", "v")
        .withColumn("n", first)
        .where(F.col("n") <= k + 1)
        .groupBy("v")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
        .orderBy(F.element_at("ids", 1), "v")
        .withColumn("class", F.monotonically_increasing_id()),
        "vector-classes",
    )
    asking = rows.where("asks").select(F.col("vec_id").alias("query_id"), "v")
    asked = stored(asking.join(classes.select("v", "class"), "v").select("query_id", "class"), "queries")
    total = classes.count()
    parts = 1 << 20
    spread = F.pmod(F.xxhash64("class"), F.lit(parts))
    sample = classes.where(spread < min(parts, parts * SAMPLE // total + 1)).select("class", "v").toArrow()
    order = np.argsort(sample["class"].to_numpy())
    sampled = _matrix(sample["v"].combine_chunks())[order]
    if not len(sampled):  # a very small table may miss a hash below the share; any class will do then
        sampled = _matrix(classes.limit(1).select("v").toArrow()["v"].combine_chunks())
    index = fit(sampled, total, k)

    def listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            home = assign(_matrix(batch.column(0)), index.centroids) if batch.num_rows else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(home.astype(np.int32))], ["v", "ids", "class", "list"]
            )

    placed = stored(classes.select("v", "ids", "class").mapInArrow(listed, "v array<double>, ids array<long>, class long, list int"), "lists")
    sizes = np.zeros(len(index.centroids), np.int64)
    for row in placed.groupBy("list").count().collect():  # no more rows than lists
        sizes[row.list] = row["count"]
    index.sizes, index.parts = sizes, _packed(sizes)

    asks = asked.select("class").distinct().join(classes.select("class", "v"), "class")
    probing = stored(asks.select("class", "v").mapInArrow(_probe(index, k), "part int, class long, v array<double>, lists array<int>, least double"), "probes")
    # A row for each part; Spark broadcasts them while they prove few.
    blocks = probing.groupBy("part").agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks"))
    parted = placed.select("v", "class", "list").mapInArrow(_part(index), "part int, v array<double>, class long, list int")
    table = parted.join(blocks, "part").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    block = F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")
    asking = probing.join(blocks, "part").withColumn("block", block)
    found = (
        table.drop("blocks")
        .groupBy("part", "block")
        .cogroup(asking.drop("blocks").groupBy("part", "block"))
        .applyInArrow(_searcher(index, k), "query long, class long, score double")
    )
    # Best classes first, then their ids.
    best = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "class"))
    hits = found.withColumn("n", best).where(F.col("n") <= k + 1).drop("n")
    ids = hits.join(classes.select("class", "ids"), "class").select("query", "score", "class", F.explode("ids").alias("vec_id"))
    ranked = F.row_number().over(W.partitionBy("query").orderBy(F.desc("score"), "vec_id", "class"))
    answers = (
        ids.withColumn("n", ranked)
        .where(F.col("n") <= k + 1)
        .groupBy("query")
        .agg(F.sort_array(F.collect_list(F.struct("n", "vec_id", "score", F.col("class").alias("of")))).alias("hits"))
    )
    own = F.slice(F.filter("hits", lambda h: (h["vec_id"] != F.col("query_id")) | (h["of"] != F.col("class"))), 1, k)
    return (
        asked.join(answers.withColumnRenamed("query", "class"), "class")
        .select("query_id", F.posexplode(own).alias("at", "hit"))
        .select("query_id", (F.col("at") + 1).alias("rank"), "hit.vec_id", "hit.score")
    )


def _packed(sizes: np.ndarray) -> list[tuple[int, int]]:
    """Neighbouring lists share a part; a list too large for one has several to itself. (first, how many) of each."""
    out, part, room = [], 0, PART_ROWS
    for size in sizes.tolist():
        if size > PART_ROWS:
            n = -(-size // PART_ROWS)
            start = part + (room < PART_ROWS)
            out.append((start, n))
            part, room = start + n, PART_ROWS
            continue
        if size > room:
            part, room = part + 1, PART_ROWS
        out.append((part, 1))
        room -= size
    return out


def _probe(index: Index, k: int):
    """For each query and part: the lists to probe there, and the query's first threshold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], [], []]
            if batch.num_rows:
                vectors = _matrix(batch.column(1))
                order = np.argsort(-(vectors @ index.centroids.T), axis=1, kind="stable")
                # Enough lists for k + 1 classes even where lists are small.
                enough = (np.cumsum(index.sizes[order], axis=1) < k + 1).sum(axis=1) + 1
                rank = THRESHOLD * (k + 1)
                near = vectors @ index.seeds.T
                least = -np.partition(-near, rank - 1, axis=1)[:, rank - 1] if near.shape[1] >= rank else np.full(len(near), -np.inf)
                for i, query in enumerate(batch.column(0).to_pylist()):
                    by_part: dict[int, list[int]] = {}
                    for at in order[i, : max(index.probes, enough[i])].tolist():
                        first, several = index.parts[at]
                        for part in range(first, first + several):
                            by_part.setdefault(part, []).append(at)
                    for part, lists in by_part.items():
                        for column, value in zip(out, (part, query, vectors[i], lists, float(least[i]))):
                            column.append(value)
            types = [pa.int32(), pa.int64(), pa.list_(pa.float64()), pa.list_(pa.int32()), pa.float64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(out, types)], ["part", "class", "v", "lists", "least"]
            )

    return run


def _part(index: Index):
    """The part of each vector; a list with several deals them out by class."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = np.array(index.parts, np.int64)
        for batch in batches:
            first, several = places[batch.column(2).to_numpy()].T
            part = first + batch.column(1).to_numpy() % several
            yield pa.RecordBatch.from_arrays([pa.array(part.astype(np.int32)), *batch.columns], ["part", "v", "class", "list"])

    return run


def _searcher(index: Index, k: int):
    def search(table: pa.Table, probing: pa.Table) -> pa.Table:
        hits: list[tuple[int, int, float]] = []
        if table.num_rows and probing.num_rows:
            vectors, queries = (_matrix(t["v"].combine_chunks()) for t in (table, probing))
            names, home = table["class"].to_numpy(), table["list"].to_numpy()
            order = np.argsort(home, kind="stable")
            heaps: list[list[tuple[float, int]]] = [[] for _ in range(len(queries))]
            least = probing["least"].to_numpy().copy()
            asking: dict[int, list[int]] = {}
            for i, lists in enumerate(probing["lists"].to_pylist()):
                for at in lists:
                    asking.setdefault(at, []).append(i)
            turned = (vectors @ index.rotation, queries @ index.rotation)
            starts = np.searchsorted(home[order], np.arange(len(index.centroids) + 1))
            for at, those in asking.items():
                mine = order[starts[at] : starts[at + 1]]
                if len(mine):
                    _scan(np.array(those), mine, queries, vectors, turned, names, heaps, least, k)
            for query, heap in zip(probing["class"].to_pylist(), heaps):
                hits += [(query, -name, score) for score, name in heap]
        columns = zip(*hits) if hits else ([], [], [])
        return pa.table(
            [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.float64()))], names=["query", "class", "score"]
        )

    return search


def _scan(those, mine, queries, vectors, turned, names, heaps, least, k) -> None:
    """One list against the queries that probe it; survivors go to the queries' heaps of k + 1."""
    data, asked = turned[0][mine], turned[1][those]
    dims = data.shape[1]
    # The square of the distance at which a candidate just reaches the threshold.
    lengths = (asked**2).sum(axis=1)[:, None] + (data**2).sum(axis=1)
    limit = lengths - 2 * least[those][:, None]
    a, b = asked[:, :BLOCK], data[:, :BLOCK]
    far = (a**2).sum(axis=1)[:, None] + (b**2).sum(axis=1) - 2 * (a @ b.T)
    seen = min(BLOCK, dims)
    i, j = np.nonzero(_kept(far, seen, dims, limit))
    far, limit = far[i, j], limit[i, j]
    while seen < dims and len(i):
        step = slice(seen, min(dims, seen + BLOCK))
        far = far + ((asked[i, step] - data[j, step]) ** 2).sum(axis=1)
        seen = step.stop
        keep = _kept(far, seen, dims, limit)
        i, j, far, limit = i[keep], j[keep], far[keep], limit[keep]
    scores = (queries[those[i]] * vectors[mine[j]]).sum(axis=1)
    for query, name, score in zip(those[i].tolist(), names[mine[j]].tolist(), scores.tolist()):
        heap = heaps[query]
        if len(heap) <= k:
            heapq.heappush(heap, (score, -name))
        elif (score, -name) > heap[0]:
            heapq.heapreplace(heap, (score, -name))
        if len(heap) > k and heap[0][0] > least[query]:
            least[query] = heap[0][0]


def _kept(far: np.ndarray, seen: int, dims: int, limit: np.ndarray) -> np.ndarray:
    """Where the hypothesis that the whole distance is within the limit still stands; rounding decides nothing."""
    slack = (1 + DEVIATIONS / np.sqrt(seen)) ** 2 if seen < dims else 1 + 1e-9
    return far * (dims / seen) <= np.maximum(limit, 0) * slack + 1e-9
