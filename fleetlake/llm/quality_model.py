"""Quality classifier: ridge regression on random Fourier features of document statistics.

The features approximate a Gaussian kernel over standardised statistics of the
whole text. Every partition of the training rows sums its part of the normal
equations, fold by fold; the driver adds up the few sums and solves them. Each
fold is scored by the solution of the others, and those scores and labels give
an isotonic calibration to probabilities.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import by_bytes, carried, spare, stored

FEATURES, FOLDS, RIDGE = 256, 5, 1e-3
#: The training sample, in rows on average.
SAMPLE = 20_000
THRESHOLD = 0.3
BATCH_BYTES = 4_000_000

_CLASSES = np.zeros(256, np.int64)
_CLASSES[ord("a") : ord("z") + 1] = 1
_CLASSES[ord("A") : ord("Z") + 1] = 2
_CLASSES[ord("0") : ord("9") + 1] = 3
_CLASSES[[0x20, 9, 11, 12]] = 4
_CLASSES[[10, 13]] = 5
_CLASSES[[ord(c) for c in ".,;:"]] = 6
_CLASSES[[ord(c) for c in "'\"()-?"]] = 7
_CLASSES[ord("!")] = 8
_CLASSES[[ord(c) for c in "|<>{}[]\\/_=+~^`"]] = 9
_CLASSES[[ord(c) for c in "#$%&*@"]] = 10
_CLASSES[128:] = 11
CLASSES = 12
STATISTICS = CLASSES + 10


def statistics(text: str) -> np.ndarray:
    """Shares of byte classes, and shapes of words, lines and repetition, of a whole text."""
    raw = text.encode()
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    n = max(1, len(raw))
    words = raw.split()
    lines = [x for x in raw.split(b"\n") if x]
    lengths = np.fromiter(map(len, words), np.int64, len(words)) if words else np.zeros(1, np.int64)
    share = counts[counts > 0] / n
    pairs = len(words) - 1
    return np.concatenate(
        [
            np.sqrt(np.bincount(_CLASSES, counts, CLASSES) / n),
            [
                np.log1p(len(raw)),
                lengths.mean(),
                lengths.std(),
                np.log1p(lengths.max()),
                len(set(words)) / max(1, len(words)),
                len(set(zip(words, words[1:]))) / pairs if pairs > 0 else 1.0,
                len(set(lines)) / max(1, len(lines)),
                np.log1p(len(lines)),
                -(share * np.log(share)).sum(),
                sum(w[-1:] in b".,;:" for w in words) / max(1, len(words)),
            ],
        ]
    )


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    frequencies: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray  # raw scores, and the probabilities they are calibrated to
    levels: np.ndarray

    def features(self, x: np.ndarray) -> np.ndarray:
        return fourier((x - self.mean) / self.scale, self.frequencies, self.phases)

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.interp(self.features(x) @ self.weights, self.knots, self.levels)


def fourier(z: np.ndarray, frequencies: np.ndarray, phases: np.ndarray) -> np.ndarray:
    """cos(zW + b), and a constant. Beyond eight deviations a statistic counts as eight."""
    waves = np.cos(np.clip(z, -8, 8) @ frequencies + phases) * np.sqrt(2 / len(phases))
    return np.concatenate([waves, np.ones((len(z), 1))], axis=1)


def isotonic(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the rising fit of ``y`` to ``x``: pool neighbours that fall, then join the blocks' middles."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []  # sum of x, sum of y, rows
    for a, b in zip(x[order], y[order]):
        blocks.append([a, b, 1.0])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][2] >= blocks[-1][1] * blocks[-2][2]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    sums = np.array(blocks)
    return sums[:, 0] / sums[:, 2], np.clip(sums[:, 1] / sums[:, 2], 0, 1)


def _with_statistics(df: DataFrame, text: str, others: list[str]) -> DataFrame:
    taken = df.select(*others, F.coalesce(text, F.lit("")).alias("__text"))
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in taken.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, len(others), BATCH_BYTES):
            x = [statistics(t).tolist() for t in batch.column(len(others)).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(x, pa.list_(pa.float64()))], [*others, "statistics"]
            )

    return taken.mapInArrow(run, f"{kept}statistics array<double>")


def train(
    docs: DataFrame, labels: DataFrame, training: Column, text: str = "text", label: str = "quality", sample: int = SAMPLE
) -> Model | None:
    """Fit on about ``sample`` labelled rows of ``training`` ids, chosen by a hash of the id; None without rows.

    ``labels`` has doc_id and ``label``; rows with a NULL id or a label other
    than 0 and 1 are none. Several labels of a document are several rows.
    """
    chosen = labels.where(training & F.col("doc_id").isNotNull() & F.col(label).isin(0, 1)).select(
        "doc_id", F.col(label).cast("int").alias("label")
    )
    total = chosen.count()
    if not total:
        return None
    parts = 1 << 20
    spread = F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(parts))
    mine = spread < min(parts, parts * sample // total + 1)
    # The same test on both sides: no text outside the sample is read further or moved.
    rows = docs.where(F.col("doc_id").isNotNull() & mine).select("doc_id", text).join(chosen.where(mine), "doc_id")
    folds = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(FOLDS)).cast("int")
    described = _with_statistics(rows.withColumn("fold", folds), text, ["doc_id", "fold", "label"])
    # The share holds on average; the limit binds only if one id repeats very often. It moves no texts.
    known = stored(described.limit(4 * sample), "quality-rows")
    moments = known.select(F.posexplode("statistics").alias("i", "v")).groupBy("i").agg(F.avg("v").alias("m"), F.stddev_pop("v").alias("s")).collect()
    if not moments:
        return None
    moments.sort(key=lambda r: r.i)
    mean = np.array([r.m for r in moments])
    scale = np.array([r.s or 1.0 for r in moments])
    rng = np.random.default_rng(17)
    # Statistics are of unit size, so squared distances grow with their number.
    frequencies = rng.normal(0, 1.0 / np.sqrt(STATISTICS), (STATISTICS, FEATURES))
    phases = rng.uniform(0, 2 * np.pi, FEATURES)
    model = Model(mean, scale, frequencies, phases, np.zeros(FEATURES + 1), np.zeros(1), np.zeros(1))
    gram, right, weight = _normal_equations(known, model)
    solve = lambda g, r, n: np.linalg.solve(g + RIDGE * max(n, 1.0) * np.eye(len(g)), r)
    model.weights = solve(gram.sum(axis=0), right.sum(axis=0), weight.sum())
    apart = np.stack([solve(gram.sum(axis=0) - g, right.sum(axis=0) - r, weight.sum() - n) for g, r, n in zip(gram, right, weight)])
    scored = _out_of_fold(known, model, apart)
    model.knots, model.levels = isotonic(scored[:, 0], scored[:, 1])
    return model


def _normal_equations(known: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """By fold: the sums of zz', of zy and of rows, each partition's part first."""
    size = FEATURES + 1

    def part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((FOLDS, size, size + 2))
        for batch in batches:
            x = np.array(batch.column(2).to_pylist())
            z, y, fold = model.features(x), batch.column(1).to_numpy(), batch.column(0).to_numpy()
            for k in np.unique(fold):
                at = fold == k
                sums[k, :, :size] += z[at].T @ z[at]
                sums[k, :, size] += z[at].T @ y[at]
                sums[k, 0, size + 1] += at.sum()
        used = [k for k in range(FOLDS) if sums[k, 0, size + 1]]
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array([sums[k].tobytes() for k in used], pa.binary())], ["fold", "sums"]
        )

    # The sample is small: few partitions keep what reaches the driver to a few matrices.
    parts = known.select("fold", "label", "statistics").repartition(FOLDS, "fold").mapInArrow(part, "fold int, sums binary")
    total = np.zeros((FOLDS, size, size + 2))
    for row in parts.toLocalIterator():
        total[row.fold] += np.frombuffer(row.sums).reshape(size, size + 2)
    return total[:, :, :size], total[:, :, size], total[:, 0, size + 1]


def _out_of_fold(known: DataFrame, model: Model, weights: np.ndarray) -> np.ndarray:
    """Raw score and label of every sampled row, by the weights its fold had no part in; in a fixed order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                z = model.features(np.array(batch.column(2).to_pylist()))
                raw = (z * weights[batch.column(0).to_numpy()]).sum(axis=1)
                yield pa.RecordBatch.from_arrays([pa.array(raw, pa.float64()), batch.column(1)], ["raw", "label"])

    rows = known.select("fold", "label", "statistics").mapInArrow(run, "raw double, label int").collect()
    return np.array(sorted((r.raw, float(r.label)) for r in rows))


def score(docs: DataFrame, model: Model | None, text: str = "text", keep: list[str] | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` with score, the probability of label 1, and predicted, 1 from ``threshold`` on.

    NULL and empty texts are scored by the statistics of an empty text, long
    texts by those of all their bytes. Where nothing was learned every score is
    1. Rows stay as they are, repeated ones too. Columns called like a result
    keep their values under the name with an underscore added. ``keep`` names
    the columns that stay.
    """
    columns = docs.columns if keep is None else keep
    names = [spare(c + "_", docs.columns) if c in ("score", "predicted") else c for c in columns]
    taken, place = carried(docs, columns, names, text)
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in taken.schema.fields[: len(names)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, place, BATCH_BYTES):
            scores = np.ones(batch.num_rows)
            if model is not None and batch.num_rows:
                scores = model.score(np.stack([statistics(t or "") for t in batch.column(place).to_pylist()]))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], pa.array(scores, pa.float64()), pa.array((scores >= threshold).astype(np.int32))],
                [*names, "score", "predicted"],
            )

    return taken.mapInArrow(run, f"{kept}score double, predicted int")
