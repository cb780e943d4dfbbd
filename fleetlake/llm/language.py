"""Language identification with a convolutional network over bytes, trained here in numpy.

A text is lower-cased and cut into windows of fixed length that overlap by the
widest filter less one byte. Filters of several widths slide over a window, the
largest response of each filter is kept, and a softmax layer gives the window's
languages. A text's languages are the mean over its windows, weighted by their
bytes.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from fleetlake.llm.common import by_bytes, spare

WINDOW = 128
WIDTHS = (2, 3, 4)
FILTERS = 12
#: Windows that go through the network together: few enough to stay in a core's cache.
TOGETHER = 48
#: The training sample: at most so many texts of a language, windows of a text, and texts in all.
PER_LANGUAGE, PER_TEXT, TEXTS = 600, 6, 60_000
#: Texts more, so that a language's share of the hashes does not miss all of it by chance.
LEAST = 16
EPOCHS, MINIBATCH, RATE = 12, 64, 0.01
BATCH_BYTES = 4_000_000
UNKNOWN = "und"


def windows_of(text: str) -> tuple[np.ndarray, np.ndarray]:
    """All windows of a text, padded with zeros, and how many bytes each has."""
    raw = np.frombuffer(text.lower().encode(), np.uint8)
    step = WINDOW - max(WIDTHS) + 1
    starts = np.arange(0, max(1, len(raw) - max(WIDTHS) + 1), step)
    padded = np.zeros(starts[-1] + WINDOW, np.uint8)
    padded[: len(raw)] = raw
    view = np.lib.stride_tricks.sliding_window_view(padded, WINDOW)[starts]
    return view, np.minimum(WINDOW, len(raw) - starts)


@dataclass
class Network:
    """One table a width and position: what each byte there adds to each filter."""

    languages: list[str]
    tables: dict[int, np.ndarray]  # width -> (width, 256, FILTERS)
    bias: np.ndarray
    out: np.ndarray
    out_bias: np.ndarray

    @classmethod
    def fresh(cls, languages: list[str], rng: np.random.Generator) -> Network:
        features = len(WIDTHS) * FILTERS
        return cls(
            languages,
            {w: rng.normal(0, 0.3, (w, 256, FILTERS)).astype(np.float32) for w in WIDTHS},
            np.zeros(features, np.float32),
            rng.normal(0, 0.1, (features, len(languages))).astype(np.float32),
            np.zeros(len(languages), np.float32),
        )

    def responses(self, x: np.ndarray, width: int) -> np.ndarray:
        """Each filter of a width at each place: (windows, places, FILTERS)."""
        places = WINDOW - width + 1
        total = np.take(self.tables[width][0], x[:, :places], axis=0)
        for j in range(1, width):
            total += np.take(self.tables[width][j], x[:, j : j + places], axis=0)
        return total

    def pooled(self, x: np.ndarray) -> np.ndarray:
        best = np.concatenate([self.responses(x, w).max(axis=1) for w in WIDTHS], axis=1)
        return np.maximum(best + self.bias, 0)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        return softmax(np.concatenate([self.pooled(x[i : i + TOGETHER]) for i in range(0, len(x), TOGETHER)]) @ self.out + self.out_bias)


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


class Adam:
    """Step sizes by running moments, for one array."""

    def __init__(self, like: np.ndarray):
        self.m, self.v, self.t = np.zeros_like(like), np.zeros_like(like), 0

    def step(self, param: np.ndarray, grad: np.ndarray) -> None:
        self.t += 1
        self.m += 0.1 * (grad - self.m)
        self.v += 0.001 * (grad * grad - self.v)
        param -= RATE * (self.m / (1 - 0.9**self.t)) / (np.sqrt(self.v / (1 - 0.999**self.t)) + 1e-8)


def fit(x: np.ndarray, y: np.ndarray, languages: list[str], seed: int = 11) -> Network:
    """Train on windows ``x`` of languages ``y``; languages weigh the same whatever their number of windows."""
    rng = np.random.default_rng(seed)
    net = Network.fresh(languages, rng)
    share = np.bincount(y, minlength=len(languages))
    weight = (len(y) / (len(languages) * np.maximum(share, 1)))[y].astype(np.float32)
    params = [*net.tables.values(), net.bias, net.out, net.out_bias]
    steps = [Adam(p) for p in params]
    for _ in range(EPOCHS):
        order = rng.permutation(len(x))
        for at in range(0, len(x), MINIBATCH):
            rows = order[at : at + MINIBATCH]
            for adam, param, grad in zip(steps, params, _gradients(net, x[rows], y[rows], weight[rows])):
                adam.step(param, grad)
    return net


def _gradients(net: Network, x: np.ndarray, y: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    responses = {w: net.responses(x, w) for w in WIDTHS}
    places = {w: r.argmax(axis=1) for w, r in responses.items()}
    best = np.concatenate([np.take_along_axis(r, places[w][:, None], 1)[:, 0] for w, r in responses.items()], axis=1)
    hidden = np.maximum(best + net.bias, 0)
    p = softmax(hidden @ net.out + net.out_bias)
    p[np.arange(len(y)), y] -= 1
    p *= weight[:, None] / len(y)
    back = (p @ net.out.T) * (hidden > 0)
    grads = []
    columns = np.arange(FILTERS)
    for n, w in enumerate(WIDTHS):
        # Only the place with the largest response takes part.
        grad = np.zeros_like(net.tables[w])
        mine = back[:, n * FILTERS : (n + 1) * FILTERS]
        for j in range(w):
            np.add.at(grad[j], (np.take_along_axis(x, places[w] + j, 1), columns), mine)
        grads.append(grad)
    return [*grads, back.sum(axis=0), hidden.T @ p, p.sum(axis=0)]


def train(docs: DataFrame, training: Column, text: str = "text", lang: str = "lang", per_language: int = PER_LANGUAGE) -> Network | None:
    """Fit on a bounded sample of the rows where ``training`` holds; None if there are none.

    Of each language about ``per_language`` texts are taken by a hash of their
    row, fewer where languages are so many that ``TEXTS`` would be exceeded, and
    from each at most ``PER_TEXT`` windows, spread evenly over the whole text.
    Copies of a text count once. No language is left out for being rare: ``LEAST``
    further texts are taken of each.
    """
    usable = docs.where(training & F.col(text).isNotNull() & F.col(lang).isNotNull() & F.col(text).rlike(r"\p{L}"))
    usable = usable.select(lang, text, F.xxhash64(lang, text).alias("__hash"))
    counts = {
        r[0]: r[1]
        for r in usable.select(lang, "__hash")
        .distinct()
        .groupBy(lang).agg(F.count(F.lit(1)).alias("n")).collect()  # a row for each language
    }
    if not counts:
        return None
    per_language = max(1, min(per_language, TEXTS // len(counts)))
    parts = 1 << 20
    share = F.create_map(*(F.lit(v) for k, n in counts.items() for v in (k, min(parts, parts * (per_language + LEAST) // n + 1))))
    mine = F.pmod("__hash", F.lit(parts)) < F.element_at(share, F.col(lang))
    sample = usable.where(mine).distinct()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple[str, int, bytes]] = []
            for name, value, key in zip(*(c.to_pylist() for c in batch.columns)):
                view, _ = windows_of(value)
                chosen = np.unique(np.linspace(0, len(view) - 1, PER_TEXT).astype(int))
                out += [(name, key, view[i].tobytes()) for i in chosen]
            types = (pa.string(), pa.int64(), pa.binary())
            yield pa.RecordBatch.from_arrays(
                [pa.array([o[i] for o in out], t) for i, t in enumerate(types)], ["lang", "hash", "window"]
            )

    # The shares hold on average; each language is bounded by itself.
    text_number = F.dense_rank().over(W.partitionBy("lang").orderBy("hash"))
    windows = sample.mapInArrow(cut, "lang string, hash long, window binary").withColumn("n", text_number)
    rows = windows.where(F.col("n") <= 2 * (per_language + LEAST)).select("lang", "window").collect()
    rows.sort(key=lambda r: (r.lang, bytes(r.window)))
    languages = sorted({r.lang for r in rows})
    if not languages:
        return None
    x = np.stack([np.frombuffer(r.window, np.uint8) for r in rows])
    y = np.array([languages.index(r.lang) for r in rows])
    return fit(x, y, languages)


def predict(docs: DataFrame, net: Network | None, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with lang_pred and score, the probability of that language.

    A text that is NULL or holds no letter, and every text where nothing was
    learned, is ``und`` with score 0. Whole texts are read. Rows stay as they
    are, repeated ones too. Columns called like a result keep their values under
    the name with an underscore added. ``keep`` names the columns that stay.
    """
    columns = docs.columns if keep is None else keep
    names = [spare(c + "_", docs.columns) if c in ("lang_pred", "score") else c for c in columns]
    # Texts without a letter need not travel.
    lettered = F.when(docs[text].rlike(r"\p{L}"), docs[text])
    taken = docs.select(*(docs[c].alias(n) for c, n in zip(columns, names)), lettered.alias("__text"))
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in taken.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, len(names), BATCH_BYTES):
            found, scores = [UNKNOWN] * batch.num_rows, np.zeros(batch.num_rows)
            texts = batch.column(len(names)).to_pylist()
            rows = [i for i, t in enumerate(texts) if t is not None] if net else []
            if rows:
                views, sizes = zip(*(windows_of(texts[i]) for i in rows))
                p = net.probabilities(np.concatenate(views)) * np.concatenate(sizes)[:, None]
                starts = np.cumsum([0, *(len(v) for v in views[:-1])])
                p = np.add.reduceat(p, starts, axis=0)
                p /= p.sum(axis=1, keepdims=True)
                best = p.argmax(axis=1)
                scores[rows] = p[np.arange(len(rows)), best]
                for i, b in zip(rows, best):
                    found[i] = net.languages[b]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array(found, pa.string()), pa.array(scores, pa.float64())],
                [*names, "lang_pred", "score"],
            )

    return taken.mapInArrow(run, f"{kept}, lang_pred string, score double")
