"""Periodic stretches of words by seeds on diagonals.

A stretch whose words repeat at a distance (lag) q, and that is at least
``times`` periods long, overlaps its own copy q words on by a number of words
that the lag guarantees. Runs of words of that guaranteed overlap are indexed,
one size for the lags from a power of two up to the next; each such run and the
one before it that reads the same make a seed on the diagonal of their lag. A
seed is extended word by word in both directions, unless the table of the
furthest word covered on its diagonal shows that an extension has been there.

A run of words of the guaranteed overlap is no shorter than the lag. Therefore
its occurrences in a periodic stretch follow each other at the smallest period,
so neighbouring occurrences are enough, and what they extend to has no smaller
period. An index of a size only takes places whose smaller run occurs twice.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from fleetlake.llm.common import by_bytes, spare
from fleetlake.llm.words import MULTIPLIER, mixed

#: Bytes of text searched at a time.
BATCH_BYTES = 2_000_000


def overlap(low: int, least: int, times: int) -> int:
    """Words that a run of any period from ``low`` on surely shares with its copy a period on."""
    return min(max(least, times * lag) - lag for lag in range(low, max(low, least) + 1))


def _joined(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    return mixed(left * MULTIPLIER + right)


def _grams(single: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words from each place on, from runs of powers of two; at the end there are fewer."""
    out, power, width, have = None, single, 1, 0
    while size:
        if size & 1:
            end = max(0, len(single) - have - width + 1)
            out = power if out is None else _joined(out[:end], power[have : have + end])
            have += width
        size >>= 1
        if size:
            power = _joined(power[: max(0, len(power) - width)], power[width:])
            width *= 2
    return out


def _seeds(hashes: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and second of neighbouring places with equal hashes, and all places whose hash occurs twice."""
    order = np.argsort(hashes[places], kind="stable")
    sorted_places = places[order]
    same = hashes[sorted_places[1:]] == hashes[sorted_places[:-1]]
    repeated = np.zeros(len(places), bool)
    repeated[:-1] |= same
    repeated[1:] |= same
    return sorted_places[:-1][same], sorted_places[1:][same], np.sort(sorted_places[repeated])


def _reach(words: np.ndarray, start: int, lag: int, step: int) -> int:
    """How many words from ``start`` on, forwards or backwards, equal the one ``lag`` further."""
    done, width = 0, 32
    while True:
        if step > 0:
            lo, hi = start + done, min(start + done + width, len(words) - lag)
        else:
            lo, hi = max(0, start - done - width + 1), start - done + 1
        if hi <= lo:
            return done
        unlike = np.flatnonzero(words[lo:hi] != words[lo + lag : hi + lag])
        if len(unlike):
            return done + int(unlike[0] if step > 0 else hi - lo - 1 - unlike[-1])
        done += hi - lo
        width *= 2


def find_in(words: np.ndarray, document: np.ndarray, least: int, times: int) -> list[tuple[int, int, int]]:
    """(start, length, period) of all runs, in order of start and period.

    ``words`` numbers the words of several documents, each followed by a number
    that occurs nowhere else; ``document`` tells whose word each is.
    """
    found: list[tuple[int, int, int]] = []
    if not len(words):
        return found
    # Equal words of different documents have different hashes, so that no seed joins documents.
    single = mixed(words.astype(np.uint64) * MULTIPLIER ^ mixed(document.astype(np.uint64) + np.uint64(1)))
    longest = int(np.bincount(document).max()) // times
    covered: dict[int, int] = {}
    places = np.arange(len(words))
    low = 1
    while low <= longest and len(places) > 1:
        hashes = _grams(single, overlap(low, least, times))
        places = places[places < len(hashes)]
        first, second, places = _seeds(hashes, places)
        lags = second - first
        kept = (lags >= low) & (lags < 2 * low)
        order = np.lexsort((first[kept], lags[kept]))
        first, lags = first[kept][order], lags[kept][order]
        # Of seeds side by side on a diagonal the first stands for all.
        head = np.ones(len(first), bool)
        head[1:] = (np.diff(first) != 1) | (np.diff(lags) != 0)
        for at, lag in zip(first[head].tolist(), lags[head].tolist()):
            if at < covered.get(lag, 0):
                continue
            back = _reach(words, at, lag, -1)
            ahead = _reach(words, at, lag, 1)
            # Where hashes collided, nothing was reached.
            covered[lag] = at + max(ahead, 1)
            start, length = at - back + 1, back - 1 + ahead + lag
            if ahead and length >= max(least, times * lag):
                found.append((start, length, lag))
        low *= 2
    return sorted(found, key=lambda run: (run[0], run[2]))


def kept_words(n: int, runs: list[tuple[int, int, int]]) -> np.ndarray:
    """Which of ``n`` words no run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    for start, length, period in runs:
        change[start + period] += 1
        change[start + length] -= 1
    return np.cumsum(change[:-1]) == 0


def _numbered(texts: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of all words with one of its own after each text, whose they are, and where texts begin."""
    numbers: dict[bytes, int] = {}
    flat = [numbers.setdefault(w, len(numbers)) for words in texts for w in words]
    sizes = np.array([len(words) for words in texts])
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])
    document = np.repeat(np.arange(len(texts)), sizes + 1)
    out = np.empty(len(document), np.int64)
    ends = begins[1:] - 1
    inside = np.ones(len(out), bool)
    inside[ends] = False
    out[inside] = flat
    out[ends] = len(numbers) + np.arange(len(texts))
    return out, document, begins


RESULTS = ("n_words", "runs", "collapsed")


def find_runs(
    docs: DataFrame, text: str = "text", keep: list[str] | None = None, least: int = 6, times: int = 4
) -> DataFrame:
    """``docs`` with n_words, runs (start, length, period) and collapsed.

    Words are what stands between blanks and the characters 9 to 13, numbered
    from 0. A run is a stretch of consecutive words with smallest period q, of
    ``max(least, times * q)`` words or more, that no neighbouring word extends
    at that period; runs come by start, then period. ``collapsed`` joins the
    words that no run holds after its first q words with one blank.

    NULL texts, empty ones and those of blanks have no words, no runs and an
    empty ``collapsed``. Long texts are searched whole; a text's words stay in
    one task, about a hundred bytes each. Rows are kept as they are, repeated
    ones too; there is no exchange. Columns called like a result keep their
    values under the name with an underscore added. ``keep`` names the columns
    that stay (all by default). ``times`` is 3 or more.
    """
    if times < 3:
        raise ValueError("a run is three periods long at least")
    columns = docs.columns if keep is None else keep
    names = [spare(c + "_", docs.columns) if c in RESULTS else c for c in columns]
    taken = docs.select(*(docs[c].alias(n) for c, n in zip(columns, names)), docs[text].alias("__text"))
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in taken.schema.fields[:-1])
    schema = f"{kept}n_words long, runs array<struct<start:long,length:long,period:long>>, collapsed string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_bytes(batches, len(names), BATCH_BYTES):
            texts = [(t or "").encode().split() for t in batch.column(len(names)).to_pylist()]
            words, document, begins = _numbered(texts)
            runs: list[list[tuple[int, int, int]]] = [[] for _ in texts]
            for start, length, period in find_in(words, document, least, times):
                d = int(document[start])
                runs[d].append((start - int(begins[d]), length, period))
            collapsed = []
            for own, found in zip(texts, runs):
                if found:
                    own = [own[i] for i in np.flatnonzero(kept_words(len(own), found)).tolist()]
                collapsed.append(b" ".join(own).decode())
            sizes = np.cumsum([0, *map(len, runs)])
            flat = np.array([r for found in runs for r in found], np.int64).reshape(-1, 3)
            structs = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], ["start", "length", "period"])
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array([len(w) for w in texts], pa.int64()),
                    pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), structs),
                    pa.array(collapsed, pa.string()),
                ],
                [*names, *RESULTS],
            )

    return taken.mapInArrow(run, schema)
