"""Tokens of two tokenizers over one text, linked through the bytes they cover.

Each side is an incidence matrix of tokens and bytes in compressed rows. The
product of one side with the other's transpose has an entry for every pair of
tokens that overlap, valued with the bytes they share (overlap links). Where
both tokens of such a pair end at the same byte a group ends; tokens and groups
form incidence matrices again, whose product has an entry for every pair of
tokens in one group (shared-group links).

Both tokenizers part a text before a single blank between two visible
characters. The text is therefore aligned unit by unit, a unit from one such
blank up to the next; the matrices hold all units that a batch meets for the
first time, and what they gave is remembered by a worker.

Tokens that end together cover the same bytes up to there, so that the shorter
one is a suffix of the longer. The id pairs that can be linked at all are thus
known from the two vocabularies, at most one for every suffix of every token;
links are stored as numbers into that list, and counts over the corpus are an
array of its length, whatever the corpus.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from fleetlake.llm.common import by_bytes, spare
from fleetlake.llm.csr import Csr
from fleetlake.llm.pieces import MARK, Encoder

#: Bytes of text aligned at a time; units remembered in a worker before it starts afresh.
BATCH_BYTES, REMEMBERED = 1_000_000, 200_000
#: Before such a blank both tokenizers part: it stands alone, between characters that nobody takes for white space.
UNSURE = r"\s\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff"
CUT = re.compile(rf"(?<=[^{UNSURE}]) (?=[^{UNSURE}])")
#: Letters, digits and signs that every version of Unicode puts in the same classes, between single blanks.
PLAIN = re.compile(r"(?: [!-~À-ÖØ-öø-ÿ]+)+")
#: Fixed value: where the byte-level vocabulary parts a text before merging.
PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_letters() -> dict[str, int]:
    """The letters by which a byte-level vocabulary spells bytes: printable ones are themselves, others follow at 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Vocabularies:
    """Both tokenizers, the bytes of their tokens, and the pairs of ids that can end together."""

    def __init__(self, byte_level: str, pieces: str):
        self.a = Tokenizer.from_file(byte_level)
        self.a.encode_special_tokens = True
        letters = byte_letters()
        with open(byte_level, encoding="utf-8") as file:
            spelled = json.load(file)["model"]["vocab"]
        self.bytes_a = [b""] * (max(spelled.values(), default=-1) + 1)
        for entry, i in spelled.items():
            # What is not spelled in byte letters is a special token's name, which text never becomes.
            self.bytes_a[i] = bytes(letters[c] for c in entry) if all(c in letters for c in entry) else b""
        self.encoder = Encoder(pieces)
        library: sentencepiece.SentencePieceProcessor = self.encoder.library
        self.bytes_b = [
            bytes([int(library.id_to_piece(i)[3:-1], 16)])
            if library.is_byte(i)
            else library.id_to_piece(i).replace(MARK, " ").encode()
            for i in range(len(library))
        ]
        # On plain text the two libraries agree, and this one is three times as fast.
        ranks = {token: i for i, token in enumerate(self.bytes_a) if token}
        self.fast = tiktoken.Encoding("own", pat_str=PARTS, mergeable_ranks=ranks, special_tokens={})
        self.width_a = np.array([*map(len, self.bytes_a)], np.int64)
        self.width_b = np.array([*map(len, self.bytes_b)], np.int64)
        self.pairs = self._pairs()

    def _pairs(self) -> np.ndarray:
        """Sorted ``a * (ids of B) + b`` of all tokens of which one is a suffix of the other."""
        by_bytes_a, by_bytes_b = _by_bytes(self.bytes_a), _by_bytes(self.bytes_b)
        found = {
            (a, b)
            for own, other, swap in ((self.bytes_a, by_bytes_b, False), (self.bytes_b, by_bytes_a, True))
            for i, token in enumerate(own)
            for cut in range(len(token))
            for j in other.get(token[cut:], ())
            for a, b in [(j, i) if swap else (i, j)]
        }
        return np.array(sorted(a * len(self.bytes_b) + b for a, b in found), np.int64)

    def ids(self, units: list[str]) -> tuple[list[list[int]], list[list[int]]]:
        """Ids of both sides for texts that begin with the blank that B adds by itself."""
        plain = PLAIN.fullmatch
        a = [self.fast.encode_ordinary(u) if plain(u) else None for u in units]
        rest = [k for k, ids in enumerate(a) if ids is None]
        for k, encoded in zip(rest, self.a.encode_batch([units[k] for k in rest], add_special_tokens=False)):
            a[k] = encoded.ids
        return a, self.encoder.library.encode([u[1:] for u in units], num_threads=1)

    def units(self, text: str) -> list[str]:
        """``text`` with a blank before it, cut where both tokenizers part; whole where B might join across."""
        if not self.encoder.by_unit:
            return [" " + text]
        first, *rest = CUT.split(text)
        return [" " + first, *(" " + part for part in rest)]


def _by_bytes(tokens: list[bytes]) -> dict[bytes, list[int]]:
    found: dict[bytes, list[int]] = {}
    for i, token in enumerate(tokens):
        if token:
            found.setdefault(token, []).append(i)
    return found


@lru_cache(maxsize=2)
def _vocabularies(byte_level: str, pieces: str) -> Vocabularies:
    # Spark gives a task one core.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return Vocabularies(byte_level, pieces)


def incidence(widths: np.ndarray) -> Csr:
    """Tokens and the bytes they cover, one token after the other."""
    ends = np.cumsum(widths)
    total = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate([[0], ends]), np.arange(total), np.ones(total, np.int64), total)


@dataclass(frozen=True)
class Alignment:
    """Overlap links (a, b, shared bytes), which of them end together, and the group of every token."""

    overlap: Csr
    linked: np.ndarray
    group_a: np.ndarray
    group_b: np.ndarray

    def linked_pairs(self) -> tuple[np.ndarray, np.ndarray]:
        """Tokens of both sides that end together, in order."""
        return self.overlap.row_of_entries()[self.linked], self.overlap.indices[self.linked]

    def shared(self) -> Csr:
        """Shared-group links: tokens of A and groups times groups and tokens of B."""
        groups = int(self.group_a[-1]) + 1 if len(self.group_a) else 0
        left = Csr.of_entries(np.arange(len(self.group_a)), self.group_a, (len(self.group_a), groups))
        right = Csr.of_entries(np.arange(len(self.group_b)), self.group_b, (len(self.group_b), groups))
        return left.times(right.transposed())


def align(widths_a: np.ndarray, widths_b: np.ndarray) -> Alignment:
    """Align two sequences of tokens over the same bytes, given the bytes of each token (one or more)."""
    overlap = incidence(widths_a).times(incidence(widths_b).transposed())
    ends_a, ends_b = np.cumsum(widths_a), np.cumsum(widths_b)
    linked = ends_a[overlap.row_of_entries()] == ends_b[overlap.indices]
    ends = ends_b[overlap.indices[linked]]
    return Alignment(overlap, linked, np.searchsorted(ends, ends_a), np.searchsorted(ends, ends_b))


def _texts(tokens: list[bytes]) -> list[bytes]:
    return [b"%d" % i for i in range(len(tokens))]


class Aligner:
    """What units gave, by unit: numbers of tokens, spelled groups, linked pairs."""

    def __init__(self, vocabularies: Vocabularies):
        self.v = vocabularies
        a, b = _texts(vocabularies.bytes_a), _texts(vocabularies.bytes_b)
        # An id with what follows it: inside a group's side, and at its end.
        self.spelled = [x + sign for side, signs in ((a, b",|"), (b, b",;")) for sign in (signs[:1], signs[1:]) for x in side]
        self.slot: dict[str, int] = {}
        self._forget()

    def _forget(self) -> None:
        self.slot.clear()
        self.groups: list[bytes | None] = []
        self.links: list[bytes] = []
        self.sizes = np.zeros((0, 3), np.int32)

    def add(self, units: list[str]) -> None:
        """Align units not met before, all in one matrix for each side."""
        ids_a, ids_b = self.v.ids(units)
        flat_a, flat_b, fits = self._fitting(units, ids_a, ids_b)
        made = align(self.v.width_a[flat_a], self.v.width_b[flat_b])
        of_a, of_b = made.linked_pairs()
        numbers = np.searchsorted(self.v.pairs, flat_a[of_a] * len(self.v.bytes_b) + flat_b[of_b]).astype(np.int32)
        size_a, size_b = (np.fromiter(map(len, ids), np.int64, len(units)) for ids in (ids_a, ids_b))
        last_a, last_b = np.cumsum(size_a), np.cumsum(size_b)
        # A unit's end ends a group, so that a unit's groups are those up to its last token's.
        edge = np.concatenate([[0], np.append(made.group_a, -1)[last_a - 1] + 1])
        spelled = self._spelled(flat_a, flat_b, made)
        tokens = [0, *(last_a + last_b).tolist()]
        raw, cuts = numbers.tobytes(), (edge * 4).tolist()
        first = len(self.groups)
        self.slot.update(zip(units, range(first, first + len(units))))
        self.groups += [
            b"".join(spelled[lo:hi])[:-1] if fit else None for lo, hi, fit in zip(tokens, tokens[1:], fits)
        ]
        self.links += [raw[lo:hi] for lo, hi in zip(cuts, cuts[1:])]
        sizes = np.stack([size_a, size_b, np.diff(edge)], axis=1).astype(np.int32)
        self.sizes = np.concatenate([self.sizes, sizes])

    def _fitting(self, units: list[str], ids_a: list, ids_b: list) -> tuple[np.ndarray, np.ndarray, list[bool]]:
        """All ids in a row, and which units both sides spell byte by byte; others lose their ids."""
        spell = (self.v.bytes_a.__getitem__, self.v.bytes_b.__getitem__)
        fits = [True] * len(units)
        for k, unit in enumerate(units):
            raw = unit.encode()
            if b"".join(map(spell[0], ids_a[k])) != raw or b"".join(map(spell[1], ids_b[k])) != raw:
                fits[k], ids_a[k], ids_b[k] = False, [], []
        return *(np.fromiter((i for x in ids for i in x), np.int64) for ids in (ids_a, ids_b)), fits

    def _spelled(self, flat_a: np.ndarray, flat_b: np.ndarray, made: Alignment) -> list[bytes]:
        """Every token as its decimal id and what follows it, A's of a group before B's."""
        out = np.empty(len(flat_a) + len(flat_b), np.int64)
        last_a = np.diff(made.group_a, append=-1) != 0
        last_b = np.diff(made.group_b, append=-1) != 0
        n_a, n_b = len(self.v.bytes_a), len(self.v.bytes_b)
        ends_a, ends_b = np.flatnonzero(last_a) + 1, np.flatnonzero(last_b) + 1
        before_b = np.concatenate([[0], ends_b[:-1]]) if len(ends_b) else ends_b
        out[np.arange(len(flat_a)) + before_b[made.group_a]] = flat_a + last_a * n_a
        out[np.arange(len(flat_b)) + ends_a[made.group_b]] = flat_b + last_b * n_b + 2 * n_a
        return list(map(self.spelled.__getitem__, out.tolist()))

    def texts(self, texts: list[str]) -> tuple[np.ndarray, list[bytes], list[bytes]]:
        """(tokens of A, of B, groups) of each text, its spelled groups, its links' numbers."""
        units = [self.v.units(t) if t else [] for t in texts]
        if len(self.slot) > REMEMBERED:
            self._forget()
        new = list(dict.fromkeys(u for own in units for u in own if u not in self.slot))
        if new:
            self.add(new)
        sizes = np.zeros((len(texts), 3), np.int64)
        groups, links = [b""] * len(texts), [b""] * len(texts)
        for k, own in enumerate(units):
            slots = [self.slot[u] for u in own]
            spelled = [self.groups[s] for s in slots]
            if own and None not in spelled:
                sizes[k] = self.sizes[slots].sum(axis=0)
                groups[k] = b";".join(spelled)
                links[k] = b"".join([self.links[s] for s in slots])
        return sizes, groups, links


@lru_cache(maxsize=2)
def _aligner(byte_level: str, pieces: str) -> Aligner:
    return Aligner(_vocabularies(byte_level, pieces))


RESULTS = ("n_a", "n_b", "n_groups", "groups", "links")


def align_tokens(
    docs: DataFrame, byte_level: str, pieces: str, text: str = "text", keep: list[str] | None = None
) -> DataFrame:
    """``docs`` with n_a, n_b, n_groups, groups and links.

    A is a byte-level vocabulary of the tokenizers library, which gets the text
    with a blank before it; B is a sentencepiece model, which adds that blank
    itself. ``groups`` spells the groups as ``a1,a2|b1;a3|b2,b3``; ``links`` has
    for each pair of tokens that end together the number of its id pair (see
    ``link_pairs``), in order. Both paths are those of files on every worker.

    NULL and empty texts, and those that one of the tokenizers does not give
    back byte by byte, have no tokens: zeros, an empty string and an empty list.
    Texts are aligned whole, however long; a text stays in one task. Rows are
    kept as they are, repeated ones too; there is no exchange. Columns called
    like a result keep their values under the name with an underscore added.
    ``keep`` names the columns that stay (all by default).
    """
    columns = docs.columns if keep is None else keep
    names = [spare(c + "_", docs.columns) if c in RESULTS else c for c in columns]
    taken = docs.select(*(docs[c].alias(n) for c, n in zip(columns, names)), docs[text].alias("__text"))
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in taken.schema.fields[:-1])
    schema = f"{kept}n_a long, n_b long, n_groups long, groups string, links array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(byte_level, pieces)
        for batch in by_bytes(batches, len(names), BATCH_BYTES):
            sizes, groups, links = aligner.texts([t or "" for t in batch.column(len(names)).to_pylist()])
            numbers = np.frombuffer(b"".join(links), np.int32)
            offsets = np.cumsum([0, *(len(x) // 4 for x in links)])
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    *(pa.array(sizes[:, i]) for i in range(3)),
                    pa.array(groups, pa.binary()).cast(pa.string()),
                    pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(numbers)),
                ],
                [*names, *RESULTS],
            )

    return taken.mapInArrow(run, schema)


def token_links(docs: DataFrame, byte_level: str, pieces: str, kind: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """(key, links) with links of one kind as (a, b, weight), a and b being places of tokens in the text.

    ``overlap``: tokens that share bytes, weighed by their number; ``ends``:
    those of them that end together; ``group``: tokens of one group, weight 1.
    A group of m and n tokens has m * n links; the other kinds have at most a
    link for each token of either side. Texts as in ``align_tokens``.
    """
    if kind not in ("overlap", "ends", "group"):
        raise ValueError(kind)
    taken = docs.select(docs[key].alias("key"), docs[text].alias("text"))
    field = taken.schema["key"].dataType.simpleString()

    def links(v: Vocabularies, text: str) -> np.ndarray:
        a, b = v.ids([" " + text]) if text else ([[]], [[]])
        ids_a, ids_b = np.array(a[0], np.int64), np.array(b[0], np.int64)
        spelled = (b"".join(tokens[i] for i in ids) for tokens, ids in ((v.bytes_a, ids_a), (v.bytes_b, ids_b)))
        if any(s != (" " + text).encode() for s in spelled):
            return np.zeros((0, 3), np.int64)
        made = align(v.width_a[ids_a], v.width_b[ids_b])
        matrix = made.shared() if kind == "group" else made.overlap
        rows = np.stack([matrix.row_of_entries(), matrix.indices, matrix.data], axis=1)
        return rows[made.linked] if kind == "ends" else rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = _vocabularies(byte_level, pieces)
        for batch in by_bytes(batches, 1, BATCH_BYTES):
            found = [links(v, t or "") for t in batch.column(1).to_pylist()]
            flat = np.concatenate([np.zeros((0, 3), np.int64), *found])
            structs = pa.StructArray.from_arrays([pa.array(flat[:, i]) for i in range(3)], ["a", "b", "weight"])
            offsets = pa.array(np.cumsum([0, *map(len, found)]), pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.ListArray.from_arrays(offsets, structs)], [key, "links"])

    return taken.mapInArrow(run, f"`{key}` {field}, links array<struct<a:long,b:long,weight:long>>")


def link_pairs(byte_level: str, pieces: str) -> tuple[np.ndarray, np.ndarray]:
    """Ids of A and of B by number of pair."""
    v = _vocabularies(byte_level, pieces)
    return v.pairs // len(v.bytes_b), v.pairs % len(v.bytes_b)


def count_links(aligned: DataFrame, n_pairs: int) -> DataFrame:
    """(pair, n): the links of ``aligned`` by number of their pair. A task sends each pair once."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_pairs, np.int64)
        for batch in batches:
            total += np.bincount(pa.compute.list_flatten(batch.column(0)).to_numpy(zero_copy_only=False), minlength=n_pairs)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met.astype(np.int32)), pa.array(total[met])], ["pair", "n"])

    return aligned.select("links").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def weigh_links(aligned: DataFrame, byte_level: str, pieces: str, keep: list[str]) -> DataFrame:
    """``aligned``'s columns ``keep``, n_links, n_best and count_sum, with counts over all its links.

    ``count_sum`` adds up the counts of the links' id pairs; ``n_best`` is how
    many links have a count that no other pair of their B id exceeds. What is
    collected and sent to the tasks is one number for each pair of
    ``link_pairs``, a few megabytes for any corpus. ``aligned`` is read twice;
    store it first.
    """
    pair_b = link_pairs(byte_level, pieces)[1]
    counted = count_links(aligned, len(pair_b)).toPandas()
    counts = np.zeros(len(pair_b), np.int64)
    counts[counted["pair"].to_numpy()] = counted["n"].to_numpy()
    highest = np.zeros(int(pair_b.max(initial=0)) + 1, np.int64)
    np.maximum.at(highest, pair_b, counts)
    best = counts == highest[pair_b]
    weights = aligned.sparkSession.sparkContext.broadcast((counts, best))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, best = weights.value
        for batch in batches:
            *kept, links = batch.columns
            numbers = pa.compute.list_flatten(links).to_numpy(zero_copy_only=False)
            sizes = pa.compute.list_value_length(links).to_numpy(zero_copy_only=False)
            before = np.concatenate([[0], np.cumsum(sizes)])
            sums = [np.concatenate([[0], np.cumsum(x[numbers], dtype=np.int64)]) for x in (best, counts)]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(sizes.astype(np.int64)), *(pa.array(np.diff(s[before])) for s in sums)],
                [*keep, "n_links", "n_best", "count_sum"],
            )

    taken = aligned.select(*keep, "links")
    kept = "".join(f"`{f.name}` {f.dataType.simpleString()}, " for f in taken.schema.fields[:-1])
    return taken.mapInArrow(run, f"{kept}n_links long, n_best long, count_sum long")

