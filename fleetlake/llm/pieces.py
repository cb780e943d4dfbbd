"""SentencePiece encoding that keeps, for every piece, the bytes of the text it came from.

The text is normalised here: at each place the longest prefix in the model's
compiled character map is replaced, spaces become the model's space mark, and
every byte written records the byte of the text it stands for. Pieces never
join across the start of a space mark, so the normalised text falls into units
that are encoded one by one; a unit met before is looked up. The lengths of the
pieces then give their places in the normalised text, and the record of the
normalisation gives their places in the original.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from sentencepiece import sentencepiece_model_pb2

from fleetlake.llm.common import by_bytes, carried, spare

#: Fixed values of the model format: the space mark, and the kinds of pieces.
MARK = "▁"
BYTE, UNKNOWN = 6, 2
#: Bytes of text encoded at a time; units remembered in a worker before it starts afresh.
BATCH_BYTES, REMEMBERED = 2_000_000, 200_000


class CharMap:
    """The compiled character map: a double array of prefixes and a pool of their replacements."""

    def __init__(self, blob: bytes):
        size = struct.unpack_from("<I", blob)[0] if blob else 0
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist() if blob else []
        self.pool = blob[4 + size :] if blob else b""
        self.first = {b for b in range(1, 256) if self.units and self._child(self._offset(self.units[0]), b) is not None}

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & (1 << 9)) >> 6)

    def _child(self, base: int, byte: int) -> int | None:
        at = base ^ byte
        if at < len(self.units) and self.units[at] & (1 << 31 | 0xFF) == byte:
            return at
        return None

    def longest(self, text: bytes, start: int) -> tuple[int, bytes] | None:
        """Length of the longest prefix in the map at ``start``, and what replaces it."""
        if not self.units:
            return None
        found = None
        at = 0
        base = self._offset(self.units[0])
        for i in range(start, len(text)):
            child = self._child(base, text[i])
            if child is None:
                break
            at = child
            base = at ^ self._offset(self.units[at])
            if self.units[at] >> 8 & 1:
                value = self.units[base] & (1 << 31) - 1
                end = self.pool.index(b"\0", value)
                found = (i + 1 - start, self.pool[value:end])
        return found


class Encoder:
    """A model file's pieces, with alignment. ``encode`` gives what the library's ``encode`` gives."""

    def __init__(self, path: str):
        proto = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            proto.ParseFromString(file.read())
        self.library = sentencepiece.SentencePieceProcessor(model_file=path)
        spec = proto.normalizer_spec
        self.map = CharMap(spec.precompiled_charsmap)
        self.prefix, self.trim = spec.add_dummy_prefix, spec.remove_extra_whitespaces
        if proto.trainer_spec.treat_whitespace_as_suffix or not spec.escape_whitespaces:
            raise ValueError("only models that write spaces as marks before words are supported")
        # Byte pieces stand for a byte each.
        self.width = np.array([1 if p.type == BYTE else len(p.piece.encode()) for p in proto.pieces], np.int64)
        self.unknown = [i for i, p in enumerate(proto.pieces) if p.type == UNKNOWN]
        apart = not any(re.search(f"[^{MARK}]{MARK}", p.piece) for p in proto.pieces)
        fallback = proto.trainer_spec.byte_fallback
        # Without a map that acts on text the library would normalise a unit as it normalises the whole.
        self.by_unit = apart and fallback and not self.map.units and self.prefix and not self.trim
        self.known: dict[str, tuple[bytes, int]] = {}

    def normalise(self, text: str) -> tuple[str, np.ndarray]:
        """The normalised text, and for each of its bytes and its end the byte of ``text`` it begins at."""
        raw = text.encode()
        if not self.map.units and not self.trim:
            return self._marked(text, raw)
        out, places = bytearray(), []
        i = 0
        while i < len(raw):
            step, new = self._step(raw, i)
            out += new
            places += [i] * len(new)
            i += step
        return self._spaced(bytes(out), places, len(raw))

    def _step(self, raw: bytes, i: int) -> tuple[int, bytes]:
        hit = self.map.longest(raw, i) if raw[i] in self.map.first else None
        if hit:
            return hit
        lead = raw[i]
        step = 1 if lead < 0x80 else 2 if lead < 0xE0 else 3 if lead < 0xF0 else 4
        return step, raw[i : i + step]

    def _spaced(self, out: bytes, places: list[int], end: int) -> tuple[str, np.ndarray]:
        """Trim and join spaces if the model does, put the prefix, and write marks."""
        mark = MARK.encode()
        final, aligned = bytearray(), []
        last_space = self.trim
        for byte, place in zip(out, places):
            if byte == 0x20:
                if not (self.trim and last_space):
                    final += mark
                    aligned += [place] * 3
                last_space = True
            else:
                final.append(byte)
                aligned.append(place)
                last_space = False
        while self.trim and final.endswith(mark):
            end = aligned[-1]
            del final[-3:], aligned[-3:]
        if self.prefix and final:
            final[:0] = mark
            aligned[:0] = [aligned[0]] * 3
        return final.decode(), np.array([*aligned, end], np.int64)

    def _marked(self, text: str, raw: bytes) -> tuple[str, np.ndarray]:
        """The same for a model that only marks spaces, without a loop."""
        if not raw:
            return "", np.zeros(1, np.int64)
        codes = np.frombuffer(raw, np.uint8)
        width = np.where(codes == 0x20, 3, 1)
        places = np.repeat(np.arange(len(codes)), width)
        head = np.zeros(3 if self.prefix else 0, np.int64)
        return (MARK if self.prefix else "") + text.replace(" ", MARK), np.concatenate([head, places, [len(codes)]])

    def encode(self, texts: list[str]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Ids of each text, and the first byte and the end of what each id stands for."""
        normal = [self.normalise(t) for t in texts]
        if self.by_unit:
            ids = self._by_unit([n for n, _ in normal])
        else:
            ids = [np.array(x, np.int32) for x in self.library.encode(texts, num_threads=1)]
        return [(x, *self._project(x, n, places)) for x, (n, places) in zip(ids, normal)]

    def _by_unit(self, normal: list[str]) -> list[np.ndarray]:
        split = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+").findall
        units = [split(n) for n in normal]
        if len(self.known) > REMEMBERED:
            self.known.clear()
        known = self.known
        new = list({u for text in units for u in text if u not in known})
        # The library puts one mark before what it is given.
        spelled = [u[1:].replace(MARK, " ") for u in new]
        for unit, ids in zip(new, self._alone(spelled)):
            known[unit] = ids
        return [np.frombuffer(b"".join(map(known.__getitem__, text)), np.int32) for text in units]

    def _alone(self, spelled: list[str]) -> list[bytes]:
        # A unit that is the mark of an empty rest: the library gives nothing for an empty text.
        bare = self.library.piece_to_id(MARK)
        filled = self.library.encode(spelled, num_threads=1)
        return [np.array(ids if s else [bare], np.int32).tobytes() for s, ids in zip(spelled, filled)]

    def _project(self, ids: np.ndarray, normal: str, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        width = self.width[ids]
        if self.unknown and np.isin(ids, self.unknown).any():
            width = self._with_unknown(ids, normal)
        ends = np.cumsum(width)
        starts = ends - width
        # A piece ends where the next byte of the text begins, not inside what one byte became.
        return places[starts].astype(np.int32), places[ends].astype(np.int32)

    def _with_unknown(self, ids: np.ndarray, normal: str) -> np.ndarray:
        """Widths where an unknown piece stands for all up to where the next known piece is found."""
        raw = normal.encode()
        width, at = [], 0
        for n, i in enumerate(ids.tolist()):
            if i not in self.unknown:
                width.append(int(self.width[i]))
            elif n + 1 == len(ids):
                width.append(len(raw) - at)
            else:
                width.append(raw.index(self.library.id_to_piece(int(ids[n + 1])).encode(), at) - at)
            at += width[-1]
        return np.array(width, np.int64)


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


RESULTS = ("ids", "starts", "ends", "decoded")


def encode_pieces(docs: DataFrame, model: str, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ids, starts, ends and decoded.

    ``model`` is a model file's path on every worker. ``starts`` and ``ends``
    are byte positions in the UTF-8 of the text, end exclusive; byte pieces of
    one character have one byte each. ``decoded`` is what the library's
    ``decode`` makes of the ids. NULL and empty texts have no ids and decode to
    an empty text. Long texts are encoded whole. Rows are kept as they are,
    repeated ones too. Columns called like a result keep their values under the
    name with an underscore added. ``keep`` names the columns that stay (all by
    default).
    """
    columns = docs.columns if keep is None else keep
    names = [spare(c + "_", docs.columns) if c in RESULTS else c for c in columns]
    taken, place = carried(docs, columns, names, text)
    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in taken.schema.fields[: len(names)])
    schema = f"{kept}, ids array<int>, starts array<int>, ends array<int>, decoded string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(model)
        for batch in by_bytes(batches, place, BATCH_BYTES):
            texts = [t or "" for t in batch.column(place).to_pylist()]
            encoded = encoder.encode(texts)
            decoded = encoder.library.decode([ids.tolist() for ids, _, _ in encoded], num_threads=1)
            offsets = pa.array(np.cumsum([0, *(len(ids) for ids, _, _ in encoded)]), pa.int32())
            lists = [
                pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([e[i] for e in encoded]), pa.int32()))
                for i in range(3)
            ]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], *lists, pa.array(decoded, pa.string())], [*names, *RESULTS]
            )

    return taken.mapInArrow(run, schema)
