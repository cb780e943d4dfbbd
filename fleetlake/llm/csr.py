"""Sparse matrices in compressed rows, as far as alignments need them."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

#: Entries that a product expands at a time.
BLOCK = 4_000_000


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The numbers of all spans, one span after the other."""
    ends = np.cumsum(lengths)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) + np.repeat(starts - ends + lengths, lengths)


@dataclass(frozen=True)
class Csr:
    """Row i holds ``data[k]`` in column ``indices[k]`` for k from ``indptr[i]`` to ``indptr[i + 1]``."""

    indptr: np.ndarray
    indices: np.ndarray
    data: np.ndarray
    columns: int

    @property
    def rows(self) -> int:
        return len(self.indptr) - 1

    def row_of_entries(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.indptr))

    @staticmethod
    def of_entries(rows: np.ndarray, columns: np.ndarray, shape: tuple[int, int], data: np.ndarray | None = None) -> Csr:
        """From entries in any order; each place at most once."""
        if len(rows) and not (np.diff(rows) >= 0).all():
            order = np.argsort(rows, kind="stable")
            rows, columns, data = rows[order], columns[order], None if data is None else data[order]
        indptr = np.concatenate([[0], np.cumsum(np.bincount(rows, minlength=shape[0]))])
        return Csr(indptr, columns, np.ones(len(columns), np.int64) if data is None else data, shape[1])

    def transposed(self) -> Csr:
        return Csr.of_entries(self.indices, self.row_of_entries(), (self.columns, self.rows), self.data)

    def times(self, other: Csr) -> Csr:
        """The product by rows (Gustavson): row i is the sum of ``other``'s rows that row i names, times its entries.

        Rows are taken in blocks, so that about ``BLOCK`` partial products, or
        those of one row, exist at a time.
        """
        widths = np.diff(other.indptr)[self.indices]
        before = np.concatenate([[0], np.cumsum(widths)])[self.indptr]
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        row = 0
        while row < self.rows:
            end = max(row + 1, int(np.searchsorted(before, before[row] + BLOCK, "right")) - 1)
            parts.append(self._block(other, widths, row, end))
            row = end
        if not parts:
            return Csr(np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), other.columns)
        rows, columns, data = (np.concatenate(p) for p in zip(*parts))
        return Csr.of_entries(rows, columns, (self.rows, other.columns), data)

    def _block(self, other: Csr, widths: np.ndarray, row: int, end: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        entries = slice(self.indptr[row], self.indptr[end])
        named, width = self.indices[entries], widths[entries]
        rows = np.repeat(np.repeat(np.arange(row, end), np.diff(self.indptr[row : end + 1])), width)
        taken = spans(other.indptr[named], width)
        columns = other.indices[taken]
        data = np.repeat(self.data[entries], width) * other.data[taken]
        key = rows * other.columns + columns
        if len(key) and not (np.diff(key) >= 0).all():
            order = np.argsort(key, kind="stable")
            key, rows, columns, data = key[order], rows[order], columns[order], data[order]
        first = np.ones(len(key), bool)
        first[1:] = np.diff(key) != 0
        at = np.flatnonzero(first)
        return rows[at], columns[at], np.add.reduceat(data, at) if len(at) else data
