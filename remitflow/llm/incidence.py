"""Sparse 0/1 matrices in compressed rows, made by hand, and their products row by row (Gustavson)."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np


class Csr(NamedTuple):
    """Row ``i`` has its ones in the columns ``indices[indptr[i]:indptr[i + 1]]``, ascending."""

    indptr: np.ndarray
    indices: np.ndarray
    columns: int

    @property
    def rows(self) -> int:
        return len(self.indptr) - 1


def token_bytes(ends: np.ndarray) -> Csr:
    """Tokens x bytes of a text that its tokens cover one after the other (``ends``: where each ends)."""
    size = int(ends[-1]) if len(ends) else 0
    return Csr(np.concatenate(([0], ends)), np.arange(size), size)


def token_groups(ends: np.ndarray, cuts: np.ndarray) -> Csr:
    """Tokens x groups: the group of a token is the one whose cut is the first at or after its end."""
    return Csr(np.arange(len(ends) + 1), np.searchsorted(cuts, ends), len(cuts))


def transposed(m: Csr) -> Csr:
    row = np.repeat(np.arange(m.rows), np.diff(m.indptr))
    order = np.argsort(m.indices, kind="stable")
    return Csr(np.concatenate(([0], np.cumsum(np.bincount(m.indices, minlength=m.columns)))), row[order], m.rows)


def spread(indptr: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(positions of all entries of ``rows`` in order, number of entries of each)."""
    sizes = indptr[rows + 1] - indptr[rows]
    before = np.cumsum(sizes) - sizes
    return np.arange(int(sizes.sum())) - np.repeat(before - indptr[rows], sizes), sizes


def product(a: Csr, b: Csr) -> tuple[Csr, np.ndarray]:
    """The pattern of ``a . b`` and its values: row ``i`` adds up the rows of ``b`` that row ``i`` of ``a`` names."""
    row = np.repeat(np.arange(a.rows), np.diff(a.indptr))
    at, sizes = spread(b.indptr, a.indices)
    key = np.repeat(row, sizes) * b.columns + b.indices[at]
    if len(key) and (np.diff(key) < 0).any():
        key.sort()
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(key) else np.zeros(0, dtype=np.int64)
    values = np.diff(np.concatenate((first, [len(key)])))
    key = key[first]
    counts = np.bincount(key // b.columns, minlength=a.rows) if len(key) else np.zeros(a.rows, dtype=np.int64)
    return Csr(np.concatenate(([0], np.cumsum(counts))), key % b.columns if len(key) else key, b.columns), values


def product_size(a: Csr, b: Csr) -> np.ndarray:
    """Entries that each row of ``a . b`` gathers, without making them."""
    gathered = np.concatenate(([0], np.cumsum(np.diff(b.indptr)[a.indices])))
    return gathered[a.indptr[1:]] - gathered[a.indptr[:-1]]


def product_in_blocks(a: Csr, b: Csr, most: int = 1 << 20) -> Iterator[tuple[int, Csr, np.ndarray]]:
    """``product`` in blocks of rows that gather about ``most`` entries (one row at least): first row, block, values."""
    gathered = np.cumsum(product_size(a, b))
    begin = 0
    while begin < a.rows:
        done = int(gathered[begin - 1]) if begin else 0
        end = max(begin + 1, int(np.searchsorted(gathered, done + most, side="right")))
        part = Csr(a.indptr[begin:end + 1] - a.indptr[begin], a.indices[a.indptr[begin]:a.indptr[end]], a.columns)
        yield begin, *product(part, b)
        begin = end
