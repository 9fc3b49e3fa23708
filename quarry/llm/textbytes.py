"""Vectorised passes over the UTF-8 bytes of Arrow string columns.

Tasks work on the column's own buffers: words are found and hashed with array
operations over a few megabytes at a time, never one Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
PIECE = 1 << 20  # bytes handled at once, so that the work arrays stay small

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
#: Letters, digits and every byte of a non-ASCII character; anything else separates terms.
TERM = np.zeros(256, dtype=bool)
TERM[48:58] = TERM[65:91] = TERM[97:123] = True
TERM[128:] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


class Rolling:
    """Polynomial hashes of any byte range from one prefix-sum pass."""

    def __init__(self, seed: int):
        rng = np.random.default_rng(seed)
        self.code = rng.integers(0, 1 << 64, 256, dtype=np.uint64)
        self.base = U(int(rng.integers(1 << 62, 1 << 63)) * 2 + 1 & (1 << 64) - 1 | 5)
        inv = pow(int(self.base), -1, 1 << 64)
        self.inverse = U(inv)
        self._up = self._down = np.ones(1, dtype=np.uint64)

    def _powers(self, n: int):
        if len(self._up) < n + 1:
            with np.errstate(over="ignore"):
                for name, b in (("_up", self.base), ("_down", self.inverse)):
                    p = np.full(n + 1, b, dtype=np.uint64)
                    p[0] = 1
                    setattr(self, name, np.cumprod(p, dtype=np.uint64))
        return self._up, self._down

    def sums(self, data: np.ndarray, code: np.ndarray | None = None) -> np.ndarray:
        up, _ = self._powers(len(data))
        s = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((self.code if code is None else code)[data] * up[:len(data)], out=s[1:])
        return s

    def of(self, sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hash of ``[start, end)`` for each range (length is mixed in)."""
        _, down = self._powers(len(sums) - 1)
        return mix((sums[end] - sums[start]) * down[start] + (end - start).astype(np.uint64) * U(0x9E3779B97F4A7C15))


WORDS = Rolling(11)
LOWER_CODE = WORDS.code[_LOWER]


def buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and int64 offsets (rows + 1) of a string column; nulls are empty."""
    if col.null_count:
        col = pc.fill_null(col, b"" if pa.types.is_binary(col.type) or pa.types.is_large_binary(col.type) else "")
    large = pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type)
    _, off, data = col.buffers()
    if off is None or len(col) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(col) + 1, np.int64)
    off = np.frombuffer(off, dtype=np.int64 if large else np.int32)[col.offset:col.offset + len(col) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[off[0]:off[-1]], off - off[0]


def pieces(batch: pa.RecordBatch, column: str, size: int = PIECE) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Runs of rows with about ``size`` bytes of text: (rows, bytes, offsets).
    A longer text is a run of its own and stays whole."""
    data, off = buffers(batch.column(column))
    n, a = len(off) - 1, 0
    while a < n:
        b = max(a + 1, min(n, int(np.searchsorted(off, off[a] + size, side="right")) - 1, a + 8192))
        yield slice(a, b), data[off[a]:off[b]], off[a:b + 1] - off[a]
        a = b


def word_ranges(data: np.ndarray, off: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of bytes marked in ``inside`` (no
    run crosses a row), and the rows' offsets into that list."""
    n = len(data)
    if n == 0:
        z = np.zeros(0, np.int64)
        return z, z, np.zeros(len(off), np.int64)
    cut = np.zeros(n + 1, dtype=bool)
    cut[off] = True
    first = inside.copy()
    first[1:] &= ~inside[:-1] | cut[1:n]
    last = inside.copy()
    last[:-1] &= ~inside[1:] | cut[1:n]
    start = np.flatnonzero(first)
    return start, np.flatnonzero(last) + 1, np.searchsorted(start, off)


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, and the
    rows' offsets into them."""
    s, e, at = word_ranges(data, off, ~SPACE[data])
    return WORDS.of(WORDS.sums(data, LOWER_CODE), s, e), at


def terms(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The same for runs of letters and digits: punctuation does not stick."""
    s, e, at = word_ranges(data, off, TERM[data])
    return WORDS.of(WORDS.sums(data, LOWER_CODE), s, e), at


def distinct(values: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each row, sorted, and the rows' new offsets."""
    rows = len(at) - 1
    if len(values) == 0:
        return values, np.zeros(rows + 1, np.int64)
    row = np.repeat(np.arange(rows), np.diff(at))
    order = np.argsort(values, kind="stable")
    order = order[np.argsort(row[order], kind="stable")]
    v, r = values[order], row[order]
    new = np.ones(len(v), dtype=bool)
    new[1:] = (v[1:] != v[:-1]) | (r[1:] != r[:-1])
    v, r = v[new], r[new]
    return v, np.searchsorted(r, np.arange(rows + 1))


def per_row(values: np.ndarray, at: np.ndarray, reduce, empty):
    """``reduce.reduceat`` by row; rows without values get ``empty``."""
    rows = len(at) - 1
    out = np.full(rows, empty, dtype=values.dtype if len(values) else None)
    full = np.flatnonzero(np.diff(at))
    if len(full):
        out[full] = reduce.reduceat(values, at[full])
    return out
