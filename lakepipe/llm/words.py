"""Words and rolling hashes of a whole Arrow batch at once, in numpy.

A hash of a byte range or a run of words is a polynomial over 64-bit values,
taken as a difference of two prefix sums (modulo 2**64), so every range of a
batch costs one subtraction.  All ranges of equal content have equal hashes,
in every batch and on every executor.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

U = np.uint64
#: Texts are worked on in slices of whole rows of about this many bytes; a longer text is a slice of its own.
SLICE_BYTES = 1 << 20


class _Tables(dict):
    """Tables that each process makes for itself: they stay behind when a function that uses them is sent to workers."""

    def __reduce__(self):
        return dict, ()


_POWERS = _Tables()


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit values (a bijection)."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def spread(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudorandom 64-bit values."""
    return mix(np.arange(1, n + 1, dtype=U) * U(0x9E3779B97F4A7C15) + U(seed * 1_000_003 + 77))


def powers(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0..n of an odd base, and of its inverse modulo 2**64."""
    got = _POWERS.get(seed)
    if got is None or len(got[0]) <= n:
        size = max(n + 1, SLICE_BYTES + 1)
        base = int(spread(1, 1000 + seed)[0]) | 1
        pair = []
        for b in (base, pow(base, -1, 1 << 64)):
            p = np.full(size, b, dtype=U)
            p[0] = 1
            pair.append(np.multiply.accumulate(p))
        got = _POWERS[seed] = tuple(pair)
    return got


def prefix(values: np.ndarray, seed: int) -> np.ndarray:
    p, _ = powers(len(values), seed)
    out = np.zeros(len(values) + 1, dtype=U)
    np.cumsum(values * p[: len(values)], out=out[1:])
    return out


def ranged(sums: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int) -> np.ndarray:
    """Hash of each range [start, end) of the values behind ``sums``."""
    _, inverse = powers(len(sums), seed)
    return mix((sums[end] - sums[start]) * inverse[start])


def text_bytes(column) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of an Arrow string column; null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    off = np.frombuffer(offsets, dtype=kind)[column.offset: column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    return raw[off[0]: off[-1]], off - off[0]


def slices(batch: pa.RecordBatch, column: str = "text", rows: int | None = None):
    """Slices of whole rows with about SLICE_BYTES of text each, and at most ``rows`` rows (at least one row)."""
    _, off = text_bytes(batch.column(column))
    a = 0
    while a < len(batch):
        b = max(a + 1, int(np.searchsorted(off, off[a] + SLICE_BYTES, side="right")) - 1)
        b = min(b, a + (rows or len(batch)))
        yield batch.slice(a, b - a)
        a = b


def pieces(column, inside: np.ndarray):
    """Row numbers, bytes and row offsets of pieces of about SLICE_BYTES; runs of ``inside`` bytes stay whole.

    A longer text is a piece of its own for each SLICE_BYTES, cut at a byte
    that is outside, so memory does not grow with a text (a single run that
    is longer is held whole).
    """
    data, off = text_bytes(column)
    a = 0
    while a < len(off) - 1:
        b = max(a + 1, int(np.searchsorted(off, off[a] + SLICE_BYTES, side="right")) - 1)
        if off[b] - off[a] <= SLICE_BYTES:
            yield np.arange(a, b), data[off[a]: off[b]], off[a: b + 1] - off[a]
        else:
            at = int(off[a])
            while at < off[b]:
                end = min(at + SLICE_BYTES, int(off[b]))
                while end < off[b]:
                    outside = np.flatnonzero(~inside[data[end: min(end + 4096, int(off[b]))]])
                    if len(outside):
                        end += int(outside[0])
                        break
                    end = min(end + 4096, int(off[b]))
                yield np.array([a]), data[at:end], np.array([0, end - at])
                at = end
        a = b


def runs(inside: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end of each run of bytes that are inside; a run ends with its row."""
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1]
    last[:-1] &= ~inside[1:]
    full = off[1:] > off[:-1]
    a, b = off[:-1][full], off[1:][full] - 1
    first[a], last[b] = inside[a], inside[b]
    return np.flatnonzero(first), np.flatnonzero(last) + 1


def ranges(start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """All positions of the ranges, one after another."""
    return np.repeat(start - (np.cumsum(length) - length), length) + np.arange(int(length.sum()))


def strings(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte ranges as an Arrow string column."""
    off = np.concatenate([[0], np.cumsum(end - start)]).astype(np.int64)
    body = np.ascontiguousarray(data[ranges(start, end - start)])
    return pa.LargeStringArray.from_buffers(len(start), pa.py_buffer(off), pa.py_buffer(body)).cast(pa.string())


def byte_table(separators) -> np.ndarray:
    table = np.ones(256, dtype=bool)
    table[list(separators)] = False
    return table


#: `[^\x20\x09-\x0D]+`
PLAIN = byte_table([0x20, *range(0x09, 0x0E)])
#: `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`, after A-Z are lower-cased
LETTERS = byte_table([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


class Words:
    """Words of the rows of a slice: byte range, row, hash; ``off`` has each row's first word."""

    def __init__(self, column, lower: bool = False, seeds: tuple[int, ...] = (1,)):
        data, self.row_bytes = text_bytes(column)
        if lower:
            data = LOWER[data]
        self.data, self.n_rows = data, len(column)
        inside = (LETTERS if lower else PLAIN)[data]
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        full = self.row_bytes[1:] > self.row_bytes[:-1]
        a, b = self.row_bytes[:-1][full], self.row_bytes[1:][full] - 1
        first[a], last[b] = inside[a], inside[b]
        self.start, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        self.off = np.searchsorted(self.start, self.row_bytes)
        self.count = np.diff(self.off)
        self.row = np.repeat(np.arange(self.n_rows), self.count)
        self.hashes = []
        for seed in seeds:
            self.hashes.append(ranged(prefix(spread(256, seed)[data], seed), self.start, self.end, seed))
        self.hash = self.hashes[0] if seeds else None

    def __len__(self) -> int:
        return len(self.start)

    def windows(self, k: int, at: np.ndarray | None = None, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """First word and hash of each run of ``k`` words of one row (of those that start ``at``, if given)."""
        n = len(self)
        if at is None:
            at = np.arange(max(0, n - k + 1))
        else:
            at = at[at + k <= n]
        at = at[self.row[at] == self.row[at + k - 1]] if len(at) else at
        seed = 11 + which
        return at, ranged(prefix(self.hashes[which], seed), at, at + k, seed)

    def by_row(self, values: np.ndarray) -> np.ndarray:
        """Sum of a value of each word, per row."""
        sums = np.zeros(len(values) + 1, dtype=np.int64)
        np.cumsum(values, out=sums[1:])
        return sums[self.off[1:]] - sums[self.off[:-1]]


def repeated(values: np.ndarray) -> np.ndarray:
    """Which values occur twice or more."""
    order = np.sort(values)
    again = np.unique(order[1:][order[1:] == order[:-1]])
    if not len(again):
        return np.zeros(len(values), dtype=bool)
    at = np.minimum(np.searchsorted(again, values), len(again) - 1)
    return again[at] == values


def covered(n: int, start: np.ndarray, length) -> np.ndarray:
    """Which of ``n`` positions lie in one of the ranges."""
    if not len(start):
        return np.zeros(n, dtype=bool)
    change = np.bincount(start, minlength=n + 1) - np.bincount(start + length, minlength=n + 1)
    return np.cumsum(change[:n]) > 0


def row_salt(rows: np.ndarray) -> np.ndarray:
    """A 64-bit value for each row number, to keep equal hashes of different rows apart."""
    return mix(rows.astype(U) + U(0x51_7C_C1_B7_27_22_0A_95))
