"""Words, word hashes and shingle hashes of Arrow text columns, computed on whole batches.

A batch is worked on in pieces of a megabyte, so memory stays bounded however long the
batch; one text is never split, and needs about 30 bytes of memory per byte of its own.
Nulls count as empty texts. All hashes are 64 bits wide and the same on every machine.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def byte_class(separators: str) -> np.ndarray:
    """True for each byte that belongs to a word; ``separators`` are ASCII characters."""
    table = np.ones(256, dtype=bool)
    table[[ord(c) for c in separators]] = False
    return table


#: Words are runs of anything but white space.
SPACED = byte_class(" \t\n\v\f\r")
#: Words are runs of digits, small letters and everything beyond ASCII.
ALNUM = byte_class("".join(map(chr, [*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])))


def free_name(stem: str, taken: Iterable[str]) -> str:
    """``stem``, or with underscores behind it: a name that is not among ``taken`` (Spark does
    not tell upper from lower case in names)."""
    used = {c.lower() for c in taken}
    while stem.lower() in used:
        stem += "_"
    return stem


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values (the finalizer of MurmurHash3)."""
    h = h ^ (h >> np.uint64(33))
    h *= np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64))
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        n = max(n, 1 << 16)
        tables = []
        for base in (_BASE, _INVERSE):
            steps = np.full(n, base, dtype=np.uint64)
            steps[0] = 1
            tables.append(np.multiply.accumulate(steps))
        _powers = (tables[0], tables[1])
    return _powers


def column_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column one after another, and where each text starts and ends."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) of runs of rows of up to PIECE_BYTES, or one row."""
    if not len(column):
        return
    raw, at = column_bytes(column)
    first = 0
    while first < len(at) - 1:
        end = int(np.searchsorted(at, at[first] + PIECE_BYTES, "right")) - 1
        end = min(max(end, first + 1), len(at) - 1)
        yield first, end, raw[at[first] : at[end]], at[first : end + 1] - at[first]
        first = end


class Words:
    """The words of some texts: ``start`` and ``end`` in ``data`` (lower-cased bytes), and
    ``row`` with the number of the first word of each text (one entry more at the end)."""

    def __init__(self, raw: np.ndarray, at: np.ndarray, word_bytes: np.ndarray):
        self.data = _LOWER[raw]
        inside = word_bytes[self.data]
        edges = at[(at > 0) & (at < len(raw))]
        opens = inside.copy()
        opens[1:] &= ~inside[:-1]
        opens[edges] = inside[edges]
        closes = inside.copy()
        closes[:-1] &= ~inside[1:]
        closes[edges - 1] = inside[edges - 1]
        self.start = np.flatnonzero(opens)
        self.end = np.flatnonzero(closes) + 1
        self.row = np.searchsorted(self.start, at)

    def hashes(self, prefix: int | None = None) -> np.ndarray:
        """A 64-bit hash of each word, or of its first ``prefix`` bytes."""
        out = np.empty(len(self.start), np.uint64)
        first = 0
        while first < len(out):
            low = self.start[first]
            end = max(first + 1, int(np.searchsorted(self.start, low + PIECE_BYTES)))
            part = self.data[low : self.end[end - 1]]
            power, inverse = _power_tables(len(part) + 1)
            total = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(_BYTE_VALUE[part] * power[: len(part)], out=total[1:])
            a, b = self.start[first:end] - low, self.end[first:end] - low
            if prefix is not None:
                b = np.minimum(b, a + prefix)
            out[first:end] = (total[b] - total[a]) * inverse[a]
            first = end
        return mix(out if prefix is None else out + np.uint64(prefix))

    def text(self, first: int, end: int) -> bytes:
        """Words ``first`` to ``end`` with single spaces between them."""
        return b" ".join(self.data[a:b].tobytes() for a, b in zip(self.start[first:end], self.end[first:end]))


def windows_hash(words: np.ndarray, size: int) -> np.ndarray:
    """A hash of the ``size`` words from each place on (those that reach past the end are left out)."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n].copy()
    for k in range(1, size):
        out *= np.uint64(_BASE)
        out += words[k : k + n]
    return mix(out + np.uint64(size))


def window_starts(row: np.ndarray, size: int) -> np.ndarray:
    """True for each word from which ``size`` words follow in the same text."""
    ok = np.zeros(int(row[-1]), bool)
    for a, b in zip(row[:-1], row[1:]):
        if b - a >= size:
            ok[a : b - size + 1] = True
    return ok


def sliding(values: np.ndarray, size: int, pick=np.minimum) -> np.ndarray:
    """The smallest (or largest) of the ``size`` values from each place on."""
    n = len(values) - size + 1
    if n <= 0:
        return values[:0]
    width, best = 1, values
    while width * 2 <= size:
        best = pick(best[:-width], best[width:])
        width *= 2
    return pick(best[:n], best[size - width : size - width + n]) if width < size else best[:n]
