"""Words, lines and their hashes over whole Arrow columns, inside Spark tasks.

Texts stay UTF-8 bytes: white space is ``[\\x20\\x09-\\x0D]`` and letters A-Z are lowered,
so that no byte of a longer character is ever touched. Every function takes nulls for
empty texts and has no limit on the length of a text; memory is bounded by ``blocks``.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 1 << 21
_SPAN = 1 << 17  # bytes hashed at once; words longer than this are hashed alone

_NOT_SPACE = np.ones(256, dtype=bool)
_NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32

_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))  # odd multipliers
_POWERS: dict = {}


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values (the finaliser of splitmix64)."""
    h = h.astype(np.uint64, copy=True)
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def _powers(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i mod 2**64 for i < n."""
    key = int(base)
    if key not in _POWERS or len(_POWERS[key][0]) < n:
        inverse = np.uint64(pow(key, -1, 1 << 64))
        pair = []
        for b in (base, inverse):
            steps = np.full(n, b, dtype=np.uint64)
            steps[:1] = 1
            pair.append(np.multiply.accumulate(steps))
        _POWERS[key] = tuple(pair)
    forward, back = _POWERS[key]
    return forward[:n], back[:n]


def buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and the n+1 offsets of its values."""
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) or pa.types.is_large_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    offsets = np.frombuffer(column.buffers()[1] or bytes(8), dtype=np.int64 if wide else np.int32)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, dtype=np.uint8)
    first = offsets[0] if len(offsets) else 0
    last = offsets[-1] if len(offsets) else 0
    return data[first:last], offsets - first


def blocks(batches: Iterator[pa.RecordBatch], name: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches holding about ``limit`` bytes of text, one row at least."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(name))
        _, offsets = buffers(column)
        start = 0
        while start < len(batch):
            stop = int(np.searchsorted(offsets, offsets[start] + limit, side="right")) - 1
            stop = min(max(stop, start + 1), len(batch))
            yield batch.slice(start, stop - start)
            start = stop
        pa.default_memory_pool().release_unused()  # workers stay, and what they hold adds up


class Words:
    """The words of a column.

    ``offsets`` has the first word of each row (and the number of all at its end),
    ``start`` and ``end`` the place of each word in ``data``. ``members`` says which bytes
    are part of a word; by default all but white space.
    """

    def __init__(self, column: pa.Array, lower: bool = False, members: np.ndarray = _NOT_SPACE):
        self.data, rows = buffers(column)
        if lower:
            self.data = _LOWER[self.data]
        inside = members[self.data]
        n = len(inside)
        before, after = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
        before[1:], after[:-1] = inside[:-1], inside[1:]
        before[rows[:-1][rows[:-1] < n]] = False
        after[rows[1:][rows[1:] > 0] - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.offsets = np.searchsorted(self.start, rows)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)

    def hashes(self, which: int = 0) -> np.ndarray:
        """A 64-bit hash of each word; ``which`` picks one of two independent ones."""
        base, n = _BASES[which], len(self.start)
        out = np.empty(n, dtype=np.uint64)
        length = self.end - self.start
        i = 0
        while i < n:
            if length[i] > _SPAN:
                out[i] = self._long(i, base)
                i += 1
                continue
            origin = self.start[i]
            j = int(np.searchsorted(self.start, origin + _SPAN, side="left"))
            long = np.flatnonzero(length[i:j] > _SPAN)
            j = i + int(long[0]) if len(long) else j
            piece = self.data[origin : self.end[j - 1]]
            forward, back = _powers(base, 2 * _SPAN)
            sums = np.zeros(len(piece) + 1, dtype=np.uint64)
            np.cumsum(_BYTE_VALUES[piece] * forward[: len(piece)], out=sums[1:])
            s, e = self.start[i:j] - origin, self.end[i:j] - origin
            out[i:j] = (sums[e] - sums[s]) * back[s]
            i = j
        return mix(out + length.astype(np.uint64) * base)

    def _long(self, i: int, base: np.uint64) -> np.uint64:
        total, scale = np.zeros(1, dtype=np.uint64), np.ones(1, dtype=np.uint64)
        forward, _ = _powers(base, 2 * _SPAN)
        for at in range(int(self.start[i]), int(self.end[i]), _SPAN):
            piece = self.data[at : min(at + _SPAN, int(self.end[i]))]
            total += scale * np.sum(_BYTE_VALUES[piece] * forward[: len(piece)], dtype=np.uint64)
            scale = scale * forward[_SPAN]
        return total[0]


def windows(hashes: np.ndarray, size: int, which: int = 0) -> np.ndarray:
    """Rabin-Karp hash of every ``size`` consecutive word hashes, by doubling.

    ``out[i]`` covers ``hashes[i : i + size]``; rows are not told apart, see ``inside``.
    """
    base = int(_BASES[which])
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, dtype=np.uint64)
    part, width, done, total = hashes, 1, 0, None
    rest = size
    while rest:
        if rest & 1:
            shifted = part[done : len(part)] if done else part
            if total is None:
                total = shifted.copy()
            else:
                m = min(len(total), len(shifted))
                total = total[:m] * np.uint64(pow(base, width, 1 << 64)) + shifted[:m]
            done += width
        rest >>= 1
        if rest:
            part = part[: len(part) - width] * np.uint64(pow(base, width, 1 << 64)) + part[width:]
            width *= 2
    return mix(total[:n])


def inside(offsets: np.ndarray, size: int) -> np.ndarray:
    """Positions at which ``size`` words of one row start."""
    counts = np.maximum(np.diff(offsets) - size + 1, 0)
    total = int(counts.sum())
    ends = np.cumsum(counts)
    return np.arange(total) + np.repeat(offsets[:-1] - (ends - counts), counts)


def distinct_per_row(values: np.ndarray, rows: np.ndarray, n_rows: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct values of each row and their n_rows+1 offsets; ``rows`` ascends."""
    order = np.lexsort((values, rows))
    values, rows = values[order], rows[order]
    keep = np.ones(len(values), dtype=bool)
    keep[1:] = (values[1:] != values[:-1]) | (rows[1:] != rows[:-1])
    values, rows = values[keep], rows[keep]
    return values, np.searchsorted(rows, np.arange(n_rows + 1))
