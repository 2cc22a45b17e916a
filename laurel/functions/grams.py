"""Hashes of the byte substrings of whole Arrow columns of names.

A substring whose size is a power of two is hashed from its two halves; any other from the
two such substrings that cover it.  All places of a column are worked out at once.
"""

from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

ODD = np.uint64(0x9E3779B97F4A7C15)
WHOLE = 16  # bytes; names up to this size are known by the hash of the whole name
SLICE = 1 << 20  # bytes worked on at once, one name at least


def _mix(x):
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _joined(left, right):
    return _mix(left * ODD + (right << np.uint64(1)) + np.uint64(1))


def key_size(lengths: np.ndarray) -> np.ndarray:
    """The size of the substring that a name of so many bytes is filed under: more than half of it."""
    power = np.int64(1) << (np.frexp(lengths.astype(float))[1] - 1).astype(np.int64)
    return np.where(lengths <= WHOLE, lengths, power)


class Names:
    """Names of a column, with the hashes of their substrings."""

    def __init__(self, names: pa.Array):
        names = names.cast(pa.large_binary())
        _, offsets, data = names.buffers()
        offsets = np.frombuffer(offsets, np.int64)[names.offset : names.offset + len(names) + 1]
        self.data = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
        self.starts = offsets[:-1] - offsets[0]
        self.lengths = np.diff(offsets)
        self.row = np.repeat(np.arange(len(names)), self.lengths)
        self.left = np.repeat(self.starts + self.lengths, self.lengths) - np.arange(len(self.data))
        self.powers = [_mix(self.data.astype(np.uint64) + ODD)]

    def _power(self, k):
        while len(self.powers) <= k:
            half, h = 1 << (len(self.powers) - 1), self.powers[-1]
            h = np.append(h, np.zeros(half, np.uint64))
            self.powers.append(_joined(h[:-half], h[half:]))
        return self.powers[k]

    def of_size(self, size: int) -> np.ndarray:
        """The hash of the substring of ``size`` bytes from each byte on; see ``left`` for those that end in their name."""
        k = int(size).bit_length() - 1
        h, apart = self._power(k), size - (1 << k)
        if apart:
            longer = np.append(h, np.zeros(apart, np.uint64))
            h = _joined(longer[:-apart], longer[apart:])
        return _mix(h ^ np.uint64(size))

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Rows and keys: the hash of a whole name, or of the first, last and least substring of its size."""
        sizes, rows, keys = key_size(self.lengths), [], []
        for size in np.unique(sizes):
            of = np.flatnonzero(sizes == size)
            h = self.of_size(size)
            inside = (self.left >= size) & (sizes[self.row] == size)
            begins = np.flatnonzero(np.diff(self.row[inside], prepend=-1))
            ends = self.starts[of] + self.lengths[of] - size
            whole = self.lengths[of] == size
            for key in (h[self.starts[of]], h[ends], np.minimum.reduceat(h[inside], begins)):
                rows.append(of)
                keys.append(key)
            keep = np.flatnonzero(~whole)
            rows[-2:], keys[-2:] = [r[keep] for r in rows[-2:]], [k[keep] for k in keys[-2:]]
        empty = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
        return np.concatenate(rows or empty[0]), np.concatenate(keys or empty[1])


def slices(batches, column: str):
    """Arrow batches cut to about ``SLICE`` bytes of the column, one row at least."""
    for batch in batches:
        ends = np.cumsum(pc.binary_length(batch.column(column)).to_numpy(zero_copy_only=False))
        borders = np.searchsorted(ends, np.arange(SLICE, ends[-1], SLICE)) if len(ends) else []
        for begin, end in pairwise(np.unique([0, *borders, len(ends)])):
            yield batch.slice(begin, end - begin)
