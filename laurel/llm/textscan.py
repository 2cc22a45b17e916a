"""Vectorised reading of texts inside tasks, and a key filter of fixed size.

``Words`` finds the words of a whole Arrow column of texts at once, as places in its byte
buffer; ``KeyFilter`` lets the driver tell every task which keys may matter without ever
holding the keys themselves.
"""

from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from laurel.llm.common import mix64

WORD, GAP, BREAK = 0, 1, 2
_LOWER = bytes(b + 32 if 65 <= b < 91 else b for b in range(256))
_FIRST_BYTES = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
_LONG = 4096  # longer words are hashed one by one
_BLOCK = 1 << 18  # bytes worked on at once, so that long texts need no more memory than short ones


def byte_kinds(gaps: bytes, breaks: bytes = b"") -> np.ndarray:
    """What each byte is: part of a word, a gap between words, or a break words don't join over."""
    kinds = np.zeros(256, np.uint8)
    kinds[list(gaps)] = GAP
    kinds[list(breaks)] = BREAK
    return kinds


def _runs(starts, lengths):
    """Indexes of the bytes of all runs, one run behind the other."""
    begins = np.cumsum(lengths) - lengths
    return np.arange(int(lengths.sum())) + np.repeat(starts - begins, lengths), begins


def _blocks(lengths):
    """Slices of the runs that hold about ``_BLOCK`` bytes, one run at least."""
    ends = np.cumsum(lengths)
    i = 0
    while i < len(lengths):
        j = max(i + 1, int(np.searchsorted(ends, (ends[i - 1] if i else 0) + _BLOCK, "right")))
        yield i, j
        i = j


def gather(data: np.ndarray, starts, lengths) -> pa.Array:
    """The byte runs as an Arrow binary column."""
    ends = np.zeros(len(starts) + 1, np.int64)
    np.cumsum(lengths, out=ends[1:])
    out = np.empty(int(ends[-1]), np.uint8)
    for i, j in _blocks(lengths):
        out[ends[i] : ends[j]] = data[_runs(starts[i:j], lengths[i:j])[0]]
    return pa.Array.from_buffers(
        pa.large_binary(), len(starts), [None, pa.py_buffer(ends), pa.py_buffer(out)]
    ).cast(pa.binary())


class Words:
    """Words of a column of texts, A-Z lower-cased: ``doc, starts, lengths, piece`` arrays.

    Words of one piece have no break byte and no end of a text between them.  A null text
    has no words.
    """

    def __init__(self, texts: pa.Array, kinds: np.ndarray):
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        _, offsets, data = texts.buffers()
        offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
        # ``translate`` looks bytes up several times as fast as indexing does
        raw = data[int(offsets[0]) : int(offsets[-1])].to_pybytes() if data else b""
        offsets = offsets - offsets[0]
        self.data = np.zeros(len(raw) + 8, np.uint8)  # eight bytes can be read at any place
        self.data[: len(raw)] = np.frombuffer(raw.translate(_LOWER), np.uint8)
        kind = np.frombuffer(raw.translate(kinds.tobytes()), np.uint8)
        inside = kind == WORD
        first, last = inside.copy(), inside.copy()
        first[1:] &= ~inside[:-1]
        last[:-1] &= ~inside[1:]
        edges = offsets[:-1][offsets[:-1] < offsets[1:]]
        first[edges] = inside[edges]
        last[edges[1:] - 1] = inside[edges[1:] - 1]
        self.starts = np.flatnonzero(first)
        self.lengths = np.flatnonzero(last) + 1 - self.starts
        self.doc = np.searchsorted(offsets, self.starts, "right") - 1
        self.breaks = kind == BREAK

    def __len__(self):
        return len(self.starts)

    @cached_property
    def piece(self) -> np.ndarray:
        """Worked out when asked for, as not every scan needs it."""
        return np.searchsorted(np.flatnonzero(self.breaks), self.starts) + self.doc

    def select(self, keep: np.ndarray) -> "Words":
        """The words of a mask or list of places."""
        some = object.__new__(Words)
        some.data, some.breaks = self.data, self.breaks
        some.starts, some.lengths, some.doc = (a[keep] for a in (self.starts, self.lengths, self.doc))
        return some

    def hashes(self, seed: int, most: int | None = None) -> np.ndarray:
        """64-bit hashes of the words, or of their first ``most`` bytes."""
        lengths = self.lengths if most is None else np.minimum(self.lengths, most)
        eights = np.ndarray((len(self.data) - 7,), "<u8", self.data, strides=(1,))
        out = mix64(lengths.astype(np.uint64) + np.uint64(seed << 40))
        at, left, start = np.flatnonzero(lengths <= _LONG), lengths, self.starts
        if len(at) < len(lengths):
            for i in np.flatnonzero(lengths > _LONG):
                whole = self.data[self.starts[i] : self.starts[i] + lengths[i]].tobytes()
                out[i] = xxhash.xxh3_64_intdigest(whole, seed)
            left, start = lengths[at], start[at]
        while len(at):
            value = eights[start] & _FIRST_BYTES[np.minimum(left, 8)]
            out[at] = mix64((out[at] ^ value) * np.uint64(0x9E3779B97F4A7C15))
            more = left > 8
            at, left, start = at[more], left[more] - 8, start[more] + 8
        return out

    def spaced(self) -> tuple[np.ndarray, np.ndarray]:
        """All words with one space behind each: the bytes, and where each word starts."""
        ends = np.cumsum(self.lengths + 1)
        out = np.full(int(ends[-1]) if len(ends) else 0, 32, np.uint8)
        starts = ends - self.lengths - 1
        for i, j in _blocks(self.lengths):
            source, _ = _runs(self.starts[i:j], self.lengths[i:j])
            target, _ = _runs(starts[i:j], self.lengths[i:j])
            out[target] = self.data[source]
        return out, starts

    def phrases(self, at: np.ndarray, k: int) -> pa.Array:
        """The ``k`` words from each of these places on, joined by single spaces."""
        some = self.select((at[:, None] + np.arange(k)).ravel())
        data, starts = some.spaced()
        sizes = (some.lengths + 1).reshape(len(at), k).sum(axis=1)
        return gather(data, starts[::k], sizes - 1).cast(pa.string())


def grouped(first: np.ndarray, second: np.ndarray, stable=False):
    """Runs of equal 128-bit keys: ``(order, begins)``; members keep their order if ``stable``.

    Two keys that agree in the first half only may come as several runs, never as one.
    """
    order = np.argsort(first, kind="stable" if stable else None)
    a, b = first[order], second[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order, np.flatnonzero(new)


class KeyFilter:
    """A Bloom filter of fixed size: never misses a key that is in it.

    A key sets four bits of one 64-bit word.  However many keys there are, the filter and
    what builds it have at most ``SIZE`` words; a full filter lets more other keys through,
    which costs work but changes no result, since all results are counted exactly.
    """

    SIZE = 1 << 20

    def __init__(self, words: np.ndarray | None = None):
        self.words = np.zeros(self.SIZE, np.uint64) if words is None else words

    @staticmethod
    def places(keys: np.ndarray, size: int):
        """The word of each key in a filter of ``size`` words (a power of two), and its bits."""
        one, six = np.uint64(1), np.uint64(63)
        bits = np.zeros(len(keys), np.uint64)
        for shift in (20, 26, 32, 38):
            bits |= one << ((keys >> np.uint64(shift)) & six)
        return (keys & np.uint64(size - 1)).astype(np.int64), bits

    def has(self, keys: np.ndarray) -> np.ndarray:
        where, bits = self.places(keys, len(self.words))
        return (self.words[where] & bits) == bits

    def with_keys(self, rows: DataFrame, hashes) -> "KeyFilter":
        """This filter and the keys of all rows; ``hashes`` maps Arrow batches to 64-bit keys.

        Bits are put together on Spark; at most one row a filter word comes to the driver.
        """
        size = len(self.words)

        def bits_of(batches):
            for batch in batches:
                where, bits = KeyFilter.places(hashes(batch), size)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(where), pa.array(bits.view(np.int64))], ["place", "bits"]
                )

        found = rows.mapInArrow(bits_of, "place long, bits long")
        parts = found.groupBy("place").agg(F.expr("bit_or(bits)").alias("bits")).toArrow()
        words = self.words.copy()
        words[parts["place"].to_numpy()] |= parts["bits"].to_numpy().view(np.uint64)
        return KeyFilter(words)

    def same(self, other: "KeyFilter") -> bool:
        return bool(np.array_equal(self.words, other.words))
