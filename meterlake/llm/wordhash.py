"""Words of Arrow text columns and their hashes, vectorised over whole batches.

A word is a maximal run of bytes other than space and 0x09-0x0D.  Its hash is the sum of one
random 64-bit number for each pair of place and byte, mixed with its length.  (A polynomial in the
bytes modulo 2**64 would not do: words built by doubling and swapping agree under any odd base.)
Windows of words are Rabin-Karp polynomials over those hashes: prefix sums of ``symbol * base**i``,
so the hash of any range is one difference, moved to exponent zero by the inverse power.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute

#: Odd bases of the two independent lanes, and the bytes hashed at a time.
BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
BLOCK = 1 << 18
#: Places of a word whose numbers are looked up; those of later places are computed.
PLACES = 48

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x = x * np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _draw(key: np.ndarray, lane: int) -> np.ndarray:
    """A random number for each key, of two rounds of mixing with the lane's base between them."""
    return mix(mix(key + np.uint64(BASES[lane])) ^ np.uint64(BASES[1 - lane]))


@functools.lru_cache(maxsize=2)
def _place_table(lane: int) -> np.ndarray:
    return _draw(np.arange(PLACES << 8, dtype=np.uint64), lane)


@functools.lru_cache(maxsize=8)
def _powers(base: int, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def range_hashes(symbols: np.ndarray, start: np.ndarray, end: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of symbols[start:end] for each pair; independent of where the range lies."""
    size = 1 << max(10, int(len(symbols)).bit_length())
    power, inverse = _powers(base, size), _powers(pow(base, -1, 1 << 64), size)
    total = np.zeros(len(symbols) + 1, np.uint64)
    np.cumsum(symbols.astype(np.uint64) * power[: len(symbols)], out=total[1:])
    return (total[end] - total[start]) * inverse[start]


class Words:
    """The words of a run of texts: byte bounds, text of each word, and hashes by lane.

    ``first`` has one more entry than there are texts: text i holds the words
    first[i] to first[i + 1].  Null texts hold none.
    """

    def __init__(self, texts: pa.Array, lower: bool = False, space: np.ndarray = _SPACE):
        self.space = space
        texts = texts.cast(pa.large_string())
        lengths = np.asarray(texts.is_valid()) * 1
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
        base, stop = int(offsets[0]), int(offsets[-1])
        data = texts.buffers()[2]
        raw = np.frombuffer(data, np.uint8)[base:stop] if data is not None and stop > base else np.zeros(0, np.uint8)
        self.data = _LOWER[raw] if lower else raw
        self.bounds = offsets - base
        if len(texts) and not lengths.all():  # the bytes under a null are not promised to be none
            dead = np.flatnonzero(lengths == 0)
            if np.any(self.bounds[dead + 1] > self.bounds[dead]):
                self.__init__(pa.array([x or "" for x in texts.to_pylist()], pa.large_string()), lower, space)
                return
        solid = ~space[self.data]
        before = np.empty(len(solid), bool)
        if len(solid):
            before[0] = False
            before[1:] = solid[:-1]
            inner = self.bounds[:-1][self.bounds[:-1] < len(solid)]
            before[inner] = False
        self.start = np.flatnonzero(solid & ~before)
        after = np.ones(len(solid) + 1, bool)
        if len(solid):
            after[:-1] = ~solid
            after[self.bounds[1:]] = True
            after[-1] = True
            ends = np.flatnonzero(solid & after[1:]) + 1
        else:
            ends = np.zeros(0, np.int64)
        self.end = ends
        self.first = np.searchsorted(self.start, self.bounds)

    def __len__(self) -> int:
        return len(self.start)

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def hashes(self, lane: int = 0) -> np.ndarray:
        """64 bits per word, block by block so that long texts need no large tables."""
        out = np.empty(len(self), np.uint64)
        table = _place_table(lane)
        i = 0
        while i < len(self):
            j = max(i + 1, int(np.searchsorted(self.end, self.start[i] + BLOCK, side="right")))
            a, b = int(self.start[i]), int(self.end[j - 1])
            size = self.end[i:j] - self.start[i:j]
            at = np.repeat(self.start[i:j] - a, size)
            inner = np.arange(len(at)) - np.repeat(np.cumsum(size) - size, size)
            symbols = self.data[at + a + inner].astype(np.int64)
            if int(size.max()) <= PLACES:
                drawn = table[inner << 8 | symbols]
            else:
                drawn = table[np.minimum(inner, PLACES - 1) << 8 | symbols]
                far = np.flatnonzero(inner >= PLACES)
                drawn[far] = _draw((inner[far] << 8 | symbols[far]).astype(np.uint64), lane)
            total = np.zeros(len(drawn) + 1, np.uint64)
            np.cumsum(drawn, out=total[1:])
            ends = np.cumsum(size)
            out[i:j] = total[ends] - total[ends - size]
            i = j
        out += (self.end - self.start).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
        return mix(out)

    def names(self) -> pa.DictionaryArray:
        """The bytes of each word, equal words once in the dictionary."""
        offsets = np.concatenate(([0], np.cumsum(self.end - self.start))).astype(np.int64)
        solid = self.data[~self.space[self.data]]  # all words' bytes in a row, without an index for each byte
        parts = pa.Array.from_buffers(pa.large_binary(), len(self), [None, pa.py_buffer(offsets), pa.py_buffer(solid)])
        return parts.dictionary_encode()

    def ids(self) -> np.ndarray:
        """A number per word, equal for equal words and for those only: the bytes are compared."""
        return self.names().indices.to_numpy().astype(np.int64)


def windows(words: Words, hashed: np.ndarray, size: int, lane: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Start word and hash of every run of ``size`` words of one text."""
    counts = np.maximum(words.counts() - size + 1, 0)
    skip = words.first[:-1] - np.concatenate(([0], np.cumsum(counts)[:-1])) if len(counts) else np.zeros(0, np.int64)
    start = np.arange(int(counts.sum())) + np.repeat(skip, counts)
    out = np.empty(len(start), np.uint64)
    step = BLOCK
    for i in range(0, len(start), step):  # blocks bound the tables of powers
        s = start[i : i + step]
        a, b = int(s[0]), int(s[-1]) + size
        out[i : i + step] = range_hashes(hashed[a:b], s - a, s - a + size, BASES[lane])
    return start, mix(out)


def slices(batch: pa.RecordBatch, column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds at most ``most`` bytes of text, or one row."""
    lengths = np.nan_to_num(np.asarray(pa.compute.binary_length(batch.column(column)).cast(pa.float64()).fill_null(0)))
    total = np.concatenate(([0], np.cumsum(lengths)))
    i = 0
    while i < len(lengths):
        j = max(i + 1, int(np.searchsorted(total, total[i] + most, side="right")) - 1)
        yield batch.slice(i, j - i)
        i = j
