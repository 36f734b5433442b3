"""Words, hashes and shingles of whole Arrow batches of texts, without a Python step per word.

A batch of texts is one UTF-8 byte buffer with offsets.  Word bounds come from a byte class table,
word hashes from prefix sums of a polynomial over the bytes, and hashes of runs of words from prefix
sums over the word hashes, so every step is a NumPy pass.  Memory follows SLICE_BYTES, or the longest
single text where that is longer.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import lru_cache, wraps

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text that are worked on at once.
SLICE_BYTES = 2 << 20

U = np.uint64
_P, _Q = 0x9E3779B97F4A7C15, 0xD6E8FEB86659FD93  # odd multipliers over bytes and over words
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser."""
    x = x.astype(U, copy=True)
    x ^= x >> U(30)
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


_BYTES = mix(np.arange(1, 257, dtype=U) * U(_P))


@lru_cache(maxsize=8)
def _powers(base: int, bits: int) -> np.ndarray:
    out = np.full(1 << bits, base, U)
    out[0] = 1
    return np.cumprod(out, dtype=U)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64."""
    return _powers(base, max(10, int(n).bit_length()))[:n]


def table(chars) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(chars)] = True
    return out


#: Bytes of words that only white space (x20, x09 to x0D) parts.
SOLID = ~table([0x20, *range(0x09, 0x0E)])
#: Bytes of letters and digits; every byte of a character beyond ASCII counts as a letter.
ALNUM = table([*range(0x30, 0x3A), *range(0x41, 0x5B), 0x5F, *range(0x61, 0x7B), *range(0x80, 0x100)])


@dataclass
class Words:
    """Words of n texts: word i is data[start[i]:stop[i]]; text d has the words first[d] to first[d+1]."""

    data: np.ndarray
    off: np.ndarray
    start: np.ndarray
    stop: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def hashes(self) -> np.ndarray:
        """A 64-bit hash of the bytes of each word."""
        n = len(self.data)
        if not len(self.start):
            return np.zeros(0, U)
        sums = np.zeros(n + 1, U)
        np.cumsum(_BYTES[self.data] * powers(_P, n), out=sums[1:])
        inverse = powers(pow(_P, -1, 1 << 64), n)
        return mix((sums[self.stop] - sums[self.start]) * inverse[self.start] + (self.stop - self.start).astype(U))


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of texts; a null is an empty text."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts, "")
    wide = pa.types.is_large_string(texts.type)
    if not len(texts):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(texts.buffers()[1], np.int64 if wide else np.int32)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8)[off[0] : off[-1]] if buffer is not None and buffer.size else np.zeros(0, np.uint8)
    return data, off - off[0]


def words(data: np.ndarray, off: np.ndarray, kind: np.ndarray) -> Words:
    """Cut each text into its longest runs of bytes for which kind holds."""
    n = len(data)
    inside = np.zeros(n + 2, bool)
    inside[1:-1] = kind[data]
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    at = off[1:-1]
    at = at[(at > 0) & (at < n)]
    begins[at] = inside[at + 1]
    ends[at - 1] = inside[at]
    start, stop = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(data, off, start, stop, np.searchsorted(start, off))


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of every n consecutive items, the first at each index (len - n + 1 of them)."""
    if len(hashes) < n:
        return np.zeros(0, U)
    sums = np.zeros(len(hashes) + 1, U)
    np.cumsum(hashes * powers(_Q, len(hashes)), out=sums[1:])
    return mix((sums[n:] - sums[:-n]) * powers(pow(_Q, -1, 1 << 64), len(hashes))[: len(hashes) - n + 1] + U(n))


def wholes(hashes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A hash of all words of each text, in order."""
    sums = np.zeros(len(hashes) + 1, U)
    np.cumsum(hashes * powers(_Q, len(hashes)), out=sums[1:])
    inverse = powers(pow(_Q, -1, 1 << 64), len(hashes) + 1)
    return mix((sums[first[1:]] - sums[first[:-1]]) * inverse[first[:-1]] + np.diff(first).astype(U))


def shingles(hashes: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word shingles of each text and their offsets; a text of 1 to n-1 words has one, of all its words."""
    count = np.diff(first)
    size = np.where(count == 0, 0, np.maximum(count - n + 1, 1))
    offs = np.concatenate([[0], np.cumsum(size)]).astype(np.int64)
    out = np.zeros(offs[-1], U)
    long = count >= n
    if long.any():
        full = runs(hashes, n)
        where = np.arange(offs[-1], dtype=np.int64) + np.repeat(first[:-1] - offs[:-1], size)
        keep = np.repeat(long, size)
        out[keep] = full[where[keep]]
    short = np.flatnonzero((count > 0) & ~long)
    if len(short):
        out[offs[short]] = wholes(hashes, first)[short]
    return out, offs


def normal_words(texts: pa.Array) -> Words:
    """Words of letters and digits of the lower-cased texts."""
    return words(*utf8(pc.utf8_lower(pc.fill_null(texts, ""))), ALNUM)


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """The rows of the batches, in batches of about SLICE_BYTES of text (or one text)."""
    for batch in batches:
        _, off = utf8(batch.column(column))
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(off, off[at] + SLICE_BYTES, "right")) - 1)
            yield batch.slice(at, to - at)
            at = to


def pieces(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in parts of about SLICE_BYTES (or one text)."""
    for batch in slices(iter([pa.RecordBatch.from_arrays([texts], ["text"])])):
        yield batch.column(0)


def segment_sums(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of values[first[d]:first[d+1]] for each d, empty ones too."""
    sums = np.concatenate([[0], np.cumsum(values)])
    return sums[first[1:]] - sums[first[:-1]]


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def release() -> None:
    """Give freed memory back to the system: Python workers outlive their tasks, and what they keep counts against the executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # a C library without it
        pass


def tidy(step: Callable) -> Callable:
    """A step over batches that gives its memory back as the task ends."""

    @wraps(step)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from step(batches)
        release()

    return run
