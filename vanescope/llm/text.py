"""Whole texts as byte arrays: words, their hashes and shingles, many documents at a time.

All functions work inside a task on Arrow batches. A batch is cut into chunks of whole
documents; a chunk holds ``CHUNK_BYTES`` or one longer document, so memory follows the
longest document and not the batch.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 19

# Only the GNU C library has it.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)

_STEP = np.uint64(0x9E3779B97F4A7C15)
_STEP_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

# The bytes that separate words of the pattern [^\x20\x09-\x0D]+.
SPACES = (0x20, *range(0x09, 0x0E))
SPACE_WORD = np.ones(256, bool)
SPACE_WORD[list(SPACES)] = False

# Words of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ after lower-casing: digits, a-z, other scripts.
ALNUM_WORD = np.zeros(256, bool)
ALNUM_WORD[0x30:0x3A] = ALNUM_WORD[0x61:0x7B] = ALNUM_WORD[0x80:] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

_BYTE_VALUES = np.random.default_rng(20240101).integers(1, 1 << 63, 256, np.uint64) | np.uint64(1)
_SLOTS = np.random.default_rng(20240102).integers(1, 1 << 63, 64, np.uint64) | np.uint64(1)


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, bounds of the documents in the bytes); NULL is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if texts.null_count:
        texts = pc.fill_null(texts, "")
    if not pa.types.is_large_string(texts.type):
        texts = texts.cast(pa.large_string())
    n = len(texts)
    if not n:
        return
    _, offsets, values = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        end = int(np.searchsorted(bounds, bounds[first] + limit, "right")) - 1
        end = min(max(end, first + 1), n)
        yield first, end, data[bounds[first] : bounds[end]], bounds[first : end + 1] - bounds[first]
        first = end
    give_back()


def give_back() -> None:
    """Return freed memory to the system: a worker lives on after its task and would keep the most
    that any of its tasks has held, beside those of other tasks and Spark's own."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def mix(h: np.ndarray) -> np.ndarray:
    """Finish a hash in place, so that every input bit reaches every output bit."""
    h ^= h >> np.uint64(30)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class _Powers:
    """Powers of the step and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, base in (("up", _STEP), ("down", _STEP_INVERSE)):
                powers = np.full(size, base)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))
        return self.up, self.down


_powers = _Powers()


class Words:
    """Words of a chunk: byte positions, documents and 64-bit hashes."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, is_word: np.ndarray = SPACE_WORD, lower: bool = False):
        if lower:
            data = LOWER[data]
        n = len(data)
        inside = is_word[data]
        first = inside.copy()
        last = inside.copy()
        if n:
            first[1:] &= ~inside[:-1]
            last[:-1] &= ~inside[1:]
            inner = bounds[(bounds > 0) & (bounds < n)]
            first[inner] = inside[inner]
            last[inner - 1] = inside[inner - 1]
        self.starts = np.flatnonzero(first)
        self.ends = np.flatnonzero(last) + 1
        #: Words of document i are bounds[i] to bounds[i + 1].
        self.bounds = np.searchsorted(self.starts, bounds)
        self.counts = np.diff(self.bounds)
        up, down = _powers.get(n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(_BYTE_VALUES[data] * up[:n], out=total[1:])
        self.hashes = mix((total[self.ends] - total[self.starts]) * down[self.starts])

    def ends_of_documents(self) -> np.ndarray:
        """For each word, the end of its document."""
        return np.repeat(self.bounds[1:], self.counts)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Hash of the k words from each word on, and whether they are in one document."""
        n = len(self.hashes)
        out = np.zeros(n, np.uint64)
        for j in range(min(k, n)):
            out[: n - j] += self.hashes[j:] * _SLOTS[j]
        return mix(out), np.arange(k, n + k) <= self.ends_of_documents()

    def whole(self, document: int) -> np.ndarray:
        """Hash of all words of a document as one sequence, in an array of length one."""
        own = self.hashes[self.bounds[document] : self.bounds[document + 1]]
        out = np.array([len(own)], np.uint64)
        for h in own:
            out = mix(out * _SLOTS[0] + h)
        return out


def from_little_endian(values: list[bytes], width: int) -> pa.Array:
    """Fixed-size byte strings as a binary column."""
    return pa.array(values, pa.binary(width)).cast(pa.binary())
