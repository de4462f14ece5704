"""Vectorised helpers over the UTF-8 buffers of Arrow text columns.

Words are maximal runs of bytes other than 0x20 and 0x09..0x0D; in UTF-8 these
are whole characters, so words can be cut from the bytes without decoding.
"""

from __future__ import annotations

import contextlib
import ctypes
import gc
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

U64 = np.uint64
BATCH_ROWS = 250
SLICE_BYTES = 1 << 20  # text handled at once; one longer text is a slice of its own

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_BASE = U64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every input bit over the whole word (a 64-bit finaliser)."""
    h = h ^ (h >> U64(30))
    h = h * U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


_BYTE = mix(np.arange(1, 257, dtype=U64) * _BASE)
_LOWER = _BYTE.copy()
_LOWER[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]


def powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(max(n, 1), base, U64)
    out[0] = 1
    return np.multiply.accumulate(out)


class Powers:
    """Powers of a base, grown on demand and kept by the worker."""

    def __init__(self, base: np.uint64) -> None:
        self.base, self.have = base, powers(base, 1 << 12)

    def upto(self, n: int) -> np.ndarray:
        if len(self.have) < n:
            self.have = powers(self.base, max(n, 2 * len(self.have)))
        return self.have[:n]

    def trim(self) -> None:
        if len(self.have) > 4 * SLICE_BYTES:
            self.have = powers(self.base, 1 << 12)


_UP, _DOWN = Powers(_BASE), Powers(_INVERSE)


def as_large(text: pa.Array) -> pa.Array:
    """A string column without nulls (null is empty) and with 64-bit offsets."""
    if isinstance(text, pa.ChunkedArray):
        text = text.combine_chunks()
    return pc.fill_null(text.cast(pa.large_string()), "")


def buffer_of(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets from 0) of a large_string column without nulls."""
    text = as_large(text)
    offsets = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, text.offset * 8)
    data = text.buffers()[2]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[offsets[0] : offsets[-1]], offsets - offsets[0]


def string_array(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    """The reverse of buffer_of; the bytes must be valid UTF-8."""
    return pa.LargeStringArray.from_buffers(
        len(offsets) - 1, pa.py_buffer(np.ascontiguousarray(offsets, np.int64)), pa.py_buffer(np.ascontiguousarray(data))
    )


def small_batches(docs: DataFrame) -> DataFrame:
    """Have Spark hand texts to Python some at a time.

    Ten thousand long texts, Spark's default, can be hundreds of MB in each worker
    and beside it in the JVM. The session's setting is lowered, never raised.
    """
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    conf = docs.sparkSession.conf
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))
    return docs


def release() -> None:
    """Give freed memory back: workers live on and meet tasks of other operators."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only where the C library has it
        ctypes.CDLL(None).malloc_trim(0)


def slices(batches: Iterator[pa.RecordBatch], text: str, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about ``most`` bytes of text, or one row."""
    release()
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        at, total, start = 0, 0, 0
        for at, n in enumerate(lengths.tolist()):
            if at > start and total + n > most:
                yield batch.slice(start, at - start)
                start, total = at, 0
            total += n
        if batch.num_rows > start:
            yield batch.slice(start)
    release()


@dataclass
class Words:
    """The words of a slice: where they are, whose they are, and their hashes."""

    raw: np.ndarray
    offsets: np.ndarray  # of documents, in bytes
    start: np.ndarray  # byte where each word starts
    end: np.ndarray
    first: np.ndarray  # of documents, in words; one more entry than documents
    hash: np.ndarray

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


_LETTER = np.zeros(256, bool)
_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_MARK = np.zeros(256, bool)  # ASCII that is neither letter, digit, space nor control
_MARK[[*range(0x21, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x7F)]] = True


def words_of(text: pa.Array, lower: bool = False, cut_marks: bool = False) -> Words:
    """Cut the words and hash each to 64 bits.

    ``lower``: A-Z count as a-z. ``cut_marks``: a word also ends where an ASCII
    mark follows an ASCII letter.
    """
    raw, offsets = buffer_of(text)
    n = len(raw)
    inside = np.zeros(n + 2, bool)
    np.logical_not(_SPACE[raw], out=inside[1:-1])
    # A word ends with its document, whatever byte the next document starts with.
    change = inside[1:] != inside[:-1]
    starts, ends = change.copy(), change.copy()
    starts[:-1] &= inside[1:-1]
    starts[-1] = False
    ends &= inside[:-1]
    cut = offsets[1:-1]
    cut = cut[(cut > 0) & (cut < n)]
    cut = cut[inside[cut] & inside[cut + 1]]
    starts[cut] = True
    ends[cut] = True
    if cut_marks and n:
        cut = np.flatnonzero(_LETTER[raw[:-1]] & _MARK[raw[1:]]) + 1
        starts[cut] = True
        ends[cut] = True
    start, end = np.flatnonzero(starts), np.flatnonzero(ends)
    first = np.searchsorted(start, offsets)
    return Words(raw, offsets, start, end, first, span_hashes(raw, start, end, lower))


def span_hashes(raw: np.ndarray, start: np.ndarray, end: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each byte span, from one running sum over the slice."""
    if not len(start):
        return np.zeros(0, U64)
    total = running_sum(raw, lower)
    h = (total[end] - total[start]) * inverse_powers(len(raw))[start]
    return mix(h + (end - start).astype(U64) * U64(0xD6E8FEB86659FD93))


def running_sum(raw: np.ndarray, lower: bool = False) -> np.ndarray:
    """Sums of bytes times powers: differences, times the inverse power of their start, are hashes of spans."""
    n = len(raw)
    values = (_LOWER if lower else _BYTE)[raw]
    values *= _UP.upto(n)
    total = np.zeros(n + 1, U64)
    np.cumsum(values, out=total[1:])
    _UP.trim()
    return total


def inverse_powers(n: int) -> np.ndarray:
    out = _DOWN.upto(n)
    _DOWN.trim()
    return out


def window_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """Hash of each window of ``size`` consecutive entries, ignoring where documents end."""
    n = len(h) - size + 1
    if n <= 0:
        return np.zeros(0, U64)
    out = np.zeros(n, U64)
    for i in range(size):
        out *= _BASE
        out += h[i : i + n]
    return mix(out)


def within(first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts of the windows of ``size`` words that stay in one document, and their documents."""
    counts = np.maximum(np.diff(first) - size + 1, 0)
    doc = np.repeat(np.arange(len(counts)), counts)
    return np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts) + first[doc], doc


def gather(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Indices start, start + 1, ... of each span, one after the other."""
    total = int(lengths.sum())
    shift = np.repeat(starts - (np.cumsum(lengths) - lengths), lengths)
    return np.arange(total) + shift


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


class WordIds:
    """Token ids of words by their hash, in sorted arrays; forgotten when over ``most`` words."""

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], most: int) -> None:
        self.encode, self.most = encode, most
        self.clear()

    def clear(self) -> None:
        self.hash, self.slot = np.zeros(0, U64), np.zeros(0, np.int64)
        self.ids, self.start = np.zeros(0, np.int32), np.zeros(1, np.int64)

    def of(self, words: Words, lower: bool) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words one after the other, number of ids of each word)."""
        if len(self.hash) > self.most:
            self.clear()
        found, at, inverse = np.unique(words.hash, return_index=True, return_inverse=True)
        place = np.searchsorted(self.hash, found)
        known = np.zeros(len(found), bool)
        inside = place < len(self.hash)
        known[inside] = self.hash[place[inside]] == found[inside]
        if not known.all():
            new = np.flatnonzero(~known)
            raw = words.raw.tobytes()
            raw = raw.lower() if lower else raw
            spans = zip(words.start[at[new]].tolist(), words.end[at[new]].tolist(), strict=True)
            ids, counts = self.encode([raw[a:b].decode() for a, b in spans])
            self.slot = np.insert(self.slot, place[new], len(self.start) - 1 + np.arange(len(new)))
            self.hash = np.insert(self.hash, place[new], found[new])
            self.ids = np.append(self.ids, ids.astype(np.int32))
            self.start = np.append(self.start, self.start[-1] + np.cumsum(counts))
        slot = self.slot[np.searchsorted(self.hash, found)][inverse]
        lengths = self.start[slot + 1] - self.start[slot]
        return self.ids[gather(self.start[slot], lengths)], lengths
