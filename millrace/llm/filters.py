"""Bit filters over 64-bit hashes of a whole corpus, built by Spark and shared with every task.

A filter answers "may have occurred once" and "may have occurred at least twice";
it never misses a hash that did. Its size follows the number of hashes up to
MOST_BITS, so what is broadcast is bounded; beyond that it lets more pass, which
costs time and changes no result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import textops as tx

U64 = np.uint64
SEGMENTS = 256  # by the top 8 bits of a hash
BITS_EACH = 8  # bits for each expected hash
MOST_BITS = 22  # of a segment, as a power of two: 128 MB for the whole filter
FLUSH = 2_000_000  # hashes a task gathers before it sends them
FULL = 0.1  # share of set bits below which a filter is folded
_SCHEMA = "segment int, hashes binary"


def _bits(h: np.ndarray, power: int) -> list[np.ndarray]:
    """Three bit places inside a segment."""
    mask = U64((1 << power) - 1)
    return [(h & mask).astype(np.int64), ((h >> U64(17)) & mask).astype(np.int64), ((h >> U64(34)) & mask).astype(np.int64)]


class BitFilter:
    """Packed bits of all segments."""

    def __init__(self, power: int, packed: np.ndarray) -> None:
        self.power, self.packed = power, packed

    def has(self, h: np.ndarray) -> np.ndarray:
        """Which hashes may be in the filter."""
        if self.power < 0:
            return np.zeros(len(h), bool)
        place = (h >> U64(56)).astype(np.int64) << (self.power - 3)
        hit = None
        for bit in _bits(h, self.power):
            if hit is None:
                hit = np.flatnonzero((self.packed[place + (bit >> 3)] >> (bit & 7).astype(np.uint8)) & 1)
            else:
                b = bit[hit]
                hit = hit[((self.packed[place[hit] + (b >> 3)] >> (b & 7).astype(np.uint8)) & 1).astype(bool)]
        out = np.zeros(len(h), bool)
        out[hit] = True
        return out


_SHARED: list[Broadcast] = []


def share(spark: SparkSession, value: object) -> Broadcast:
    """A broadcast that ``unshare`` knows of."""
    _SHARED.append(spark.sparkContext.broadcast(value))
    return _SHARED[-1]


def unshare() -> None:
    """Free the executors' copies of what operators have shared so far; a result that is read later fetches its own again."""
    while _SHARED:
        _SHARED.pop().unpersist()


def power_for(expected: float) -> int:
    """Bits of a segment for so many hashes in all, as a power of two."""
    need = max(1.0, expected * BITS_EACH / SEGMENTS)
    return int(min(MOST_BITS, max(10, np.ceil(np.log2(need)))))


def _rows(hashes: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Sorted hashes by segment; a hash found often is sent twice."""
    h = np.sort(np.concatenate(hashes))
    repeat = np.zeros(len(h), bool)
    repeat[2:] = h[2:] == h[:-2]
    h = h[~repeat]
    cut = np.searchsorted(h, np.arange(SEGMENTS, dtype=U64) << U64(56))
    parts = np.split(h, cut[1:])
    some = [i for i, p in enumerate(parts) if len(p)]
    yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array([parts[i].tobytes() for i in some], pa.binary())], ["segment", "hashes"])


def build(
    rows: DataFrame, hashes: Callable[[pa.RecordBatch], np.ndarray], expected: float, text: str | None = None, keep: str = "both"
) -> BitFilter | tuple[BitFilter, BitFilter]:
    """The filter of what ``hashes`` finds ``once`` or ``twice``, or ``both``, in each batch of rows, or in each slice of their ``text``."""
    power = power_for(expected)
    wanted = ["once", "twice"] if keep == "both" else [keep]

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in tx.slices(batches, text) if text else batches:
            held.append(hashes(batch))
            n += len(held[-1])
            if n >= FLUSH:
                yield from _rows(held)
                held, n = [], 0
        if n:
            yield from _rows(held)

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        once: dict[int, np.ndarray] = {}
        twice: dict[int, np.ndarray] = {}
        for batch in batches:
            for segment, raw in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                h = np.frombuffer(raw.as_buffer(), U64)
                if segment not in once:
                    once[segment] = np.zeros(1 << power, bool)
                    twice[segment] = np.zeros(1 << power, bool)
                one, two = once[segment], twice[segment]
                again = np.zeros(len(h), bool)
                again[1:] = h[1:] == h[:-1]
                places = _bits(h, power)
                again |= one[places[0]] & one[places[1]] & one[places[2]]
                for p in places:
                    one[p] = True
                    two[p[again]] = True
        names = ["segment", "once", "twice"]
        keys = sorted(once)
        found = {"once": once, "twice": twice}
        packed = [
            pa.array([np.packbits(found[n][k], bitorder="little").tobytes() if n in wanted else None for k in keys], pa.binary()) for n in names[1:]
        ]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), *packed], names)

    spark = rows.sparkSession
    # A task unpacks both filters of its segments: 64 MB at most.
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), (SEGMENTS * 2 << power) >> 26)
    packed = (
        rows.mapInArrow(emit, _SCHEMA)
        .repartition(min(parts, SEGMENTS), "segment")
        .mapInArrow(gather, "segment int, once binary, twice binary")
    )
    size = 1 << (power - 3)
    out = {name: np.zeros(SEGMENTS * size, np.uint8) for name in wanted}
    for row in packed.toLocalIterator():
        at = slice(row["segment"] * size, (row["segment"] + 1) * size)
        for name in wanted:
            out[name][at] = np.frombuffer(row[name], np.uint8)
    done = [_folded(power, out.pop(name)) for name in wanted]
    return done[0] if len(done) == 1 else (done[0], done[1])


def _folded(power: int, bits: np.ndarray) -> BitFilter:
    """The halves of every segment laid over each other while few bits are set."""
    while power > 10 and np.bitwise_count(bits).sum(dtype=np.int64) < FULL * 8 * len(bits):
        halves = bits.reshape(SEGMENTS, 2, -1)
        bits = (halves[:, 0] | halves[:, 1]).reshape(-1)
        power -= 1
    return BitFilter(power, bits)
