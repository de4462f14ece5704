"""Tokenise documents, cut them into pieces, and pack the pieces into full sequences.

Packing depends on lengths alone, and there are at most ``capacity`` of them, so
Spark counts the pieces of each length and the driver plans bins over that small
table, whatever the number of pieces. Minimum bin slack: a bin takes the longest
length left and the combination of the others that fills the rest best, found by
subset sums in a bitset; the combination is used as often as the counts allow and
removed. Each piece then finds its place from its length and its rank among the
pieces of that length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import textops as tx
from millrace.session import stage_table

MOST_WORDS = 1_000_000  # words a worker remembers
_GAP = "\x01"  # between words that are tokenised together; one token by itself


@lru_cache(1)
def _tokenizer(path: str):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def _encode_words(path: str):
    """Tokenise words joined by a gap token, and share the ids out again."""
    tokenizer = _tokenizer(path)
    gap = tokenizer.encode(_GAP, add_special_tokens=False).ids
    assert len(gap) == 1, "the gap must be one token"

    def run(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        out, counts = [], np.zeros(len(words), np.int64)
        for a in range(0, len(words), 4000):
            some = words[a : a + 4000]
            ids = np.array(tokenizer.encode(f" {_GAP} ".join(some), add_special_tokens=False).ids, np.int64)
            cut = np.flatnonzero(ids == gap[0])
            if len(cut) == len(some) - 1:
                counts[a : a + len(some)] = np.diff(np.concatenate([[-1], cut, [len(ids)]])) - 1
                out.append(ids[ids != gap[0]])
            else:  # a word holds the gap itself
                each = [tokenizer.encode(w, add_special_tokens=False).ids for w in some]
                counts[a : a + len(some)] = list(map(len, each))
                out += [np.array(x, np.int64) for x in each]
        return np.concatenate([np.zeros(0, np.int64), *out]), counts

    return run


def token_ids(text: pa.Array, words: tx.WordIds) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all texts, number of ids of each), for a tokenizer that drops white space and case.

    Special tokens are matched in the raw text, so a slice that may hold one is
    neither lower-cased nor cut at marks first.
    """
    plain = b"<|" not in text.buffers()[2].to_pybytes() if text.buffers()[2] is not None else True
    found = tx.words_of(text, lower=plain, cut_marks=plain)
    ids, lengths = words.of(found, plain)
    ends = np.append(0, np.cumsum(lengths))[found.first]
    return ids, np.diff(ends)


def cut_documents(
    docs: DataFrame, tokenizer: str, most: int = 2048, end_id: int = 0, doc_id: str = "doc_id", text: str = "text", with_ids: bool = False
) -> DataFrame:
    """Pieces of at most ``most`` ids of each tokenised whole text followed by ``end_id``.

    Returns doc_id, piece (from 0), start, length, ids_crc32 and, if asked for,
    ids; further ``_task`` and ``_nth`` (rank among the task's pieces of this
    length) for packing. The tokenizer must drop case and white space and cut at marks,
    as uncased word-piece vocabularies do; ids of others would be wrong. A null or empty text is the end id alone. Repeated rows
    are cut alike; other columns are left out.
    """
    fields = [
        T.StructField(doc_id, docs.schema[doc_id].dataType),
        T.StructField("piece", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("length", T.LongType()),
        T.StructField("ids_crc32", T.LongType()),
        T.StructField("_task", T.IntegerType()),
        T.StructField("_nth", T.LongType()),
    ]
    fields += [T.StructField("ids", T.ArrayType(T.IntegerType()))] * with_ids
    schema = T.StructType(fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = tx.WordIds(_encode_words(tokenizer), MOST_WORDS)
        seen = np.zeros(most + 1, np.int64)
        task = TaskContext.get().partitionId()
        for batch in tx.slices(batches, text):
            ids, counts = token_ids(tx.as_large(batch.column(text)), words)
            # Every document gets its end id.
            ends = np.cumsum(counts)
            ids = np.insert(ids, ends, end_id).astype("<u4")
            counts = counts + 1
            first = np.cumsum(counts) - counts
            pieces = -(-counts // most)
            row = np.repeat(np.arange(len(counts)), pieces)
            piece = np.arange(len(row)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
            start = piece * most
            length = np.minimum(counts[row] - start, most)
            begin = first[row] + start
            view = memoryview(ids).cast("B") if len(ids) else b""
            crc = [zlib.crc32(view[4 * a : 4 * (a + n)]) for a, n in zip(begin.tolist(), length.tolist(), strict=True)]
            # Rank among equal lengths so far in this task.
            order = np.argsort(length, kind="stable")
            sorted_ = length[order]
            head = np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))
            rank = np.arange(len(order)) - np.repeat(head, np.diff(np.append(head, len(order))))
            nth = np.empty(len(order), np.int64)
            nth[order] = rank + seen[sorted_]
            seen += np.bincount(length, minlength=most + 1)
            columns = [
                batch.column(doc_id).take(pa.array(row)),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
                pa.array(np.full(len(row), task), pa.int32()),
                pa.array(nth, pa.int64()),
            ]
            columns += [tx.list_array(ids.astype(np.int32), length, pa.int32())] * with_ids
            yield pa.RecordBatch.from_arrays(columns, schema.names)

    return tx.small_batches(docs).select(doc_id, text).mapInArrow(run, schema)


@dataclass
class Pattern:
    """A combination of lengths (longest first) and how many bins use it."""

    lengths: list[int]
    times: int


def fullest(counts: dict[int, int], room: int) -> list[int]:
    """The lengths, each at most its count often, whose sum is largest within ``room``."""
    mask = (1 << (room + 1)) - 1
    reach, steps = 1, []
    for length in sorted((x for x in counts if x <= room), reverse=True):
        steps.append((length, reach))
        left, take = min(counts[length], room // length), 1
        while left:  # copies in groups of 1, 2, 4, ... reach every number of copies
            take = min(take, left)
            reach |= (reach << take * length) & mask
            left -= take
            take *= 2
        if reach >> room & 1:
            break
    sum_ = reach.bit_length() - 1
    chosen: list[int] = []
    for length, before in reversed(steps):
        while not before >> sum_ & 1:
            chosen.append(length)
            sum_ -= length
    return chosen


def plan_bins(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Minimum bin slack over a table of lengths; every count is used up."""
    left = {k: v for k, v in counts.items() if v > 0}
    patterns = []
    while left:
        seed = max(left)
        left[seed] -= 1
        rest = fullest({k: v for k, v in left.items() if v}, capacity - seed)
        left[seed] += 1
        bin_ = sorted([seed, *rest], reverse=True)
        used = {k: bin_.count(k) for k in set(bin_)}
        times = min(left[k] // n for k, n in used.items())
        for k, n in used.items():
            left[k] -= n * times
            if not left[k]:
                del left[k]
        patterns.append(Pattern(bin_, times))
    return patterns


def pack(pieces: DataFrame, capacity: int = 2048) -> DataFrame:
    """Add sequence_id and offset to the pieces of ``cut_documents``.

    Every piece gets one place; the pieces of a sequence lie without gaps from 0
    and never pass ``capacity``. An empty table gives an empty result. The pieces
    are stored first, as their ranks must not change between the two readings.
    """
    schema = T.StructType([*(f for f in pieces.schema if f.name not in ("_task", "_nth")), T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType())])
    stored = stage_table(pieces, "pieces")
    groups = stored.groupBy("length", "_task").agg(F.count(F.lit(1)).alias("_n"))
    # At most one row for each length up to the capacity.
    table = {r["length"]: r["n"] for r in groups.groupBy("length").agg(F.sum("_n").alias("n")).collect()}
    length, rank, base, offset, made = [], [], [], [], 0
    given = dict.fromkeys(table, 0)
    for p in plan_bins(table, capacity):
        at = 0
        for n in p.lengths:
            length.append(n), rank.append(given[n]), base.append(made), offset.append(at)
            given[n] += p.times
            at += n
        made += p.times
    order = np.lexsort((rank, length))
    slots = [np.array(x, np.int64)[order] for x in (length, rank, base, offset)]
    # Slots of one length follow each other; a key of both makes one sorted array.
    top = max([1, *table.values()]) + 1
    keys = slots[0] * top + slots[1]
    earlier = Window.partitionBy("length").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    before = groups.select("length", "_task", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    shared = stored.sparkSession.sparkContext.broadcast((keys, *slots[1:]))  # bounded by the capacity, not by the rows

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, rank, base, offset = shared.value
        for batch in batches:
            of = lambda c: batch.column(c).to_numpy(zero_copy_only=False)  # noqa: B023, E731
            n = of("_nth") + of("_before")
            slot = np.searchsorted(key, of("length") * top + n, "right") - 1
            kept = [batch.column(f.name) for f in schema[:-2]]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(base[slot] + n - rank[slot]), pa.array(offset[slot])], schema.names)

    return stored.join(before, ["length", "_task"]).mapInArrow(place, schema)


def packed(docs: DataFrame, tokenizer: str, capacity: int = 2048) -> DataFrame:
    """Documents cut and packed: one row per piece."""
    return pack(cut_documents(docs, tokenizer, capacity), capacity).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )
