"""Repeated word windows across documents, by fixed-block anchors.

Every document is an indexed reference: its non-overlapping blocks of
``window // 2 + 1`` words. Any window of ``window`` words holds one whole block
of its document, so an equal window of another document holds the same words at
some place, and a rolling window of block size over that document meets them.

1. Blocks of all documents go into a bit filter (once, twice).
2. Rolling windows probe it; hits away from a document's own blocks go into a
   second filter, which tells a document that one of its blocks was met.
3. Hits are extended to the whole windows that hold them. The hashes of those
   windows are dealt by hash, where the smallest document is found; every window
   of a later document is a repeat. Overlapping repeats join to maximal ones.
4. Spans are gathered for each document and taken out of its text.

Filters only admit too much, never too little, and step 3 is decided on the whole
window, so the filters' false hits cost time alone. Of documents with one window
hash, a task sends only its smallest; the others are repeats already. Words and
windows are compared by 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import filters, spans
from millrace.llm import textops as tx

WINDOW = 13
FLUSH = 800_000  # windows a task gathers before it settles and sends them
_NAMES = ["bucket", "docs", "tags", "counts", "hashes", "starts", "ends"]
_SCHEMA = "bucket long, docs binary, tags binary, counts binary, hashes binary, starts binary, ends binary"


def _blocks(words: tx.Words, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, start, is one of the document's own blocks) of every rolling window of block size."""
    start, doc = tx.within(words.first, size)
    own = (start - words.first[doc]) % size == 0
    return tx.window_hashes(words.hash, size)[start], start, own


def _settle(held: list[tuple[np.ndarray, ...]], window: int, buckets: int) -> Iterator[pa.RecordBatch]:
    """Send one task's windows: by hash where another task may know a smaller document, else as spans."""
    h, doc, tag, pos = (np.concatenate(x) for x in zip(*held, strict=True))
    repeat, first = _later(h, doc)
    done = spans.pack(doc[repeat], tag[repeat], pos[repeat], pos[repeat] + window, buckets)
    empty = pa.array([None] * done.num_rows, pa.binary())
    # Spans travel under negative bucket numbers.
    yield pa.RecordBatch.from_arrays(
        [pa.array(-1 - done.column(0).to_numpy(), pa.int64()), *(done.column(c) for c in ("docs", "tags", "counts")), empty, done.column("starts"), done.column("ends")],
        _NAMES,
    )
    h, doc, tag, pos = h[first], doc[first], tag[first], pos[first]
    bucket = (h % np.uint64(buckets)).astype(np.int64)
    order = np.lexsort((pos, tag, doc, bucket))
    out = spans.rows_by(bucket[order], doc[order], tag[order], [h[order], pos[order].astype(np.int32)], _NAMES[:-1])
    yield pa.RecordBatch.from_arrays([*out.columns, pa.array([None] * out.num_rows, pa.binary())], _NAMES)


def _later(h: np.ndarray, doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the entries whose hash a smaller document has too, and of the others."""
    order = np.lexsort((doc, h))
    at = spans.heads(h[order])
    smallest = np.repeat(doc[order][at], np.diff(np.append(at, len(h))))
    later = doc[order] > smallest
    return order[later], order[~later]


def repeated_spans(docs: DataFrame, size: float, window: int = WINDOW) -> DataFrame:
    """doc_id, tag and spans (in words) of all windows that a smaller doc_id holds too; ``docs`` as of ``spans.tagged``."""
    size_of_block = window // 2 + 1
    buckets = spans.buckets_for(size)
    sc = docs.sparkSession.sparkContext
    known = docs.filter("doc_id IS NOT NULL")

    def own_blocks(batch: pa.RecordBatch) -> np.ndarray:
        h, _, own = _blocks(tx.words_of(batch.column("text")), size_of_block)
        return h[own]

    once, twice = filters.build(known.select("text"), own_blocks, size / 40, "text")
    index = sc.broadcast((once, twice))

    def met_blocks(batch: pa.RecordBatch) -> np.ndarray:
        h, _, own = _blocks(tx.words_of(batch.column("text")), size_of_block)
        h = h[~own]
        return h[index.value[0].has(h)]

    met = sc.broadcast(filters.build(known.select("text"), met_blocks, size / 40, "text", "once"))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in tx.slices(batches, "text"):
            words = tx.words_of(batch.column("text"))
            h, start, own = _blocks(words, size_of_block)
            hit = np.where(own, index.value[1].has(h) | met.value.has(h), index.value[0].has(h))
            # Windows that hold a hit: as many starts up to the hit as fit.
            flag = np.zeros(len(words.hash) + 1, np.int64)
            begin = np.maximum(start[hit] - (window - size_of_block), words.first[np.searchsorted(words.first, start[hit], "right") - 1])
            np.add.at(flag, begin, 1)
            np.add.at(flag, start[hit] + 1, -1)
            at, doc = tx.within(words.first, window)
            chosen = np.cumsum(flag)[at] > 0
            at, doc = at[chosen], doc[chosen]
            ids, tags = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("doc_id", "tag"))
            held.append((tx.window_hashes(words.hash, window)[at], ids[doc], tags[doc], at - words.first[doc]))
            n += len(at)
            if n >= FLUSH:
                yield from _settle(held, window, buckets)
                held, n = [], 0
        if n:
            yield from _settle(held, window, buckets)

    def decide(table: pa.Table) -> pa.Table:
        if table.column("bucket")[0].as_py() < 0:
            return pa.table([pa.array(-1 - table.column("bucket").to_numpy(), pa.int64()), *(table.column(c) for c in spans.NAMES[1:])], spans.NAMES)
        doc, tag = spans.unpack(table)
        pos = spans.read(table, "starts", np.int32).astype(np.int64)
        repeat, _ = _later(spans.read(table, "hashes", np.uint64), doc)
        return pa.Table.from_batches([spans.pack(doc[repeat], tag[repeat], pos[repeat], pos[repeat] + window, buckets)])

    found = known.mapInArrow(probe, _SCHEMA).groupBy("bucket").applyInArrow(decide, spans.PACKED)
    return spans.per_document(found)


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", window: int = WINDOW, with_text: bool = True) -> DataFrame:
    """Remove the words of every window that also starts in a document with a smaller id.

    Returns doc_id, n_words, n_removed, kept_sha256 and, ``with_text``, kept (the
    kept words joined by one space). A null or empty text has no words. Rows
    without an id have no place in the order: they lose nothing and take nothing
    from others. Rows that repeat id and text lose the same words; an id with
    several texts is several documents of equal rank. Other columns are ignored.
    """
    source = spans.tagged(docs, doc_id, text)
    size = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    found = repeated_spans(source, float(size), window)
    names = ["doc_id", "n_words", "n_removed", "kept_sha256"] + ["kept"] * with_text
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.slices(batches, "text"):
            raw, offsets = tx.buffer_of(batch.column("text"))
            whole = raw.tobytes()
            n_words, n_removed, sha, kept = [], [], [], []
            marks = zip(batch.column("_starts").to_pylist(), batch.column("_ends").to_pylist(), strict=True)
            for a, b, (starts, ends) in zip(offsets[:-1].tolist(), offsets[1:].tolist(), marks, strict=True):
                words = whole[a:b].split()
                n_words.append(len(words))
                gone = spans.removed_mask(len(words), starts, ends)
                n_removed.append(0 if gone is None else int(gone.sum()))
                if gone is not None:
                    words = [w for w, x in zip(words, gone.tolist(), strict=True) if not x]
                left = b" ".join(words)
                sha.append(hashlib.sha256(left).hexdigest())
                if with_text:
                    kept.append(left.decode())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(sha, pa.string()), *([pa.array(kept, pa.string())] * with_text)], names)

    return spans.with_spans(source, found, cut, schema)
