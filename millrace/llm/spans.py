"""Spans of documents found by tasks that do not hold the documents, brought together per document.

Tasks send spans packed: one row holds the spans of many documents of one bucket,
so millions of spans cost thousands of rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.llm import filters
from millrace.llm import textops as tx
from millrace.session import stage_table

Cut = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]

PACKED = "bucket long, docs binary, tags binary, counts binary, starts binary, ends binary"
NAMES = [f.split()[0] for f in PACKED.split(", ")]


def bucket_of(doc: np.ndarray, buckets: int) -> np.ndarray:
    return (tx.mix(doc.astype(np.int64).view(np.uint64)) % np.uint64(buckets)).astype(np.int64)


def heads(*columns: np.ndarray) -> np.ndarray:
    """Where a new combination of sorted columns begins."""
    if not len(columns[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(columns[0]), bool)
    new[0] = True
    for c in columns:
        new[1:] |= c[1:] != c[:-1]
    return np.flatnonzero(new)


def merged(doc: np.ndarray, tag: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, ...]:
    """Sorted spans with overlapping and touching ones of a document joined."""
    if not len(doc):
        return doc, tag, start, end
    order = np.lexsort((start, tag, doc))
    doc, tag, start, end = doc[order], tag[order], start[order], end[order]
    owner = np.zeros(len(doc), np.int64)
    owner[heads(doc, tag)] = 1
    owner = np.cumsum(owner)
    width = np.int64(max(int(end.max()), 1) + 1)
    reach = np.maximum.accumulate(owner * width + end)  # of a later document every value is larger
    new = np.ones(len(doc), bool)
    new[1:] = owner[1:] * width + start[1:] > reach[:-1]
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(doc)) - 1
    return doc[at], tag[at], start[at], reach[last] - owner[last] * width


def pack(doc: np.ndarray, tag: np.ndarray, start: np.ndarray, end: np.ndarray, buckets: int) -> pa.RecordBatch:
    """Rows of PACKED, one for each bucket of documents."""
    doc, tag, start, end = merged(doc, tag, start, end)
    bucket = bucket_of(doc, buckets)
    order = np.argsort(bucket, kind="stable")
    doc, tag, start, end, bucket = doc[order], tag[order], start[order], end[order], bucket[order]
    return rows_by(bucket, doc, tag, [start.astype(np.int32), end.astype(np.int32)], NAMES)


def rows_by(bucket: np.ndarray, doc: np.ndarray, tag: np.ndarray, values: list[np.ndarray], names: list[str]) -> pa.RecordBatch:
    """One row for each bucket: its documents, how many values each has, and the values (all sorted by bucket, document)."""
    owner = heads(bucket, doc, tag)
    counts = np.diff(np.append(owner, len(doc))).astype(np.int32)
    cut = heads(bucket)
    columns: list[list[bytes]] = [[] for _ in range(3 + len(values))]
    for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(doc)][: len(cut)], strict=True):
        o, p = np.searchsorted(owner, (a, b))
        columns[0].append(doc[owner[o:p]].astype(np.int64).tobytes())
        columns[1].append(tag[owner[o:p]].astype(np.int64).tobytes())
        columns[2].append(counts[o:p].tobytes())
        for column, v in zip(columns[3:], values, strict=True):
            column.append(v[a:b].tobytes())
    return pa.RecordBatch.from_arrays([pa.array(bucket[cut], pa.int64()), *(pa.array(c, pa.binary()) for c in columns)], names)


def read(table: pa.Table | pa.RecordBatch, column: str, kind: type) -> np.ndarray:
    """All values of a packed column, row after row."""
    return np.frombuffer(b"".join(x for x in table.column(column).to_pylist() if x), kind)


def unpack(table: pa.Table | pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """(document, tag) of each packed value."""
    counts = read(table, "counts", np.int32)
    return np.repeat(read(table, "docs", np.int64), counts), np.repeat(read(table, "tags", np.int64), counts)


def per_document(packed: DataFrame) -> DataFrame:
    """One row for each document with spans: doc_id, tag, and its merged spans as two binaries."""

    def gather(table: pa.Table) -> pa.Table:
        doc, tag = unpack(table)
        start, end = (read(table, c, np.int32).astype(np.int64) for c in ("starts", "ends"))
        doc, tag, start, end = merged(doc, tag, start, end)
        at = heads(doc, tag)
        ends = [*at[1:].tolist(), len(doc)][: len(at)]
        return pa.table(
            {
                "doc_id": doc[at],
                "tag": tag[at],
                "starts": pa.array([start[a:b].tobytes() for a, b in zip(at.tolist(), ends, strict=True)], pa.binary()),
                "ends": pa.array([end[a:b].tobytes() for a, b in zip(at.tolist(), ends, strict=True)], pa.binary()),
            }
        )

    return packed.groupBy("bucket").applyInArrow(gather, "doc_id long, tag long, starts binary, ends binary")


def tagged(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, tag and text alone; (doc_id, tag) stays the same for repeated rows and differs for two texts of one id."""
    docs = tx.small_batches(docs)
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("tag"), F.col(text).alias("text"))


def boxed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """As ``tagged``, with all other columns in one struct, so that their names clash with none of ours."""
    rest = F.struct(*[c for c in docs.columns if c != text]).alias("row")
    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.xxhash64(F.col(text)).alias("tag"), rest, F.col(text).alias("text"))


def unboxed(rows: DataFrame, names: list[str], text: str) -> DataFrame:
    """The columns that ``boxed`` put away, in their order, with the text beside them."""
    return rows.select(*[F.col("text").alias(n) if n == text else F.col("row").getField(n).alias(n) for n in names])


def buckets_for(size: float, each: float = 8e6) -> int:
    """Buckets of about ``each`` bytes of text."""
    return int(max(64, size // each))


def key_of(batch: pa.RecordBatch, doc: str, tag: str) -> np.ndarray:
    ids, tags = (pc.fill_null(batch.column(c), 0).to_numpy(zero_copy_only=False).view(np.uint64) for c in (doc, tag))
    return tx.mix(ids ^ tx.mix(tags))


def filter_of(rows: DataFrame, doc: str, tag: str) -> filters.BitFilter:
    """A bit filter of the documents of stored rows."""
    return filters.build(rows.select(doc, tag), lambda b: key_of(b, doc, tag), float(max(1, rows.count())), keep="once")


def with_spans(docs: DataFrame, found: DataFrame, cut: Cut, schema: str | T.StructType, doc: str = "doc_id", tag: str = "tag") -> DataFrame:
    """``cut`` over every row of ``docs``, given the columns _starts and _ends of its spans (null: none).

    Only rows that a bit filter says may have spans are shuffled to meet them; all
    others go straight through.
    """
    found = found.select(F.col("doc_id").alias("_doc"), F.col("tag").alias("_tag"), F.col("starts").alias("_starts"), F.col("ends").alias("_ends"))
    found = stage_table(found, "spans")
    known = filters.share(docs.sparkSession, filter_of(found, "_doc", "_tag"))

    def untouched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            batch = batch.filter(pa.array(~known.value.has(key_of(batch, doc, tag))))
            nothing = pa.nulls(batch.num_rows, pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns, nothing, nothing], [*batch.schema.names, "_starts", "_ends"])

    def touched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(known.value.has(key_of(batch, doc, tag))))

    rest = docs.mapInArrow(lambda batches: cut(untouched(batches)), schema)
    some = docs.mapInArrow(touched, docs.schema)
    some = some.join(found, (F.col(doc) == F.col("_doc")) & (F.col(tag) == F.col("_tag")), "left").drop("_doc", "_tag")
    return rest.union(some.mapInArrow(cut, schema))


def removed_mask(n: int, starts: bytes | None, ends: bytes | None) -> np.ndarray | None:
    """True at the positions the spans cover, or None without spans."""
    if not starts:
        return None
    step = np.zeros(n + 1, np.int64)
    np.add.at(step, np.frombuffer(starts, np.int64), 1)
    np.add.at(step, np.frombuffer(ends, np.int64), -1)
    return np.cumsum(step[:-1]) > 0
