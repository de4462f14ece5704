"""Connected components of a stored table of links, by alternating stars.

Every round ties each node's larger neighbours, then its smaller ones, to the
smallest it knows, so components become stars in a number of rounds that grows
with the logarithm of their width. Rounds are written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.spans import heads
from millrace.session import stage_table


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, smallest node of its component) of links held by one task, without the smallest themselves."""
    nodes, flat = np.unique(np.concatenate([a, b]), return_inverse=True)
    x, y = flat[: len(a)], flat[len(a) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[x], root[y])
        new = root.copy()
        np.minimum.at(new, root[x], low)
        np.minimum.at(new, root[y], low)
        new = np.minimum(new, new[new])
        if np.array_equal(new, root):
            break
        root = new
    some = root != np.arange(len(nodes))
    return nodes[some], nodes[root[some]]


def _local(edges: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for batch in batches:
            a = np.append(a, batch.column(0).to_numpy())
            b = np.append(b, batch.column(1).to_numpy())
            if len(a) > 2_000_000:
                a, b = forest(a, b)
                if len(a) > 1_000_000:
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
                    a, b = a[:0], b[:0]
        a, b = forest(a, b)
        yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return edges.select("a", "b").mapInArrow(run, "a long, b long")


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, component) for links (a, b); component is the smallest node, which has a row too.

    Rounds grow as the logarithm of a component's size; more than ``most_rounds`` is an error, never a partial result.
    """
    edges = stage_table(_local(edges).distinct(), "links")
    before = None
    for _ in range(most_rounds):
        # Every node ties its larger neighbours to the smallest it knows,
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.union(low.filter("m < a").select("a", F.col("m").alias("b"))).distinct()
        # then its smaller ones; links run from larger to smaller here.
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").filter("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        edges = stage_table(small.union(least.select("a", F.col("m").alias("b"))).distinct(), "links")
        state = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    else:
        raise RuntimeError(f"components still change after {most_rounds} rounds")
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("component", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(roots)


def linked(count: int, link: callable) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links of ``count`` items, where ``link(i, others)`` says which of ``others`` i is linked to.

    Every item is asked once, about the items not yet reached, so a dense group
    costs little more than its size and yields at most one link for each item.
    """
    waiting = np.arange(count)
    out_a, out_b = [], []
    while len(waiting):
        queue, waiting = [int(waiting[0])], waiting[1:]
        while queue and len(waiting):
            i = queue.pop()
            hit = link(i, waiting)
            if hit.any():
                found = waiting[hit]
                waiting = waiting[~hit]
                out_a.append(np.full(len(found), i))
                out_b.append(found)
                queue += found.tolist()
    nothing = np.zeros(0, np.int64)
    return np.concatenate([nothing, *out_a]), np.concatenate([nothing, *out_b])


__all__ = ["components", "forest", "heads", "linked"]
