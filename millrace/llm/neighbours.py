"""Nearest neighbours by cosine, with one vantage-point tree for each shard.

Vectors are dealt to the nearest of a sample of pivots, so a cell holds like vectors
and knows the least and largest distance to its pivot; a cell of more than SHARD rows
is split into several shards. A shard keeps each distinct vector once, with its ids,
and builds a tree over the unit vectors: a node holds a vantage point and splits the
others at their median distance to it. On unit vectors the distance grows as the
cosine falls and obeys the triangle inequality, so a cell, or a side of a node, whose
distances are all farther than the best so far from the query's cannot hold a nearer
vector. It is skipped when its bound times ``relax`` exceeds the distance of the last
one kept: 1 is exact search, larger values skip more.

Queries travel in blocks. In a first pass each meets one shard of its own cell, which
bounds the distance of its last neighbour; in the second it meets the shards of all
cells that this bound does not rule out. A task walks a tree with all queries of a
block at once and returns the best few of the shard.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import stage_table

SHARD = 4096
QUERY_BLOCK = 512
MOST_PIVOTS = 4096  # more vectors make larger cells of more shards
LEAF = 48
MOST_TASKS = 20_000
_SLACK = 1e-7  # distances of unit vectors are only this exact near zero


@dataclass
class Node:
    """A vantage point with the nearer and the farther half, or a leaf."""

    low: int
    high: int
    spans: tuple[float, float, float, float] = (0.0, 0.0, 0.0, 0.0)  # least and largest distance, near and far side
    near: Node | None = None
    far: Node | None = None


@dataclass
class Tree:
    """Distinct vectors in tree order, their unit vectors, and the ids of each."""

    vectors: np.ndarray
    ids: list[np.ndarray]
    root: Node = field(default_factory=lambda: Node(0, 0))
    unit: np.ndarray = field(init=False)
    norm: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        self.norm = np.sqrt((self.vectors * self.vectors).sum(1))
        self.unit = self.vectors / self.norm[:, None]

    @staticmethod
    def build(ids: np.ndarray, vectors: np.ndarray, seed: int = 5) -> Tree:
        """Rows that repeat id and vector count once."""
        order = np.lexsort((ids, *vectors.T[::-1]))
        ids, vectors = ids[order], vectors[order]
        new = np.ones(len(ids), bool)
        new[1:] = (vectors[1:] != vectors[:-1]).any(1)
        cut = np.flatnonzero(new)
        of = [np.unique(x) for x in np.split(ids, cut[1:])]
        tree = Tree(vectors[cut], of)
        place = np.arange(len(cut))
        tree.root = tree._split(place, 0, len(cut), np.random.default_rng(seed))
        return Tree(tree.vectors[place], [of[i] for i in place.tolist()], tree.root)

    def _split(self, place: np.ndarray, low: int, high: int, draw: np.random.Generator) -> Node:
        if high - low <= LEAF:
            return Node(low, high)
        pick = low + int(draw.integers(high - low))
        place[low], place[pick] = place[pick], place[low]
        rest = place[low + 1 : high]
        d = _distance(self.unit[rest] @ self.unit[place[low]])
        order = np.argsort(d, kind="stable")  # equal distances fall on both sides; the bounds hold for either
        place[low + 1 : high] = rest[order]
        d = d[order]
        half = len(d) // 2
        node = Node(low, high, (d[0], d[half - 1], d[half], d[-1]))
        node.near = self._split(place, low + 1, low + 1 + half, draw)
        node.far = self._split(place, low + 1 + half, high, draw)
        return node

    def nearest(
        self, queries: np.ndarray, own: np.ndarray, k: int, relax: float, bound: np.ndarray | None = None
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(query number, id, cosine) of the best ``k`` ids of every query but its own, ties to smaller ids; then the new bounds.

        Only vectors within ``bound`` are looked for, where that is given for each query. The new
        bound is a distance within which ``k`` ids are known, infinite if they are not.
        """
        length = np.sqrt((queries * queries).sum(1))
        query, at, d, worst = self._walk(queries / length[:, None], k, relax, bound)
        near = d <= worst[query] + _SLACK
        return *self._exact(queries, length, own, query[near], at[near], k), worst

    def _walk(self, unit: np.ndarray, k: int, relax: float, bound: np.ndarray | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(query number, place, distance) of all that may be among the best, and the distance of each query's last one kept."""
        keep = k + 1  # its own vector beside the k
        best = np.full((len(unit), keep), np.inf)
        worst = np.full(len(unit), np.inf) if bound is None else bound.astype(float)
        seen: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

        def offer(who: np.ndarray, low: int, high: int) -> np.ndarray:
            d = _distance(unit[who] @ self.unit[low:high].T)
            row = np.flatnonzero(d.min(1) <= worst[who] + _SLACK)
            if len(row):
                some, near = who[row], d[row]
                best[some] = np.partition(np.concatenate([best[some], near], axis=1), keep - 1, axis=1)[:, :keep]
                worst[some] = np.minimum(worst[some], best[some].max(1))
                # Whatever ties the last one kept may be wanted for its id: exact scores decide in the end.
                q, slot = np.nonzero(near <= worst[some][:, None] + _SLACK)
                seen.append((some[q], slot + low, near[q, slot]))
            return d

        stack: list[tuple[Node, np.ndarray, np.ndarray]] = [(self.root, np.arange(len(unit)), np.zeros(len(unit)))]
        while stack:
            node, who, least = stack.pop()
            who = who[least * relax <= worst[who] + _SLACK]
            if not len(who):
                continue
            if node.near is None:
                offer(who, node.low, node.high)
                continue
            d = offer(who, node.low, node.low + 1)[:, 0]
            a, b, c, e = node.spans
            near = np.maximum(0, np.maximum(a - d, d - b))
            far = np.maximum(0, np.maximum(c - d, d - e))
            # What is popped first was pushed last: the likelier side of most queries.
            sides = [(node.far, who, far), (node.near, who, near)]
            stack += sides if 2 * (near <= far).sum() >= len(who) else sides[::-1]
        nothing = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        query, at, d = (np.concatenate(x) for x in zip(*(seen or [nothing]), strict=True))
        return query, at, d, worst

    def _exact(self, queries: np.ndarray, length: np.ndarray, own: np.ndarray, query: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        score = (queries[query] * self.vectors[at]).sum(1) / (length[query] * self.norm[at])
        out: list[tuple[np.ndarray, ...]] = []
        for q, i, s in zip(query.tolist(), at.tolist(), score.tolist(), strict=True):
            ids = self.ids[i][: k + 1]
            ids = ids[ids != own[q]][:k]
            out.append((np.full(len(ids), q), ids, np.full(len(ids), s)))
        if not out:
            return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0)
        query, ids, score = (np.concatenate(x) for x in zip(*out, strict=True))
        order = np.lexsort((ids, -score, query))
        query, ids, score = query[order], ids[order], score[order]
        rank = np.arange(len(query)) - np.searchsorted(query, query)
        return query[rank < k], ids[rank < k], score[rank < k]


def _distance(cosine: np.ndarray) -> np.ndarray:
    return np.sqrt(np.maximum(0.0, 2.0 - 2.0 * cosine))


def _matrix(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _dump(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def usable(vector: str) -> Column:
    """Neither null nor zero, and no component null or not finite."""
    v = F.col(vector).cast("array<double>")
    odd = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~odd & F.exists(v, lambda x: x != 0)


def _clean(rows: DataFrame, vec_id: str, vector: str) -> DataFrame:
    rows = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(vector).alias("v")).filter(F.col("vec_id").isNotNull() & usable("v"))
    return rows.select("vec_id", F.col("v").cast("array<double>").alias("v"), F.size("v").alias("dim"))


def _pivots(points: DataFrame) -> dict[int, np.ndarray]:
    """By dimension: unit vectors with the smallest hashes, copies once; one for SHARD rows, at most MOST_PIVOTS."""
    n = {r["dim"]: r["n"] for r in points.groupBy("dim").agg(F.count(F.lit(1)).alias("n")).collect()}
    wanted = _by_dim({d: min(MOST_PIVOTS, -(-x // SHARD)) for d, x in n.items()})
    drawn = points.select("dim", F.xxhash64("v").alias("draw"), "v")
    place = F.row_number().over(Window.partitionBy("dim").orderBy("draw"))
    first = drawn.select("dim", "draw").distinct().withColumn("place", place).filter(F.col("place") <= wanted).select("dim", "draw")
    rows = drawn.join(F.broadcast(first), ["dim", "draw"]).groupBy("dim", "draw").agg(F.first("v").alias("v")).collect()
    by_dim: dict[int, list[list[float]]] = {}
    for r in sorted(rows, key=lambda r: r["draw"]):
        by_dim.setdefault(r["dim"], []).append(r["v"])
    return {d: _unit(np.array(v)) for d, v in by_dim.items()}


def _unit(vectors: np.ndarray) -> np.ndarray:
    return vectors / np.sqrt((vectors * vectors).sum(1))[:, None]


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    """Rows of one dimension, at most QUERY_BLOCK at once."""
    for batch in batches:
        dim = batch.column("dim").to_numpy()
        for d in np.unique(dim).tolist():
            some = batch.filter(pa.array(dim == d))
            for at in range(0, some.num_rows, QUERY_BLOCK):
                yield d, some.slice(at, QUERY_BLOCK)


def _in_cells(points: DataFrame, pivots: dict[int, np.ndarray]) -> DataFrame:
    """Each row with the cell of its nearest pivot and its distance to it."""
    shared = points.sparkSession.sparkContext.broadcast(pivots)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, block in _blocks(batches):
            d = _distance(_unit(_matrix(block.column("v"), dim)) @ shared.value[dim].T)
            cell = d.argmin(1)
            columns = [*(block.column(c) for c in ("vec_id", "v", "dim")), pa.array(cell, pa.int32()), pa.array(d[np.arange(len(d)), cell])]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "v", "dim", "cell", "away"])

    return points.mapInArrow(run, "vec_id long, v array<double>, dim int, cell int, away double")


_KEY = ["dim", "cell", "part"]  # of a shard


def _met(asked: DataFrame, pivots: dict[int, np.ndarray], cells: dict[int, list[tuple[int, int, float, float]]], relax: float, home: bool) -> DataFrame:
    """Packs of queries for each shard they must meet: one of the nearest cell, or all that ``bound`` leaves over.

    ``cells`` holds (cell, parts, least, largest distance) by dimension, at most MOST_PIVOTS of each.
    """
    shared = asked.sparkSession.sparkContext.broadcast((pivots, cells))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pivots, cells = shared.value
        for dim, block in _blocks(batches):
            if dim not in cells:
                continue
            ids, rows = block.column("vec_id").to_numpy(), _matrix(block.column("v"), dim)
            cell, parts, low, high = (np.array(x) for x in zip(*cells[dim], strict=True))
            d = _distance(_unit(rows) @ pivots[dim][cell].T)
            if home:
                bound = np.full(len(ids), np.inf)
                goes = np.arange(len(cell)) == d.argmin(1)[:, None]
                parts = np.ones_like(parts)
            else:
                bound = block.column("bound").to_numpy()
                goes = np.maximum(0, np.maximum(low - d, d - high)) * relax <= bound[:, None] + _SLACK
            for j in np.flatnonzero(goes.any(0)).tolist():
                who = goes[:, j]
                pack = _dump(ids=ids[who], rows=rows[who], bound=bound[who])
                n = int(parts[j])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([dim] * n, pa.int32()), pa.array([int(cell[j])] * n, pa.int32()), pa.array(range(n), pa.int32()), pa.array([pack] * n, pa.binary()), pa.array([int(who.sum())] * n, pa.int64())],
                    [*_KEY, "queries", "n"],
                )

    return asked.mapInArrow(run, "dim int, cell int, part int, queries binary, n long")


def _shards(points: DataFrame, pivots: dict[int, np.ndarray]) -> tuple[DataFrame, dict[int, list[tuple[int, int, float, float]]]]:
    """One row a shard with its vectors (the tree is built by the task that walks it, from a fixed seed), and what is known of the cells."""
    placed = stage_table(_in_cells(points, pivots), "cells")
    sizes = placed.groupBy("dim", "cell").agg(F.count(F.lit(1)).alias("n"), F.min("away").alias("low"), F.max("away").alias("high"))
    sizes = sizes.withColumn("parts", F.ceil(F.col("n") / SHARD).cast("int"))
    cells: dict[int, list[tuple[int, int, float, float]]] = {}
    for r in sizes.orderBy("dim", "cell").collect():
        cells.setdefault(r["dim"], []).append((r["cell"], r["parts"], r["low"], r["high"]))

    def plant(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        order = np.argsort(table.column("vec_id").to_numpy(), kind="stable")
        ids, rows = table.column("vec_id").to_numpy()[order], _matrix(table.column("v"), dim)[order]
        return pa.table({**{c: table.column(c).slice(0, 1) for c in _KEY}, "points": pa.array([_dump(ids=ids, rows=rows)], pa.binary())})

    # At most MOST_PIVOTS short rows of each dimension.
    parted = placed.join(F.broadcast(sizes.select("dim", "cell", "parts")), ["dim", "cell"])
    parted = parted.withColumn("part", F.pmod(F.xxhash64("vec_id"), F.col("parts")).cast("int"))
    return parted.groupBy(*_KEY).applyInArrow(plant, "dim int, cell int, part int, points binary"), cells


def _visits(packs: DataFrame, index: DataFrame, tasks: int) -> DataFrame:
    # Trees are work, not bytes: as many tasks as shards, whatever their size.
    return packs.join(index.repartition(min(MOST_TASKS, tasks), *_KEY), _KEY, "left").select(*_KEY, "points", "queries")


def _trees(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, Tree | None, dict[str, np.ndarray]]]:
    """(dimension, tree or None for a part without rows, pack of queries); the join sorts by shard, so packs of one tree follow each other."""
    at, tree = None, None
    for batch in batches:
        for i in range(batch.num_rows):
            key = tuple(batch.column(c)[i].as_py() for c in _KEY)
            if key != at:
                points = batch.column("points")[i].as_py()
                have = np.load(io.BytesIO(points)) if points else None
                at, tree = key, Tree.build(have["ids"], have["rows"]) if have else None
            yield key[0], tree, np.load(io.BytesIO(batch.column("queries")[i].as_py()))


def nearest_neighbours(vectors: DataFrame, queries: DataFrame, k: int = 5, relax: float = 1.0, vec_id: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """query_id, rank (from 1), vec_id and score: each query's ``k`` nearest rows by cosine.

    A row with the query's id is not its neighbour. Ties go to the smaller id.
    Vectors that are null, zero, or hold null or non-finite components, and rows
    without an id, take no part; vectors meet only those of their own length. Rows
    that repeat id and vector count once. Fewer than ``k`` others give fewer rows.
    """
    packs, first, index, shards = _two_passes(_clean(vectors, vec_id, vector), _clean(queries, vec_id, vector), k, relax)

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, tree, ask in _trees(batches):
            if tree:
                query, ids, score, _ = tree.nearest(ask["rows"], ask["ids"], k, relax, ask["bound"])
                yield pa.RecordBatch.from_arrays([pa.array(ask["ids"][query]), pa.array(ids), pa.array(score)], ["query_id", "vec_id", "score"])

    found = _visits(packs, index, shards).mapInArrow(walk, "query_id long, vec_id long, score double").unionAll(first)
    by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.distinct().select("query_id", F.row_number().over(by).alias("rank"), "vec_id", "score").filter(F.col("rank") <= k)


def _two_passes(points: DataFrame, asked: DataFrame, k: int, relax: float) -> tuple[DataFrame, DataFrame, DataFrame, int]:
    """Packs of queries for all shards that their bounds leave over, what the first pass found, the shards, and how many there are."""
    pivots = _pivots(points)
    index, cells = _shards(points, pivots)
    index = stage_table(index, "shards")
    shards = max(1, sum(parts for of in cells.values() for _, parts, _, _ in of))
    hits = pa.list_(pa.struct([("vec_id", pa.int64()), ("score", pa.float64())]))

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for dim, tree, ask in _trees(batches):
            n = len(ask["ids"])
            near: list[list[dict]] = [[] for _ in range(n)]
            bound = np.full(n, np.inf)
            if tree:
                query, ids, score, bound = tree.nearest(ask["rows"], ask["ids"], k, relax)
                for q, i, x in zip(query.tolist(), ids.tolist(), score.tolist(), strict=True):
                    near[q].append({"vec_id": i, "score": x})
            v = pa.ListArray.from_arrays(np.arange(n + 1, dtype=np.int32) * dim, ask["rows"].ravel())
            columns = [pa.array(ask["ids"]), v, pa.array([dim] * n, pa.int32()), pa.array(bound), pa.array(near, hits)]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "v", "dim", "bound", "near"])

    home = _visits(_met(asked, pivots, cells, relax, home=True), index, shards)
    reached = stage_table(home.mapInArrow(walk, "vec_id long, v array<double>, dim int, bound double, near array<struct<vec_id: long, score: double>>"), "bounds")
    first = reached.select(F.col("vec_id").alias("query_id"), F.inline("near"))
    return _met(reached.drop("near"), pivots, cells, relax, home=False), first, index, shards


def _by_dim(counts: dict[int, int]) -> Column:
    out = F.lit(1)
    for dim, n in counts.items():
        out = F.when(F.col("dim") == dim, F.lit(n)).otherwise(out)
    return out
