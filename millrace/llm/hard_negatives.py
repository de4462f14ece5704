"""Hard negatives from blocks of rows along a Hilbert curve, chosen by zone maps.

Vectors become integers, so every score is an exact inner product.

1. Rows are range-sorted by label and by their place on a Hilbert curve through the
   vectors' box, and written as Parquet: one row holds SHARD vectors in blocks of
   BLOCK, all of one label, with each block's least and largest value per dimension.
   Anchors see the other rows of their own block there, which gives a first floor
   for the scores of their positives.
2. Interval arithmetic on a block's box bounds all scores an anchor can have in it.
   Packs of anchors meet the zone maps alone and name the blocks that may hold one
   of the positives; those are read and scored, and each anchor keeps its best.
3. The positives' scores are windows. The same bounds name the blocks of other
   labels in which a score may fall into a window, and those are read in turn.

Bounds only ever leave out blocks that can't matter, so results are exact.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.spans import heads
from millrace.session import stage_table

BLOCK = 64  # vectors under one zone
SHARD = 2048  # vectors stored, and read, as one row
PACK = 256  # anchors that travel together
MEET = 32  # packs, or shards' zone maps, that meet at once
BITS = 4  # of each dimension on the curve
LARGEST = 2.0**20  # components of this size or more count as not finite
NONE = np.iinfo(np.int64).min


def hilbert(places: np.ndarray, bits: int) -> np.ndarray:
    """Place on the Hilbert curve of each row of ``places`` (integers of ``bits`` bits), as bytes in order.

    Skilling's transform: exchange or invert lower bits from the highest bit down,
    then Gray-code across the dimensions; bits of one weight stand together.
    """
    x = places.astype(np.int64).T.copy()
    for weight in (1 << np.arange(bits - 1, 0, -1)).tolist():
        below = weight - 1
        for i in range(len(x)):
            swap = (x[0] ^ x[i]) & below
            up = (x[i] & weight) != 0
            x[0] ^= np.where(up, below, swap)
            x[i] ^= np.where(up, 0, swap)
    x = np.bitwise_xor.accumulate(x, axis=0)
    turn = np.zeros(x.shape[1], np.int64)
    for weight in (1 << np.arange(bits - 1, 0, -1)).tolist():
        turn ^= np.where(x[-1] & weight, weight - 1, 0)
    x ^= turn
    planes = (x[None] >> np.arange(bits - 1, -1, -1)[:, None, None]) & 1
    return np.packbits(planes.reshape(bits * len(x), -1).T.astype(np.uint8), axis=1)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer inner products of the rows of ``a`` and ``b``."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * max(1, a.shape[1])
    if most < 2**53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if most >= 2**63:
        raise OverflowError("scores are beyond 64 bits")
    return a.astype(np.int64) @ b.astype(np.int64).T


def bounds(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(least, largest) score that each anchor can have inside each box."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return products(up, low) + products(down, high), products(up, high) + products(down, low)


def first_of(group: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Which entries are among the first ``k`` of their group: higher scores first, then smaller ids."""
    order = np.lexsort((ids, -score, group))
    at = heads(group[order])
    rank = np.arange(len(order)) - np.repeat(at, np.diff(np.append(at, len(order))))
    return order[rank < k]


def usable(vector: str) -> Column:
    v = F.col(vector).cast("array<double>")
    return F.col(vector).isNotNull() & (F.size(vector) > 0) & ~F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) >= LARGEST))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _box(rows: DataFrame, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Least and largest value of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low, high = np.full(dim, np.iinfo(np.int64).max), np.full(dim, NONE)
        for batch in batches:
            v = _matrix(batch.column("v"), dim)
            low, high = np.minimum(low, v.min(0, initial=low.max())), np.maximum(high, v.max(0, initial=high.min()))
        kind = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([low], kind), pa.array([high], kind)], ["low", "high"])

    each = rows.select("v").mapInArrow(run, "low array<long>, high array<long>").select(F.posexplode(F.arrays_zip("low", "high")).alias("pos", "x"))
    found = sorted(each.groupBy("pos").agg(F.min("x.low").alias("low"), F.max("x.high").alias("high")).collect())
    return np.array([r["low"] for r in found]), np.array([r["high"] for r in found])


def _shards(rows: DataFrame, dim: int, k: int) -> DataFrame:
    """The blocks along the curve, stored: one row for each shard."""
    low, high = _box(rows, dim)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = _matrix(batch.column("v"), dim)
            cell = (v - low) * (1 << BITS) // (high - low + 1)
            keys = hilbert(cell, BITS)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array([x.tobytes() for x in keys], pa.binary())], [*batch.schema.names, "curve"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple[np.ndarray, ...]] = []
        have, last = 0, None

        def shard(columns: tuple[np.ndarray, ...]) -> pa.RecordBatch:
            nonlocal number
            label, ids, anchor, v = columns
            zone = np.arange(0, len(ids), BLOCK)
            who = np.flatnonzero(anchor)
            seeds = np.full(len(who), NONE)
            for at, i in enumerate(who.tolist()):
                block = slice(i // BLOCK * BLOCK, (i // BLOCK + 1) * BLOCK)
                score = products(v[i : i + 1], v[block])[0][ids[block] != ids[i]]
                if len(score) >= k:
                    seeds[at] = np.partition(score, -k)[-k]
            values = [ids, v.astype(np.int32), np.minimum.reduceat(v, zone).astype(np.int32), np.maximum.reduceat(v, zone).astype(np.int32)]
            values += [ids[who], v[who].astype(np.int32), seeds]
            out = pa.RecordBatch.from_arrays(
                [pa.array([number], pa.int64()), pa.array([label[0]], pa.int64()), *(pa.array([x.tobytes()], pa.binary()) for x in values)],
                ["shard", "label", "ids", "rows", "low", "high", "anchors", "asked", "seeds"],
            )
            number += 1
            return out

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal held, have
            if held:
                columns = tuple(np.concatenate(x) for x in zip(*held, strict=True))
                for start in range(0, len(columns[0]), SHARD):
                    yield shard(tuple(x[start : start + SHARD] for x in columns))
            held, have = [], 0

        def rest() -> None:
            """What is left of the rows in hand beyond whole shards stays in hand."""
            nonlocal held, have
            columns = tuple(np.concatenate(x) for x in zip(*held, strict=True))
            whole = have // SHARD * SHARD
            held, have = [tuple(x[whole:] for x in columns)], have - whole
            parts.extend(tuple(x[a : a + SHARD] for x in columns) for a in range(0, whole, SHARD))

        for batch in batches:
            label, ids, anchor = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("label", "vec_id", "anchor"))
            v = _matrix(batch.column("v"), dim)
            # Repeated rows stand together, as they share label, place and id; each counts once.
            again = np.zeros(len(ids), bool)
            again[1:] = (label[1:] == label[:-1]) & (ids[1:] == ids[:-1]) & (v[1:] == v[:-1]).all(1)
            if last is not None and len(ids):
                again[0] = label[0] == last[0] and ids[0] == last[1] and (v[0] == last[2]).all()
            if len(ids):
                last = (label[-1], ids[-1], v[-1])
            label, ids, anchor, v = (x[~again] for x in (label, ids, anchor, v))
            cuts = heads(label).tolist()
            for a, b in zip(cuts, [*cuts[1:], len(label)], strict=True):
                if held and held[0][0][0] != label[a]:
                    yield from flush()
                held.append((label[a:b], ids[a:b], anchor[a:b], v[a:b]))
                have += b - a
                if have >= SHARD:
                    parts: list[tuple[np.ndarray, ...]] = []
                    rest()
                    yield from map(shard, parts)
                    if not have:
                        held = []
        yield from flush()

    placed = rows.mapInArrow(place, "vec_id long, label long, anchor boolean, v array<long>, curve binary")
    # Equal vectors of one id differ by nothing else than v, so sorting by it too brings repeated rows together.
    ordered = placed.repartitionByRange("label", "curve", "vec_id").sortWithinPartitions("label", "curve", "vec_id", "v")
    schema = "shard long, label long, ids binary, rows binary, low binary, high binary, anchors binary, asked binary, seeds binary"
    return stage_table(ordered.mapInArrow(cut, schema), "shards")


def _packs(shards: DataFrame, dim: int) -> DataFrame:
    """Anchors in curve order, PACK together, stored: pack, labels, ids, rows and seeds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        held: list[tuple[np.ndarray, ...]] = []
        have = 0

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal number, held, have
            columns = [np.concatenate(x) for x in zip(*held, strict=True)] if held else [np.zeros(0)]
            for a in range(0, len(columns[0]), PACK):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), *(pa.array([x[a : a + PACK].tobytes()], pa.binary()) for x in columns)], ["pack", "labels", "ids", "rows", "seeds"]
                )
                number += 1
            held, have = [], 0

        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["anchors"], np.int64)
                held.append((np.full(len(ids), row["label"]), ids, np.frombuffer(row["asked"], np.int32).reshape(-1, dim), np.frombuffer(row["seeds"], np.int64)))
                have += len(ids)
                if have >= 4 * PACK:
                    yield from packed()
        yield from packed()

    some = shards.filter(F.octet_length("anchors") > 0).select("shard", "label", "anchors", "asked", "seeds").repartitionByRange("shard").sortWithinPartitions("shard")
    return stage_table(some.mapInArrow(run, "pack long, labels binary, ids binary, rows binary, seeds binary"), "packs")


Wanted = Callable[[dict, np.ndarray, np.ndarray, np.ndarray], np.ndarray]
Hits = Callable[[dict, np.ndarray, np.ndarray, int], tuple[np.ndarray, np.ndarray, np.ndarray]]


def _pack_of(row: dict, dim: int) -> dict:
    out = {"labels": np.frombuffer(row["labels"], np.int64), "ids": np.frombuffer(row["ids"], np.int64), "seeds": np.frombuffer(row["seeds"], np.int64)}
    out["rows"] = np.frombuffer(row["rows"], np.int32).reshape(-1, dim).astype(np.int64)
    out["windows"] = np.frombuffer(row["windows"], np.int64).reshape(len(out["ids"]), -1) if row.get("windows") else None
    return out


def _read(packs: DataFrame, shards: DataFrame, dim: int, k: int, wanted: Wanted, hits: Hits) -> DataFrame:
    """(pack, at, slot, score, vec_id): the first ``k`` of each shard for each anchor and slot.

    ``wanted`` judges boxes by their bounds, ``hits`` scores of the blocks that are read.
    """
    n_packs, n_shards = packs.count(), shards.count()
    teams, zones = max(1, -(-n_packs // MEET)), max(1, -(-n_shards // MEET))
    names = packs.columns
    team = F.pmod(F.xxhash64("pack"), F.lit(teams)).cast("int")

    def spread(groups: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))

    def choose(packed: pa.Table, zoned: pa.Table) -> pa.Table:
        out: dict[str, list] = {"shard": [], "team": [], "pack": [], "need": []}
        for row in packed.to_pylist():
            pack = _pack_of(row, dim)
            for zone in zoned.to_pylist():
                low, high = (np.frombuffer(zone[c], np.int32).reshape(-1, dim).astype(np.int64) for c in ("low", "high"))
                least, most = bounds(pack["rows"], low, high)
                need = wanted(pack, np.full(len(low), zone["label"]), least, most)
                if need.any():
                    for name, value in (("shard", zone["shard"]), ("team", row["team"]), ("pack", row["pack"]), ("need", np.packbits(need, axis=1).tobytes())):
                        out[name].append(value)
        return pa.table(out, pa.schema([("shard", pa.int64()), ("team", pa.int32()), ("pack", pa.int64()), ("need", pa.binary())]))

    asked = packs.withColumn("team", team)
    maps = shards.select("shard", "label", "low", "high").withColumn("zone", F.pmod(F.xxhash64("shard"), F.lit(zones)).cast("int"))
    chosen = (
        asked.withColumn("zone", spread(zones))
        .groupBy("team", "zone")
        .cogroup(maps.withColumn("team", spread(teams)).groupBy("team", "zone"))
        .applyInArrow(choose, "shard long, team int, pack long, need binary")
    )
    chosen = stage_table(chosen, "chosen")

    def score(packed: pa.Table, stored: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, ...]] = []
        for shard in stored.to_pylist():
            ids = np.frombuffer(shard["ids"], np.int64)
            rows = np.frombuffer(shard["rows"], np.int32).reshape(-1, dim).astype(np.int64)
            blocks = -(-len(ids) // BLOCK)
            for row in packed.to_pylist():
                pack = _pack_of(row, dim)
                need = np.unpackbits(np.frombuffer(row["need"], np.uint8).reshape(len(pack["ids"]), -1), axis=1, count=blocks).astype(bool)
                who, some = np.flatnonzero(need.any(1)), np.flatnonzero(need.any(0))
                of = np.concatenate([np.arange(b * BLOCK, min((b + 1) * BLOCK, len(ids))) for b in some.tolist()])
                scores = products(pack["rows"][who], rows[of])
                may = need[np.ix_(who, of // BLOCK)] & (pack["ids"][who][:, None] != ids[of][None, :])
                part = {n: v[who] if v is not None else None for n, v in pack.items()}
                at, slot, place = hits(part, scores, may, shard["label"])
                value, which = scores[at, place], ids[of][place]
                top = first_of(who[at] * 64 + slot, value, which, k)
                found.append((np.full(len(top), row["pack"]), who[at][top], slot[top], value[top], which[top]))
        columns = [np.concatenate(x) for x in zip(*found, strict=True)] if found else [np.zeros(0, np.int64)] * 5
        return pa.table(dict(zip(("pack", "at", "slot", "score", "vec_id"), (c.astype(np.int64) for c in columns), strict=True)))

    # Only shards that some pack has named go on to be read.
    named = shards.select("shard", "label", "ids", "rows").withColumn("team", spread(teams))
    named = named.join(chosen.select("shard", "team").distinct(), ["shard", "team"], "left_semi")
    asks = chosen.join(packs.select(*names), "pack")
    schema = "pack long, at long, slot long, score long, vec_id long"
    return asks.groupBy("shard", "team").cogroup(named.groupBy("shard", "team")).applyInArrow(score, schema)


def hard_negatives(
    vectors: DataFrame,
    anchors: Column,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    scale: float = 256.0,
    percent: int = 80,
    positives: int = 5,
    negatives: int = 5,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    Components become floor(scale * x), a score is an inner product of integers, and
    higher scores come first, ties by smaller id. ``anchors`` tells the rows that
    ask. An anchor's positives are its first ``positives`` rows of the same label;
    for each, the first ``negatives`` rows of other labels whose score lies between
    ``percent`` of the positive's and the positive's.

    Rows with a null id, label or vector, or with components that are null, not
    finite or of LARGEST or more take no part; with vectors of several lengths only
    the most frequent length does (the longer on a tie). Rows that repeat id, label
    and vector count once; rows of one id are never each other's positives or
    negatives. Fewer rows than asked for give fewer results; an empty table none.
    """
    clean = vectors.select(
        F.col(vec_id).cast("long").alias("vec_id"), F.col(label).cast("long").alias("label"), F.coalesce(anchors, F.lit(False)).alias("anchor"), F.col(vector).alias("v")
    ).filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & usable("v"))
    rows = clean.withColumn("v", F.transform(F.col("v").cast("array<double>"), lambda c: F.floor(c * scale).cast("long")))
    longest = rows.groupBy(F.size("v").alias("dim")).count().orderBy(F.desc("count"), F.desc("dim")).first()
    if longest is None:
        return vectors.sparkSession.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    dim = longest["dim"]
    shards = _shards(rows.filter(F.size("v") == dim), dim, positives)
    packs = _packs(shards, dim)

    def may_be_positive(pack: dict, label: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        return (pack["labels"][:, None] == label[None, :]) & (most >= pack["seeds"][:, None])

    def positive_hits(pack: dict, scores: np.ndarray, may: np.ndarray, label: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        at, place = np.nonzero(may & (scores >= pack["seeds"][:, None]))
        return at, np.zeros(len(at), np.int64), place

    best = Window.partitionBy("pack", "at").orderBy(F.desc("score"), "vec_id")
    first = _read(packs, shards, dim, positives, may_be_positive, positive_hits)
    first = first.withColumn("slot", F.row_number().over(best) - 1).filter(F.col("slot") < positives)
    first = stage_table(first.select("pack", "at", "slot", F.col("score").alias("positive_score"), F.col("vec_id").alias("positive_id")), "positives")

    def windows(packed: pa.Table, found: pa.Table) -> pa.Table:
        rows = []
        for row in packed.to_pylist():
            # A slot without a positive has a window that nothing falls into.
            out = np.full((len(row["ids"]) // 8, positives), NONE)
            out[found.column("at").to_numpy(), found.column("slot").to_numpy()] = found.column("positive_score").to_numpy()
            rows.append(row | {"windows": out.tobytes()})
        return pa.Table.from_pylist(rows, pa.schema([*packed.schema, pa.field("windows", pa.binary())]))

    schema = "pack long, labels binary, ids binary, rows binary, seeds binary, windows binary"
    armed = stage_table(packs.groupBy("pack").cogroup(first.groupBy("pack")).applyInArrow(windows, schema), "packs")

    def limits(pack: dict, slot: int) -> tuple[np.ndarray, np.ndarray]:
        top = pack["windows"][:, slot]
        floor = np.where(top == NONE, 0, -(-np.maximum(top, 0) * percent // 100))
        return np.where(top < 0, 1, floor)[:, None], np.where(top < 0, 0, top)[:, None]

    def may_be_negative(pack: dict, label: np.ndarray, least: np.ndarray, most: np.ndarray) -> np.ndarray:
        inside = np.zeros(least.shape, bool)
        for slot in range(positives):
            low, high = limits(pack, slot)
            inside |= (low <= high) & (least <= high) & (most >= low)
        return inside & (pack["labels"][:, None] != label[None, :])

    def negative_hits(pack: dict, scores: np.ndarray, may: np.ndarray, label: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        may = may & (pack["labels"][:, None] != label)
        found = []
        for slot in range(positives):
            low, high = limits(pack, slot)
            at, place = np.nonzero(may & (scores >= low) & (scores <= high))
            found.append((at, np.full(len(at), slot), place))
        at, slot, place = (np.concatenate(x) for x in zip(*found, strict=True))
        return at, slot, place

    second = _read(armed, shards, dim, negatives, may_be_negative, negative_hits)
    nearest = Window.partitionBy("pack", "at", "slot").orderBy(F.desc("score"), "vec_id")
    second = second.withColumn("rank", F.row_number().over(nearest)).filter(F.col("rank") <= negatives)

    def names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(ids), row["pack"])), pa.array(np.arange(len(ids))), pa.array(ids)], ["pack", "at", "anchor_id"])

    named = packs.select("pack", "ids").mapInArrow(names, "pack long, at long, anchor_id long")
    return (
        second.join(first, ["pack", "at", "slot"])
        .join(named, ["pack", "at"])
        .select(
            "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score")
        )
    )
