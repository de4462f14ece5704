"""Near duplicates by HyperMinHash sketches, banded, estimated and then verified on whole sets.

1. A document's distinct word shingles are dealt to REGISTERS buckets by hash. A
   register keeps the least hash of its bucket in 16 bits: its count of leading
   zeros and the MANTISSA bits after the leading one. An empty register borrows from
   the first filled one in a fixed random order of its own, so that short texts
   have whole sketches too. Documents with one set form a class; only classes go on.
2. BANDS bands of ROWS registers are keys. Classes that share a key form a list, and
   a list meets in one task, which estimates similarities and sends spanning links.
   Lists of more than LIST members first compare them, in rounds of joins, with the
   list's smallest class. Registers that differ are a distance, so the triangle
   inequality holds: who is within CORE of the centre has all its likely partners
   within reach of the centre, and leaves the list. What is left after ROUNDS rounds
   meets in pairs of blocks.
3. Components of the likely pairs are groups. Whole sets of a group meet in blocks,
   each with the group's centre. Only members not linked to the centre meet the
   other blocks.
4. Components of the verified links name each class's smallest document.

Two sets with a similarity of 0.8 share no band with a probability of about 1e-11,
and are estimated below LEAST with about 1e-9.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.llm import filters
from millrace.llm import textops as tx
from millrace.llm.components import components, forest, linked
from millrace.llm.spans import heads
from millrace.session import stage_table

U64 = np.uint64
BANDS, ROWS = 48, 4
REGISTERS = BANDS * ROWS
MANTISSA = 10
CORE = 24  # registers that differ from the centre's, at most, of a member that leaves its list
LEAST = 0.58  # estimated similarity of a pair worth verifying
FEW = 64  # sets below this size fill few buckets, so their estimate is coarse:
LEAST_FEW = 0.33  # less is enough
LIST = 4096  # members of a list, or of a block of one, that meet at once
ROUNDS = 3
BLOCK = 512  # members of a group whose whole sets meet at once
BLOCK_SHINGLES = 1 << 20  # or fewer, if their sets hold more than this

_ORDER = np.argsort(np.random.default_rng(12).random((REGISTERS, REGISTERS)), axis=1)  # where each register borrows from, first choice first
_RANK = np.argsort(_ORDER, axis=1)


def shingle_sets(text: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes, documents, counts) of the distinct shingles of a slice, sorted by document and hash."""
    words = tx.words_of(text, lower=True)
    n_words = np.diff(words.first)
    at, doc = tx.within(words.first, size)
    found, owner = [tx.window_hashes(words.hash, size)[at]], [doc]
    for n in range(1, size):  # fewer words than a shingle has: all of them are one
        short = np.flatnonzero(n_words == n)
        if len(short):
            found.append(tx.mix(tx.window_hashes(words.hash, n)[words.first[short]] + U64(n)))
            owner.append(short)
    h, doc = np.concatenate(found), np.concatenate(owner)
    order = np.lexsort((h, doc))
    new = heads(doc[order], h[order])
    h, doc = h[order][new], doc[order][new]
    return h, doc, np.bincount(doc, minlength=len(n_words))


def compress(least: np.ndarray) -> np.ndarray:
    """Registers of least hashes: leading zeros, then the bits after the leading one; never 0."""
    top = least >> U64(11)  # 53 bits, which a double holds exactly
    length = np.frexp(top.astype(float))[1]
    shift = length - 1 - MANTISSA
    bits = np.where(shift >= 0, top >> np.maximum(shift, 0).astype(U64), top << np.maximum(-shift, 0).astype(U64))
    return ((53 - length) * (1 << MANTISSA) + (bits & U64((1 << MANTISSA) - 1)).astype(np.int64) + 1).astype(np.uint16)


def sketch(h: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """Registers of each document; all 0 without shingles."""
    value = tx.mix(h ^ U64(0xA0761D6478BD642F))
    bucket = (((value >> U64(32)) * U64(REGISTERS)) >> U64(32)).astype(np.int64)
    value = tx.mix(value + U64(0xE7037ED1A0B428DB))
    place = doc * REGISTERS + bucket
    order = np.lexsort((value, place))
    at = order[heads(place[order])]
    out = np.zeros(n_docs * REGISTERS, np.uint16)
    out[place[at]] = compress(value[at])
    own = out.reshape(n_docs, REGISTERS)
    full = own.copy()
    some = np.flatnonzero(own.any(1))
    for choice in range(12):
        some = some[(full[some] == 0).any(1)]
        if not len(some):
            break
        lent = own[some][:, _ORDER[:, choice]]
        full[some] = np.where(full[some] == 0, lent, full[some])
    for i in some[(full[some] == 0).any(1)].tolist():  # few filled: pick the best ranked of them
        filled, empty = np.flatnonzero(own[i]), np.flatnonzero(full[i] == 0)
        full[i, empty] = own[i, filled[np.argmin(_RANK[np.ix_(empty, filled)], axis=1)]]
    return full


def similarity(differ: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Jaccard estimate, corrected for collisions, from the registers that differ in sketches of sets of sizes x and y.

    Least hashes that differ agree in a register if they fall into one cell of the
    compression. Cells have a width of 2^-MANTISSA / (2 ln 2) of their hash on
    average, and for u and v hashes in a bucket the chance is that width times
    u v / (u + v)^2. What this adds to the share of agreeing registers is taken off.
    """
    chance = 2.0**-MANTISSA / (2 * np.log(2)) * (x * y) / np.maximum(1, (x + y) ** 2)
    return (1 - differ / REGISTERS - chance) / (1 - chance)


def band_keys(registers: np.ndarray) -> np.ndarray:
    """A 64-bit key of each band of each row."""
    packed = np.ascontiguousarray(registers).view(U64).reshape(len(registers), BANDS)
    return tx.mix(tx.mix(packed) + np.arange(1, BANDS + 1, dtype=U64) * U64(0x8EBC6AF09C88C6E3))


def reach(n: np.ndarray, percent: int) -> np.ndarray:
    """Registers that may differ from a centre whose core holds a partner of a set of size n."""
    least = np.where(n * percent >= FEW * 100, LEAST, LEAST_FEW)  # an estimate is never above the share that agrees
    return np.floor((1 - least) * REGISTERS) + CORE


def _registers(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint16).reshape(-1, REGISTERS)


def _describe(docs: DataFrame, size: int) -> DataFrame:
    """doc_id, n_shingles, class and registers of every row, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.slices(batches, "text"):
            h, doc, counts = shingle_sets(batch.column("text"), size)
            registers = sketch(h, doc, batch.num_rows)
            columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(_classes(h, counts)), pa.array([r.tobytes() if n else None for r, n in zip(registers, counts.tolist(), strict=True)], pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "class", "registers"])

    return stage_table(docs.mapInArrow(run, "doc_id long, n_shingles long, class long, registers binary"), "sketches")


def _classes(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """One number for each distinct set."""
    total = np.append(U64(0), np.cumsum(tx.mix(h ^ U64(0x589965CC75374CC3))))
    ends = np.cumsum(counts)
    return tx.mix(total[ends] - total[ends - counts] + counts.astype(U64)).view(np.int64)


def _lists(kinds: DataFrame) -> DataFrame:
    """(key, class, members) of bands that at least two classes share, stored."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = band_keys(_registers(batch.column("registers")))
            classes = np.repeat(batch.column("class").to_numpy(), BANDS)
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(classes)], ["key", "class"])

    bands = kinds.select("class", "registers").mapInArrow(run, "key long, class long")
    shared = bands.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1")
    return stage_table(bands.join(shared, "key"), "lists")


def _judge(pairs: DataFrame, kinds: DataFrame, percent: int) -> DataFrame:
    """(class, center, state) of distinct pairs, stored; state 1: within reach of the centre, 2: in its core too."""
    one = kinds.select("class", "n", "registers")
    other = kinds.select(F.col("class").alias("center"), F.col("registers").alias("center_registers"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            differ = (_registers(batch.column("registers")) != _registers(batch.column("center_registers"))).sum(1)
            state = (differ <= reach(batch.column("n").to_numpy(), percent)).astype(np.int32) + (differ <= CORE)
            yield pa.RecordBatch.from_arrays([batch.column("class"), batch.column("center"), pa.array(state.astype(np.int32))], ["class", "center", "state"])

    return stage_table(pairs.join(one, "class").join(other, "center").mapInArrow(run, "class long, center long, state int"), "judged")


def _meet(lists: DataFrame, kinds: DataFrame, percent: int) -> DataFrame:
    """Spanning links (a, b) between likely pairs of lists (key, class, members); long lists meet block by block."""
    buckets = max(64, lists.count() // 8192)
    placed = lists.withColumn("blocks", F.ceil(F.col("members") / LIST).cast("int"))
    placed = placed.withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "key", "class", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )
    full = met.join(kinds.select("class", "n", "registers"), "class").withColumn("bucket", F.pmod(F.xxhash64("key", "low", "high"), F.lit(buckets)))

    def find(table: pa.Table) -> pa.Table:
        key, low, high, classes, n = (table.column(c).to_numpy() for c in ("key", "low", "high", "class", "n"))
        order = np.lexsort((classes, high, low, key))
        registers = _registers(table.column("registers").combine_chunks())[order]
        key, low, high, classes, n = key[order], low[order], high[order], classes[order], n[order]
        cut = heads(key, low, high)
        done: set[bytes] = set()
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for start, stop in zip(cut.tolist(), [*cut[1:].tolist(), len(key)], strict=True):
            here = classes[start:stop]
            if len(here) < 2 or here.tobytes() in done:  # the same members met in another list
                continue
            done.add(here.tobytes())
            own, count = registers[start:stop], n[start:stop]

            def likely(i: int, others: np.ndarray, own: np.ndarray = own, count: np.ndarray = count) -> np.ndarray:
                x, y = count[i], count[others]
                near = np.minimum(x, y) * 100 >= percent * np.maximum(x, y)
                y = y[near]
                differ = (own[others[near]] != own[i]).sum(1)
                near[near] = similarity(differ, x, y) >= np.where(np.minimum(x, y) >= FEW, LEAST, LEAST_FEW)
                return near

            x, y = linked(len(here), likely)
            a.append(here[x])
            b.append(here[y])
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    return full.select("bucket", "key", "low", "high", "class", "n", "registers").groupBy("bucket").applyInArrow(find, "a long, b long")


def _thinned(lists: DataFrame, kinds: DataFrame, percent: int) -> tuple[DataFrame, DataFrame]:
    """(links to centres, what is left of the lists) after rounds of comparing all members of long lists with a centre."""
    found: DataFrame | None = None
    for _ in range(ROUNDS):
        centres = lists.groupBy("key").agg(F.min("class").alias("center"))
        led = lists.join(centres, "key").filter(F.col("class") != F.col("center"))
        judged = _judge(led.select("class", "center").distinct(), kinds, percent)
        links = judged.filter("state > 0").select(F.col("class").alias("a"), F.col("center").alias("b"))
        found = links if found is None else found.union(links)
        left = led.join(judged.filter("state = 2").select("class", "center"), ["class", "center"], "left_anti").select("key", "class")
        left = stage_table(left, "left")
        lists = left.join(left.groupBy("key").agg(F.count(F.lit(1)).alias("members")).filter("members > 1"), "key")
    return found, stage_table(lists, "lists")


def _candidates(kinds: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) whose components hold every likely pair."""
    lists = _lists(kinds)
    long = lists.filter(F.col("members") > LIST)
    if long.isEmpty():
        return _meet(lists, kinds, percent)
    links, left = _thinned(long.select("key", "class"), kinds, percent)
    return links.union(_meet(lists.filter(F.col("members") <= LIST).unionByName(left), kinds, percent))


class Group:
    """Whole sets that meet in one task, with lists of who holds each shingle."""

    def __init__(self, sets: list[np.ndarray], percent: int) -> None:
        self.sets, self.percent = sets, percent
        self.n = np.array([len(s) for s in sets], np.int64)
        tokens, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), self.n)
        order = np.argsort(tokens, kind="stable")
        self.owner = owner[order]
        at = heads(tokens[order])
        self.token, self.at, self.length = tokens[order][at], at, np.diff(np.append(at, len(tokens)))

    def alike(self, i: int, others: np.ndarray) -> np.ndarray:
        """Which of ``others`` have a similarity of at least ``percent`` with i, exactly."""
        place = np.searchsorted(self.token, self.sets[i])
        shared = np.bincount(self.owner[tx.gather(self.at[place], self.length[place])], minlength=len(self.n))[others]
        return shared * 100 >= self.percent * (self.n[i] + self.n[others] - shared)


def _verified(docs: DataFrame, kinds: DataFrame, groups: DataFrame, size: int, percent: int) -> DataFrame:
    """Links (a, b) between classes of a group whose whole sets are alike, stored."""
    spark = docs.sparkSession
    members = groups.join(kinds.filter("doc_id IS NOT NULL").select("class", "doc_id", "n"), groups["node"] == F.col("class"))
    members = stage_table(members.select(F.col("component").alias("group"), "class", "doc_id", "n"), "members")
    sizes = members.groupBy("group").agg(F.count(F.lit(1)).alias("members"), F.sum("n").alias("shingles"), F.min("class").alias("centre"))
    blocks = F.ceil(F.greatest(F.col("members") / BLOCK, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    placed = members.join(sizes.filter("members > 1"), "group").withColumn("blocks", blocks)
    placed = stage_table(placed.withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int")), "placed")
    total = placed.agg(F.sum("n")).first()[0] or 0
    buckets = max(64, total >> 17)  # about a megabyte of shingles each
    wanted = spark.sparkContext.broadcast(
        filters.build(placed.select("doc_id"), lambda b: tx.mix(b.column("doc_id").to_numpy().view(U64)), float(max(1, placed.count())), keep="once")
    )

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.slices(batches, "text"):
            keep = wanted.value.has(tx.mix(batch.column("doc_id").to_numpy().view(U64)))
            if keep.any():
                batch = batch.filter(pa.array(keep))
                h, _, counts = shingle_sets(batch.column("text"), size)
                ends = np.cumsum(counts)
                sets = [h[b - c : b].tobytes() for b, c in zip(ends.tolist(), counts.tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(_classes(h, counts)), pa.array(sets, pa.binary())], ["doc_id", "class", "shingles"])

    sets = docs.filter("doc_id IS NOT NULL").mapInArrow(sets_of, "doc_id long, class long, shingles binary")
    sets = sets.join(placed.select("doc_id", "class", "group", "block", "blocks", "centre"), ["doc_id", "class"])
    sets = stage_table(sets.select("group", "class", "block", "blocks", "centre", "shingles"), "sets")

    # First every block with its group's centre.
    everywhere = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    centres = sets.filter("class = centre AND blocks > 1").withColumn("other", everywhere).filter("other <> block")
    own = sets.select("group", "class", "centre", "block", "blocks", "shingles")
    met = own.union(centres.select("group", "class", "centre", F.col("other").alias("block"), "blocks", "shingles"))
    met = met.withColumn("bucket", F.pmod(F.xxhash64("group", "block"), F.lit(buckets)))

    def first(table: pa.Table) -> pa.Table:
        group, block, classes, centre, several = (table.column(c).to_numpy() for c in ("group", "block", "class", "centre", "blocks"))
        order = np.lexsort((classes, block, group))
        order = order[heads(group[order], block[order], classes[order])]
        shingles = table.column("shingles").combine_chunks()
        cut = heads(group[order], block[order]).tolist()
        out: list[tuple[np.ndarray, ...]] = []
        for start, stop in zip(cut, [*cut[1:], len(order)], strict=True):
            some = order[start:stop]
            here = Group([np.frombuffer(shingles[i].as_buffer(), U64) for i in some.tolist()], percent)
            x, y = linked(len(some), here.alike)
            a, b = classes[some[x]], classes[some[y]]
            out.append((a, b, np.zeros(len(a), np.int64)))
            if several[some[0]] > 1:
                node, root = forest(a, b)
                tree = dict(zip(node.tolist(), root.tolist(), strict=True))
                base = tree.get(int(centre[some[0]]), int(centre[some[0]]))
                apart = np.array([c for c in classes[some].tolist() if tree.get(c, c) != base], np.int64)
                out.append((apart, np.full(len(apart), group[some[0]]), np.ones(len(apart), np.int64)))
        columns = [np.concatenate(c) for c in zip(*out, strict=True)]
        return pa.table(dict(zip(("a", "b", "apart"), columns, strict=True)))

    names = ("bucket", "group", "block", "class", "centre", "blocks", "shingles")
    found = stage_table(met.select(*names).groupBy("bucket").applyInArrow(first, "a long, b long, apart long"), "verified")

    # Then those apart from the centre, in blocks of their own, with every block of the group.
    apart = found.filter("apart = 1").select(F.col("a").alias("class"), F.col("b").alias("group"))
    counts = apart.groupBy("group").agg(F.count(F.lit(1)).alias("askers"))
    asking = sets.join(apart, ["group", "class"]).join(counts, "group").withColumn("teams", F.ceil(F.col("askers") / BLOCK).cast("int"))
    asking = asking.withColumn("team", F.pmod(F.xxhash64("class"), F.col("teams")).cast("int"))
    asking = asking.select("group", "class", "team", everywhere.alias("block"), F.lit(1).alias("asks"), "shingles")
    asked = sets.join(counts, "group").select("group", "class", F.explode(F.sequence(F.lit(0), F.ceil(F.col("askers") / BLOCK).cast("int") - 1)).alias("team"), "block", F.lit(0).alias("asks"), "shingles")
    pairs = asking.union(asked).withColumn("bucket", F.pmod(F.xxhash64("group", "team", "block"), F.lit(buckets)))

    def second(table: pa.Table) -> pa.Table:
        group, team, block, asks, classes = (table.column(c).to_numpy() for c in ("group", "team", "block", "asks", "class"))
        order = np.lexsort((-asks, classes, block, team, group))
        order = order[heads(group[order], team[order], block[order], classes[order])]  # who asks and is asked stands once, as asking
        shingles = table.column("shingles").combine_chunks()
        cut = heads(group[order], team[order], block[order]).tolist()
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for start, stop in zip(cut, [*cut[1:], len(order)], strict=True):
            some = order[start:stop]
            here = Group([np.frombuffer(shingles[i].as_buffer(), U64) for i in some.tolist()], percent)
            everyone = np.arange(len(some))
            hits = [(i, everyone[here.alike(i, everyone)]) for i in np.flatnonzero(asks[some]).tolist()]
            x = np.repeat([i for i, _ in hits], [len(h) for _, h in hits]).astype(np.int64)
            y = np.concatenate([h for _, h in hits]) if hits else x
            node, root = forest(classes[some[x]], classes[some[y]])
            a.append(node)
            b.append(root)
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    more = pairs.groupBy("bucket").applyInArrow(second, "a long, b long")
    links = stage_table(found.filter("apart = 0").select("a", "b").union(more), "links")
    wanted.unpersist()
    return links


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links) and kept (it is its own).

    Documents link when their sets of ``size``-word shingles (A-Z as a-z; fewer
    words are one shingle) have a Jaccard similarity of at least ``percent``, which
    must be 80 or more: the bands are made for that. A text that is null or has no
    word has an empty set and is linked with nothing. Rows that repeat an id count
    as documents of their own with one id. A row without an id is linked only
    through documents with its set; its component may be null. Other columns are
    ignored; an empty table gives an empty result. Shingles and sets are compared
    by 64-bit hashes.
    """
    if percent < 80:
        raise ValueError("bands are made for a similarity of 80 percent or more")
    docs = tx.small_batches(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    described = _describe(docs, size)
    some = described.filter("n_shingles > 0")
    kinds = some.groupBy("class").agg(F.min("doc_id").alias("doc_id"), F.first("n_shingles").alias("n"), F.first("registers").alias("registers"))
    kinds = stage_table(kinds, "classes")
    groups = components(_candidates(kinds, percent))
    joined = components(_verified(docs, kinds, groups, size, percent))
    named = kinds.select("class", "doc_id").join(joined, F.col("class") == F.col("node"))
    lowest = named.groupBy("component").agg(F.min("doc_id").alias("component_id"))
    of_linked = named.join(lowest, "component").select("class", F.col("component_id").alias("low"))
    of_class = kinds.select("class", "doc_id").join(of_linked, "class", "left").select("class", F.coalesce("low", "doc_id").alias("low"))
    out = described.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("class")).alias("class")).join(of_class, "class", "left")
    component = F.coalesce("low", "doc_id")
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
