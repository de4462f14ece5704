"""Documents whose sets of word shingles have a large Jaccard similarity, by T-occurrence search.

Two sets of sizes x and y are alike when they share at least
T = t (x + y) / (100 + t) shingles, for a similarity of t percent. All documents
with one set form a class, and only classes are compared.

1. A bit filter tells which shingles of a share of the hash space occur twice.
   A document with more shingles that occur once than it may lack is alone: no
   list it could be found in has another document.
2. The others send their prefix: all but the last T - 1 of their shingles, those
   that occur once first, then by hash. Alike sets meet in a list of it. Within a
   list, counts of shingles in 64 cells bound the difference of two sets from
   below; what passes is a candidate. Lists send spanning links only.
3. Components of the candidates are groups. Long sets share much by chance and 64
   cells hardly tell them apart, so the members of a group of more than BLOCK first
   meet by the parities of at least two cells for each shingle; only what may still
   be alike stays together. Then each group's whole sets meet in one task, or in
   pairs of blocks if there are many. DivideSkip: a query merges its
   short inverted lists and probes the long ones by binary search for those
   members that can still reach T. Queries ask about members not yet reached, and
   a task sends spanning links only.
4. Components of the links name each class's smallest document.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from math import log2

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import filters
from millrace.llm import textops as tx
from millrace.llm.components import components, linked
from millrace.llm.spans import heads
from millrace.session import stage_table

CELLS = 64
BLOCK = 512  # members of one group that meet in one task
BITS_BLOCK = 2048  # the same, of parities alone
U64 = np.uint64


def needed(n: np.ndarray | int, percent: int) -> np.ndarray | int:
    """Shingles that a set of n must share with any set alike."""
    return -(-percent * n // 100)


def overlap(x: int, y: np.ndarray, percent: int) -> np.ndarray:
    """T: shingles that sets of sizes x and y must share to be alike."""
    return -(-percent * (x + y) // (100 + percent))


class Sets:
    """The distinct shingles of each document of a slice, sorted by document and hash."""

    def __init__(self, text: pa.Array, size: int) -> None:
        words = tx.words_of(text, lower=True)
        at, doc = tx.within(words.first, size)
        h = tx.window_hashes(words.hash, size)[at]
        n_words = np.diff(words.first)
        for n in range(1, size):  # too short for a shingle: the whole sequence is one
            short = np.flatnonzero(n_words == n)
            doc = np.append(doc, short)
            h = np.append(h, tx.mix(tx.window_hashes(words.hash, n)[words.first[short]] + U64(n)) if len(short) else np.zeros(0, U64))
        order = np.lexsort((h, doc))
        h, doc = h[order], doc[order]
        new = heads(h, doc)
        self.hash, self.doc = h[new], doc[new]
        self.count = np.bincount(self.doc, minlength=len(n_words))
        self.first = np.append(0, np.cumsum(self.count))

    def classes(self) -> np.ndarray:
        """One number for each distinct set."""
        total = np.append(U64(0), np.cumsum(tx.mix(self.hash ^ U64(0x5851F42D4C957F2D))))
        return tx.mix(total[self.first[1:]] - total[self.first[:-1]] + self.count.astype(U64)).view(np.int64)

    def cells(self) -> np.ndarray:
        """Shingles of each document in each cell, at most 255."""
        cell = ((self.hash >> U64(10)) & U64(CELLS - 1)).astype(np.int64)
        counts = np.bincount(self.doc * CELLS + cell, minlength=len(self.count) * CELLS)
        return np.minimum(counts, 255).astype(np.uint8).reshape(-1, CELLS)

    def parities(self, some: np.ndarray) -> list[bytes | None]:
        """One bit for each of ``bits_for`` cells of some documents: whether the number of shingles in it is odd."""
        bits = np.where(some, bits_for(self.count), 0)
        end = np.cumsum(bits)
        of = some[self.doc]
        doc = self.doc[of]
        cell = (end - bits)[doc] + (self.hash[of] & (bits[doc] - 1).astype(U64)).astype(np.int64)
        packed = np.packbits((np.bincount(cell, minlength=int(end[-1]) if len(end) else 0) & 1).astype(np.uint8))
        return [packed[(e - n) >> 3 : e >> 3].tobytes() if n else None for e, n in zip(end.tolist(), bits.tolist(), strict=True)]


def bits_for(n: np.ndarray) -> np.ndarray:
    """Cells whose parities tell sets of n apart: a power of two from 2 n to 4 n, 64 at least."""
    return 1 << np.ceil(np.log2(np.maximum(2 * n, 64))).astype(np.int64)


def _describe(docs: DataFrame, size: int, percent: int, total: int) -> DataFrame:
    """Per document: doc_id, n_shingles, class and, unless it is alone, its prefix, cells and parities; stored."""
    share = min(1.0, 2 * (100 - percent) / 100)
    top = U64(int(share * (2**64 - 1)))

    def sampled(batch: pa.RecordBatch) -> np.ndarray:
        h = Sets(batch.column("text"), size).hash
        return tx.mix(h[h <= top])

    twice = filters.share(docs.sparkSession, filters.build(docs.select("text"), sampled, total / 6 * share, "text", "twice"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.slices(batches, "text"):
            s = Sets(batch.column("text"), size)
            single = s.hash <= top
            single[single] = ~twice.value.has(tx.mix(s.hash[single]))
            singles = np.bincount(s.doc[single], minlength=len(s.count))
            take = np.where(s.count > 0, s.count - needed(s.count, percent) + 1, 0) - singles
            rest = np.flatnonzero(~single)
            doc = s.doc[rest]
            place = np.arange(len(rest)) - np.searchsorted(doc, np.arange(len(s.count)))[doc]
            chosen = rest[place < take[doc]]
            cut = np.searchsorted(s.doc[chosen], np.arange(len(s.count) + 1))
            h, cells, some = s.hash[chosen], s.cells(), take > 0
            prefix = [h[a:b].tobytes() if ok else None for a, b, ok in zip(cut[:-1].tolist(), cut[1:].tolist(), some.tolist(), strict=True)]
            sketch = [c.tobytes() if ok else None for c, ok in zip(cells, some.tolist(), strict=True)]
            columns = [batch.column("doc_id"), pa.array(s.count, pa.int64()), pa.array(s.classes()), pa.array(prefix, pa.binary()), pa.array(sketch, pa.binary()), pa.array(s.parities(some), pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_shingles", "class", "prefix", "cells", "bits"])

    done = stage_table(docs.mapInArrow(run, "doc_id long, n_shingles long, class long, prefix binary, cells binary, bits binary"), "sets")
    twice.unpersist()
    return done


def _candidates(described: DataFrame, percent: int, buckets: int) -> DataFrame:
    """Spanning links (a, b) between classes that share a list and may be alike."""

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            classes, n = (batch.column(c).to_numpy() for c in ("class", "n_shingles"))
            prefix = batch.column("prefix").to_pylist()
            counts = np.array([len(x) // 8 for x in prefix], np.int64)
            h = np.frombuffer(b"".join(prefix), U64)
            row = np.repeat(np.arange(len(counts)), counts)
            bucket = (h % U64(buckets)).astype(np.int64)
            order = np.lexsort((row, bucket))
            h, row, bucket = h[order], row[order], bucket[order]
            cells = batch.column("cells").to_pylist()
            cut = heads(bucket)
            for a, b in zip(cut.tolist(), [*cut[1:].tolist(), len(h)][: len(cut)], strict=True):
                some, of = np.unique(row[a:b], return_inverse=True)
                values = [h[a:b].tobytes(), of.astype(np.int32).tobytes(), classes[some].tobytes(), n[some].tobytes(), b"".join(cells[i] for i in some.tolist())]
                yield pa.RecordBatch.from_arrays([pa.array([bucket[a]], pa.int64()), *(pa.array([v], pa.binary()) for v in values)], ["bucket", "lists", "members", "classes", "sizes", "cells"])

    def join(table: pa.Table) -> pa.Table:
        lists, member, classes, sizes, cells, base = [], [], [], [], [], 0
        for row in table.to_pylist():
            lists.append(np.frombuffer(row["lists"], U64))
            member.append(np.frombuffer(row["members"], np.int32).astype(np.int64) + base)
            classes.append(np.frombuffer(row["classes"], np.int64))
            sizes.append(np.frombuffer(row["sizes"], np.int64))
            cells.append(np.frombuffer(row["cells"], np.uint8).reshape(-1, CELLS))
            base += len(classes[-1])
        lists, member, classes, sizes, cells = (np.concatenate(x) for x in (lists, member, classes, sizes, cells))
        # One entry for each class and list.
        order = np.lexsort((classes[member], lists))
        order = order[heads(lists[order], classes[member[order]])]
        lists, member = lists[order], member[order]
        at = heads(lists)
        size = np.diff(np.append(at, len(lists)))
        a, b, done = [], [], set()
        for start, n in zip(at[size > 1].tolist(), size[size > 1].tolist(), strict=True):
            here = member[start : start + n]
            key = classes[here].tobytes()
            if key in done:  # the same members met in another list of this bucket
                continue
            done.add(key)
            counts, kinds = sizes[here], cells[here].astype(np.int16)

            def may(i: int, others: np.ndarray, counts: np.ndarray = counts, kinds: np.ndarray = kinds) -> np.ndarray:
                x, y = int(counts[i]), counts[others]
                room = x + y - 2 * overlap(x, y, percent)
                near = np.abs(x - y) <= room
                near[near] = np.abs(kinds[others[near]] - kinds[i]).sum(1) <= room[near]
                return near

            x, y = linked(n, may)
            a.append(classes[here[x]])
            b.append(classes[here[y]])
        nothing = [np.zeros(0, np.int64)]
        return pa.table({"a": np.concatenate(a + nothing), "b": np.concatenate(b + nothing)})

    # Copies have one class and one prefix: a prefix takes a tenth of what its lists take, so copies go before it is dealt.
    dealt = described.filter("prefix IS NOT NULL").select("class", "n_shingles", "prefix", "cells").dropDuplicates(["class"])
    met = dealt.mapInArrow(deal, "bucket long, lists binary, members binary, classes binary, sizes binary, cells binary").groupBy("bucket").applyInArrow(join, "a long, b long")
    return stage_table(met, "candidates")


def differing(bits: list[bytes]) -> Callable[[int, np.ndarray], np.ndarray]:
    """A function (i, others) with the number of cells whose parities differ, which is never more than the elements that do.

    Sets with numbers of cells more than twice apart count as differing in none.
    """
    length = np.array([len(b) for b in bits], np.int64)
    place = np.zeros(len(bits), np.int64)
    rows, halves = {}, {}
    for n in np.unique(length).tolist():
        own = np.flatnonzero(length == n)
        place[own] = np.arange(len(own))
        rows[n] = np.frombuffer(b"".join(bits[i] for i in own.tolist()), U64).reshape(len(own), -1)
        if n > 8:  # the two halves of the cells laid over each other
            halves[n] = rows[n][:, : n // 16] ^ rows[n][:, n // 16 :]

    def count(i: int, others: np.ndarray) -> np.ndarray:
        out, n = np.zeros(len(others), np.int64), int(length[i])
        for m, mine, theirs in ((n, rows, rows), (n // 2, halves, rows), (2 * n, rows, halves)):
            if n in mine and m in theirs:
                at = np.flatnonzero(length[others] == m)
                out[at] = np.bitwise_count(theirs[m][place[others[at]]] ^ mine[n][place[i]]).sum(1, dtype=np.int64)
        return out

    return count


def _narrowed(described: DataFrame, groups: DataFrame, percent: int, buckets: int) -> DataFrame:
    """The groups, those of more than BLOCK members cut into the components of what may be alike by its parities."""
    groups = stage_table(groups, "wide-groups")
    counts = groups.groupBy(F.col("component").alias("group")).agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > BLOCK)
    counts = stage_table(counts, "large-groups")
    if counts.isEmpty():
        return groups
    large = groups.join(counts, F.col("component") == F.col("group")).select("node", "group", F.ceil(F.col("n") / BITS_BLOCK).cast("int").alias("blocks"))
    known = described.filter("bits IS NOT NULL").join(large, F.col("class") == F.col("node")).select("class", "n_shingles", "bits", "group", "blocks").dropDuplicates(["class"])
    known = known.withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    # A block meets every block of its group, itself included.
    pairs = known.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "class", "n_shingles", "bits", "group", (F.col("block") > F.col("other")).cast("int").alias("side"), F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )

    def find(table: pa.Table) -> pa.Table:
        classes, n, group, side, low, high = (table.column(c).to_numpy() for c in ("class", "n_shingles", "group", "side", "low", "high"))
        order = np.lexsort((classes, high, low, group))
        classes, n, group, side, low, high = (x[order] for x in (classes, n, group, side, low, high))
        bits, order = table.column("bits").combine_chunks(), order.tolist()
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        cut = heads(group, low, high)
        for start, stop in zip(cut.tolist(), [*cut[1:].tolist(), len(group)][: len(cut)], strict=True):
            count, sides, one = n[start:stop], side[start:stop], low[start] == high[start]
            apart = differing([bits[i].as_py() for i in order[start:stop]])

            def may(i: int, others: np.ndarray, count: np.ndarray = count, sides: np.ndarray = sides, one: bool = one, apart: Callable = apart) -> np.ndarray:
                x, y = int(count[i]), count[others]
                room = x + y - 2 * overlap(x, y, percent)
                near = (np.abs(x - y) <= room) & (one | (sides[others] != sides[i]))
                near[near] = apart(i, others[near]) <= room[near]
                return near

            x, y = linked(stop - start, may)
            a.append(classes[start:stop][x])
            b.append(classes[start:stop][y])
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    meeting = F.pmod(F.xxhash64("group", "low", "high"), F.lit(buckets)).alias("bucket")
    links = stage_table(pairs.select(meeting, "*").groupBy("bucket").applyInArrow(find, "a long, b long"), "narrow-links")
    return groups.join(counts, F.col("component") == F.col("group"), "left_anti").union(components(links))


def search(sets: list[np.ndarray], sides: np.ndarray | None, percent: int, mu: float = 0.01) -> tuple[np.ndarray, np.ndarray]:
    """Spanning links between sorted sets that are alike, by DivideSkip.

    ``sides``: 0 or 1 of each set; links within a side are then left to other tasks,
    but the sets of one side that a link leads to still join one component.
    """
    n = np.array([len(s) for s in sets], np.int64)
    tokens = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), n)
    order = np.lexsort((owner, tokens))
    lists = owner[order]
    at = heads(tokens[order])
    ends = np.append(at[1:], len(tokens))
    number = np.empty(len(tokens), np.int64)  # the list of each token of each set
    number[order] = np.repeat(np.arange(len(at)), ends - at)
    first = np.append(0, np.cumsum(n))
    length = ends - at

    def alike(i: int, others: np.ndarray) -> np.ndarray:
        out = np.zeros(len(others), bool)
        x = int(n[i])
        own = number[first[i] : first[i + 1]]
        own = own[np.argsort(length[own], kind="stable")]
        least = int(needed(x, percent))
        # Long lists set aside: more where lists are short beside the threshold.
        skip = min(least - 1, int(least / (mu * log2(max(2, int(length[own[-1]]))) + 1)))
        short, long = own[: x - skip], own[x - skip :]
        member = lists[tx.gather(at[short], length[short])]
        count = np.bincount(member, minlength=len(n))[others]
        may = np.flatnonzero((count >= least - skip) & (n[others] * 100 >= percent * x) & (x * 100 >= percent * n[others]))
        if sides is not None:
            may = may[sides[others[may]] != sides[i]]
        if not len(may):
            return out
        count, need = count[may], overlap(x, n[others[may]], percent)
        if len(may) <= len(long):
            probe = np.sort(tokens[order[at[long]]])
            for k, j in enumerate(others[may].tolist()):
                place = np.minimum(np.searchsorted(sets[j], probe), n[j] - 1)
                count[k] += int((sets[j][place] == probe).sum())
        else:
            asked = others[may]
            left = len(long)
            for t in long.tolist():
                inside = lists[at[t] : ends[t]]
                place = np.minimum(np.searchsorted(inside, asked), len(inside) - 1)
                count += inside[place] == asked
                left -= 1
                if left % 64 == 0:
                    live = count + left >= need
                    if not live.all():
                        may, asked, count, need = may[live], asked[live], count[live], need[live]
                        if not len(may):
                            return out
        out[may[count >= need]] = True
        return out

    return linked(len(sets), alike)


def _links(docs: DataFrame, described: DataFrame, groups: DataFrame, size: int, percent: int, buckets: int) -> DataFrame:
    """Spanning links (a, b) between classes that are alike, found within the groups."""
    spark = docs.sparkSession
    first = described.filter("prefix IS NOT NULL AND doc_id IS NOT NULL").groupBy("class").agg(F.min("doc_id").alias("doc_id"))
    members = stage_table(groups.join(first, groups["node"] == first["class"]).select("doc_id", "class", F.col("component").alias("group")), "members")
    counts = members.groupBy("group").agg(F.count(F.lit(1)).alias("n"))
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = members.join(counts, "group").withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("class"), F.col("blocks")).cast("int"))
    # A block meets every block of its group, itself included; small groups have one.
    pairs = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "doc_id", "class", "group", (F.col("block") > F.col("other")).cast("int").alias("side"), F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high")
    )
    wanted = filters.share(
        spark, filters.build(members.select("doc_id"), lambda b: tx.mix(b.column("doc_id").to_numpy().view(U64)), float(members.count()), keep="once")
    )

    def sets_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.slices(batches, "text"):
            ids = batch.column("doc_id").to_numpy()
            keep = wanted.value.has(tx.mix(ids.view(U64)))
            if keep.any():
                batch = batch.filter(pa.array(keep))
                s = Sets(batch.column("text"), size)
                sets = [s.hash[a:b].tobytes() for a, b in zip(s.first[:-1].tolist(), s.first[1:].tolist(), strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(s.classes()), pa.array(sets, pa.binary())], ["doc_id", "class", "shingles"])

    sets = docs.filter("doc_id IS NOT NULL").mapInArrow(sets_of, "doc_id long, class long, shingles binary")
    meeting = F.pmod(F.xxhash64("group", "low", "high"), F.lit(buckets)).alias("bucket")
    together = pairs.join(sets, ["doc_id", "class"]).select(meeting, "group", "low", "high", "side", "class", "shingles")

    def find(table: pa.Table) -> pa.Table:
        group, low, high, side, classes = (table.column(c).to_numpy() for c in ("group", "low", "high", "side", "class"))
        order = np.lexsort((classes, high, low, group))
        order = order[heads(group[order], low[order], high[order], classes[order])]  # repeated rows of one document meet once
        group, low, high, side, classes = group[order], low[order], high[order], side[order], classes[order]
        shingles, order = table.column("shingles").combine_chunks(), order.tolist()
        a, b = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        cut = heads(group, low, high)
        for start, stop in zip(cut.tolist(), [*cut[1:].tolist(), len(group)][: len(cut)], strict=True):
            if stop - start > 1:
                sets = [np.frombuffer(shingles[i].as_buffer(), U64) for i in order[start:stop]]
                x, y = search(sets, None if low[start] == high[start] else side[start:stop], percent)
                a.append(classes[start:stop][x])
                b.append(classes[start:stop][y])
        return pa.table({"a": np.concatenate(a), "b": np.concatenate(b)})

    # Stored before their components are sought, so that one Python worker for each task is at work.
    return stage_table(together.groupBy("bucket").applyInArrow(find, "a long, b long"), "links")


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles and component_id: the smallest doc_id reachable by links.

    Documents link when their sets of ``size``-word shingles (A-Z as a-z; fewer
    words are one shingle) have a Jaccard similarity of at least ``percent``. A
    text that is null or has no word has an empty set and is linked with nothing.
    Rows that repeat an id count as documents of their own with one id. A row
    without an id gets the smallest id of its component, if any. Other columns
    are ignored; an empty table gives an empty result. Shingles and sets are
    compared by 64-bit hashes.
    """
    docs = tx.small_batches(docs).select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(64, total >> 20)  # what meets in one task at once grows with a bucket
    described = _describe(docs, size, percent, total)
    groups = _narrowed(described, components(_candidates(described, percent, buckets)), percent, buckets)
    linked_classes = components(_links(docs, described, groups, size, percent, buckets))
    classes = described.filter("n_shingles > 0").groupBy("class").agg(F.min("doc_id").alias("low"))
    named = classes.join(linked_classes, classes["class"] == linked_classes["node"], "left").select(
        "class", "low", F.coalesce("component", "class").alias("component")
    )
    lowest = named.groupBy("component").agg(F.min("low").alias("component_id"), F.count(F.lit(1)).alias("_n"), F.first("low").alias("_low"))
    of_class = named.join(lowest, "component").select("class", "component_id")
    # Only documents that share their set or are linked need a look-up; the others name themselves.
    return described.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("class")).alias("class")).join(of_class, "class", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_first(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", size: int = 5, percent: int = 80) -> DataFrame:
    """All columns of the documents with the smallest id of their group.

    Rows that repeat id and text stay once; rows of one id with different texts
    stay or go together. Rows without an id belong to no group and stay. Rows that
    a bit filter of the ids that stay does not hold go where they are; only those
    are shuffled that may go, or may be repeated, by a second filter.
    """
    groups = stage_table(near_duplicates(docs, doc_id, text, size, percent).filter("doc_id IS NOT NULL"), "groups")
    marks = groups.groupBy("doc_id").agg(F.max(F.col("doc_id") != F.col("component_id")).alias("_goes"), F.count(F.lit(1)).alias("_n"))
    marks = stage_table(marks.select(F.col("doc_id").alias("_id"), "_goes", "_n"), "marks")
    stay, marks = marks.filter("NOT _goes").select("_id"), marks.filter("_goes OR _n > 1").select("_id", "_goes")
    key = lambda ids: tx.mix(ids.to_numpy(zero_copy_only=False).view(U64))
    touched, staying = (
        filters.share(docs.sparkSession, filters.build(ids, lambda b: key(b.column("_id")), float(ids.count()), keep="once")) for ids in (marks, stay)
    )
    names = docs.columns
    boxed = docs.select(F.struct(*names).alias("row"), F.col(doc_id).cast("long").alias("id"))

    def only(hit: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                ids = batch.column("id")
                hashes, valid = key(ids.fill_null(0)), ids.is_valid().to_numpy(zero_copy_only=False)
                found = touched.value.has(hashes) & valid
                yield batch.filter(pa.array(found & staying.value.has(hashes) if hit else ~found))

        return boxed.mapInArrow(run, boxed.schema)

    some = only(True).join(marks, F.col("id") == F.col("_id"), "left").filter(~F.coalesce("_goes", F.lit(False)))
    some = some.select(F.col("row"), F.col("id"), F.col("row").getField(text).alias("_text")).dropDuplicates(["id", "_text"])
    return only(False).select("row.*").union(some.select("row.*"))
