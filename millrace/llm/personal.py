"""Personal data: base patterns, and contextual extraction bootstrapped from what they find.

1. Base patterns find seeds: e-mail and IP addresses, card and phone numbers.
2. The one and two words before a seed are lexical patterns. Those seen before
   enough different values go on through a bit filter, with the kind of most seeds.
3. A second reading counts what follows these patterns in all documents: words that
   look like identifiers, by value, and ordinary words, which speak against them.
   After patterns of cards and phones an identifier runs over following words of
   digits and the kind's marks, up to the kind's most digits.
4. Spark scores the graph of patterns and values in rounds. A pattern is worth the
   share of its occurrences that precede personal data, each counted with the worth
   of its value; seeds are worth 1, any other value the chance that at least one of
   its patterns is right.
5. A third reading meets the patterns of high worth; identifiers after them become
   spans of the pattern's kind.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import filters, spans
from millrace.llm import textops as tx
from millrace.session import stage_table

KINDS = ("email", "ip", "card", "phone")
ROUNDS = 3
SUPPORT = 3  # different seed values before which a pattern must be seen
HELD = 1_000_000  # counts a task gathers before it sends them
WORTH = 0.8  # of a pattern whose finds are believed
U64 = np.uint64

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_WORD = re.compile(r"[^\x20\x09-\x0D]+")
_SPACE = frozenset(" \t\n\x0b\x0c\r")
_TRIM = b"\"'`()[]{}<>,;:.!?*#"
# How identifiers of each kind go on after their first word: not at all, or (marks, most digits).
RUNS = (None, (b"-", 19), (b"().-", 15))
RUN_OF = np.array([0, 0, 1, 2])  # of each kind
WHOLE = 8  # digits of the shortest whole phone number
_NEXT = re.compile(rb" +([^\x20\x09-\x0D]+)")
_DIGITS = b"0123456789"
_LEAD = re.compile(rb".*[:=]", re.S)


def _emails(text: str) -> list[tuple[int, int]]:
    """From each @: the run of local characters before it and the domain after it."""
    out, last, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > last and text[start - 1] in _LOCAL:
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            out.append((start, domain.end()))
            last = domain.end()
        at = text.find("@", max(at + 1, last))
    return out


def luhn(digits: str) -> bool:
    total = sum(map(int, digits[-1::-2])) + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return total % 10 == 0


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) of the base patterns, by kind and start, in code points."""
    out = [(0, a, b) for a, b in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
            out.append((1, m.start(), m.end()))
    for m in _CARD.finditer(text):
        digits = m[0].replace(" ", "").replace("-", "")
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append((2, m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum("0" <= c <= "9" for c in m[0]) <= 15:
                out.append((3, m.start(), m.end()))
    return out


def _n_digits(word: bytes) -> int:
    return len(word) - len(word.translate(None, _DIGITS))


def _looks(word: bytes) -> bool:
    """Does a value look like an identifier: an at sign, or four digits or more?"""
    return b"@" in word or _n_digits(word) >= 4


def _pure(word: bytes, marks: bytes) -> bool:
    return not word.translate(None, _DIGITS + marks)


def _run_end(raw: bytes, start: int, end: int, stop: int, run: tuple[bytes, int] | None) -> int:
    """Where an identifier ends whose first word is given, at most at ``stop`` (all in bytes).

    It goes on over blanks while words hold only digits and the kind's marks and its
    digits stay within the kind's most. A word with other trailing marks is the last,
    and so is one that closes a bracket from before the identifier.
    """
    if run is None:
        return end
    marks, most = run
    word = raw[start:end]
    head = _LEAD.sub(b"", word.rstrip(_TRIM)).lstrip(_TRIM + b"+")
    bracket = word[: len(word) - len(word.lstrip(_TRIM))].endswith(b"(") or word in (b"(", b"+(")
    if not _pure(head, marks) or not (head or word in (b"(", b"+", b"+(")):
        return end
    digits, depth, last = _n_digits(word), int(bracket), end
    depth += head.count(b"(") - word.count(b")")
    at, tail = end, word[len(word.rstrip(_TRIM)) :] if head else b""
    while not tail.strip(b")") and depth >= 0 and not (bracket and depth == 0 and digits >= WHOLE):
        m = _NEXT.match(raw, at, stop)
        if not m:
            break
        word = m[1]
        core = word.rstrip(_TRIM)
        tail = word[len(core) :]
        if word == b"(":
            core, tail = word, b""
        n = _n_digits(core)
        if not _pure(core, marks) or digits + n > most or not (core or b"(" in marks and not tail.strip(b")")):
            break
        digits += n
        depth += core.count(b"(") - word.count(b")")
        at = m.end()
        # An open bracket may hold words that are no part of it.
        if n and (depth <= 0 or bracket and depth == 1 and b"(" not in raw[end:at]):
            last = at
    return last


def _trimmed(raw: bytes, start: int, end: int) -> tuple[int, int]:
    """Without marks around the value, except a bracket whose other half is inside."""
    text = raw[start:end]
    a, b = start + len(text) - len(text.lstrip(_TRIM)), start + len(text.rstrip(_TRIM))
    if a >= b:
        return start, start
    value = raw[a:b]
    inside = value.count(b"(") - value.count(b")")
    if inside < 0 and a > start and raw[a - 1 : a] == b"(":
        a -= 1
    elif inside > 0 and b < end and raw[b : b + 1] == b")":
        b += 1
    return a, b


def _before(text: str, start: int) -> list[str] | None:
    """The one or two words before a place where a word starts, however long they are."""
    if start == 0 or text[start - 1] not in _SPACE:
        return None
    back = 400  # looked back over; more until two whole words are seen
    while True:
        begin = max(0, start - back)
        found = [m for m in _WORD.finditer(text, begin, start)]
        if found and begin and found[0].start() == begin:
            del found[0]
        if len(found) >= 2 or not begin:
            return [m[0] for m in found[-2:]]
        back *= 4


def _pattern_hashes(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word as a pattern, and of each pair of words (by the second)."""
    one = tx.mix(h ^ U64(0x1D8E4E27C47D124F))
    two = tx.mix(np.append(U64(0), h[:-1]) * U64(0x9E3779B97F4A7C15) + h) if len(h) else one
    return one, two


def _value_hash(values: list[str]) -> np.ndarray:
    """Hash of the letters and digits of each value, without case."""
    plain = ["".join(c for c in v.lower() if c.isalnum() or c == "@") for v in values]
    raw, offsets = tx.buffer_of(pa.array(plain, pa.large_string()))
    return tx.span_hashes(raw, offsets[:-1], offsets[1:])


def _seeds(source: DataFrame) -> DataFrame:
    """doc_id, tag, base spans as a binary of (kind, start, end), and what precedes them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.slices(batches, "text"):
            found, words, values, where = [], [], [], []
            for i, text in enumerate(batch.column("text").to_pylist()):
                own = base_spans(text) if text else []
                found.append(np.array(own, np.int32).tobytes() if own else None)
                for kind, a, b in own:
                    context = _before(text, a)
                    if context:
                        words.append(" ".join(context))
                        values.append(text[a:b])
                        where.append((i, kind, len(context)))
            patterns: list[list[dict]] = [[] for _ in found]
            if where:
                w = tx.words_of(pa.array(words, pa.large_string()), lower=True)
                one, two = _pattern_hashes(w.hash)
                ends = w.first[1:] - 1
                for j, ((i, kind, n), v) in enumerate(zip(where, _value_hash(values).view(np.int64).tolist(), strict=True)):
                    for h in (one, two)[:n]:
                        patterns[i].append({"pattern": int(h[ends[j]].view(np.int64)), "value": v, "kind": kind})
            kind = pa.list_(pa.struct([("pattern", pa.int64()), ("value", pa.int64()), ("kind", pa.int32())]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("tag"), pa.array(found, pa.binary()), pa.array(patterns, kind)], ["doc_id", "tag", "base", "seeds"])

    schema = "doc_id long, tag long, base binary, seeds array<struct<pattern: long, value: long, kind: int>>"
    return stage_table(source.mapInArrow(run, schema), "personal")


def _keyed(pattern: np.ndarray, run: int) -> np.ndarray:
    """Hash of a pattern together with how its identifiers go on."""
    return tx.mix(pattern + U64((run + 1) * 0xD1B54A32D192ED03 % 2**64))


def _filter(patterns: DataFrame, n: int) -> filters.BitFilter:
    """Of patterns, alone and with how their identifiers go on."""

    def hashes(batch: pa.RecordBatch) -> np.ndarray:
        p, run = batch.column("pattern").to_numpy().view(U64), batch.column("run").to_numpy()
        return np.concatenate([p, *(_keyed(p[run == r], r) for r in range(len(RUNS)))])

    return filters.build(patterns.select("pattern", "run"), hashes, 2.0 * n, keep="once")


def _followed(w: tx.Words, wanted: Callable[[np.ndarray], np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, pattern before it, how its identifiers go on) wherever a wanted pattern stands before a word."""
    one, two = _pattern_hashes(w.hash)
    place = np.arange(len(w.hash)) - w.first[w.doc]  # word number in its document
    words, patterns = [], []
    for least, h in ((1, one), (2, two)):
        at = np.flatnonzero(place >= least)
        at = at[wanted(h[at - 1])]
        words.append(at)
        patterns.append(h[at - 1])
    word, pattern = np.concatenate(words), np.concatenate(patterns)
    hits = [np.flatnonzero(wanted(_keyed(pattern, r))) for r in range(len(RUNS))]
    at = np.concatenate(hits)
    return word[at], pattern[at], np.repeat(np.arange(len(RUNS)), [len(x) for x in hits])


def _met(batch: pa.RecordBatch, wanted: Callable[[np.ndarray], np.ndarray]) -> tuple[list[tuple[np.ndarray, int, np.ndarray]], pa.RecordBatch | None]:
    """Ordinary words after the patterns as (patterns, how they go on, counts), and the identifiers that no base span covers."""
    w = tx.words_of(batch.column("text"), lower=True)
    word, pattern, run = _followed(w, wanted)
    digits = np.append(0, np.cumsum((w.raw >= 0x30) & (w.raw <= 0x39)))
    signs = np.append(0, np.cumsum(w.raw == 0x40))
    a, b = w.start[word], w.end[word]
    # Only these words can be or begin an identifier or a base span.
    look = (digits[b] > digits[a]) | (signs[b] > signs[a])
    if len(word):
        look |= (run == 2) & (b - a <= 2) & ((w.raw[a] == 0x28) | (w.raw[a] == 0x2B))
    ordinary = ~look
    found = _identifiers(batch, w, word, pattern, run, np.flatnonzero(look), ordinary)
    counts = []
    for r in range(len(RUNS)):
        h, n = np.unique(pattern[ordinary & (run == r)], return_counts=True)
        if len(h):
            counts.append((h.view(np.int64), r, n))
    return counts, found


def _identifiers(
    batch: pa.RecordBatch, w: tx.Words, word: np.ndarray, pattern: np.ndarray, run: np.ndarray, look: np.ndarray, ordinary: np.ndarray
) -> pa.RecordBatch | None:
    """Identifiers among the words looked at; those that are none are marked as ordinary, unless a base span covers them."""
    if not len(look):
        return None
    ids, tags = (batch.column(c).to_pylist() for c in ("doc_id", "tag"))
    doc = w.doc[word[look]]
    raw = w.raw.tobytes()
    points = np.append(0, np.cumsum((w.raw & 0xC0) != 0x80))  # code points before each byte
    base: dict[int, list[tuple[int, int]]] = {}
    seen: dict[tuple[int, int], tuple[int, int] | None] = {}  # what begins at a word: nothing, a base span (-1), an identifier
    rows, values = [], []
    for j, d, i, r in zip(look.tolist(), doc.tolist(), word[look].tolist(), run[look].tolist(), strict=True):
        if (i, r) not in seen:
            start, end, first, stop = int(w.start[i]), int(w.end[i]), int(w.offsets[d]), int(w.offsets[d + 1])
            if d not in base:
                own = base_spans(raw[first:stop].decode())
                base[d] = []
                if own:
                    to_byte = first + np.flatnonzero((w.raw[first:stop] & 0xC0) != 0x80)
                    to_byte = np.append(to_byte, stop)
                    base[d] = sorted((int(to_byte[x]), int(to_byte[y])) for _, x, y in own)
            stop = min([stop, *(x for x, _ in base[d] if x >= end)])
            a, b = _trimmed(raw, start, end)
            if any(x < b and a < y for x, y in base[d]):
                seen[i, r] = (-1, -1)
            else:
                a, b = _trimmed(raw, start, _run_end(raw, start, end, stop, RUNS[r]))
                seen[i, r] = (a, b) if _looks(raw[a:b]) else None
        place = seen[i, r]
        if place is None:
            ordinary[j] = True
        elif place[0] >= 0:
            a, b = place
            values.append(raw[a:b].decode())
            begin = int(points[int(w.offsets[d])])
            rows.append((int(pattern[j].view(np.int64)), r, ids[d], tags[d], int(points[a]) - begin, int(points[b]) - begin))
    if not rows:
        return None
    p, r, i, t, a, b = (pa.array(x, pa.int64()) for x in zip(*rows, strict=True))
    names = ["pattern", "run", "value", "doc_id", "tag", "start", "end"]
    return pa.RecordBatch.from_arrays([p, r, pa.array(_value_hash(values).view(np.int64)), i, t, a, b], names)


def _summed(held: list[tuple[np.ndarray, ...]]) -> tuple[np.ndarray, ...]:
    """Rows of keys and a count at the end, with one row for each different key."""
    *keys, n = (np.concatenate(x) for x in zip(*held, strict=True))
    order = np.lexsort(keys)
    keys = [k[order] for k in keys]
    at = spans.heads(*keys)
    return *(k[at] for k in keys), np.add.reduceat(n[order], at) if len(at) else n


def _by_task(slices: Iterator[list[tuple[np.ndarray, ...]]], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Counts of slices summed over the task; keys are ``names`` without value and n, is there a value, and the value."""
    held: list[tuple[np.ndarray, ...]] = []
    size = 0
    for rows in slices:
        held += rows
        size += sum(len(x[0]) for x in rows)
        if size > HELD:
            held = [_summed(held)]
            size = len(held[0][0])
            if size > HELD // 2:
                yield _count_rows(held.pop(), names)
                size = 0
    if held:
        yield _count_rows(_summed(held), names)


def _count_rows(rows: tuple[np.ndarray, ...], names: list[str]) -> pa.RecordBatch:
    *keys, known, value, n = rows
    return pa.RecordBatch.from_arrays([*(pa.array(k) for k in keys), pa.array(value, mask=~known), pa.array(n)], names)


def _counts(source: DataFrame, wanted: filters.BitFilter) -> DataFrame:
    """pattern, run, value and n: identifiers after the patterns, and ordinary words under a null value."""
    shared = filters.share(source.sparkSession, wanted)
    names = ["pattern", "run", "value", "n"]

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple[np.ndarray, ...]]]:
        for batch in tx.slices(batches, "text"):
            counts, found = _met(batch, shared.value.has)
            rows = [(h, np.full(len(h), r), np.zeros(len(h), bool), np.zeros(len(h), np.int64), n) for h, r, n in counts]
            if found:
                p, r, v = (found.column(c).to_numpy() for c in names[:3])
                rows.append((p, r, np.ones(len(p), bool), v, np.ones(len(p), np.int64)))
            yield rows

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from _by_task(counted(batches), names)

    return source.mapInArrow(run, "pattern long, run long, value long, n long").groupBy("pattern", "run", "value").agg(F.sum("n").alias("n"))


def _places(source: DataFrame, wanted: filters.BitFilter) -> DataFrame:
    """Where identifiers after the patterns are that no base span covers."""
    shared = filters.share(source.sparkSession, wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.slices(batches, "text"):
            _, found = _met(batch, shared.value.has)
            if found:
                yield found

    return source.mapInArrow(run, "pattern long, run long, value long, doc_id long, tag long, start long, end long")


def _score(seeds: DataFrame, met: DataFrame, rounds: int) -> DataFrame:
    """(pattern, worth) after scoring the graph of patterns and values."""
    counts = seeds.groupBy("pattern", "value").agg(F.count(F.lit(1)).alias("n"))
    found = met.filter("value IS NOT NULL").select("pattern", "value", "n")
    known = seeds.select("value").distinct().withColumn("seed", F.lit(True))
    edges = counts.unionByName(found).groupBy("pattern", "value").agg(F.sum("n").alias("n"))
    edges = stage_table(edges.join(known, "value", "left").withColumn("seed", F.coalesce("seed", F.lit(False))), "graph")
    against = met.filter("value IS NULL").select("pattern", F.col("n").alias("against"))
    worth = edges.withColumn("of_value", F.col("seed").cast("double"))
    for _ in range(rounds):
        pattern = worth.groupBy("pattern").agg(F.sum(F.col("n") * F.col("of_value")).alias("good"), F.sum("n").alias("all")).join(against, "pattern", "left")
        pattern = pattern.select("pattern", (F.col("good") / (F.col("all") + F.coalesce("against", F.lit(0)) + 1)).alias("worth"))
        value = edges.join(pattern, "pattern").groupBy("value").agg((1 - F.exp(F.sum(F.log(1 - F.least("worth", F.lit(0.999)))))).alias("chance"))
        worth = stage_table(edges.join(value, "value").withColumn("of_value", F.when(F.col("seed"), 1.0).otherwise(F.col("chance"))).drop("chance"), "graph")
    return pattern


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", support: int = SUPPORT, worth: float = WORTH, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, tag, base and added: spans as binaries of int32 (kind, start, end) in code points.

    A null or empty text has no spans. Rows that repeat id and text get the same
    spans, but count as evidence each; a pattern's support counts different values,
    so copies do not add to it. Rows without an id are searched like all others.
    Other columns are ignored. Words, patterns and values are compared by 64-bit
    hashes.
    """
    source = spans.tagged(docs, doc_id, text)
    base = _seeds(source)
    seeds = base.select(F.explode("seeds").alias("s")).select("s.*")
    evidence = seeds.groupBy("pattern").agg(F.count_distinct("value").alias("values")).filter(F.col("values") >= support)
    # A pattern's kind is that of most of its seeds.
    kinds = seeds.groupBy("pattern", "kind").agg(F.count(F.lit(1)).alias("n")).groupBy("pattern").agg(F.min_by("kind", F.struct(-F.col("n"), "kind")).alias("kind"))
    run = F.element_at(F.array(*(F.lit(int(r)).cast("long") for r in RUN_OF)), F.col("kind") + 1)
    chosen = stage_table(evidence.join(kinds, "pattern").select("pattern", "kind", run.alias("run")), "patterns")
    n = chosen.count()
    out = base.select("doc_id", "tag", "base")
    if not n:
        return out.withColumn("added", F.lit(None).cast("binary"))
    met = _counts(source, _filter(chosen, n)).join(chosen, ["pattern", "run"], "left_semi")  # drops the filter's false hits
    scored = _score(seeds.join(chosen, "pattern", "left_semi"), stage_table(met, "contexts"), rounds)
    believed = stage_table(scored.filter(F.col("worth") >= worth).join(chosen, "pattern"), "patterns")
    n = believed.count()
    if not n:
        return out.withColumn("added", F.lit(None).cast("binary"))
    places = _places(source, _filter(believed, n)).join(believed, ["pattern", "run"])
    # A place found by several patterns takes the kind of the best.
    places = places.groupBy("doc_id", "tag", "start", "end").agg(F.max_by("kind", F.struct("worth", -F.col("kind"))).alias("kind"))
    added = places.groupBy("doc_id", "tag").agg(F.array_sort(F.collect_list(F.struct("kind", "start", "end"))).alias("list"))
    return out.join(added, out["doc_id"].eqNullSafe(added["doc_id"]) & (out["tag"] == added["tag"]), "left").select(
        out["doc_id"], out["tag"], "base", "list"
    ).mapInArrow(_pack_added, "doc_id long, tag long, base binary, added binary")


def _pack_added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        added = [np.array([(x["kind"], x["start"], x["end"]) for x in row], np.int32).tobytes() if row else None for row in batch.column("list").to_pylist()]
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("doc_id", "tag", "base")), pa.array(added, pa.binary())], ["doc_id", "tag", "base", "added"])


def _triples(raw: bytes | None) -> list[tuple[int, int, int]]:
    return [tuple(x) for x in np.frombuffer(raw, np.int32).reshape(-1, 3).tolist()] if raw else []


def _written(found: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in sorted(found))


def digest(docs: DataFrame) -> DataFrame:
    """Per document: base counts, a hash of the base spans, and all spans as text."""
    names = ["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"]
    schema = "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, sha, written = [], [], []
            for base, added in zip(batch.column("base").to_pylist(), batch.column("added").to_pylist(), strict=True):
                own = _triples(base)
                counts.append([sum(k == i for k, _, _ in own) for i in range(len(KINDS))])
                sha.append(hashlib.sha256(_written(own).encode()).hexdigest())
                written.append(_written(own + _triples(added)))
            columns = [pa.array(x, pa.int64()) for x in zip(*counts, strict=True)] or [pa.array([], pa.int64())] * len(KINDS)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, pa.array(sha, pa.string()), pa.array(written, pa.string())], names)

    return find(docs).select("doc_id", "base", "added").mapInArrow(run, schema)


def masked(text: str, found: list[tuple[int, int, int]]) -> str:
    """The text with each span replaced by its kind; overlapping spans count as one of the first's kind."""
    out, at = [], 0
    for kind, a, b in sorted(found, key=lambda x: (x[1], -x[2], x[0])):
        if a >= at:
            out += [text[at:a], f"<{KINDS[kind].upper()}>"]
        at = max(at, b)
    return "".join(out) + text[at:]


def mask(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """All rows and columns, with personal data in ``text`` replaced by its kind; null texts stay null."""
    found = find(docs, doc_id, text).filter("base IS NOT NULL OR added IS NOT NULL")
    # Repeated rows have equal spans.
    found = found.groupBy(F.col("doc_id").alias("_id"), F.col("tag").alias("_tag")).agg(F.first("base").alias("base"), F.first("added").alias("added"))
    rows = spans.boxed(docs, doc_id, text)
    schema = rows.select("row", "text").schema
    both = rows.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("tag") == F.col("_tag")), "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in tx.slices(batches, "text"):
            new = []
            for value, base, added in zip(*(batch.column(c).to_pylist() for c in ("text", "base", "added")), strict=True):
                own = _triples(base) + _triples(added)
                new.append(masked(value, own) if value is not None and own else value)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(new, pa.string())], ["row", "text"])

    return spans.unboxed(both.select("row", "text", "base", "added").mapInArrow(run, schema), docs.columns, text)
