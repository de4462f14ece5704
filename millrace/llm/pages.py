"""Main text of web pages by differencing against the pages of the nearest URLs.

A page becomes lines, one for each block of text, in page order. Pages of one host
are sorted by URL path; copies, which have the same lines, stand there once. Each is
aligned with the NEAREST pages before and after it by a longest common subsequence of
line hashes. A line that most of these neighbours share is deleted: template lines
are shared by all, a passage that two articles quote by few. A neighbour that shares
four fifths of the characters is a near copy and has no vote.

Every page is aligned, and markup then checks what was found: parts named as menus,
footers, sidebars, notices, adverts, forms or comments are never text, even if they
differ from page to page; lines of an article element always are. A page with an
article element has no other text. Where the only article stands inside a part named
by its class or id, or inside a form, that part is a wrapper and the article is the
text.

Pages are read once. Only line hashes are sorted and compared, in blocks of places
that lie side by side; lines that may be text are stored, and meet the decisions on
their page where one of them goes.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Callable, Iterator
from html import unescape

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import textops as tx
from millrace.operators.ordinal import with_ordinal
from millrace.session import stage_table

NEAREST = 3  # pages on each side
BLOCK = 64  # pages that a task aligns together
OFTEN = 64  # places from which the bits of a line are remembered
TABLE = 1 << 28  # bits of the largest table
PLAIN, ARTICLE, AROUND, INSIDE = 0, 1, 2, 3  # INSIDE: an article inside a part that may be a wrapper

# Parts of markup that are never text, or never the article. Fixed values.
SILENT = "script|style|noscript|template|textarea|title|iframe"
ASIDE = frozenset("nav header footer aside form dialog menu fieldset select button object svg canvas math".split())
MAIN = frozenset("article main".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset(
    "a abbr acronym b bdi bdo big br cite code data dfn em font i img ins del kbd label mark q s samp small span strike strong sub sup time tt u var wbr".split()
)
ROLES = frozenset("navigation banner contentinfo complementary search alert dialog menu".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner sponsor sponsored promo promotion sidebar menu nav navbar navigation "
    "breadcrumb breadcrumbs masthead footer cookie cookies consent gdpr notice alert popup modal overlay newsletter subscribe "
    "signup login share sharing social related recommended comments comment discussion replies respond widget toolbar pagination "
    "pager search skip copyright".split()
)
WRAPPERS = frozenset("form fieldset".split())  # of ASIDE: may hold the whole page
OTHERS = frozenset("related recommended comments comment replies respond".split())  # hold articles of others
# Inside an article these are parts of it: sections, boxes, quoted notices.
OF_ARTICLE = frozenset("discussion alert notice search skip copyright".split())
# Words beside the names of a part, as in "site-footer"; with any other word a name says something else ("no-sidebar").
BESIDE = frozenset(
    "site page main global primary secondary top bottom left right inner outer sub container wrapper wrap box bar block section "
    "list item items link links area panel region form button buttons icon icons text title heading header body head".split()
)

# Possessive throughout, and no tag holds "<" outside quotes: broken markup costs no second look.
_TOKEN = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({SILENT})\b[^<>]*+>.*?(?:</\1\s*+>|\Z)"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^<>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>|<[!?/][^<>]*+>",
    re.S | re.I,
)
_NAMED = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\b(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


def _names(value: str) -> set[str]:
    """Names of parts in a class or id: whole names, alone or beside words that only say which or where."""
    out: set[str] = set()
    for name in value.split():
        parts = [p.lower() for p in _PARTS.findall(name)]
        if all(p in NAMES or p in BESIDE for p in parts):
            out.update(p for p in parts if p in NAMES)
    return out


def _named_aside(attributes: str, article: bool) -> tuple[bool, bool]:
    """(do class, id or role name a part around the text, or is it hidden; may that part be a wrapper of the article)"""
    aside, wrapper = False, True
    for m in _NAMED.finditer(attributes):
        key, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if key == "hidden" or key == "aria-hidden" and value == "true" or key == "style" and "display:none" in value.replace(" ", ""):
            return True, False
        if key == "role":
            aside = aside or value.lower() in ROLES and not (article and value.lower() in OF_ARTICLE)
        elif key in ("class", "id"):
            names = _names(value) - (OF_ARTICLE if article else frozenset())
            aside = aside or bool(names)
            wrapper = wrapper and not names & OTHERS
    return aside, wrapper


def page_lines(html: str) -> tuple[list[str], list[int]]:
    """(lines, kind of each) of a page; character references decoded, white space as one space."""
    lines: list[str] = []
    kinds: list[int] = []
    parts: list[str] = []
    open_: list[tuple[str, int, bool]] = []
    kind, wrapped = PLAIN, True  # wrapped: all parts around the text that are open may be wrappers

    def flush() -> None:
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                lines.append(text)
                kinds.append(kind)
            parts.clear()

    def close(name: str) -> None:
        nonlocal kind, wrapped
        for i in range(len(open_) - 1, -1, -1):
            if open_[i][0] == name:
                _, kind, wrapped = open_[i]
                del open_[i:]
                return

    at = 0
    for m in _TOKEN.finditer(html):
        if m.start() > at:
            parts.append(html[at : m.start()])
        at = m.end()
        name = m[3]
        if name is None:
            if m[1]:
                flush()
            continue
        name = name.lower()
        if name in INLINE:
            if name == "br":
                parts.append(" ")
            continue
        flush()
        if m[2]:
            close(name)
        elif name not in VOID:
            if name in ("p", "li"):  # a new one ends the one before
                for i in range(len(open_) - 1, -1, -1):
                    if open_[i][0] == name:
                        close(name)
                        break
                    if open_[i][0] not in ("p", "h1", "h2", "h3", "h4", "h5", "h6"):
                        break
            if m[4].endswith("/"):
                continue
            open_.append((name, kind, wrapped))
            if name in ("html", "body"):  # hold every page: their classes tell of the layout
                continue
            inside = kind in (ARTICLE, INSIDE)
            aside, wrapper = _named_aside(m[4], inside) if m[4] else (False, True)
            if name in ASIDE and not (name == "header" and inside):
                aside, wrapper = True, wrapper and name in WRAPPERS
            if kind == AROUND:
                wrapped = wrapped and (wrapper or not aside)
                if name in MAIN and wrapped and not aside:
                    kind = INSIDE
            elif aside:
                wrapped = wrapped and wrapper and not inside
                kind = AROUND
            elif name in MAIN and kind == PLAIN:
                kind = ARTICLE
    if at < len(html):
        parts.append(html[at:])
    flush()
    if INSIDE in kinds:
        only = AROUND if ARTICLE in kinds else ARTICLE
        kinds = [only if k == INSIDE else k for k in kinds]
    return lines, kinds


def place_of(url: str | None) -> tuple[str, str]:
    """(host, path) of a URL, without scheme, query and fragment; digits are padded so that numbers sort by size."""
    rest = re.split(r"[?#]", re.sub(r"^[a-zA-Z][a-zA-Z0-9+.-]*://", "", url or ""), maxsplit=1)[0]
    host, _, path = rest.partition("/")
    return host.lower(), re.sub(r"\d+", lambda m: m[0].zfill(12), path)


def _masks(b: list[int], wanted: set[int]) -> Callable[[int], int]:
    """For a line: the bits of the places where ``b`` holds it."""
    where: dict[int, list[int]] = defaultdict(list)
    for j, x in enumerate(b):
        if x in wanted:
            where[x].append(j)
    often: dict[int, int] = {}  # few lines repeat much, so what is remembered stays small

    def mask(x: int) -> int:
        if x in often:
            return often[x]
        places = where.get(x)
        if not places:
            return 0
        bits = bytearray(len(b) // 8 + 1)
        for j in places:
            bits[j >> 3] |= 1 << (j & 7)
        out = int.from_bytes(bits, "little")
        if len(places) > OFTEN:
            often[x] = out
        return out

    return mask


def _rows(a: list[int], b: list[int]) -> Iterator[int]:
    """After each line of ``a``: bit j is 0 where line j of ``b`` makes the longest common subsequence longer."""
    mask, full = _masks(b, set(a)), (1 << len(b)) - 1
    row = full
    for x in a:
        hit = row & mask(x)
        if hit:
            row = ((row + hit) | (row - hit)) & full
        yield row


def _lengths(a: list[int], b: list[int]) -> np.ndarray:
    """Length of the longest common subsequence of ``a`` with each beginning of ``b``."""
    row = (1 << len(b)) - 1
    for row in _rows(a, b):
        pass
    bits = np.unpackbits(np.frombuffer(row.to_bytes(len(b) // 8 + 1, "little"), np.uint8), bitorder="little")[: len(b)]
    return np.append(0, np.cumsum(bits == 0))


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Indices of ``a`` in one longest common subsequence with ``b``.

    Rows of the table are bits of one integer; a table of more than TABLE bits is
    halved first (Hirschberg), so memory follows the number of lines.
    """
    out: list[int] = []
    open_ = [(0, len(a), 0, len(b))]
    while open_:
        low, high, left, right = open_.pop()
        while low < high and left < right and a[low] == b[left]:
            out.append(low)
            low, left = low + 1, left + 1
        while low < high and left < right and a[high - 1] == b[right - 1]:
            high, right = high - 1, right - 1
            out.append(high)
        if low == high or left == right:
            continue
        if high - low > 1 and (high - low) * (right - left) > TABLE:
            middle = (low + high) // 2
            first = _lengths(a[low:middle], b[left:right])
            second = _lengths(a[middle:high][::-1], b[left:right][::-1])[::-1]
            cut = left + int((first + second).argmax())
            open_ += [(low, middle, left, cut), (middle, high, cut, right)]
            continue
        rows = [(1 << (right - left)) - 1, *_rows(a[low:high], b[left:right])]
        i, j = high - low, right - left
        while i and j:
            if rows[i] >> (j - 1) & 1:
                j -= 1
            elif rows[i - 1] >> (j - 1) & 1:
                i, j = i - 1, j - 1
                out.append(low + i)
            else:
                i -= 1
    return sorted(out)


def may_be_text(kinds: list[int]) -> list[bool]:
    """Which lines markup leaves: those of the article, or of a page without one all that are in no named part."""
    wanted = ARTICLE if ARTICLE in kinds else PLAIN
    return [k == wanted for k in kinds]


def differing(own: list[int], neighbours: list[list[int]], sizes: list[int]) -> list[bool]:
    """Which lines most neighbours do not share at an aligned place."""
    votes, voters = [0] * len(own), 0
    for other in neighbours:
        common = common_lines(own, other)
        if 5 * sum(sizes[i] for i in common) >= 4 * sum(sizes):  # a near copy, or nothing to tell apart
            continue
        voters += 1
        for i in common:
            votes[i] += 1
    return [2 * v <= voters for v in votes]


def lines_to_keep(own: list[int], kinds: list[int], neighbours: list[list[int]], sizes: list[int] | None = None) -> list[bool]:
    """Which lines are the text; lines are hashes, neighbours the lines of pages near by, sizes the characters of each line."""
    aligned = [i for i, k in enumerate(kinds) if k in (PLAIN, ARTICLE)]  # the others are no text wherever they stand
    size = sizes or [1] * len(own)
    found = {i for i, d in zip(aligned, differing([own[i] for i in aligned], neighbours, [size[i] for i in aligned]), strict=True) if d}
    # The check: an article holds all of the text, its shared lines included.
    return [m and (k == ARTICLE or i in found) for i, (m, k) in enumerate(zip(may_be_text(kinds), kinds, strict=True))]


def _hashes(lines: list[str]) -> np.ndarray:
    raw = pa.array(lines, pa.large_string())
    data, offsets = tx.buffer_of(raw)
    return tx.span_hashes(data, offsets[:-1], offsets[1:])


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of each page as hashes, kinds and sizes, and those that may be its text as they are."""
    for batch in tx.slices(batches, "html"):
        rows: list[tuple[str, str, bytes, bytes, bytes, str]] = []
        for url, html in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist(), strict=True):
            lines, kinds = page_lines(html or "")
            sizes = np.fromiter(map(len, lines), np.int32, len(lines))
            text = "\n".join(line for line, m in zip(lines, may_be_text(kinds), strict=True) if m)
            rows.append((*place_of(url), _hashes(lines).tobytes(), bytes(kinds), sizes.tobytes(), text))
        columns = [pa.array(x, t) for x, t in zip(zip(*rows, strict=True), (pa.string(),) * 2 + (pa.binary(),) * 3 + (pa.string(),), strict=True)]
        names = ["host", "path", "hashes", "kinds", "sizes", "text"]
        yield pa.RecordBatch.from_arrays([batch.column("page_id"), batch.column("url"), *columns], ["page_id", "url", *names])


def _decide(group: pa.Table) -> pa.Table:
    """Of each page of a block, which of the lines that may be text are it. Pages beside the block stand in it as neighbours."""
    pages = sorted(group.to_pylist(), key=lambda x: x["place"])
    lines = [np.frombuffer(x["hashes"], np.int64).tolist() for x in pages]
    classes, out = [], []
    for i, page in enumerate(pages):
        if (page["place"] - 1) // BLOCK != page["block"]:
            continue
        beside = range(max(0, i - NEAREST), min(len(pages), i + NEAREST + 1))  # places have no gaps
        others = [lines[j] for j in beside if pages[j]["host"] == page["host"] and pages[j]["hashes"] != page["hashes"]]
        kinds = list(page["kinds"])
        keep = lines_to_keep(lines[i], kinds, others, np.frombuffer(page["sizes"], np.int32).tolist())
        classes.append(page["class"])
        out.append([k for k, m in zip(keep, may_be_text(kinds), strict=True) if m])
    return pa.table([pa.array(classes, pa.int64()), pa.array(out, pa.list_(pa.bool_()))], ["class", "keep"])


def main_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """page_id, url, text and n_chars of every page.

    A null or empty page has an empty text. A null URL counts as an empty one, and
    such pages are neighbours of each other. Rows that repeat id, URL and page get the
    same text each. Other columns are ignored; an empty table gives an empty result.
    """
    source = tx.small_batches(pages).select(F.col(page_id).alias("page_id"), F.col(url).alias("url"), F.col(html).alias("html"))
    kind = source.schema["page_id"].dataType.simpleString()
    sketch = source.mapInArrow(_sketch, f"page_id {kind}, url string, host string, path string, hashes binary, kinds binary, sizes binary, text string")
    read = stage_table(sketch.withColumn("class", F.xxhash64("host", "hashes", "kinds")), "pages")
    # Pages of one host with the same lines are one page here, at the first of their paths.
    same = [F.first(c).alias(c) for c in ("hashes", "kinds", "sizes")]
    lists = read.groupBy("class").agg(F.min("host").alias("host"), F.min("path").alias("path"), *same)
    placed = with_ordinal(lists, ["host", "path", "class"], "place")
    # A page stands in its own block, and within NEAREST of a border in the next one as well.
    blocks = F.array_distinct(F.array(*[F.floor((F.col("place") - 1 + d) / BLOCK) for d in (-NEAREST, 0, NEAREST)]))
    beside = placed.select("place", "host", "class", "hashes", "kinds", "sizes", F.explode(blocks).alias("block"))
    decided = beside.groupBy("block").applyInArrow(_decide, "class long, keep array<boolean>")
    # Copies share a decision. Texts stay where they are unless many lists lose lines: only those decisions are stored and meet them.
    less = stage_table(decided.filter(F.exists("keep", lambda k: ~k)), "page-cuts")
    cut = F.array_join(F.filter(F.split("text", "\n"), lambda _, i: F.get("keep", i)), "\n")
    text = F.when(F.col("keep").isNull(), F.col("text")).otherwise(cut).alias("text")
    return read.join(less, "class", "left").select("page_id", "url", text).withColumn("n_chars", F.length("text").cast("long"))
