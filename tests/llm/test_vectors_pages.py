"""Neighbours against brute force; main text against the article and against planted boilerplate."""

import html
import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import neighbours, pages
from millrace.llm.catalog import RELAX
from tests.conftest import rows


def brute_nearest(table, queries, k=5):
    out = {}
    for q, v in queries.items():
        near = []
        for i, x in table.items():
            if i != q and len(x) == len(v):
                near.append((-float((v * x).sum() / (np.sqrt((v * v).sum()) * np.sqrt((x * x).sum()))), i))
        out[q] = [(i, -s) for s, i in sorted(near)[:k]]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        assert r["rank"] == len(out.setdefault(r.query_id, [])) + 1
        out[r.query_id].append((r.vec_id, r.score))
    return out


@pytest.mark.parametrize("relax,recall", [(1.0, 1.0), (RELAX, 0.9)])
def test_recall_against_brute_force(spark, sf, relax, recall, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD", 150)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 4)
    vectors = spark.read.parquet(f"{sf}/embeddings.parquet")
    table = {r.vec_id: np.array(r.embedding, float) for r in vectors.collect()}
    got = found(neighbours.nearest_neighbours(vectors, vectors.filter("vec_id % 50 = 0"), relax=relax))
    want = brute_nearest(table, {i: v for i, v in table.items() if i % 50 == 0})
    assert got.keys() == want.keys()
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= recall * 5 * len(want)
    if relax == 1:
        assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}
    for q, x in got.items():
        v = table[q]
        assert np.allclose([s for _, s in x], [(v * table[i]).sum() / np.sqrt((v * v).sum() * (table[i] * table[i]).sum()) for i, _ in x], rtol=0, atol=1e-15)


def test_ties_copies_and_unusable_vectors(spark):
    rows_ = [(i, [1.0, 0.0, 0.0], "x") for i in range(40)]  # one common vector
    rows_ += [(50, [1.0, 1.0, 0.0], "x"), (50, [1.0, 1.0, 0.0], "x"), (51, [0.0, 0.0, 0.0], "x"), (52, None, "x"), (53, [1.0, float("nan"), 0.0], "x")]
    rows_ += [(54, [1.0, None, 0.0], "x"), (55, [float("inf"), 0.0, 0.0], "x"), (56, [], "x"), (57, [2.0, 1.0], "x"), (100, [0.5, 0.0, 0.0], "x"), (None, [1.0, 0.0, 0.0], "x")]
    df = spark.createDataFrame(rows_, "vec_id long, embedding array<double>, rank string")
    got = found(neighbours.nearest_neighbours(df, df.filter("vec_id % 50 = 0")))
    assert [i for i, _ in got[0]] == [1, 2, 3, 4, 5] and [i for i, _ in got[100]] == [0, 1, 2, 3, 4]
    assert [i for i, _ in got[50]] == [0, 1, 2, 3, 4] and all(abs(s - 0.5**0.5) < 1e-15 for _, s in got[50])
    alone = neighbours.nearest_neighbours(df, df.filter("vec_id = 57"))
    assert alone.count() == 0
    assert neighbours.nearest_neighbours(df.limit(0), df.limit(0)).count() == 0
    few = df.filter("vec_id < 3")
    assert {q: len(x) for q, x in found(neighbours.nearest_neighbours(few, few)).items()} == {0: 2, 1: 2, 2: 2}


@pytest.mark.parametrize("relax", [1.0, RELAX])
def test_ties_between_scaled_copies_go_to_the_smallest_ids(spark, relax):
    draw = np.random.default_rng(9)
    scaled = [(100 + i, [0.5 * 2.0 ** (i % 7), 0.25 * 2.0 ** (i % 7), 0.0]) for i in draw.permutation(60).tolist()]
    others = [(1000 + i, [float(c) for c in draw.normal(size=3)]) for i in range(200)]
    df = spark.createDataFrame(scaled + others, "vec_id long, embedding array<double>")
    got = found(neighbours.nearest_neighbours(df, df.filter("vec_id IN (100, 150)"), relax=relax))
    assert [i for i, _ in got[100]] == [101, 102, 103, 104, 105] and [i for i, _ in got[150]] == [100, 101, 102, 103, 104]
    assert all(s == got[100][0][1] for _, s in got[100])


def test_clustered_vectors_meet_few_shards(spark, monkeypatch):
    monkeypatch.setattr(neighbours, "SHARD", 100)
    draw = np.random.default_rng(3)
    centres = draw.normal(size=(20, 8))
    table = {i: centres[i % 20] + 0.05 * draw.normal(size=8) for i in range(2000)}
    df = spark.createDataFrame([(i, v.tolist()) for i, v in table.items()], "vec_id long, embedding array<double>")
    asked = df.filter("vec_id % 50 < 2")
    points, queries = (neighbours._clean(x, "vec_id", "embedding") for x in (df, asked))
    packs, _, index, shards = neighbours._two_passes(points, queries, 5, 1.0)
    assert shards == index.count() >= 20
    assert packs.agg(F.sum("n")).first()[0] < 0.3 * shards * asked.count()
    got = found(neighbours.nearest_neighbours(df, asked))
    want = brute_nearest(table, {i: v for i, v in table.items() if i % 50 < 2})
    loose = found(neighbours.nearest_neighbours(df, asked, relax=20.0))
    assert loose.keys() == want.keys() and all(len(x) == 5 for x in loose.values())
    assert {q: [i for i, _ in x] for q, x in got.items()} == {q: [i for i, _ in x] for q, x in want.items()}


@settings(max_examples=25, deadline=None)
@given(st.integers(0, 10**6), st.integers(2, 200), st.integers(1, 6))
def test_trees_are_exact_at_factor_one(seed, n, dim):
    draw = np.random.default_rng(seed)
    vectors = draw.integers(-3, 4, (n, dim)).astype(float)
    vectors = vectors[(vectors != 0).any(1)]
    ids = draw.permutation(len(vectors) * 3)[: len(vectors)]
    if len(ids) < 2:
        return
    tree = neighbours.Tree.build(ids, vectors)
    query, near, score, bound = tree.nearest(vectors[:5], ids[:5], 4, 1.0)
    again = tree.nearest(vectors[:5], ids[:5], 4, 1.0, bound)
    assert all((x == y).all() for x, y in zip(again, (query, near, score), strict=False))
    for q in range(min(5, len(ids))):
        v = vectors[q]
        cosine = (v * vectors).sum(1) / (np.sqrt((v * v).sum()) * np.sqrt((vectors * vectors).sum(1)))
        order = [i for i in np.lexsort((ids, -cosine)).tolist() if ids[i] != ids[q]][:4]
        assert np.allclose(score[query == q], cosine[order], atol=1e-12)


def test_main_text_of_given_pages(spark, sf):
    table = spark.read.parquet(f"{sf}/pages.parquet")
    got = {r.page_id: r for r in pages.main_text(table).collect()}
    assert len(got) == table.count()
    for r in table.collect():
        article = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        blocks = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?p>|</?h1>", article)]
        want = "\n".join(b for b in blocks if b)
        assert (got[r.page_id].text, got[r.page_id].n_chars, got[r.page_id].url) == (want, len(want), r.url)


def test_alignment_alone_finds_the_article(spark):
    """The given pages without their article elements: neighbours must tell the article from the rest."""
    table = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    renamed = table.withColumn("html", F.regexp_replace("html", r"(</?)(article|main)\b", "$1div"))
    want = {r.page_id: r.text for r in pages.main_text(table).collect()}
    got = {r.page_id: r.text for r in pages.main_text(renamed).collect()}
    assert set(got) == set(want) and sum(got[i] == want[i] for i in want) >= 0.99 * len(want)
    # The same by plain Python over the sorted pages.
    made = []
    for r in renamed.collect():
        lines, kinds = pages.page_lines(r.html)
        made.append((*pages.place_of(r.url), r.page_id, lines, kinds))
    lists = {}
    for host, path, _, lines, kinds in made:
        key = host, tuple(lines), tuple(kinds)
        lists[key] = min(path, lists.get(key, path))
    order = sorted((host, path, lines, kinds) for (host, lines, kinds), path in lists.items())
    at = {(host, lines, kinds): i for i, (host, _, lines, kinds) in enumerate(order)}
    tied = {i for i in range(1, len(order)) if order[i][:2] == order[i - 1][:2]}  # Spark breaks such ties by hash
    assert len(tied) < 20
    for host, _, page, lines, kinds in made:
        i = at[host, tuple(lines), tuple(kinds)]
        if tied & set(range(i - 4, i + 5)):
            continue
        near = [list(order[j][2]) for j in range(max(0, i - 3), min(len(order), i + 4)) if order[j][0] == host and order[j][2] != tuple(lines)]
        keep = pages.lines_to_keep(lines, kinds, near, [len(x) for x in lines])
        assert got[page] == "\n".join(x for x, k in zip(lines, keep, strict=True) if k)


def test_pages_with_an_article_are_aligned_as_well(monkeypatch):
    met = []
    real = pages.common_lines
    monkeypatch.setattr(pages, "common_lines", lambda a, b: met.append((a, b)) or real(a, b))
    kinds = [pages.AROUND, pages.ARTICLE, pages.PLAIN, pages.ARTICLE, pages.AROUND]
    assert pages.lines_to_keep([9, 1, 2, 3, 8], kinds, [[9, 2, 3, 8], [9, 2, 8]]) == [False, True, False, True, False]
    assert met == [([1, 2, 3], [9, 2, 3, 8]), ([1, 2, 3], [9, 2, 8])]
    # A block decides on its own pages; those of the next block stand in it as neighbours only.
    own = [{"block": 0, "host": "h", "class": p, "place": p, "hashes": np.array([7, p]).tobytes(), "kinds": bytes([pages.ARTICLE, pages.PLAIN]), "sizes": np.array([3, 3], np.int32).tobytes()} for p in range(62, 68)]
    del met[:]
    done = pages._decide(pa.Table.from_pylist(own)).to_pylist()
    assert done == [{"class": p, "keep": [True]} for p in (62, 63, 64)] and len(met) == 3 + 4 + 5


def test_template_of_short_pages_and_runs_of_copies_goes(spark):
    template = "".join(f"<p>Tmpl {i}</p>" for i in range(15))
    page = "<html><body><div>{t}</div><div>{own}</div></body></html>"
    own = "<p>Story {n} tells at some length what happened on day {n}</p><p>It went on for {n} hours and more than that</p><p>Then story {n} ended well</p>"
    made = [(n, f"http://a.example/{n}", page.format(t=template, own=own.format(n=n))) for n in range(8)]
    made += [(100 + n, f"http://a.example/3/{n}", made[3][2]) for n in range(40)]  # copies beside each other
    got = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(made, "page_id long, url string, html string")).collect()}
    for n in range(8):
        assert got[n] == "\n".join(re.findall("<p>(.*?)</p>", own.format(n=n)))
    assert {got[100 + n] for n in range(40)} == {got[3]}


def test_attributes_and_repeated_lines_of_any_length():
    long = "A" * 100_000
    assert pages.page_lines(f'<div data-x="{long} > b">text</div><p title=\'{long}>\'>more')[0] == ["text", "more"]
    assert len(pages.common_lines([1] * 20_000 + [2], [3] + [1] * 20_000)) == 20_000
    draw = np.random.default_rng(4)
    a, b = (draw.integers(0, 3, 20_000).tolist() for _ in range(2))
    rest, got = iter(b), pages.common_lines(a, b)
    assert len(got) > 13_000 and all(any(a[i] == y for y in rest) for i in got)


PAGE = """<html><head><title>T</title><style>p{{}}</style></head><body>
<header><a href="/">Home</a></header><nav><ul><li>Menu {n}</ul></nav><div class="cookie-notice">We use cookies</div>
<div><p>Welcome to our site</p></div>{body}<div><p>Follow   the &amp; crowd</p></div>
<form>Search <input></form><aside>Side {n}</aside><section id="comments"><p>Reader says {n}</p></section>
<script>var x = "<p>no</p>";</script><!-- <p>hidden</p> --><footer>&copy; us {n}</footer></body></html>"""


def test_shared_lines_of_plain_pages_go(spark):
    plain = [(n, f"http://a.example/p/{n}", PAGE.format(n=n, body=f"<div><p>Story <b>num&shy;ber</b> {n}<br>goes on &lt;{n}&gt;<p>End {n}</div>")) for n in range(1, 12)]
    df = spark.createDataFrame(plain, "page_id long, url string, html string")
    got = {r.page_id: r.text for r in pages.main_text(df).collect()}
    assert got == {n: f"Story num\xadber {n} goes on <{n}>\nEnd {n}" for n in range(1, 12)}


def test_articles_and_copies_keep_shared_lines(spark):
    body = "<article><header><h1>Title</h1></header><p>Quoted by all</p><p>Own {n}</p><div class='share'>Share this</div><aside>Ad</aside></article>"
    made = [(n, f"http://a.example/{n}", PAGE.format(n=n, body=body.format(n=n))) for n in range(5)]
    copy = "<div><p>One line</p><p>Another line</p></div>"
    made += [(10 + n, f"http://b.example/{n}", copy) for n in range(4)]
    got = {r.page_id: r.text for r in pages.main_text(spark.createDataFrame(made, "page_id long, url string, html string")).collect()}
    assert all(got[n] == f"Title\nQuoted by all\nOwn {n}" for n in range(5))
    assert all(got[10 + n] == "One line\nAnother line" for n in range(4))


ARTICLE = "<article><h1>Title</h1><p>Own</p></article>"


@pytest.mark.parametrize(
    ("page", "text"),
    [
        (f"<body class='has-sidebar'><nav>Menu</nav>{ARTICLE}</body>", "Title|Own"),
        ("<body class='sidebar'><p>Plain</p></body>", "Plain"),
        ("<div class='no-sidebar'><p>Plain</p></div><div class='site-footer'>Foot</div><div class='cookie-notice'>Cookies</div>", "Plain"),
        (f"<div id='page' class='no-sidebar social'><nav>Menu</nav>{ARTICLE}<p>Beside</p></div>", "Title|Own"),
        (f"<form action='x'><div>Beside</div><main>{ARTICLE}</main></form>", "Title|Own"),
        ("<article><p>Own</p><section id='discussion'>Part</section><p class='alert'>Box</p><div class='share'>Share</div></article>", "Own|Part|Box"),
        (f"{ARTICLE}<div class='sidebar'><article>Teaser</article></div><section id='comments'><article>Reader</article></section>", "Title|Own"),
        ("<p>Plain</p><section class='comments'><article>Reader</article></section><aside><article>Teaser</article></aside>", "Plain"),
        (f"<div hidden>{ARTICLE}</div><p>Plain</p>", "Plain"),
    ],
)
def test_wrappers_keep_their_article(page, text):
    lines, kinds = pages.page_lines(page)
    keep = pages.lines_to_keep(list(range(len(lines))), kinds, [])
    assert "|".join(x for x, k in zip(lines, keep, strict=True) if k) == text


def test_odd_pages(spark):
    made = [(1, None, None), (2, "", ""), (2, "", ""), (None, "x", "<p>no id"), (4, "http://h/a", "<p>a<p>b</div></p>&#x41;&nbsp;&eacute; <3 x <b"), (5, "http://h/b", "plain")]
    made += [(6, "http://h/c", "<script>never closed <p>x"), (7, "http://h/d", "<div" * 3000), (8, "http://h/e", "<p>" + "long " * 50_000)]
    df = spark.createDataFrame(made, "page_id long, url string, html string").withColumns({c: F.lit("x") for c in ("tag", "keep", "host", "text")})
    got = rows(pages.main_text(df).select("page_id", "text"))
    assert len(got) == len(made)
    texts = dict(got)
    assert texts[1] == texts[2] == texts[6] == "" and texts[None] == "no id" and texts[5] == "plain"
    assert texts[4].startswith("a\nb\nA é") and texts[8] == " ".join(["long"] * 50_000)
    assert pages.main_text(df.limit(0)).count() == 0


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 5), max_size=14), st.lists(st.integers(0, 5), max_size=14))
def test_common_lines_are_longest(a, b):
    best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            best[i + 1][j + 1] = best[i][j] + 1 if x == y else max(best[i][j + 1], best[i + 1][j])
    whole = pages.common_lines(a, b)
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(pages, "TABLE", 6)
        halved = pages.common_lines(a, b)
    for got in (whole, halved):
        assert len(got) == best[-1][-1] and got == sorted(set(got))
        rest = iter(b)
        assert all(any(a[i] == y for y in rest) for i in got)
