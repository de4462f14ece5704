"""Sentiment, keywords, markup and page entries."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from millrace.functions import text
from millrace.functions.sentiment import LEXICON, sentiment
from millrace.plans import news
from millrace.sources import feeds, pages, tables
from millrace.sources.pages import extract_entries
from tests.conftest import rows


def score(spark, body):
    return spark.createDataFrame([(body,)], "t string").select(sentiment(F.col("t")).alias("s")).first().s


@pytest.mark.parametrize("body", ["", "   ", None])
def test_empty_text_is_neutral(spark, body):
    assert tuple(score(spark, body)) == ("neutral", 0.0, 0.0, 0.0, 1.0)


def test_labels_follow_the_words(spark):
    assert score(spark, "A great and wonderful day").label == "positive"
    assert score(spark, "A terrible, horrible crash").label == "negative"
    assert score(spark, "The committee met on Tuesday").label == "neutral"


def test_published_examples_of_the_rules(spark):
    plain = score(spark, "the food is good").compound
    assert plain == round(1.9 / (1.9**2 + 15) ** 0.5, 4) == 0.4404
    assert score(spark, "the food is not good").compound == round(-1.406 / (1.406**2 + 15) ** 0.5, 4)
    assert score(spark, "the food is very good").compound > plain > score(spark, "the food is slightly good").compound
    assert score(spark, "the food is GOOD").compound > plain
    assert score(spark, "the food is good!!!").compound > score(spark, "the food is good!").compound > plain
    assert score(spark, "the food is good, but the service is terrible").compound < 0


def test_shares_add_up(spark):
    s = score(spark, "good bad neither here nor there")
    assert abs(s.positive + s.negative + s.neutral - 1) < 0.001


def test_any_lexicon_table_may_be_used(spark):
    df = spark.createDataFrame([("A blorp day", "so flim"), ("good", None)], "title string, description string")
    lexicon = spark.createDataFrame([("blorp", 3.0), ("blorp", 1.0), ("flim", -1.0)] + [(f"w{i}", 1.0) for i in range(5000)], "word string, valence double")
    found = {r.title: r.sentiment for r in news.article_sentiment(df, lexicon).collect()}
    assert found["A blorp day"].label == "positive" and found["good"].label == "neutral"
    text = news.article_sentiment(df, lexicon)._jdf.queryExecution().toString()
    assert "w4999" not in text


def test_title_and_description_with_nulls(spark):
    df = spark.createDataFrame([(None, None), ("Good", None), (None, "bad")], "title string, description string")
    found = {(r.title, r.description): r.sentiment.label for r in news.article_sentiment(df).collect()}
    assert found == {(None, None): "neutral", ("Good", None): "positive", (None, "bad"): "negative"}


def brute_keywords(body, n=10):
    letters = "".join(c for c in body.lower() if "a" <= c <= "z" or c.isspace())
    kept = [w for w in letters.split() if len(w) > 3 and w not in text.STOP_WORDS]
    return [w for w, _ in Counter(kept).most_common(n)]


@pytest.mark.parametrize(
    "body",
    [
        "",
        "the and of",
        "Market market MARKET stocks, stocks rally rally rally rally!",
        "zeta alpha zeta alpha beta beta gamma",
        "don't won't markets' market's co-operate 2024 rally2",
        "one thing leads\tto\nanother thing",
        " ".join(f"word{chr(97 + i % 26)}{chr(97 + i // 26)}" for i in range(200)) + " wordzz wordzz",
    ],
)
def test_keywords_match_brute_force(spark, body):
    got = spark.createDataFrame([(body,)], "t string").select(text.top_keywords(F.col("t")).alias("k")).first().k
    assert got == brute_keywords(body)


def test_keywords_match_brute_force_on_whole_documents(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("text", text.top_keywords(F.col("text")).alias("k"))
    for row in docs.collect():
        assert row.k == brute_keywords(row.text)


def test_top_n_is_respected(spark):
    df = spark.createDataFrame([("alpha bravo charlie delta",)], "t string")
    assert df.select(text.top_keywords(F.col("t"), 2).alias("k")).first().k == ["alpha", "bravo"]


def test_markup_goes_and_spaces_collapse(spark):
    df = spark.createDataFrame([("<p>a <b>b</b></p>\n\n  c<br/>d", None)], "title string, content string")
    out = news.clean_articles(df).first()
    assert (out.title_clean, out.content_clean) == ("a b cd", None)


def test_sentiment_distribution_leaves_out_null_labels(spark):
    df = spark.createDataFrame([(("positive",),), ((None,),), (None,)], "sentiment struct<label: string>")
    assert rows(news.sentiment_distribution(df)) == [("positive", 1)]


LABELS = ("Aries", "Leo")
ALIASES = {"Lion": "Leo"}
LONG = "a description that is long enough to stand alone"


def test_headings_take_the_next_sibling():
    html = f"<div><h3> Aries </h3><p>{LONG}</p></div><h3>Aries</h3><p>second is ignored, first wins</p>"
    assert pages.extract_entries(html, LABELS, ALIASES) == [("Aries", LONG)]


def test_short_siblings_fall_through_to_the_enclosing_element():
    html = f"<section><div><b>Leo</b><i>short</i></div><em>{LONG}</em></section>"
    assert pages.extract_entries(html, LABELS, ALIASES) == [("Leo", f"short {LONG}")]


def test_aliases_fold_and_blocks_are_the_fallback():
    html = f"<p>Lion: {LONG}</p><p>Leo: again {LONG}</p><li>Aries - tiny</li><script>Aries {LONG}</script>"
    assert pages.extract_entries(html, LABELS, ALIASES) == [("Leo", LONG)]


def test_pages_without_labels_give_nothing():
    assert pages.extract_entries("", LABELS, ALIASES) == []
    assert pages.extract_entries("<p>nothing<p>here", LABELS, ALIASES) == []


def test_entries_of_a_page_table(spark):
    table = spark.createDataFrame([(1, f"<h2>Aries</h2><p>{LONG}</p>"), (2, None)], "page_id long, html string")
    out = pages.entries(table, "2024-02-01 10:00:00", LABELS, ALIASES)
    assert rows(out) == [(1, "Aries", LONG, "2024-02-01", "2024-02-01 10:00:00")]


def test_feeds_share_one_schema(spark):
    now = F.lit("2024-02-01T00:00:00")
    a = spark.createDataFrame(
        [("http://x/1", None, "d", None, None, ("Src",), None)],
        "url string, title string, description string, content string, author string, source struct<name: string>, publishedAt string",
    )
    b = spark.createDataFrame(
        [(7, None, "Title", None, "me", 1700000000, 5, None), (8, "http://y", "", "t", "me", 0, 1, 2)],
        "id long, url string, title string, text string, by string, time long, score int, descendants int",
    )
    one, two = feeds.normalize_headlines(a, "newsapi_headlines", now), feeds.normalize_stories(b, now)
    assert one.columns == two.columns and len(one.columns) == 13
    head, story = one.first(), two.first()
    assert (head.title, head.author, head.source_name, head.category) == ("", "", "Src", "technology")
    assert two.count() == 1
    assert story.url == "https://news.ycombinator.com/item?id=7" and story.published_at == "2023-11-14T22:13:20"
    assert (story.score, story.comments) == (5, 0)


def deep(levels, text):
    return "<div>" * levels + text + "</div>" * levels


def test_entries_of_deeply_nested_pages_take_linear_time():
    import time

    def seconds(levels):
        page = deep(levels, "".join(f"<p>Word {i} of the page</p>" for i in range(levels)) + "<p>The rest of the story goes here</p>")
        start = time.process_time()
        assert extract_entries(page, ("The",), {}) == [("The", "rest of the story goes here")]
        return time.process_time() - start

    small, large = seconds(500), seconds(2000)
    assert large < 12 * max(small, 0.02)


def brute_entries(html, labels, aliases):
    """Every block's whole text against every label."""
    import re

    found = {}
    blocks = re.findall(r"<p>([^<]*)</p>", html)
    for text in (" ".join(b.split("\n")).strip() for b in blocks):
        for label in (*labels, *aliases):
            name = aliases.get(label, label)
            if text.startswith(label) and len(text) > len(label) + 10 and name not in found:
                found[name] = text[len(label) :].strip(" :-")
                break
    return found


def test_opening_blocks_match_a_plain_reading():
    labels, aliases = ("The", "Th", "Of"), {"Das": "The"}
    html = "".join(f"<p>{t}</p>" for t in ("Das ist ein langer Satz", "Off the record, as they say", "Of it", "The second sentence is here", "Of course it is so"))
    assert dict(extract_entries(html, labels, aliases)) == brute_entries(html, labels, aliases)


def test_articles_of_large_ids(spark, tmp_path):
    spark.createDataFrame([(3_000_000_000, "a\nb", "en", "s", 3)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(tmp_path / "documents.parquet")
    )
    row = tables.articles(spark, str(tmp_path)).first()
    assert row.doc_id == 3_000_000_000 and row.published_at.startswith("2")


TEXTS = [
    ("GOOD day, but NOT very good", "so bad! really?? good"),
    ("never Good", "not so EXTREMELY great!!!"),
    (None, None),
    ("", "   "),
    ("love love love", "hate but love hate isn't bad"),
    ("plain words alone", "x"),
    ("very very good bad", "VERY GOOD BAD"),
]


def test_both_ways_to_meet_a_lexicon_agree(spark, sf):
    """In the plan and by a join of the words: the same scores, and no exchange holds a text."""
    lexicon = spark.createDataFrame(list(LEXICON.items()), "word string, valence double")
    large = lexicon.unionByName(spark.createDataFrame([(f"zz{i}", float(i)) for i in range(3000)] + [(None, 1.0), ("good", -9.0)], "word string, valence double"))
    made = spark.createDataFrame(TEXTS, "title string, description string").withColumn("doc_id", F.monotonically_increasing_id())
    given = tables.articles(spark, sf).select("title", "description", "doc_id")
    for df in (made, given, made.union(made), given.limit(0)):
        here = news.article_sentiment(df, lexicon).select("doc_id", "sentiment.*")
        there = news.article_sentiment(df, large, keep=["doc_id"]).select("doc_id", "sentiment.*")
        builtin = news.article_sentiment(df).select("doc_id", "sentiment.*")
        assert rows(here) == rows(there) == rows(builtin)
    assert "Exchange" not in _plan(news.article_sentiment(given))
    plan = _plan(news.article_sentiment(given, large, keep=["doc_id"]))
    moved = [x for x in plan.split("\n") if "Exchange hashpartitioning(_row" in x]
    assert len(moved) == 1 and plan.count("FileScan") == 1
    assert "title" not in plan.split(moved[0])[0]  # above the scan's own part there is no text


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()
