"""News-article jobs: cleaning, enrichment, trends and metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.sentiment import contexts, literal_valences, scored_hits, sentiment, verdict
from millrace.functions.text import joined_text, strip_markup, top_keywords
from millrace.operators.aggregates import group_count, unnest_count
from millrace.operators.windows import window_counts, window_delta

TREND_MINUTES = 60


def clean_articles(df: DataFrame) -> DataFrame:
    """Markup-free title and content beside the originals. Works on batches and streams."""
    return df.withColumns(
        {"title_clean": strip_markup(F.col("title")), "content_clean": strip_markup(F.col("content"))}
    )


MOST_WORDS, MOST_VALENCES = 1_000, 200  # of a lexicon that may stand in the plan


def article_sentiment(df: DataFrame, lexicon: DataFrame | None = None, keep: list[str] | None = None) -> DataFrame:
    """Sentiment of title and description, beside the columns ``keep`` (all).

    ``lexicon`` is a table (word, valence) of any size; a word listed twice counts
    with its larger valence. The built-in words, and any lexicon of up to MOST_WORDS
    words, are part of the expression: one scan, and nothing is shuffled. With a
    larger one the texts still stay where they are: words go to meet it, each with
    the little around it that scoring needs, and only those it holds come back to
    their row's ``keep`` columns.
    """
    keep = df.columns if keep is None else keep
    body = joined_text("title", "description")
    if lexicon is None:
        return df.select(*keep, sentiment(body).alias("sentiment"))
    known = lexicon.filter(F.col("word").isNotNull() & F.col("valence").isNotNull()).groupBy("word").agg(F.max("valence").cast("double").alias("valence"))
    first = known.limit(MOST_WORDS + 1).collect()
    if len(first) <= MOST_WORDS and len({r["valence"] for r in first}) <= MOST_VALENCES:
        return df.select(*keep, sentiment(body, literal_valences({r["word"]: r["valence"] for r in first})).alias("sentiment"))
    return _by_words(df, body, known, keep)


def _by_words(df: DataFrame, body: Column, known: DataFrame, keep: list[str]) -> DataFrame:
    """Sentiment by a join of the words with a lexicon of distinct words."""
    # One more entry for each row stands for the row itself and alone carries its columns.
    rows = df.select(F.monotonically_increasing_id().alias("_row"), F.struct(*keep).alias("_keep"), contexts(body).alias("_c"))
    itself = F.struct(F.col("_keep"), F.col("_c.n").alias("n"), F.col("_c.emph").alias("emph"), F.col("_c.mixed").alias("mixed"), F.col("_c.but").alias("but"))
    entries = rows.select("_row", itself.alias("_itself"), F.explode(F.concat(F.array(F.lit(None)), F.col("_c.words"))).alias("_word"))
    entries = entries.select("_row", F.when(F.col("_word").isNull(), F.col("_itself")).alias("_itself"), "_word")
    met = entries.join(known, F.col("_word.w") == F.col("word"), "left").filter(F.col("_itself").isNotNull() | F.col("valence").isNotNull())
    hit = F.when(F.col("_itself").isNull(), F.struct("_word.i", "_word.loud", "_word.before", "valence"))
    by_row = met.groupBy("_row").agg(F.first("_itself", ignorenulls=True).alias("_s"), F.sort_array(F.collect_list(hit)).alias("_hits"))
    scores = scored_hits(F.col("_hits"), F.col("_s.mixed"), F.col("_s.but"))
    return by_row.select("_s._keep.*", verdict(F.col("_s.n"), F.col("_s.emph"), scores).alias("sentiment"))


def article_keywords(df: DataFrame, top_n: int = 10) -> DataFrame:
    """Most frequent keywords of title, description and content."""
    return df.withColumn("keywords", top_keywords(joined_text("title", "description", "content"), top_n))


def enrich(df: DataFrame) -> DataFrame:
    """Sentiment and keywords."""
    return article_keywords(article_sentiment(df))


def sentiment_distribution(enriched: DataFrame) -> DataFrame:
    labelled = enriched.select(F.col("sentiment.label").alias("sentiment_label"))
    return group_count(labelled.filter(F.col("sentiment_label").isNotNull()), ["sentiment_label"])


def keyword_counts(with_keywords: DataFrame, ts: str, minutes: int = TREND_MINUTES) -> DataFrame:
    """Keyword occurrences per window."""
    # The outer form keeps the optimizer from testing the array's size first,
    # which would compute the keywords twice.
    exploded = with_keywords.select(F.col(ts).alias("at"), F.explode_outer("keywords").alias("keyword"))
    return window_counts(exploded.filter(F.col("keyword").isNotNull()), "at", "keyword", minutes)


def keyword_trend(counts: DataFrame, minutes: int = TREND_MINUTES) -> DataFrame:
    """Keyword counts per window against the window before."""
    return window_delta(counts, minutes)


def trending(trend: DataFrame, top_n: int = 20) -> DataFrame:
    """The strongest risers of the latest window that has articles."""
    latest = trend.filter(F.col("current_count") > 0).agg(F.max("window_start")).scalar()
    return (
        trend.filter(F.col("window_start") == latest)
        .orderBy(F.desc("trend_score"), F.desc("current_count"), F.asc("keyword"))
        .limit(top_n)
    )


def all_time_keywords(with_keywords: DataFrame, top_n: int = 20) -> DataFrame:
    """All-time keyword counts."""
    return unnest_count(with_keywords, "keywords").orderBy(F.desc("n"), F.asc("keyword")).limit(top_n)


def live_metrics(articles: DataFrame, day: str, ts: str = "published_at") -> DataFrame:
    """Total, today's and per-source article counts as (metric, value) rows.

    Articles are counted once per (source, today or not); the rest are sums of
    those few rows.
    """
    per_source = articles.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col(ts).startswith(day)).alias("today")
    )
    # Sources are explicit rows; the two totals are added from the same counts.
    rows = per_source.select(
        F.explode(
            F.array(
                F.struct(F.concat(F.lit("source:"), F.col("source")).alias("metric"), F.col("n").alias("value")),
                F.struct(F.lit("total_articles").alias("metric"), F.col("n").alias("value")),
                F.struct(F.lit("articles_today").alias("metric"), F.col("today").alias("value")),
            )
        ).alias("m")
    )
    return rows.groupBy("m.metric").agg(F.sum("m.value").alias("value"))
