"""Two raw article feeds brought to one schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.dates import epoch_to_iso

CATEGORY = "technology"
STORY_URL = "https://news.ycombinator.com/item?id="


def _text(column: Column) -> Column:
    return F.coalesce(column, F.lit(""))


def normalize_headlines(df: DataFrame, source: str, collected_at: Column) -> DataFrame:
    """Headline feed: url, title, description, content, author, source{name}, publishedAt."""
    url = _text(F.col("url"))
    return df.select(
        F.md5(url).alias("id"),
        _text(F.col("title")).alias("title"),
        _text(F.col("description")).alias("description"),
        _text(F.col("content")).alias("content"),
        url.alias("url"),
        _text(F.col("author")).alias("author"),
        _text(F.col("source.name")).alias("source_name"),
        _text(F.col("publishedAt")).alias("published_at"),
        collected_at.alias("collected_at"),
        F.lit(source).alias("source"),
        F.lit(CATEGORY).alias("category"),
        F.lit(None).cast("int").alias("score"),
        F.lit(None).cast("int").alias("comments"),
    )


def normalize_stories(df: DataFrame, collected_at: Column) -> DataFrame:
    """Story feed: id, url, title, text, by, time (epoch seconds), score, descendants.

    Stories without a title are left out; a missing url becomes the story's page.
    """
    url = F.coalesce(F.col("url"), F.concat(F.lit(STORY_URL), F.col("id").cast("string")))
    return df.filter(F.coalesce(F.col("title"), F.lit("")) != "").select(
        F.md5(url).alias("id"),
        F.col("title"),
        _text(F.col("text")).alias("description"),
        _text(F.col("text")).alias("content"),
        url.alias("url"),
        _text(F.col("by")).alias("author"),
        F.lit("Hacker News").alias("source_name"),
        epoch_to_iso(F.col("time")).alias("published_at"),
        collected_at.alias("collected_at"),
        F.lit("hackernews").alias("source"),
        F.lit(CATEGORY).alias("category"),
        F.coalesce(F.col("score").cast("int"), F.lit(0)).alias("score"),
        F.coalesce(F.col("descendants").cast("int"), F.lit(0)).alias("comments"),
    )
