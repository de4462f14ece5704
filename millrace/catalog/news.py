"""Text and article queries over documents and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.scalars import TOKENS_SQL
from millrace.catalog.views import over
from millrace.functions import sentiment as lex
from millrace.plans import news
from millrace.registry import query
from millrace.session import stage_table
from millrace.sources import feeds, pages
from millrace.sources import tables as t


def articles(spark, sf):
    return t.articles(spark, sf)


def _pairs(values: dict[str, float]) -> str:
    return ", ".join(f"('{w}', {v}::DOUBLE)" for w, v in values.items())


_NEGATIONS = ", ".join("'" + w.replace("'", "''") + "'" for w in lex.NEGATIONS)


_WORDS = ", ".join(f"'{w}'" for w in lex.LEXICON)


def _step(distance: int, weight: float) -> str:
    """SQL for the effect of the word ``distance`` places before a hit."""
    before = f"list_extract(words, i - {distance})"
    spoken = f"list_extract(raw, i - {distance})"
    s = f"s{distance - 1}"
    return f"""r{distance} AS (SELECT r.*, coalesce(b.v, 0) * CASE WHEN {s} < 0 THEN -1 ELSE 1 END AS b{distance}
          FROM r{distance - 1} r LEFT JOIN boost b ON i > {distance} AND b.w = {before}),
      q{distance} AS (SELECT r.*, {s} + (b{distance} + CASE WHEN mixed AND b{distance} <> 0 AND {spoken} = upper({spoken}) AND {spoken} <> lower({spoken})
            THEN CASE WHEN {s} > 0 THEN 0.733 ELSE -0.733 END::DOUBLE ELSE 0 END) * {weight}::DOUBLE AS m{distance} FROM r{distance} r),
      t{distance} AS (SELECT q.*, CASE WHEN i <= {distance} OR {before} IN (SELECT w FROM lex) THEN {s}
            WHEN {before} IN ({_NEGATIONS}) THEN m{distance} * -0.74::DOUBLE ELSE m{distance} END AS s{distance} FROM q{distance} q)"""


def sentiment_sql(tail: str) -> str:
    """Sentiment per article in SQL; ``scored`` has doc_id and the five results."""
    return f"""WITH lex(w, v) AS (VALUES {_pairs(lex.LEXICON)}), boost(w, v) AS (VALUES {_pairs(lex.BOOSTERS)}),
      a AS (SELECT doc_id, title || ' ' || description AS body,
                   list_filter(string_split_regex(title || ' ' || description, '[\\s\\x0B]+'), lambda x: x <> '') AS parts FROM articles_v),
      b AS (SELECT doc_id, body, list_transform(parts, lambda x: CASE WHEN length(regexp_replace(x, '^[[:punct:]]+|[[:punct:]]+$', '', 'g')) <= 2
                   THEN x ELSE regexp_replace(x, '^[[:punct:]]+|[[:punct:]]+$', '', 'g') END) AS raw FROM a),
      c AS (SELECT doc_id, body, raw, list_transform(raw, lambda x: lower(x)) AS words,
                   len(list_filter(raw, lambda x: x = upper(x) AND x <> lower(x))) AS caps FROM b),
      d AS (SELECT *, caps > 0 AND caps < len(raw) AS mixed, coalesce(list_position(words, 'but'), 0) AS but FROM c),
      e AS (SELECT doc_id, words, raw, mixed, but,
                   unnest(list_filter(range(1, len(words) + 1), lambda p: words[p] IN ({_WORDS}))) AS i FROM d),
      r0 AS (SELECT e.doc_id, i, words, raw, mixed, but, lex.v + CASE WHEN mixed AND raw[i] = upper(raw[i]) AND raw[i] <> lower(raw[i])
                 THEN CASE WHEN lex.v > 0 THEN 0.733 ELSE -0.733 END::DOUBLE ELSE 0 END AS s0
             FROM e JOIN lex ON lex.w = words[i]),
      {_step(1, 1.0)},
      {_step(2, 0.95).replace('FROM r1 r', 'FROM t1 r')},
      {_step(3, 0.9).replace('FROM r2 r', 'FROM t2 r')},
      h AS (SELECT doc_id, s3 * CASE WHEN but > 0 AND i < but THEN 0.5 WHEN but > 0 AND i > but THEN 1.5 ELSE 1 END::DOUBLE AS s FROM t3),
      g AS (SELECT doc_id, sum(s) AS total, sum(CASE WHEN s > 0 THEN s + 1 ELSE 0 END) AS pos,
                   sum(CASE WHEN s < 0 THEN 1 - s ELSE 0 END) AS neg, count(*) FILTER (s <> 0) AS n FROM h GROUP BY doc_id),
      k AS (SELECT d.doc_id, len(words) AS n_words, coalesce(total, 0) AS total, coalesce(pos, 0) AS pos, coalesce(neg, 0) AS neg,
                   len(words) - coalesce(n, 0) AS neu,
                   least(length(body) - length(replace(body, '!', '')), 4) * 0.292::DOUBLE
                   + CASE WHEN length(body) - length(replace(body, '?', '')) > 3 THEN 0.96::DOUBLE
                          WHEN length(body) - length(replace(body, '?', '')) > 1 THEN (length(body) - length(replace(body, '?', ''))) * 0.18::DOUBLE
                          ELSE 0 END AS emph
            FROM d LEFT JOIN g ON d.doc_id = g.doc_id),
      l AS (SELECT *, CASE WHEN total > 0 THEN total + emph WHEN total < 0 THEN total - emph ELSE 0 END AS t,
                   pos + CASE WHEN pos > neg THEN emph ELSE 0 END AS p, neg + CASE WHEN pos < neg THEN emph ELSE 0 END AS ng FROM k),
      scored AS (SELECT doc_id, round(t / sqrt(t * t + 15.0::DOUBLE), 4) AS compound,
                   CASE WHEN n_words = 0 THEN 0 ELSE round(p / (p + ng + neu), 4) END AS positive,
                   CASE WHEN n_words = 0 THEN 0 ELSE round(ng / (p + ng + neu), 4) END AS negative,
                   CASE WHEN n_words = 0 THEN 1 ELSE round(neu / (p + ng + neu), 4) END AS neutral,
                   CASE WHEN round(t / sqrt(t * t + 15.0::DOUBLE), 4) >= 0.05 THEN 'positive'
                        WHEN round(t / sqrt(t * t + 15.0::DOUBLE), 4) <= -0.05 THEN 'negative' ELSE 'neutral' END AS label FROM l)
      {tail}"""


KEYWORDS_SQL = f"""kw AS (SELECT doc_id, {TOKENS_SQL.format(body="title || ' ' || description || ' ' || content")} AS toks FROM articles_v),
      ex AS (SELECT doc_id, unnest(toks) AS word, unnest(range(1, len(toks) + 1)) AS i FROM kw),
      ct AS (SELECT doc_id, word, count(*) AS n, min(i) AS first FROM ex GROUP BY doc_id, word),
      rk AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, first) AS rn FROM ct)"""


@query(
    "txt01_sentiment",
    over("articles_v", sentiment_sql("SELECT doc_id, label, compound, positive, negative, neutral FROM scored")),
)
def txt01(spark, sf):
    return news.article_sentiment(articles(spark, sf)).select("doc_id", "sentiment.*")


@query(
    "txt02_keywords",
    over(
        "articles_v",
        f"""WITH {KEYWORDS_SQL}
            SELECT a.doc_id, coalesce(string_agg(word, ' ' ORDER BY rn), '') AS keywords
            FROM articles_v a LEFT JOIN rk ON a.doc_id = rk.doc_id AND rn <= 10 GROUP BY a.doc_id""",
    ),
)
def txt02(spark, sf):
    return news.article_keywords(articles(spark, sf)).select("doc_id", F.array_join("keywords", " ").alias("keywords"))


@query(
    "txt06_enrich",
    over(
        "articles_v",
        sentiment_sql("").rstrip()
        + f""", {KEYWORDS_SQL},
            ks AS (SELECT a.doc_id, coalesce(string_agg(word, ' ' ORDER BY rn), '') AS keywords
                   FROM articles_v a LEFT JOIN rk ON a.doc_id = rk.doc_id AND rn <= 10 GROUP BY a.doc_id)
            SELECT id, min(doc_id) AS doc_id, any_value(label) AS label, any_value(compound) AS compound, any_value(keywords) AS keywords
            FROM articles_v JOIN scored USING (doc_id) JOIN ks USING (doc_id) WHERE id <> '' GROUP BY id""",
    ),
)
def txt06(spark, sf):
    """New articles (first per id), enriched with sentiment and keywords."""
    from millrace.operators.sets import new_by_key

    everything = articles(spark, sf)
    keepers = new_by_key(t.articles(spark, sf).select("id", "doc_id"), "id", [F.asc("doc_id")]).select("doc_id")
    fresh = everything.join(keepers, "doc_id", "left_semi")
    return news.enrich(fresh).select(
        "id", "doc_id", "sentiment.label", "sentiment.compound", F.array_join("keywords", " ").alias("keywords")
    )


@query(
    "txt07_sentiment_distribution",
    over("articles_v", sentiment_sql("SELECT label AS sentiment_label, count(*) AS n FROM scored GROUP BY label")),
)
def txt07(spark, sf):
    return news.sentiment_distribution(news.article_sentiment(articles(spark, sf)))


@query(
    "agg20_top_keywords",
    over(
        "articles_v",
        f"""WITH {KEYWORDS_SQL}
            SELECT word AS keyword, count(*) AS n FROM rk WHERE rn <= 10 AND word <> '' AND length(word) > 2
            GROUP BY word ORDER BY n DESC, keyword LIMIT 20""",
    ),
)
def agg20_keywords(spark, sf):
    return news.all_time_keywords(news.article_keywords(articles(spark, sf)))


@query(
    "win05_trending_keywords",
    over(
        "articles_v",
        f"""WITH {KEYWORDS_SQL},
            w AS (SELECT date_trunc('hour', CAST(published_at AS TIMESTAMP)) AS slot, word FROM rk JOIN articles_v USING (doc_id) WHERE rn <= 10),
            c AS (SELECT slot, word, count(*) AS n FROM w GROUP BY slot, word),
            l AS (SELECT max(slot) AS slot FROM c),
            cur AS (SELECT word, n FROM c, l WHERE c.slot = l.slot), prev AS (SELECT word, n FROM c, l WHERE c.slot = l.slot - INTERVAL 1 HOUR)
            SELECT l.slot AS window_start, coalesce(cur.word, prev.word) AS keyword, coalesce(cur.n, 0) AS current_count,
                   coalesce(prev.n, 0) AS previous_count, coalesce(cur.n, 0) - coalesce(prev.n, 0) AS trend_score
            FROM cur FULL JOIN prev ON cur.word = prev.word, l
            ORDER BY trend_score DESC, current_count DESC, keyword LIMIT 20""",
    ),
)
def win05_keywords(spark, sf):
    tagged = news.article_keywords(articles(spark, sf)).withColumn(
        "at", F.to_timestamp_ntz("published_at")
    )
    # The counts are read for the trend and for its latest window, so they are stored once.
    counts = stage_table(news.keyword_counts(tagged, "at"), "keyword_counts")
    return news.trending(news.keyword_trend(counts))


@query(
    "job22_live_metrics",
    over(
        "articles_v",
        """SELECT 'total_articles' AS metric, count(*) AS value FROM articles_v
           UNION ALL SELECT 'articles_today', count(*) FROM articles_v WHERE published_at LIKE '2024-01-01%'
           UNION ALL SELECT 'source:' || source, count(*) FROM articles_v GROUP BY source""",
    ),
)
def job22(spark, sf):
    return news.live_metrics(t.articles(spark, sf), "2024-01-01")


@query(
    "src10_normalize_feeds",
    """SELECT md5(url) AS id, coalesce(CASE WHEN page_id % 5 <> 0 THEN url END, '') AS title, url, '' AS author,
              'Feed ' || page_id % 3 AS source_name, '2024-01-01T00:00:00' AS published_at, 'newsapi_headlines' AS source,
              'technology' AS category, NULL::INTEGER AS score, NULL::INTEGER AS comments, length(coalesce(html, '')) AS content_length
       FROM pages
       UNION ALL
       SELECT md5('https://news.ycombinator.com/item?id=' || doc_id), source, 'https://news.ycombinator.com/item?id=' || doc_id, lang,
              'Hacker News', CASE WHEN doc_id = 0 THEN '' ELSE strftime(make_timestamp(doc_id * 86400 * 1000000), '%Y-%m-%dT%H:%M:%S') END,
              'hackernews', 'technology', CAST(n_chars AS INTEGER), 0, length(text) FROM documents""",
)
def src10(spark, sf):
    """Pages as the headline feed and documents as the story feed, in one schema."""
    from millrace.operators.sets import union_all

    headlines = t.table(spark, sf, "pages").select(
        "url",
        F.when(F.col("page_id") % 5 != 0, F.col("url")).alias("title"),
        F.lit(None).cast("string").alias("description"),
        F.col("html").alias("content"),
        F.lit(None).cast("string").alias("author"),
        F.struct(F.concat(F.lit("Feed "), (F.col("page_id") % 3).cast("string")).alias("name")).alias("source"),
        F.lit("2024-01-01T00:00:00").alias("publishedAt"),
    )
    stories = t.table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"),
        F.lit(None).cast("string").alias("url"),
        F.col("source").alias("title"),
        "text",
        F.col("lang").alias("by"),
        (F.col("doc_id") * 86400).alias("time"),
        F.col("n_chars").alias("score"),
        F.lit(None).cast("int").alias("descendants"),
    )
    now = F.lit("2024-02-01T00:00:00")
    both = union_all(feeds.normalize_headlines(headlines, "newsapi_headlines", now), feeds.normalize_stories(stories, now))
    return both.select(
        "id", "title", "url", "author", "source_name", "published_at", "source", "category", "score", "comments",
        F.length("content").cast("long").alias("content_length"),
    )


@query("src09_page_entries")
def src09(spark, sf):
    """Text blocks that begin with one of these words, by page."""
    return pages.entries(
        t.table(spark, sf, "pages"),
        "2024-02-01 00:00:00",
        labels=("The", "And", "Of", "To", "De", "La", "En", "Der", "Und"),
        aliases={"Die": "Der", "Las": "La"},
    )
