"""Streaming flows over the given tables, drained into tables and compared with batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.views import over
from millrace.operators.windows import window_delta
from millrace.registry import query
from millrace.session import run_dir
from millrace.sinks import streams
from millrace.sinks.kafka import keyed_json
from millrace.sources import replay
from millrace.sources import tables as t
from millrace.streaming import flows


def _drain(spark, df, label):
    root = run_dir(spark, label)
    return streams.drain(df, f"{root}/table", f"{root}/checkpoint")


def _events(spark, sf):
    return flows.parse_events(replay.event_messages(replay.table_stream(spark, sf, "events")))


def _plain(column):
    """A timestamp without zone, as the tables hold it."""
    return F.col(column).cast("timestamp_ntz").alias(column)


@query(
    "str01_watermark",
    over(
        "activity_v",
        """WITH c AS (SELECT time_bucket(INTERVAL 60 SECOND, event_time) AS window_start, count(*) AS event_count
                      FROM activity_v GROUP BY 1)
           SELECT CAST(sum(event_count) AS BIGINT) AS events, count(*) AS windows, max(window_start) AS last_window FROM c
           WHERE window_start + INTERVAL 60 SECOND <= (SELECT max(event_time) FROM activity_v) - INTERVAL 10 SECOND""",
    ),
)
def str01(spark, sf):
    """What has been emitted: only windows that closed before the watermark."""
    counts = flows.activity_counts(_events(spark, sf), "60 seconds", "10 seconds")
    emitted = _drain(spark, counts, "str01")
    return emitted.agg(
        F.sum("event_count").alias("events"),
        F.count_distinct("window_start").alias("windows"),
        F.max(F.col("window_start").cast("timestamp_ntz")).alias("last_window"),
    )


@query(
    "str02_window_counts",
    over(
        "activity_v",
        """WITH c AS (SELECT time_bucket(INTERVAL 10 SECOND, event_time) AS window_start, CAST(user_id AS VARCHAR) AS user_id,
                             event_type, count(*) AS event_count FROM activity_v GROUP BY 1, 2, 3)
           SELECT window_start, user_id, event_type, event_count FROM c
           WHERE window_start + INTERVAL 10 SECOND <= (SELECT max(event_time) FROM activity_v) - INTERVAL 10 SECOND""",
    ),
)
def str02(spark, sf):
    counts = _drain(spark, flows.activity_counts(_events(spark, sf)), "str02")
    return counts.select(_plain("window_start"), "user_id", "event_type", "event_count")


@query(
    "str03_purchases",
    over(
        "activity_v",
        """SELECT CAST(event_id AS VARCHAR) AS session_id, CAST(user_id AS VARCHAR) AS user_id, page, event_time
           FROM activity_v WHERE event_type = 'purchase'""",
    ),
)
def str03(spark, sf):
    found = _drain(spark, flows.purchases(_events(spark, sf)), "str03")
    return found.select("session_id", "user_id", "page", _plain("event_time"))


def _claims(spark, sf, ceiling=400_000):
    messages = replay.claim_messages(t.as_claims(replay.table_stream(spark, sf, "orders")))
    return flows.clean_claims(messages, ceiling)


CLAIMS_SQL = """clean AS (SELECT CAST(claim_id AS VARCHAR) AS claim_id, claim_amount, fraud_score, claim_date AS claim_date_ts,
       approved_amount / claim_amount AS approval_ratio,
       CASE WHEN fraud_score >= 0.7 THEN 'HIGH' WHEN fraud_score >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS risk_flag
     FROM claims_v WHERE claim_amount > 0 AND claim_amount < 400000)"""


@query("str04_clean_claims", over("claims_v", f"WITH {CLAIMS_SQL} SELECT * FROM clean"))
def str04(spark, sf):
    cleaned = _drain(spark, _claims(spark, sf), "str04")
    return cleaned.select(
        "claim_id", "claim_amount", "fraud_score", _plain("claim_date_ts"), "approval_ratio", "risk_flag"
    )


@query(
    "str05_clean_text",
    r"""SELECT md5(url) AS id, url AS title_clean,
               regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '[\s\x0B]+', ' ', 'g') AS content_clean FROM pages""",
)
def str05(spark, sf):
    stream = replay.table_stream(spark, sf, "pages").select(
        F.md5("url").alias("id"),
        F.col("url").alias("title"),
        F.lit("").alias("description"),
        F.col("html").alias("content"),
        "url",
        F.lit("").alias("published_at"),
        F.lit("page").alias("source"),
    )
    cleaned = _drain(spark, flows.clean_article_messages(replay.article_messages(stream)), "str05")
    return cleaned.select("id", "title_clean", "content_clean")


@query(
    "str06_two_queries",
    over(
        "activity_v",
        """WITH c AS (SELECT time_bucket(INTERVAL 10 SECOND, event_time) AS w, user_id, event_type, count(*) AS n
                      FROM activity_v GROUP BY 1, 2, 3)
           SELECT 'counts' AS query, count(*) AS rows FROM c
             WHERE w + INTERVAL 10 SECOND <= (SELECT max(event_time) FROM activity_v) - INTERVAL 10 SECOND
           UNION ALL SELECT 'purchases', count(*) FROM activity_v WHERE event_type = 'purchase'""",
    ),
)
def str06(spark, sf):
    """Two queries with their own checkpoints over one parsed stream."""
    root = run_dir(spark, "str06")
    messages = replay.event_messages(replay.table_stream(spark, sf, "events"))
    for q in flows.start_activity(messages, f"{root}/out", f"{root}/checkpoint", trigger=None):
        q.awaitTermination()
    sizes = [
        spark.read.parquet(f"{root}/out/{name}").agg(F.lit(name).alias("query"), F.count(F.lit(1)).alias("rows"))
        for name in ("counts", "purchases")
    ]
    return sizes[0].unionByName(sizes[1])


@query("str07_first_seen", "SELECT DISTINCT md5(text) AS id FROM documents")
def str07(spark, sf):
    """Keys are told apart from all before them, however long ago."""
    root = run_dir(spark, "str07")
    stream = replay.table_stream(spark, sf, "documents").select(F.md5("text").alias("id"))
    flows.start_new_keys(stream, "id", f"{root}/table", f"{root}/checkpoint", trigger=None).awaitTermination()
    return spark.read.schema("id string").parquet(f"{root}/table").select("id")


@query(
    "str08_keyword_trend",
    over(
        "activity_v",
        """WITH c AS (SELECT time_bucket(INTERVAL 60 MINUTE, event_time) AS w, page AS keyword, count(*) AS n
                      FROM activity_v GROUP BY 1, 2),
                d AS (SELECT * FROM c WHERE w + INTERVAL 60 MINUTE <= (SELECT max(event_time) FROM activity_v) - INTERVAL 10 MINUTE)
           SELECT coalesce(a.w, b.w + INTERVAL 60 MINUTE) AS window_start, coalesce(a.keyword, b.keyword) AS keyword,
                  coalesce(a.n, 0) AS current_count, coalesce(b.n, 0) AS previous_count,
                  coalesce(a.n, 0) - coalesce(b.n, 0) AS trend_score
           FROM d a FULL JOIN d b ON a.w = b.w + INTERVAL 60 MINUTE AND a.keyword = b.keyword""",
    ),
)
def str08(spark, sf):
    counts = _drain(spark, flows.keyword_counts(_events(spark, sf), "event_time", "page", 60, "10 minutes"), "str08")
    trend = window_delta(counts, 60)
    return trend.select(_plain("window_start"), "keyword", "current_count", "previous_count", "trend_score")


@query(
    "str09_fan_out",
    over(
        "claims_v",
        f"""WITH {CLAIMS_SQL}
            SELECT claim_id, CASE WHEN fraud_score >= 0.7 THEN 'fraud' ELSE 'validated' END AS side FROM clean
            WHERE fraud_score IS NOT NULL""",
    ),
)
def str09(spark, sf):
    root = run_dir(spark, "str09")
    write = streams.fan_out(
        {
            "fraud": lambda b: keyed_json(flows.fraud_side(b), "claim_id"),
            "validated": lambda b: keyed_json(flows.validated_side(b), "claim_id"),
        },
        f"{root}/out",
    )
    streams.start_batches(_claims(spark, sf), write, f"{root}/checkpoint", trigger=None).awaitTermination()
    sides = [
        streams.committed(spark, f"{root}/out", side).select(F.col("key").alias("claim_id"), F.lit(side).alias("side"))
        for side in ("fraud", "validated")
    ]
    return sides[0].unionByName(sides[1])


@query(
    "snk06_claims_and_alerts",
    over(
        "claims_v",
        """SELECT 'claims' AS target, CAST(claim_id AS VARCHAR) AS claim_id, fraud_score, NULL AS severity FROM claims_v
           WHERE claim_amount > 0 AND claim_amount < 1000000
           UNION ALL SELECT 'alerts', CAST(claim_id AS VARCHAR), fraud_score, 'HIGH' FROM claims_v
           WHERE claim_amount > 0 AND claim_amount < 1000000 AND fraud_score >= 0.7""",
    ),
)
def snk06(spark, sf):
    root = run_dir(spark, "snk06")
    messages = replay.claim_messages(t.as_claims(replay.table_stream(spark, sf, "orders")))
    flows.start_claims(messages, f"{root}/out", f"{root}/checkpoint", trigger=None).awaitTermination()
    claims = streams.committed(spark, f"{root}/out", "claims")
    alerts = streams.committed(spark, f"{root}/out", "alerts")
    return claims.select(
        F.lit("claims").alias("target"), "claim_id", "fraud_score", F.lit(None).cast("string").alias("severity")
    ).unionByName(alerts.select(F.lit("alerts").alias("target"), "claim_id", "fraud_score", "severity"))
