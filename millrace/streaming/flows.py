"""Streaming flows: activity counts, claims, articles and keyword trends.

Each flow is a plain DataFrame function, so the same code runs on a topic, on a
file replay or on a batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from millrace.operators.projections import expand_json
from millrace.plans import claims as claim_plans
from millrace.plans import news
from millrace.schemas import ARTICLE_SCHEMA, CLAIM_SCHEMA, EVENT_SCHEMA
from millrace.session import LARGE_STATE, settings
from millrace.sinks import streams


def parse_events(messages: DataFrame) -> DataFrame:
    return (
        expand_json(messages, "value", EVENT_SCHEMA)
        .withColumn("event_time", F.to_timestamp("timestamp"))
        .filter(F.col("user_id").isNotNull())
    )


def activity_counts(events: DataFrame, window: str = "10 seconds", lateness: str = "10 seconds") -> DataFrame:
    """Events per window, user and type; a window is emitted once the watermark passes its end."""
    return (
        events.withWatermark("event_time", lateness)
        .groupBy(F.window("event_time", window).alias("w"), "user_id", "event_type")
        .agg(F.count(F.lit(1)).alias("event_count"))
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "user_id",
            "event_type",
            "event_count",
        )
    )


def purchases(events: DataFrame) -> DataFrame:
    return events.filter(F.col("event_type") == "purchase")


def clean_claims(messages: DataFrame, ceiling: float = claim_plans.MAX_AMOUNT) -> DataFrame:
    """Parse, validate and enrich claim messages."""
    parsed = expand_json(messages, "value", CLAIM_SCHEMA)
    enriched = claim_plans.enrich_claims(claim_plans.valid_claims(parsed, ceiling))
    return enriched.withColumn("processed_at", F.current_timestamp())


def clean_article_messages(messages: DataFrame) -> DataFrame:
    parsed = expand_json(messages, "value", ARTICLE_SCHEMA)
    return news.clean_articles(parsed).withColumn("processed_at", F.current_timestamp())


def first_seen(rows: DataFrame, key: str, ts: str, lateness: str) -> DataFrame:
    """Rows whose non-blank key has not come within the lateness before; state stays bounded by it."""
    return (
        rows.filter(F.col(key).isNotNull() & (F.col(key) != ""))
        .withWatermark(ts, lateness)
        .dropDuplicatesWithinWatermark([key])
    )


def new_keys(rows: DataFrame, key: str) -> DataFrame:
    """Rows whose non-blank key has never come before; nothing expires, so the state holds every key."""
    return rows.filter(F.col(key).isNotNull() & (F.col(key) != "")).dropDuplicates([key])


def start_new_keys(rows: DataFrame, key: str, path: str, checkpoint: str, trigger: str | None = "10 seconds") -> StreamingQuery:
    """Write each non-blank key once, whenever it comes again.

    Keys seen are state by hash of the key, kept in RocksDB beside the executors and
    in the checkpoint. A batch looks up and stores its own keys only, so its work
    follows its size and not the number of batches or keys before it.
    """
    with settings(rows.sparkSession, LARGE_STATE):
        return streams.start(new_keys(rows, key), path, checkpoint, trigger)


def keyword_counts(rows: DataFrame, ts: str, keyword: str, minutes: int, lateness: str) -> DataFrame:
    """Occurrences per fixed window and keyword, emitted when the window closes."""
    return (
        rows.withWatermark(ts, lateness)
        .groupBy(F.window(ts, f"{minutes} minutes").alias("w"), F.col(keyword).alias("keyword"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), "keyword", "n")
    )


CLAIM_COLUMNS = [
    "claim_id", "patient_id", "hospital_id", "treatment_code", "diagnosis_code", "claim_amount",
    "approved_amount", "insurance_status", "is_fraud", "fraud_score", "status",
]


# The texts that readers of the alerts table look for.
ALERT_REASON = "Fraud score exceeded threshold in Spark job"
ALERT_TYPE = "ML_DETECTED"


def claim_rows(batch: DataFrame) -> DataFrame:
    """The claims table's columns."""
    return batch.select(*CLAIM_COLUMNS, F.col("claim_date_ts").alias("claim_date"))


def claim_alerts(batch: DataFrame, threshold: float = claim_plans.FRAUD_THRESHOLD) -> DataFrame:
    """An alert for each claim at or above the threshold."""
    return batch.filter(F.col("fraud_score") >= threshold).select(
        "claim_id",
        "patient_id",
        "hospital_id",
        "fraud_score",
        F.lit(ALERT_REASON).alias("alert_reason"),
        F.lit(ALERT_TYPE).alias("alert_type"),
        F.col("risk_flag").alias("severity"),
    )


def fraud_side(rows: DataFrame, threshold: float = claim_plans.FRAUD_THRESHOLD) -> DataFrame:
    return rows.filter(F.col("fraud_score") >= threshold)


def validated_side(rows: DataFrame, threshold: float = claim_plans.FRAUD_THRESHOLD) -> DataFrame:
    """Below the threshold; a row without a score is on neither side."""
    return rows.filter(F.col("fraud_score") < threshold)


def start_activity(messages: DataFrame, path: str, checkpoint: str, trigger: str | None = "10 seconds") -> list[StreamingQuery]:
    """Counts and purchases as two queries over one parsed stream, each with its own checkpoint."""
    events = parse_events(messages)
    return [
        streams.start(activity_counts(events), f"{path}/counts", f"{checkpoint}/counts", trigger),
        streams.start(purchases(events), f"{path}/purchases", f"{checkpoint}/purchases", trigger),
    ]


def start_claims(messages: DataFrame, path: str, checkpoint: str, trigger: str | None = "10 seconds") -> StreamingQuery:
    """Claims and alerts tables from one micro-batch stream."""
    write = streams.fan_out({"claims": claim_rows, "alerts": claim_alerts}, path)
    return streams.start_batches(clean_claims(messages), write, checkpoint, trigger)
