"""Given tables replayed as streams of (key, value) messages, shaped like a topic."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sources import tables as t

_MOMENT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a streaming source with the batch schema, be it one file or a folder of part files."""
    schema = t.table(spark, sf_dir, name).schema
    # A pattern is read like a folder: it matches the one path, and part files below it.
    return spark.readStream.schema(schema).parquet(f"{sf_dir}/{name}.parque[t]")


def _message(df: DataFrame, key: str, fields: list) -> DataFrame:
    return df.select(
        F.col(key).cast("string").cast("binary").alias("key"),
        F.to_json(F.struct(*fields)).cast("binary").alias("value"),
    )


def event_messages(events: DataFrame) -> DataFrame:
    """Event rows as JSON messages with all-text fields."""
    kind = F.when(F.col("event_type") == "signup", "login").otherwise(F.col("event_type"))
    return _message(
        events,
        "user_id",
        [
            F.col("user_id").cast("string").alias("user_id"),
            kind.alias("event_type"),
            F.date_format("ts", _MOMENT).alias("timestamp"),
            F.col("event_id").cast("string").alias("session_id"),
            F.get_json_object("props", "$.k").alias("page"),
        ],
    )


def claim_messages(claims: DataFrame) -> DataFrame:
    """Claim rows as JSON messages."""
    texts = ["claim_id", "patient_id", "hospital_id", "treatment_code"]
    kept = [
        "diagnosis_code", "claim_amount", "approved_amount", "insurance_status", "is_fraud", "fraud_score",
        "status", "insurance_type", "hospital_type",
    ]
    return _message(
        claims,
        "claim_id",
        [
            *[F.col(c).cast("string").alias(c) for c in texts],
            *kept,
            F.date_format("claim_date", _MOMENT).alias("claim_date"),
        ],
    )


def article_messages(articles: DataFrame) -> DataFrame:
    """Article rows as JSON messages."""
    return _message(articles, "id", ["id", "title", "description", "content", "url", "published_at", "source"])
