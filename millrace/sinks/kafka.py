"""Topic sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def keyed_json(df: DataFrame, key: str) -> DataFrame:
    """(key, value): the key column as text and the whole row as JSON."""
    return df.select(F.col(key).cast("string").alias("key"), F.to_json(F.struct("*")).alias("value"))


def to_kafka(df: DataFrame, key: str, servers: str, topic: str, checkpoint: str, trigger: str = "10 seconds") -> StreamingQuery:
    """Stream whole rows to a topic; every query has its own checkpoint."""
    return (
        keyed_json(df, key)
        .writeStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("topic", topic)
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=trigger)
        .start()
    )
