"""Topic scans. The connector package must be on the cluster's classpath."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def batch_options(servers: str, topic: str, start: str = "earliest", end: str = "latest") -> dict[str, str]:
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
        "endingOffsets": end,
    }


def stream_options(
    servers: str,
    topic: str,
    start: str = "latest",
    fail_on_data_loss: bool = False,
    min_partitions: int | None = None,
    max_per_trigger: int | None = None,
) -> dict[str, str]:
    """``min_partitions`` splits large topic partitions; ``max_per_trigger`` bounds a micro-batch."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
        "failOnDataLoss": str(fail_on_data_loss).lower(),
    }
    if min_partitions:
        options["minPartitions"] = str(min_partitions)
    if max_per_trigger:
        options["maxOffsetsPerTrigger"] = str(max_per_trigger)
    return options


def kafka_batch(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Bounded replay of a topic as (key, value, ...)."""
    return spark.read.format("kafka").options(**batch_options(servers, topic, **options)).load()


def kafka_stream(spark: SparkSession, servers: str, topic: str, **options) -> DataFrame:
    """Unbounded scan of a topic as (key, value, ...)."""
    return spark.readStream.format("kafka").options(**stream_options(servers, topic, **options)).load()
