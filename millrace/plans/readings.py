"""Daily reports over nested readings: records with parallel arrays of times and values."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def zipped(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per reading from the parallel arrays; a missing value stays null."""
    pairs = F.arrays_zip(F.col("hourly.time").alias("time"), F.col("hourly.value").alias("value"))
    return df.select(*keys, F.explode(pairs).alias("r")).select(*keys, "r.time", "r.value")


def report(df: DataFrame, decimals: int | None = 2) -> DataFrame:
    """Statistics of each record, computed inside its row: no explode, no shuffle.

    Null readings are left out; a record without any reading is dropped.
    """
    with_valid = df.withColumns(
        {
            "_valid": F.filter("hourly.value", lambda v: v.isNotNull()),
            "readings": F.arrays_zip(F.col("hourly.time").alias("time"), F.col("hourly.value").alias("value")),
            "date": F.substring(F.get("hourly.time", 0).cast("string"), 1, 10),
        }
    ).filter(F.size("_valid") > 0)
    total = F.round(F.aggregate("_valid", F.lit(0.0), lambda a, v: a + v), 2)
    mean = total / F.size("_valid")
    return with_valid.withColumns(
        {
            "min_value": F.round(F.array_min("_valid"), 2),
            "max_value": F.round(F.array_max("_valid"), 2),
            "avg_value": mean if decimals is None else F.round(mean, decimals),
            "total_readings": F.size("_valid").cast("long"),
        }
    ).drop("_valid", "hourly")


def as_records(events: DataFrame, size: int = 24) -> DataFrame:
    """Events as nested records of at most ``size`` readings, ordered by time.

    A record covers one user and ``size`` consecutive event ids, so no group can
    grow beyond that. Some readings are missing.
    """
    reading = F.when(F.col("event_id") % 7 != 0, F.col("value"))
    return (
        events.groupBy("user_id", F.floor(F.col("event_id") / size).alias("record"))
        .agg(F.sort_array(F.collect_list(F.struct(F.col("ts"), F.col("event_id"), reading.alias("v")))).alias("rows"))
        .select(
            "user_id",
            "record",
            F.struct(
                F.transform("rows", lambda r: r["ts"]).alias("time"),
                F.transform("rows", lambda r: r["v"]).alias("value"),
            ).alias("hourly"),
        )
    )
