"""Stored tables by day (or month): retention forgets whole ones and rewrites only those that keep some rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.sinks import partitioned
from millrace.sinks import tables as sink

DAY = "_day"


def create(df: DataFrame, name: str, ts: Column, unit: str = "day") -> None:
    """A new table of ``df`` in partitions by the day of ``ts``, or by the first day of its ``unit``; rows without a time share one."""
    partitioned.create(df.withColumn(DAY, F.date_trunc(unit, ts).cast("date")), name, DAY, {"unit": unit})


def read(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name).drop(DAY)


def delete_older_than(spark: SparkSession, name: str, ts: Column, as_of: str, days: int, extra: Column | None = None) -> dict[str, list[str]]:
    """Retention as in ``tables.delete_older_than``; returns the days dropped and rewritten.

    ``ts`` is the time that ``create`` was given. Days before the limit go without
    being read; with an ``extra`` condition their rows are counted first, and a day
    of which nothing goes is left alone. Only the rest, and the day of the limit,
    are rewritten.
    """
    at = F.expr(f"TIMESTAMP_NTZ'{as_of}' - INTERVAL {days} DAYS")
    unit = partitioned.property_of(spark, name, "unit")
    limit, last = spark.range(1).select(at.cast("string"), F.date_trunc(unit, at).cast("date").cast("string")).first()
    old = sorted(d for d in partitioned.partitions(spark, name) if d is not None and d <= last)
    reach = old if extra is not None else [d for d in old if d == last]
    goes = F.coalesce((ts < F.lit(limit).cast("timestamp_ntz")) & (F.lit(True) if extra is None else extra), F.lit(False))
    some = spark.table(name).filter(F.col(DAY).isin([F.lit(d).cast("date") for d in reach]) if reach else F.lit(False))
    counts = some.groupBy(F.col(DAY).cast("string").alias("day")).agg(F.count_if(goes).alias("go"), F.count(F.lit(1)).alias("n")).collect()
    dropped = [d for d in old if d not in reach] + [r["day"] for r in counts if r["go"] == r["n"]]
    rewritten = sorted(r["day"] for r in counts if 0 < r["go"] < r["n"])
    if rewritten:
        kept = spark.table(name).filter(F.col(DAY).isin([F.lit(d).cast("date") for d in rewritten]))
        partitioned.replace(spark, name, DAY, rewritten, sink.delete_older_than(kept, ts, as_of, days, extra))
    partitioned.drop(spark, name, DAY, sorted(dropped))
    return {"dropped": sorted(dropped), "rewritten": rewritten}
