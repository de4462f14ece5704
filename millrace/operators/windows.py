"""Ranking and window-to-window operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def percent_of_total(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    """Rows per group and their share of all rows, in percent with two decimals."""
    total = df.agg(F.count(F.lit(1))).scalar()
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias(name))
        .withColumn("percentage", F.round(F.col(name) * 100.0 / total, 2))
    )


def top_n_per_group(df: DataFrame, keys: list[str], order: list[Column], n: int, rank: str | None = None) -> DataFrame:
    """The first ``n`` rows of each group in a total order.

    Spark limits each group before the shuffle as well (window group limit), so
    a hot group sends at most ``n`` rows per input task.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    name = rank or "_rank"
    out = df.withColumn(name, F.row_number().over(window)).filter(F.col(name) <= n)
    return out if rank else out.drop(name)


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """DISTINCT ON (keys) with a stated order."""
    return top_n_per_group(df, keys, order, 1)


def interleave(df: DataFrame, source: str, order: list[Column], keep: int) -> DataFrame:
    """Round-robin over sources: first row of each source, then the second of each, and so on.

    A source can contribute at most ``keep`` rows, so ranking stops there.
    """
    ranked = top_n_per_group(df, [source], order, keep, rank="turn")
    return ranked.orderBy("turn", source).limit(keep)


def window_counts(df: DataFrame, ts: str, item: str, minutes: int) -> DataFrame:
    """Occurrences of each item per fixed window."""
    return (
        df.groupBy(F.window(ts, f"{minutes} minutes").alias("w"), F.col(item).alias("keyword"))
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), "keyword", "n")
    )


def window_delta(counts: DataFrame, minutes: int, keys: list[str] = ["keyword"]) -> DataFrame:
    """Count now minus count in the window before, for items present in either.

    Each count is entered once as current and once, one window later, as
    previous; a single grouped sum then pairs them, with 0 where one is absent.
    """
    later = F.col("window_start") + F.expr(f"INTERVAL {minutes} MINUTES")
    both = counts.select(
        *keys,
        F.explode(
            F.array(
                F.struct(F.col("window_start").alias("at"), F.col("n").alias("cur"), F.lit(0).cast("long").alias("prev")),
                F.struct(later.alias("at"), F.lit(0).cast("long").alias("cur"), F.col("n").alias("prev")),
            )
        ).alias("e"),
    )
    return (
        both.groupBy(F.col("e.at").alias("window_start"), *keys)
        .agg(F.sum("e.cur").alias("current_count"), F.sum("e.prev").alias("previous_count"))
        .withColumn("trend_score", F.col("current_count") - F.col("previous_count"))
    )
