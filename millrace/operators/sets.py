"""Set operations and change detection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.windows import first_per_key


def union_all(*frames: DataFrame) -> DataFrame:
    """Row-wise concatenation by column name; missing columns become null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def distinct_sorted(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct().orderBy(column)


def drop_duplicate_rows(df: DataFrame) -> DataFrame:
    return df.distinct()


def duplicate_count(df: DataFrame) -> DataFrame:
    """How many rows are copies of an earlier row, and how many distinct rows there are."""
    groups = df.groupBy(*df.columns).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(
        F.coalesce(F.sum("_n"), F.lit(0)).alias("rows"),
        F.count(F.lit(1)).alias("distinct_rows"),
        F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("duplicates"),
    )


def new_by_key(batch: DataFrame, key: str, order: list[Column], seen: DataFrame | None = None) -> DataFrame:
    """First row of each non-blank key that is not among the seen keys.

    Copies are reduced to one row before the join with the seen keys, so a key
    with many copies is a single row in it.
    """
    usable = batch.filter(F.col(key).isNotNull() & (F.col(key) != ""))
    first = first_per_key(usable, [key], order)
    return first if seen is None else first.join(seen.select(key).distinct(), key, "left_anti")


def snapshot_changes(new: DataFrame, old: DataFrame, columns: list[str]) -> DataFrame:
    """Rows (by ``columns`` only) found in just one of two snapshots, marked added or removed.

    One grouped pass over both; an empty result means no change.
    """
    marked = new.select(*columns, F.lit(1).alias("_new"), F.lit(0).alias("_old")).unionByName(
        old.select(*columns, F.lit(0).alias("_new"), F.lit(1).alias("_old"))
    )
    sides = marked.groupBy(*columns).agg(F.max("_new").alias("_new"), F.max("_old").alias("_old"))
    return sides.filter(F.col("_new") != F.col("_old")).select(
        *columns, F.when(F.col("_new") == 1, "added").otherwise("removed").alias("change")
    )


def has_changed(new: DataFrame, old: DataFrame | None, columns: list[str]) -> bool:
    """True when there is no history, or the two snapshots differ as sets."""
    return old is None or not snapshot_changes(new, old, columns).isEmpty()
