"""Grouped and global aggregates. All of them combine map-side before shuffling."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.quantiles import quantiles


def group_count(df: DataFrame, keys: list[str], name: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def conditional_counts(df: DataFrame, keys: list[str], conditions: dict[str, Column], total: str | None = None) -> DataFrame:
    """Per group, how many rows meet each condition."""
    aggs = [F.count_if(c).alias(n) for n, c in conditions.items()]
    if total:
        aggs.insert(0, F.count(F.lit(1)).alias(total))
    return df.groupBy(*keys).agg(*aggs)


def summarise(df: DataFrame, keys: list[str], **aggs: Column) -> DataFrame:
    """Grouped aggregate with named results; no keys gives the one-row table."""
    named = [expr.alias(name) for name, expr in aggs.items()]
    return df.groupBy(*keys).agg(*named)


def having(df: DataFrame, keys: list[str], condition: Column, **aggs: Column) -> DataFrame:
    """Groups whose aggregates meet the condition."""
    return summarise(df, keys, **aggs).filter(condition)


AGGREGATES = {
    "sum": F.sum,
    "mean": F.avg,
    "avg": F.avg,
    "min": F.min,
    "max": F.max,
    "count": F.count,
    "std": F.stddev_samp,
    "nunique": F.count_distinct,
}


def agg_map(df: DataFrame, keys: list[str], spec: dict[str, str | list[str]]) -> DataFrame:
    """Per-column aggregates by name, e.g. ``{"sales": "sum", "profit": ["max", "mean"]}``."""
    out = []
    for column, names in spec.items():
        for name in [names] if isinstance(names, str) else names:
            out.append(AGGREGATES[name](column).alias(f"{column}_{name}"))
    return df.groupBy(*keys).agg(*out)


def mean_ratio(df: DataFrame, keys: list[str], numerator: str, denominator: str, name: str) -> DataFrame:
    """Mean of per-row ratios over rows with a positive denominator."""
    return (
        df.filter(F.col(denominator) > 0)
        .groupBy(*keys)
        .agg(F.avg(F.col(numerator) / F.col(denominator)).alias(name))
    )


def revenue_by_key(lines: DataFrame, key: str, price: str, freight: str) -> DataFrame:
    """Total and line count per key from raw text columns; rows that do not parse are skipped."""
    parsed = lines.select(
        F.col(key),
        F.expr(f"try_cast({price} AS DOUBLE)").alias("_p"),
        F.expr(f"try_cast({freight} AS DOUBLE)").alias("_f"),
    ).filter(F.col("_p").isNotNull() & F.col("_f").isNotNull())
    return parsed.groupBy(key).agg(
        F.round(F.sum(F.col("_p") + F.col("_f")), 2).alias("total_sales"),
        F.count(F.lit(1)).alias("order_count"),
    )


def pivot_sum(df: DataFrame, rows: list[str], column: str, values: list, value: str) -> DataFrame:
    """Pivot table of sums with 0 where a cell has no rows. Values are listed, so no extra scan."""
    return df.groupBy(*rows).pivot(column, values).agg(F.sum(value)).fillna(0)


def dispersion(df: DataFrame, keys: list[str], column: str) -> DataFrame:
    return df.groupBy(*keys).agg(
        F.count(column).alias("n"),
        F.avg(column).alias("mean"),
        F.stddev_samp(column).alias("std"),
    )


def mode_value(df: DataFrame, column: str) -> DataFrame:
    """The most frequent non-null value, the smallest one on a tie."""
    return (
        df.filter(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc(column))
        .limit(1)
    )


def histogram(df: DataFrame, column: str, bins: int) -> DataFrame:
    """Counts in equal-width bins between the minimum and maximum; the last bin is closed.

    The bounds are a scalar subquery, so the rows are only scanned and counted.
    Empty bins are reported with 0.
    """
    present = df.filter(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("_v"))
    bounds = present.agg(F.struct(F.min("_v").alias("lo"), F.max("_v").alias("hi")).alias("b"))
    spread = present.withColumn("_b", bounds.scalar())
    lo, hi = F.col("_b.lo"), F.col("_b.hi")
    width = (hi - lo) / bins
    slot = F.when(hi == lo, F.lit(0)).otherwise(
        F.least(F.floor((F.col("_v") - lo) / width).cast("int"), F.lit(bins - 1))
    )
    counted = spread.groupBy(slot.alias("bin")).agg(F.count(F.lit(1)).alias("_n"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    edges = every.withColumn("_b", bounds.scalar())
    return edges.join(counted, "bin", "left").select(
        "bin",
        (lo + F.col("bin") * width).alias("bin_from"),
        (lo + (F.col("bin") + 1) * width).alias("bin_to"),
        F.coalesce(F.col("_n"), F.lit(0)).alias("n"),
    )


def box_stats(df: DataFrame, column: str, by: list[str]) -> DataFrame:
    """Five-number summary per group, with whiskers at the last points inside the 1.5 IQR fences."""
    value = F.col(column)
    present = df.filter(value.isNotNull()).select(*by, column)
    fences = quantiles(present, column, [0.25, 0.5, 0.75], by).withColumns(
        {
            "_low": F.col("p25") - 1.5 * (F.col("p75") - F.col("p25")),
            "_high": F.col("p75") + 1.5 * (F.col("p75") - F.col("p25")),
        }
    )
    # One row for each group: Spark broadcasts it if it is small and splits hot groups if not.
    joined = present.join(fences, by)
    inside = (value >= F.col("_low")) & (value <= F.col("_high"))
    spread = joined.groupBy(*by, "p25", "p50", "p75").agg(
        F.min(value).alias("min"),
        F.max(value).alias("max"),
        F.min(F.when(inside, value)).alias("whisker_low"),
        F.max(F.when(inside, value)).alias("whisker_high"),
        F.count_if(~inside).alias("outliers"),
    )
    return spread.select(
        *by, "min", "whisker_low", "p25", "p50", "p75", "whisker_high", "max", "outliers"
    )


SHIFT_ROWS = 1_000  # rows whose mean is taken off before squares are summed


def correlations(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pairwise Pearson correlation as (column_a, column_b, r), from one pass over the rows.

    Each task multiplies matrices of its rows: values, squares and which are
    present, so that a pair counts the rows in which both are (NaN counts as
    missing). Tasks send six sums for each pair, which Spark adds up. Correlation
    does not change with a shift, so values near their column's mean are summed:
    the mean of up to SHIFT_ROWS rows, whichever they are, keeps the sums exact
    enough. A pair without two different values on each side has no r.
    """
    width = len(columns)
    values = F.array(*[F.col(c).cast("double") for c in columns]).alias("v")
    some = df.select(*columns).limit(SHIFT_ROWS).agg(*[F.avg(F.nanvl(F.col(c).cast("double"), F.lit(None))).alias(f"m{i}") for i, c in enumerate(columns)]).first()
    shift = np.array([0.0 if m is None else m for m in some])
    x, y = np.triu_indices(width, 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((6, len(x)))
        for batch in batches:
            v = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, width) - shift
            there = ~np.isnan(v)
            v, there = np.where(there, v, 0.0), there.astype(float)
            both, once, squares = there.T @ there, v.T @ there, (v * v).T @ there
            sums += np.stack([both[x, y], once[x, y], once[y, x], squares[x, y], squares[y, x], (v.T @ v)[x, y]])
        kind = pa.list_(pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array([row], kind) for row in sums], list("nabcdp"))

    parts = df.select(values).mapInArrow(run, ", ".join(f"{c} array<double>" for c in "nabcdp"))
    nothing = df.sparkSession.range(1).select(*[F.array_repeat(F.lit(0.0), len(x)).alias(c) for c in "nabcdp"])  # so that every pair has a row
    cells = parts.unionByName(nothing).select(F.posexplode(F.arrays_zip(*"nabcdp")).alias("at", "s")).groupBy("at").agg(*[F.sum(f"s.{c}").alias(c) for c in "nabcdp"])
    n, a, b, c, d, p = (F.col(i) for i in "nabcdp")
    spread_a, spread_b = n * c - a * a, n * d - b * b
    # What is left of a constant column is rounding, far below its squares.
    flat = (n < 2) | (spread_a <= 1e-14 * n * c) | (spread_b <= 1e-14 * n * d)
    r = F.when(~flat, F.greatest(F.lit(-1.0), F.least(F.lit(1.0), (n * p - a * b) / F.sqrt(spread_a) / F.sqrt(spread_b))))
    names = F.array(*[F.lit(c) for c in columns])
    first, second = (F.array(*[F.lit(int(i)) for i in side]) for side in (x, y))
    pairs = cells.select(F.get(names, F.get(first, F.col("at"))).alias("column_a"), F.get(names, F.get(second, F.col("at"))).alias("column_b"), r.alias("r"))
    own = df.sparkSession.createDataFrame([(c, c, 1.0) for c in columns], "column_a string, column_b string, r double")
    return pairs.unionByName(own) if len(x) else own


def group_rate(df: DataFrame, keys: list[str], flag: str, name: str) -> DataFrame:
    """Mean of a 0/1 (or numeric) column per group."""
    return df.groupBy(*keys).agg(F.avg(F.col(flag).cast("double")).alias(name))


def unnest_count(df: DataFrame, array: str, name: str = "keyword", longer_than: int = 2) -> DataFrame:
    """Frequency of array elements that are non-empty and longer than a length."""
    return (
        df.select(F.explode_outer(array).alias(name))
        .filter((F.col(name) != "") & (F.length(name) > longer_than))
        .groupBy(name)
        .agg(F.count(F.lit(1)).alias("n"))
    )
