"""Exact quantiles with linear interpolation, at any number of distinct values."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordinal import running_count


def label_of(p: float) -> str:
    return f"p{round(p * 100):02d}"


def column_quantiles(
    df: DataFrame, columns: list[str], probs: list[float], by: list[str] | None = None, weight: str | None = None
) -> DataFrame:
    """One row per group and column: the groups, ``column``, and ``p25``, ``p50`` ...

    ``weight`` names a column saying how often a row's values occur, for values
    that are already counted. Null values and null groups are ignored; a column
    without values has no row.

    Values are counted, range-sorted and picked by position, all columns in one
    run. A group's values lie in as many sorted pieces as they need, so no task
    holds a whole group.
    """
    by = by or []
    keys = [*by, "column"]
    times = F.col(weight) if weight else F.lit(1).cast("long")
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("_v")) for c in columns])
    present = (
        df.dropna(subset=by)
        .select(*by, times.alias("_c"), F.explode(cells).alias("_cell"))
        .select(*by, "_c", "_cell.column", "_cell._v")
        .filter(F.col("_v").isNotNull())
    )
    counts = present.groupBy(*keys, "_v").agg(F.sum("_c").alias("_c"))
    ranked = running_count(counts, keys, "_v", "_c", "_before")
    # The group's size travels with its last value's end rank.
    sizes = ranked.groupBy(*keys).agg(F.max(F.col("_before") + F.col("_c")).alias("_n"))
    before, end, n = F.col("_before"), F.col("_before") + F.col("_c"), F.col("_n")

    def value_at(position: Column) -> Column:
        return F.max(F.when((before <= position) & (position < end), F.col("_v")))

    picks = []
    for i, p in enumerate(probs):
        place = (n - 1) * F.lit(float(p))
        picks += [
            value_at(F.floor(place)).alias(f"_lo{i}"),
            value_at(F.ceil(place)).alias(f"_hi{i}"),
            F.max(place - F.floor(place)).alias(f"_f{i}"),
        ]
    out = ranked.join(sizes, keys).groupBy(*keys).agg(*picks)
    return out.select(
        *keys,
        *[
            (F.col(f"_lo{i}") + (F.col(f"_hi{i}") - F.col(f"_lo{i}")) * F.col(f"_f{i}")).alias(label_of(p))
            for i, p in enumerate(probs)
        ],
    )


def quantiles(
    df: DataFrame, column: str, probs: list[float], by: list[str] | None = None, weight: str | None = None
) -> DataFrame:
    """One row per group with columns ``p25``, ``p50`` ... of a numeric column."""
    return column_quantiles(df, [column], probs, by, weight).drop("column")


def quantile_structs(df: DataFrame, columns: list[str], probs: list[float]) -> Column:
    """All columns' quantiles as one scalar subquery: a struct of ``p25``, ``p50`` ... for each column."""
    labels = [label_of(p) for p in probs]
    found = column_quantiles(df, columns, probs)
    of = {c: F.max(F.when(F.col("column") == c, F.struct(*labels))).alias(c) for c in columns}
    return found.agg(F.struct(*of.values()).alias("q")).scalar()


def median_of(df: DataFrame, column: str) -> Column:
    """The column's exact median as a scalar subquery."""
    return quantiles(df, column, [0.5]).scalar()
