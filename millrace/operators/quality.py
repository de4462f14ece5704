"""Profiling, missing values, outliers and record validity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.dates import years_since
from millrace.operators.quantiles import column_quantiles, median_of, quantile_structs

NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


def numeric_columns(df: DataFrame) -> list[str]:
    return [c for c, kind in df.dtypes if kind.split("(")[0] in NUMERIC]


def _per_column(row: DataFrame, columns: list[str], name: str) -> DataFrame:
    """A one-row result with a column per input column, turned into (column, value) rows."""
    cells = [F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").alias(name)) for c in columns]
    return row.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def null_counts(df: DataFrame) -> DataFrame:
    """Nulls per column, one pass."""
    row = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return _per_column(row, df.columns, "nulls")


def any_null(df: DataFrame) -> DataFrame:
    """Whether each column holds a null."""
    row = df.agg(*[F.coalesce(F.bool_or(F.col(c).isNull()), F.lit(False)).alias(c) for c in df.columns])
    return _per_column(row, df.columns, "has_null")


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def column_types(df: DataFrame) -> DataFrame:
    return df.sparkSession.createDataFrame(df.dtypes, "column string, type string")


def describe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Count, mean, sample deviation, minimum, exact quartiles and maximum per numeric column.

    One pass sums up all columns, and one run sorts the values of all columns for the quartiles.
    """
    columns = columns or numeric_columns(df)
    row = df.agg(
        *[
            F.struct(
                F.count(c).alias("count"),
                F.avg(c).alias("mean"),
                F.stddev_samp(c).alias("std"),
                F.min(c).cast("double").alias("min"),
                F.max(c).cast("double").alias("max"),
            ).alias(c)
            for c in columns
        ]
    )
    stats = _per_column(row, columns, "s").select("column", "s.*")
    quartiles = column_quantiles(df, columns, [0.25, 0.5, 0.75])
    return stats.join(quartiles, "column", "left").select(
        "column", "count", "mean", "std", "min", "p25", "p50", "p75", "max"
    )


def drop_nulls(df: DataFrame, thresh: int | None = None) -> DataFrame:
    """Rows without nulls, or with at least ``thresh`` non-null values."""
    return df.dropna(how="any") if thresh is None else df.dropna(thresh=thresh)


def fill_constants(df: DataFrame, values: dict, blank_is_null: tuple[str, ...] = ()) -> DataFrame:
    """Fill nulls per column; in ``blank_is_null`` columns an empty text counts as null."""
    if blank_is_null:
        df = df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in blank_is_null})
    return df.fillna(values)


def impute_median(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fill nulls with the column's exact median; all medians come from one run."""
    found = quantile_structs(df, columns, [0.5])
    return df.withColumns({c: F.coalesce(F.col(c).cast("double"), found.getField(c).getField("p50")) for c in columns})


def impute_median_date(df: DataFrame, column: str) -> DataFrame:
    """Fill missing dates with the median date (the middle day, whole days)."""
    days = df.select(F.datediff(F.col(column), F.lit("1970-01-01").cast("date")).alias("d"))
    middle = F.date_add(F.lit("1970-01-01").cast("date"), F.floor(median_of(days, "d")).cast("int"))
    return df.withColumn(column, F.coalesce(F.col(column), middle))


def impute_mode(df: DataFrame, column: str) -> DataFrame:
    """Fill nulls with the most frequent value, the smallest on a tie."""
    from millrace.operators.aggregates import mode_value

    return df.withColumn(column, F.coalesce(F.col(column), mode_value(df, column).select(column).scalar()))


def iqr_fences(df: DataFrame, column: str, k: float = 1.5) -> tuple[Column, Column, Column]:
    """Lower fence, upper fence and median as scalar subqueries of one run."""
    q = quantile_structs(df, [column], [0.25, 0.5, 0.75]).getField(column)
    low, high = q.getField("p25"), q.getField("p75")
    spread = (high - low) * k
    return low - spread, high + spread, q.getField("p50")


def outliers(df: DataFrame, column: str) -> DataFrame:
    """Rows outside the fences."""
    low, high, _ = iqr_fences(df, column)
    return df.filter((F.col(column) < low) | (F.col(column) > high))


def remove_outliers(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows inside the fences, column by column; each fence is taken from the rows still left."""
    for column in columns:
        low, high, _ = iqr_fences(df, column)
        df = df.filter((F.col(column) >= low) & (F.col(column) <= high))
    return df


def outliers_to_median(df: DataFrame, column: str) -> DataFrame:
    low, high, middle = iqr_fences(df, column)
    value = F.col(column)
    return df.withColumn(column, F.when((value < low) | (value > high), middle).otherwise(value))


def winsorise(df: DataFrame, column: str) -> DataFrame:
    """Cap at the fences; nulls stay null."""
    low, high, _ = iqr_fences(df, column)
    value = F.col(column)
    return df.withColumn(
        column, F.when(value > high, high).when(value < low, low).otherwise(value)
    )


def tidy_categories(df: DataFrame, columns: list[str]) -> DataFrame:
    """Trim and title-case category texts."""
    return df.withColumns({c: F.initcap(F.trim(F.col(c))) for c in columns})


def tenure_features(df: DataFrame, since: str, value: str, as_of: str, decimals: int | None = 2) -> DataFrame:
    """Years since a date (one decimal) and the value per year; less than a tenth counts as one year."""
    with_years = df.withColumn("experience", years_since(F.to_date(since), as_of))
    years = F.when(F.col("experience") == 0, F.lit(1.0)).otherwise(F.col("experience"))
    per_year = F.col(value) / years
    return with_years.withColumn(
        "value_per_year", per_year if decimals is None else F.round(per_year, decimals)
    )


def violations(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """How many rows break each rule, from one pass. A rule that is null counts as broken."""
    row = df.agg(*[F.count_if(~F.coalesce(rule, F.lit(False))).alias(n) for n, rule in rules.items()])
    cells = [F.struct(F.lit(n).alias("rule"), F.col(f"`{n}`").alias("violations")) for n in rules]
    return row.select(F.explode(F.array(*cells)).alias("cell")).select("cell.*")


def unique_violations(df: DataFrame, key: list[str], rule: str) -> DataFrame:
    """Rows that repeat an earlier key."""
    groups = df.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))
    return groups.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).alias("violations")).select(
        F.lit(rule).alias("rule"), "violations"
    )


def reference_violations(fact: DataFrame, dimension: DataFrame, key: str, rule: str) -> DataFrame:
    """Fact rows whose key is not in the dimension.

    Keys are counted before the anti join, so a hot key is one row in it.
    """
    keys = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("_n"))
    missing = keys.join(dimension.select(key), key, "left_anti")
    return missing.agg(F.coalesce(F.sum("_n"), F.lit(0)).alias("violations")).select(
        F.lit(rule).alias("rule"), "violations"
    )
