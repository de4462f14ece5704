"""Market price series: cleaning and the three chart views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.functions.dates import month_start
from millrace.operators.aggregates import box_stats, histogram
from millrace.operators.filters import filter_eq, filter_in


def raw_prices(lineitem: DataFrame) -> DataFrame:
    """Item lines as a raw price table: year and month apart, prices as text, some blanks."""
    return lineitem.select(
        F.when(F.col("l_suppkey") % 9 != 0, F.concat(F.lit("S"), F.col("l_suppkey"))).alias("region"),
        F.col("l_returnflag").alias("market"),
        F.col("l_linestatus").alias("commodity"),
        F.year("l_shipdate").alias("year"),
        F.month("l_shipdate").alias("month"),
        F.when(F.col("l_linenumber") != 6, F.col("l_extendedprice").cast("string")).alias("price"),
        F.lit(None).cast("string").alias("commodity_source"),
    )


def clean(raw: DataFrame) -> DataFrame:
    """Drop the unused column, name missing regions, type the price, build the month, drop unpriced rows."""
    return (
        raw.drop("commodity_source")
        .fillna({"region": "Unknown"})
        .withColumn("price", F.col("price").cast("double"))
        .withColumn("date", month_start(F.col("year"), F.col("month")))
        .filter(F.col("price").isNotNull())
    )


def selected(df: DataFrame, commodity: str, markets: list[str]) -> DataFrame:
    return filter_in(filter_eq(df, "commodity", commodity), market=markets)


def series(df: DataFrame) -> DataFrame:
    """Mean price and number of quotes per market and month."""
    return df.groupBy("market", "date").agg(
        F.count(F.lit(1)).alias("n"),
        (F.round(F.sum("price"), 2) / F.count(F.lit(1))).alias("mean_price"),
    )


def boxes(df: DataFrame) -> DataFrame:
    return box_stats(df, "price", ["market"])


def price_histogram(df: DataFrame, bins: int = 30) -> DataFrame:
    return histogram(df, "price", bins)
