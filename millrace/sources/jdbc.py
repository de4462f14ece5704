"""Relational table scans."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_options(
    url: str,
    table: str,
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
    partition: tuple[str, str, str, int] | None = None,
    fetch_size: int = 10_000,
) -> dict[str, str]:
    """``partition`` is (column, lower, upper, tasks); without it one task reads the whole table."""
    options = {"url": url, "dbtable": table, "fetchsize": str(fetch_size)}
    for name, value in (("driver", driver), ("user", user), ("password", password)):
        if value:
            options[name] = value
    if partition:
        column, lower, upper, tasks = partition
        options |= {
            "partitionColumn": column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(tasks),
        }
    return options


def jdbc_table(spark: SparkSession, url: str, table: str, **options) -> DataFrame:
    """The table; filters on bare columns above it are pushed to the database."""
    return spark.read.format("jdbc").options(**read_options(url, table, **options)).load()
