"""Appends to a relational table."""

from __future__ import annotations

from pyspark.sql import DataFrame


def append_options(
    url: str,
    table: str,
    driver: str | None = None,
    user: str | None = None,
    password: str | None = None,
    batch_size: int = 10_000,
    connections: int | None = None,
) -> dict[str, str]:
    """``connections`` bounds how many tasks write at once."""
    options = {"url": url, "dbtable": table, "batchsize": str(batch_size)}
    for name, value in (("driver", driver), ("user", user), ("password", password)):
        if value:
            options[name] = value
    if connections:
        options["numPartitions"] = str(connections)
    return options


def jdbc_append(df: DataFrame, url: str, table: str, **options) -> None:
    df.write.format("jdbc").options(**append_options(url, table, **options)).mode("append").save()
