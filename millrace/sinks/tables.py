"""Table sinks: replace, merge, delete, nest.

Plain files cannot be updated in place and Spark does not overwrite what a query
reads, so merges and deletes produce the next full content; ``switch_table``
writes it beside the old one and then moves the table to it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators.windows import first_per_key
from millrace.session import run_dir


def insert_overwrite_table(df: DataFrame, name: str, fmt: str = "orc", path: str | None = None) -> None:
    """Replace a managed table's rows, creating it on first use."""
    spark = df.sparkSession
    if spark.catalog.tableExists(name):
        df.select(*spark.table(name).columns).write.insertInto(name, overwrite=True)
        return
    writer = df.write.format(fmt)
    (writer.option("path", path) if path else writer).saveAsTable(name)


def switch_table(df: DataFrame, name: str) -> None:
    """Write the next content to a fresh folder, then point the table at it."""
    spark = df.sparkSession
    folder = run_dir(spark, name.replace(".", "_"))
    df.write.parquet(folder)
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, path=folder, source="parquet")


def merge_insert_new(target: DataFrame, batch: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Target plus the batch's first row of each key the target does not have.

    Batch rows without a key cannot be told apart and are left out; set them aside
    first with ``files.quarantine``.
    """
    batch = batch.filter(F.col(key).isNotNull())
    fresh = first_per_key(batch, [key], order).join(target.select(key), key, "left_anti")
    return target.unionByName(fresh.select(*target.columns))


def merge_upsert(target: DataFrame, batch: DataFrame, key: str, order: list[Column]) -> DataFrame:
    """Insert or update: batch rows replace target rows of the same key, column by column.

    A row present in the batch gives all its columns, nulls included. Both sides
    have one row per key, so the outer join cannot meet a hot key. Batch rows
    without a key are left out, as in ``merge_insert_new``; target rows without one
    stay as they are, beside the join.
    """
    unkeyed = target.filter(F.col(key).isNull())
    target = target.filter(F.col(key).isNotNull())
    latest = first_per_key(batch.filter(F.col(key).isNotNull()), [key], order)
    values = [c for c in target.columns if c != key]
    new = latest.select(key, F.lit(True).alias("_new"), *[F.col(c).alias(f"_new_{c}") for c in values])
    merged = target.join(new, key, "full")
    return merged.select(
        *[
            F.col(c) if c == key else F.when(F.col("_new"), F.col(f"_new_{c}")).otherwise(F.col(c)).alias(c)
            for c in target.columns
        ]
    ).unionByName(unkeyed)


def delete_older_than(df: DataFrame, ts: Column, as_of: str, days: int, extra: Column | None = None) -> DataFrame:
    """Rows that stay after a retention delete; an unreadable (null) time is kept."""
    old = ts < F.expr(f"TIMESTAMP_NTZ'{as_of}' - INTERVAL {days} DAYS")
    if extra is not None:
        old = old & extra
    return df.filter(~F.coalesce(old, F.lit(False)))


def delete_by_key(target: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    return target.join(keys.select(key), key, "left_anti")


def nest_families(df: DataFrame, key: str, families: dict[str, dict[str, Column]]) -> DataFrame:
    """Flat rows as a key and one struct per column family."""
    return df.select(
        F.col(key),
        *[F.struct(*[v.alias(n) for n, v in fields.items()]).alias(f) for f, fields in families.items()],
    )


def dimensions(*columns: str, missing: str = "0") -> Column:
    """Sizes as one text such as ``10x20x30``."""
    return F.concat_ws("x", *[F.coalesce(F.col(c).cast("string"), F.lit(missing)) for c in columns])
