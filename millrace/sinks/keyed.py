"""Stored tables laid out by buckets of their key: merges and deletes rewrite only the buckets they touch.

A row's bucket is a hash of its key, so all rows a batch can change lie in the
batch's own buckets. These are found first; only their partitions are read and
rewritten, and a bucket that no row of the batch changes keeps its files. What
reaches the driver is a list of buckets, whose number is fixed when the table is
made: choose it so that a bucket is some hundred megabytes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.operators import projections
from millrace.operators.windows import first_per_key
from millrace.session import stage_table
from millrace.sinks import partitioned
from millrace.sinks import tables as sink

BUCKET = "_bucket"


def create(df: DataFrame, name: str, key: str, buckets: int = 64) -> None:
    """A new table of ``df`` in buckets of ``key``. Rows without a key share a bucket and are never matched."""
    bucketed = df.withColumn(BUCKET, _bucket(F.col(key), buckets))
    partitioned.create(bucketed, name, BUCKET, {"key": key, "buckets": str(buckets), "type": df.schema[key].dataType.simpleString()})


def read(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name).drop(BUCKET)


def lookup(spark: SparkSession, name: str, values: list) -> DataFrame:
    """The rows of some keys; only their buckets are read."""
    key, buckets, kind = _layout(spark, name)
    wanted = spark.createDataFrame([(v,) for v in values], f"k {kind}")
    where = [r[0] for r in wanted.select(_bucket(F.col("k"), buckets)).distinct().collect()]
    return _of(spark, name, where).filter(F.col(key).isin(values)).drop(BUCKET)


def upsert(spark: SparkSession, name: str, batch: DataFrame, order: list[Column]) -> list[int]:
    """Insert or update by whole rows, as ``merge_upsert``; returns the buckets rewritten.

    A batch row that equals the stored one changes nothing and touches no bucket.
    """
    key, buckets, kind = _layout(spark, name)
    batch = first_per_key(_typed(batch, key, kind).filter(F.col(key).isNotNull()), [key], order)
    batch = stage_table(batch.withColumn(BUCKET, _bucket(F.col(key), buckets)), "batch")
    columns = read(spark, name).columns
    target = _of(spark, name, _buckets(batch))
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in columns]
    changed = batch.alias("a").join(target.alias("b"), [F.col(f"a.{BUCKET}") == F.col(f"b.{BUCKET}"), *same], "left_anti")
    touched = _buckets(changed)
    if touched:
        merged = sink.merge_upsert(
            _of(spark, name, touched).drop(BUCKET), batch.filter(F.col(BUCKET).isin(touched)).select(*columns), key, [F.col(key).asc()]
        )
        _write(spark, name, touched, merged, key, buckets)
    return touched


def insert_new(spark: SparkSession, name: str, batch: DataFrame, order: list[Column]) -> int:
    """Add the batch's first row of each key the table does not have; returns how many.

    Rows are only added, so no stored file is rewritten; the keys of the batch's
    buckets are all that is read.
    """
    key, buckets, kind = _layout(spark, name)
    batch = first_per_key(_typed(batch, key, kind).filter(F.col(key).isNotNull()), [key], order)
    batch = stage_table(batch.withColumn(BUCKET, _bucket(F.col(key), buckets)), "batch")
    known = _of(spark, name, _buckets(batch)).select(BUCKET, key)
    fresh = stage_table(batch.join(known, [BUCKET, key], "left_anti").select(*spark.table(name).columns), "fresh")
    n = fresh.count()
    if n:
        fresh.hint("rebalance", F.col(BUCKET)).write.insertInto(name)
    return n


def delete(spark: SparkSession, name: str, keys: DataFrame) -> list[int]:
    """Remove the rows of ``keys`` (its column of the table's key); returns the buckets rewritten."""
    key, buckets, kind = _layout(spark, name)
    gone = _typed(keys.select(key), key, kind).filter(F.col(key).isNotNull()).distinct()
    gone = stage_table(gone.withColumn(BUCKET, _bucket(F.col(key), buckets)), "gone")
    held = _of(spark, name, _buckets(gone)).select(BUCKET, key)
    touched = _buckets(held.join(gone, [BUCKET, key], "left_semi"))
    if touched:
        left = sink.delete_by_key(_of(spark, name, touched).drop(BUCKET), gone, key)
        _write(spark, name, touched, left, key, buckets)
    return touched


def update_where(spark: SparkSession, name: str, condition: Column, sets: dict[str, Column]) -> list[int]:
    """Set columns, but not the key, on the rows meeting the condition; returns the buckets rewritten."""
    key, buckets, _ = _layout(spark, name)
    if key in sets:
        raise ValueError(f"{key} places the rows and cannot be set")
    touched = _buckets(spark.table(name).filter(condition))
    if touched:
        done = projections.update_where(_of(spark, name, touched).drop(BUCKET), condition, sets)
        _write(spark, name, touched, done, key, buckets)
    return touched


def partial_update(spark: SparkSession, name: str, updates: DataFrame, touched: str | None = None, now: Column | None = None) -> list[int]:
    """Overwrite the supplied (non-null) fields of matching rows, as in projections; returns the buckets rewritten."""
    key, buckets, kind = _layout(spark, name)
    updates = _typed(updates, key, kind).filter(F.col(key).isNotNull())
    updates = stage_table(updates.withColumn(BUCKET, _bucket(F.col(key), buckets)), "updates")
    held = _of(spark, name, _buckets(updates)).select(BUCKET, key)
    some = _buckets(held.join(updates.select(BUCKET, key), [BUCKET, key], "left_semi"))
    if some:
        mine = updates.filter(F.col(BUCKET).isin(some)).drop(BUCKET)
        done = projections.partial_update(_of(spark, name, some).drop(BUCKET), mine, key, touched, now)
        _write(spark, name, some, done, key, buckets)
    return some


def _bucket(key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")


def _layout(spark: SparkSession, name: str) -> tuple[str, int, str]:
    found = (partitioned.property_of(spark, name, p) for p in ("key", "buckets", "type"))
    key, buckets, kind = found
    return key, int(buckets), kind


def _typed(df: DataFrame, key: str, kind: str) -> DataFrame:
    """The hash of a key depends on its type."""
    return df.withColumn(key, F.col(key).cast(kind))


def _buckets(rows: DataFrame) -> list[int]:
    return sorted(r[0] for r in rows.select(BUCKET).distinct().collect())


def _of(spark: SparkSession, name: str, buckets: list[int]) -> DataFrame:
    return spark.table(name).filter(F.col(BUCKET).isin(buckets) if buckets else F.lit(False))


def _write(spark: SparkSession, name: str, touched: list[int], rows: DataFrame, key: str, buckets: int) -> None:
    bucketed = rows.withColumn(BUCKET, _bucket(F.col(key), buckets)).select(*spark.table(name).columns)
    partitioned.replace(spark, name, BUCKET, touched, bucketed)
