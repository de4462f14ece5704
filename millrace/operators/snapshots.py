"""Snapshots stored with a tree of hashes, so that two of them are compared where they differ.

A snapshot holds the distinct rows of its columns in buckets of their hash. Beside
them stand, for each bucket, the number of rows and two sums of hashes, and the same
for branches of BRANCH buckets. A sum does not depend on order or layout, so equal
sets have equal trees, however they were written; different ones agree with a
probability of about 2^-64. A comparison walks down: branches that differ, their
buckets that differ, and only then rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.operators.sets import snapshot_changes

BRANCH = 64
_NUMBERS = ("n", "first", "second")


def store(df: DataFrame, path: str, columns: list[str], buckets: int = 4096) -> None:
    """Write the snapshot; ``buckets`` must be the same for snapshots that are compared."""
    spark = df.sparkSession
    rows = df.select(*columns).distinct()
    rows = rows.withColumn("_bucket", F.pmod(F.xxhash64(*columns), F.lit(buckets)).cast("int"))
    rows.hint("rebalance", F.col("_bucket")).write.partitionBy("_bucket").parquet(f"{path}/rows")
    stored = _rows(spark, path, rows.drop("_bucket").schema)
    wide = "decimal(38,0)"
    # Nulls are told from each other's columns by the second hash, which sees which are null.
    marks = [F.col(c).isNull() for c in columns]
    leaves = stored.groupBy("_bucket").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.xxhash64(*columns).cast("decimal(20,0)")).cast(wide).alias("first"),
        F.sum(F.xxhash64(F.lit(1), *columns, *marks).cast("decimal(20,0)")).cast(wide).alias("second"),
    )
    rows.drop("_bucket").limit(0).write.parquet(f"{path}/schema")
    leaves.withColumn("branch", F.floor(F.col("_bucket") / BRANCH).cast("int")).repartitionByRange("branch").write.partitionBy("branch").parquet(f"{path}/leaves")
    tree = _leaves(spark, path)
    tree.groupBy("branch").agg(F.sum("n").alias("n"), *[F.sum(c).cast(wide).alias(c) for c in _NUMBERS[1:]]).coalesce(1).write.parquet(f"{path}/branches")


_SUMS = "n bigint, first decimal(38,0), second decimal(38,0)"


def _leaves(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(f"_bucket int, {_SUMS}, branch int").parquet(f"{path}/leaves")


def _rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("_bucket", T.IntegerType())])).parquet(f"{path}/rows")


def _differing(new: DataFrame, old: DataFrame, key: str) -> list[int]:
    """Keys whose numbers differ, or that one side lacks."""
    a, b = (df.select(F.col(key), F.struct(*[F.col(c).cast("decimal(38,0)").alias(c) for c in _NUMBERS]).alias(side)) for df, side in ((new, "x"), (old, "y")))
    return sorted(r[0] for r in a.join(b, key, "full").filter(~F.col("x").eqNullSafe(F.col("y"))).select(key).collect())


def differing_buckets(spark: SparkSession, new: str, old: str) -> list[int]:
    """Buckets whose rows differ between two stored snapshots, from their trees alone."""
    branches = _differing(*[spark.read.parquet(f"{path}/branches") for path in (new, old)], "branch")
    if not branches:
        return []
    leaves = [_leaves(spark, path).filter(F.col("branch").isin(branches)) for path in (new, old)]
    return _differing(*leaves, "_bucket")


def changes(spark: SparkSession, new: str, old: str) -> DataFrame:
    """As ``sets.snapshot_changes`` between stored snapshots; rows of equal buckets are not read."""
    some = differing_buckets(spark, new, old)
    schema = spark.read.parquet(f"{new}/schema").schema
    columns = schema.names
    sides = [_rows(spark, path, schema).filter(F.col("_bucket").isin(some) if some else F.lit(False)) for path in (new, old)]
    return snapshot_changes(sides[0].select(*columns), sides[1].select(*columns), columns)


def has_changed(spark: SparkSession, new: str, old: str | None) -> bool:
    """True when there is no history, or the two stored snapshots differ as sets; no row is read."""
    return old is None or bool(differing_buckets(spark, new, old))
