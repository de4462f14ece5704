"""Row positions in a stated order, without passing the rows through one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import stage_table

_LOW_BITS = (1 << 33) - 1  # monotonically_increasing_id: partition number above bit 33


def _laid_out(df: DataFrame, order_by: list[str], label: str) -> DataFrame:
    """Range-sorted rows with their partition number and place in it, staged once."""
    ids = F.col("_row_id")
    return (
        stage_table(
            df.repartitionByRange(*order_by)
            .sortWithinPartitions(*order_by)
            .withColumn("_row_id", F.monotonically_increasing_id()),
            label,
        )
        .withColumn("_part", F.shiftright(ids, 33))
        .withColumn("_place", ids.bitwiseAND(F.lit(_LOW_BITS)))
        .drop("_row_id")
    )


def with_ordinal(df: DataFrame, order_by: list[str], name: str = "ordinal") -> DataFrame:
    """Number rows 1..n by ``order_by``, which must be a total order.

    Rows are range-partitioned and numbered within their partition; the offset
    of each partition is a running sum over one row per partition, which is
    small whatever the data size.
    """
    laid = _laid_out(df, order_by, "ordinal")
    sizes = laid.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (
        laid.join(F.broadcast(offsets), "_part")
        .withColumn(name, F.col("_offset") + F.col("_place") + 1)
        .drop("_part", "_place", "_offset")
    )


def running_count(df: DataFrame, by: list[str], order_by: str, weight: str, name: str) -> DataFrame:
    """Per group, the sum of ``weight`` over the rows before each row in ``order_by`` order.

    (``by``, ``order_by``) must be unique. A group may span many range
    partitions: totals of (partition, group) give each piece its start, and the
    window only ever covers one piece.
    """
    keys = [*by, order_by]
    laid = _laid_out(df, keys, "running").drop("_place")
    pieces = laid.groupBy("_part", *by).agg(F.sum(weight).alias("_w"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select(
        "_part", *by, F.coalesce(F.sum("_w").over(earlier), F.lit(0)).alias("_start")
    )
    within = (
        Window.partitionBy("_part", *by).orderBy(order_by).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        laid.join(starts, ["_part", *by])
        .withColumn(name, F.col("_start") + F.coalesce(F.sum(weight).over(within), F.lit(0)))
        .drop("_part", "_start")
    )
