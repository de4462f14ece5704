"""Ordered results and paging."""

from __future__ import annotations

from dataclasses import dataclass
from itertools import accumulate

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.session import run_dir


def top_k(df: DataFrame, order: list[Column], k: int) -> DataFrame:
    """First ``k`` rows of a total order; each task keeps its own ``k`` (no full sort)."""
    return df.orderBy(*order).limit(k)


def full_sort(df: DataFrame, order: list[Column]) -> DataFrame:
    return df.orderBy(*order)


SHALLOW = 10_000  # rows that a task may keep to find a page


def page(df: DataFrame, order: list[Column], number: int, size: int) -> DataFrame:
    """Rows of page ``number`` (from 1) of a total order.

    A page near the front comes from each task's first rows. For one further back
    the rows are laid out by range once and only the ranges that hold it are read;
    to turn several pages, keep what ``paged`` returns.
    """
    if number * size <= SHALLOW:
        return df.orderBy(*order).offset((number - 1) * size).limit(size)
    return paged(df, order).page(number, size)


@dataclass(frozen=True)
class Pages:
    """Rows laid out in ranges of a total order, and how many rows each range has."""

    rows: DataFrame
    columns: list[str]
    parts: list[int]
    starts: list[int]
    total: int

    def page(self, number: int, size: int) -> DataFrame:
        """Rows of page ``number`` (from 1), in order; only the folders of its ranges are read."""
        low, high = (number - 1) * size, min(number * size, self.total)
        ends = [*self.starts, self.total][1:]
        some = [(p, s) for p, s, e in zip(self.parts, self.starts, ends, strict=True) if s < high and e > low]
        if not some:
            return self.rows.filter(F.lit(False)).select(*self.columns)
        start = F.lit(some[0][1])
        for part, at in some[1:]:
            start = F.when(F.col("_part") == part, F.lit(at)).otherwise(start)
        here = self.rows.filter(F.col("_part").isin([p for p, _ in some]))
        # A range's rows are stored in order, so its places also leave out whole row groups.
        if len(some) == 1:
            first = some[0][1]
            return here.filter((F.col("_place") >= low - first) & (F.col("_place") < high - first)).orderBy("_place").select(*self.columns)
        placed = here.withColumn("_at", start + F.col("_place"))
        return placed.filter((F.col("_at") >= low) & (F.col("_at") < high)).orderBy("_at").select(*self.columns)

    def totals(self, size: int) -> tuple[int, int]:
        """Total rows and page count; at least one page even when empty."""
        return self.total, max(1, -(-self.total // size))


def paged(df: DataFrame, order: list[Column], ranges: int | None = None) -> Pages:
    """Lay rows out in ranges of a total order, one folder each, and count the ranges.

    Counts are one number for each range, which is what reaches the driver. Spark
    chooses how many ranges there are, if ``ranges`` does not.
    """
    ids = F.monotonically_increasing_id()
    dealt = df.repartitionByRange(ranges, *order) if ranges else df.repartitionByRange(*order)
    laid = dealt.sortWithinPartitions(*order).withColumn("_id", ids)
    laid = laid.withColumns({"_part": F.shiftright("_id", 33).cast("int"), "_place": F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))}).drop("_id")
    path = run_dir(df.sparkSession, "pages")
    laid.write.partitionBy("_part").parquet(path)
    fields = [f for f in laid.schema.fields if f.name != "_part"]
    rows = df.sparkSession.read.schema(T.StructType([*fields, laid.schema["_part"]])).parquet(path)
    counts = sorted(tuple(r) for r in rows.groupBy("_part").agg(F.count(F.lit(1))).collect())
    starts = list(accumulate((n for _, n in counts), initial=0))
    return Pages(rows, df.columns, [p for p, _ in counts], starts[:-1], starts[-1])


def page_totals(df: DataFrame, size: int) -> DataFrame:
    """Total rows and page count; at least one page even when empty."""
    total = F.count(F.lit(1))
    return df.agg(
        total.alias("total"), F.greatest(F.ceil(total / F.lit(size)), F.lit(1)).alias("pages")
    )


def latest_ascending(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` largest by a unique column, shown smallest first."""
    return df.orderBy(F.desc(column)).limit(n).orderBy(F.asc(column))
