"""File sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.session import stage_table


def write_parquet(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace the path's content; partition fact tables by day so that date filters prune files."""
    writer = df.write.mode("overwrite")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def write_csv(df: DataFrame, path: str, single: bool = False) -> None:
    """Headered CSV. ``single`` makes one file, for small results only: one task writes it, many still compute it."""
    out = df.repartition(1) if single else df
    out.write.mode("overwrite").option("header", True).csv(path)


def append_ndjson(df: DataFrame, path: str) -> int:
    """Append records, one JSON text per line, and return how many the store now holds."""
    df.write.mode("append").json(path)
    return df.sparkSession.read.schema(df.schema).json(path).count()


def append_history(df: DataFrame, path: str, run_ts: str) -> None:
    """Keep this run's snapshot in its own partition; repeating a run replaces it."""
    df.write.mode("overwrite").parquet(f"{path}/run_ts={run_ts.replace(':', '-').replace(' ', 'T')}")


def latest_history(df: DataFrame, run_ts: str = "run_ts") -> DataFrame:
    """The rows of the last run."""
    last = df.agg(F.max(run_ts)).scalar()
    return df.filter(F.col(run_ts) == last)


def quarantine(df: DataFrame, reason: str, path: str, run_id: str, ok: str = "OK") -> DataFrame:
    """Write failed rows with their reason aside and return the good ones.

    Each run has its own folder below ``path``, so repeating a run replaces its
    rows. The checked rows are stored once, as both sides read them.
    """
    failed = F.coalesce(F.col(reason), F.lit("unknown")) != ok
    checked = stage_table(df, "checked")
    checked.filter(failed).write.mode("overwrite").parquet(f"{path}/run_id={run_id}")
    return checked.filter(~failed)
