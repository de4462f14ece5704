"""Streaming sinks and triggers."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery


def start(
    df: DataFrame,
    path: str,
    checkpoint: str,
    trigger: str | None = "10 seconds",
    mode: str = "append",
) -> StreamingQuery:
    """Write a stream to Parquet. ``trigger=None`` processes what is there and stops."""
    writer = df.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)).start()


def drain(df: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Process everything available, then read the written table."""
    start(df, path, checkpoint, trigger=None).awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def console_sink(df: DataFrame, checkpoint: str, rows: int = 20, truncate: bool = False, trigger: str | None = "10 seconds") -> StreamingQuery:
    """Print each trigger's output."""
    writer = (
        df.writeStream.format("console")
        .outputMode("append")
        .option("numRows", rows)
        .option("truncate", truncate)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)).start()


COMMITS = "commits"


def fan_out(outputs: dict[str, Callable[[DataFrame], DataFrame]], path: str) -> Callable[[DataFrame, int], None]:
    """A micro-batch function that writes several tables derived from one batch, visible together.

    Each batch owns a folder per table. Its commit marker is written after all of
    them, and ``committed`` shows no batch without one, so a crash between two
    tables leaves nothing half readable: the replayed batch replaces its folders. A
    batch that is replayed after its marker is left as it is. An empty batch writes
    nothing.
    """
    if COMMITS in outputs:
        raise ValueError(f"{COMMITS} is the folder of the markers")

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if batch_id <= last_commit(spark, path):
            return
        batch.persist()
        try:
            if batch.isEmpty():
                return
            for name, derive in outputs.items():
                derive(batch).write.mode("overwrite").parquet(f"{path}/{name}/batch_id={batch_id}")
            _commit(spark, path, batch_id)
        finally:
            batch.unpersist()

    return write


def _folder(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def last_commit(spark: SparkSession, path: str) -> int:
    """The highest batch id whose tables are all written, or -1."""
    files, where = _folder(spark, f"{path}/{COMMITS}")
    names = [f.getPath().getName() for f in files.listStatus(where)] if files.exists(where) else []
    return max((int(n) for n in names if n.isdigit()), default=-1)


def _commit(spark: SparkSession, path: str, batch_id: int) -> None:
    """Batches come one after the other, so the last marker speaks for all before it and stays alone."""
    before = last_commit(spark, path)
    files, where = _folder(spark, f"{path}/{COMMITS}/{batch_id}")
    files.create(where, True).close()
    if 0 <= before < batch_id:
        files.delete(_folder(spark, f"{path}/{COMMITS}/{before}")[1], False)


def committed(spark: SparkSession, path: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """The rows of one of the tables of ``fan_out``, from finished batches only; folders of others are not read."""
    reader = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch_id", T.LongType())])) if schema else spark.read
    return reader.parquet(f"{path}/{name}").filter(F.col("batch_id") <= last_commit(spark, path)).drop("batch_id")


def start_batches(df: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str, trigger: str | None = "10 seconds") -> StreamingQuery:
    writer = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if trigger is None else writer.trigger(processingTime=trigger)).start()
