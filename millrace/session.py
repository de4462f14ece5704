"""Session settings and the shared folder used for checkpoints and staged tables."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark import SparkConf, SparkContext
from pyspark.sql import DataFrame, SparkSession

# Streaming state may outgrow executor memory; each batch stores only what it changed.
LARGE_STATE = {
    "spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
}

# Settings every job expects; what spark-submit, spark-defaults or the caller sets comes first.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    **LARGE_STATE,
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    app: str = "millrace",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    **extra: str,
) -> SparkSession:
    """Create (or get) a session with the library's defaults.

    ``shuffle_partitions`` stays unset on a cluster so that AQE coalesces from
    the cluster's own value; tests and the bench pass the core count.
    """
    builder = SparkSession.builder.appName(app).config("spark.ui.showConsoleProgress", "false")  # the shell sets it by itself
    if master:
        builder = builder.master(master)
    for key, value in {**_unset(DEFAULTS), **extra}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    return builder.getOrCreate()


def _unset(defaults: dict[str, str]) -> dict[str, str]:
    """Those defaults that neither the submitted configuration nor a running session holds."""
    running = SparkSession.getActiveSession()
    given = running.sparkContext.getConf() if running else _submitted()
    return {k: v for k, v in defaults.items() if not given.contains(k)}


def _submitted() -> SparkConf:
    """What spark-submit and spark-defaults say; starts the gateway that the session will use."""
    SparkContext._ensure_initialized()
    return SparkConf(loadDefaults=True, _jvm=SparkContext._jvm)


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local master may fall back to a temporary folder: on a cluster a
    machine-local folder would be lost with its executor.
    """
    context = spark.sparkContext
    named = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    local = context.master.startswith("local")
    if named and named.startswith("file:") and not local:
        raise ValueError(f"{named} is a folder of one machine; set spark.checkpoint.dir to a folder shared by all executors")
    if named:
        return named.rstrip("/")
    if not local:
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="millrace-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; one per run, never reused."""
    return f"{shared_dir(spark)}/millrace/{label}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Used where a value must be fixed before it is used twice (row positions,
    micro-batch contents): the files survive lost executors, so a recomputed
    task sees the same rows.
    """
    path = run_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder that this library wrote under the shared folder; any other path is refused."""
    inside = f"{shared_dir(spark).split(':', 1)[-1].lstrip('/')}/millrace/"
    plain = path.split(":", 1)[-1].lstrip("/")
    if not plain.startswith(inside) or ".." in plain or plain == inside:
        raise ValueError(f"{path} is not a folder of this library")
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for what is started inside; the caller's come back afterwards."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def release(df: DataFrame) -> None:
    """Delete the files of a table that ``stage_table`` stored, once everything made from it is written."""
    folders = {f.rsplit("/", 1)[0] for f in df.inputFiles()}
    for folder in folders:
        delete_folder(df.sparkSession, folder)
