"""Stored tables whose partitions are replaced one by one.

A table keeps every partition in a folder of its own. Replacing some partitions
writes their next content beside the old and then moves the catalog's location of
just those partitions; all other folders, and the files in them, stay as they are.
A failed write changes nothing, and a run that stops between two moves is put right
by running it again. Folders that are no longer used stay for readers that began
before; ``vacuum`` deletes them.
"""

from __future__ import annotations

import posixpath
import uuid
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.session import delete_folder, run_dir

TOGETHER = 500  # partitions named in one statement
NULL_FOLDER = "__HIVE_DEFAULT_PARTITION__"


def create(df: DataFrame, name: str, by: str, properties: dict[str, str] | None = None) -> None:
    """A new table of ``df``, partitioned by its column ``by``, which becomes the last one."""
    spark = df.sparkSession
    root = run_dir(spark, name.replace(".", "_"))
    columns = [c for c in df.columns if c != by] + [by]
    ddl = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in columns)
    extra = {"root": root, **(properties or {})}
    stated = ", ".join(f"'millrace.{k}'='{v}'" for k, v in extra.items())
    spark.sql(f"CREATE TABLE {name} ({ddl}) USING parquet PARTITIONED BY (`{by}`) LOCATION '{root}/none' TBLPROPERTIES ({stated})")
    replace(spark, name, by, [], df.select(*columns))


def property_of(spark: SparkSession, name: str, key: str) -> str:
    return spark.sql(f"SHOW TBLPROPERTIES {name} ('millrace.{key}')").first()["value"]


def partitions(spark: SparkSession, name: str) -> list[str | None]:
    """The values of the table's partitions, as texts."""
    values = [unquote(r["partition"].split("=", 1)[1]) for r in spark.sql(f"SHOW PARTITIONS {name}").collect()]
    return [None if v in (NULL_FOLDER, "null") else v for v in values]


def _spec(by: str, value: str | None) -> str:
    return f"PARTITION (`{by}`={'NULL' if value is None else repr(str(value))})"


def replace(spark: SparkSession, name: str, by: str, values: list, content: DataFrame) -> None:
    """Make ``content`` all that the partitions ``values`` hold, and add partitions it has beside them.

    Each partition is written by one task, or by several if it is large.
    """
    folder = f"{property_of(spark, name, 'root')}/{uuid.uuid4().hex}"
    content.hint("rebalance", F.col(by)).write.partitionBy(by).parquet(folder)
    # Read back with the table's own type, so that a folder's text is no number by accident.
    kind = content.schema[by].dataType.simpleString()
    written = {r[0] for r in spark.read.schema(f"`{by}` {kind}").parquet(folder).select(F.col(by).cast("string")).distinct().collect()}
    known = set(partitions(spark, name))
    new = []
    for value in sorted(written, key=str):
        where = f"{folder}/{by}={NULL_FOLDER if value is None else value}"
        if value in known:
            spark.sql(f"ALTER TABLE {name} {_spec(by, value)} SET LOCATION '{where}'")
        else:
            new.append(f"{_spec(by, value)} LOCATION '{where}'")
    for at in range(0, len(new), TOGETHER):
        spark.sql(f"ALTER TABLE {name} ADD {' '.join(new[at : at + TOGETHER])}")
    drop(spark, name, by, [v for v in map(_text, values) if v in known and v not in written])
    spark.catalog.refreshTable(name)


def _text(value) -> str | None:
    return None if value is None else str(value)


def drop(spark: SparkSession, name: str, by: str, values: list[str | None]) -> None:
    """Forget partitions without reading or writing a file of theirs."""
    for at in range(0, len(values), TOGETHER):
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS {', '.join(_spec(by, v) for v in values[at : at + TOGETHER])}")
    spark.catalog.refreshTable(name)


def vacuum(spark: SparkSession, name: str) -> int:
    """Delete the folders under the table's root that no partition uses; returns how many. Run it when no old reader is left."""
    root = property_of(spark, name, "root")
    live = {posixpath.dirname(f).split(root.split(":", 1)[-1], 1)[-1] for f in map(unquote, spark.table(name).inputFiles())}
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    gone = 0
    for run in files.listStatus(path):
        if run.isDirectory():
            for part in files.listStatus(run.getPath()):
                place = f"/{run.getPath().getName()}/{part.getPath().getName()}"
                if part.isDirectory() and unquote(place) not in live:
                    gone += delete_folder(spark, part.getPath().toString())
    return gone
