"""Batch file scans."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None, infer: bool = True) -> DataFrame:
    """Headered CSV. Inference costs an extra pass over the file; a schema avoids it."""
    reader = spark.read.option("header", True)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", infer).csv(path)


def read_delimited(spark: SparkSession, path: str, schema: T.StructType, sep: str = ",") -> DataFrame:
    """Delimited text with declared columns taken by position; the first line is skipped."""
    return spark.read.schema(schema).option("header", True).option("enforceSchema", True).option("sep", sep).csv(path)


def read_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame]) -> DataFrame:
    """The stored table, or a freshly built one when the path does not exist."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return build()


def read_json_docs(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True) -> DataFrame:
    """JSON documents with declared fields.

    ``multiline`` reads whole files as an array or object, one task per file;
    large collections should be stored one document per line.
    """
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def literal_table(spark: SparkSession, rows: list, schema: str | T.StructType) -> DataFrame:
    """A small table written in code."""
    return spark.createDataFrame(rows, schema)
