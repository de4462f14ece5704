"""Encodings and scaling of feature columns."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.operators.ordinal import with_ordinal

def one_hot(df: DataFrame, levels: dict[str, list], drop_first: bool = True) -> DataFrame:
    """A 0/1 column per listed level of each column (the first one dropped); the source columns go.

    A column per level only makes sense for levels that are known beforehand, so
    the caller lists them; any other value gives 0 throughout. For levels found in
    the data use ``one_hot_vector``.
    """
    for column, known in levels.items():
        kept = known[1 if drop_first else 0 :]
        df = df.withColumns(
            {f"{column}_{v}": F.coalesce((F.col(column) == F.lit(v)).cast("int"), F.lit(0)) for v in kept}
        ).drop(column)
    return df


def one_hot_vector(df: DataFrame, column: str, name: str) -> DataFrame:
    """A sparse 0/1 vector over all levels in the data, however many; null and unseen values are all 0."""
    stages = [
        StringIndexer(inputCol=column, outputCol="_level", stringOrderType="alphabetAsc", handleInvalid="keep"),
        OneHotEncoder(inputCol="_level", outputCol=name),
    ]
    return Pipeline(stages=stages).fit(df).transform(df).drop("_level")


def label_encode(df: DataFrame, column: str, name: str) -> DataFrame:
    """Alphabetical position of each level from 0; null stays null.

    The levels are numbered as a table, so there may be any number of them.
    """
    known = df.filter(F.col(column).isNotNull()).select(column).distinct()
    numbered = with_ordinal(known, [column], name).withColumn(name, (F.col(name) - 1).cast("int"))
    return df.join(numbered, column, "left")


def standardise(df: DataFrame, columns: list[str]) -> DataFrame:
    """(x - mean) / population deviation; a constant column becomes 0."""
    stats = df.agg(
        F.struct(
            *[
                F.struct(F.avg(c).alias("mean"), F.stddev_pop(c).alias("std")).alias(c)
                for c in columns
            ]
        ).alias("s")
    ).scalar()
    out = {}
    for c in columns:
        mean, std = stats.getField(c).getField("mean"), stats.getField(c).getField("std")
        out[c] = (F.col(c) - mean) / F.when(std == 0, F.lit(1.0)).otherwise(std)
    return df.withColumns(out)
