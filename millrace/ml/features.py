"""Inputs, splits, class weights, evaluation: shared by the models."""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.ml import Transformer
from pyspark.ml.base import Estimator
from pyspark.ml.classification import ClassificationModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import StandardScaler, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.numbers import mapped

SEED = 42
_BUCKETS = 1_000_000
LARGE = 100_000  # rows of one class that a single task may get
MOST_CLASSES = 10_000  # that may be broadcast, with one row each


@dataclass(frozen=True)
class Number:
    """A numeric input. A missing value becomes ``default``; without one the row is left out."""

    name: str
    default: float | None = None


@dataclass(frozen=True)
class Category:
    """A text input, as a number: from ``codes``, where other values become ``default``, or by rank of frequency, where missing ones do."""

    name: str
    default: str | int
    codes: dict[str, int] | None = None


class Inputs:
    """What a model learns from. Fills, codes, the scaled vector and the names of importances follow from one list."""

    def __init__(self, *columns: Number | Category, centred: bool = False) -> None:
        self.names = [c.name for c in columns]
        self.centred = centred
        categories = [c for c in columns if isinstance(c, Category)]
        self._coded = [c for c in categories if c.codes]
        self._ranked = [c for c in categories if not c.codes]
        self._needed = [c.name for c in columns if isinstance(c, Number) and c.default is None]
        self._defaults = {c.name: c.default for c in columns if c not in self._coded and c.default is not None}
        # Columns of the vector: numbers as they are, categories by their code.
        self.vector = [f"{c.name}_code" if c in categories else c.name for c in columns]

    def ready(self, df: DataFrame) -> DataFrame:
        """Rows with all that is needed, gaps filled, fixed codes added."""
        if self._needed:
            df = df.dropna(subset=self._needed)
        return df.fillna(self._defaults).withColumns(
            {f"{c.name}_code": mapped(F.col(c.name), c.codes, c.default) for c in self._coded}
        )

    def stages(self) -> list[Estimator | Transformer]:
        """Ranks of categories without codes, then the scaled vector ``features``."""
        names = [c.name for c in self._ranked]
        rank = [StringIndexer(inputCols=names, outputCols=[f"{n}_code" for n in names], handleInvalid="keep")] if names else []
        return [
            *rank,
            VectorAssembler(inputCols=self.vector, outputCol="unscaled"),
            StandardScaler(inputCol="unscaled", outputCol="features", withMean=self.centred),
        ]


@contextmanager
def kept(df: DataFrame):
    """Hold training rows while an iterative fit reads them again and again."""
    df = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield df
    finally:
        df.unpersist()


def _bucket(key: str, seed: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key), F.lit(seed)), F.lit(_BUCKETS))


def split(df: DataFrame, key: str, train: float = 0.8, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """Train and test rows by a hash of the key: the same row always falls on the same side."""
    inside = _bucket(key, seed) < int(train * _BUCKETS)
    return df.filter(inside), df.filter(~inside)


def _beside(sizes: DataFrame, per_class: DataFrame) -> DataFrame:
    """One row per class, ready to be joined: broadcast if a class is large, as a shuffle would send all its rows to one task.

    Few non-empty partitions keep AQE from doing so, and a cached plan is not split.
    """
    classes, largest = sizes.agg(F.count(F.lit(1)), F.max("_n")).first()
    return F.broadcast(per_class) if classes <= MOST_CLASSES and (largest or 0) > LARGE else per_class


def spread(df: DataFrame) -> DataFrame:
    """Rows in partitions of about LARGE, so that an iterative fit holds blocks that fit beside each other in memory."""
    parts = df.count() // LARGE
    return df.repartition(parts) if parts > 1 else df


def stratified_split(df: DataFrame, key: str, label: str, train: float = 0.8, seed: int = SEED) -> tuple[DataFrame, DataFrame]:
    """As ``split``, with the share kept in every class: each class has its own cut on the hash.

    Rows without a label are a class of their own, so every row is on one side.
    """
    marked = df.withColumn("_b", _bucket(key, seed))
    cuts = marked.groupBy(F.col(label).alias("_label")).agg(F.percentile_approx("_b", train, 10_000).alias("_cut"))
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    joined = marked.join(_beside(sizes, cuts), F.col(label).eqNullSafe(F.col("_label")))
    columns = df.columns
    return (
        joined.filter(F.col("_b") <= F.col("_cut")).select(*columns),
        joined.filter(F.col("_b") > F.col("_cut")).select(*columns),
    )


def balanced_weights(df: DataFrame, label: str, name: str = "weight") -> DataFrame:
    """Weight n / (classes * class size) per row; rows without a label are left out, as nothing can be learnt from them."""
    df = df.filter(F.col(label).isNotNull())
    sizes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_n"))
    everything = Window.partitionBy()  # one row per class
    weights = sizes.select(
        label, (F.sum("_n").over(everything) / (F.count(F.lit(1)).over(everything) * F.col("_n"))).alias(name)
    )
    return df.join(_beside(sizes, weights), label)


def confusion(predictions: DataFrame, label: str = "label") -> DataFrame:
    """Rows per (label, prediction)."""
    return predictions.groupBy(F.col(label).alias("label"), "prediction").agg(F.count(F.lit(1)).alias("n"))


def class_report(matrix: DataFrame) -> DataFrame:
    """Precision, recall, F1 and support per class, from the confusion counts."""
    cells = matrix.select(
        F.explode(
            F.array(
                F.struct(
                    F.col("label").alias("c"),
                    F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0).alias("hit"),
                    F.col("n").alias("actual"),
                    F.lit(0).cast("long").alias("guessed"),
                ),
                F.struct(
                    F.col("prediction").alias("c"),
                    F.lit(0).cast("long").alias("hit"),
                    F.lit(0).cast("long").alias("actual"),
                    F.col("n").alias("guessed"),
                ),
            )
        ).alias("x")
    )
    sums = cells.groupBy(F.col("x.c").alias("label")).agg(
        F.sum("x.hit").alias("hit"), F.sum("x.actual").alias("support"), F.sum("x.guessed").alias("guessed")
    )
    zero = F.lit(0.0)
    precision = F.when(F.col("guessed") > 0, F.col("hit") / F.col("guessed")).otherwise(zero)
    recall = F.when(F.col("support") > 0, F.col("hit") / F.col("support")).otherwise(zero)
    return sums.select("label", precision.alias("precision"), recall.alias("recall"), "support").withColumn(
        "f1",
        F.when(
            F.col("precision") + F.col("recall") > 0,
            2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall")),
        ).otherwise(zero),
    )


def metrics(predictions: DataFrame, label: str = "label") -> dict[str, float]:
    """Accuracy and area under the ROC curve."""
    accuracy = MulticlassClassificationEvaluator(labelCol=label, metricName="accuracy").evaluate(predictions)
    auc = BinaryClassificationEvaluator(labelCol=label, metricName="areaUnderROC").evaluate(predictions)
    return {"accuracy": accuracy, "auc": auc}


def importances(model: ClassificationModel, names: list[str], spark, k: int = 10) -> DataFrame:
    """The strongest features of a tree model; one row per feature."""
    rows = [(n, float(v)) for n, v in zip(names, model.featureImportances.toArray())]
    return (
        spark.createDataFrame(rows, "feature string, importance double")
        .orderBy(F.desc("importance"), F.asc("feature"))
        .limit(k)
    )


def chance(column: str = "probability", decimals: int = 4) -> Column:
    """Probability of the positive class."""
    return F.round(vector_to_array(column)[1], decimals)
