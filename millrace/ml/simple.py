"""Regression, clustering and multiclass models over numeric columns."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml import Pipeline
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.clustering import KMeansModel
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import LinearRegression, LinearRegressionModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.ml.features import SEED
from millrace.session import release, stage_table


def assemble(df: DataFrame, columns: list[str]) -> DataFrame:
    return VectorAssembler(inputCols=columns, outputCol="features", handleInvalid="skip").transform(df)


def array_to_columns(df: DataFrame, array: str, size: int, prefix: str = "e") -> DataFrame:
    """Elements of a fixed-length array as columns."""
    return df.select(*df.columns, *[F.get(array, i).cast("double").alias(f"{prefix}{i}") for i in range(size)])


def linear_fit(df: DataFrame, features: list[str], label: str) -> LinearRegressionModel:
    return LinearRegression(labelCol=label, solver="normal").fit(assemble(df, features))


def squared_error(predictions: DataFrame, label: str) -> DataFrame:
    error = F.col(label) - F.col("prediction")
    return predictions.agg(F.avg(error * error).alias("mse"), F.count(F.lit(1)).alias("n"))


SEED_ROWS = 2_000  # rows that first centres are drawn from
TOLERANCE = 1e-4  # a start rests when no centre moves further
ROWS_AT_ONCE = 1_024  # vectors that a task holds with all their entries


def kmeans_fit(rows: DataFrame, k: int, starts: int = 1, seed: int = SEED, most_rounds: int = 20) -> KMeansModel:
    """The cheapest of several seeded starts, all advanced together.

    A round is one pass over the vectors, whatever the number of starts: tasks send
    the sums and counts of each (start, cluster), which Spark adds up. First centres
    are drawn from SEED_ROWS rows with the smallest hashes, each next one by its
    squared distance to those before. A cluster that has lost its rows keeps its
    centre. A start that rests takes no further part but for its cost.

    The vectors are stored as they are, sparse ones by their entries alone; a task
    spreads out ROWS_AT_ONCE of them at a time.
    """
    held = stage_table(rows.select("features"), "vectors")
    try:
        drawn = held.select(vector_to_array("features").alias("x")).withColumn("h", F.xxhash64("x")).orderBy("h").limit(SEED_ROWS).collect()
        if not drawn:
            raise ValueError("there is no row to cluster")
        sample = np.array([r["x"] for r in drawn])
        centres = np.array([_first_centres(sample, k, np.random.default_rng(seed + i)) for i in range(starts)])
        resting = np.zeros(starts, bool)
        cost = np.full(starts, np.inf)
        for _ in range(most_rounds):
            moving = np.flatnonzero(~resting)
            sums, counts, found = _round(held, centres[moving])
            new = np.where(counts[..., None] > 0, sums / np.maximum(counts, 1)[..., None], centres[moving])
            resting[moving] = ((new - centres[moving]) ** 2).sum(2).max(1) <= TOLERANCE**2
            centres[moving], cost[moving] = new, found
            if resting.all():
                break
        # Costs belong to the centres before their last step: one more pass for all.
        cost = _round(held, centres)[2]
    finally:
        release(held)
    return _model(rows.sparkSession, centres[int(cost.argmin())])


def _first_centres(sample: np.ndarray, k: int, draw: np.random.Generator) -> np.ndarray:
    centres = [sample[draw.integers(len(sample))]]
    for _ in range(k - 1):
        far = np.min([((sample - c) ** 2).sum(1) for c in centres], axis=0)
        total = far.sum()
        centres.append(sample[draw.choice(len(sample), p=far / total if total > 0 else None)])
    return np.array(centres)


def _round(vectors: DataFrame, centres: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(sums, counts, costs) of the vectors nearest to each centre, for every start."""
    starts, k, dim = centres.shape

    across, own_norms = np.ascontiguousarray(centres.reshape(-1, dim).T), (centres**2).sum(2)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, counts, cost = np.zeros((starts * k, dim)), np.zeros(starts * k), np.zeros(starts)
        for batch in (b.slice(i, ROWS_AT_ONCE) for b in batches for i in range(0, b.num_rows, ROWS_AT_ONCE)):
            x = _spread(batch, dim)
            # One product for the centres of all starts, another for the sums of all their clusters.
            d = (x @ across).reshape(-1, starts, k)
            d *= -2
            d += own_norms
            own = d.argmin(2)
            near = np.take_along_axis(d, own[..., None], 2)[..., 0] + np.einsum("ij,ij->i", x, x)[:, None]
            member = np.zeros((len(x), starts * k))
            member[np.arange(len(x))[:, None], own + np.arange(starts) * k] = 1
            sums += member.T @ x
            counts += member.sum(0)
            cost += np.maximum(near, 0).sum(0)
        total = np.concatenate([sums.reshape(starts, -1), counts.reshape(starts, -1), cost[:, None]], axis=1)
        yield pa.RecordBatch.from_arrays([pa.array([total.ravel()], pa.list_(pa.float64()))], ["part"])

    plain = vectors.select(F.unwrap_udt("features").alias("v"))
    entries = plain.select(F.coalesce("v.indices", F.sequence(F.lit(0), F.size("v.values") - 1)).alias("at"), F.col("v.values").alias("value"))
    parts = entries.mapInArrow(run, "part array<double>").select(F.posexplode("part")).groupBy("pos").agg(F.sum("col").alias("total"))
    found = np.array([r["total"] for r in sorted(parts.collect(), key=lambda r: r["pos"])]).reshape(starts, -1)
    return found[:, : k * dim].reshape(starts, k, dim), found[:, k * dim : -1], found[:, -1]


def _spread(batch: pa.RecordBatch, dim: int) -> np.ndarray:
    """Rows of (places, values) with all their entries."""
    x = np.zeros((batch.num_rows, dim))
    row = np.repeat(np.arange(batch.num_rows), batch.column(0).value_lengths().to_numpy(zero_copy_only=False))
    x[row, batch.column(0).flatten().to_numpy()] = batch.column(1).flatten().to_numpy(zero_copy_only=False)
    return x


def _model(spark: SparkSession, centres: np.ndarray) -> KMeansModel:
    """The centres as Spark's own model, which scores inside the JVM."""
    jvm, listed = spark._jvm, spark._jvm.java.util.ArrayList()
    for centre in centres.tolist():
        listed.add(jvm.org.apache.spark.mllib.linalg.Vectors.dense(float(centre[0]), _doubles(spark, centre[1:])))
    inner = jvm.org.apache.spark.mllib.clustering.KMeansModel(listed)
    return KMeansModel(jvm.org.apache.spark.ml.clustering.KMeansModel(f"kmeans_{uuid.uuid4().hex[:12]}", inner))


def _doubles(spark: SparkSession, values: list[float]):
    out = spark._jvm.PythonUtils.toSeq([float(v) for v in values])
    return out


def multiclass_pipeline(features: list[str], label: str, trees: int = 100) -> Pipeline:
    return Pipeline(
        stages=[
            StringIndexer(inputCol=label, outputCol="label", stringOrderType="alphabetAsc", handleInvalid="keep"),
            VectorAssembler(inputCols=features, outputCol="features"),
            RandomForestClassifier(numTrees=trees, seed=SEED),
        ]
    )
