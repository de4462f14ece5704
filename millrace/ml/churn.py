"""Customer churn: label, features and classifiers."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.ml.features import SEED, Category, Inputs, Number, kept

INPUTS = Inputs(Number("total_orders"), Number("total_spent"), Number("avg_order_value", 0.0), Category("customer_state", "Unknown"))


def churn_label(customers: DataFrame, min_orders: int = 2, min_spend: float = 100) -> DataFrame:
    """1 for customers with few orders or little spend."""
    churned = (F.col("total_orders") < min_orders) | (F.col("total_spent") < min_spend)
    return customers.withColumn("is_churn", F.when(churned, 1).otherwise(0))


def feature_rows(customers: DataFrame) -> DataFrame:
    """Customers with totals; other gaps are filled."""
    return INPUTS.ready(customers.select("customer_id", *INPUTS.names, "is_churn"))


# The settings of both classifiers.
def logistic_regression() -> LogisticRegression:
    return LogisticRegression(labelCol="is_churn", maxIter=10, regParam=0.3, elasticNetParam=0.8)


def random_forest(trees: int = 10, depth: int = 5) -> RandomForestClassifier:
    """Over the scaled numbers, so there may be any number of states."""
    return RandomForestClassifier(labelCol="is_churn", numTrees=trees, maxDepth=depth, seed=SEED)


def fit(train: DataFrame, *classifiers) -> list[PipelineModel]:
    """One fitted pipeline per classifier over the same prepared rows."""
    prepared = Pipeline(stages=INPUTS.stages()).fit(train)
    with kept(prepared.transform(train)) as rows:
        return [PipelineModel([*prepared.stages, c.fit(rows)]) for c in classifiers]
