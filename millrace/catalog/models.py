"""Models over the given tables. Fitted results have no SQL; the tests check their invariants."""

from __future__ import annotations

from pyspark.ml import Pipeline
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from millrace.catalog.views import over
from millrace.ml import churn, features, fraud, simple, topics
from millrace.plans import commerce
from millrace.registry import query
from millrace.session import run_dir
from millrace.sinks.files import write_parquet
from millrace.sources import tables as t

SEGMENTS_SQL = """seg AS (SELECT customer_id, customer_state, count(DISTINCT order_id) AS total_orders,
        round(sum(price + freight_value), 4) AS total_spent, round(sum(price + freight_value), 4) / count(*) AS avg_order_value
      FROM orders_v JOIN items_v USING (order_id) LEFT JOIN customers_v USING (customer_id)
      WHERE order_status = 'F' GROUP BY customer_id, customer_state)"""


def labelled(spark, sf):
    segments = commerce.customer_segments(t.orders(spark, sf), t.items(spark, sf), t.customers(spark, sf))
    return churn.churn_label(segments, min_orders=2, min_spend=1_000_000)


def churn_rows(spark, sf):
    return churn.feature_rows(labelled(spark, sf))


@query(
    "ml01_churn_label",
    over(
        "orders_v items_v customers_v",
        f"""WITH {SEGMENTS_SQL} SELECT customer_id, total_orders,
            CASE WHEN total_orders < 2 OR total_spent < 1000000 THEN 1 ELSE 0 END AS is_churn FROM seg""",
    ),
)
def ml01(spark, sf):
    return labelled(spark, sf).select("customer_id", "total_orders", "is_churn")


@query(
    "ml02_features",
    over(
        "orders_v items_v customers_v",
        f"""WITH {SEGMENTS_SQL},
            idx AS (SELECT customer_state, row_number() OVER (ORDER BY count(*) DESC, customer_state) - 1 AS i FROM seg GROUP BY customer_state)
            SELECT customer_id, round(total_orders / stddev_samp(total_orders) OVER (), 6) AS f_orders,
                   round(total_spent / stddev_samp(total_spent) OVER (), 6) AS f_spent,
                   round(avg_order_value / stddev_samp(avg_order_value) OVER (), 6) AS f_avg,
                   round(i / stddev_samp(i) OVER (), 6) AS f_state
            FROM seg JOIN idx USING (customer_state)""",
    ),
)
def ml02(spark, sf):
    rows = churn_rows(spark, sf)
    scaled = Pipeline(stages=churn.INPUTS.stages()).fit(rows).transform(rows)
    v = vector_to_array("features")
    names = ["f_orders", "f_spent", "f_avg", "f_state"]
    return scaled.select("customer_id", *[F.round(v[i], 6).alias(n) for i, n in enumerate(names)])


@query("ml03_split")
def ml03(spark, sf):
    train, test = features.split(churn_rows(spark, sf), "customer_id")
    s_train, s_test = features.stratified_split(churn_rows(spark, sf), "customer_id", "is_churn")
    parts = [("plain", "train", train), ("plain", "test", test), ("stratified", "train", s_train), ("stratified", "test", s_test)]
    out = None
    for kind, side, rows in parts:
        one = rows.groupBy("is_churn").agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(kind).alias("kind"), F.lit(side).alias("side"), "is_churn", "n"
        )
        out = one if out is None else out.unionByName(one)
    return out


@query(
    "ml03_split_totals",
    over(
        "orders_v items_v customers_v",
        f"""WITH {SEGMENTS_SQL},
            c AS (SELECT CASE WHEN total_orders < 2 OR total_spent < 1000000 THEN 1 ELSE 0 END AS is_churn FROM seg)
            SELECT kind, is_churn, count(*) AS n FROM c, (VALUES ('plain'), ('stratified')) k(kind) GROUP BY kind, is_churn""",
    ),
)
def ml03_totals(spark, sf):
    """No class gains or loses rows by either split."""
    return ml03(spark, sf).groupBy("kind", "is_churn").agg(F.sum("n").alias("n"))


def _churn_split(spark, sf):
    return features.split(churn_rows(spark, sf), "customer_id")


@query("ml04_logistic_regression")
def ml04(spark, sf):
    train, test = _churn_split(spark, sf)
    (model,) = churn.fit(train, churn.logistic_regression())
    return model.transform(test).select("customer_id", "is_churn", "prediction", features.chance().alias("probability"))


@query("ml05_random_forest")
def ml05(spark, sf):
    train, test = _churn_split(spark, sf)
    (model,) = churn.fit(train, churn.random_forest())
    return model.transform(test).select("customer_id", "is_churn", "prediction", features.chance().alias("probability"))


@query("ml06_evaluation")
def ml06(spark, sf):
    """Per-class report of the churn forest on unseen customers."""
    train, test = _churn_split(spark, sf)
    (model,) = churn.fit(train, churn.random_forest())
    matrix = features.confusion(
        model.transform(test).select(F.col("is_churn").cast("double").alias("label"), "prediction")
    )
    return features.class_report(matrix)


@query("ml06_overall")
def ml06_overall(spark, sf):
    """Accuracy, area under the curve and the confusion counts on unseen customers."""
    train, test = _churn_split(spark, sf)
    (model,) = churn.fit(train, churn.random_forest())
    with features.kept(model.transform(test).withColumn("label", F.col("is_churn").cast("double"))) as scored:
        found = features.metrics(scored)
        cells = features.confusion(scored).collect()  # one row for each pair of classes
    rows = [("accuracy", found["accuracy"]), ("area under the curve", found["auc"])]
    rows += [(f"{int(r['label'])} predicted as {int(r['prediction'])}", float(r["n"])) for r in cells]
    return spark.createDataFrame(rows, "measure string, value double")


@query("ml07_feature_importance")
def ml07(spark, sf):
    (model,) = churn.fit(_churn_split(spark, sf)[0], churn.random_forest())
    return features.importances(model.stages[-1], churn.INPUTS.names, spark)


@query("ml08_predictions")
def ml08(spark, sf):
    """Both classifiers compared by area under the curve; the better one's predictions are stored."""
    train, test = _churn_split(spark, sf)
    names = ["logistic regression", "random forest"]
    models = churn.fit(train, churn.logistic_regression(), churn.random_forest())
    scored = [m.transform(test) for m in models]
    aucs = [features.metrics(p, "is_churn")["auc"] for p in scored]
    best = max(range(len(models)), key=lambda i: aucs[i])
    path = run_dir(spark, "ml08")
    kept = scored[best].select(
        "customer_id", "total_orders", "total_spent", "is_churn", "prediction", features.chance().alias("probability")
    )
    write_parquet(kept.withColumns({"model": F.lit(names[best]), "auc": F.lit(round(aucs[best], 6))}), path)
    return spark.read.parquet(path)


@query("ml09_fraud_scores")
def ml09(spark, sf):
    """Scores of the claims that the model has not seen."""
    train, test = features.stratified_split(t.claims(spark, sf), "claim_id", "is_fraud")
    return fraud.score(test, fraud.train(train)).select("claim_id", "is_fraud", "fraud_probability")


@query("ml09_fraud_evaluation")
def ml09_evaluation(spark, sf):
    """Precision, recall and F1 of each class on the claims that the model has not seen."""
    train, test = features.stratified_split(t.claims(spark, sf), "claim_id", "is_fraud")
    scored = fraud.score(test.filter("is_fraud IS NOT NULL"), fraud.train(train))
    return features.class_report(features.confusion(scored.select(F.col("is_fraud").cast("double").alias("label"), "prediction")))


@query(
    "ml10_linear_regression",
    """WITH m AS (SELECT regr_slope(l_extendedprice, l_quantity) AS b, regr_intercept(l_extendedprice, l_quantity) AS a FROM lineitem)
       SELECT round(any_value(b), 4) AS slope, round(any_value(a), 3) AS intercept,
              round(sqrt(avg((l_extendedprice - a - b * l_quantity) * (l_extendedprice - a - b * l_quantity))), 4) AS rmse, count(*) AS n
       FROM lineitem, m""",
)
def ml10(spark, sf):
    rows = t.table(spark, sf, "lineitem").select("l_quantity", "l_extendedprice")
    model = simple.linear_fit(rows, ["l_quantity"], "l_extendedprice")
    error = simple.squared_error(model.transform(simple.assemble(rows, ["l_quantity"])), "l_extendedprice")
    return error.select(
        F.lit(round(float(model.coefficients[0]), 4)).alias("slope"),
        F.lit(round(float(model.intercept), 3)).alias("intercept"),
        F.round(F.sqrt("mse"), 4).alias("rmse"),
        "n",
    )


DIMENSIONS = 64


@query("ml11_kmeans")
def ml11(spark, sf):
    vectors = simple.array_to_columns(t.table(spark, sf, "embeddings"), "embedding", DIMENSIONS)
    rows = simple.assemble(vectors, [f"e{i}" for i in range(DIMENSIONS)])
    model = simple.kmeans_fit(rows, 3)
    return model.transform(rows).select("vec_id", "label", F.col("prediction").alias("cluster"))


@query("ml12_multiclass_forest")
def ml12(spark, sf):
    """Embedding labels from the vector elements, with the test accuracy on every row."""
    vectors = simple.array_to_columns(
        t.table(spark, sf, "embeddings").select("vec_id", F.col("label").cast("string").alias("species"), "embedding"),
        "embedding",
        DIMENSIONS,
    )
    train, test = features.stratified_split(vectors, "vec_id", "species")
    model = simple.multiclass_pipeline([f"e{i}" for i in range(DIMENSIONS)], "species").fit(train)
    scored = model.transform(test).select("vec_id", "label", "prediction")
    accuracy = scored.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).scalar()
    return scored.withColumn("accuracy", accuracy)


@query("txt03_topic_clusters")
def txt03(spark, sf):
    articles = t.articles(spark, sf)
    return topics.assign(articles, topics.fit(articles)).select("doc_id", "cluster")


@query("txt04_cluster_terms")
def txt04(spark, sf):
    return topics.cluster_terms(topics.fit(t.articles(spark, sf)), spark)


@query("txt05_projection")
def txt05(spark, sf):
    articles = t.articles(spark, sf)
    return topics.projection(topics.assign(articles, topics.fit(articles)), ["doc_id"])


@query("txt06_enrich_with_clusters")
def txt06_clusters(spark, sf):
    done = topics.enrich(t.articles(spark, sf))
    return done.select("id", "doc_id", "sentiment.label", F.array_join("keywords", " ").alias("keywords"), "cluster")
