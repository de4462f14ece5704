"""Invariants of splits, models and their reports."""

import math
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.feature import CountVectorizer, StopWordsRemover
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from millrace.catalog import models
from millrace.ml import churn, features, fraud, simple, topics
from millrace.sources import tables as t
from tests.conftest import rows


def test_split_is_repeatable_and_whole(spark):
    df = spark.range(2000).select(F.col("id").alias("k"))
    train, test = features.split(df, "k")
    assert train.count() + test.count() == 2000 and train.intersect(test).count() == 0
    again, _ = features.split(df.repartition(7), "k")
    assert rows(again) == rows(train)
    assert 0.75 < train.count() / 2000 < 0.85


def test_stratified_split_keeps_class_shares(spark):
    df = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 20 == 0).cast("int").alias("y"))
    train, test = features.stratified_split(df, "k", "y")
    assert train.count() + test.count() == 3000
    share = {r.y: r.n for r in train.groupBy("y").agg(F.count("*").alias("n")).collect()}
    assert abs(share[1] / 150 - 0.8) < 0.02 and abs(share[0] / 2850 - 0.8) < 0.02


def test_split_and_weights_with_missing_labels_and_many_classes(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), F.when(F.col("id") % 4 > 0, F.col("id") % 3).alias("y"))
    train, test = features.stratified_split(df, "k", "y")
    assert train.count() + test.count() == 1000
    missing = train.filter("y IS NULL").count()
    assert abs(missing / 250 - 0.8) < 0.02
    # Rows without a label are left out of the weights.
    assert features.balanced_weights(df, "y").count() == 750
    classes = spark.range(10_000).select(F.col("id").alias("k"), (F.col("id") % 5000).alias("y"))
    assert features.balanced_weights(classes, "y").filter("weight = 1").count() == 10_000
    train, test = features.stratified_split(classes, "k", "y")
    assert train.count() + test.count() == 10_000


def test_forest_takes_any_number_of_states(spark):
    df = spark.range(800).selectExpr(
        "id AS customer_id", "id % 5 AS total_orders", "id * 1.5 AS total_spent", "id * 0.5 AS avg_order_value",
        "concat('s', id % 200) AS customer_state", "CAST(id % 5 < 2 AS INT) AS is_churn",
    )
    (model,) = churn.fit(df, churn.random_forest())
    assert model.transform(df).filter("prediction = is_churn").count() > 700


def test_rows_of_a_large_class_are_not_dealt_by_class(spark, monkeypatch):
    df = spark.range(3000).select(F.col("id").alias("k"), (F.col("id") % 20 == 0).cast("int").alias("y"))
    sides = [rows(side) for side in features.stratified_split(df, "k", "y")]
    weights = rows(features.balanced_weights(df, "y").select("k", "weight"))
    monkeypatch.setattr(features, "LARGE", 200)
    found = features.stratified_split(df, "k", "y")
    weighted = features.balanced_weights(df, "y")
    assert [rows(side) for side in found] == sides and rows(weighted.select("k", "weight")) == weights
    # Without the hint a class goes to one task wherever few partitions are filled, or the plan is cached.
    assert all("BroadcastHashJoin" in df._jdf.queryExecution().sparkPlan().toString() for df in (*found, weighted))
    assert features.spread(df).rdd.getNumPartitions() == 15
    monkeypatch.setattr(features, "MOST_CLASSES", 1)
    assert rows(features.balanced_weights(df, "y").select("k", "weight")) == weights


def test_balanced_weights_sum_to_the_rows(spark):
    df = spark.createDataFrame([(i, int(i < 10)) for i in range(100)], "k int, label int")
    weighted = features.balanced_weights(df, "label")
    sums = {r.label: r.w for r in weighted.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
    assert math.isclose(sums[0], 50) and math.isclose(sums[1], 50)


def test_class_report_matches_hand_counts(spark):
    p = spark.createDataFrame([(0.0, 0.0)] * 8 + [(0.0, 1.0)] * 2 + [(1.0, 1.0)] * 3 + [(1.0, 0.0)], "label double, prediction double")
    report = {r.label: r for r in features.class_report(features.confusion(p)).collect()}
    assert math.isclose(report[1.0].precision, 3 / 5) and math.isclose(report[1.0].recall, 3 / 4)
    assert report[0.0].support == 10 and math.isclose(report[0.0].f1, 16 / 19)


def test_single_class_report(spark):
    p = spark.createDataFrame([(0.0, 0.0)] * 3, "label double, prediction double")
    (row,) = features.class_report(features.confusion(p)).collect()
    assert (row.precision, row.recall, row.f1) == (1.0, 1.0, 1.0)


def test_churn_labels_at_the_bounds(spark):
    df = spark.createDataFrame([(1, 500.0), (2, 99.99), (2, 100.0)], "total_orders int, total_spent double")
    assert [r.is_churn for r in churn.churn_label(df).collect()] == [1, 1, 0]


def test_churn_models_score_every_test_customer(spark, sf):
    data = models.churn_rows(spark, sf)
    train, test = features.split(data, "customer_id")
    for model in churn.fit(train, churn.logistic_regression(), churn.random_forest()):
        scored = model.transform(test).select("is_churn", "prediction", features.chance().alias("p"))
        assert scored.count() == test.count()
        assert scored.filter(~F.col("p").between(0, 1)).count() == 0


def test_fraud_scores_are_probabilities_for_every_claim(spark, sf):
    claims = t.claims(spark, sf)
    model = fraud.train(claims, trees=10)
    odd = claims.limit(5).withColumns({"claim_amount": F.lit(0.0), "insurance_type": F.lit("OTHER")})
    scored = fraud.score(claims.unionByName(odd), model)
    assert scored.count() == claims.count() + 5
    assert scored.filter(~F.col("fraud_probability").between(0, 1)).count() == 0


def test_fraud_encoding_defaults(spark):
    df = spark.createDataFrame(
        [(100.0, 50.0, "DENIED", "MEDICAID", "TEACHING"), (0.0, 5.0, "?", None, "?")],
        "claim_amount double, approved_amount double, insurance_status string, insurance_type string, hospital_type string",
    )
    out = [tuple(r)[-4:] for r in fraud.encode(df).collect()]
    assert out == [(0.5, 1, 1, 2), (0.0, 2, 2, 0)]


def test_linear_fit_recovers_a_line(spark):
    df = spark.range(50).select(F.col("id").cast("double").alias("x"), (F.col("id") * 3 + 2).cast("double").alias("y"))
    model = simple.linear_fit(df, ["x"], "y")
    error = simple.squared_error(model.transform(simple.assemble(df, ["x"])), "y").first()
    assert math.isclose(model.coefficients[0], 3, rel_tol=1e-6) and error.mse < 1e-9 and error.n == 50


def test_kmeans_separates_clear_groups(spark):
    df = spark.createDataFrame([(float(g * 100 + i),) for g in range(3) for i in range(5)], "x double")
    rows_ = simple.assemble(df, ["x"])
    found = simple.kmeans_fit(rows_, 3, starts=5).transform(rows_)
    assert found.groupBy("prediction").count().filter("count = 5").count() == 3


def test_topics_need_as_many_articles_as_clusters(spark):
    few = spark.createDataFrame([("a", "b")], "title string, description string")
    assert topics.fit(few) is None
    assert topics.assign(few, None).first().cluster is None


def test_topics_group_articles_by_their_words(spark):
    sport = [("football match", f"the team won the football cup {i}") for i in range(6)]
    money = [("stock market", f"shares rise on the stock market {i}") for i in range(6)]
    df = spark.createDataFrame(sport + money, "title string, description string")
    fitted = topics.fit(df, k=2, starts=3, terms=30)
    assigned = topics.assign(df, fitted)
    assert assigned.groupBy("title").agg(F.count_distinct("cluster").alias("n")).filter("n > 1").count() == 0
    terms = topics.cluster_terms(fitted, spark)
    assert terms.count() == 10
    assert {"football", "market"} <= {word for r in terms.collect() for word in r.term.split()}
    flat = topics.projection(assigned, ["title"])
    centre = flat.agg(F.avg("x"), F.avg("y")).first()
    assert flat.count() == 12 and all(abs(v) < 1e-6 for v in centre)


def test_topics_hold_neither_terms_nor_whole_vectors(spark, monkeypatch):
    """A cache packs 10,000 rows of terms into one buffer of the heap, so nothing of the texts is cached."""
    monkeypatch.setattr(type(spark.range(1)), "persist", lambda *_: pytest.fail("rows are cached"))
    df = spark.range(40).selectExpr("concat('title ', id % 4) AS title", "concat('word', id % 4, ' other', id % 4) AS description")
    assigned = topics.assign(df, topics.fit(df, k=4, starts=2, terms=30))
    assert assigned.groupBy("title").agg(F.count_distinct("cluster").alias("n")).filter("n > 1").count() == 0
    assert topics.projection(assigned, ["title"]).count() == 40


def plain_terms(texts):
    """Counts of words of two letters or more but stop words, and of pairs of neighbours."""
    stop = set(StopWordsRemover.loadDefaultStopWords("english"))
    kept = [[w for w in re.findall(r"\w\w+", t.lower()) if w not in stop] for t in texts]
    words, pairs = Counter(w for ws in kept for w in ws), Counter(f"{a} {b}" for ws in kept for a, b in zip(ws, ws[1:]))
    ranked = sorted([(-n, False, w) for w, n in words.items()] + [(-n, True, w) for w, n in pairs.items()])
    return [(w, -n) for n, _, w in ranked]


@pytest.mark.parametrize("terms", [5, 23, 60, 10_000])
def test_vocabulary_equals_plain_counts(spark, terms, monkeypatch):
    """Pairs are counted only where both words are frequent enough; the estimator that counts them all is not fitted."""
    monkeypatch.setattr(CountVectorizer, "_fit", lambda *_: pytest.fail("every pair of words is shuffled"))
    draw = np.random.default_rng(terms)
    words = [*(f"wort{i}" for i in range(30)), "the", "and", "x", "Éa", "it's", "naïve", "__this__", "二つ", "selects", "null"]
    weights = 1 / np.arange(1, len(words) + 1)
    texts = [" ".join(draw.choice(words, n, p=weights / weights.sum())) for n in draw.integers(0, 40, 60)] + ["", "ha ha ha ha", "only-once here"]
    rows = spark.createDataFrame([(t,) for t in texts], "body string")
    want = plain_terms(texts)[:terms]
    assert topics.most_frequent(rows, terms) == [w for w, _ in want]
    articles = rows.selectExpr("body AS title", "CAST(NULL AS string) AS description")
    text, _ = topics.fit(articles, k=2, starts=1, terms=terms)
    found = text.transform(topics.with_body(articles)).select(vector_to_array("counts").alias("c")).collect()
    assert np.sum([r.c for r in found], axis=0).tolist() == [n for _, n in want]
    with pytest.raises(ValueError, match="no article"):
        topics.fit(articles.select(F.lit("the x").alias("title"), "description"), k=2)


def test_a_round_of_all_starts_equals_plain_sums(spark):
    draw = np.random.default_rng(8)
    points, centres = draw.normal(size=(2500, 5)), draw.normal(size=(3, 4, 5))
    rows = spark.createDataFrame([(Vectors.dense(p.tolist()),) for p in points], ["features"])
    sums, counts, costs = simple._round(rows, centres)
    for s, c in enumerate(centres):
        far = ((points[:, None] - c) ** 2).sum(2)
        own = far.argmin(1)
        assert counts[s].tolist() == np.bincount(own, minlength=4).tolist()
        assert np.allclose(sums[s], [points[own == i].sum(0) for i in range(4)]) and np.isclose(costs[s], far.min(1).sum())


def test_sparse_and_dense_vectors_cluster_alike(spark):
    draw = np.random.default_rng(3)
    points = draw.normal(size=(3000, 6)) * (draw.random((3000, 6)) < 0.4) + np.repeat(np.eye(3, 6) * 9, 1000, axis=0)
    places = [[j for j in range(6) if p[j]] for p in points]
    mixed = [(i, Vectors.sparse(6, js, [float(p[j]) for j in js]) if i % 3 else Vectors.dense(p.tolist())) for i, (p, js) in enumerate(zip(points, places, strict=True))]
    dense = [(i, Vectors.dense(p.tolist())) for i, p in enumerate(points)]
    a, b = (simple.kmeans_fit(spark.createDataFrame(x, ["id", "features"]), 3, starts=3) for x in (mixed, dense))
    assert np.allclose(a.clusterCenters(), b.clusterCenters())
    assert np.allclose(sorted(c.tolist() for c in a.clusterCenters()), sorted(points[i * 1000 : i * 1000 + 1000].mean(0).tolist() for i in range(3)))
    batch = pa.RecordBatch.from_pydict({"at": [[0, 2], [], [1]], "value": [[1.0, 2.0], [], [3.0]]})
    assert simple._spread(batch.slice(1, 2), 3).tolist() == [[0, 0, 0], [0, 3, 0]]


def counted(pairs):
    """label -> (precision, recall, F1, support), counted one by one."""
    out = {}
    for label in {x for pair in pairs for x in pair}:
        hit = sum(a == p == label for a, p in pairs)
        guessed, actual = sum(p == label for _, p in pairs), sum(a == label for a, _ in pairs)
        precision, recall = hit / guessed if guessed else 0.0, hit / actual if actual else 0.0
        out[label] = (precision, recall, 2 * precision * recall / (precision + recall) if hit else 0.0, actual)
    return out


def same_report(report, pairs):
    got = {r["label"]: (r["precision"], r["recall"], r["f1"], r["support"]) for r in report.collect()}
    want = counted(pairs)
    return got.keys() == want.keys() and all(np.allclose(got[k], want[k]) for k in want)


def test_inputs_fill_code_and_name_their_columns(spark):
    inputs = features.Inputs(features.Number("a"), features.Number("b", 1.5), features.Category("c", "?"), features.Category("d", 9, {"x": 4}))
    df = spark.createDataFrame([(1.0, None, None, "x"), (None, 2.0, "u", "x"), (3.0, 2.0, "u", None)], "a double, b double, c string, d string")
    assert rows(inputs.ready(df)) == [(1.0, 1.5, "?", "x", 4), (3.0, 2.0, "u", None, 9)]
    assert inputs.names == ["a", "b", "c", "d"] and inputs.vector == ["a", "b", "c_code", "d_code"]


def test_logistic_probabilities_follow_the_coefficients(spark, sf):
    train, test = features.split(models.churn_rows(spark, sf), "customer_id")
    (model,) = churn.fit(train, churn.logistic_regression())
    scored = model.transform(test).select("prediction", vector_to_array("features").alias("x"), vector_to_array("probability")[1].alias("p")).collect()
    last = model.stages[-1]
    for r in scored:
        p = 1 / (1 + math.exp(-(float(np.dot(last.coefficients.toArray(), r.x)) + last.intercept)))
        assert math.isclose(r.p, p, abs_tol=1e-9) and r.prediction == (r.p > 0.5)


def test_churn_reports_equal_plain_counts(spark, sf):
    scored = models.ml05(spark, sf).collect()
    pairs = [(float(r.is_churn), r.prediction) for r in scored]
    assert same_report(models.ml06(spark, sf), pairs)
    overall = {r.measure: r.value for r in models.ml06_overall(spark, sf).collect()}
    assert math.isclose(overall["accuracy"], sum(a == p for a, p in pairs) / len(pairs))
    for a, p in set(pairs):
        assert overall[f"{int(a)} predicted as {int(p)}"] == pairs.count((a, p))
    found = models.ml07(spark, sf).collect()
    assert {r.feature for r in found} == set(churn.INPUTS.names) and math.isclose(sum(r.importance for r in found), 1)


def test_area_under_the_curve_counts_pairs_in_order(spark):
    draw = np.random.default_rng(5)
    scores = [(float(y), float(np.round(draw.normal(y), 1)) + 0.0) for y in draw.integers(0, 2, 300)]
    df = spark.createDataFrame([(y, (y > 0.5) * 1.0, [-s, s]) for y, s in scores], "label double, prediction double, raw array<double>")
    got = features.metrics(df.withColumn("rawPrediction", array_to_vector("raw")))
    up, down = ([s for y, s in scores if y == side] for side in (1, 0))
    want = sum((u > d) + 0.5 * (u == d) for u in up for d in down) / (len(up) * len(down))
    assert math.isclose(got["auc"], want, abs_tol=1e-9) and got["accuracy"] == 1


def test_fraud_report_equals_plain_counts(spark, sf):
    claims = t.claims(spark, sf)
    train, test = features.stratified_split(claims, "claim_id", "is_fraud")
    scored = fraud.score(test.filter("is_fraud IS NOT NULL"), fraud.train(train, trees=10))
    scored = scored.select(F.col("is_fraud").cast("double").alias("label"), "prediction")
    assert same_report(features.class_report(features.confusion(scored)), [tuple(r) for r in scored.collect()])


def test_clusters_are_of_the_nearest_mean(spark, sf):
    vectors = {r.vec_id: np.array(r.embedding, float) for r in t.table(spark, sf, "embeddings").filter("embedding IS NOT NULL").collect()}
    found = {r.vec_id: r.cluster for r in models.ml11(spark, sf).collect()}
    assert found and found.keys() <= vectors.keys()
    x, own = np.array([vectors[i] for i in found]), np.array(list(found.values()))
    means = np.array([x[own == c].mean(0) for c in range(3)])
    nearest = ((x[:, None] - means) ** 2).sum(2).argmin(1)
    assert (nearest == own).mean() > 0.97  # rounds end after 20


def test_forest_of_many_classes_counts_its_accuracy(spark, sf):
    found = models.ml12(spark, sf).collect()
    (accuracy,) = {r.accuracy for r in found}
    assert math.isclose(accuracy, sum(r.label == r.prediction for r in found) / len(found))
    species = {r.vec_id: str(r.label) for r in t.table(spark, sf, "embeddings").collect()}
    names = sorted(set(species.values()))
    assert {r.vec_id: names[int(r.label)] for r in found} == {r.vec_id: species[r.vec_id] for r in found}
