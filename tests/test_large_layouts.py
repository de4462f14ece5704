"""Deep pages, stored snapshots, wide correlations and joint k-means starts: results and what they read."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.clustering import KMeans
from pyspark.sql import functions as F

from millrace.ml import simple
from millrace.operators import aggregates, sets, snapshots, sorting
from tests.conftest import rows


def files_read(df):
    """Files that the scans of a plan have read."""
    df.collect()

    def walk(node):
        name = node.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return walk(node.executedPlan())
        if "QueryStage" in name:
            return walk(node.plan())
        own = node.metrics().apply("numFiles").value() if node.metrics().contains("numFiles") else 0
        children = node.children()
        return own + sum(walk(children.apply(i)) for i in range(children.size()))

    return walk(df._jdf.queryExecution().executedPlan())


# --- pages


@pytest.fixture(scope="module")
def shuffled(spark):
    return spark.range(40_000).selectExpr("(id * 7919) % 40000 AS k", "id % 10 AS g").repartition(5)


def test_pages_are_those_of_the_sorted_rows(spark, shuffled):
    order = [F.desc("g"), F.asc("k")]
    want = sorted(((r.k, r.g) for r in shuffled.collect()), key=lambda r: (-r[1], r[0]))
    pages = sorting.paged(shuffled, order, 8)
    assert pages.totals(100) == (40_000, 400) and len(pages.parts) > 3
    edges = {s // 100 + 1 for s in pages.starts}  # pages over the end of a range
    for number in {1, 2, 137, 400} | edges:
        assert [tuple(r) for r in pages.page(number, 100).collect()] == want[(number - 1) * 100 : number * 100]
    assert pages.page(401, 100).count() == 0
    assert [tuple(r) for r in pages.page(2, 30_000).collect()] == want[30_000:]
    for number in (1, 3, 250):  # near the front and deep: one function, the same rows
        assert [tuple(r) for r in sorting.page(shuffled, order, number, 100).collect()] == want[(number - 1) * 100 : number * 100]


def test_a_deep_page_reads_its_ranges_only(spark, shuffled):
    pages = sorting.paged(shuffled, [F.asc("k")], 8)
    page = pages.page(300, 100)
    plan = page._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_part" in plan or "PartitionFilters: [isnotnull(_part" in plan
    assert "GreaterThanOrEqual(_place" in plan
    assert 1 <= files_read(page) <= 2 < len(pages.parts)
    assert sorting.paged(shuffled.limit(0), [F.asc("k")]).totals(10) == (0, 1)
    assert sorting.paged(shuffled.limit(0), [F.asc("k")]).page(1, 10).count() == 0


# --- snapshots

SNAP = "a long, b string, c double"


def test_equal_snapshots_compare_by_hashes_alone(spark, tmp_path):
    made = [(i % 300, f"x{i % 7}" if i % 11 else None, float(i % 300)) for i in range(2000)]
    df = spark.createDataFrame(made, SNAP)
    old, new = str(tmp_path / "old"), str(tmp_path / "new")
    snapshots.store(df.repartition(3), old, ["a", "b", "c"], 128)
    snapshots.store(df.orderBy(F.desc("b")).union(df.limit(50)), new, ["a", "b", "c"], 128)
    assert snapshots.differing_buckets(spark, new, old) == [] and not snapshots.has_changed(spark, new, old)
    assert snapshots.changes(spark, new, old).count() == 0
    assert snapshots.has_changed(spark, new, None)
    # Rows are not read: without them the answer is the same.
    for f in (tmp_path / "new/rows").rglob("*.parquet"):
        f.write_bytes(b"")
    assert not snapshots.has_changed(spark, new, old)


def test_changes_are_found_in_their_buckets(spark, tmp_path):
    draw = random.Random(3)
    before = [(i, f"x{i}", draw.random() if i % 9 else None) for i in range(5000)] + [(None, None, None)]
    after = before[10:] + [(9, "x9", None), (-1, None, 1.0), (None, "n", None)]
    a, b = (spark.createDataFrame(x, SNAP) for x in (after, before))
    old, new, none = (str(tmp_path / n) for n in ("old", "new", "none"))
    snapshots.store(b, old, ["a", "b", "c"], 512)
    snapshots.store(a, new, ["a", "b", "c"], 512)
    snapshots.store(b.limit(0), none, ["a", "b", "c"], 512)
    assert 1 <= len(snapshots.differing_buckets(spark, new, old)) <= 12
    found = snapshots.changes(spark, new, old)
    assert rows(found) == rows(sets.snapshot_changes(a, b, ["a", "b", "c"]))
    assert files_read(found) <= 24
    assert snapshots.changes(spark, old, none).count() == b.distinct().count()
    assert {r.change for r in snapshots.changes(spark, none, old).collect()} == {"removed"}


def test_values_that_swap_columns_differ(spark, tmp_path):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    snapshots.store(spark.createDataFrame([("x", None), ("y", None)], "a string, b string"), one, ["a", "b"], 4)
    snapshots.store(spark.createDataFrame([(None, "x"), (None, "y")], "a string, b string"), two, ["a", "b"], 4)
    assert snapshots.has_changed(spark, one, two)


# --- correlations


def test_two_hundred_columns_in_one_pass(spark):
    draw = np.random.default_rng(2)
    values = draw.normal(size=(300, 200)) @ draw.normal(size=(200, 200)) + 1e6 * np.arange(200)
    missing = draw.random(values.shape) < 0.1
    table = [[None if m else float(v) for v, m in zip(r, miss, strict=True)] for r, miss in zip(values, missing, strict=True)]
    df = spark.createDataFrame([(r,) for r in table], "v array<double>").select(*[F.col("v")[i].alias(f"c{i}") for i in range(200)])
    out = aggregates.correlations(df, df.columns)
    assert out._jdf.queryExecution().executedPlan().toString().count("Scan") <= 2  # the rows, and the diagonal
    got = {(r.column_a, r.column_b): r.r for r in out.collect()}
    assert len(got) == 200 * 201 // 2 and all(got[c, c] == 1 for c in df.columns)
    for _ in range(200):
        i, j = sorted(draw.choice(200, 2, replace=False).tolist())
        both = ~missing[:, i] & ~missing[:, j]
        assert math.isclose(got[f"c{i}", f"c{j}"], np.corrcoef(values[both, i], values[both, j])[0, 1], abs_tol=1e-9)


def test_correlations_without_spread(spark):
    made = [(1.0, 5.0, None, 1.0, None), (2.0, 5.0, None, 3.0, 1.0), (4.0, 5.0, 7.0, float("nan"), None), (8.0, 5.0, None, 9.0, 2.0)]
    df = spark.createDataFrame(made, "a double, flat double, one double, odd double, few double")
    got = {(r.column_a, r.column_b): r.r for r in aggregates.correlations(df, df.columns).collect()}
    assert got["a", "flat"] is None and got["a", "one"] is None and got["flat", "one"] is None
    assert math.isclose(got["a", "odd"], np.corrcoef([1, 2, 8], [1, 3, 9])[0, 1]) and math.isclose(got["a", "few"], 1.0)
    empty = aggregates.correlations(df.limit(0), ["a", "flat"])
    assert {(r.column_a, r.column_b): r.r for r in empty.collect()} == {("a", "flat"): None, ("a", "a"): 1.0, ("flat", "flat"): 1.0}
    assert rows(aggregates.correlations(df, ["a"])) == [("a", "a", 1.0)]


# --- k-means


def test_all_starts_advance_in_one_pass_a_round(spark, monkeypatch):
    draw = np.random.default_rng(7)
    centres = draw.normal(size=(6, 5)) * 4
    points = np.concatenate([c + draw.normal(size=(60, 5)) for c in centres])
    table = spark.createDataFrame([(i, *map(float, p)) for i, p in enumerate(points)], "id long, a double, b double, c double, d double, e double")
    held = simple.assemble(table, list("abcde"))
    passes = []
    real = simple._round
    monkeypatch.setattr(simple, "_round", lambda *a: passes.append(len(a[1])) or real(*a))
    model = simple.kmeans_fit(held, 6, starts=10)
    assert len(passes) <= 21 and passes[0] == passes[-1] == 10

    def cost(fitted):
        found = np.array(fitted.clusterCenters())
        return float(((points[:, None] - found[None]) ** 2).sum(2).min(1).sum())

    best = min(cost(KMeans(k=6, seed=42 + i).fit(held)) for i in range(10))
    assert cost(model) <= best * 1.001
    own = {r.id: r.prediction for r in model.transform(held).collect()}
    nearest = ((points[:, None] - np.array(model.clusterCenters())[None]) ** 2).sum(2).argmin(1)
    assert [own[i] for i in range(len(points))] == nearest.tolist()


def test_fewer_different_points_than_clusters(spark):
    df = simple.assemble(spark.createDataFrame([(1.0,), (1.0,), (2.0,)], "a double"), ["a"])
    assert sorted({float(c[0]) for c in simple.kmeans_fit(df, 3, starts=2).clusterCenters()}) == [1.0, 2.0]
    with pytest.raises(ValueError, match="no row"):
        simple.kmeans_fit(df.limit(0), 2)
