"""Friend suggestions for everybody against brute force, with hubs and people who know many."""

import random
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from millrace.plans import activity

EDGES = "src long, dst long"


def brute(edges, k):
    knows = defaultdict(set)
    for a, b in edges:
        if a is not None and b is not None and a != b:
            knows[a].add(b)
    out = []
    for person, friends in knows.items():
        common = Counter(c for b in friends for c in knows.get(b, ()) if c != person and c not in friends)
        best = sorted(common.items(), key=lambda x: (-x[1], x[0]))[:k]
        out += [(person, c, n, i) for i, (c, n) in enumerate(best, 1)]
    return sorted(out)


def found(df):
    return sorted(tuple(r) for r in df.collect())


def hub_graph(seed, people=120, hubs=3, others=300):
    """A third of all edges touch one person; two more are hubs as well."""
    draw = random.Random(seed)
    edges = [(draw.randrange(people), draw.randrange(people)) for _ in range(others)]
    for h in range(hubs):
        edges += [(p, h) for p in range(people) if draw.random() < (0.9 if h == 0 else 0.3)]
        edges += [(h, p) for p in range(people) if draw.random() < (0.9 if h == 0 else 0.3)]
    return edges + edges[:20] + [(5, 5), (None, 1), (1, None)]


@pytest.mark.parametrize(("paths", "wide"), [(10**6, 1000), (200, 1000), (200, 8), (0, 4), (0, 1000)])
def test_everybody_gets_the_best(spark, paths, wide):
    edges = hub_graph(paths + wide)
    got = found(activity.friend_suggestions(spark.createDataFrame(edges, EDGES), 10, paths, wide))
    assert got == brute(edges, 10)


@pytest.mark.parametrize("task_paths", [1, 60, 2000])
@pytest.mark.parametrize(("paths", "wide"), [(10**6, 1000), (200, 8), (200, 1000)])
def test_people_with_many_paths_are_spread(spark, paths, wide, task_paths):
    edges = hub_graph(task_paths, people=40, others=100)
    got = found(activity.friend_suggestions(spark.createDataFrame(edges, EDGES), 4, paths, wide, task_paths))
    assert got == brute(edges, 4)


def test_tasks_follow_the_number_of_paths(spark):
    """Few links, many paths: no task counts many times its share, also of somebody who meets everybody."""
    draw = random.Random(7)
    links = {(a, b) for a in range(300) for b in draw.sample(range(300), 20)} | {(0, b) for b in range(300)} | {(a, 0) for a in range(300)}
    links = {(a, b) for a, b in links if a != b}
    df = spark.createDataFrame(sorted(links), EDGES)
    first, second = df.select("src", F.col("dst").alias("mid")), df.select(F.col("src").alias("mid"), "dst")
    counted = activity._two_step_counts(first, second, None, 500, piece=100)
    rows = counted.withColumn("task", F.spark_partition_id()).collect()
    knows = defaultdict(set)
    for a, b in links:
        knows[a].add(b)
    want = Counter((a, c) for a, b in links for c in knows[b])
    assert {(r.src, r.dst): r.common for r in rows} == want
    assert len(rows) == len(want)
    assert max(Counter(r.task for r in rows).values()) < 4 * 500
    assert len({r.task for r in rows if r.src == 0}) > 5


def test_paths_through_a_hub_are_not_built(spark):
    """2,000 people know one hub who knows them all: four million paths, of which few rows come to be."""
    n = 2000
    edges = [(p, 0) for p in range(1, n)] + [(0, p) for p in range(1, n)] + [(p, p + 1) for p in range(1, n - 1)]
    df = activity.friend_suggestions(spark.createDataFrame(edges, EDGES), 3, 10_000, 100)
    got = found(df)
    assert got == brute(edges, 3)
    plan = df._jdf.queryExecution().executedPlan()
    made = [int(str(m)) for m in _row_counts(plan)]
    assert made and max(made) < 30 * n


def _row_counts(node):
    """Rows made by the joins of a plan that has run."""
    if node.nodeName().startswith("AdaptiveSparkPlan"):
        yield from _row_counts(node.executedPlan())
        return
    if "QueryStage" in node.nodeName():
        yield from _row_counts(node.plan())
        return
    if "Join" in node.nodeName() and node.metrics().contains("numOutputRows"):
        yield node.metrics().apply("numOutputRows").value()
    children = node.children()
    for i in range(children.size()):
        yield from _row_counts(children.apply(i))


def test_nobody_without_paths(spark):
    assert activity.friend_suggestions(spark.createDataFrame([], EDGES)).count() == 0
    assert activity.friend_suggestions(spark.createDataFrame([(1, 2)], EDGES)).count() == 0
