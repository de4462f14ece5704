"""What is learnt, against plain Python: decision lists and the graph of patterns and values."""

from math import log2

import numpy as np
import pytest

from millrace.llm import personal, quality


def holds(rule, row):
    return all((row[f] > at) == above for f, above, at in rule)


def n_bad(some):
    return sum(r["bad"] for r in some)


def plain_rules(given, most_rules=8, most_conditions=3, precision=0.95, least=5):
    """Sequential covering that tries every threshold of every feature on the rows themselves."""
    rules = []
    while len(rules) < most_rules:
        left, rule = [r for r in given if not any(holds(x, r) for x in rules)], []
        while len(rule) < most_conditions:
            grow, tried = [r for r in left if r["part"] < 2 and holds(rule, r)], []
            for f in quality.FEATURES:
                values = sorted({r[f] for r in grow})
                for a, b in zip(values, values[1:], strict=False):
                    for above in (True, False):
                        here = [r for r in grow if (r[f] > (a + b) / 2) == above]
                        if n_bad(here) >= least:
                            gain = n_bad(here) * (log2(n_bad(here) / len(here)) - log2(n_bad(grow) / len(grow)))
                            tried.append((gain, (f, above, (a + b) / 2), len(here) > n_bad(here)))
            gain, condition, mixed = max(tried, key=lambda x: x[0], default=(0, None, False))
            if gain <= 1e-9:
                break
            rule.append(condition)
            if not mixed:
                break
        if not rule:
            break
        worth = []
        for k in range(1, len(rule) + 1):
            here = [r for r in left if r["part"] == 2 and holds(rule[:k], r)]
            worth.append(((2 * n_bad(here) - len(here)) / max(1, len(here)), -k, n_bad(here), len(here)))
        _, k, bad, n = max(worth, key=lambda x: x[:2])
        if not bad or bad / n < precision:
            break
        rules.append(rule[:-k])  # k is below zero: shorter forms win ties
    return rules


@pytest.mark.parametrize("seed", [1, 2])
def test_decision_lists_equal_plain_covering(spark, seed):
    draw, names = np.random.default_rng(seed), list(quality.FEATURES)
    given = []
    for i in range(600):
        row = {f: int(draw.integers(0, 12)) * 10 for f in names}
        marked = (row[names[0]] > 80 and row[names[3]] <= 60) or row[names[4 + seed % 2]] > 100
        given.append(row | {"bad": int(marked or draw.random() < 0.01), "part": i % 3})
    schema = ", ".join(f"{n} int" for n in [*names, "bad", "part"])
    df = spark.createDataFrame([tuple(r[n] for n in [*names, "bad", "part"]) for r in given], schema)
    want = plain_rules(given)
    got = [[(c.feature, c.above, c.threshold) for c in rule] for rule in quality.learn(df)]
    assert got == want and len(want) >= 2 and max(map(len, want)) > 1


@pytest.mark.parametrize("rounds", [1, 3])
def test_worth_of_patterns_equals_a_plain_graph(spark, rounds):
    draw = np.random.default_rng(rounds)
    seeds = [(int(p), int(v), 3) for p, v in zip(draw.integers(0, 12, 150), draw.integers(0, 60, 150), strict=True)]
    met = {(int(p), int(v)): int(n) for p, v, n in zip(draw.integers(0, 12, 80), draw.integers(40, 120, 80), draw.integers(1, 9, 80), strict=True)}
    against = {p: int(draw.integers(0, 40)) for p in range(0, 12, 2)}

    edges = dict(met)
    for p, v, _ in seeds:
        edges[p, v] = edges.get((p, v), 0) + 1
    known = {v for _, v, _ in seeds}
    of_value = {v: float(v in known) for _, v in edges}
    for _ in range(rounds):
        worth = {}
        for p in {p for p, _ in edges}:
            own = [(v, n) for (q, v), n in edges.items() if q == p]
            worth[p] = sum(n * of_value[v] for v, n in own) / (sum(n for _, n in own) + against.get(p, 0) + 1)
        for v in of_value:
            if v not in known:
                of_value[v] = 1 - np.prod([1 - min(worth[p], 0.999) for p, u in edges if u == v])

    schema = "pattern long, run long, value long, n long"
    counted = [(p, 2, v, n) for (p, v), n in met.items()] + [(p, 2, None, n) for p, n in against.items()]
    scored = personal._score(spark.createDataFrame(seeds, "pattern long, value long, kind int"), spark.createDataFrame(counted, schema), rounds)
    got = {r["pattern"]: r["worth"] for r in scored.collect()}
    assert got.keys() == worth.keys() and all(abs(got[p] - worth[p]) < 1e-9 for p in got)
