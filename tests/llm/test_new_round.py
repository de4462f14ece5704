"""Whitening, sketches and hard negatives against plain numpy and brute force."""

import random
from collections import Counter

import duckdb
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.llm import catalog, hard_negatives, hyperminhash, whitening
from tests.llm.conftest import by_id
from tests.llm.test_repeats import brute_components, repeated_texts, table

VECTORS = "vec_id long, embedding array<double>, label int"


# --- whitening ---


def integers(rows):
    return {i: np.floor(64 * np.array(v)).astype(np.int64) + 1_000_000 for i, v, _ in rows}


def check_whitening(rows, got, k=16):
    x = integers(rows)
    fit = np.unique(np.array(list(x.values())), axis=0)
    n, sums = len(fit), fit.sum(0)
    covariance = np.cov(fit.T, bias=True)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:k], vectors[:, ::-1][:, :k]
    assert {r.component for r in got} == set(range(1, k + 1))
    assert len(got) == k * len(rows)
    assert {r.n for r in got} == {n}
    assert all(r.identity_error <= 1e-9 for r in got)
    for r in got:
        z = [int(v) for v in n * x[r.vec_id] - sums]
        assert r.deviation == sum(v * v for v in z)
        assert abs(r.explained - values[r.component - 1] / np.trace(covariance)) < 1e-12
    mine = {(r.vec_id, r.component): r.whitened for r in got}
    for c in range(k):
        want = np.array([(x[i] - sums / n) @ vectors[:, c] / np.sqrt(values[c]) for i, _, _ in rows])
        have = np.array([mine[i, c + 1] for i, _, _ in rows])
        assert min(np.abs(have - want).max(), np.abs(have + want).max()) < 1e-8


def test_components_of_given_vectors(spark, sf):
    given_ = [tuple(r) for r in spark.read.parquet(f"{sf}/embeddings.parquet").collect()]
    check_whitening(given_, catalog.op11_whitening(spark, sf).collect())


def test_fit_list_holds_each_vector_once(spark):
    draw = np.random.default_rng(3)
    base = draw.normal(size=(60, 20)) * np.linspace(4, 1, 20) + 7
    rows = [(i, [float(c) for c in base[i % 60 if i % 3 else 0]], 1) for i in range(180)]  # a third of all rows is one vector
    odd = [(900, None, 1), (901, [float("nan")] * 20, 1), (902, [None] * 20, 1), (903, [float("inf")] * 20, 1), (904, [], 1), (905, [1.0], 1)]
    extra = {c: F.lit("x") for c in ("x", "n", "deviation", "whitened", "row", "component")}
    df = spark.createDataFrame(rows + odd, VECTORS).withColumns(extra)
    check_whitening(rows, whitening.components(df).collect())
    repeated = spark.createDataFrame([*rows, rows[1], (None, rows[1][1], 2)], VECTORS)
    got = Counter((r.vec_id, r.component) for r in whitening.components(repeated).collect())
    assert got[1, 1] == 2 and got[None, 1] == 1


def test_few_vectors_have_few_components(spark):
    flat = spark.createDataFrame([(i, [float(i), 2.0 * i, 5.0], 0) for i in range(4)], VECTORS)
    got = whitening.components(flat).collect()
    assert {r.component for r in got} == {1} and len(got) == 4 and all(abs(r.explained - 1) < 1e-12 for r in got)
    assert whitening.components(spark.createDataFrame([(1, [1.0, 2.0], 0), (2, [1.0, 2.0], 0)], VECTORS)).count() == 0
    assert whitening.components(spark.createDataFrame([], VECTORS)).count() == 0


@settings(max_examples=30, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 70), st.integers(1, 16))
def test_subspace_iteration_finds_leading_pairs(seed, dim, k):
    draw = np.random.default_rng(seed)
    q = np.linalg.qr(draw.normal(size=(dim, dim)))[0]
    values = np.sort(draw.choice([0.0, 1.0, 1.0 + 1e-3, 2.0, 50.0, 1e4], dim) + draw.random(dim) * draw.choice([0, 1e-2]))[::-1] + 1e-3
    matrix = (q * values) @ q.T
    found, vectors, residuals = whitening.leading(lambda x: matrix @ x, dim, k)
    assert np.allclose(found, values[: min(k, dim)], rtol=1e-9, atol=1e-9 * values[0])
    assert residuals.max() <= whitening.LOOSE and np.allclose(vectors.T @ vectors, np.eye(len(found)), atol=1e-12)


@pytest.mark.parametrize(("seed", "dim", "k"), [(88959, 66, 1), (865110, 34, 9), (855253, 69, 10)])
def test_a_flat_part_wider_than_the_block(seed, dim, k):
    draw = np.random.default_rng(seed)
    q = np.linalg.qr(draw.normal(size=(dim, dim)))[0]
    values = np.sort(draw.choice([0.0, 1.0, 1.0 + 1e-3, 2.0, 50.0, 1e4], dim) + draw.random(dim) * draw.choice([0, 1e-2]))[::-1] + 1e-3
    matrix = (q * values) @ q.T
    found, vectors, residuals = whitening.leading(lambda x: matrix @ x, dim, k)
    assert np.allclose(found, values[:k], rtol=1e-9, atol=1e-9 * values[0]) and residuals.max() <= whitening.LOOSE
    assert np.allclose(vectors.T @ vectors, np.eye(k), atol=1e-12)


def test_large_entries_stay_exact(spark):
    rows = [(i, [1e9 * i, -3e9 * (i % 3), 0.5 * i], 0) for i in range(5)]
    df = spark.createDataFrame(rows, VECTORS)
    model, _ = whitening.fit(df, 2)
    x = integers(rows)
    sums = sum(v.astype(object) for v in x.values())
    got = {r.vec_id: int(r.deviation) for r in whitening.transform(df, model).collect()}
    assert got == {i: sum(int(d) ** 2 for d in 5 * v.astype(object) - sums) for i, v in x.items()}


# --- sketches ---


@pytest.mark.parametrize("seed", range(3))
def test_near_duplicates_against_brute_force(spark, seed, monkeypatch):
    monkeypatch.setattr(hyperminhash, "BLOCK", 4 if seed else 512)
    monkeypatch.setattr(hyperminhash, "ROUNDS", 1 + seed)
    made = dict(enumerate([*repeated_texts(seed, 120), "", None, "a", "A", "a b c", "a  b\nC", "a b c d"]))
    got = by_id(hyperminhash.near_duplicates(table(spark, list(made.values())), size=4, percent=80), "n_shingles", "component_id", "kept")
    want = brute_components(made, 4, 80)
    assert {i: x[:2] for i, x in got.items()} == want
    assert all(kept == (i == component) for i, (_, component, kept) in got.items())


def test_hot_groups_keep_every_link(spark, monkeypatch):
    """A third copies, a third near copies of one text, a third chained: each text differs a little more from the first."""
    monkeypatch.setattr(hyperminhash, "BLOCK", 8)
    draw = random.Random(5)
    words = [f"w{draw.randrange(10**6)}" for _ in range(120)]
    made = [" ".join(words)] * 40
    for _ in range(40):
        near = list(words)
        for _ in range(draw.randint(1, 6)):
            near[draw.randrange(120)] = f"n{draw.randrange(10**6)}"
        made.append(" ".join(near))
    chain = list(words[::-1])
    for i in range(40):
        chain[(3 * i) % 120] = f"c{i}"
        made.append(" ".join(chain))
    texts = dict(enumerate(made))
    got = by_id(hyperminhash.near_duplicates(table(spark, made), size=4, percent=80), "n_shingles", "component_id")
    assert got == brute_components(texts, 4, 80)
    assert {c for i, (_, c) in got.items() if i >= 80} == {80}  # linked only through each other


def test_odd_documents(spark, odd, none):
    got = hyperminhash.near_duplicates(odd, size=4).collect()
    assert len(got) == odd.count()
    sizes = Counter((r.doc_id, r.n_shingles, r.component_id) for r in got)
    assert sizes[4, 1, 4] == 2 and sizes[1, 0, 1] == sizes[2, 0, 2] == sizes[3, 0, 3] == 1 and sizes[8, 1, 8] == 1
    assert hyperminhash.near_duplicates(none).count() == 0
    with pytest.raises(ValueError, match="80 percent"):
        hyperminhash.near_duplicates(odd, percent=70)


def test_very_long_text(spark):
    long = " ".join(str(i * 7919 % 100_003) for i in range(400_000))  # some MB
    got = by_id(hyperminhash.near_duplicates(table(spark, [long, long + " more", "short"]), size=4), "n_shingles", "component_id")
    assert got[1][1] == 0 and got[2] == (1, 2)


def test_registers_compress_and_estimate():
    draw = np.random.default_rng(1)
    least = draw.integers(1, 2**63, 1000).astype(np.uint64) >> draw.integers(0, 40, 1000).astype(np.uint64)
    least = np.maximum(least, 1 << 12)
    got = hyperminhash.compress(least << np.uint64(1))
    for v, r in zip((least << np.uint64(1)).tolist(), got.tolist(), strict=True):
        top = v >> 11
        bits = top.bit_length()
        want = (53 - bits) << 10 | ((top << 10 >> (bits - 1)) & 1023 if bits else 0)
        assert r == want + 1
    for share in (0.3, 0.6, 0.8, 0.95):
        errors = []
        for _ in range(40):
            both = draw.integers(0, 2**63, int(2000 * share)).astype(np.uint64)
            one, two = (draw.integers(0, 2**63, (2000 - len(both)) // 2).astype(np.uint64) for _ in range(2))
            h = np.concatenate([both, one, both, two])
            doc = np.repeat([0, 1], [len(both) + len(one), len(both) + len(two)])
            registers = hyperminhash.sketch(h, doc, 2)
            n = np.bincount(doc)
            errors.append(float(hyperminhash.similarity(np.array([(registers[0] != registers[1]).sum()]), n[0], n[1:])[0]) - share)
        assert abs(np.mean(errors)) < 0.02 and np.abs(errors).max() < 0.15


def test_small_sets_share_bands():
    """Sets of five and four of their shingles, the smallest with a similarity of 0.8 that differ."""
    draw = np.random.default_rng(2)
    for _ in range(300):
        h = draw.integers(0, 2**63, 5).astype(np.uint64)
        registers = hyperminhash.sketch(np.concatenate([h, h[:4]]), np.repeat([0, 1], [5, 4]), 2)
        assert registers.all()
        keys = hyperminhash.band_keys(registers)
        assert (keys[0] == keys[1]).any()


# --- hard negatives ---


def brute_negatives(rows):
    keep = {(i, lab, tuple(np.floor(256 * np.array(v, float)).astype(int).tolist())) for i, v, lab in rows}
    out = []
    for i, lab, v in keep:
        if i % 100:
            continue
        scored = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), j, other) for j, other, w in keep if j != i)
        for s, j, _ in [x for x in scored if x[2] == lab][:5]:
            found = [x for x in scored if x[2] != lab and 80 * -s <= 100 * -x[0] <= 100 * -s][:5]
            out += [(i, j, r, n, -s, -t) for r, (t, n, _) in enumerate(found, 1)]
    return sorted(out)


def mined(df):
    return sorted(tuple(r) for r in hard_negatives.hard_negatives(df, F.col("vec_id") % 100 == 0).collect())


@pytest.mark.parametrize("clusters", [0, 12])
def test_negatives_against_brute_force(spark, clusters, monkeypatch):
    for name, n in (("BLOCK", 5), ("SHARD", 20), ("PACK", 3), ("MEET", 2)):
        monkeypatch.setattr(hard_negatives, name, n)
    draw = np.random.default_rng(4)
    centres = draw.normal(size=(max(clusters, 1), 6)) * (1 if clusters else 0)
    rows = []
    for i in range(600):
        v = centres[i % len(centres)] + draw.normal(size=6) * 0.2
        rows.append((i, [float(np.float32(c)) for c in v], int(draw.integers(3)) if i % 3 else 0))
    df = spark.createDataFrame(rows, VECTORS)
    assert mined(df) == brute_negatives(rows)


def test_odd_vectors_and_hot_copies(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "SHARD", 64)
    draw = np.random.default_rng(6)
    one = [0.5, 0.25, -0.125]
    rows = [(i, one if i % 3 == 0 else [float(c) for c in draw.integers(-3, 4, 3) / 4], i % 2) for i in range(400)]
    odd = [(1000, None, 1), (1100, [0.1, None, 0.2], 1), (1200, [0.1, float("nan"), 0.2], 1), (1300, one, None), (None, one, 1), (1400, [], 0), (1500, [1.0], 0)]
    extra = {c: F.lit("x") for c in ("pack", "at", "slot", "shard", "rank", "v", "team", "zone", "anchor")}
    df = spark.createDataFrame([*rows, *rows[:50], *odd], VECTORS).withColumns(extra)
    assert mined(df) == brute_negatives(rows)
    assert mined(df.limit(0)) == []
    assert mined(spark.createDataFrame(rows[:1], VECTORS)) == []


def test_zone_maps_leave_blocks_unread(spark, monkeypatch):
    """In clusters far apart, few blocks of other labels can hold a score inside a window."""
    for name, n in (("BLOCK", 16), ("SHARD", 16), ("PACK", 8)):
        monkeypatch.setattr(hard_negatives, name, n)
    staged = {}
    real = hard_negatives.stage_table

    def keep(df, label):
        staged.setdefault(label, []).append(real(df, label))
        return staged[label][-1]

    monkeypatch.setattr(hard_negatives, "stage_table", keep)
    draw = np.random.default_rng(8)
    centres = draw.normal(size=(40, 8)) * 3
    rows = [(i, [float(c) for c in centres[i % 40] + draw.normal(size=8) * 0.05], i % 80 // 40) for i in range(3000)]
    df = spark.createDataFrame(rows, VECTORS)
    assert mined(df) == brute_negatives(rows)
    blocks, anchors = staged["shards"][0].count(), 30
    read = [sum(int(np.unpackbits(np.frombuffer(r.need, np.uint8).reshape(-1, 1), axis=1)[:, 0].sum()) for r in chosen.collect()) for chosen in staged["chosen"]]
    assert all(0 < n < 0.25 * blocks * anchors for n in read)


@given(st.integers(1, 4), st.integers(2, 3))
@settings(max_examples=12, deadline=None)
def test_curve_steps_are_neighbours(bits, dim):
    grid = np.stack(np.meshgrid(*[np.arange(1 << bits)] * dim, indexing="ij"), -1).reshape(-1, dim)
    order = sorted(range(len(grid)), key=[x.tobytes() for x in hard_negatives.hilbert(grid, bits)].__getitem__)
    assert (np.abs(np.diff(grid[order], axis=0)).sum(1) == 1).all()


@pytest.mark.parametrize("name", ["op7_jaccard", "op12_hyperminhash", "op13_hard_negatives"])
def test_queries_equal_their_sql(spark, sf, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    cursor = con.execute(catalog.ORACLE_SQL[name])
    columns = [c[0] for c in cursor.description]
    want = sorted(cursor.fetchall())
    got = catalog.QUERIES[name](spark, sf)
    assert sorted(got.columns) == sorted(columns)
    assert sorted(tuple(r) for r in got.select(*columns).collect()) == want
