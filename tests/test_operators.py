"""Edge-case rows for the relational operators."""

import datetime as dt

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from millrace.functions import dates, numbers
from millrace.operators import aggregates, encode, filters, joins, projections, quality, sets, sorting, windows
from millrace.operators.ordinal import with_ordinal
from millrace.operators.quantiles import quantiles
from millrace.operators.skew import salted_join, salted_outer_join
from tests.conftest import rows


def test_filter_optional_ignores_missing_values(spark):
    df = spark.createDataFrame([("A", True), ("B", False)], "s string, f boolean")
    assert filters.filter_optional(df, s=None, f=None).count() == 2
    assert rows(filters.filter_optional(df, upper=("s",), s="a", f=True)) == [("A", True)]
    assert filters.filter_optional(df, f=False).count() == 1


def test_lookup_of_absent_key_is_empty(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    assert filters.lookup(df, "k", 9).count() == 0
    assert filters.lookup(df, "k", 1).count() == 1


def test_search_treats_wildcards_as_text(spark):
    df = spark.createDataFrame([(1, "100% sure"), (2, "100 sure"), (3, None)], "i int, t string")
    found = filters.search_substring(df, "0% S", ["t"], [F.desc("i")], 10)
    assert [r.i for r in found.collect()] == [1]


def test_boosted_search_filters_ranks_and_drops_misses(spark):
    recipes = spark.createDataFrame(
        [
            (1, "Steamed momo", "dumpling", ["flour", "chicken"], 4.5),
            (2, "Chicken curry", "with momo", ["chicken"], 4.8),
            (3, "Tea", "hot", ["leaf"], 5.0),
        ],
        "id int, name string, description string, ingredients array<string>, rating double",
    )
    hits = filters.search_boosted(
        recipes, "momo", {"name": 3, "description": 2, "ingredients": 1}, [F.desc("rating"), F.desc("relevance")]
    )
    assert [(r.id, r.relevance) for r in hits.collect()] == [(2, 2.0), (1, 3.0)]
    by_ingredient = filters.search_boosted(
        recipes, "chicken", {"ingredients": 1}, [F.desc("rating")], F.col("rating") >= 4.6
    )
    assert [r.id for r in by_ingredient.collect()] == [2]


def test_tier_open_and_closed_edges(spark):
    df = spark.createDataFrame([(0.4,), (0.7,), (0.85,), (None,)], "s double")
    closed = projections.tier(F.col("s"), [(0.7, "HIGH"), (0.4, "MEDIUM")], "LOW", closed=True)
    opened = projections.tier(F.col("s"), [(0.85, "HIGH")], "MEDIUM")
    assert [r[0] for r in df.select(closed).collect()] == ["MEDIUM", "HIGH", "HIGH", "LOW"]
    assert [r[0] for r in df.select(opened).collect()] == ["MEDIUM"] * 4


def test_safe_ratio_with_zero_denominator(spark):
    df = spark.createDataFrame([(1.0, 0.0), (1.0, -2.0), (1.0, 4.0), (1.0, None)], "n double, d double")
    assert [r[0] for r in df.select(projections.safe_ratio(F.col("n"), F.col("d"))).collect()] == [0.0, 0.0, 0.25, 0.0]


def test_update_where_leaves_null_conditions(spark):
    df = spark.createDataFrame([("PENDING", 1), (None, 2)], "s string, i int")
    out = projections.update_where(df, F.col("s") == "PENDING", {"s": F.lit("DONE")})
    assert rows(out) == [("DONE", 1), (None, 2)]


def test_partial_update_keeps_fields_not_supplied(spark):
    base = spark.createDataFrame([(1, "a", 5), (2, "b", 6)], "k int, t string, p int")
    new = spark.createDataFrame([(1, None, 9)], "k int, t string, p int")
    assert rows(projections.partial_update(base, new, "k")) == [(1, "a", 9), (2, "b", 6)]


def test_sentiment_flattening_defaults(spark):
    nested = spark.createDataFrame(
        [(("positive", 0.5), None, None, None), (None, None, ["x"], 3)],
        "sentiment struct<label: string, compound: double>, title string, keywords array<string>, score int",
    )
    out = projections.flatten_sentiment(nested).collect()
    assert [(r.sentiment_label, r.sentiment_score, r.title, r.keywords, r.score) for r in out] == [
        ("positive", 0.5, "", [], 0),
        ("neutral", 0.0, "", ["x"], 3),
    ]


def test_outer_joins_keep_unmatched_and_null_keys(spark):
    staff = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "id int, name string")
    pay = spark.createDataFrame([(2, 10), (4, 20), (None, 30)], "id int, pay int")
    assert joins.inner(staff, pay, "id").count() == 1
    assert joins.left_outer(staff, pay, "id").count() == 3
    assert joins.right_outer(staff, pay, "id").count() == 3
    assert joins.full_outer(staff, pay, ["id"]).count() == 5


def test_beside_pairs_by_position(spark):
    a = spark.createDataFrame([(3, "c"), (1, "a"), (2, "b")], "x int, p string")
    b = spark.createDataFrame([(10, "t"), (5, "s")], "y int, q string")
    out = joins.beside(a, b, ["x"], ["y"])
    assert rows(out.select("ordinal", "p", "q")) == [(1, "a", "s"), (2, "b", "t"), (3, "c", None)]
    assert joins.beside(a, b, ["x"], ["y"], how="inner").count() == 2


def test_two_hops_excludes_self_and_friends(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (2, 1), (2, 4), (1, 4), (2, 3), (5, 1)], "src int, dst int")
    asked = spark.createDataFrame([(1,)], "src int")
    assert rows(joins.two_hops(edges, asked)) == [(1, 3)]


def test_with_ordinal_numbers_every_row_once(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5003).alias("v"))
    out = with_ordinal(df, ["v"]).collect()
    ordered = sorted(out, key=lambda r: r.ordinal)
    assert [r.ordinal for r in ordered] == list(range(1, 5001))
    assert [r.v for r in ordered] == sorted(r.v for r in out)


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join_with_a_hot_key(spark, how):
    big = spark.range(3000).select(
        "id", F.when(F.col("id") % 3 == 0, F.lit(7)).when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id") % 400).alias("k")
    )
    small = spark.range(300).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")).unionByName(
        spark.createDataFrame([(7, -1)], "k long, v long")
    )
    salted = salted_join(big, small, ["k"], salt_by=["id"], how=how, salts=8, share=0.01)
    plain = big.join(small, "k", how)
    assert rows(salted.select(*plain.columns)) == rows(plain)


@pytest.mark.parametrize("how", ["right", "full"])
def test_salted_outer_join_equals_plain_join(spark, how):
    big = spark.range(900).select("id", F.when(F.col("id") % 3 == 0, 7).when(F.col("id") == 1, None).otherwise(F.col("id")).alias("k"))
    small = spark.range(50).select((F.col("id") * 30).alias("k"), F.col("id").alias("v")).unionByName(
        spark.createDataFrame([(7, 1), (7, 2), (None, 3)], "k long, v long")
    )
    salted = salted_outer_join(big, small, ["k"], salt_by=["id"], how=how, salts=4, share=0.01)
    plain = big.join(small, "k", how)
    assert rows(salted.select(*plain.columns)) == rows(plain)


def test_quantiles_match_numpy(spark):
    values = [5.0, 1.0, 1.0, 9.0, 2.5, None, 4.0]
    df = spark.createDataFrame([("a", v) for v in values] + [("b", 3.0), (None, 8.0)], "g string, v double")
    want = np.percentile([v for v in values if v is not None], [10, 50, 90])
    found = {r.g: r for r in quantiles(df, "v", [0.1, 0.5, 0.9], ["g"]).collect()}
    assert set(found) == {"a", "b"}
    assert np.allclose([found["a"].p10, found["a"].p50, found["a"].p90], want)
    assert found["b"].p50 == 3.0


def test_quantiles_of_a_group_of_two_million_values(spark):
    df = spark.range(2_000_001).select(F.lit("g").alias("g"), (F.col("id") / 2).alias("v"))
    row = quantiles(df, "v", [0.25, 0.5], ["g"]).first()
    assert (row.p25, row.p50) == (250_000.0, 500_000.0)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-50, 50), min_size=1, max_size=60))
def test_sorted_quantiles_property(spark, values):
    df = spark.createDataFrame([(float(v),) for v in values], "v double")
    row = quantiles(df, "v", [0.25, 0.75]).first()
    assert np.allclose([row.p25, row.p75], np.percentile(values, [25, 75]))


def test_mode_prefers_the_smaller_value_on_a_tie(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), ("a",), (None,), (None,), (None,)], "v string")
    assert rows(aggregates.mode_value(df, "v")) == [("a", 2)]


def test_histogram_closes_the_last_bin_and_reports_empty_ones(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (10.0,), (None,)], "v double")
    out = [(r.bin, r.n) for r in aggregates.histogram(df, "v", 5).orderBy("bin").collect()]
    assert out == [(0, 2), (1, 0), (2, 0), (3, 0), (4, 1)]
    constant = spark.createDataFrame([(3.0,), (3.0,)], "v double")
    assert aggregates.histogram(constant, "v", 4).agg(F.sum("n")).first()[0] == 2


def test_empty_input_aggregates_to_zero(spark):
    empty = spark.createDataFrame([], "claim_amount double")
    out = aggregates.summarise(empty, [], n=F.count("*"), s=F.coalesce(F.sum("claim_amount"), F.lit(0.0)))
    assert rows(out) == [(0, 0.0)]


def test_revenue_skips_malformed_lines(spark):
    df = spark.createDataFrame([("p", "1.005", "1"), ("p", "x", "1"), ("p", None, "1"), ("q", "2", "")], "k string, a string, b string")
    assert rows(aggregates.revenue_by_key(df, "k", "a", "b")) == [("p", 2.01, 1)]


def test_pivot_fills_missing_cells(spark):
    df = spark.createDataFrame([("x", "A", 1), ("x", "A", 2), ("y", "B", 5)], "r string, c string, v int")
    assert rows(aggregates.pivot_sum(df, ["r"], "c", ["A", "B"], "v")) == [("x", 3, 0), ("y", 0, 5)]


def test_interleave_alternates_sources(spark):
    df = spark.createDataFrame([("a", i) for i in range(5)] + [("b", i) for i in range(2)], "s string, i int")
    out = windows.interleave(df, "s", [F.asc("i")], 6)
    assert [(r.s, r.i) for r in out.collect()] == [("a", 0), ("b", 0), ("a", 1), ("b", 1), ("a", 2), ("a", 3)]


def test_window_delta_counts_absent_windows_as_zero(spark):
    t0 = dt.datetime(2024, 1, 1)
    counts = spark.createDataFrame([(t0, "k", 3), (t0 + dt.timedelta(hours=2), "k", 1)], "window_start timestamp_ntz, keyword string, n long")
    out = {r.window_start.hour: (r.current_count, r.previous_count, r.trend_score) for r in windows.window_delta(counts, 60).collect()}
    assert out == {0: (3, 0, 3), 1: (0, 3, -3), 2: (1, 0, 1), 3: (0, 1, -1)}


def test_page_totals_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "a int")
    assert rows(sorting.page_totals(empty, 20)) == [(0, 1)]


def test_new_by_key_drops_blank_and_seen(spark):
    batch = spark.createDataFrame([("a", 1), ("a", 2), ("", 3), (None, 4), ("s", 5)], "id string, n int")
    seen = spark.createDataFrame([("s",), ("s",)], "id string")
    assert rows(sets.new_by_key(batch, "id", [F.asc("n")], seen)) == [("a", 1)]


def test_snapshot_changes_ignore_other_columns(spark):
    old = spark.createDataFrame([("x", "t1", "mon"), ("y", "t2", "mon")], "label string, text string, at string")
    same = spark.createDataFrame([("y", "t2", "tue"), ("x", "t1", "tue")], "label string, text string, at string")
    new = spark.createDataFrame([("x", "t9", "tue"), ("y", "t2", "tue")], "label string, text string, at string")
    keys = ["label", "text"]
    assert not sets.has_changed(same, old, keys)
    assert sets.has_changed(new, old, keys) and sets.has_changed(new, None, keys)
    assert rows(sets.snapshot_changes(new, old, keys)) == [("x", "t1", "removed"), ("x", "t9", "added")]


def test_bins_are_right_closed(spark):
    df = spark.createDataFrame([(0,), (30,), (31,), (45,), (100,), (101,), (None,)], "age int")
    out = df.select(numbers.cut(F.col("age"), [0, 30, 45, 100], ["Young", "Mid", "Senior"])).collect()
    assert [r[0] for r in out] == [None, "Young", "Mid", "Mid", "Senior", None, None]


def test_number_words_and_bad_numbers(spark):
    df = spark.createDataFrame([(" Thirty ",), ("41",), ("nan years",), (None,)], "a string")
    assert [r[0] for r in df.select(numbers.to_number(F.col("a"), numbers.AGE_WORDS, lower=True)).collect()] == [30.0, 41.0, None, None]


def test_mixed_dates(spark):
    df = spark.createDataFrame([("2020-01-15",), ("01/15/2020",), ("Jan 15, 2020",), ("2020.01.15",), ("soon",), ("",), (None,)], "d string")
    day = dt.date(2020, 1, 15)
    assert [r[0] for r in df.select(dates.parse_mixed_date(F.col("d"))).collect()] == [day] * 4 + [None] * 3


def test_epoch_to_iso_ignores_the_session_zone(spark):
    df = spark.createDataFrame([(1700000000,), (0,), (None,)], "t long")
    spark.conf.set("spark.sql.session.timeZone", "Asia/Kathmandu")
    try:
        assert [r[0] for r in df.select(dates.epoch_to_iso(F.col("t"))).collect()] == ["2023-11-14T22:13:20", "", ""]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_iqr_keeps_values_on_the_fence(spark):
    salaries = [20000, 25000, 27000, 30000, 32000, 35000, 40000, 1000000]
    df = spark.createDataFrame([(float(s),) for s in salaries], "v double")
    assert rows(quality.outliers(df, "v")) == [(1000000.0,)]
    assert quality.remove_outliers(df, ["v"]).count() == 7
    assert rows(quality.outliers_to_median(df, "v"))[-1] == (40000.0,)
    # Quartiles 26500 and 36250 put the upper fence at 50875.
    assert max(r.v for r in quality.winsorise(df, "v").collect()) == 50875.0
    edge = spark.createDataFrame([(v,) for v in (0.0, 1.0, 2.0, 3.0, 4.0, 6.0)], "v double")
    low, high, _ = quality.iqr_fences(edge, "v")
    assert edge.filter(F.col("v") <= high).filter(F.col("v") >= low).count() == 6


def test_fill_treats_blank_as_missing(spark):
    df = spark.createDataFrame([("", 1), (None, 2), ("x", 3)], "p string, i int")
    assert rows(quality.fill_constants(df, {"p": "unknown"}, ("p",))) == [("unknown", 1), ("unknown", 2), ("x", 3)]


def test_rules_count_nulls_as_broken(spark):
    df = spark.createDataFrame([(1.0,), (None,), (-1.0,)], "a double")
    assert rows(quality.violations(df, {"positive": F.col("a") > 0})) == [("positive", 2)]


def test_encoders(spark):
    df = spark.createDataFrame([(1, "B"), (2, "A"), (3, "C"), (4, None)], "i int, g string")
    assert rows(encode.one_hot(df, {"g": ["A", "B", "C"]})) == [(1, 1, 0), (2, 0, 0), (3, 0, 1), (4, 0, 0)]
    assert rows(encode.label_encode(df, "g", "code").select("i", "code")) == [(1, 1), (2, 0), (3, 2), (4, None)]
    vector = encode.one_hot_vector(df, "g", "v").orderBy("i").collect()
    assert [r.v.toArray().tolist() for r in vector] == [[0, 1, 0], [1, 0, 0], [0, 0, 1], [0, 0, 0]]
    many = spark.range(5000).select(F.concat(F.lit("k"), F.col("id")).alias("g"))
    assert encode.label_encode(many, "g", "code").agg(F.count_distinct("code"), F.max("code")).first()[:] == (5000, 4999)
    assert encode.one_hot_vector(many, "g", "v").first().v.size == 5000
    flat = spark.createDataFrame([(5.0,), (5.0,)], "x double")
    assert rows(encode.standardise(flat, ["x"])) == [(0.0,), (0.0,)]


def test_column_profiles(spark):
    df = spark.createDataFrame([(1, None), (2, "x")], "a int, b string")
    assert rows(quality.null_counts(df)) == [("a", 0), ("b", 1)]
    assert rows(quality.any_null(df)) == [("a", False), ("b", True)]
    assert rows(quality.shape(df)) == [(2, 2)]
    assert rows(quality.column_types(df)) == [("a", "int"), ("b", "string")]
    wide = spark.range(1, 10).select(F.col("id").alias("a"), (F.col("id") * F.col("id")).alias("b"))
    assert [(r.p25, r.p50, r.p75) for r in quality.describe(wide).orderBy("column").collect()] == [(3.0, 5.0, 7.0), (9.0, 25.0, 49.0)]
    described = quality.describe(df).first()
    assert (described["count"], described["p50"]) == (2, 1.5)
