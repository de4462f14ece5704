"""Plans of key queries: pushdown, pruning, group limits, no cartesian products, no Python where it is not needed."""

import pytest
from pyspark.sql import functions as F

from millrace.operators import windows
from millrace.registry import all_queries
from millrace.sources import tables as t
from tests.conftest import SMALL

QUERIES = all_queries()
EAGER = ("ml", "txt03", "txt04", "txt05", "str", "snk", "src0", "job30")


def plan(df):
    return df._jdf.queryExecution().toString()


def scans(text):
    return [line for line in text.split("== Physical Plan ==")[-1].splitlines() if "FileScan" in line]


def test_date_ranges_reach_the_scan(spark):
    for name in ("flt11_recent", "flt11_on_day", "job12_velocity_alerts"):
        text = plan(QUERIES[name].run(spark, SMALL))
        assert "GreaterThanOrEqual(o_orderdate" in text, name


def test_equality_reaches_the_scan_and_columns_are_pruned(spark):
    (scan,) = scans(plan(QUERIES["flt01_filter_eq"].run(spark, SMALL)))
    assert "EqualTo(o_orderstatus,F)" in scan
    assert "o_orderpriority" not in scan.split("ReadSchema:")[1] and "o_orderdate" not in scan.split("ReadSchema:")[1]


def test_two_column_aggregate_reads_two_columns(spark):
    (scan,) = scans(plan(QUERIES["agg06_having"].run(spark, SMALL)))
    assert scan.split("ReadSchema:")[1].count(":") == 1


def test_groups_are_limited_before_the_shuffle(spark):
    text = plan(QUERIES["win03_top_n_per_group"].run(spark, SMALL))
    assert text.count("WindowGroupLimit") >= 2
    assert "Partial" in text


def test_top_k_is_not_a_full_sort(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["srt01_top_k"].run(spark, SMALL))


def test_item_totals_share_the_shuffle_of_the_order_join(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(QUERIES["job03_monthly_trend"].run(spark, SMALL)).split("== Physical Plan ==")[-1]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # Items and orders once each by order, then the monthly groups; sorting adds a range exchange.
    assert text.count("Exchange hashpartitioning(order_id") == 2


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(EAGER)])
def test_no_cartesian_products_or_row_python(spark, name):
    text = plan(QUERIES[name].run(spark, SMALL))
    assert "CartesianProduct" not in text
    assert "BatchEvalPython" not in text
    assert "BroadcastNestedLoopJoin" not in text


def test_windows_over_raw_rows_always_have_keys(spark):
    df = windows.percent_of_total(t.orders(spark, SMALL), ["order_status"])
    assert "SinglePartition" not in plan(df.select(F.col("order_status"), F.col("n")))
