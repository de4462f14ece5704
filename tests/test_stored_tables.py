"""Keyed and daily tables: what is rewritten, what is left alone, and what a repeated run does."""

import random
import uuid

import pytest
from pyspark.sql import functions as F

from millrace import session
from millrace.operators import projections
from millrace.sinks import daily, keyed, partitioned
from millrace.sinks import tables as sink
from tests.conftest import rows

ROW = "id long, n long, t string"


def name():
    return f"t_{uuid.uuid4().hex}"


def files(spark, table):
    return set(spark.table(table).inputFiles())


@pytest.fixture(scope="module")
def base(spark):
    return spark.range(4000).selectExpr("id", "id * 2 AS n", "CAST(id AS STRING) AS t").unionByName(spark.createDataFrame([(None, 1, "none"), (None, 2, "none")], ROW))


@pytest.fixture
def table(spark, base):
    made = name()
    keyed.create(base, made, "id", 64)
    return made


def test_a_small_upsert_rewrites_its_buckets_only(spark, base, table):
    draw = random.Random(1)
    batch = [(draw.randrange(8000), -i, None if i % 3 else "x") for i in range(20)] + [(None, 9, "z"), (5, 0, "first"), (5, 1, "second")]
    batch = spark.createDataFrame(batch, ROW)
    before = files(spark, table)
    assert len(before) == 64
    touched = keyed.upsert(spark, table, batch, [F.asc("n")])
    after = files(spark, table)
    assert len(before - after) == len(after - before) == len(touched) <= 22
    assert rows(keyed.read(spark, table)) == rows(sink.merge_upsert(base, batch, "id", [F.asc("n")]))
    assert keyed.upsert(spark, table, batch, [F.asc("n")]) == [] and files(spark, table) == after  # a repeated run changes nothing


def test_new_keys_are_added_without_rewriting(spark, base, table):
    batch = spark.createDataFrame([(3, 9, "known"), (9001, 2, "b"), (9001, 1, "a"), (None, 7, "x"), (9002, 5, None)], "id int, n long, t string")
    before = files(spark, table)
    assert keyed.insert_new(spark, table, batch, [F.asc("n")]) == 2
    after = files(spark, table)
    assert before <= after and 1 <= len(after - before) <= 2
    assert rows(keyed.lookup(spark, table, [3, 9001, 9002])) == [(3, 6, "3"), (9001, 1, "a"), (9002, 5, None)]
    assert keyed.insert_new(spark, table, batch, [F.asc("n")]) == 0 and files(spark, table) == after
    # Added files are seen, and kept, by the next merge of their bucket.
    keyed.upsert(spark, table, spark.createDataFrame([(9001, 8, "c")], ROW), [F.asc("n")])
    assert rows(keyed.lookup(spark, table, [9001, 9002])) == [(9001, 8, "c"), (9002, 5, None)]


def test_deletes_and_updates_touch_buckets_that_hold_a_match(spark, base, table):
    before = files(spark, table)
    gone = keyed.delete(spark, table, spark.createDataFrame([(7,), (8,), (70_000,), (None,)], "id long"))
    assert len(gone) <= 2 and len(before - files(spark, table)) == len(gone)
    assert keyed.read(spark, table).count() == base.count() - 2
    assert keyed.delete(spark, table, spark.createDataFrame([(7,)], "id long")) == []
    assert len(keyed.update_where(spark, table, F.col("t").isin("11", "12"), {"n": F.lit(-1)})) <= 2
    assert rows(keyed.lookup(spark, table, [11, 12, 13])) == [(11, -1, "11"), (12, -1, "12"), (13, 26, "13")]
    with pytest.raises(ValueError, match="cannot be set"):
        keyed.update_where(spark, table, F.lit(True), {"id": F.lit(1)})
    updates = spark.createDataFrame([(20, None, "new"), (21, 5, None), (-4, 1, "none")], ROW)
    assert len(keyed.partial_update(spark, table, updates)) <= 2
    want = projections.partial_update(base.filter("id IN (20, 21)"), updates, "id")
    assert rows(keyed.lookup(spark, table, [20, 21, -4])) == rows(want)


def test_a_bucket_may_become_empty_and_full_again(spark):
    made = name()
    keyed.create(spark.createDataFrame([(1, 1, "a")], ROW), made, "id", 8)
    keyed.delete(spark, made, spark.createDataFrame([(1,)], "id long"))
    assert keyed.read(spark, made).count() == 0 and partitioned.partitions(spark, made) == []
    keyed.upsert(spark, made, spark.createDataFrame([(1, 2, "b")], ROW), [F.asc("n")])
    assert rows(keyed.read(spark, made)) == [(1, 2, "b")]
    empty = name()
    keyed.create(spark.createDataFrame([], ROW), empty, "id", 8)
    assert keyed.upsert(spark, empty, spark.createDataFrame([], ROW), [F.asc("n")]) == [] and keyed.read(spark, empty).count() == 0


def test_lookups_read_one_bucket(spark, table):
    plan = keyed.lookup(spark, table, [5])._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_bucket" in plan and "PushedFilters: [IsNotNull(id), EqualTo(id,5)]" in plan
    assert len(keyed.lookup(spark, table, [5]).inputFiles()) == 1


def test_vacuum_deletes_only_what_no_partition_uses(spark, table):
    keyed.upsert(spark, table, spark.createDataFrame([(5, 0, "x")], ROW), [F.asc("n")])
    live, content = files(spark, table), rows(keyed.read(spark, table))
    assert partitioned.vacuum(spark, table) == 1 and partitioned.vacuum(spark, table) == 0
    assert files(spark, table) == live and rows(keyed.read(spark, table)) == content


HOURS = "SELECT id, TIMESTAMP_NTZ'2024-01-01 00:00:00' + make_dt_interval(0, id) AS at, id % 2 = 0 AS done FROM range(720) UNION ALL SELECT -1, NULL, TRUE"


def test_retention_drops_days_unread_and_rewrites_one(spark):
    made = name()
    events = spark.sql(HOURS)
    daily.create(events, made, F.col("at"))
    before = files(spark, made)
    out = daily.delete_older_than(spark, made, F.col("at"), "2024-01-20 06:00:00", 10)
    assert out == {"dropped": [f"2024-01-{d:02}" for d in range(1, 10)], "rewritten": ["2024-01-10"]}
    assert len(files(spark, made) - before) == 1 and len(before - files(spark, made)) == 10
    assert rows(daily.read(spark, made)) == rows(sink.delete_older_than(events, F.col("at"), "2024-01-20 06:00:00", 10))
    kept = files(spark, made)
    assert daily.delete_older_than(spark, made, F.col("at"), "2024-01-20 06:00:00", 10) == {"dropped": [], "rewritten": []}
    assert files(spark, made) == kept


@pytest.mark.parametrize("unit", ["day", "month"])
def test_retention_with_a_condition_keeps_the_other_rows(spark, unit):
    made = name()
    events = spark.sql(HOURS).withColumn("done", F.when(F.to_date("at") == "2024-01-03", False).when(F.to_date("at") == "2024-01-04", True).otherwise(F.col("done")))
    daily.create(events, made, F.col("at"), unit)
    out = daily.delete_older_than(spark, made, F.col("at"), "2024-01-06 00:00:00", 1, F.col("done"))
    if unit == "day":  # nothing of the 3rd goes, all of the 4th, half of the others
        assert out == {"dropped": ["2024-01-04"], "rewritten": ["2024-01-01", "2024-01-02"]}
    assert rows(daily.read(spark, made)) == rows(sink.delete_older_than(events, F.col("at"), "2024-01-06 00:00:00", 1, F.col("done")))


def test_only_own_folders_are_deleted(spark, tmp_path):
    staged = session.stage_table(spark.range(3), "mine")
    session.release(staged)
    with pytest.raises(ValueError, match="not a folder"):
        session.delete_folder(spark, str(tmp_path))
    with pytest.raises(ValueError, match="not a folder"):
        session.delete_folder(spark, f"{session.shared_dir(spark)}/millrace/../x")


def test_defaults_yield_to_what_is_set(spark):
    spark.sparkContext.getConf()
    given = session._unset(session.DEFAULTS)
    assert "spark.sql.session.timeZone" not in given  # the running session has it
    with session.settings(spark, {"spark.sql.shuffle.partitions": "3"}):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
    assert spark.conf.get("spark.sql.shuffle.partitions") == "8"
