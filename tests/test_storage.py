"""Sources and sinks on small files."""

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from millrace.plans import readings
from millrace.schemas import RECIPE_SCHEMA
from millrace.session import shared_dir
from millrace.sinks import files as out
from millrace.sinks import jdbc as jdbc_out
from millrace.sinks import tables as sink
from millrace.sinks.kafka import keyed_json
from millrace.sources import files as src
from millrace.sources import jdbc, kafka
from tests.conftest import rows


def test_csv_inference_and_positional_schema(spark, tmp_path):
    path = tmp_path / "t.csv"
    path.write_text("a,b\n1,x\n2,\n")
    assert dict(src.read_csv(spark, str(path)).dtypes) == {"a": "int", "b": "string"}
    declared = src.read_delimited(spark, str(path), src.literal_table(spark, [], "k string, v string").schema)
    assert rows(declared) == [("1", "x"), ("2", None)]


def test_read_or_build_only_catches_missing_paths(spark, tmp_path):
    built = src.read_or_build(spark, str(tmp_path / "none"), lambda: spark.range(3))
    assert built.count() == 3
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "x.parquet").write_text("not parquet")
    with pytest.raises(Exception) as error:
        src.read_or_build(spark, str(tmp_path / "bad"), lambda: spark.range(3)).count()
    assert not (isinstance(error.value, AnalysisException) and error.value.getCondition() == "PATH_NOT_FOUND")


def test_multiline_documents(spark, tmp_path):
    docs = [{"id": 1, "name": "momo", "ingredients": ["flour", "meat"], "rating": 4.5}, {"id": 2, "name": "tea"}]
    (tmp_path / "r.json").write_text(json.dumps(docs, indent=1))
    out_df = src.read_json_docs(spark, str(tmp_path / "r.json"), RECIPE_SCHEMA)
    assert [(r.id, r.ingredients) for r in out_df.orderBy("id").collect()] == [(1, ["flour", "meat"]), (2, None)]


def test_readings_report_skips_nulls_and_empty_records(spark):
    df = spark.createDataFrame(
        [("k", (["2024-01-01T00:00", "2024-01-01T01:00", "2024-01-01T02:00"], [1.0, None, 2.5])), ("none", (["2024-01-01T00:00"], [None]))],
        "place string, hourly struct<time: array<string>, value: array<double>>",
    )
    (row,) = readings.report(df).collect()
    assert (row.place, row.date, row.min_value, row.max_value, row.avg_value, row.total_readings) == ("k", "2024-01-01", 1.0, 2.5, 1.75, 2)
    assert readings.zipped(df, ["place"]).count() == 4


def test_kafka_options():
    assert kafka.batch_options("b:9092", "user_events") == {
        "kafka.bootstrap.servers": "b:9092", "subscribe": "user_events", "startingOffsets": "earliest", "endingOffsets": "latest",
    }
    stream = kafka.stream_options("b:9092", "t", min_partitions=64, max_per_trigger=1000)
    assert (stream["startingOffsets"], stream["failOnDataLoss"], stream["minPartitions"]) == ("latest", "false", "64")


def test_jdbc_options():
    options = jdbc.read_options("jdbc:x", "claims", user="u", partition=("claim_date", "2024-01-01", "2024-12-31", 32))
    assert options["numPartitions"] == "32" and options["partitionColumn"] == "claim_date" and "password" not in options
    assert jdbc_out.append_options("jdbc:x", "claims", connections=8)["numPartitions"] == "8"


def test_keyed_json_carries_the_whole_row(spark):
    row = keyed_json(spark.createDataFrame([(1, "x")], "id int, v string"), "id").first()
    assert row.key == "1" and json.loads(row.value) == {"id": 1, "v": "x"}


def test_single_csv_file(spark, tmp_path):
    out.write_csv(spark.range(100).repartition(4), str(tmp_path / "c"), single=True)
    assert len(list((tmp_path / "c").glob("part-*.csv"))) == 1


def test_history_keeps_runs_and_replaces_a_repeated_one(spark, tmp_path):
    path = str(tmp_path / "h")
    out.append_history(spark.range(2), path, "2024-01-01 00:00:00")
    out.append_history(spark.range(3), path, "2024-01-02 00:00:00")
    out.append_history(spark.range(4), path, "2024-01-02 00:00:00")
    stored = spark.read.parquet(path)
    assert stored.count() == 6 and out.latest_history(stored).count() == 4


def test_merge_insert_skips_known_and_repeated_keys(spark):
    target = spark.createDataFrame([("a", 1)], "id string, n int")
    batch = spark.createDataFrame([("a", 9), ("b", 3), ("b", 2)], "id string, n int")
    assert rows(sink.merge_insert_new(target, batch, "id", [F.asc("n")])) == [("a", 1), ("b", 2)]


def test_upsert_replaces_whole_rows_and_survives_rerun(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "id string, n int, t string")
    batch = spark.createDataFrame([("a", 5, None), ("c", 7, "z")], "id string, n int, t string")
    once = sink.merge_upsert(target, batch, "id", [F.asc("n")])
    assert rows(once) == [("a", 5, None), ("b", 2, "y"), ("c", 7, "z")]
    assert rows(sink.merge_upsert(once, batch, "id", [F.asc("n")])) == rows(once)


def test_merges_leave_out_rows_without_a_key(spark):
    target = spark.createDataFrame([("a", 1), (None, 8)], "id string, n int")
    batch = spark.createDataFrame([("b", 3), (None, 4), (None, 5)], "id string, n int")
    once = sink.merge_insert_new(target, batch, "id", [F.asc("n")])
    assert rows(once) == rows(sink.merge_insert_new(once, batch, "id", [F.asc("n")]))
    assert once.filter("id IS NULL").count() == 1 and once.count() == 3
    merged = sink.merge_upsert(target, batch, "id", [F.asc("n")])
    assert merged.filter("id IS NULL").count() == 1 and merged.count() == 3
    assert rows(sink.merge_upsert(merged, batch, "id", [F.asc("n")])) == rows(merged)


def test_switch_table_reads_and_replaces_itself(spark):
    sink.switch_table(spark.range(3).withColumn("v", F.lit(1)), "switched")
    sink.switch_table(spark.table("switched").filter("id > 0"), "switched")
    assert rows(spark.table("switched").select("id")) == [(1,), (2,)]


def test_retention_keeps_unreadable_times(spark):
    df = spark.createDataFrame([("2023-01-01T00:00:00",), ("2024-01-31T00:00:00",), ("soon",), (None,)], "at string")
    kept = sink.delete_older_than(df, F.col("at").try_cast("timestamp_ntz"), "2024-02-01", 30)
    assert sorted(str(r.at) for r in kept.collect()) == ["2024-01-31T00:00:00", "None", "soon"]


def test_quarantine_splits_without_losing_rows(spark, tmp_path):
    df = spark.createDataFrame([(1, "OK"), (2, "bad"), (3, None)], "k int, reason string")
    for _ in range(2):  # a repeated run replaces its rows
        good = out.quarantine(df, "reason", str(tmp_path / "q"), run_id="r1")
    assert rows(good.select("k")) == [(1,)]
    assert spark.read.parquet(str(tmp_path / "q")).count() == 2


def test_nested_families_have_defaults(spark):
    df = spark.createDataFrame([("p", None, 3, None, 5)], "id string, cat string, l int, h int, w int")
    row = sink.nest_families(
        df, "id", {"info": {"category": F.coalesce("cat", F.lit("unknown")), "dimensions": sink.dimensions("l", "h", "w")}, "sales": {"total_sold": F.lit(0)}}
    ).first()
    assert (row.info.category, row.info.dimensions, row.sales.total_sold) == ("unknown", "3x0x5", 0)


def test_shared_dir_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.sparkContext.getConf().get("spark.checkpoint.dir")
