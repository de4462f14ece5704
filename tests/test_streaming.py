"""Watermarks, windows, dedup across batches and replayed batches."""

import json

import pytest
from pyspark.sql import functions as F

from millrace.registry import all_queries
from millrace.sinks import streams
from millrace.streaming import flows
from tests.conftest import rows
from tools.check import TABLES

MESSAGE = "key string, value string"


def put(spark, folder, name, records):
    """One file of messages per call, in order."""
    lines = [(str(r.get("user_id") or r.get("claim_id") or r.get("id")), json.dumps(r)) for r in records]
    spark.createDataFrame(lines, MESSAGE).coalesce(1).write.mode("append").json(f"{folder}/{name}")


def source(spark, folder):
    return spark.readStream.schema(MESSAGE).option("maxFilesPerTrigger", 1).json(f"{folder}/*")


def event(user, kind, at):
    return {"user_id": user, "event_type": kind, "timestamp": f"2024-01-01T00:{at}", "page": "home"}


def test_windows_close_with_the_watermark_and_late_rows_are_dropped(spark, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "cp"))
    counts = lambda: flows.activity_counts(flows.parse_events(source(spark, inbox)))
    put(spark, inbox, "1", [event("u", "click", "00:01"), event("u", "click", "00:09"), event("u", "click", "00:10"), event(None, "click", "00:02")])
    assert rows(streams.drain(counts(), out, state)) == []
    put(spark, inbox, "2", [event("u", "click", "00:45")])
    streams.drain(counts(), out, state)
    put(spark, inbox, "3", [event("u", "click", "00:05"), event("v", "login", "01:30")])
    done = streams.drain(counts(), out, state)
    found = [(r.window_start.minute * 60 + r.window_start.second, r.user_id, r.event_count) for r in done.collect()]
    # 00:10 opens its own window; 00:05 came after the watermark had passed; 01:30 is still open.
    assert sorted(found) == [(0, "u", 2), (10, "u", 1), (40, "u", 1)]


def test_first_seen_holds_across_batches_and_drops_blank_ids(spark, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "cp"))

    def fresh():
        parsed = source(spark, inbox).select(F.from_json("value", "id string, at timestamp").alias("d")).select("d.*")
        return flows.first_seen(parsed, "id", "at", "1 hour")

    put(spark, inbox, "1", [{"id": "a", "at": "2024-01-01T00:00:00"}, {"id": "a", "at": "2024-01-01T00:01:00"}, {"id": "", "at": "2024-01-01T00:01:00"}])
    streams.drain(fresh(), out, state)
    put(spark, inbox, "2", [{"id": "a", "at": "2024-01-01T00:02:00"}, {"id": "b", "at": "2024-01-01T00:02:00"}])
    assert [r.id for r in streams.drain(fresh(), out, state).orderBy("id").collect()] == ["a", "b"]


CLAIMS = [
    {"claim_id": "1", "patient_id": "p", "hospital_id": "h", "claim_amount": 100.0, "approved_amount": 50.0, "fraud_score": 0.7, "claim_date": "2024-01-01T10:00:00"},
    {"claim_id": "2", "patient_id": "p", "hospital_id": "h", "claim_amount": 100.0, "approved_amount": 25.0, "fraud_score": 0.4, "claim_date": "2024-01-01T10:00:00"},
    {"claim_id": "3", "patient_id": "p", "hospital_id": "h", "claim_amount": 100.0, "fraud_score": None, "claim_date": "2024-01-01T10:00:00"},
    {"claim_id": "4", "patient_id": "p", "hospital_id": "h", "claim_amount": 0.0, "fraud_score": 0.9},
    {"claim_id": None, "patient_id": "p", "hospital_id": "h", "claim_amount": 5.0, "fraud_score": 0.9},
]


def test_claims_are_cleaned_and_split(spark, tmp_path):
    put(spark, str(tmp_path / "in"), "1", CLAIMS)
    batch = spark.read.schema(MESSAGE).json(str(tmp_path / "in/*"))
    cleaned = flows.clean_claims(batch)
    assert rows(cleaned.select("claim_id", "approval_ratio", "risk_flag")) == [
        ("1", 0.5, "HIGH"), ("2", 0.25, "MEDIUM"), ("3", None, "LOW"),
    ]
    assert rows(flows.fraud_side(cleaned).select("claim_id")) == [("1",)]
    assert rows(flows.validated_side(cleaned).select("claim_id")) == [("2",)]


def test_a_replayed_batch_does_not_repeat_rows(spark, tmp_path):
    put(spark, str(tmp_path / "in"), "1", CLAIMS)
    batch = flows.clean_claims(spark.read.schema(MESSAGE).json(str(tmp_path / "in/*")))
    write = streams.fan_out({"claims": flows.claim_rows, "alerts": flows.claim_alerts}, str(tmp_path / "out"))
    write(batch, 0)
    write(batch, 0)
    write(batch.limit(0), 1)
    assert spark.read.parquet(str(tmp_path / "out/claims")).count() == 3
    alert = spark.read.parquet(str(tmp_path / "out/alerts")).first()
    assert (alert.claim_id, alert.severity, alert.alert_type) == ("1", "HIGH", "ML_DETECTED")
    assert not (tmp_path / "out/claims/batch_id=1").exists()


def test_tables_of_a_batch_appear_together(spark, tmp_path):
    """A crash between two tables shows nothing of the batch; the replay shows all of it, once."""
    put(spark, str(tmp_path / "in"), "1", CLAIMS)
    batch = flows.clean_claims(spark.read.schema(MESSAGE).json(str(tmp_path / "in/*")))
    out, broken = str(tmp_path / "out"), [True]

    def alerts(rows_):
        if broken[0]:
            raise RuntimeError("lost")
        return flows.claim_alerts(rows_)

    write = streams.fan_out({"claims": flows.claim_rows, "alerts": alerts}, out)
    streams.fan_out({"claims": flows.claim_rows, "alerts": flows.claim_alerts}, out)(batch.limit(1), 0)
    with pytest.raises(RuntimeError, match="lost"):
        write(batch, 1)
    assert spark.read.parquet(f"{out}/claims").count() == 4  # there, but not committed
    assert streams.last_commit(spark, out) == 0 and streams.committed(spark, out, "claims").count() == 1
    broken[0] = False
    write(batch, 1)
    assert streams.last_commit(spark, out) == 1 and len(list((tmp_path / "out/commits").glob("[0-9]*"))) == 1
    assert streams.committed(spark, out, "claims").count() == 4 and streams.committed(spark, out, "alerts").count() == 2
    files = sorted(streams.committed(spark, out, "claims").inputFiles())
    write(batch, 1)  # replayed after its marker: left as it is
    assert sorted(streams.committed(spark, out, "claims").inputFiles()) == files
    with pytest.raises(ValueError, match="markers"):
        streams.fan_out({"commits": flows.claim_rows}, out)


def test_work_of_a_batch_does_not_grow_with_the_batches_before(spark, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "cp"))
    for i in range(50):
        lines = [(f"k{i}-{j}", "{}") for j in range(4)] + [("k0-0", "{}"), (f"k{max(0, i - 1)}-1", "{}"), ("", "{}")]
        spark.createDataFrame(lines, MESSAGE).coalesce(1).write.mode("append").json(f"{inbox}/{i:02}")
    query = flows.start_new_keys(source(spark, inbox).select(F.col("key").alias("id")), "id", out, state, trigger=None)
    query.awaitTermination()
    assert sorted(r.id for r in spark.read.parquet(out).collect()) == sorted(f"k{i}-{j}" for i in range(50) for j in range(4))
    batches = [p for p in query.recentProgress if p.numInputRows]
    assert len(batches) == 50 and {p.numInputRows for p in batches} == {6}  # blank keys are filtered in the source
    assert {p.stateOperators[0].numRowsUpdated for p in batches} == {4}  # keys stored by a batch are its own
    assert batches[-1].stateOperators[0].numRowsTotal == 200
    assert all("rocksdb" in str(p.stateOperators[0].customMetrics).lower() for p in batches[-1:])


def as_folders(spark, sf, tmp_path):
    """Every table as a folder of four part files."""
    for name in TABLES:
        spark.read.parquet(f"{sf}/{name}.parquet").repartition(4).write.parquet(str(tmp_path / f"{name}.parquet"))
    return str(tmp_path)


def test_streams_read_tables_in_folders(spark, sf, tmp_path):
    queries = {n: q for n, q in all_queries().items() if n.startswith("str") or n == "snk06_foreach_batch"}
    assert len(queries) >= 9
    folders = as_folders(spark, sf, tmp_path)
    for name, q in queries.items():
        if name != "str01_watermark":
            want = q.run(spark, sf).count()
            assert q.run(spark, folders).count() == want > 0, name
    assert rows(queries["str01_watermark"].run(spark, folders)) == rows(queries["str01_watermark"].run(spark, sf))


def test_new_keys_over_several_batches(spark, tmp_path):
    inbox, out, state = (str(tmp_path / n) for n in ("in", "out", "cp"))
    keys = lambda: source(spark, inbox).select(F.col("key").alias("id"))
    for name, ids in (("1", ["a", "b", "a", ""]), ("2", ["b", "c"]), ("3", ["a", "c", "d"])):
        put(spark, inbox, name, [{"id": i} for i in ids])
        flows.start_new_keys(keys(), "id", out, state, trigger=None).awaitTermination()
    assert rows(spark.read.parquet(out).select("id")) == [("a",), ("b",), ("c",), ("d",)]


def test_console_sink_prints_and_stops(spark, tmp_path):
    inbox = str(tmp_path / "in")
    put(spark, inbox, "1", [event("u", "purchase", "00:01")])
    found = flows.purchases(flows.parse_events(source(spark, inbox)))
    query = streams.console_sink(found, str(tmp_path / "cp"), trigger=None)
    query.awaitTermination()
    assert query.exception() is None


def test_article_messages_are_cleaned(spark):
    batch = spark.createDataFrame([("1", json.dumps({"id": "1", "title": "<b>Hi</b>  there", "content": "<p>x</p>"}))], MESSAGE)
    out = flows.clean_article_messages(batch).first()
    assert (out.title_clean, out.content_clean) == ("Hi there", "x") and out.processed_at is not None
