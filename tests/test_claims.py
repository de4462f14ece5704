"""Claim rules on literal rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from millrace.plans import claims
from tests.conftest import rows

CLAIM = "claim_id string, patient_id string, hospital_id string, claim_amount double, claim_date timestamp_ntz"
DAY = dt.datetime(2024, 1, 10)


def test_stream_rule_excludes_the_bound_and_nulls(spark):
    df = spark.createDataFrame(
        [
            ("a", "p", "h", 1_000_000.0, None),
            ("b", "p", "h", 999_999.99, None),
            ("c", "p", "h", 0.0, None),
            ("d", "p", "h", -5.0, None),
            ("e", None, "h", 10.0, None),
            (None, "p", "h", 10.0, None),
            ("f", "p", None, 10.0, None),
            ("g", "p", "h", None, None),
        ],
        CLAIM,
    )
    assert [r.claim_id for r in claims.valid_claims(df).collect()] == ["b"]


@pytest.mark.parametrize(
    "row, reason",
    [
        (("a", "p", "h", 10.0, DAY), "OK"),
        (("a", "p", "h", 1_000_000.0, DAY), "OK"),
        (("a", "p", "h", 1_000_000.01, DAY), "claim_amount exceeds maximum threshold"),
        (("a", "p", "h", -1.0, DAY), "claim_amount must be positive"),
        (("a", "p", "h", 0.0, DAY), "Missing required field: claim_amount"),
        (("", "p", "h", 10.0, DAY), "Missing required field: claim_id"),
        (("", None, "h", 10.0, DAY), "Missing required field: claim_id"),
        (("a", "p", "h", 10.0, None), "Missing required field: claim_date"),
    ],
)
def test_consumer_rules_report_the_first_failure(spark, row, reason):
    out = claims.validate_claims(spark.createDataFrame([row], CLAIM)).first()
    assert (out.reason, out.valid) == (reason, reason == "OK")


def test_route_treats_a_missing_score_as_zero(spark):
    df = spark.createDataFrame(
        [("a", 0.7, False), ("b", 0.85, None), ("c", 0.86, False), ("d", None, True), ("e", None, None), ("f", 0.69, False)],
        "claim_id string, fraud_score double, is_fraud boolean",
    )
    fraud, rest = claims.route(df)
    assert rows(fraud.select("claim_id", "severity")) == [("a", "MEDIUM"), ("b", "MEDIUM"), ("c", "HIGH"), ("d", "MEDIUM")]
    assert rows(rest.select("claim_id")) == [("e",), ("f",)]


def test_pending_claims_older_than_the_interval(spark):
    df = spark.createDataFrame(
        [("a", "PENDING", DAY), ("b", "PENDING", DAY - dt.timedelta(hours=1)), ("c", "PENDING", DAY - dt.timedelta(hours=1, seconds=1)), ("d", "DONE", DAY - dt.timedelta(days=9))],
        "claim_id string, status string, claim_date timestamp_ntz",
    )
    out = claims.process_pending(df, str(DAY))
    assert rows(out.select("claim_id", "status", "processed_date")) == [
        ("a", "PENDING", None), ("b", "PENDING", None), ("c", "PROCESSED", DAY), ("d", "DONE", None),
    ]


def test_velocity_needs_more_than_five_and_alerts_once(spark):
    made = [(f"x{i}", "busy", "h", 1.0, DAY - dt.timedelta(hours=i)) for i in range(6)]
    made += [(f"y{i}", "calm", "h", 1.0, DAY - dt.timedelta(hours=i)) for i in range(5)]
    made.append(made[0])
    df = spark.createDataFrame(made, CLAIM)
    seen = spark.createDataFrame([("x1",)], "claim_id string")
    out = claims.velocity_alerts(df, seen, str(DAY))
    assert [r[0] for r in rows(out.select("claim_id"))] == ["x0", "x2", "x3", "x4", "x5"]


def test_high_amount_levels(spark):
    costs = spark.createDataFrame([("T", 100.0)], "treatment_code string, avg_cost double")
    df = spark.createDataFrame(
        [("a", "p", "h", 300.0, DAY, "T"), ("b", "p", "h", 301.0, DAY, "T"), ("c", "p", "h", 501.0, DAY, "T"), ("d", "p", "h", 9000.0, DAY, "T")],
        CLAIM + ", treatment_code string",
    )
    none = spark.createDataFrame([], "claim_id string")
    out = claims.high_amount_alerts(df, costs, none, str(DAY))
    assert [(r[0], round(r[1], 4), r[2]) for r in rows(out.select("claim_id", "fraud_score", "severity"))] == [
        ("b", 0.301, "HIGH"), ("c", 0.501, "CRITICAL"), ("d", 0.99, "CRITICAL"),
    ]


def _history(spark, rows_):
    return spark.createDataFrame(
        rows_, "patient_id string, fraud_score double, insurance_status string, claim_amount double, insurance_type string"
    )


def test_weighted_risk_bounds(spark):
    patients = spark.createDataFrame([("none",), ("low",), ("high",), ("max",)], "patient_id string")
    history = _history(
        spark,
        [("low", 0.1, "APPROVED", 1000.0, "PRIVATE")]
        + [("high", 0.8, "DENIED", 60_000.0, "PRIVATE")] * 5
        + [("max", 1.0, "DENIED", 200_000.0, "UNINSURED")] * 25,
    )
    risk = {r.patient_id: r.risk_score for r in claims.patient_risk_weighted(patients, history).collect()}
    assert risk["none"] == 0.0
    assert risk["low"] == round(1 / 20 * 0.15 + 0.1 * 0.4 + 0.01 * 0.1, 4)
    assert risk["low"] < risk["high"] < risk["max"] == 1.0


def test_recent_risk_keeps_patients_without_claims(spark):
    patients = spark.createDataFrame([("a", 0.2), ("b", 0.3)], "patient_id string, risk_score double")
    made = spark.createDataFrame(
        [("a", 0.5, 60_000.0, DAY)], "patient_id string, fraud_score double, claim_amount double, claim_date timestamp_ntz"
    )
    out = claims.patient_risk_recent(patients, made, str(DAY))
    assert [(r[0], round(r[1], 6)) for r in rows(out)] == [("a", 0.61), ("b", 0.3)]


def test_kpis_of_no_claims_are_zero(spark):
    empty = spark.createDataFrame([], "claim_id string, claim_amount double, is_fraud boolean, status string")
    assert rows(claims.platform_kpis(empty)) == [(0, 0.0, 0.0, 0, 0.0, 0)]
