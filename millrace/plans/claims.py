"""Insurance-claim jobs: validation, routing, fraud rules, scores and reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.operators import joins
from millrace.operators.filters import on_day, recent
from millrace.operators.projections import safe_ratio, tier, update_where

MAX_AMOUNT = 1_000_000
FRAUD_THRESHOLD = 0.7


def _now(as_of: str) -> Column:
    return F.expr(f"TIMESTAMP_NTZ'{as_of}'")


# --- cleaning and routing --------------------------------------------------


def valid_claims(df: DataFrame, ceiling: float = MAX_AMOUNT) -> DataFrame:
    """Stream-side rule: ids and amount present, 0 < amount < ceiling."""
    amount = F.col("claim_amount")
    return df.filter(
        F.col("claim_id").isNotNull()
        & F.col("patient_id").isNotNull()
        & F.col("hospital_id").isNotNull()
        & amount.isNotNull()
        & (amount > 0)
        & (amount < ceiling)
    )


REQUIRED = ["claim_id", "patient_id", "hospital_id", "claim_amount", "claim_date"]


def validate_claims(df: DataFrame, ceiling: float = MAX_AMOUNT) -> DataFrame:
    """Consumer-side rules in order, first failure wins; adds ``valid`` and ``reason``.

    An empty text or a zero counts as missing.
    """
    kinds = dict(df.dtypes)
    reason = None
    for name in REQUIRED:
        column = F.col(name)
        missing = column.isNull()
        if kinds[name] == "string":
            missing = missing | (column == "")
        elif not kinds[name].startswith(("timestamp", "date")):
            missing = missing | (column == 0)
        text = f"Missing required field: {name}"
        reason = F.when(missing, text) if reason is None else reason.when(missing, text)
    reason = (
        reason.when(F.col("claim_amount") <= 0, "claim_amount must be positive")
        .when(F.col("claim_amount") > ceiling, "claim_amount exceeds maximum threshold")
        .otherwise("OK")
    )
    return df.withColumn("reason", reason).withColumn("valid", F.col("reason") == "OK")


def route(df: DataFrame, threshold: float = FRAUD_THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Split into fraud (score at or above the threshold, or flagged) and the rest.

    A missing score counts as 0.
    """
    score = F.coalesce(F.col("fraud_score"), F.lit(0.0))
    is_hit = (score >= threshold) | F.coalesce(F.col("is_fraud"), F.lit(False))
    fraud = df.filter(is_hit).withColumns(
        {
            "alert_reason": F.lit("High fraud score detected by consumer"),
            "severity": F.when(score > 0.85, "HIGH").otherwise("MEDIUM"),
        }
    )
    return fraud, df.filter(~is_hit)


def enrich_claims(df: DataFrame, threshold: float = FRAUD_THRESHOLD) -> DataFrame:
    """Claim timestamp, approval ratio and risk flag; a missing score is LOW."""
    return df.withColumns(
        {
            "claim_date_ts": F.to_timestamp("claim_date"),
            "approval_ratio": safe_ratio(F.col("approved_amount"), F.col("claim_amount")),
            "risk_flag": tier(F.col("fraud_score"), [(threshold, "HIGH"), (0.4, "MEDIUM")], "LOW", closed=True),
        }
    )


def process_pending(df: DataFrame, as_of: str, older_than: str = "1 HOUR") -> DataFrame:
    """PENDING claims older than the interval become PROCESSED with a timestamp."""
    stale = (F.col("status") == "PENDING") & F.expr(
        f"claim_date < TIMESTAMP_NTZ'{as_of}' - INTERVAL {older_than}"
    )
    if "processed_date" not in df.columns:
        df = df.withColumn("processed_date", F.lit(None).cast("timestamp_ntz"))
    # The date is set first: the status test must see the old status.
    return update_where(
        update_where(df, stale, {"processed_date": _now(as_of)}), stale, {"status": F.lit("PROCESSED")}
    )


def resolve_old_alerts(alerts: DataFrame, as_of: str, older_than: str = "7 DAYS") -> DataFrame:
    """Open LOW and MEDIUM alerts older than the interval are resolved."""
    stale = (
        ~F.col("resolved")
        & F.expr(f"created_at < TIMESTAMP_NTZ'{as_of}' - INTERVAL {older_than}")
        & F.col("severity").isin("LOW", "MEDIUM")
    )
    return update_where(
        update_where(alerts, stale, {"resolved_at": _now(as_of)}), stale, {"resolved": F.lit(True)}
    )


# --- fraud rules -----------------------------------------------------------


def _alert_columns(score: Column, reason: str, kind: str, severity: Column) -> list[Column]:
    return [
        F.col("claim_id"),
        F.col("patient_id"),
        F.col("hospital_id"),
        score.alias("fraud_score"),
        F.lit(reason).alias("alert_reason"),
        F.lit(kind).alias("alert_type"),
        severity.alias("severity"),
    ]


def high_amount_alerts(
    claims: DataFrame, treatments: DataFrame, alerts: DataFrame, as_of: str, window: str = "6 HOURS"
) -> DataFrame:
    """Recent claims above three times their treatment's average cost, without an alert yet."""
    amount, cost = F.col("claim_amount"), F.col("avg_cost")
    costly = joins.lookup_literal(recent(claims, "claim_date", as_of, window), treatments, "treatment_code").filter(
        amount > cost * 3
    )
    fresh = joins.without_match(costly, alerts.select("claim_id"), "claim_id")
    return fresh.select(
        *_alert_columns(
            F.least(F.lit(0.99), amount / F.nullif(cost, F.lit(0.0)) * 0.1),
            "Claim amount exceeds 3x treatment average",
            "HIGH_AMOUNT",
            F.when(amount > cost * 5, "CRITICAL").otherwise("HIGH"),
        )
    )


def velocity_alerts(
    claims: DataFrame,
    alerts: DataFrame,
    as_of: str,
    count_window: str = "24 HOURS",
    window: str = "6 HOURS",
    more_than: int = 5,
) -> DataFrame:
    """Recent claims of patients with many claims in the counting window, without an alert yet."""
    busy = (
        recent(claims, "claim_date", as_of, count_window)
        .groupBy("patient_id")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > more_than)
        .select("patient_id")
    )
    hits = joins.having_match(recent(claims, "claim_date", as_of, window), busy, "patient_id")
    # One alert per claim: claim_id is the key of claims, a repeated row must not alert twice.
    fresh = joins.without_match(hits, alerts.select("claim_id"), "claim_id").dropDuplicates(["claim_id"])
    return fresh.select(
        *_alert_columns(
            F.lit(0.85),
            f"Patient submitted more than {more_than} claims in {count_window.lower()}",
            "UNUSUAL_PATTERN",
            F.lit("HIGH"),
        )
    )


def mark_fraud(claims: DataFrame, alerts: DataFrame) -> DataFrame:
    """Claims with an open HIGH or CRITICAL alert are flagged."""
    open_alerts = (
        alerts.filter(F.col("severity").isin("HIGH", "CRITICAL") & ~F.col("resolved"))
        .select("claim_id")
        .distinct()
    )
    return joins.update_from(claims, open_alerts, "claim_id", {"is_fraud": F.lit(True)})


# --- summaries and scores --------------------------------------------------


def cents(total: Column) -> Column:
    """A money sum, free of the noise that depends on the order of summing; 0 when empty."""
    return F.round(F.coalesce(total, F.lit(0.0)), 2)

def daily_summary(claims: DataFrame, day: str | None = None) -> DataFrame:
    """Six measures per claim date, for one day or all days."""
    rows = on_day(claims, "claim_date", day) if day else claims
    amount = cents(F.sum("claim_amount"))
    return rows.groupBy(F.to_date("claim_date").alias("summary_date")).agg(
        F.count(F.lit(1)).alias("total_claims"),
        amount.alias("total_amount"),
        F.count_if(F.col("insurance_status") == "APPROVED").alias("approved_claims"),
        F.count_if(F.col("insurance_status") == "DENIED").alias("denied_claims"),
        F.count_if(F.col("is_fraud")).alias("fraud_detected"),
        F.coalesce(amount / F.count("claim_amount"), F.lit(0.0)).alias("avg_claim_amount"),
    )


def patient_risk_recent(
    patients: DataFrame, claims: DataFrame, as_of: str, window: str = "30 DAYS", large: float = 50_000
) -> DataFrame:
    """Risk from recent claims; a patient without one keeps the stored score."""
    recent_risk = (
        recent(claims, "claim_date", as_of, window)
        .groupBy("patient_id")
        .agg(
            F.least(
                F.lit(1.0),
                F.count(F.lit(1)) * F.lit(0.01)
                + F.avg("fraud_score") * 0.6
                + F.when(F.avg("claim_amount") > large, 0.3).otherwise(0.0),
            ).alias("new_risk")
        )
    )
    return joins.update_from(patients, recent_risk, "patient_id", {"risk_score": F.col("src_new_risk")})


def patient_risk_weighted(patients: DataFrame, claims: DataFrame, large: float = 50_000, scale: float = 100_000) -> DataFrame:
    """Weighted risk over the whole claim history; no claims gives 0."""
    per_patient = claims.groupBy("patient_id").agg(
        F.round(
            F.least(
                F.least(F.count(F.lit(1)) / F.lit(20.0), F.lit(1.0)) * 0.15
                + F.coalesce(F.avg("fraud_score"), F.lit(0.0)) * 0.40
                + F.avg((F.col("insurance_status") == "DENIED").cast("double")) * 0.20
                + F.least(F.avg("claim_amount") / F.lit(float(scale)), F.lit(1.0)) * 0.10
                + F.avg((F.col("claim_amount") > large).cast("double")) * 0.10
                + F.when(F.bool_or(F.col("insurance_type") == "UNINSURED"), 0.05).otherwise(0.0),
                F.lit(1.0),
            ),
            4,
        ).alias("risk")
    )
    return patients.select("patient_id").join(per_patient, "patient_id", "left").select(
        "patient_id", F.coalesce(F.col("risk"), F.lit(0.0)).alias("risk_score")
    )


def hospital_performance(hospitals: DataFrame, claims: DataFrame, as_of: str, window: str = "30 DAYS") -> DataFrame:
    """100 minus fraud percent minus 20 times the denial rate, kept within 0..99."""
    n = F.count(F.lit(1))
    scores = (
        recent(claims, "claim_date", as_of, window)
        .groupBy("hospital_id")
        .agg(
            F.least(
                F.lit(99.0),
                F.greatest(
                    F.lit(0.0),
                    F.lit(100.0)
                    - F.count_if(F.col("is_fraud")) / n * 100
                    - F.count_if(F.col("insurance_status") == "DENIED") / n * 20,
                ),
            ).alias("perf_score")
        )
    )
    return joins.update_from(hospitals, scores, "hospital_id", {"performance_score": F.col("src_perf_score")})


def hospital_ranking(hospitals: DataFrame, claims: DataFrame, limit: int = 20) -> DataFrame:
    """Hospitals by score with their claim totals; claims are summed before the join."""
    totals = claims.groupBy("hospital_id").agg(
        F.count("claim_id").alias("total_claims"),
        cents(F.sum("claim_amount")).alias("total_amount"),
        F.sum(F.col("is_fraud").cast("int")).alias("fraud_count"),
    )
    return (
        hospitals.join(totals, "hospital_id", "left")
        .select(
            "hospital_id",
            "hospital_name",
            "state",
            F.coalesce("total_claims", F.lit(0)).alias("total_claims"),
            F.coalesce("total_amount", F.lit(0.0)).alias("total_amount"),
            F.coalesce("fraud_count", F.lit(0)).alias("fraud_count"),
            F.coalesce("performance_score", F.lit(0.0)).alias("performance_score"),
        )
        .orderBy(F.desc("performance_score"), F.asc("hospital_id"))
        .limit(limit)
    )


def breakdown(claims: DataFrame, key: str, limit: int | None = None) -> DataFrame:
    """Claims and amount per value of a column, largest group first."""
    out = (
        claims.groupBy(key)
        .agg(F.count("claim_id").alias("n"), cents(F.sum("claim_amount")).alias("total_amount"))
        .orderBy(F.desc("n"), F.asc(key))
    )
    return out if limit is None else out.limit(limit)


def platform_kpis(claims: DataFrame) -> DataFrame:
    """One row of platform totals; an empty table gives zeros."""
    total = F.count("claim_id")
    fraud = F.count_if(F.col("is_fraud"))
    return claims.agg(
        total.alias("total_claims"),
        F.round(F.coalesce(F.sum("claim_amount"), F.lit(0.0)), 2).alias("total_amount"),
        F.round(F.coalesce(F.avg("claim_amount"), F.lit(0.0)), 2).alias("avg_amount"),
        fraud.alias("fraud_count"),
        F.round(fraud / F.greatest(total, F.lit(1)) * 100, 2).alias("fraud_rate"),
        F.count_if(F.col("status") == "PENDING").alias("pending_claims"),
    )


def alert_stats(alerts: DataFrame) -> DataFrame:
    """Alert totals and resolution rate, in one row."""
    total, unresolved = F.count("alert_id"), F.count_if(~F.col("resolved"))
    return alerts.agg(
        total.alias("total_alerts"),
        unresolved.alias("unresolved"),
        F.round((total - unresolved) / F.greatest(total, F.lit(1)) * 100, 2).alias("resolution_rate"),
    )


def alert_groups(alerts: DataFrame) -> DataFrame:
    """Alerts per severity and per type, from one pass over the alerts."""
    pairs = F.explode(
        F.array(
            F.struct(F.lit("severity").alias("kind"), F.col("severity").alias("value")),
            F.struct(F.lit("type").alias("kind"), F.col("alert_type").alias("value")),
        )
    )
    return (
        alerts.select(pairs.alias("g"))
        .groupBy("g.kind", "g.value")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def weekly_totals(summary: DataFrame, as_of: str, days: int = 7) -> DataFrame:
    """Totals over the last days of the daily summary."""
    return summary.filter(F.expr(f"summary_date >= DATE'{as_of}' - INTERVAL {days} DAYS")).agg(
        F.sum("total_claims").alias("total_claims"),
        F.sum("total_amount").alias("total_amount"),
        F.sum("fraud_detected").alias("fraud_detected"),
        F.avg("avg_claim_amount").alias("avg_claim_amount"),
    )


def busiest_hospitals(claims: DataFrame, hospitals: DataFrame, as_of: str, window: str = "7 DAYS", k: int = 5) -> DataFrame:
    """Hospital names by recent claim count; claims are summed per hospital before the join."""
    per_id = (
        recent(claims, "claim_date", as_of, window)
        .groupBy("hospital_id")
        .agg(F.count(F.lit(1)).alias("n"), F.sum("claim_amount").alias("amount"))
    )
    return (
        per_id.join(hospitals.select("hospital_id", "hospital_name"), "hospital_id")
        .groupBy("hospital_name")
        .agg(F.sum("n").alias("claim_count"), cents(F.sum("amount")).alias("total"))
        .orderBy(F.desc("claim_count"), F.asc("hospital_name"))
        .limit(k)
    )


def high_risk_patients(patients: DataFrame, threshold: float = 0.7, limit: int = 50) -> DataFrame:
    return (
        patients.filter(F.col("risk_score") >= threshold)
        .orderBy(F.desc("risk_score"), F.asc("patient_id"))
        .limit(limit)
    )


def open_high_alerts(alerts: DataFrame, limit: int = 20) -> DataFrame:
    return (
        alerts.filter(F.col("severity").isin("HIGH", "CRITICAL") & ~F.col("resolved"))
        .orderBy(F.desc("fraud_score"), F.asc("alert_id"))
        .limit(limit)
    )
