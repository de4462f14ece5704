"""Claim reports, fraud rules and scores over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.views import over
from millrace.plans import claims
from millrace.registry import query
from millrace.sources import tables as t

DAILY_SQL = """SELECT CAST(claim_date AS DATE) AS summary_date, count(*) AS total_claims,
    round(coalesce(sum(claim_amount), 0), 2) AS total_amount,
    count(*) FILTER (insurance_status = 'APPROVED') AS approved_claims,
    count(*) FILTER (insurance_status = 'DENIED') AS denied_claims, count(*) FILTER (is_fraud) AS fraud_detected,
    round(coalesce(sum(claim_amount), 0), 2) / count(*) AS avg_claim_amount FROM claims_v"""


@query("job10_daily_summary", over("claims_v", f"{DAILY_SQL} GROUP BY 1"))
def job10(spark, sf):
    return claims.daily_summary(t.claims(spark, sf))


@query(
    "job10_daily_summary_one_day",
    over("claims_v", f"{DAILY_SQL} WHERE CAST(claim_date AS DATE) = DATE '1998-10-03' GROUP BY 1"),
)
def job10_day(spark, sf):
    return claims.daily_summary(t.claims(spark, sf), "1998-10-03")


HIGH_SQL = """SELECT claim_id, patient_id, hospital_id, least(0.99::DOUBLE, claim_amount / nullif(avg_cost, 0) * 0.1::DOUBLE) AS fraud_score,
    'Claim amount exceeds 3x treatment average' AS alert_reason, 'HIGH_AMOUNT' AS alert_type,
    CASE WHEN claim_amount > avg_cost * 5 THEN 'CRITICAL' ELSE 'HIGH' END AS severity
  FROM claims_v c JOIN treatments_v USING (treatment_code)
  WHERE claim_amount > avg_cost * 3 AND claim_date >= TIMESTAMP '2001-08-01' - INTERVAL 30 DAY
    AND NOT EXISTS (SELECT 1 FROM alerts_v a WHERE a.claim_id = c.claim_id)"""


@query("job11_high_amount_alerts", over("claims_v treatments_v alerts_v", HIGH_SQL))
def job11(spark, sf):
    return claims.high_amount_alerts(
        t.claims(spark, sf), t.treatments(spark), t.alerts(spark, sf), t.CLAIMS_AS_OF, "30 DAYS"
    )


@query(
    "job12_velocity_alerts",
    over(
        "claims_v alerts_v",
        """SELECT claim_id, patient_id, hospital_id, 0.85::DOUBLE AS fraud_score,
                  'Patient submitted more than 3 claims in 365 days' AS alert_reason, 'UNUSUAL_PATTERN' AS alert_type,
                  'HIGH' AS severity
           FROM claims_v c
           WHERE patient_id IN (SELECT patient_id FROM claims_v WHERE claim_date >= TIMESTAMP '2001-08-01' - INTERVAL 365 DAY
                                GROUP BY patient_id HAVING count(*) > 3)
             AND claim_date >= TIMESTAMP '2001-08-01' - INTERVAL 30 DAY
             AND NOT EXISTS (SELECT 1 FROM alerts_v a WHERE a.claim_id = c.claim_id)""",
    ),
)
def job12(spark, sf):
    return claims.velocity_alerts(
        t.claims(spark, sf), t.alerts(spark, sf), t.CLAIMS_AS_OF, count_window="365 DAYS", window="30 DAYS", more_than=3
    )


@query(
    "job13_mark_fraud",
    over(
        "claims_v alerts_v",
        """SELECT claim_id, is_fraud OR claim_id IN (SELECT claim_id FROM alerts_v
                    WHERE severity IN ('HIGH', 'CRITICAL') AND NOT resolved) AS is_fraud FROM claims_v""",
    ),
)
def job13(spark, sf):
    return claims.mark_fraud(t.claims(spark, sf), t.alerts(spark, sf)).select("claim_id", "is_fraud")


@query(
    "job14_patient_risk_recent",
    over(
        "claims_v patients_v",
        """WITH r AS (SELECT patient_id, least(1.0::DOUBLE, count(*) * 0.01::DOUBLE + avg(fraud_score) * 0.6::DOUBLE
                             + CASE WHEN avg(claim_amount) > 400000 THEN 0.3::DOUBLE ELSE 0 END) AS risk
                      FROM claims_v WHERE claim_date >= TIMESTAMP '2001-08-01' - INTERVAL 30 DAY GROUP BY patient_id)
           SELECT p.patient_id, p.state, round(coalesce(r.risk, p.risk_score), 8) AS risk_score
           FROM patients_v p LEFT JOIN r ON p.patient_id = r.patient_id""",
    ),
)
def job14(spark, sf):
    out = claims.patient_risk_recent(t.patients(spark, sf), t.claims(spark, sf), t.CLAIMS_AS_OF, large=400_000)
    return out.select("patient_id", "state", F.round("risk_score", 8).alias("risk_score"))


@query(
    "job15_patient_risk_weighted",
    over(
        "claims_v patients_v",
        """WITH r AS (SELECT patient_id, least(
                 least(count(*) / 20.0::DOUBLE, 1.0::DOUBLE) * 0.15::DOUBLE + coalesce(avg(fraud_score), 0) * 0.40::DOUBLE
                 + avg(CASE WHEN insurance_status = 'DENIED' THEN 1.0::DOUBLE ELSE 0 END) * 0.20::DOUBLE
                 + least(avg(claim_amount) / 500000.0::DOUBLE, 1.0::DOUBLE) * 0.10::DOUBLE
                 + avg(CASE WHEN claim_amount > 400000 THEN 1.0::DOUBLE ELSE 0 END) * 0.10::DOUBLE
                 + CASE WHEN bool_or(insurance_type = 'UNINSURED') THEN 0.05::DOUBLE ELSE 0 END, 1.0::DOUBLE) AS risk
               FROM claims_v GROUP BY patient_id)
           SELECT p.patient_id, round(coalesce(risk, 0), 4) AS risk_score FROM patients_v p LEFT JOIN r ON p.patient_id = r.patient_id""",
    ),
)
def job15(spark, sf):
    return claims.patient_risk_weighted(t.patients(spark, sf), t.claims(spark, sf), large=400_000, scale=500_000)


@query(
    "job16_hospital_performance",
    over(
        "claims_v hospitals_v",
        """WITH s AS (SELECT hospital_id, least(99.0::DOUBLE, greatest(0.0::DOUBLE, 100.0::DOUBLE
                    - count(*) FILTER (is_fraud)::DOUBLE / count(*) * 100
                    - count(*) FILTER (insurance_status = 'DENIED')::DOUBLE / count(*) * 20)) AS perf
                  FROM claims_v WHERE claim_date >= TIMESTAMP '2001-08-01' - INTERVAL 30 DAY GROUP BY hospital_id)
           SELECT h.hospital_id, h.hospital_name, round(coalesce(perf, performance_score), 8) AS performance_score
           FROM hospitals_v h LEFT JOIN s ON h.hospital_id = s.hospital_id""",
    ),
)
def job16(spark, sf):
    out = claims.hospital_performance(t.hospitals(spark, sf), t.claims(spark, sf), t.CLAIMS_AS_OF)
    return out.select("hospital_id", "hospital_name", F.round("performance_score", 8).alias("performance_score"))


@query(
    "job17_hospital_ranking",
    over(
        "claims_v hospitals_v",
        """SELECT h.hospital_id, hospital_name, state, count(claim_id) AS total_claims,
                  round(coalesce(sum(claim_amount), 0), 2) AS total_amount,
                  CAST(coalesce(sum(is_fraud::INT), 0) AS BIGINT) AS fraud_count, performance_score
           FROM hospitals_v h LEFT JOIN claims_v c ON h.hospital_id = c.hospital_id
           GROUP BY h.hospital_id, hospital_name, state, performance_score
           ORDER BY performance_score DESC, h.hospital_id LIMIT 20""",
    ),
)
def job17(spark, sf):
    return claims.hospital_ranking(t.hospitals(spark, sf), t.claims(spark, sf))


@query(
    "job18_diagnosis_breakdown",
    over(
        "claims_v",
        """SELECT diagnosis_code, count(claim_id) AS n, round(sum(claim_amount), 2) AS total_amount FROM claims_v
           GROUP BY diagnosis_code ORDER BY n DESC, diagnosis_code LIMIT 10""",
    ),
)
def job18(spark, sf):
    return claims.breakdown(t.claims(spark, sf), "diagnosis_code", 10)


@query(
    "job18_insurance_breakdown",
    over(
        "claims_v",
        """SELECT insurance_status, count(claim_id) AS n, round(sum(claim_amount), 2) AS total_amount FROM claims_v
           GROUP BY insurance_status""",
    ),
)
def job18_insurance(spark, sf):
    return claims.breakdown(t.claims(spark, sf), "insurance_status")


@query(
    "job19_platform_kpis",
    over(
        "claims_v",
        """SELECT count(*) AS total_claims, round(sum(claim_amount), 2) AS total_amount, round(avg(claim_amount), 2) AS avg_amount,
                  count(*) FILTER (is_fraud) AS fraud_count,
                  round(count(*) FILTER (is_fraud)::DOUBLE / greatest(count(*), 1) * 100, 2) AS fraud_rate,
                  count(*) FILTER (status = 'PENDING') AS pending_claims FROM claims_v""",
    ),
)
def job19(spark, sf):
    return claims.platform_kpis(t.claims(spark, sf))


@query(
    "job19_alert_stats",
    over(
        "alerts_v",
        """SELECT count(*) AS total_alerts, count(*) FILTER (NOT resolved) AS unresolved,
                  round((count(*) - count(*) FILTER (NOT resolved))::DOUBLE / greatest(count(*), 1) * 100, 2) AS resolution_rate
           FROM alerts_v""",
    ),
)
def job19_alerts(spark, sf):
    return claims.alert_stats(t.alerts(spark, sf))


@query(
    "job19_alerts_by_severity_and_type",
    over(
        "alerts_v",
        """SELECT 'severity' AS kind, severity AS value, count(*) AS n FROM alerts_v GROUP BY severity
           UNION ALL SELECT 'type', alert_type, count(*) FROM alerts_v GROUP BY alert_type""",
    ),
)
def job19_groups(spark, sf):
    return claims.alert_groups(t.alerts(spark, sf))


@query(
    "job20_weekly_totals",
    over(
        "claims_v",
        f"""WITH s AS ({DAILY_SQL} GROUP BY 1)
            SELECT CAST(sum(total_claims) AS BIGINT) AS total_claims, round(sum(total_amount), 2) AS total_amount,
                   CAST(sum(fraud_detected) AS BIGINT) AS fraud_detected, round(avg(avg_claim_amount), 6) AS avg_claim_amount
            FROM s WHERE summary_date >= DATE '2001-08-01' - INTERVAL 7 DAY""",
    ),
)
def job20(spark, sf):
    out = claims.weekly_totals(claims.daily_summary(t.claims(spark, sf)), t.CLAIMS_AS_OF)
    return out.withColumns(
        {"total_amount": F.round("total_amount", 2), "avg_claim_amount": F.round("avg_claim_amount", 6)}
    )


@query(
    "job20_busiest_hospitals",
    over(
        "claims_v hospitals_v",
        """SELECT hospital_name, CAST(count(*) AS BIGINT) AS claim_count, round(sum(claim_amount), 2) AS total
           FROM claims_v JOIN hospitals_v USING (hospital_id)
           WHERE claim_date >= TIMESTAMP '2001-08-01' - INTERVAL 365 DAY
           GROUP BY hospital_name ORDER BY claim_count DESC, hospital_name LIMIT 5""",
    ),
)
def job20_hospitals(spark, sf):
    return claims.busiest_hospitals(t.claims(spark, sf), t.hospitals(spark, sf), t.CLAIMS_AS_OF, "365 DAYS")


@query("job20_high_risk_count", over("patients_v", "SELECT count(*) AS high_risk FROM patients_v WHERE risk_score > 0.7"))
def job20_risk(spark, sf):
    return t.patients(spark, sf).agg(F.count_if(F.col("risk_score") > 0.7).alias("high_risk"))


@query(
    "job21_high_risk_patients",
    over(
        "patients_v",
        """SELECT patient_id, state, insurance_type, risk_score FROM patients_v WHERE risk_score >= 0.7
           ORDER BY risk_score DESC, patient_id LIMIT 50""",
    ),
)
def job21(spark, sf):
    return claims.high_risk_patients(t.patients(spark, sf))


@query(
    "job21_open_high_alerts",
    over(
        "alerts_v",
        """SELECT alert_id, patient_id, fraud_score, severity FROM alerts_v
           WHERE severity IN ('HIGH', 'CRITICAL') AND NOT resolved ORDER BY fraud_score DESC, alert_id LIMIT 20""",
    ),
)
def job21_alerts(spark, sf):
    return claims.open_high_alerts(t.alerts(spark, sf)).select("alert_id", "patient_id", "fraud_score", "severity")
