"""SQL text of the domain views, for the checking queries."""

VIEWS = {
    "orders_v": """
        SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderstatus AS order_status,
               o_orderdate AS purchase_ts, o_orderdate + INTERVAL 60 DAY AS estimated_ts,
               o_totalprice AS order_value, o_orderpriority AS priority
        FROM orders""",
    "items_v": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
               l_suppkey AS seller_id, l_extendedprice AS price,
               l_extendedprice * l_tax AS freight_value, l_shipdate AS delivered_ts
        FROM lineitem""",
    "products_v": """
        SELECT p_partkey AS product_id, p_type AS category, p_name AS product_name,
               p_brand AS brand, p_size AS size, p_retailprice AS list_price
        FROM part""",
    "customers_v": """
        SELECT c_custkey AS customer_id, c_mktsegment AS customer_city, n_name AS customer_state
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "claims_v": """
        SELECT o_orderkey AS claim_id, o_custkey AS patient_id, o_orderkey % 10 AS hospital_id,
               CAST(o_orderkey % 15 AS INTEGER) AS treatment_code,
               o_orderpriority AS diagnosis_code, o_totalprice AS claim_amount,
               o_totalprice * (0.5::DOUBLE + (o_orderkey % 50) / 100.0::DOUBLE) AS approved_amount,
               CASE o_orderstatus WHEN 'F' THEN 'APPROVED' WHEN 'P' THEN 'DENIED'
                    ELSE 'PENDING' END AS insurance_status,
               o_orderdate AS claim_date, o_orderkey % 20 = 0 AS is_fraud,
               ((o_orderkey * 7919) % 10000) / 10000.0::DOUBLE AS fraud_score,
               CASE o_orderstatus WHEN 'O' THEN 'PENDING' ELSE 'PROCESSED' END AS status,
               ['MEDICARE', 'MEDICAID', 'PRIVATE', 'UNINSURED'][o_custkey % 4 + 1] AS insurance_type,
               ['GENERAL', 'SPECIALTY', 'TEACHING', 'CRITICAL_ACCESS'][(o_orderkey % 10) % 4 + 1]
                   AS hospital_type
        FROM orders""",
    "patients_v": """
        SELECT c_custkey AS patient_id, n_name AS state,
               ['MEDICARE', 'MEDICAID', 'PRIVATE', 'UNINSURED'][c_custkey % 4 + 1] AS insurance_type,
               ((c_custkey * 37) % 100) / 100.0::DOUBLE AS risk_score
        FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    "hospitals_v": """
        SELECT s_suppkey AS hospital_id, s_name AS hospital_name, n_name AS state,
               CAST((s_suppkey * 13) % 100 AS DOUBLE) AS performance_score
        FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey""",
    "treatments_v": """
        SELECT CAST(range AS INTEGER) AS treatment_code, (range + 1) * 10000.0::DOUBLE AS avg_cost
        FROM range(15)""",
    "alerts_v": """
        SELECT claim_id AS alert_id, claim_id, patient_id, hospital_id, fraud_score,
               CASE WHEN claim_amount > 300000 THEN 'HIGH_AMOUNT' ELSE 'ML_DETECTED' END AS alert_type,
               CASE WHEN fraud_score >= 0.95 THEN 'CRITICAL' WHEN fraud_score >= 0.85 THEN 'HIGH'
                    WHEN fraud_score >= 0.75 THEN 'MEDIUM' ELSE 'LOW' END AS severity,
               claim_id % 3 = 0 AS resolved, claim_date AS created_at,
               CASE WHEN claim_id % 3 = 0 THEN claim_date + INTERVAL 5 DAY END AS resolved_at
        FROM claims_v WHERE fraud_score >= 0.7""",
    "activity_v": """
        SELECT event_id, user_id,
               CASE event_type WHEN 'signup' THEN 'login' ELSE event_type END AS event_type,
               ts AS event_time, json_extract_string(props, '$.k') AS page, value
        FROM events""",
    "articles_v": r"""
        SELECT doc_id, md5(text) AS id, split_part(text, chr(10), 1) AS title,
               substr(text, length(split_part(text, chr(10), 1)) + 2) AS description,
               '' AS content, source, lang, n_chars,
               strftime(TIMESTAMP '2024-01-01' + to_minutes(CAST(doc_id AS INTEGER)), '%Y-%m-%dT%H:%M:%S')
                   AS published_at
        FROM documents""",
}

# Views that read another view.
NEEDS = {"alerts_v": ("claims_v",)}


def over(views: str, sql: str) -> str:
    """``sql`` with the named views in front as common table expressions.

    ``sql`` may begin with its own ``WITH`` list, which is appended.
    """
    names: list[str] = []
    for view in views.split():
        for name in (*NEEDS.get(view, ()), view):
            if name not in names:
                names.append(name)
    ctes = ",\n".join(f"{name} AS ({VIEWS[name]})" for name in names)
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
