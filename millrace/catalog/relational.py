"""Filters, projections and joins over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.catalog.views import over
from millrace.operators import filters, joins, projections
from millrace.operators.skew import salted_join, salted_outer_join
from millrace.plans import claims as claim_plans
from millrace.registry import query
from millrace.sources import tables as t

# --- filters ---------------------------------------------------------------


@query(
    "flt01_filter_eq",
    over("orders_v", "SELECT order_id, customer_id, order_value FROM orders_v WHERE order_status = 'F'"),
)
def flt01(spark, sf):
    return filters.filter_eq(t.orders(spark, sf), "order_status", "F").select(
        "order_id", "customer_id", "order_value"
    )


@query(
    "flt02_valid_claims",
    over(
        "claims_v",
        """SELECT claim_id, patient_id, claim_amount FROM claims_v
           WHERE claim_id IS NOT NULL AND patient_id IS NOT NULL AND hospital_id IS NOT NULL
             AND claim_amount IS NOT NULL AND claim_amount > 0 AND claim_amount < 400000""",
    ),
)
def flt02(spark, sf):
    valid = claim_plans.valid_claims(t.claims(spark, sf), ceiling=400_000)
    return valid.select("claim_id", "patient_id", "claim_amount")


@query(
    "flt03_validate_claims",
    over(
        "claims_v",
        """SELECT claim_id, reason = 'OK' AS valid, reason FROM (
             SELECT claim_id, CASE
               WHEN coalesce(claim_id, 0) = 0 THEN 'Missing required field: claim_id'
               WHEN coalesce(patient_id, 0) = 0 THEN 'Missing required field: patient_id'
               WHEN coalesce(hospital_id, 0) = 0 THEN 'Missing required field: hospital_id'
               WHEN coalesce(claim_amount, 0) = 0 THEN 'Missing required field: claim_amount'
               WHEN claim_date IS NULL THEN 'Missing required field: claim_date'
               WHEN claim_amount <= 0 THEN 'claim_amount must be positive'
               WHEN claim_amount > 400000 THEN 'claim_amount exceeds maximum threshold'
               ELSE 'OK' END AS reason FROM claims_v)""",
    ),
)
def flt03(spark, sf):
    checked = claim_plans.validate_claims(t.claims(spark, sf), ceiling=400_000)
    return checked.select("claim_id", "valid", "reason")


@query(
    "flt04_route",
    over(
        "claims_v",
        """SELECT claim_id,
                  CASE WHEN coalesce(fraud_score, 0) >= 0.7 OR coalesce(is_fraud, FALSE)
                       THEN 'fraud' ELSE 'validated' END AS route,
                  CASE WHEN coalesce(fraud_score, 0) >= 0.7 OR coalesce(is_fraud, FALSE)
                       THEN CASE WHEN coalesce(fraud_score, 0) > 0.85 THEN 'HIGH' ELSE 'MEDIUM' END
                  END AS severity
           FROM claims_v""",
    ),
)
def flt04(spark, sf):
    fraud, validated = claim_plans.route(t.claims(spark, sf))
    return (
        fraud.select("claim_id", F.lit("fraud").alias("route"), "severity")
        .unionByName(
            validated.select(
                "claim_id", F.lit("validated").alias("route"), F.lit(None).cast("string").alias("severity")
            )
        )
    )


@query(
    "flt05_filter_optional",
    over(
        "claims_v",
        """SELECT claim_id, insurance_status, is_fraud FROM claims_v
           WHERE insurance_status = 'APPROVED' AND is_fraud""",
    ),
)
def flt05(spark, sf):
    return filters.filter_optional(
        t.claims(spark, sf), upper=("insurance_status",), insurance_status="approved", is_fraud=True,
        hospital_id=None,
    ).select("claim_id", "insurance_status", "is_fraud")


@query("flt06_lookup", over("claims_v", "SELECT claim_id, patient_id, claim_amount FROM claims_v WHERE claim_id = 77"))
def flt06(spark, sf):
    return filters.lookup(t.claims(spark, sf), "claim_id", 77).select("claim_id", "patient_id", "claim_amount")


@query(
    "flt07_filter_in",
    over(
        "products_v",
        """SELECT product_id, category, brand FROM products_v
           WHERE category IN ('ECONOMY', 'PROMO') AND brand IN ('Brand#1', 'Brand#2', 'Brand#3')""",
    ),
)
def flt07(spark, sf):
    return filters.filter_in(
        t.products(spark, sf), category=["ECONOMY", "PROMO"], brand=["Brand#1", "Brand#2", "Brand#3"]
    ).select("product_id", "category", "brand")


@query(
    "flt08_search_substring",
    over(
        "articles_v",
        """SELECT doc_id, id, title, published_at FROM articles_v
           WHERE contains(lower(title), 'tion') OR contains(lower(description), 'tion')
           ORDER BY published_at DESC, doc_id LIMIT 50""",
    ),
)
def flt08(spark, sf):
    return filters.search_substring(
        t.articles(spark, sf), "TION", ["title", "description"], [F.desc("published_at"), F.asc("doc_id")], 50
    ).select("doc_id", "id", "title", "published_at")


@query(
    "flt09_search_boosted",
    over(
        "articles_v",
        r"""WITH scored AS (
             SELECT doc_id, n_chars AS rating,
               greatest(
                 3.0::DOUBLE * (CAST(list_contains(regexp_split_to_array(lower(title), '[^\p{L}\p{N}]+'), 'the') AS INTEGER)
                      + CAST(list_contains(regexp_split_to_array(lower(title), '[^\p{L}\p{N}]+'), 'whether') AS INTEGER)),
                 2.0::DOUBLE * (CAST(list_contains(regexp_split_to_array(lower(description), '[^\p{L}\p{N}]+'), 'the') AS INTEGER)
                      + CAST(list_contains(regexp_split_to_array(lower(description), '[^\p{L}\p{N}]+'), 'whether') AS INTEGER))
               ) AS relevance
             FROM articles_v WHERE lang = 'en' AND n_chars >= 500)
           SELECT doc_id, rating, relevance FROM scored WHERE relevance > 0
           ORDER BY rating DESC, relevance DESC, doc_id LIMIT 10""",
    ),
)
def flt09(spark, sf):
    return filters.search_boosted(
        t.articles(spark, sf).withColumnRenamed("n_chars", "rating"),
        "the whether",
        {"title": 3, "description": 2},
        [F.desc("rating"), F.desc("relevance"), F.asc("doc_id")],
        (F.col("lang") == "en") & (F.col("rating") >= 500),
    ).select("doc_id", "rating", "relevance")


@query(
    "flt10_scan_filter",
    over("customers_v", "SELECT customer_id, customer_city FROM customers_v WHERE customer_state = 'NATION_3'"),
)
def flt10(spark, sf):
    nested = t.customers(spark, sf).select("customer_id", F.struct("customer_city", "customer_state").alias("info"))
    return filters.scan_filter(nested, "info.customer_state", "NATION_3", limit=None).select(
        "customer_id", "info.customer_city"
    )


@query(
    "flt11_recent",
    over(
        "claims_v",
        """SELECT claim_id, claim_date FROM claims_v
           WHERE claim_date >= TIMESTAMP '2001-08-01' - INTERVAL 30 DAY""",
    ),
)
def flt11(spark, sf):
    return filters.recent(t.claims(spark, sf), "claim_date", t.CLAIMS_AS_OF, "30 DAYS").select("claim_id", "claim_date")


@query(
    "flt11_on_day",
    over("claims_v", "SELECT claim_id, claim_amount FROM claims_v WHERE CAST(claim_date AS DATE) = DATE '1998-10-03'"),
)
def flt11_day(spark, sf):
    return filters.on_day(t.claims(spark, sf), "claim_date", "1998-10-03").select("claim_id", "claim_amount")


@query(
    "flt12_prefix_day",
    over("articles_v", "SELECT doc_id, published_at FROM articles_v WHERE published_at LIKE '2024-01-01%'"),
)
def flt12(spark, sf):
    return filters.prefix_day(t.articles(spark, sf), "published_at", "2024-01-01").select("doc_id", "published_at")


@query(
    "flt13_filter_not_null",
    "SELECT doc_id, quality FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NOT NULL",
)
def flt13(spark, sf):
    joined = t.table(spark, sf, "documents").join(t.table(spark, sf, "labels"), "doc_id", "left")
    return filters.filter_not_null(joined, "quality").select("doc_id", "quality")


@query(
    "flt14_bool_mask",
    over("products_v", "SELECT product_id, size, list_price FROM products_v WHERE size > 20 AND list_price < 1000"),
)
def flt14(spark, sf):
    return filters.bool_mask(t.products(spark, sf), "size > 20 AND list_price < 1000", ["product_id", "size", "list_price"])


# --- projections -----------------------------------------------------------


@query(
    "prj01_order_enrich",
    over(
        "orders_v items_v",
        """SELECT order_id, order_item_id, price + freight_value AS total_order_value,
                  CAST(year(purchase_ts) AS INTEGER) AS order_year, CAST(month(purchase_ts) AS INTEGER) AS order_month,
                  CAST(dayofweek(purchase_ts) + 1 AS INTEGER) AS order_day_of_week,
                  CAST(date_diff('day', purchase_ts, delivered_ts) AS INTEGER) AS delivery_days
           FROM orders_v JOIN items_v USING (order_id) WHERE order_status = 'F'""",
    ),
)
def prj01(spark, sf):
    from millrace.plans import commerce

    joined = filters.filter_eq(t.orders(spark, sf), "order_status", "F").join(t.items(spark, sf), "order_id")
    return commerce.order_enrich(joined).select(
        "order_id", "order_item_id", "total_order_value", "order_year", "order_month",
        "order_day_of_week", "delivery_days",
    )


@query(
    "prj02_tier",
    over(
        "claims_v",
        """SELECT claim_id,
                  CASE WHEN claim_amount > 300000 THEN 'High Value' WHEN claim_amount > 100000 THEN 'Medium Value'
                       ELSE 'Low Value' END AS value_tier,
                  CASE WHEN fraud_score >= 0.7 THEN 'HIGH' WHEN fraud_score >= 0.4 THEN 'MEDIUM' ELSE 'LOW' END AS risk_flag
           FROM claims_v""",
    ),
)
def prj02(spark, sf):
    return t.claims(spark, sf).select(
        "claim_id",
        projections.tier(F.col("claim_amount"), [(300000, "High Value"), (100000, "Medium Value")], "Low Value").alias("value_tier"),
        projections.tier(F.col("fraud_score"), [(0.7, "HIGH"), (0.4, "MEDIUM")], "LOW", closed=True).alias("risk_flag"),
    )


@query(
    "prj03_safe_ratio",
    over(
        "claims_v",
        """SELECT claim_id, CASE WHEN claim_amount > 0 THEN approved_amount / claim_amount ELSE 0.0 END AS approval_ratio
           FROM claims_v""",
    ),
)
def prj03(spark, sf):
    return t.claims(spark, sf).select(
        "claim_id", projections.safe_ratio(F.col("approved_amount"), F.col("claim_amount")).alias("approval_ratio")
    )


@query("prj04_expand_json", "SELECT CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def prj04(spark, sf):
    return projections.expand_json(t.table(spark, sf, "events"), "props", T.StructType([T.StructField("k", T.IntegerType())]))


@query(
    "prj05_add_drop_rename",
    """SELECT p_partkey AS id, p_name, p_type, p_size, p_retailprice,
              p_retailprice * 0.9::DOUBLE AS discounted FROM part""",
)
def prj05(spark, sf):
    return projections.add_drop_rename(
        t.table(spark, sf, "part"),
        add={"discounted": F.col("p_retailprice") * 0.9},
        drop=["p_brand", "not_there"],
        rename={"p_partkey": "id"},
    )


@query(
    "prj06_update_where",
    over(
        "claims_v",
        """SELECT claim_id,
                  CASE WHEN status = 'PENDING' AND claim_date < TIMESTAMP '2001-08-01' - INTERVAL 30 DAY
                       THEN 'PROCESSED' ELSE status END AS status,
                  CASE WHEN status = 'PENDING' AND claim_date < TIMESTAMP '2001-08-01' - INTERVAL 30 DAY
                       THEN TIMESTAMP '2001-08-01' END AS processed_date
           FROM claims_v""",
    ),
)
def prj06(spark, sf):
    return claim_plans.process_pending(t.claims(spark, sf), t.CLAIMS_AS_OF, "30 DAYS").select(
        "claim_id", "status", "processed_date"
    )


@query(
    "prj06_resolve_old_alerts",
    over(
        "alerts_v",
        """SELECT alert_id,
                  resolved OR (created_at < TIMESTAMP '2001-08-01' - INTERVAL 7 DAY AND severity IN ('LOW', 'MEDIUM')) AS resolved,
                  CASE WHEN NOT resolved AND created_at < TIMESTAMP '2001-08-01' - INTERVAL 7 DAY
                            AND severity IN ('LOW', 'MEDIUM') THEN TIMESTAMP '2001-08-01'
                       ELSE resolved_at END AS resolved_at
           FROM alerts_v""",
    ),
)
def prj06_alerts(spark, sf):
    return claim_plans.resolve_old_alerts(t.alerts(spark, sf), t.CLAIMS_AS_OF).select("alert_id", "resolved", "resolved_at")


@query(
    "prj07_partial_update",
    """WITH u AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 'X' END AS o_orderstatus,
                         o_totalprice * 2 AS o_totalprice
                  FROM orders WHERE o_orderpriority = '1-URGENT')
       SELECT o.o_orderkey, coalesce(u.o_orderstatus, o.o_orderstatus) AS o_orderstatus,
              coalesce(u.o_totalprice, o.o_totalprice) AS o_totalprice,
              CASE WHEN u.o_orderkey IS NOT NULL THEN TIMESTAMP '2001-08-01' ELSE o.o_orderdate END AS o_orderdate
       FROM orders o LEFT JOIN u ON o.o_orderkey = u.o_orderkey""",
)
def prj07(spark, sf):
    base = t.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    updates = t.table(spark, sf, "orders").filter("o_orderpriority = '1-URGENT'").select(
        "o_orderkey",
        F.expr("CASE WHEN o_orderkey % 2 = 0 THEN 'X' END").alias("o_orderstatus"),
        (F.col("o_totalprice") * 2).alias("o_totalprice"),
    )
    return projections.partial_update(
        base, updates, "o_orderkey", touched="o_orderdate", now=F.expr(f"TIMESTAMP_NTZ'{t.CLAIMS_AS_OF}'")
    )


@query(
    "prj08_flatten_sentiment",
    """SELECT doc_id, CASE WHEN quality IS NULL THEN 'neutral' WHEN quality = 1 THEN 'positive' ELSE 'negative' END
                  AS sentiment_label,
              coalesce(quality - 0.5::DOUBLE, 0.0) AS sentiment_score, coalesce(toxic, 0) AS score
       FROM documents LEFT JOIN labels USING (doc_id)""",
)
def prj08(spark, sf):
    quality = F.col("quality")
    joined = t.table(spark, sf, "documents").join(t.table(spark, sf, "labels"), "doc_id", "left")
    nested = joined.select(
        "doc_id",
        F.when(
            quality.isNotNull(),
            F.struct(
                F.when(quality == 1, "positive").otherwise("negative").alias("label"),
                (quality - F.lit(0.5)).alias("compound"),
            ),
        ).alias("sentiment"),
        F.col("toxic").alias("score"),
    )
    return projections.flatten_sentiment(nested)


# --- joins -----------------------------------------------------------------


@query(
    "join01_inner",
    over("orders_v items_v", "SELECT order_id, customer_id, product_id, price FROM orders_v JOIN items_v USING (order_id)"),
)
def join01(spark, sf):
    return joins.inner(t.orders(spark, sf), t.items(spark, sf), "order_id").select(
        "order_id", "customer_id", "product_id", "price"
    )


@query(
    "join01_inner_salted",
    over("orders_v customers_v", "SELECT order_id, customer_id, customer_state FROM orders_v JOIN customers_v USING (customer_id)"),
)
def join01_salted(spark, sf):
    return salted_join(
        t.orders(spark, sf).select("order_id", "customer_id"),
        t.customers(spark, sf).select("customer_id", "customer_state"),
        ["customer_id"],
        salt_by=["order_id"],
    )


@query(
    "join02_left",
    over(
        "items_v products_v",
        """SELECT order_id, order_item_id, price, category FROM items_v
           LEFT JOIN (SELECT product_id, category FROM products_v WHERE size > 10) USING (product_id)""",
    ),
)
def join02(spark, sf):
    wanted = t.products(spark, sf).filter("size > 10").select("product_id", "category")
    return joins.left_outer(t.items(spark, sf), wanted, "product_id").select(
        "order_id", "order_item_id", "price", "category"
    )


@query(
    "join03_right",
    over(
        "orders_v customers_v",
        """SELECT customer_id, order_id, customer_state
           FROM (SELECT order_id, customer_id FROM orders_v WHERE priority = '1-URGENT') o
           RIGHT JOIN customers_v USING (customer_id)""",
    ),
)
def join03(spark, sf):
    urgent = t.orders(spark, sf).filter("priority = '1-URGENT'").select("order_id", "customer_id")
    return joins.right_outer(urgent, t.customers(spark, sf), ["customer_id"], salt_by=["order_id"]).select(
        "customer_id", "order_id", "customer_state"
    )


@query(
    "join03_right_salted",
    over(
        "orders_v customers_v",
        """SELECT customer_id, order_id, customer_state
           FROM (SELECT order_id, customer_id FROM orders_v WHERE priority = '1-URGENT') o
           RIGHT JOIN customers_v USING (customer_id)""",
    ),
)
def join03_salted(spark, sf):
    urgent = t.orders(spark, sf).filter("priority = '1-URGENT'").select("order_id", "customer_id")
    people = t.customers(spark, sf).select("customer_id", "customer_state")
    return salted_outer_join(urgent, people, ["customer_id"], salt_by=["order_id"], how="right")


@query(
    "join04_full_salted",
    over(
        "orders_v customers_v",
        """SELECT coalesce(o.customer_id, c.customer_id) AS customer_id, order_id, customer_state
           FROM (SELECT order_id, customer_id FROM orders_v WHERE order_status <> 'P') o
           FULL JOIN (SELECT * FROM customers_v WHERE customer_city <> 'BUILDING') c ON o.customer_id = c.customer_id""",
    ),
)
def join04_salted(spark, sf):
    """Orders without partial ones and customers outside one segment."""
    made = t.orders(spark, sf).filter("order_status <> 'P'").select("order_id", "customer_id")
    people = t.customers(spark, sf).filter("customer_city <> 'BUILDING'").select("customer_id", "customer_state")
    return salted_outer_join(made, people, ["customer_id"], salt_by=["order_id"], how="full")


@query(
    "join04_full",
    """SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, d.n_chars, l.quality
       FROM (SELECT doc_id, n_chars FROM documents WHERE lang = 'en') d
       FULL JOIN labels l ON d.doc_id = l.doc_id""",
)
def join04(spark, sf):
    english = t.table(spark, sf, "documents").filter("lang = 'en'").select("doc_id", "n_chars")
    return joins.full_outer(english, t.table(spark, sf, "labels").select("doc_id", "quality"), ["doc_id"])


@query(
    "join05_star",
    over(
        "orders_v items_v products_v customers_v",
        """SELECT order_id, order_item_id, price, category, customer_state
           FROM items_v JOIN orders_v USING (order_id) LEFT JOIN products_v USING (product_id)
           LEFT JOIN customers_v USING (customer_id) WHERE order_status = 'F'""",
    ),
)
def join05(spark, sf):
    return joins.star(
        t.items(spark, sf),
        [
            (t.orders(spark, sf).filter("order_status = 'F'"), "order_id", "inner"),
            (t.products(spark, sf), "product_id", "left"),
            (t.customers(spark, sf), "customer_id", "left"),
        ],
    ).select("order_id", "order_item_id", "price", "category", "customer_state")


@query(
    "join06_lookup",
    over("claims_v treatments_v", "SELECT claim_id, treatment_code, avg_cost FROM claims_v JOIN treatments_v USING (treatment_code)"),
)
def join06(spark, sf):
    return joins.lookup_literal(t.claims(spark, sf), t.treatments(spark), "treatment_code").select(
        "claim_id", "treatment_code", "avg_cost"
    )


@query(
    "join07_semi",
    "SELECT doc_id, lang, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)",
)
def join07(spark, sf):
    good = t.table(spark, sf, "labels").filter("quality = 1")
    return joins.having_match(t.table(spark, sf, "documents"), good, "doc_id").select("doc_id", "lang", "source")


@query(
    "join08_anti",
    "SELECT doc_id, lang, source FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
)
def join08(spark, sf):
    return joins.without_match(t.table(spark, sf, "documents"), t.table(spark, sf, "labels"), "doc_id").select(
        "doc_id", "lang", "source"
    )


@query(
    "join09_update_from",
    over(
        "patients_v claims_v",
        """WITH s AS (SELECT patient_id, least(1.0::DOUBLE, count(*) * 0.01::DOUBLE) AS new_risk
                      FROM claims_v WHERE insurance_status = 'DENIED' GROUP BY patient_id)
           SELECT p.patient_id, p.state, coalesce(s.new_risk, p.risk_score) AS risk_score
           FROM patients_v p LEFT JOIN s ON p.patient_id = s.patient_id""",
    ),
)
def join09(spark, sf):
    denied = (
        t.claims(spark, sf)
        .filter("insurance_status = 'DENIED'")
        .groupBy("patient_id")
        .agg(F.least(F.lit(1.0), F.count(F.lit(1)) * F.lit(0.01)).alias("new_risk"))
    )
    return joins.update_from(
        t.patients(spark, sf), denied, "patient_id", {"risk_score": F.col("src_new_risk")}
    ).select("patient_id", "state", "risk_score")


@query(
    "join10_ordinal",
    """WITH a AS (SELECT row_number() OVER (ORDER BY c_acctbal, c_custkey) AS ordinal, c_name FROM customer),
            b AS (SELECT row_number() OVER (ORDER BY s_acctbal, s_suppkey) AS ordinal, s_name FROM supplier)
       SELECT coalesce(a.ordinal, b.ordinal) AS ordinal, c_name, s_name
       FROM a FULL JOIN b ON a.ordinal = b.ordinal""",
)
def join10(spark, sf):
    return joins.beside(
        t.table(spark, sf, "customer").select("c_acctbal", "c_custkey", "c_name"),
        t.table(spark, sf, "supplier").select("s_acctbal", "s_suppkey", "s_name"),
        ["c_acctbal", "c_custkey"],
        ["s_acctbal", "s_suppkey"],
    ).select("ordinal", "c_name", "s_name")
