"""Aggregates over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.views import over
from millrace.operators import aggregates as agg
from millrace.operators.quantiles import quantiles
from millrace.plans import readings
from millrace.registry import query
from millrace.sources import tables as t


@query("agg01_group_count", "SELECT event_type, count(*) AS n FROM events GROUP BY event_type")
def agg01(spark, sf):
    return agg.group_count(t.table(spark, sf, "events"), ["event_type"])


@query("agg01_docs_per_source", "SELECT source, count(*) AS n FROM documents GROUP BY source")
def agg01_docs(spark, sf):
    return agg.group_count(t.table(spark, sf, "documents"), ["source"])


@query("agg01_turns_per_role", "SELECT role, count(*) AS n FROM conversations GROUP BY role")
def agg01_roles(spark, sf):
    return agg.group_count(t.table(spark, sf, "conversations"), ["role"])


@query(
    "agg02_conditional_counts",
    """SELECT user_id, count(*) AS total_events, count(*) FILTER (event_type = 'purchase') AS purchases,
              count(*) FILTER (event_type = 'click') AS clicks FROM events GROUP BY user_id""",
)
def agg02(spark, sf):
    kind = F.col("event_type")
    return agg.conditional_counts(
        t.table(spark, sf, "events"), ["user_id"], {"purchases": kind == "purchase", "clicks": kind == "click"},
        total="total_events",
    )


@query(
    "agg03_sum_avg_min_max",
    over(
        "items_v",
        """SELECT product_id, round(sum(price), 2) AS revenue, round(sum(price), 2) / count(*) AS avg_price,
                  min(price) AS min_price, max(price) AS max_price, min(delivered_ts) AS first_delivery,
                  max(delivered_ts) AS last_delivery FROM items_v GROUP BY product_id""",
    ),
)
def agg03(spark, sf):
    return agg.summarise(
        t.items(spark, sf),
        ["product_id"],
        revenue=F.round(F.sum("price"), 2),
        avg_price=F.round(F.sum("price"), 2) / F.count("price"),
        min_price=F.min("price"),
        max_price=F.max("price"),
        first_delivery=F.min("delivered_ts"),
        last_delivery=F.max("delivered_ts"),
    )


@query(
    "agg04_count_distinct",
    over(
        "items_v",
        """SELECT seller_id, count(DISTINCT order_id) AS orders, count(DISTINCT product_id) AS products
           FROM items_v GROUP BY seller_id""",
    ),
)
def agg04(spark, sf):
    return agg.summarise(
        t.items(spark, sf), ["seller_id"], orders=F.count_distinct("order_id"), products=F.count_distinct("product_id")
    )


@query(
    "agg05_global",
    over(
        "claims_v",
        """SELECT count(*) AS total, coalesce(round(sum(claim_amount), 2), 0) AS amount,
                  round(count(*) FILTER (is_fraud) * 100.0::DOUBLE / greatest(count(*), 1), 4) AS fraud_pct FROM claims_v""",
    ),
)
def agg05(spark, sf):
    total = F.count(F.lit(1))
    return agg.summarise(
        t.claims(spark, sf),
        [],
        total=total,
        amount=F.coalesce(F.round(F.sum("claim_amount"), 2), F.lit(0.0)),
        fraud_pct=F.round(F.count_if("is_fraud") * 100.0 / F.greatest(total, F.lit(1)), 4),
    )


@query(
    "agg05_global_empty",
    over(
        "claims_v",
        """SELECT count(*) AS total, coalesce(sum(claim_amount), 0.0::DOUBLE) AS amount FROM claims_v WHERE claim_amount < 0""",
    ),
)
def agg05_empty(spark, sf):
    return agg.summarise(
        t.claims(spark, sf).filter("claim_amount < 0"),
        [],
        total=F.count(F.lit(1)),
        amount=F.coalesce(F.sum("claim_amount"), F.lit(0.0)),
    )


@query(
    "agg06_having",
    over("claims_v", "SELECT patient_id, count(*) AS n FROM claims_v GROUP BY patient_id HAVING count(*) > 5"),
)
def agg06(spark, sf):
    return agg.having(t.claims(spark, sf), ["patient_id"], F.col("n") > 5, n=F.count(F.lit(1)))


@query(
    "agg07_multi_key",
    """SELECT l_returnflag, l_linestatus, count(*) AS n, sum(l_quantity) AS quantity,
              round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue
       FROM lineitem GROUP BY ALL""",
)
def agg07(spark, sf):
    return agg.summarise(
        t.table(spark, sf, "lineitem"),
        ["l_returnflag", "l_linestatus"],
        n=F.count(F.lit(1)),
        quantity=F.sum("l_quantity"),
        revenue=F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2),
    )


@query(
    "agg08_mean_ratio",
    over(
        "items_v",
        """SELECT product_id, round(avg(freight_value / price), 6) AS freight_ratio FROM items_v
           WHERE price > 0 GROUP BY product_id""",
    ),
)
def agg08(spark, sf):
    ratios = agg.mean_ratio(t.items(spark, sf), ["product_id"], "freight_value", "price", "freight_ratio")
    return ratios.withColumn("freight_ratio", F.round("freight_ratio", 6)).orderBy(F.desc("freight_ratio"), "product_id")


@query(
    "agg09_mean_by_key",
    over(
        "orders_v items_v customers_v",
        """SELECT customer_state, round(sum(price + freight_value), 4) / count(*) AS avg_value
           FROM items_v JOIN orders_v USING (order_id) JOIN customers_v USING (customer_id)
           WHERE order_status = 'F' AND customer_state IS NOT NULL GROUP BY customer_state""",
    ),
)
def agg09(spark, sf):
    from millrace.plans import commerce

    per_customer = commerce.customer_totals(t.orders(spark, sf), t.items(spark, sf))
    return (
        per_customer.join(t.customers(spark, sf).dropna(subset=["customer_state"]), "customer_id")
        .groupBy("customer_state")
        .agg(commerce.mean_of("total_spent").alias("avg_value"))
        .orderBy(F.desc("avg_value"), "customer_state")
    )


@query(
    "agg10_revenue_by_key",
    """WITH raw AS (SELECT l_partkey AS product_id,
                           CASE WHEN l_linenumber = 7 THEN 'n/a' ELSE CAST(l_quantity AS VARCHAR) END AS price,
                           CAST(l_tax AS VARCHAR) AS freight FROM lineitem)
       SELECT product_id, round(sum(TRY_CAST(price AS DOUBLE) + TRY_CAST(freight AS DOUBLE)), 2) AS total_sales,
              count(*) AS order_count
       FROM raw WHERE TRY_CAST(price AS DOUBLE) IS NOT NULL AND TRY_CAST(freight AS DOUBLE) IS NOT NULL
       GROUP BY product_id""",
)
def agg10(spark, sf):
    raw = t.table(spark, sf, "lineitem").select(
        F.col("l_partkey").alias("product_id"),
        F.when(F.col("l_linenumber") == 7, "n/a").otherwise(F.col("l_quantity").cast("string")).alias("price"),
        F.col("l_tax").cast("string").alias("freight"),
    )
    return agg.revenue_by_key(raw, "product_id", "price", "freight")


@query(
    "agg11_pivot",
    """SELECT l_returnflag, coalesce(sum(l_quantity) FILTER (l_linestatus = 'F'), 0) AS F,
              coalesce(sum(l_quantity) FILTER (l_linestatus = 'O'), 0) AS O
       FROM lineitem GROUP BY l_returnflag""",
)
def agg11(spark, sf):
    return agg.pivot_sum(t.table(spark, sf, "lineitem"), ["l_returnflag"], "l_linestatus", ["F", "O"], "l_quantity")


@query(
    "agg12_agg_map",
    """SELECT p_type, p_brand, sum(p_size) AS p_size_sum, round(avg(p_retailprice), 7) AS p_retailprice_mean,
              max(p_retailprice) AS p_retailprice_max FROM part GROUP BY p_type, p_brand""",
)
def agg12(spark, sf):
    out = agg.agg_map(
        t.table(spark, sf, "part"), ["p_type", "p_brand"], {"p_size": "sum", "p_retailprice": ["mean", "max"]}
    )
    return out.withColumn("p_retailprice_mean", F.round("p_retailprice_mean", 7))


@query(
    "agg13_dispersion",
    """SELECT event_type, count(value) AS n, round(avg(value), 6) AS mean, round(stddev_samp(value), 6) AS std
       FROM events GROUP BY event_type""",
)
def agg13(spark, sf):
    out = agg.dispersion(t.table(spark, sf, "events"), ["event_type"], "value")
    return out.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


@query(
    "agg14_quantiles",
    """SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.25), 4) AS p25,
              round(quantile_cont(l_extendedprice, 0.5), 4) AS p50,
              round(quantile_cont(l_extendedprice, 0.75), 4) AS p75 FROM lineitem GROUP BY l_returnflag""",
)
def agg14(spark, sf):
    out = quantiles(t.table(spark, sf, "lineitem"), "l_extendedprice", [0.25, 0.5, 0.75], ["l_returnflag"])
    return out.withColumns({p: F.round(p, 4) for p in ("p25", "p50", "p75")})


@query(
    "agg14_quantiles_sorted",
    """SELECT event_type, round(quantile_cont(value, 0.1), 6) AS p10, round(quantile_cont(value, 0.5), 6) AS p50,
              round(quantile_cont(value, 0.99), 6) AS p99 FROM events GROUP BY event_type""",
)
def agg14_sorted(spark, sf):
    """The distributed way, as taken when a group has too many values for one task."""
    out = quantiles(t.table(spark, sf, "events"), "value", [0.1, 0.5, 0.99], ["event_type"])
    return out.withColumns({p: F.round(p, 6) for p in ("p10", "p50", "p99")})


@query(
    "agg15_mode",
    "SELECT p_size, count(*) AS n FROM part GROUP BY p_size ORDER BY n DESC, p_size LIMIT 1",
)
def agg15(spark, sf):
    return agg.mode_value(t.table(spark, sf, "part"), "p_size")


@query(
    "agg16_histogram",
    """WITH b AS (SELECT min(value) AS lo, max(value) AS hi FROM events),
            c AS (SELECT least(CAST(floor((value - lo) / ((hi - lo) / 20)) AS INTEGER), 19) AS bin, count(*) AS n
                  FROM events, b GROUP BY 1)
       SELECT CAST(r.range AS INTEGER) AS bin, lo + r.range * ((hi - lo) / 20) AS bin_from,
              lo + (r.range + 1) * ((hi - lo) / 20) AS bin_to, coalesce(n, 0) AS n
       FROM range(20) r, b LEFT JOIN c ON c.bin = r.range""",
)
def agg16(spark, sf):
    return agg.histogram(t.table(spark, sf, "events"), "value", 20)


@query(
    "agg17_box_stats",
    """WITH q AS (SELECT l_shipmode, quantile_cont(v, 0.25) AS p25, quantile_cont(v, 0.5) AS p50,
                         quantile_cont(v, 0.75) AS p75
                  FROM (SELECT l_returnflag AS l_shipmode, l_quantity * l_quantity AS v FROM lineitem) GROUP BY 1),
            x AS (SELECT l_returnflag AS l_shipmode, l_quantity * l_quantity AS v FROM lineitem)
       SELECT q.l_shipmode AS l_returnflag, min(v) AS min,
              min(v) FILTER (v >= p25 - 1.5 * (p75 - p25) AND v <= p75 + 1.5 * (p75 - p25)) AS whisker_low,
              p25, p50, p75,
              max(v) FILTER (v >= p25 - 1.5 * (p75 - p25) AND v <= p75 + 1.5 * (p75 - p25)) AS whisker_high,
              max(v) AS max,
              count(*) FILTER (NOT (v >= p25 - 1.5 * (p75 - p25) AND v <= p75 + 1.5 * (p75 - p25))) AS outliers
       FROM x JOIN q USING (l_shipmode) GROUP BY q.l_shipmode, p25, p50, p75""",
)
def agg17(spark, sf):
    squared = t.table(spark, sf, "lineitem").select(
        "l_returnflag", (F.col("l_quantity") * F.col("l_quantity")).alias("v")
    )
    return agg.box_stats(squared, "v", ["l_returnflag"])


@query(
    "agg18_correlations",
    """WITH c AS (SELECT corr(l_quantity, l_extendedprice) AS qe, corr(l_quantity, l_discount) AS qd,
                         corr(l_extendedprice, l_discount) AS ed FROM lineitem)
       SELECT 'l_quantity' AS column_a, 'l_extendedprice' AS column_b, round(qe, 6) AS r FROM c
       UNION ALL SELECT 'l_quantity', 'l_discount', round(qd, 6) FROM c
       UNION ALL SELECT 'l_extendedprice', 'l_discount', round(ed, 6) FROM c
       UNION ALL SELECT n, n, 1.0::DOUBLE FROM (VALUES ('l_quantity'), ('l_extendedprice'), ('l_discount')) v(n)""",
)
def agg18(spark, sf):
    out = agg.correlations(t.table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice", "l_discount"])
    return out.withColumn("r", F.round("r", 6))


@query(
    "agg19_group_rate",
    "SELECT lang, round(avg(quality), 6) AS quality_rate FROM documents JOIN labels USING (doc_id) GROUP BY lang",
)
def agg19(spark, sf):
    joined = t.table(spark, sf, "documents").select("doc_id", "lang").join(t.table(spark, sf, "labels"), "doc_id")
    out = agg.group_rate(joined, ["lang"], "quality", "quality_rate")
    return out.withColumn("quality_rate", F.round("quality_rate", 6))


@query(
    "agg20_unnest_count",
    r"""WITH tok AS (SELECT unnest(string_split_regex(lower(text), '[^\p{L}\p{N}]+')) AS keyword FROM documents)
       SELECT keyword, count(*) AS n FROM tok WHERE keyword <> '' AND length(keyword) > 2 GROUP BY keyword""",
)
def agg20(spark, sf):
    from millrace.operators.filters import words

    tagged = t.table(spark, sf, "documents").select(words("text").alias("keywords"))
    return agg.unnest_count(tagged, "keywords")


@query(
    "agg21_nested_readings",
    """WITH r AS (SELECT user_id, event_id // 24 AS record, ts,
                        CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events)
       SELECT user_id, record, strftime(min(ts), '%Y-%m-%d') AS date, round(min(value), 2) AS min_value,
              round(max(value), 2) AS max_value, round(sum(value), 2) / count(value) AS avg_value,
              count(value) AS total_readings
       FROM r GROUP BY user_id, record HAVING count(value) > 0""",
)
def agg21(spark, sf):
    records = readings.as_records(t.table(spark, sf, "events"))
    return readings.report(records, decimals=None).select(
        "user_id", "record", "date", "min_value", "max_value", "avg_value", "total_readings"
    )


@query(
    "agg21_zipped_readings",
    """SELECT user_id, event_id // 24 AS record, ts AS time, CASE WHEN event_id % 7 <> 0 THEN value END AS value
       FROM events""",
)
def agg21_zipped(spark, sf):
    return readings.zipped(readings.as_records(t.table(spark, sf, "events")), ["user_id", "record"])
