"""Order and customer reports over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.views import over
from millrace.operators.windows import percent_of_total
from millrace.plans import commerce
from millrace.registry import query
from millrace.sources import tables as t


@query(
    "job02_top_categories",
    over(
        "items_v products_v",
        """SELECT category, round(sum(price + freight_value), 4) AS total_sales, count(DISTINCT order_id) AS total_orders,
                  round(sum(price), 4) / count(*) AS avg_price
           FROM items_v JOIN products_v USING (product_id) WHERE category IS NOT NULL
           GROUP BY category ORDER BY total_sales DESC, category LIMIT 10""",
    ),
)
def job02(spark, sf):
    return commerce.top_categories(t.items(spark, sf), t.products(spark, sf))


@query(
    "job03_monthly_trend",
    over(
        "items_v orders_v",
        """SELECT strftime(purchase_ts, '%Y-%m') AS month, count(DISTINCT order_id) AS total_orders,
                  round(sum(price + freight_value), 4) AS total_revenue, round(sum(price), 4) / count(*) AS avg_order_value
           FROM orders_v JOIN items_v USING (order_id) WHERE order_status = 'F' GROUP BY 1 ORDER BY 1""",
    ),
)
def job03(spark, sf):
    return commerce.monthly_trend(t.orders(spark, sf), t.items(spark, sf))


@query(
    "job03_monthly_sales",
    over(
        "items_v orders_v",
        """SELECT CAST(year(purchase_ts) AS INTEGER) AS order_year, CAST(month(purchase_ts) AS INTEGER) AS order_month,
                  count(DISTINCT order_id) AS total_orders, round(sum(price + freight_value), 4) AS total_revenue,
                  round(sum(price + freight_value), 4) / count(*) AS avg_order_value
           FROM orders_v JOIN items_v USING (order_id) WHERE order_status = 'F' GROUP BY 1, 2""",
    ),
)
def job03_year_month(spark, sf):
    return commerce.monthly_sales(t.orders(spark, sf), t.items(spark, sf))


@query(
    "job04_top_customers",
    over(
        "items_v orders_v customers_v",
        """SELECT customer_id, customer_city, customer_state, count(DISTINCT order_id) AS total_orders,
                  round(sum(price + freight_value), 4) AS total_spent,
                  round(sum(price + freight_value), 4) / count(*) AS avg_order_value
           FROM customers_v JOIN orders_v USING (customer_id) JOIN items_v USING (order_id)
           WHERE order_status = 'F' GROUP BY customer_id, customer_city, customer_state
           ORDER BY total_spent DESC, customer_id LIMIT 10""",
    ),
)
def job04(spark, sf):
    return commerce.top_customers(t.orders(spark, sf), t.items(spark, sf), t.customers(spark, sf))


@query(
    "job05_state_analysis",
    over(
        "items_v orders_v customers_v",
        """SELECT customer_state, CAST(count(DISTINCT order_id) AS BIGINT) AS total_orders,
                  round(sum(price + freight_value), 4) AS total_revenue, count(DISTINCT customer_id) AS unique_customers,
                  round(sum(price + freight_value), 4) / count(*) AS avg_order_value
           FROM customers_v JOIN orders_v USING (customer_id) JOIN items_v USING (order_id)
           WHERE order_status = 'F' GROUP BY customer_state""",
    ),
)
def job05(spark, sf):
    return commerce.state_analysis(t.orders(spark, sf), t.items(spark, sf), t.customers(spark, sf))


@query(
    "job06_status_distribution",
    over(
        "orders_v",
        """SELECT order_status, count(*) AS order_count,
                  round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 2) AS percentage
           FROM orders_v GROUP BY order_status""",
    ),
)
def job06(spark, sf):
    return percent_of_total(t.orders(spark, sf), ["order_status"], "order_count").orderBy(
        F.desc("order_count"), "order_status"
    )


@query(
    "job07_category_performance",
    over(
        "items_v products_v",
        """SELECT category, count(DISTINCT products_v.product_id) AS unique_products, count(DISTINCT order_id) AS total_orders,
                  round(sum(price + freight_value), 4) AS total_revenue, round(sum(price), 4) / count(price) AS avg_product_price
           FROM products_v LEFT JOIN items_v ON products_v.product_id = items_v.product_id WHERE category IS NOT NULL
           GROUP BY category HAVING count(DISTINCT order_id) > 0 ORDER BY total_revenue DESC, category LIMIT 20""",
    ),
)
def job07(spark, sf):
    return commerce.category_performance(t.items(spark, sf), t.products(spark, sf))


@query(
    "job07_category_performance_etl",
    over(
        "items_v orders_v products_v",
        """SELECT category, count(DISTINCT product_id) AS unique_products, count(DISTINCT order_id) AS total_orders,
                  round(sum(price + freight_value), 4) AS total_revenue, round(sum(price), 4) / count(price) AS avg_product_price,
                  CAST(sum(date_diff('day', purchase_ts, delivered_ts)) AS DOUBLE) / count(*) AS avg_delivery_days
           FROM orders_v JOIN items_v USING (order_id) JOIN products_v USING (product_id)
           WHERE order_status = 'F' AND category IS NOT NULL GROUP BY category""",
    ),
)
def job07_etl(spark, sf):
    return commerce.category_performance_etl(t.orders(spark, sf), t.items(spark, sf), t.products(spark, sf))


@query(
    "job08_delivery_performance",
    over(
        "items_v orders_v customers_v",
        """WITH d AS (SELECT order_id, max(delivered_ts) AS delivered_ts FROM items_v GROUP BY order_id)
           SELECT customer_state,
                  CAST(sum(date_diff('day', purchase_ts, delivered_ts)) AS DOUBLE) / count(*) AS avg_delivery_days,
                  CAST(sum(date_diff('day', delivered_ts, estimated_ts)) AS DOUBLE) / count(*) AS avg_slack_days,
                  CAST(sum(CASE WHEN delivered_ts <= estimated_ts THEN 1 ELSE 0 END) * 100.0 AS DOUBLE) / count(*)
                      AS on_time_delivery_pct
           FROM customers_v JOIN orders_v USING (customer_id) JOIN d USING (order_id)
           WHERE order_status = 'F' AND delivered_ts IS NOT NULL GROUP BY customer_state""",
    ),
)
def job08(spark, sf):
    return commerce.delivery_performance(t.orders(spark, sf), t.items(spark, sf), t.customers(spark, sf))


@query(
    "job09_customer_segments",
    over(
        "items_v orders_v customers_v",
        """SELECT customer_id, customer_city, customer_state, count(DISTINCT order_id) AS total_orders,
                  round(sum(price + freight_value), 4) AS total_spent,
                  round(sum(price + freight_value), 4) / count(*) AS avg_order_value,
                  min(purchase_ts) AS first_order_date, max(purchase_ts) AS last_order_date,
                  CASE WHEN round(sum(price + freight_value), 4) > 2500000 THEN 'High Value'
                       WHEN round(sum(price + freight_value), 4) > 1500000 THEN 'Medium Value' ELSE 'Low Value' END AS customer_segment
           FROM orders_v JOIN items_v USING (order_id) LEFT JOIN customers_v USING (customer_id)
           WHERE order_status = 'F' GROUP BY customer_id, customer_city, customer_state""",
    ),
)
def job09(spark, sf):
    return commerce.customer_segments(
        t.orders(spark, sf), t.items(spark, sf), t.customers(spark, sf), high=2_500_000, medium=1_500_000
    )


@query(
    "job24_progress_report",
    over(
        "orders_v",
        """WITH g AS (SELECT CAST(year(purchase_ts) AS INTEGER) AS period, priority AS module,
                         CASE order_status WHEN 'F' THEN 'Completed' WHEN 'P' THEN 'In Progress' ELSE 'Pending' END AS status,
                         count(*) AS topics FROM orders_v GROUP BY 1, 2, 3)
           SELECT period, module, status, topics,
                  CAST(sum(CASE WHEN status = 'Completed' THEN topics ELSE 0 END) OVER (PARTITION BY period, module) AS DOUBLE)
                    / sum(topics) OVER (PARTITION BY period, module) AS completion
           FROM g""",
    ),
)
def job24(spark, sf):
    status = (
        F.when(F.col("order_status") == "F", "Completed")
        .when(F.col("order_status") == "P", "In Progress")
        .otherwise("Pending")
    )
    topics = t.orders(spark, sf).select(
        F.year("purchase_ts").alias("period"), F.col("priority").alias("module"), status.alias("status")
    )
    return commerce.progress_report(topics)
