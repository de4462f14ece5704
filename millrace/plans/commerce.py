"""Order, item, product and customer jobs.

Items are summed per order before any other join: the sum shares the shuffle on
``order_id`` with the join that follows, later joins move one row per order,
and counting orders becomes counting those rows' keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.operators.projections import tier


def line_total() -> Column:
    return F.col("price") + F.col("freight_value")


def mean_of(total: str) -> Column:
    """Mean per line from summed totals. Money has at most four decimals, so
    rounding the sum only removes floating-point noise and makes the result
    independent of the order of summing."""
    return F.round(F.sum(total), 4) / F.sum("lines")


def order_enrich(joined: DataFrame) -> DataFrame:
    """Total value, calendar parts of the purchase and delivery days."""
    return joined.withColumns(
        {
            "total_order_value": line_total(),
            "order_year": F.year("purchase_ts"),
            "order_month": F.month("purchase_ts"),
            "order_day_of_week": F.dayofweek("purchase_ts"),
            "delivery_days": F.datediff("delivered_ts", "purchase_ts"),
        }
    )


def order_totals(items: DataFrame) -> DataFrame:
    """One row per order: line count, sum of prices, sum of totals, last delivery."""
    return items.groupBy("order_id").agg(
        F.count(F.lit(1)).alias("lines"),
        F.sum("price").alias("price_sum"),
        F.sum(line_total()).alias("total_sum"),
        F.max("delivered_ts").alias("delivered_ts"),
    )


def delivered_orders(orders: DataFrame, items: DataFrame, status: str = "F") -> DataFrame:
    """Delivered orders with their item totals."""
    return orders.filter(F.col("order_status") == status).join(order_totals(items), "order_id")


def category_lines(items: DataFrame, products: DataFrame) -> DataFrame:
    """Item lines with a known category, summed per (category, order)."""
    known = products.filter(F.col("category").isNotNull()).select("product_id", "category")
    return (
        items.select("order_id", "product_id", "price", "freight_value")
        .join(known, "product_id")
        .groupBy("category", "order_id")
        .agg(
            F.count(F.lit(1)).alias("lines"),
            F.sum("price").alias("price_sum"),
            F.sum(line_total()).alias("total_sum"),
        )
    )


def category_sales(items: DataFrame, products: DataFrame) -> DataFrame:
    """Revenue, distinct orders and mean price per category."""
    return category_lines(items, products).groupBy("category").agg(
        F.round(F.sum("total_sum"), 4).alias("total_sales"),
        F.count(F.lit(1)).alias("total_orders"),
        mean_of("price_sum").alias("avg_price"),
    )


def top_categories(items: DataFrame, products: DataFrame, k: int = 10) -> DataFrame:
    return category_sales(items, products).orderBy(F.desc("total_sales"), F.asc("category")).limit(k)


def sales_summary(items: DataFrame, products: DataFrame, processing_date: str) -> DataFrame:
    """Category sales stamped with a processing date, as stored in the summary table."""
    return category_sales(items, products).withColumn("processing_date", F.lit(processing_date))


def monthly_trend(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Delivered orders per month: orders, revenue and mean line price."""
    month = F.date_format("purchase_ts", "yyyy-MM")
    return (
        delivered_orders(orders, items)
        .groupBy(month.alias("month"))
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.round(F.sum("total_sum"), 4).alias("total_revenue"),
            mean_of("price_sum").alias("avg_order_value"),
        )
        .orderBy("month")
    )


def monthly_sales(orders: DataFrame, items: DataFrame) -> DataFrame:
    """The (year, month) variant with the mean line total."""
    return (
        delivered_orders(orders, items)
        .groupBy(F.year("purchase_ts").alias("order_year"), F.month("purchase_ts").alias("order_month"))
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.round(F.sum("total_sum"), 4).alias("total_revenue"),
            mean_of("total_sum").alias("avg_order_value"),
        )
        .orderBy("order_year", "order_month")
    )


def customer_totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    """One row per customer over delivered orders."""
    return (
        delivered_orders(orders, items)
        .groupBy("customer_id")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.sum("total_sum").alias("total_spent"),
            F.sum("lines").alias("lines"),
            F.min("purchase_ts").alias("first_order_date"),
            F.max("purchase_ts").alias("last_order_date"),
        )
    )


def customer_features(orders: DataFrame, items: DataFrame, customers: DataFrame) -> DataFrame:
    """Customer features from raw tables: all orders, prices without freight."""
    per_customer = (
        orders.join(order_totals(items), "order_id")
        .groupBy("customer_id")
        .agg(
            F.count_distinct("order_id").alias("total_orders"),
            F.round(F.sum("price_sum"), 4).alias("total_spent"),
            mean_of("price_sum").alias("avg_order_value"),
            F.min("purchase_ts").alias("first_order_date"),
            F.max("purchase_ts").alias("last_order_date"),
        )
    )
    return per_customer.join(customers, "customer_id", "left")


def top_customers(orders: DataFrame, items: DataFrame, customers: DataFrame, k: int = 10) -> DataFrame:
    """Customers by spend; orders are summed per customer before customers are joined."""
    return (
        customer_totals(orders, items)
        .join(customers, "customer_id")
        .select(
            "customer_id",
            "customer_city",
            "customer_state",
            "total_orders",
            F.round("total_spent", 4).alias("total_spent"),
            (F.round("total_spent", 4) / F.col("lines")).alias("avg_order_value"),
        )
        .orderBy(F.desc("total_spent"), F.asc("customer_id"))
        .limit(k)
    )


def state_analysis(orders: DataFrame, items: DataFrame, customers: DataFrame) -> DataFrame:
    """Orders, revenue and customers per state.

    An order has one customer and a customer one state, so distinct orders and
    customers per state are sums over the per-customer rows.
    """
    return (
        customer_totals(orders, items)
        .join(customers, "customer_id")
        .groupBy("customer_state")
        .agg(
            F.sum("total_orders").alias("total_orders"),
            F.round(F.sum("total_spent"), 4).alias("total_revenue"),
            F.count(F.lit(1)).alias("unique_customers"),
            mean_of("total_spent").alias("avg_order_value"),
        )
        .orderBy(F.desc("total_revenue"), F.asc("customer_state"))
    )


def category_performance(items: DataFrame, products: DataFrame, k: int = 20) -> DataFrame:
    """Products, orders and revenue per category with at least one order.

    The category's products (sold or not) are counted on the product table and
    its sales on the items, so the outer join only meets one row per category.
    """
    owned = (
        products.filter(F.col("category").isNotNull())
        .groupBy("category")
        .agg(F.count_distinct("product_id").alias("unique_products"))
    )
    sold = category_lines(items, products).groupBy("category").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.round(F.sum("total_sum"), 4).alias("total_revenue"),
        mean_of("price_sum").alias("avg_product_price"),
    )
    return (
        owned.join(sold, "category", "left")
        .filter(F.col("total_orders") > 0)
        .orderBy(F.desc("total_revenue"), F.asc("category"))
        .limit(k)
    )


def category_performance_etl(orders: DataFrame, items: DataFrame, products: DataFrame) -> DataFrame:
    """Delivered-only variant with the mean delivery days.

    Lines shrink to one row for each order of a category, so that orders are rows
    to count; sold products are counted from their own distinct pairs.
    """
    known = products.filter(F.col("category").isNotNull()).select("product_id", "category")
    joined = orders.filter(F.col("order_status") == "F").join(items, "order_id").join(known, "product_id")
    lines = order_enrich(joined)
    per_order = lines.groupBy("category", "order_id").agg(
        F.sum("total_order_value").alias("value"),
        F.sum("price").alias("price"),
        F.count("price").alias("lines"),
        F.sum("delivery_days").alias("days"),
        F.count("delivery_days").alias("delivered"),
    )
    sold = per_order.groupBy("category").agg(
        F.count(F.lit(1)).alias("total_orders"),
        F.round(F.sum("value"), 4).alias("total_revenue"),
        (F.round(F.sum("price"), 4) / F.sum("lines")).alias("avg_product_price"),
        (F.sum("days") / F.sum("delivered")).alias("avg_delivery_days"),
    )
    products_sold = (
        lines.select("category", "product_id").distinct().groupBy("category").agg(F.count(F.lit(1)).alias("unique_products"))
    )
    return (
        products_sold.join(sold, "category")
        .select(
            "category", "unique_products", "total_orders", "total_revenue", "avg_product_price", "avg_delivery_days"
        )
        .orderBy(F.desc("total_revenue"), F.asc("category"))
    )


def delivery_performance(orders: DataFrame, items: DataFrame, customers: DataFrame) -> DataFrame:
    """Delivery days, slack (estimated minus delivered, positive is early) and on-time share per state.

    An order is delivered with its last item. Sums per customer come before the
    join to customers.
    """
    delivered = delivered_orders(orders, items).filter(F.col("delivered_ts").isNotNull())
    per_customer = delivered.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.datediff("delivered_ts", "purchase_ts")).alias("days"),
        F.sum(F.datediff("estimated_ts", "delivered_ts")).alias("slack"),
        F.count_if(F.col("delivered_ts") <= F.col("estimated_ts")).alias("on_time"),
    )
    n = F.sum("n")
    return (
        per_customer.join(customers, "customer_id")
        .groupBy("customer_state")
        .agg(
            (F.sum("days") / n).alias("avg_delivery_days"),
            (F.sum("slack") / n).alias("avg_slack_days"),
            (F.sum("on_time") * 100.0 / n).alias("on_time_delivery_pct"),
        )
        .orderBy(F.desc("on_time_delivery_pct"), F.asc("customer_state"))
    )


def customer_segments(
    orders: DataFrame,
    items: DataFrame,
    customers: DataFrame,
    high: float = 1000,
    medium: float = 500,
) -> DataFrame:
    """Per-customer totals with a spend tier. Customers unknown to the dimension are kept."""
    spent = F.round("total_spent", 4)
    return customer_totals(orders, items).join(customers, "customer_id", "left").select(
        "customer_id",
        "customer_city",
        "customer_state",
        "total_orders",
        spent.alias("total_spent"),
        (F.round("total_spent", 4) / F.col("lines")).alias("avg_order_value"),
        "first_order_date",
        "last_order_date",
        tier(spent, [(high, "High Value"), (medium, "Medium Value")], "Low Value").alias("customer_segment"),
    )


def progress_report(topics: DataFrame) -> DataFrame:
    """Topics per (period, module, status), with the module's completed share.

    The window runs over the counted rows, at most one per status.
    """
    counted = topics.groupBy("period", "module", "status").agg(F.count(F.lit(1)).alias("topics"))
    module = Window.partitionBy("period", "module")
    done = F.sum(F.when(F.col("status") == "Completed", F.col("topics")).otherwise(0)).over(module)
    return counted.withColumn("completion", done / F.sum("topics").over(module))
