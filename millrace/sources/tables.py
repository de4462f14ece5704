"""The given Parquet tables and the domain views bound to them.

The library's jobs take any DataFrame with the right columns; these views give
the registered queries such DataFrames from the given tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Latest claim date bound; claim dates are whole days.
CLAIMS_AS_OF = "2001-08-01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_orderdate").alias("purchase_ts"),
        (F.col("o_orderdate") + F.expr("INTERVAL 60 DAYS")).alias("estimated_ts"),
        F.col("o_totalprice").alias("order_value"),
        F.col("o_orderpriority").alias("priority"),
    )


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("order_id"),
        F.col("l_linenumber").alias("order_item_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_suppkey").alias("seller_id"),
        F.col("l_extendedprice").alias("price"),
        (F.col("l_extendedprice") * F.col("l_tax")).alias("freight_value"),
        F.col("l_shipdate").alias("delivered_ts"),
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_type").alias("category"),
        F.col("p_name").alias("product_name"),
        F.col("p_brand").alias("brand"),
        F.col("p_size").alias("size"),
        F.col("p_retailprice").alias("list_price"),
    )


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("customer_id"),
            F.col("c_mktsegment").alias("customer_city"),
            F.col("n_name").alias("customer_state"),
        )
    )


def pick(index: Column, values: list[str]) -> Column:
    """The value at a zero-based position, as a CASE chain."""
    chain = F.when(index == 0, F.lit(values[0]))
    for position, value in enumerate(values[1:], start=1):
        chain = chain.when(index == position, F.lit(value))
    return chain


INSURANCE_TYPES = ["MEDICARE", "MEDICAID", "PRIVATE", "UNINSURED"]
HOSPITAL_TYPES = ["GENERAL", "SPECIALTY", "TEACHING", "CRITICAL_ACCESS"]


def claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_claims(table(spark, sf_dir, "orders"))


def as_claims(order_rows: DataFrame) -> DataFrame:
    """Orders (batch or stream) as insurance claims."""
    key = F.col("o_orderkey")
    status = F.col("o_orderstatus")
    hospital = key % 10
    return order_rows.select(
        key.alias("claim_id"),
        F.col("o_custkey").alias("patient_id"),
        hospital.alias("hospital_id"),
        (key % 15).cast("int").alias("treatment_code"),
        F.col("o_orderpriority").alias("diagnosis_code"),
        F.col("o_totalprice").alias("claim_amount"),
        (F.col("o_totalprice") * (F.lit(0.5) + (key % 50) / F.lit(100.0))).alias("approved_amount"),
        F.when(status == "F", "APPROVED").when(status == "P", "DENIED").otherwise("PENDING")
        .alias("insurance_status"),
        F.col("o_orderdate").alias("claim_date"),
        (key % 20 == 0).alias("is_fraud"),
        ((key * 7919) % 10000 / F.lit(10000.0)).alias("fraud_score"),
        F.when(status == "O", "PENDING").otherwise("PROCESSED").alias("status"),
        pick(F.col("o_custkey") % 4, INSURANCE_TYPES).alias("insurance_type"),
        pick(hospital % 4, HOSPITAL_TYPES).alias("hospital_type"),
    )


def patients(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("c_custkey").alias("patient_id"),
            F.col("n_name").alias("state"),
            pick(F.col("c_custkey") % 4, INSURANCE_TYPES).alias("insurance_type"),
            ((F.col("c_custkey") * 37) % 100 / F.lit(100.0)).alias("risk_score"),
        )
    )


def hospitals(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .select(
            F.col("s_suppkey").alias("hospital_id"),
            F.col("s_name").alias("hospital_name"),
            F.col("n_name").alias("state"),
            ((F.col("s_suppkey") * 13) % 100).cast("double").alias("performance_score"),
        )
    )


def treatments(spark: SparkSession) -> DataFrame:
    """Fifteen treatment codes with an average cost; fixed size, safe to broadcast."""
    code = F.col("id").cast("int")
    return spark.range(15).select(
        code.alias("treatment_code"), ((code + 1) * F.lit(10000.0)).alias("avg_cost")
    )


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = F.col("fraud_score")
    return (
        claims(spark, sf_dir)
        .filter(score >= 0.7)
        .select(
            F.col("claim_id").alias("alert_id"),
            "claim_id",
            "patient_id",
            "hospital_id",
            "fraud_score",
            F.when(F.col("claim_amount") > 300000, "HIGH_AMOUNT").otherwise("ML_DETECTED")
            .alias("alert_type"),
            F.when(score >= 0.95, "CRITICAL").when(score >= 0.85, "HIGH")
            .when(score >= 0.75, "MEDIUM").otherwise("LOW").alias("severity"),
            (F.col("claim_id") % 3 == 0).alias("resolved"),
            F.col("claim_date").alias("created_at"),
            F.when(F.col("claim_id") % 3 == 0, F.col("claim_date") + F.expr("INTERVAL 5 DAYS"))
            .alias("resolved_at"),
        )
    )


def activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        F.when(F.col("event_type") == "signup", "login").otherwise(F.col("event_type"))
        .alias("event_type"),
        F.col("ts").alias("event_time"),
        F.get_json_object("props", "$.k").alias("page"),
        "value",
    )


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as news articles: the first line is the title, the rest the description."""
    title = F.substring_index("text", "\n", 1)
    # One minute for each id; after a thousand years the minutes start again, so any id gives a date.
    minutes = F.pmod(F.col("doc_id"), F.lit(525_960_000)).cast("int")
    published = F.expr("TIMESTAMP_NTZ'2024-01-01'") + F.make_dt_interval(mins=minutes)
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.md5("text").alias("id"),
        title.alias("title"),
        F.expr("substr(text, length(substring_index(text, '\n', 1)) + 2)").alias("description"),
        F.lit("").alias("content"),
        "source",
        "lang",
        "n_chars",
        F.date_format(published, "yyyy-MM-dd'T'HH:mm:ss")
        .alias("published_at"),
    )
