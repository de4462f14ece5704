"""Sources and sinks: given tables written, changed and read back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.catalog.views import over
from millrace.plans import commerce, readings
from millrace.plans import claims as claim_plans
from millrace.registry import query
from millrace.schemas import READINGS_SCHEMA
from millrace.session import run_dir
from millrace.sinks import daily, keyed
from millrace.sinks import files as out
from millrace.sinks import tables as sink
from millrace.sinks.kafka import keyed_json
from millrace.sources import files as src
from millrace.sources import tables as t


BUCKETS = 16  # of the stored tables here; each is small


@query("src01_read_csv", "SELECT p_partkey AS id, p_name, p_size, p_retailprice FROM part")
def src01(spark, sf):
    path = run_dir(spark, "src01")
    out.write_csv(t.table(spark, sf, "part").selectExpr("p_partkey AS id", "p_name", "p_size", "p_retailprice"), path)
    return src.read_csv(spark, path).withColumn("id", F.col("id").cast("long"))


@query("src02_read_delimited", "SELECT o_orderkey AS order_key, o_orderstatus AS order_state, o_totalprice AS amount FROM orders")
def src02(spark, sf):
    """Columns by position: the header names differ from the declared ones."""
    path = run_dir(spark, "src02")
    out.write_csv(t.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice"), path)
    schema = T.StructType.fromDDL("order_key bigint, order_state string, amount double")
    return src.read_delimited(spark, path, schema)


@query(
    "src03_read_or_build",
    over(
        "items_v orders_v customers_v",
        """SELECT customer_id, count(DISTINCT order_id) AS total_orders, round(sum(price), 4) AS total_spent,
                  round(sum(price), 4) / count(*) AS avg_order_value, min(purchase_ts) AS first_order_date,
                  max(purchase_ts) AS last_order_date, customer_city, customer_state
           FROM orders_v JOIN items_v USING (order_id) LEFT JOIN customers_v USING (customer_id)
           GROUP BY customer_id, customer_city, customer_state""",
    ),
)
def src03(spark, sf):
    """The first call builds the customer features, the second reads the stored ones."""
    path = run_dir(spark, "src03")

    def build():
        return commerce.customer_features(t.orders(spark, sf), t.items(spark, sf), t.customers(spark, sf))

    out.write_parquet(src.read_or_build(spark, path, build), path)
    return src.read_or_build(spark, path, build)


@query(
    "src07_json_documents",
    """SELECT user_id, event_id // 24 AS record, count(*) AS readings, count(CASE WHEN event_id % 7 <> 0 THEN value END) AS present
       FROM events GROUP BY 1, 2""",
)
def src07(spark, sf):
    """Nested documents with parallel arrays, stored one per line."""
    path = run_dir(spark, "src07")
    readings.as_records(t.table(spark, sf, "events")).write.option("ignoreNullFields", False).json(path)
    docs = src.read_json_docs(spark, path, READINGS_SCHEMA, multiline=False)
    return docs.select(
        "user_id",
        "record",
        F.size("hourly.time").cast("long").alias("readings"),
        F.size(F.filter("hourly.value", lambda v: v.isNotNull())).cast("long").alias("present"),
    )


@query("snk01_write_parquet", "SELECT event_type, CAST(ts AS DATE) AS day, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-08' GROUP BY ALL")
def snk01(spark, sf):
    """Partitioned by day; reading a week touches only its folders."""
    path = run_dir(spark, "snk01")
    events = t.table(spark, sf, "events").withColumn("day", F.to_date("ts"))
    out.write_parquet(events, path, ["day"])
    week = spark.read.parquet(path).filter(F.col("day") < F.lit("2024-01-08").cast("date"))
    return week.groupBy("event_type", "day").agg(F.count(F.lit(1)).alias("n"))


@query("snk02_write_csv", "SELECT event_type, count(*) AS total_count FROM events GROUP BY event_type")
def snk02(spark, sf):
    path = run_dir(spark, "snk02")
    counts = t.table(spark, sf, "events").groupBy("event_type").agg(F.count(F.lit(1)).alias("total_count"))
    out.write_csv(counts, path, single=True)
    return src.read_csv(spark, path, T.StructType.fromDDL("event_type string, total_count bigint"))


@query(
    "snk03_insert_overwrite_table",
    over(
        "items_v products_v",
        """SELECT category, round(sum(price + freight_value), 4) AS total_sales, count(DISTINCT order_id) AS total_orders,
                  round(sum(price), 4) / count(*) AS avg_price, '2024-02-01' AS processing_date
           FROM items_v JOIN products_v USING (product_id) GROUP BY category""",
    ),
)
def snk03(spark, sf):
    """A second overwrite replaces the rows of the first."""
    name = f"sales_summary_{uuid.uuid4().hex}"
    path = run_dir(spark, "snk03")
    summary = commerce.sales_summary(t.items(spark, sf), t.products(spark, sf), "2024-02-01")
    sink.insert_overwrite_table(summary.withColumn("processing_date", F.lit("2024-01-31")), name, path=path)
    sink.insert_overwrite_table(summary, name)
    return spark.table(name)


@query("snk05_keyed_json", "SELECT CAST(p_partkey AS VARCHAR) AS key, p_partkey, p_name, p_size FROM part")
def snk05(spark, sf):
    part = t.table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    messages = keyed_json(part, "p_partkey")
    return messages.select("key", F.from_json("value", part.schema).alias("d")).select("key", "d.*")


@query(
    "snk08_append_ndjson",
    "SELECT 2 * count(DISTINCT user_id) AS total_records FROM events",
)
def snk08(spark, sf):
    """Two runs append; the total is counted over the store."""
    path = run_dir(spark, "snk08")
    report = t.table(spark, sf, "events").groupBy("user_id").agg(F.round(F.avg("value"), 2).alias("avg_value"))
    out.append_ndjson(report, path)
    total = out.append_ndjson(report, path)
    store = spark.read.schema(report.schema).json(path)
    return store.agg(F.count(F.lit(1)).alias("total_records")).filter(F.col("total_records") == total)


@query(
    "job30_reading_reports",
    """WITH r AS (SELECT user_id, event_id // 24 AS record, ts,
                        CASE WHEN event_id % 7 <> 0 THEN value END AS value FROM events),
            s AS (SELECT user_id, record, strftime(min(ts), '%Y-%m-%d') AS date, round(min(value), 2) AS min_value,
                         round(max(value), 2) AS max_value, count(value) AS total_readings
                  FROM r GROUP BY user_id, record HAVING count(value) > 0)
       SELECT *, (SELECT count(*) FROM s) AS total_records FROM s""",
)
def job30(spark, sf):
    """Reports of all records appended to the store, read back with the store's total."""
    path = run_dir(spark, "job30")
    reports = readings.report(readings.as_records(t.table(spark, sf, "events"))).select(
        "user_id", "record", "date", "min_value", "max_value", "total_readings"
    )
    total = out.append_ndjson(reports, path)
    return spark.read.schema(reports.schema).json(path).withColumn("total_records", F.lit(total).cast("long"))


@query(
    "snk09_merge_insert_new",
    """WITH a AS (SELECT md5(text) AS id, min(doc_id) AS doc_id FROM documents JOIN labels USING (doc_id) GROUP BY 1),
            b AS (SELECT md5(text) AS id, min(doc_id) AS doc_id FROM documents GROUP BY 1)
       SELECT * FROM a UNION ALL SELECT * FROM b WHERE id NOT IN (SELECT id FROM a)""",
)
def snk09(spark, sf):
    """All documents merged into a stored table of the labelled ones; known texts are skipped, no file is rewritten."""
    rows = t.articles(spark, sf).select("id", "doc_id")
    first = [F.asc("doc_id")]
    labelled = rows.join(t.table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi").select("id", "doc_id")
    name = f"texts_{uuid.uuid4().hex}"
    keyed.create(sink.merge_insert_new(rows.limit(0), labelled, "id", first), name, "id", BUCKETS)
    keyed.insert_new(spark, name, rows, first)
    return keyed.read(spark, name)


@query(
    "snk10_merge_upsert",
    over(
        "claims_v",
        """SELECT CAST(claim_date AS DATE) AS summary_date, count(*) AS total_claims, round(sum(claim_amount), 2) AS total_amount,
                  count(*) FILTER (insurance_status = 'APPROVED') AS approved_claims,
                  count(*) FILTER (insurance_status = 'DENIED') AS denied_claims, count(*) FILTER (is_fraud) AS fraud_detected,
                  round(sum(claim_amount), 2) / count(*) AS avg_claim_amount FROM claims_v GROUP BY 1""",
    ),
)
def snk10(spark, sf):
    """A summary of the claims before 1999 (with two days wrong) brought up to date by the full one."""
    claims = t.claims(spark, sf)
    fresh = claim_plans.daily_summary(claims)
    stale = (
        claim_plans.daily_summary(claims.filter("claim_date < TIMESTAMP_NTZ'1999-01-01'"))
        .withColumn("total_claims", F.when(F.dayofmonth("summary_date") == 1, 0).otherwise(F.col("total_claims")))
    )
    name = f"daily_summary_{uuid.uuid4().hex}"
    keyed.create(stale, name, "summary_date", BUCKETS)
    keyed.upsert(spark, name, fresh, [F.asc("summary_date")])
    return keyed.read(spark, name)


@query(
    "snk11_append_history",
    "SELECT lang, count(*) AS docs, '2024-02-02T06-00-00' AS run_ts FROM documents GROUP BY lang",
)
def snk11(spark, sf):
    path = run_dir(spark, "snk11")
    docs = t.table(spark, sf, "documents")
    per_lang = docs.groupBy("lang").agg(F.count(F.lit(1)).alias("docs"))
    out.append_history(per_lang.filter("lang <> 'en'"), path, "2024-02-01 06:00:00")
    out.append_history(per_lang, path, "2024-02-02 06:00:00")
    return out.latest_history(spark.read.parquet(path)).select("lang", "docs", "run_ts")


@query(
    "snk12_quarantine",
    over(
        "claims_v",
        """SELECT reason, count(*) AS n FROM (SELECT CASE WHEN claim_id = 0 THEN 'Missing required field: claim_id'
                  WHEN patient_id = 0 THEN 'Missing required field: patient_id'
                  WHEN hospital_id = 0 THEN 'Missing required field: hospital_id'
                  WHEN claim_amount > 400000 THEN 'claim_amount exceeds maximum threshold' ELSE 'OK' END AS reason FROM claims_v)
           GROUP BY reason""",
    ),
)
def snk12(spark, sf):
    path = run_dir(spark, "snk12")
    checked = claim_plans.validate_claims(t.claims(spark, sf), ceiling=400_000)
    good = out.quarantine(checked, "reason", path, run_id="first")
    both = good.select("reason").unionByName(spark.read.parquet(path).select("reason"))
    return both.groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


@query(
    "snk13_delete_older_than",
    over(
        "alerts_v",
        """SELECT alert_id, resolved, resolved_at FROM alerts_v
           WHERE NOT coalesce(resolved_at < TIMESTAMP '2001-08-01' - INTERVAL 90 DAY AND resolved, FALSE)""",
    ),
)
def snk13(spark, sf):
    """From a table by month: months of which all goes are forgotten, those that keep some rows are rewritten."""
    name = f"alerts_{uuid.uuid4().hex}"
    daily.create(t.alerts(spark, sf).select("alert_id", "resolved", "resolved_at"), name, F.col("resolved_at"), "month")
    daily.delete_older_than(spark, name, F.col("resolved_at"), t.CLAIMS_AS_OF, 90, F.col("resolved"))
    return daily.read(spark, name)


@query(
    "snk13_delete_old_events",
    "SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-20 12:00:00' - INTERVAL 7 DAY",
)
def snk13_events(spark, sf):
    """Days before the limit are forgotten unread; only the day of the limit is rewritten."""
    name = f"events_{uuid.uuid4().hex}"
    daily.create(t.table(spark, sf, "events").select("event_id", "ts"), name, F.col("ts"))
    daily.delete_older_than(spark, name, F.col("ts"), "2024-01-20 12:00:00", 7)
    return daily.read(spark, name)


@query(
    "snk13_delete_old_articles",
    over(
        "articles_v",
        """SELECT doc_id, published_at FROM articles_v
           WHERE NOT coalesce(TRY_CAST(CASE WHEN doc_id % 10 = 0 THEN 'unknown' ELSE published_at END AS TIMESTAMP)
                              < TIMESTAMP '2024-01-31 12:00:00' - INTERVAL 30 DAY, FALSE)""",
    ),
)
def snk13_articles(spark, sf):
    """Text timestamps are parsed first; one in ten cannot be read and stays."""
    written = F.when(F.col("doc_id") % 10 == 0, "unknown").otherwise(F.col("published_at"))
    kept = sink.delete_older_than(t.articles(spark, sf), written.try_cast("timestamp_ntz"), "2024-01-31 12:00:00", 30)
    return kept.select("doc_id", "published_at")


@query("snk14_delete_by_key", "SELECT c_custkey, c_name FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P')")
def snk14(spark, sf):
    keys = t.table(spark, sf, "orders").filter("o_orderstatus = 'P'").select(F.col("o_custkey").alias("c_custkey")).distinct()
    name = f"customers_{uuid.uuid4().hex}"
    keyed.create(t.table(spark, sf, "customer").select("c_custkey", "c_name"), name, "c_custkey", BUCKETS)
    keyed.delete(spark, name, keys)
    return keyed.read(spark, name)


@query(
    "prj06_update_stored",
    """SELECT o_orderkey, CASE WHEN o_orderdate < TIMESTAMP '1996-01-01' AND o_orderstatus = 'O' THEN 'P' ELSE o_orderstatus END AS o_orderstatus,
              o_orderdate FROM orders""",
)
def prj06_stored(spark, sf):
    """Old open orders of a stored table are closed; buckets without one keep their files."""
    name = f"orders_{uuid.uuid4().hex}"
    keyed.create(t.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate"), name, "o_orderkey", BUCKETS)
    old = F.col("o_orderdate") < F.expr("TIMESTAMP_NTZ'1996-01-01'")
    keyed.update_where(spark, name, old & (F.col("o_orderstatus") == "O"), {"o_orderstatus": F.lit("P")})
    return keyed.read(spark, name)


@query(
    "prj07_partial_update_stored",
    """WITH u AS (SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN 'moved' END AS c_name, c_acctbal + 1 AS c_acctbal
                  FROM customer WHERE c_mktsegment = 'BUILDING')
       SELECT c.c_custkey, coalesce(u.c_name, c.c_name) AS c_name, coalesce(u.c_acctbal, c.c_acctbal) AS c_acctbal
       FROM customer c LEFT JOIN u USING (c_custkey)""",
)
def prj07_stored(spark, sf):
    """Some customers of a stored table get another name or balance; what is not given stays."""
    customer = t.table(spark, sf, "customer")
    name = f"customers_{uuid.uuid4().hex}"
    keyed.create(customer.select("c_custkey", "c_name", "c_acctbal"), name, "c_custkey", BUCKETS)
    updates = customer.filter("c_mktsegment = 'BUILDING'").select(
        "c_custkey", F.expr("CASE WHEN c_custkey % 2 = 0 THEN 'moved' END").alias("c_name"), (F.col("c_acctbal") + 1).alias("c_acctbal")
    )
    keyed.partial_update(spark, name, updates)
    return keyed.read(spark, name)


@query(
    "snk15_nest_families",
    """SELECT p_partkey, p_type AS category, p_size || 'x0x' || p_linenumber AS dimensions, 'available' AS stock_status, 0 AS total_sold
       FROM (SELECT *, p_partkey % 3 AS p_linenumber FROM part)""",
)
def snk15(spark, sf):
    part = t.table(spark, sf, "part").withColumns(
        {"height": F.lit(None).cast("int"), "width": F.col("p_partkey") % 3}
    )
    wide = sink.nest_families(
        part,
        "p_partkey",
        {
            "info": {
                "category": F.coalesce(F.col("p_type"), F.lit("unknown")),
                "dimensions": sink.dimensions("p_size", "height", "width"),
            },
            "sales": {"total_sold": F.lit(0)},
            "inventory": {"stock_status": F.lit("available")},
        },
    )
    return wide.select(
        "p_partkey", "info.category", "info.dimensions", "inventory.stock_status", "sales.total_sold"
    )
