"""Ranking, paging and set operations over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.views import over
from millrace.operators import sets, snapshots, sorting, windows
from millrace.registry import query
from millrace.session import run_dir
from millrace.sources import tables as t


@query(
    "win01_percent_of_total",
    "SELECT o_orderpriority, count(*) AS n, round(count(*) * 100.0::DOUBLE / sum(count(*)) OVER (), 2) AS percentage FROM orders GROUP BY o_orderpriority",
)
def win01(spark, sf):
    return windows.percent_of_total(t.table(spark, sf, "orders"), ["o_orderpriority"])


@query(
    "win02_first_per_key",
    over(
        "orders_v",
        """SELECT customer_id, order_id, purchase_ts FROM (
             SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY purchase_ts, order_id) AS rn FROM orders_v)
           WHERE rn = 1""",
    ),
)
def win02(spark, sf):
    narrow = t.orders(spark, sf).select("customer_id", "order_id", "purchase_ts")
    return windows.first_per_key(narrow, ["customer_id"], [F.asc("purchase_ts"), F.asc("order_id")])


@query(
    "win03_top_n_per_group",
    over(
        "products_v",
        """SELECT category, product_id, list_price, CAST(rn AS INTEGER) AS rank FROM (
             SELECT *, row_number() OVER (PARTITION BY category ORDER BY list_price DESC, product_id) AS rn FROM products_v)
           WHERE rn <= 5""",
    ),
)
def win03(spark, sf):
    return windows.top_n_per_group(
        t.products(spark, sf).select("category", "product_id", "list_price"),
        ["category"], [F.desc("list_price"), F.asc("product_id")], 5, rank="rank",
    )


@query(
    "win04_interleave",
    over(
        "articles_v",
        """SELECT source, doc_id, published_at, CAST(turn AS INTEGER) AS turn FROM (
             SELECT *, row_number() OVER (PARTITION BY source ORDER BY published_at DESC, doc_id) AS turn FROM articles_v)
           ORDER BY turn, source LIMIT 50""",
    ),
)
def win04(spark, sf):
    latest = t.articles(spark, sf).select("source", "doc_id", "published_at")
    return windows.interleave(latest, "source", [F.desc("published_at"), F.asc("doc_id")], 50)


@query(
    "win05_window_delta",
    over(
        "activity_v",
        """WITH c AS (SELECT time_bucket(INTERVAL 60 MINUTE, event_time) AS w, page AS keyword, count(*) AS n
                      FROM activity_v GROUP BY 1, 2)
           SELECT coalesce(a.w, b.w + INTERVAL 60 MINUTE) AS window_start, coalesce(a.keyword, b.keyword) AS keyword,
                  coalesce(a.n, 0) AS current_count, coalesce(b.n, 0) AS previous_count,
                  coalesce(a.n, 0) - coalesce(b.n, 0) AS trend_score
           FROM c a FULL JOIN c b ON a.w = b.w + INTERVAL 60 MINUTE AND a.keyword = b.keyword""",
    ),
)
def win05(spark, sf):
    counts = windows.window_counts(t.activity(spark, sf), "event_time", "page", 60)
    return windows.window_delta(counts, 60)


@query(
    "srt01_top_k",
    over("products_v", "SELECT product_id, list_price FROM products_v ORDER BY list_price DESC, product_id LIMIT 20"),
)
def srt01(spark, sf):
    return sorting.top_k(
        t.products(spark, sf).select("product_id", "list_price"), [F.desc("list_price"), F.asc("product_id")], 20
    )


@query("srt02_full_sort", "SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey")
def srt02(spark, sf):
    return sorting.full_sort(
        t.table(spark, sf, "customer").select("c_custkey", "c_acctbal"), [F.desc("c_acctbal"), F.asc("c_custkey")]
    )


@query(
    "srt03_page",
    over("claims_v", "SELECT claim_id, claim_date FROM claims_v ORDER BY claim_date DESC, claim_id LIMIT 20 OFFSET 40"),
)
def srt03(spark, sf):
    return sorting.page(
        t.claims(spark, sf).select("claim_id", "claim_date"), [F.desc("claim_date"), F.asc("claim_id")], 3, 20
    )


@query(
    "srt03_deep_page",
    "SELECT l_orderkey, l_linenumber, l_extendedprice FROM lineitem ORDER BY l_extendedprice DESC, l_orderkey, l_linenumber LIMIT 20 OFFSET (SELECT count(*) // 2 // 20 * 20 FROM lineitem)",
)
def srt03_deep(spark, sf):
    """The page in the middle of all line items; the ranges before it are not read."""
    lines = t.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_extendedprice")
    pages = sorting.paged(lines, [F.desc("l_extendedprice"), F.asc("l_orderkey"), F.asc("l_linenumber")])
    return pages.page(pages.total // 2 // 20 + 1, 20)


@query(
    "srt03_page_totals",
    over("claims_v", "SELECT count(*) AS total, greatest(CAST(ceil(count(*) / 20.0) AS BIGINT), 1) AS pages FROM claims_v"),
)
def srt03_totals(spark, sf):
    return sorting.page_totals(t.claims(spark, sf), 20)


@query(
    "srt04_latest_ascending",
    over(
        "claims_v",
        """SELECT * FROM (SELECT CAST(claim_date AS DATE) AS summary_date, count(*) AS total_claims
             FROM claims_v GROUP BY 1 ORDER BY 1 DESC LIMIT 30) ORDER BY summary_date""",
    ),
)
def srt04(spark, sf):
    daily = t.claims(spark, sf).groupBy(F.to_date("claim_date").alias("summary_date")).agg(
        F.count(F.lit(1)).alias("total_claims")
    )
    return sorting.latest_ascending(daily, "summary_date", 30)


@query(
    "set01_union_all",
    """SELECT c_custkey AS key, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment FROM customer
       UNION ALL SELECT s_suppkey, s_name, s_acctbal, NULL FROM supplier""",
)
def set01(spark, sf):
    buyers = t.table(spark, sf, "customer").selectExpr(
        "c_custkey AS key", "c_name AS name", "c_acctbal AS balance", "c_mktsegment AS segment"
    )
    sellers = t.table(spark, sf, "supplier").selectExpr("s_suppkey AS key", "s_name AS name", "s_acctbal AS balance")
    return sets.union_all(buyers, sellers)


@query("set02_distinct_sorted", "SELECT DISTINCT p_brand FROM part ORDER BY p_brand")
def set02(spark, sf):
    return sets.distinct_sorted(t.table(spark, sf, "part"), "p_brand")


@query(
    "set03_drop_duplicates",
    "SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem",
)
def set03(spark, sf):
    return sets.drop_duplicate_rows(t.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"))


@query(
    "set03_duplicate_count",
    """SELECT CAST(sum(n) AS BIGINT) AS rows, count(*) AS distinct_rows, CAST(sum(n - 1) AS BIGINT) AS duplicates
       FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber)""",
)
def set03_count(spark, sf):
    return sets.duplicate_count(t.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"))


@query(
    "set04_new_by_key",
    over(
        "articles_v",
        """WITH seen AS (SELECT DISTINCT id FROM articles_v JOIN labels USING (doc_id))
           SELECT id, min(doc_id) AS doc_id FROM articles_v
           WHERE id <> '' AND id NOT IN (SELECT id FROM seen) GROUP BY id""",
    ),
)
def set04(spark, sf):
    """Articles whose text no labelled document has, first of each text."""
    feed = t.articles(spark, sf).select("id", "doc_id")
    seen = feed.join(t.table(spark, sf, "labels").select("doc_id"), "doc_id", "left_semi")
    return sets.new_by_key(feed, "id", [F.asc("doc_id")], seen).select("id", "doc_id")


@query(
    "set05_snapshot_changes",
    """WITH old AS (SELECT lang, md5(text) AS body FROM documents),
            new AS (SELECT lang, md5(CASE WHEN source IN ('src3', 'src5') THEN text || '.' ELSE text END) AS body FROM documents)
       SELECT lang, body, 'added' AS change FROM (SELECT * FROM new EXCEPT SELECT * FROM old)
       UNION ALL SELECT lang, body, 'removed' FROM (SELECT * FROM old EXCEPT SELECT * FROM new)""",
)
def set05(spark, sf):
    """The documents before and after two sources changed their texts."""
    docs = t.table(spark, sf, "documents")
    edited = F.when(F.col("source").isin("src3", "src5"), F.concat("text", F.lit("."))).otherwise(F.col("text"))
    old = docs.select("lang", F.md5("text").alias("body"))
    new = docs.select("lang", F.md5(edited).alias("body"))
    return sets.snapshot_changes(new, old, ["lang", "body"])


@query(
    "set05_stored_snapshots",
    """WITH old AS (SELECT event_type, user_id, ts FROM events),
            new AS (SELECT event_type, user_id, CASE WHEN user_id = 7 THEN ts + INTERVAL 1 HOUR ELSE ts END AS ts FROM events)
       SELECT event_type, user_id, ts, 'added' AS change FROM (SELECT * FROM new EXCEPT SELECT * FROM old)
       UNION ALL SELECT event_type, user_id, ts, 'removed' FROM (SELECT * FROM old EXCEPT SELECT * FROM new)""",
)
def set05_stored(spark, sf):
    """Two stored snapshots of the events, one user's an hour later; only the buckets whose hashes differ are read again."""
    events = t.table(spark, sf, "events")
    root = run_dir(spark, "snapshots")
    later = F.when(F.col("user_id") == 7, F.col("ts") + F.expr("INTERVAL 1 HOUR")).otherwise(F.col("ts"))
    snapshots.store(events.select("event_type", "user_id", "ts"), f"{root}/old", ["event_type", "user_id", "ts"], 64)
    snapshots.store(events.select("event_type", "user_id", later.alias("ts")), f"{root}/new", ["event_type", "user_id", "ts"], 64)
    return snapshots.changes(spark, f"{root}/new", f"{root}/old")
