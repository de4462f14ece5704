"""Scalar function groups over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.catalog.views import over
from millrace.functions import dates, numbers, text
from millrace.operators.quantiles import quantiles
from millrace.registry import query
from millrace.sources import tables as t


@query(
    "fn01_month_key",
    "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month, strftime(o_orderdate, '%Y-%m-%d') AS day FROM orders",
)
def fn01(spark, sf):
    return t.table(spark, sf, "orders").select(
        "o_orderkey", dates.month_key(F.col("o_orderdate")).alias("month"), dates.day_text(F.col("o_orderdate")).alias("day")
    )


@query(
    "fn02_date_parts",
    """SELECT event_id, CAST(year(ts) AS INTEGER) AS y, CAST(month(ts) AS INTEGER) AS m,
              CAST(dayofweek(ts) + 1 AS INTEGER) AS dow, CAST(ts AS DATE) AS d FROM events""",
)
def fn02(spark, sf):
    ts = F.col("ts")
    return t.table(spark, sf, "events").select(
        "event_id", F.year(ts).alias("y"), F.month(ts).alias("m"), F.dayofweek(ts).alias("dow"), F.to_date(ts).alias("d")
    )


@query(
    "fn03_date_difference",
    """SELECT l_orderkey, l_linenumber, l_partkey, CAST(date_diff('day', l_shipdate, TIMESTAMP '2001-08-01') AS INTEGER) AS age_days,
              l_shipdate + INTERVAL 60 DAY AS due FROM lineitem""",
)
def fn03(spark, sf):
    return t.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.datediff(F.lit("2001-08-01").cast("date"), F.col("l_shipdate")).alias("age_days"),
        (F.col("l_shipdate") + F.expr("INTERVAL 60 DAYS")).alias("due"),
    )


@query(
    "fn04_month_start",
    "SELECT o_orderkey, CAST(date_trunc('month', o_orderdate) AS DATE) AS month_start FROM orders",
)
def fn04(spark, sf):
    d = F.col("o_orderdate")
    return t.table(spark, sf, "orders").select("o_orderkey", dates.month_start(F.year(d), F.month(d)).alias("month_start"))


@query(
    "fn05_mixed_dates",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 3 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS parsed FROM orders""",
)
def fn05(spark, sf):
    """Order dates written in three layouts (and one unreadable) are parsed back."""
    d, k = F.col("o_orderdate"), F.col("o_orderkey") % 4
    written = (
        F.when(k == 0, F.date_format(d, "yyyy-MM-dd"))
        .when(k == 1, F.date_format(d, "MM/dd/yyyy"))
        .when(k == 2, F.date_format(d, "MMM d, yyyy"))
        .otherwise(F.lit("not a date"))
    )
    return t.table(spark, sf, "orders").select("o_orderkey", dates.parse_mixed_date(written).alias("parsed"))


@query(
    "fn06_numeric_functions",
    """SELECT c_custkey, least(99.0::DOUBLE, greatest(0.0::DOUBLE, c_acctbal / 100)) AS clamped,
              c_acctbal / nullif(c_custkey % 5, 0) AS per_slot, coalesce(c_acctbal / nullif(c_custkey % 5, 0), -1.0::DOUBLE) AS filled,
              CAST(ceil(c_acctbal / 20) AS BIGINT) AS pages, least(c_acctbal, 1.0::DOUBLE) AS capped FROM customer""",
)
def fn06(spark, sf):
    bal, slot = F.col("c_acctbal"), F.nullif(F.col("c_custkey") % 5, F.lit(0).cast("long"))
    return t.table(spark, sf, "customer").select(
        "c_custkey",
        numbers.clamp(bal / 100, 0.0, 99.0).alias("clamped"),
        (bal / slot).alias("per_slot"),
        F.coalesce(bal / slot, F.lit(-1.0)).alias("filled"),
        F.ceil(bal / 20).alias("pages"),
        F.least(bal, F.lit(1.0)).alias("capped"),
    )


@query("fn07_log", "SELECT o_orderkey, round(ln(o_totalprice), 9) AS log_price FROM orders")
def fn07(spark, sf):
    return t.table(spark, sf, "orders").select("o_orderkey", F.round(F.log("o_totalprice"), 9).alias("log_price"))


@query(
    "fn08_strip_markup",
    r"SELECT page_id, regexp_replace(regexp_replace(html, '<[^>]+>', '', 'g'), '[\s\x0B]+', ' ', 'g') AS clean FROM pages",
)
def fn08(spark, sf):
    return t.table(spark, sf, "pages").select("page_id", text.strip_markup(F.col("html")).alias("clean"))


@query(
    "fn09_text_case",
    """SELECT c_custkey, upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS title, lower(c_name) AS lowered,
              replace(c_name, 'Customer#', 'C-') AS renamed, trim('  ' || c_name || ' ') AS trimmed FROM customer""",
)
def fn09(spark, sf):
    return t.table(spark, sf, "customer").select(
        "c_custkey",
        text.title_case(F.concat(F.lit(" "), F.col("c_mktsegment"))).alias("title"),
        F.lower("c_name").alias("lowered"),
        F.replace("c_name", F.lit("Customer#"), F.lit("C-")).alias("renamed"),
        F.trim(F.concat(F.lit("  "), F.col("c_name"), F.lit(" "))).alias("trimmed"),
    )


@query(
    "fn10_number_words",
    """SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN 60000.0::DOUBLE WHEN 1 THEN o_totalprice END AS salary FROM orders""",
)
def fn10(spark, sf):
    k = F.col("o_orderkey") % 3
    written = F.when(k == 0, " SIXTY THOUSAND ").when(k == 1, F.col("o_totalprice").cast("string")).otherwise("unknown")
    return t.table(spark, sf, "orders").select(
        "o_orderkey", numbers.to_number(written, numbers.SALARY_WORDS).alias("salary")
    )


@query("fn11_md5_id", "SELECT page_id, md5(url) AS id FROM pages")
def fn11(spark, sf):
    return t.table(spark, sf, "pages").select("page_id", F.md5("url").alias("id"))


@query(
    "fn12_epoch_iso",
    "SELECT event_id, CASE WHEN event_id = 0 THEN '' ELSE strftime(make_timestamp(event_id * 1000000 * 3600), '%Y-%m-%dT%H:%M:%S') END AS iso FROM events",
)
def fn12(spark, sf):
    return t.table(spark, sf, "events").select("event_id", dates.epoch_to_iso(F.col("event_id") * 3600).alias("iso"))


@query(
    "fn13_json_round_trip",
    "SELECT p_partkey, p_name, p_size FROM part",
)
def fn13(spark, sf):
    part = t.table(spark, sf, "part").select("p_partkey", "p_name", "p_size")
    packed = part.select(F.to_json(F.struct("*")).alias("value"))
    return packed.select(F.from_json("value", part.schema).alias("d")).select("d.*")


@query(
    "fn14_array_functions",
    """SELECT doc_id, CAST(len(string_split(text, ' ')) AS INTEGER) AS n_words, string_split(text, ' ')[1] AS first_word,
              string_split(text, ' ')[-1] AS last_word FROM documents""",
)
def fn14(spark, sf):
    parts = F.split("text", " ")
    return t.table(spark, sf, "documents").select(
        "doc_id", F.size(parts).alias("n_words"), F.element_at(parts, 1).alias("first_word"), F.element_at(parts, -1).alias("last_word")
    )


STOP_SQL = ", ".join("'" + w.replace("'", "''") + "'" for w in text.STOP_WORDS)
# Same words as the expression: letters only, split at white space, long enough, not a stop word.
TOKENS_SQL = (
    "list_filter(string_split_regex(regexp_replace(lower({body}), '[^a-z\\s\\x0B\\x1C-\\x1F\\x{{85}}\\x{{A0}}\\x{{1680}}"
    "\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]', '', 'g'), "
    "'[\\s\\x0B\\x1C-\\x1F\\x{{85}}\\x{{A0}}\\x{{1680}}\\x{{2000}}-\\x{{200A}}\\x{{2028}}\\x{{2029}}\\x{{202F}}\\x{{205F}}\\x{{3000}}]+'), "
    "lambda w: length(w) > 3 AND w NOT IN (" + STOP_SQL + "))"
)


@query(
    "fn15_keyword_tokens",
    f"SELECT doc_id, array_to_string({TOKENS_SQL.format(body='text')}, ' ') AS tokens FROM documents",
)
def fn15(spark, sf):
    return t.table(spark, sf, "documents").select(
        "doc_id", F.array_join(text.keyword_tokens(F.col("text")), " ").alias("tokens")
    )


@query(
    "fn16_bins",
    """WITH q AS (SELECT quantile_cont(p_retailprice, 0.25) AS a, quantile_cont(p_retailprice, 0.5) AS b,
                         quantile_cont(p_retailprice, 0.75) AS c FROM part)
       SELECT p_partkey, CASE WHEN p_size <= 0 THEN NULL WHEN p_size <= 10 THEN 'small' WHEN p_size <= 30 THEN 'medium'
                              WHEN p_size <= 45 THEN 'large' END AS size_group,
              CASE WHEN p_retailprice <= a THEN 'Low' WHEN p_retailprice <= b THEN 'Medium'
                   WHEN p_retailprice <= c THEN 'High' ELSE 'Very High' END AS price_group
       FROM part, q""",
)
def fn16(spark, sf):
    part = t.table(spark, sf, "part")
    edges = quantiles(part, "p_retailprice", [0.25, 0.5, 0.75]).select(F.struct("p25", "p50", "p75").alias("e")).scalar()
    return part.select(
        "p_partkey",
        numbers.cut(F.col("p_size"), [0, 10, 30, 45], ["small", "medium", "large"]).alias("size_group"),
        numbers.qcut(
            F.col("p_retailprice"), [edges.getField("p25"), edges.getField("p50"), edges.getField("p75")],
            ["Low", "Medium", "High", "Very High"],
        ).alias("price_group"),
    )


@query(
    "fn17_column_sums",
    "SELECT l_orderkey, l_linenumber, l_partkey, l_linenumber + l_quantity + 1 AS total FROM lineitem",
)
def fn17(spark, sf):
    return t.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", numbers.total_plus(["l_linenumber", "l_quantity"], 1).alias("total")
    )
