"""Profiling and data preparation over the given tables.

``customer`` and ``part`` columns with some values blanked stand in for messy
people records.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.views import over
from millrace.operators import encode, quality
from millrace.plans import prices
from millrace.registry import query
from millrace.sources import tables as t

PEOPLE_SQL = """people_v AS (
    SELECT c_custkey AS id, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_acctbal END AS salary,
           CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE CAST(c_custkey % 60 AS INTEGER) END AS age,
           CASE WHEN c_custkey % 13 = 0 THEN NULL WHEN c_custkey % 2 = 0 THEN '  ' || lower(c_mktsegment) ELSE c_mktsegment END
               AS department,
           CASE WHEN c_custkey % 5 = 0 THEN '' WHEN c_custkey % 5 = 1 THEN NULL ELSE c_name END AS phone
    FROM customer)"""


def people(spark, sf):
    key = F.col("c_custkey")
    return t.table(spark, sf, "customer").select(
        key.alias("id"),
        F.when(key % 7 != 0, F.col("c_acctbal")).alias("salary"),
        F.when(key % 11 != 0, (key % 60).cast("int")).alias("age"),
        F.when(key % 13 == 0, F.lit(None))
        .when(key % 2 == 0, F.concat(F.lit("  "), F.lower("c_mktsegment")))
        .otherwise(F.col("c_mktsegment"))
        .alias("department"),
        F.when(key % 5 == 0, "").when(key % 5 == 1, F.lit(None)).otherwise(F.col("c_name")).alias("phone"),
    )


def people_sql(sql: str) -> str:
    body = sql.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {PEOPLE_SQL},\n{body[5:]}"
    return f"WITH {PEOPLE_SQL}\n{body}"


COLUMNS = ["id", "salary", "age", "department", "phone"]


@query(
    "dq01_null_counts",
    people_sql(
        "SELECT c AS \"column\", n AS nulls FROM ("
        + " UNION ALL ".join(f"SELECT '{c}' AS c, count(*) FILTER ({c} IS NULL) AS n FROM people_v" for c in COLUMNS)
        + ")"
    ),
)
def dq01(spark, sf):
    return quality.null_counts(people(spark, sf))


@query("dq02_shape", 'SELECT count(*) AS rows, 11 AS "columns" FROM lineitem')
def dq02(spark, sf):
    return quality.shape(t.table(spark, sf, "lineitem"))


@query(
    "dq03_describe",
    people_sql(
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std,
                CAST(min({c}) AS DOUBLE) AS min, quantile_cont({c}::DOUBLE, 0.25) AS p25, quantile_cont({c}::DOUBLE, 0.5) AS p50,
                quantile_cont({c}::DOUBLE, 0.75) AS p75, CAST(max({c}) AS DOUBLE) AS max FROM people_v"""
            for c in ("salary", "age")
        )
    ),
)
def dq03(spark, sf):
    out = quality.describe(people(spark, sf), ["salary", "age"])
    return out.withColumns({"mean": F.round("mean", 6), "std": F.round("std", 6)})


@query(
    "dq04_any_null",
    people_sql(
        " UNION ALL ".join(f"SELECT '{c}' AS \"column\", bool_or({c} IS NULL) AS has_null FROM people_v" for c in COLUMNS)
    ),
)
def dq04(spark, sf):
    return quality.any_null(people(spark, sf))


@query(
    "dq05_drop_nulls",
    people_sql(
        """SELECT * FROM people_v WHERE (salary IS NOT NULL)::INT + (age IS NOT NULL)::INT + (department IS NOT NULL)::INT
           + (phone IS NOT NULL)::INT + (id IS NOT NULL)::INT >= 4"""
    ),
)
def dq05(spark, sf):
    return quality.drop_nulls(people(spark, sf), thresh=4)


@query(
    "dq05_drop_any_null",
    people_sql(
        "SELECT * FROM people_v WHERE salary IS NOT NULL AND age IS NOT NULL AND department IS NOT NULL AND phone IS NOT NULL"
    ),
)
def dq05_any(spark, sf):
    return quality.drop_nulls(people(spark, sf))


@query(
    "dq06_fill_constants",
    people_sql(
        """SELECT id, coalesce(salary, 0.0::DOUBLE) AS salary, age, coalesce(department, 'Unknown') AS department,
                  coalesce(nullif(phone, ''), 'unknown') AS phone FROM people_v"""
    ),
)
def dq06(spark, sf):
    return quality.fill_constants(
        people(spark, sf), {"salary": 0.0, "department": "Unknown", "phone": "unknown"}, blank_is_null=("phone",)
    )


@query(
    "dq07_impute_median",
    people_sql(
        """SELECT id, coalesce(salary, (SELECT median(salary) FROM people_v)) AS salary,
                  coalesce(age::DOUBLE, (SELECT median(age) FROM people_v)) AS age FROM people_v"""
    ),
)
def dq07(spark, sf):
    return quality.impute_median(people(spark, sf), ["salary", "age"]).select("id", "salary", "age")


@query(
    "dq07_impute_mode",
    people_sql(
        """SELECT id, coalesce(department, (SELECT department FROM people_v WHERE department IS NOT NULL
                  GROUP BY department ORDER BY count(*) DESC, department LIMIT 1)) AS department FROM people_v"""
    ),
)
def dq07_mode(spark, sf):
    return quality.impute_mode(people(spark, sf), "department").select("id", "department")


@query(
    "dq07_impute_median_date",
    """WITH x AS (SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) END AS d FROM orders),
            m AS (SELECT DATE '1970-01-01' + CAST(floor(median(date_diff('day', DATE '1970-01-01', d))) AS INTEGER) AS mid FROM x)
       SELECT o_orderkey, coalesce(d, CAST(mid AS DATE)) AS d FROM x, m""",
)
def dq07_date(spark, sf):
    dated = t.table(spark, sf, "orders").select(
        "o_orderkey", F.when(F.col("o_orderkey") % 9 != 0, F.to_date("o_orderdate")).alias("d")
    )
    return quality.impute_median_date(dated, "d")


POWERS_SQL = "x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity * l_quantity * l_quantity * l_quantity * l_quantity AS v FROM lineitem)"
FENCES_SQL = """f AS (SELECT p25 - 1.5 * (p75 - p25) AS low, p75 + 1.5 * (p75 - p25) AS high FROM (
    SELECT quantile_cont(v, 0.25) AS p25, quantile_cont(v, 0.75) AS p75 FROM x))"""


def powers(spark, sf):
    q = F.col("l_quantity")
    return t.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", (q * q * q * q * q).alias("v"))


@query("dq08_outliers", f"WITH {POWERS_SQL}, {FENCES_SQL} SELECT x.* FROM x, f WHERE v < low OR v > high")
def dq08(spark, sf):
    return quality.outliers(powers(spark, sf), "v")


@query(
    "dq08_remove_outliers",
    """WITH x AS (SELECT l_orderkey, l_linenumber, l_partkey, l_quantity * l_quantity * l_quantity * l_quantity * l_quantity AS v,
                         l_extendedprice * l_extendedprice * l_extendedprice * l_extendedprice * l_extendedprice AS w FROM lineitem),
            f AS (SELECT quantile_cont(v, 0.25) AS a, quantile_cont(v, 0.75) AS b FROM x),
            y AS (SELECT x.* FROM x, f WHERE v >= a - 1.5 * (b - a) AND v <= b + 1.5 * (b - a)),
            g AS (SELECT quantile_cont(w, 0.25) AS a, quantile_cont(w, 0.75) AS b FROM y)
       SELECT y.* FROM y, g WHERE w >= a - 1.5 * (b - a) AND w <= b + 1.5 * (b - a)""",
)
def dq08_remove(spark, sf):
    q, p = F.col("l_quantity"), F.col("l_extendedprice")
    both = t.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", (q * q * q * q * q).alias("v"), (p * p * p * p * p).alias("w")
    )
    return quality.remove_outliers(both, ["v", "w"])


@query(
    "dq09_outliers_to_median",
    f"""WITH {POWERS_SQL}, {FENCES_SQL}, m AS (SELECT median(v) AS mid FROM x)
        SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN v < low OR v > high THEN mid ELSE v END AS v FROM x, f, m""",
)
def dq09(spark, sf):
    return quality.outliers_to_median(powers(spark, sf), "v")


@query(
    "dq09_winsorise",
    f"""WITH {POWERS_SQL}, {FENCES_SQL}
        SELECT l_orderkey, l_linenumber, l_partkey, least(greatest(v, low), high) AS v FROM x, f""",
)
def dq09_cap(spark, sf):
    return quality.winsorise(powers(spark, sf), "v")


@query(
    "dq10_tidy_categories",
    people_sql("SELECT id, upper(trim(department)[1]) || lower(trim(department)[2:]) AS department FROM people_v"),
)
def dq10(spark, sf):
    return quality.tidy_categories(people(spark, sf), ["department"]).select("id", "department")


@query(
    "dq11_record_rules",
    over(
        "claims_v patients_v",
        """SELECT 'amount positive' AS rule, count(*) FILTER (NOT claim_amount > 0) AS violations FROM claims_v
           UNION ALL SELECT 'approved within claimed', count(*) FILTER (NOT approved_amount <= claim_amount * 1.01) FROM claims_v
           UNION ALL SELECT 'score in range', count(*) FILTER (NOT (fraud_score BETWEEN 0 AND 1)) FROM claims_v
           UNION ALL SELECT 'known status', count(*) FILTER (insurance_status NOT IN ('APPROVED', 'DENIED')) FROM claims_v
           UNION ALL SELECT 'unique claim', CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT count(*) AS n FROM claims_v GROUP BY claim_id)
           UNION ALL SELECT 'patient exists', count(*) FROM claims_v c WHERE NOT EXISTS (
             SELECT 1 FROM patients_v p WHERE p.patient_id = c.patient_id AND p.state <> 'NATION_1')""",
    ),
)
def dq11(spark, sf):
    claims = t.claims(spark, sf)
    amount = F.col("claim_amount")
    rules = quality.violations(
        claims,
        {
            "amount positive": amount > 0,
            "approved within claimed": F.col("approved_amount") <= amount * 1.01,
            "score in range": F.col("fraud_score").between(0, 1),
            "known status": F.col("insurance_status").isin("APPROVED", "DENIED"),
        },
    )
    known = t.patients(spark, sf).filter("state <> 'NATION_1'")
    return rules.unionByName(quality.unique_violations(claims, ["claim_id"], "unique claim")).unionByName(
        quality.reference_violations(claims, known, "patient_id", "patient exists")
    )


@query(
    "dq11_url_rules",
    """SELECT 'url prefix' AS rule, count(*) FILTER (NOT (url LIKE 'http://%' OR url LIKE 'https://%')) AS violations FROM pages
       UNION ALL SELECT 'has html', count(*) FILTER (html IS NULL OR html = '') FROM pages
       UNION ALL SELECT 'secure', count(*) FILTER (url NOT LIKE 'https://%') FROM pages""",
)
def dq11_urls(spark, sf):
    url = F.col("url")
    return quality.violations(
        t.table(spark, sf, "pages"),
        {
            "url prefix": url.startswith("http://") | url.startswith("https://"),
            "has html": F.col("html") != "",
            "secure": url.startswith("https://"),
        },
    )


@query(
    "dq12_tenure",
    over(
        "orders_v",
        """WITH e AS (SELECT order_id, order_value,
                            round(date_diff('day', purchase_ts, TIMESTAMP '2001-08-01') / 365.0::DOUBLE, 1) AS experience
                     FROM orders_v)
           SELECT order_id, experience, order_value / CASE WHEN experience = 0 THEN 1 ELSE experience END AS value_per_year
           FROM e""",
    ),
)
def dq12(spark, sf):
    out = quality.tenure_features(t.orders(spark, sf), "purchase_ts", "order_value", t.CLAIMS_AS_OF, decimals=None)
    return out.select("order_id", "experience", "value_per_year")


@query(
    "dq13_price_series",
    """SELECT CASE WHEN l_suppkey % 9 = 0 THEN 'Unknown' ELSE 'S' || l_suppkey END AS region, l_returnflag AS market,
              l_linestatus AS commodity, CAST(date_trunc('month', l_shipdate) AS DATE) AS date, l_extendedprice AS price
       FROM lineitem WHERE l_linenumber <> 6""",
)
def dq13(spark, sf):
    return prices.clean(prices.raw_prices(t.table(spark, sf, "lineitem"))).select(
        "region", "market", "commodity", "date", "price"
    )


@query(
    "dq14_one_hot",
    """SELECT c_custkey, CAST(c_mktsegment = 'BUILDING' AS INTEGER) AS "c_mktsegment_BUILDING",
              CAST(c_mktsegment = 'FURNITURE' AS INTEGER) AS "c_mktsegment_FURNITURE",
              CAST(c_mktsegment = 'HOUSEHOLD' AS INTEGER) AS "c_mktsegment_HOUSEHOLD",
              CAST(c_mktsegment = 'MACHINERY' AS INTEGER) AS "c_mktsegment_MACHINERY" FROM customer""",
)
def dq14(spark, sf):
    segments = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]
    return encode.one_hot(t.table(spark, sf, "customer").select("c_custkey", "c_mktsegment"), {"c_mktsegment": segments})


@query(
    "dq15_label_encode",
    """SELECT o_orderkey, o_orderpriority, CAST(dense_rank() OVER (ORDER BY o_orderpriority) - 1 AS INTEGER) AS code FROM orders""",
)
def dq15(spark, sf):
    return encode.label_encode(t.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), "o_orderpriority", "code")


@query(
    "dq16_standardise",
    """SELECT p_partkey, round((p_retailprice - avg(p_retailprice) OVER ()) / stddev_pop(p_retailprice) OVER (), 8) AS price,
              round((p_size - avg(p_size) OVER ()) / stddev_pop(p_size) OVER (), 8) AS size FROM part""",
)
def dq16(spark, sf):
    part = t.table(spark, sf, "part").select("p_partkey", F.col("p_retailprice").alias("price"), F.col("p_size").alias("size"))
    out = encode.standardise(part, ["price", "size"])
    return out.withColumns({"price": F.round("price", 8), "size": F.round("size", 8)})


# --- price views -----------------------------------------------------------

PRICES_SQL = """p AS (SELECT CASE WHEN l_suppkey % 9 = 0 THEN 'Unknown' ELSE 'S' || l_suppkey END AS region,
    l_returnflag AS market, l_linestatus AS commodity, CAST(date_trunc('month', l_shipdate) AS DATE) AS date,
    l_extendedprice AS price FROM lineitem WHERE l_linenumber <> 6 AND l_linestatus = 'F' AND l_returnflag IN ('A', 'R'))"""


def chosen(spark, sf):
    cleaned = prices.clean(prices.raw_prices(t.table(spark, sf, "lineitem")))
    return prices.selected(cleaned, commodity="F", markets=["A", "R"])


@query(
    "job23_price_series",
    f"WITH {PRICES_SQL} SELECT market, date, count(*) AS n, round(sum(price), 2) / count(*) AS mean_price FROM p GROUP BY market, date",
)
def job23_series(spark, sf):
    return prices.series(chosen(spark, sf))


@query(
    "job23_price_boxes",
    f"""WITH {PRICES_SQL}, q AS (SELECT market, quantile_cont(price, 0.25) AS p25, quantile_cont(price, 0.5) AS p50,
              quantile_cont(price, 0.75) AS p75 FROM p GROUP BY market)
        SELECT market, min(price) AS min, round(p25, 6) AS p25, round(p50, 6) AS p50, round(p75, 6) AS p75, max(price) AS max,
               min(price) FILTER (price >= p25 - 1.5 * (p75 - p25)) AS whisker_low,
               max(price) FILTER (price <= p75 + 1.5 * (p75 - p25)) AS whisker_high,
               count(*) FILTER (price < p25 - 1.5 * (p75 - p25) OR price > p75 + 1.5 * (p75 - p25)) AS outliers
        FROM p JOIN q USING (market) GROUP BY market, p25, p50, p75""",
)
def job23_boxes(spark, sf):
    out = prices.boxes(chosen(spark, sf))
    return out.withColumns({c: F.round(c, 6) for c in ("p25", "p50", "p75")})


@query(
    "job23_price_histogram",
    f"""WITH {PRICES_SQL}, b AS (SELECT min(price) AS lo, max(price) AS hi FROM p),
            c AS (SELECT least(CAST(floor((price - lo) / ((hi - lo) / 30)) AS INTEGER), 29) AS bin, count(*) AS n FROM p, b GROUP BY 1)
        SELECT CAST(r.range AS INTEGER) AS bin, lo + r.range * ((hi - lo) / 30) AS bin_from,
               lo + (r.range + 1) * ((hi - lo) / 30) AS bin_to, coalesce(n, 0) AS n
        FROM range(30) r, b LEFT JOIN c ON c.bin = r.range""",
)
def job23_histogram(spark, sf):
    return prices.price_histogram(chosen(spark, sf))
