"""User-activity, product-analytics and graph queries over the events table."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog.views import over
from millrace.operators.joins import two_hops
from millrace.plans import activity
from millrace.registry import query
from millrace.session import stage_table
from millrace.sources import tables as t


@query(
    "job01_user_summary",
    over(
        "activity_v",
        """SELECT user_id, count(*) AS total_events, count(*) FILTER (event_type = 'purchase') AS total_purchases,
                  count(*) FILTER (event_type = 'login') AS total_logins, count(*) FILTER (event_type = 'click') AS total_clicks
           FROM activity_v WHERE user_id IS NOT NULL GROUP BY user_id""",
    ),
)
def job01(spark, sf):
    return activity.user_summary(t.activity(spark, sf))


@query(
    "job01_event_breakdown",
    over("activity_v", "SELECT event_type, count(*) AS total_count FROM activity_v WHERE user_id IS NOT NULL GROUP BY event_type"),
)
def job01_events(spark, sf):
    return activity.event_breakdown(t.activity(spark, sf))


@query(
    "job01_top_pages",
    over("activity_v", "SELECT page, count(*) AS visit_count FROM activity_v WHERE user_id IS NOT NULL GROUP BY page"),
)
def job01_pages(spark, sf):
    return activity.top_pages(t.activity(spark, sf))


@query(
    "job25_repeated_firings",
    over(
        "activity_v",
        """SELECT user_id, event_type, date_trunc('hour', event_time) AS bucket, count(*) AS firings FROM activity_v
           WHERE NOT (event_type = 'error') GROUP BY 1, 2, 3 HAVING count(*) > 1""",
    ),
)
def job25(spark, sf):
    return activity.repeated_firings(t.activity(spark, sf), "hour", F.col("event_type") == "error")


@query(
    "job26_funnel",
    over(
        "activity_v",
        """WITH s1 AS (SELECT user_id, min(event_time) AS reached FROM activity_v WHERE event_type = 'login' GROUP BY user_id),
                s2 AS (SELECT a.user_id, min(event_time) AS reached FROM activity_v a JOIN s1 ON a.user_id = s1.user_id
                       WHERE event_type = 'view' AND event_time > reached AND event_time <= reached + INTERVAL 24 HOUR GROUP BY a.user_id),
                s3 AS (SELECT a.user_id, min(event_time) AS reached FROM activity_v a JOIN s2 ON a.user_id = s2.user_id
                       WHERE event_type = 'purchase' AND event_time > reached AND event_time <= reached + INTERVAL 24 HOUR GROUP BY a.user_id),
                u AS (SELECT 1 AS step, 'login' AS name, count(*) AS users FROM s1
                      UNION ALL SELECT 2, 'view', count(*) FROM s2 UNION ALL SELECT 3, 'purchase', count(*) FROM s3)
           SELECT step, name, users, users::DOUBLE / greatest((SELECT count(*) FROM s1), 1) AS conversion FROM u""",
    ),
)
def job26(spark, sf):
    return activity.funnel(t.activity(spark, sf), ["login", "view", "purchase"])


@query(
    "job27_retention",
    over(
        "activity_v",
        """WITH d AS (SELECT user_id, CAST(event_time AS DATE) AS day, bool_or(event_type = 'purchase') AS acted
                      FROM activity_v GROUP BY 1, 2),
                f AS (SELECT user_id, min(day) AS first_day FROM d GROUP BY user_id),
                u AS (SELECT d.user_id, bool_or(acted AND day = first_day) AS did_action,
                             bool_or(date_diff('day', first_day, day) = 1) AS d1, bool_or(date_diff('day', first_day, day) = 7) AS d7,
                             bool_or(date_diff('day', first_day, day) = 14) AS d14
                      FROM d JOIN f ON d.user_id = f.user_id GROUP BY d.user_id),
                c AS (SELECT did_action, 1 AS day, d1 AS back FROM u UNION ALL SELECT did_action, 7, d7 FROM u
                      UNION ALL SELECT did_action, 14, d14 FROM u)
           SELECT did_action, day, count(*) AS cohort_size, count(*) FILTER (back) AS returned,
                  count(*) FILTER (back)::DOUBLE / count(*) AS rate FROM c GROUP BY did_action, day""",
    ),
)
def job27(spark, sf):
    return activity.retention(t.activity(spark, sf), [1, 7, 14], "purchase")


@query(
    "job28_adoption",
    over(
        "activity_v",
        """SELECT CAST(date_trunc('week', event_time) AS TIMESTAMP) AS week, event_type,
                  CASE WHEN user_id % 10 = 0 THEN 'admin' ELSE 'member' END AS role,
                  count(*) AS uses, count(DISTINCT user_id) AS users FROM activity_v GROUP BY 1, 2, 3""",
    ),
)
def job28(spark, sf):
    tagged = t.activity(spark, sf).withColumn("role", F.when(F.col("user_id") % 10 == 0, "admin").otherwise("member"))
    return activity.adoption(tagged, "event_type", ["role"])


@query(
    "job28_active_users",
    over(
        "activity_v",
        """SELECT CAST(date_trunc('week', event_time) AS TIMESTAMP) AS period, count(DISTINCT user_id) AS active_users
           FROM activity_v GROUP BY 1""",
    ),
)
def job28_active(spark, sf):
    return activity.active_users(t.activity(spark, sf))


EDGES_SQL = """friends_v AS (
    SELECT DISTINCT src, dst FROM (
        SELECT user_id AS src, lead(user_id) OVER (PARTITION BY event_type ORDER BY event_time, event_id) AS dst FROM activity_v)
    WHERE dst IS NOT NULL AND src <> dst)"""


@query("join11_edges", over("activity_v", f"WITH {EDGES_SQL} SELECT src, dst FROM friends_v"))
def join11_edges(spark, sf):
    return activity.follow_edges(t.activity(spark, sf))


@query(
    "job29_friend_suggestions",
    over(
        "activity_v",
        f"""WITH {EDGES_SQL}, paths AS (SELECT a.src, b.dst AS suggested, count(*) AS common FROM friends_v a JOIN friends_v b ON a.dst = b.src
                                         WHERE b.dst <> a.src GROUP BY 1, 2)
            SELECT src, suggested, common, CAST(row_number() OVER best AS INTEGER) AS place FROM paths
            WHERE NOT EXISTS (SELECT 1 FROM friends_v d WHERE d.src = paths.src AND d.dst = suggested)
            WINDOW best AS (PARTITION BY src ORDER BY common DESC, suggested) QUALIFY row_number() OVER best <= 10""",
    ),
)
def job29(spark, sf):
    """The ten best for everybody, by common friends."""
    return activity.friend_suggestions(activity.follow_edges(t.activity(spark, sf)))


@query(
    "job29_suggestions_for_some",
    over(
        "activity_v",
        f"""WITH {EDGES_SQL}, me AS (SELECT DISTINCT user_id AS src FROM activity_v WHERE event_type = 'purchase')
            SELECT DISTINCT a.src, b.dst AS suggested FROM friends_v a JOIN friends_v b ON a.dst = b.src
            WHERE a.src IN (SELECT src FROM me) AND b.dst <> a.src
              AND NOT EXISTS (SELECT 1 FROM friends_v d WHERE d.src = a.src AND d.dst = b.dst)""",
    ),
)
def job29_some(spark, sf):
    """All friends of friends of the people asked about: everybody who has bought something."""
    # Read for both hops, the known friends and the people asked about.
    events = t.activity(spark, sf)
    edges = stage_table(activity.follow_edges(events), "edges")
    return two_hops(edges, events.filter("event_type = 'purchase'").select(F.col("user_id").alias("src")).distinct())
