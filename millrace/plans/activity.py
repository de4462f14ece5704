"""User activity: batch summaries and product analytics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.functions.dates import truncated
from millrace.operators.aggregates import conditional_counts, group_count
from millrace.operators.ordinal import with_ordinal
from millrace.operators.sets import union_all
from millrace.operators.skew import hot_keys, salted_join
from millrace.operators.windows import top_n_per_group
from millrace.session import stage_table


def user_summary(events: DataFrame) -> DataFrame:
    """Events, purchases, logins and clicks per user, most active first."""
    kind = F.col("event_type")
    counts = conditional_counts(
        events.filter(F.col("user_id").isNotNull()),
        ["user_id"],
        {
            "total_purchases": kind == "purchase",
            "total_logins": kind == "login",
            "total_clicks": kind == "click",
        },
        total="total_events",
    )
    return counts.orderBy(F.desc("total_events"), F.asc("user_id"))


def event_breakdown(events: DataFrame) -> DataFrame:
    return group_count(events.filter(F.col("user_id").isNotNull()), ["event_type"], "total_count").orderBy(
        F.desc("total_count"), F.asc("event_type")
    )


def top_pages(events: DataFrame) -> DataFrame:
    return group_count(events.filter(F.col("user_id").isNotNull()), ["page"], "visit_count").orderBy(
        F.desc("visit_count"), F.asc("page")
    )


def repeated_firings(events: DataFrame, bucket: str = "hour", is_test: Column | None = None) -> DataFrame:
    """Same user and event type fired more than once in a time bucket; test traffic left out."""
    real = events if is_test is None else events.filter(~F.coalesce(is_test, F.lit(False)))
    return (
        real.groupBy("user_id", "event_type", truncated(bucket, F.col("event_time")).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("firings"))
        .filter(F.col("firings") > 1)
    )


def _step_count(reached: DataFrame, position: int, name: str) -> DataFrame:
    return reached.agg(
        F.lit(position).alias("step"), F.lit(name).alias("name"), F.count(F.lit(1)).alias("users")
    )


def funnel(events: DataFrame, steps: list[str], within: str = "24 HOURS") -> DataFrame:
    """Users reaching each step after the previous one, within a time limit.

    A user's first time in step one starts the funnel; each later step is the
    first such event after the step before. The per-user times meet the step's
    events in a salted join, so one user with a large share of the events does
    not end up in one task.
    """
    # The steps' events and each step's users are read several times, so they are stored.
    events = stage_table(
        events.filter(F.col("user_id").isNotNull() & F.col("event_type").isin(steps)).select(
            "event_id", "user_id", "event_type", "event_time"
        ),
        "funnel_events",
    )
    reached = stage_table(
        events.filter(F.col("event_type") == steps[0]).groupBy("user_id").agg(F.min("event_time").alias("at")),
        "funnel_step",
    )
    # Busy users are counted once, over the events of all steps, for the joins of every step.
    hot = stage_table(hot_keys(events, ["user_id"]), "funnel_hot")
    counts = [_step_count(reached, 1, steps[0])]
    for position, step in enumerate(steps[1:], start=2):
        joined = salted_join(
            events.filter(F.col("event_type") == step), reached, ["user_id"], salt_by=["event_id"], hot=hot
        )
        later = (F.col("event_time") > F.col("at")) & (
            F.col("event_time") <= F.col("at") + F.expr(f"INTERVAL {within}")
        )
        reached = stage_table(
            joined.filter(later).groupBy("user_id").agg(F.min("event_time").alias("at")), "funnel_step"
        )
        counts.append(_step_count(reached, position, step))
    first = counts[0].select("users").scalar()
    return union_all(*counts).withColumn("conversion", F.col("users") / F.greatest(first, F.lit(1)))


def retention(events: DataFrame, days: list[int], action: str, action_within: int = 1) -> DataFrame:
    """Share of users active again on day N after their first day, by whether they did an action early.

    Events shrink to one row per user and day before anything else, so a busy
    user is at most one row per calendar day.
    """
    daily = (
        events.filter(F.col("user_id").isNotNull())
        .groupBy("user_id", F.to_date("event_time").alias("day"))
        .agg(F.bool_or(F.col("event_type") == action).alias("acted"))
    )
    # The user's days already lie together, so the first day costs no further shuffle.
    first_day = F.min("day").over(Window.partitionBy("user_id"))
    aged = daily.withColumn("age", F.datediff("day", first_day))
    per_user = aged.groupBy("user_id").agg(
        F.bool_or(F.col("acted") & (F.col("age") < action_within)).alias("did_action"),
        *[F.bool_or(F.col("age") == d).alias(f"d{d}") for d in days],
    )
    cells = [F.struct(F.lit(d).alias("day"), F.col(f"d{d}").alias("back")) for d in days]
    return (
        per_user.select("did_action", F.explode(F.array(*cells)).alias("c"))
        .groupBy("did_action", "c.day")
        .agg(F.count(F.lit(1)).alias("cohort_size"), F.count_if("c.back").alias("returned"))
        .withColumn("rate", F.col("returned") / F.col("cohort_size"))
    )


def adoption(events: DataFrame, feature: str = "event_type", extra: list[str] | None = None) -> DataFrame:
    """Uses and distinct users of each feature per week, optionally split further."""
    keys = [truncated("week", F.col("event_time")).alias("week"), F.col(feature), *(extra or [])]
    return events.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("uses"), F.count_distinct("user_id").alias("users")
    )


def active_users(events: DataFrame, period: str = "week") -> DataFrame:
    return events.groupBy(truncated(period, F.col("event_time")).alias("period")).agg(
        F.count_distinct("user_id").alias("active_users")
    )


def follow_edges(events: DataFrame) -> DataFrame:
    """An edge from each user to the next user of the same event type, in time order.

    Rows are numbered without a window over whole event types, and each row then
    joins its successor on a unique key.
    """
    numbered = with_ordinal(
        events.select("event_type", "event_time", "event_id", "user_id"), ["event_type", "event_time", "event_id"]
    ).select("event_type", "ordinal", F.col("user_id").alias("src"))
    successor = numbered.select(
        "event_type", (F.col("ordinal") - 1).alias("ordinal"), F.col("src").alias("dst")
    )
    return (
        numbered.join(successor, ["event_type", "ordinal"])
        .filter(F.col("src") != F.col("dst"))
        .select("src", "dst")
        .distinct()
    )


def least_connected(edges: DataFrame, k: int = 1) -> DataFrame:
    """The people with the fewest friends, the ones suggestions are most useful to."""
    return (
        edges.groupBy("src")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.asc("n"), F.asc("src"))
        .limit(k)
        .select("src")
    )


def friend_suggestions(
    edges: DataFrame, k: int = 10, most_paths: int = 1_000_000, wide: int = 1_000, task_paths: int = 1_000_000
) -> DataFrame:
    """For everybody, the ``k`` people they do not know with most friends in common: src, suggested, common, place.

    ``edges`` has (src, dst). Paths of two steps are counted per pair, ties go to
    the smaller id. Nobody is left out and no count is estimated, but the paths
    through a hub, someone with more than ``most_paths`` of them, are not built one
    by one:

    * People who know the same hubs reach the same others through them. Those are
      counted once for each different set of hubs.
    * A pair that other paths find adds its set's count. Pairs that only hubs join
      are ranked once a set; a person meets as many of the first as can matter:
      ``k`` beyond their own friends and themselves.
    * Someone with more than ``wide`` friends has all their paths built, so a set's
      ranking is never needed further than that.

    A task counts about ``task_paths`` paths, however many there are in all.
    """
    links = edges.select("src", "dst").filter(F.col("src") != F.col("dst")).distinct()
    links = stage_table(links, "links")
    known = links.groupBy("src").agg(F.count(F.lit(1)).alias("friends"))
    knowing = links.groupBy(F.col("dst").alias("mid")).agg(F.count(F.lit(1)).alias("n"))
    hubs = knowing.join(known, F.col("mid") == F.col("src")).filter(F.col("n") * F.col("friends") > most_paths).select("mid")
    hubs = stage_table(hubs, "hubs")
    first, second = links.select("src", F.col("dst").alias("mid")), links.select(F.col("src").alias("mid"), "dst")
    barred = links.unionByName(known.select("src", F.col("src").alias("dst")))
    if hubs.isEmpty():
        return _best_suggestions(_two_step_counts(first, second, barred, task_paths), k)

    broad = known.filter(F.col("friends") > wide).select("src")
    usual = first.join(broad, "src", "left_anti")
    led = usual.join(hubs, "mid", "left_semi").groupBy("src").agg(F.sort_array(F.collect_set("mid")).alias("hubs"))
    led = stage_table(led.select("src", "hubs", F.xxhash64("hubs").alias("kind")).join(known, "src"), "led")
    kinds = led.groupBy("kind").agg(F.first("hubs").alias("hubs")).select("kind", F.explode("hubs").alias("mid"))
    through = _two_step_counts(kinds.withColumnRenamed("kind", "src"), second, None, task_paths)
    through = stage_table(through.select(F.col("src").alias("kind"), "dst", F.col("common").alias("via")), "through")

    plain = _two_step_counts(first.join(led, "src", "left_anti"), second, barred.join(led, "src", "left_anti"), task_paths)

    # The set goes with the person through the count, so the counted pairs need not meet it again.
    person = F.struct("src", "kind").alias("src")
    kind_of = led.select("src", "kind")
    steps = usual.join(hubs, "mid", "left_anti").join(kind_of, "src").select(person, "mid")
    direct = _two_step_counts(steps, second, barred.join(kind_of, "src").select(person, "dst"), task_paths)
    both = direct.select("src.src", "src.kind", "dst", "common").join(through, ["kind", "dst"], "left")
    both = both.select("src", "dst", (F.col("common") + F.coalesce("via", F.lit(0))).alias("common"))
    # A pair left out here has a larger count than its set's, and k others of the person are before it.
    both = _best_suggestions(both, k).select("src", F.col("suggested").alias("dst"), "common")

    order = Window.partitionBy("kind").orderBy(F.desc("via"), F.asc("dst"))
    ranked = through.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= k + wide + 1)
    near = F.col("place") <= F.lit(k + 1) + F.col("friends")
    hub_only = led.alias("a").join(ranked.alias("b"), (F.col("a.kind") == F.col("b.kind")) & near).select("src", "dst", F.col("via").alias("common"))
    hub_only = hub_only.filter(F.col("src") != F.col("dst")).join(links, ["src", "dst"], "left_anti")
    found = both.unionByName(hub_only).groupBy("src", "dst").agg(F.max("common").alias("common"))
    return _best_suggestions(plain.unionByName(found), k)


def _best_suggestions(found: DataFrame, k: int) -> DataFrame:
    """The first ``k`` of each person in (src, dst, common), by ``common`` and then the smaller id."""
    top = top_n_per_group(found, ["src"], [F.desc("common"), F.asc("dst")], k, rank="place")
    return top.select("src", F.col("dst").alias("suggested"), "common", "place")


def _two_step_counts(steps: DataFrame, second: DataFrame, barred: DataFrame | None, task_paths: int, piece: int = 1_000) -> DataFrame:
    """How many of the (src, mid) of ``steps`` lead on to each (mid, dst) of ``second``: src, dst, common.

    Pairs of ``barred`` (src, dst) are not returned. Friends travel as lists of about
    ``piece`` ids to the task that counts all pairs of a person. Spark plans tasks by
    the size of the links, of which there are far fewer than paths, so the number of
    tasks is set here by the number of paths: whoever has more than ``task_paths`` of
    them is spread over several tasks by ``dst``, and the followers of one with more
    than that by ``src``.
    """

    def share(paths: Column) -> Column:
        return F.ceil(paths / F.lit(task_paths)).cast("int")

    def slot(dst: Column) -> Column:
        return F.pmod(F.xxhash64(dst), F.col("slots")).cast("int")

    ahead = second.groupBy("mid").agg(F.count(F.lit(1)).alias("friends"))
    behind = steps.groupBy("mid").agg(F.count(F.lit(1)).alias("n"))
    mids = ahead.join(behind, "mid").select("mid", "friends", share(F.col("n") * F.col("friends")).alias("parts"))
    mids = stage_table(mids, "mids")
    steps = stage_table(steps.join(mids, "mid"), "steps")
    paths = steps.agg(F.coalesce(F.sum("friends"), F.lit(0))).first()[0]
    fewest = steps.sparkSession.sparkContext.defaultParallelism
    tasks = max(fewest, -(-paths // task_paths))

    heavy = steps.groupBy("src").agg(F.sum("friends").alias("paths")).filter(F.col("paths") > task_paths)
    heavy = stage_table(heavy.select("src", share(F.col("paths")).alias("slots")), "heavy")
    lists = (
        second.join(mids, "mid")
        .groupBy("mid", "parts", F.pmod(F.xxhash64("dst"), F.ceil(F.col("friends") / piece)).alias("piece"))
        .agg(F.collect_list("dst").alias("dsts"))
        .select("mid", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"), "dsts")
    )
    spread = steps.join(heavy, "src", "left").select("src", "mid", "slots", F.pmod(F.xxhash64("src"), "parts").cast("int").alias("part"))
    # These tasks only pass lists on, so each may hold some more of them.
    senders = max(fewest, tasks // 4)
    met = spread.repartition(senders, "mid", "part").join(lists.repartition(senders, "mid", "part"), ["mid", "part"])

    whole = F.array(F.struct(F.lit(0).alias("slot"), F.col("dsts")))
    one_by_one = F.transform("dsts", lambda dst: F.struct(slot(dst).alias("slot"), F.array(dst).alias("dsts")))
    rows = met.select("src", F.explode(F.when(F.col("slots").isNull(), whole).otherwise(one_by_one)).alias("x"))
    rows = rows.select("src", "x.slot", "x.dsts", F.lit(1).cast("long").alias("step"))
    if barred is not None:
        own = barred.join(heavy, "src", "left").select("src", F.coalesce(slot(F.col("dst")), F.lit(0)).alias("slot"), F.array("dst").alias("dsts"))
        rows = rows.unionByName(own.withColumn("step", F.lit(None).cast("long")))
    pairs = rows.repartition(tasks, "src", "slot").select("src", "slot", F.explode("dsts").alias("dst"), "step")
    counted = pairs.groupBy("src", "slot", "dst").agg(F.count("step").alias("common"), F.count(F.lit(1)).alias("rows"))
    return counted.filter(F.col("common") == F.col("rows")).select("src", "dst", "common")
