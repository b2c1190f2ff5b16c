"""Time-proportional random session sampling (random extract).

The reference spreads ``total`` draws evenly over the days in range
(``total div days``), then over the hours of each day in proportion to their session
counts (truncated, capped at the hour's count), and draws that many distinct random
sessions per hour. Here the "random" order is a seeded hash of the session id, so the
sample is reproducible, independent of partitioning, and identical on every engine
that has md5. Quotas come from a (date, hour) table whose size is bounded by the
number of hours in the date range, which is what gets broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlens.operators.sessions import session_hourly_counts
from visitlens.session import checkpoint_dir


#: Parts into which an hour's sessions are dealt before the draw.
SALTS = 64


def extract_quota(sessions: DataFrame, total: int = 100) -> DataFrame:
    """(date, hour, session_count, day_session_count, day_quota, hour_quota)."""
    return quota_of_hours(session_hourly_counts(sessions), total)


def quota_of_hours(hourly: DataFrame, total: int) -> DataFrame:
    """The quotas from (date, hour, session_count)."""
    # one row per (date, hour): at most 24 x days rows, so the global window is tiny
    by_day = Window.partitionBy("date")
    all_rows = Window.partitionBy()
    with_day = hourly.select(
        "date", "hour", "session_count",
        F.sum("session_count").over(by_day).alias("day_session_count"),
        F.size(F.collect_set("date").over(all_rows)).alias("n_days"),
    )
    day_quota = F.call_function("div", F.lit(total).cast("bigint"), F.col("n_days").cast("bigint"))
    hour_quota = F.least(
        F.call_function("div", F.col("session_count") * F.col("day_quota"), F.col("day_session_count")),
        F.col("session_count")).cast("bigint")
    return (with_day.withColumn("day_quota", day_quota)
            .select("date", "hour", "session_count", "day_session_count", "day_quota",
                    hour_quota.alias("hour_quota")))


def hour_samples(sessions: DataFrame, total: int, seed: str) -> DataFrame:
    """One pass over the sessions: for each (date, hour, salt) its ``total`` first sessions by draw, their places ``rn`` and
    the number ``n`` of all its sessions.

    Mergeable: an hour's first k sessions (k up to ``total``) are the first k of its salts' samples, and its
    count is the sum of ``n`` over rows with rn 1. Checkpointed to the shared folder (at most
    ``SALTS * total`` rows an hour).
    """
    keyed = sessions.select(
        "session_id", "start_time", "search_keywords", "click_category_ids",
        F.date_format("start_ts", "yyyy-MM-dd").alias("date"),
        F.hour("start_ts").alias("hour"),
        F.md5(F.concat(F.col("session_id"), F.lit(seed))).alias("draw"),
    )
    salted = keyed.withColumn("salt", F.pmod(F.conv(F.substring("draw", 29, 4), 16, 10).cast("int"), F.lit(SALTS)))
    part = Window.partitionBy("date", "hour", "salt")
    checkpoint_dir(sessions.sparkSession)
    return (salted.withColumn("rn", F.row_number().over(part.orderBy("draw", "session_id")))
            .withColumn("n", F.count(F.lit(1)).over(part)).where(F.col("rn") <= F.lit(total)).checkpoint())


def random_extract(sessions: DataFrame, total: int = 100, seed: str = "42") -> DataFrame:
    """The sampled sessions: session_id, start_time, search_keywords, click_category_ids.

    Sessions of an hour are ordered by ``md5(session_id || seed)``. ``sessions`` is read once: quotas and
    draws both come from ``hour_samples``. Each hour is cut in two steps, by rank within (hour,
    last digits of the draw) and then within the hour, so no task sees more than ``SALTS``
    times an hour's quota, however many sessions the hour has or how many are drawn.
    """
    samples = hour_samples(sessions, total, seed)
    hourly = samples.where("rn = 1").groupBy("date", "hour").agg(F.sum("n").alias("session_count"))
    quota = quota_of_hours(hourly, total).select("date", "hour", "hour_quota").where("hour_quota > 0")
    whole = Window.partitionBy("date", "hour").orderBy("draw", "session_id")
    cut = samples.join(F.broadcast(quota), ["date", "hour"]).where(F.col("rn") <= F.col("hour_quota"))
    return (cut.withColumn("rn", F.row_number().over(whole)).where(F.col("rn") <= F.col("hour_quota"))
            .select("session_id", "start_time", "search_keywords", "click_category_ids"))
