"""Session analysis: scan, roll-up, user join, filters, histograms and ratios.

All operators are lazy DataFrame transformations. The session roll-up is a single
hash aggregate keyed by ``session_id`` (partial aggregation map-side, so a session
holding a large share of all rows is pre-reduced in every map task); the histogram
and ratio report is one global aggregate whose partial step runs on every partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.functions.columns import (
    STEP_BUCKETS, VISIT_BUCKETS, bucket_condition, bucket_label, half_up_ratio_sql, nonempty,
    parse_action_time,
)
from visitlens.operators.joins import broadcast_if_small, hot_keys, salted_join
from visitlens.plans.params import TaskParams

TIME_FMT = "yyyy-MM-dd HH:mm:ss"


# ---------------------------------------------------------------- scans

def scan_actions_by_date(actions: DataFrame, start_date: str | None, end_date: str | None) -> DataFrame:
    """Actions whose ``session_date`` lies in [start_date, end_date] (strings yyyy-MM-dd).

    A plain comparison on the column so Catalyst pushes it into the parquet scan (and
    prunes partitions when the table is stored partitioned by ``session_date``).
    """
    cond = F.lit(True)
    if start_date is not None:
        cond = cond & (F.col("session_date") >= F.lit(start_date))
    if end_date is not None:
        cond = cond & (F.col("session_date") <= F.lit(end_date))
    return actions.where(cond)


def scan_click_actions(actions: DataFrame, start_date: str | None, end_date: str | None) -> DataFrame:
    """(city_id, product_id) of click actions in the date range."""
    return (scan_actions_by_date(actions, start_date, end_date)
            .where(F.col("click_product_id").isNotNull())
            .select("city_id", F.col("click_product_id").alias("product_id")))


# ---------------------------------------------------------------- roll-up (A1-A5)

def session_rollup(actions: DataFrame) -> DataFrame:
    """One row per session.

    Columns: session_id, user_id, start_ts, start_time, visit_length (s), step_length,
    keywords (sorted distinct non-empty array), categories (sorted distinct array),
    search_keywords / click_category_ids (the arrays joined by ',', null when empty).
    """
    kw = F.col("search_keyword")
    # parse the time and clean the keyword once per row, before the aggregate
    pre = actions.select("session_id", "user_id",
                         parse_action_time(F.col("action_time")).alias("ts"),
                         F.when(nonempty(kw), kw).alias("kw"), "click_category_id")
    agg = pre.groupBy("session_id").agg(
        F.min("user_id").alias("user_id"),
        F.min("ts").alias("start_ts"),
        F.max("ts").alias("end_ts"),
        F.count(F.lit(1)).alias("step_length"),
        F.array_sort(F.collect_set("kw")).alias("keywords"),
        F.array_sort(F.collect_set("click_category_id")).alias("categories"),
    )
    kws = F.array_join("keywords", ",")
    cats = F.array_join("categories", ",")
    return agg.select(
        "session_id", "user_id", "start_ts",
        F.date_format("start_ts", TIME_FMT).alias("start_time"),
        (F.unix_timestamp("end_ts") - F.unix_timestamp("start_ts")).alias("visit_length"),
        "step_length", "keywords", "categories",
        F.when(kws != "", kws).alias("search_keywords"),
        F.when(cats != "", cats).alias("click_category_ids"),
    )


#: Most distinct values of a session that become an array (about 1 MB of keywords of 100 bytes).
MAX_ARRAY_VALUES = 10_000


def session_rollup_two_level(actions: DataFrame, max_values: int = MAX_ARRAY_VALUES) -> tuple[DataFrame, DataFrame]:
    """(sessions, overflow): the roll-up for sessions with any number of distinct keywords and categories.

    Values are made distinct as rows (session, kind, value), so no task gathers one session's. Arrays and
    joined strings are built for kinds with at most ``max_values`` values; for others they are null, and
    ``overflow`` (session_id, kind ``keyword`` or ``category``, value) holds every value: nothing is lost.
    ``sessions`` has the columns of ``session_rollup`` and n_keywords, n_categories.
    """
    kw, cat = F.col("search_keyword"), F.col("click_category_id")
    value = lambda kind, v: F.struct(F.lit(kind).alias("kind"), v.cast("string").alias("value"))
    both = F.array_compact(F.array(F.when(nonempty(kw), value("keyword", kw)), F.when(cat.isNotNull(), value("category", cat))))
    pairs = (actions.select("session_id", F.explode(both).alias("v")).groupBy("session_id", "v.kind", "v.value").agg(F.first(F.lit(1)).alias("_one"))
             .drop("_one"))
    sizes = pairs.groupBy("session_id", "kind").agg(F.count(F.lit(1)).alias("n"))
    # at most one wide (session, kind) per max_values pairs; the rows of wide ones never meet in a task
    wide = broadcast_if_small(sizes.where(F.col("n") > F.lit(max_values)).select("session_id", "kind"))
    overflow = pairs.join(wide, ["session_id", "kind"], "left_semi")
    narrow = pairs.join(wide, ["session_id", "kind"], "left_anti")
    of_kind = lambda kind, v: F.collect_list(F.when(F.col("kind") == kind, v))
    arrays = narrow.groupBy("session_id").agg(F.array_sort(of_kind("keyword", F.col("value"))).alias("_kw"),
                                              F.array_sort(of_kind("category", F.col("value").cast("bigint"))).alias("_cat"))
    counts = sizes.groupBy("session_id").agg(*[F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("n"))), F.lit(0)).alias(name)
                                               for kind, name in (("keyword", "n_keywords"), ("category", "n_categories"))])
    base = actions.select("session_id", "user_id", parse_action_time(F.col("action_time")).alias("ts")).groupBy("session_id").agg(
        F.min("user_id").alias("user_id"), F.min("ts").alias("start_ts"), F.max("ts").alias("end_ts"), F.count(F.lit(1)).alias("step_length"))
    joined = base.join(counts, "session_id", "left").join(arrays, "session_id", "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("bigint")
    known = lambda c, arr, of: F.when(n(c) <= F.lit(max_values), F.coalesce(F.col(arr), F.array().cast(of)))
    out = joined.select("session_id", "user_id", "start_ts", F.date_format("start_ts", TIME_FMT).alias("start_time"),
                        (F.unix_timestamp("end_ts") - F.unix_timestamp("start_ts")).alias("visit_length"), "step_length",
                        known("n_keywords", "_kw", "array<string>").alias("keywords"), known("n_categories", "_cat", "array<bigint>").alias("categories"),
                        n("n_keywords").alias("n_keywords"), n("n_categories").alias("n_categories"))
    text = lambda c: F.when(F.size(c) > 0, F.array_join(c, ","))
    return out.select(*out.columns[:8], text("keywords").alias("search_keywords"), text("categories").alias("click_category_ids"),
                      "n_keywords", "n_categories"), overflow


def sessions_with_values(sessions: DataFrame, overflow: DataFrame, kind: str, values: list[str]) -> DataFrame:
    """The sessions of ``session_rollup_two_level`` that hold any of the values, in their array or in the overflow."""
    array = {"keyword": "keywords", "category": "categories"}[kind]
    hits = overflow.where((F.col("kind") == kind) & F.col("value").isin(*values)).select("session_id").distinct().withColumn("_hit", F.lit(True))
    in_array = F.coalesce(array_overlaps(array, values), F.lit(False))
    return sessions.join(hits, "session_id", "left").where(in_array | F.col("_hit")).drop("_hit")


SESSION_COLUMNS = ["session_id", "user_id", "start_time", "visit_length", "step_length",
                   "search_keywords", "click_category_ids"]
USER_COLUMNS = ["age", "professional", "city", "sex"]


# ---------------------------------------------------------------- join

def session_user_join(sessions: DataFrame, users: DataFrame) -> DataFrame:
    """Inner join of sessions with the user dimension on user_id.

    No broadcast hint: the user dimension grows with the business. AQE turns this into
    a broadcast hash join at run time when the (filtered) user side measures below
    ``spark.sql.adaptive.autoBroadcastJoinThreshold``, and otherwise keeps a sort-merge
    join with skew splitting for hot users.
    """
    u = users.select("user_id", *USER_COLUMNS)
    return sessions.join(u, "user_id", "inner")


# ---------------------------------------------------------------- filters

def age_between(params: TaskParams) -> Column | None:
    if params.start_age is None or params.end_age is None:
        return None
    # null age compares to null -> row dropped, as the reference rejects it
    return F.col("age").between(F.lit(params.start_age), F.lit(params.end_age))


def value_in(column: str, values: list[str] | None) -> Column | None:
    """The attribute, or one of its comma-separated items, is among the values."""
    if values is None:
        return None
    c = F.col(column).cast("string")
    several = c.contains(",") & F.arrays_overlap(F.split(c, ","), F.array(*[F.lit(v) for v in values]))
    return c.isin(*values) | several


def array_overlaps(column: str, values: list[str] | None) -> Column | None:
    """Any element of the session's array equals any parameter value (string compare)."""
    if values is None:
        return None
    arr = F.transform(F.col(column), lambda x: x.cast("string"))
    return F.coalesce(F.arrays_overlap(arr, F.array(*[F.lit(v) for v in values])), F.lit(False))


def value_equals(column: str, value: str | None) -> Column | None:
    """Equality predicate; a null parameter means no constraint."""
    if value is None:
        return None
    return F.coalesce(F.col(column).cast("string") == F.lit(value), F.lit(False))


def session_predicate(params: TaskParams) -> Column:
    """Conjunction of the constraints present in ``params``."""
    parts = [age_between(params),
             value_in("professional", params.professionals),
             value_in("city", params.cities),
             value_in("sex", params.sex),
             array_overlaps("keywords", params.keywords),
             array_overlaps("categories", params.category_ids)]
    cond = F.lit(True)
    for p in parts:
        if p is not None:
            cond = cond & p
    return cond


def filter_sessions(sessions_with_users: DataFrame, params: TaskParams) -> DataFrame:
    """Sessions (joined with users) that satisfy every constraint in ``params``.

    The user-side predicates reference only user columns; Catalyst pushes them below
    the join into the user scan.
    """
    return sessions_with_users.where(session_predicate(params))


# ---------------------------------------------------------------- detail

def session_detail(actions: DataFrame, sessions: DataFrame,
                   hot_session_rows: int | None = None) -> DataFrame:
    """Action rows of the given sessions (left semi join on session_id).

    The session side comes out of the roll-up already hash-partitioned by session_id,
    so AQE cannot split a skewed partition of this join. Sessions whose ``step_length``
    (action count, when the session rows carry it) exceeds ``hot_session_rows`` (by default
    an even share of all rows, ``joins.hot_keys``) are therefore joined salted.
    """
    ids = sessions.select("session_id")
    if "step_length" not in sessions.columns:
        return actions.join(ids, "session_id", "left_semi")
    hot = hot_keys(sessions.select("session_id", "step_length"), "session_id", "step_length", actions, hot_session_rows)
    return salted_join(actions, ids, "session_id", hot, "left_semi", salt_on=["action_time", "page_id"])


# ---------------------------------------------------------------- histograms

def visit_length_histogram(sessions: DataFrame) -> DataFrame:
    """(bucket, session_count) over the visit-length buckets; 0 s is in none."""
    b = bucket_label(F.col("visit_length"), VISIT_BUCKETS)
    return (sessions.select(b.alias("bucket")).where(F.col("bucket").isNotNull())
            .groupBy("bucket").agg(F.count(F.lit(1)).alias("session_count")))


def step_length_histogram(sessions: DataFrame) -> DataFrame:
    b = bucket_label(F.col("step_length"), STEP_BUCKETS)
    return (sessions.select(b.alias("bucket")).where(F.col("bucket").isNotNull())
            .groupBy("bucket").agg(F.count(F.lit(1)).alias("session_count")))


def session_aggr_stat(sessions: DataFrame, places: int = 2) -> DataFrame:
    """One row: session_count and the share of sessions in each bucket, half-up rounded.

    Columns visit_<label> for the visit buckets, step_<label> for the step buckets.
    A single aggregate (partial per partition, one final row) replaces the reference's
    string accumulator; it is exact and safe under task retries.
    """
    aggs = [F.count(F.lit(1)).alias("session_count")]
    for name, _, _ in VISIT_BUCKETS:
        aggs.append(F.count_if(bucket_condition(F.col("visit_length"), VISIT_BUCKETS, name))
                    .alias(f"n_visit_{name}"))
    for name, _, _ in STEP_BUCKETS:
        aggs.append(F.count_if(bucket_condition(F.col("step_length"), STEP_BUCKETS, name))
                    .alias(f"n_step_{name}"))
    counts = sessions.agg(*aggs)
    cols = ["session_count"]
    for prefix, buckets in (("visit", VISIT_BUCKETS), ("step", STEP_BUCKETS)):
        for name, _, _ in buckets:
            ratio = half_up_ratio_sql(f"n_{prefix}_{name}", "session_count", places)
            cols.append(f"{ratio} AS {prefix}_{name}")
    return counts.selectExpr(*cols)


# ---------------------------------------------------------------- time keys

def session_hourly_counts(sessions: DataFrame) -> DataFrame:
    """(date, hour, session_count) keyed by each session's start time."""
    return (sessions.select(F.date_format("start_ts", "yyyy-MM-dd").alias("date"),
                            F.hour("start_ts").alias("hour"))
            .groupBy("date", "hour").agg(F.count(F.lit(1)).alias("session_count")))


def session_daily_counts(sessions: DataFrame) -> DataFrame:
    """(date, session_count): sessions per start day (the sum of the hourly counts,
    computed in one aggregate rather than two)."""
    return (sessions.select(F.date_format("start_ts", "yyyy-MM-dd").alias("date"))
            .groupBy("date").agg(F.count(F.lit(1)).alias("session_count")))
