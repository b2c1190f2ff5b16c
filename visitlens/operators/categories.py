"""Top categories and their most active sessions.

Category events (click, order, pay) are produced by one ``explode`` per action row, so
the action table is scanned once; the three per-category counts come out of a single
conditional aggregation instead of a distinct + three outer joins.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from visitlens.functions.columns import split_ids
from visitlens.operators.ranking import global_row_number

CLICK, ORDER, PAY = "click", "order", "pay"


def category_events(actions: DataFrame) -> DataFrame:
    """(session_id, action_id, category_id, kind) for every click / order / pay category.

    Comma lists are split; empty or malformed ids are dropped.
    """
    click = F.when(F.col("click_category_id").isNotNull(),
                   F.array(F.struct(F.col("click_category_id").cast("bigint").alias("category_id"),
                                    F.lit(CLICK).alias("kind"))))
    order = F.transform(split_ids(F.col("order_category_ids")),
                        lambda x: F.struct(x.alias("category_id"), F.lit(ORDER).alias("kind")))
    pay = F.transform(split_ids(F.col("pay_category_ids")),
                      lambda x: F.struct(x.alias("category_id"), F.lit(PAY).alias("kind")))
    empty = F.array().cast("array<struct<category_id:bigint,kind:string>>")
    events = F.concat(F.coalesce(click, empty), F.coalesce(order, empty), F.coalesce(pay, empty))
    cols = [c for c in ("session_id", "action_id") if c in actions.columns]
    return (actions.select(*cols, F.explode(events).alias("e"))
            .select(*cols, "e.category_id", "e.kind"))


def category_visited(actions: DataFrame) -> DataFrame:
    """Distinct categories clicked, ordered or paid."""
    return category_events(actions).select("category_id").distinct()


def _kind_counts(actions: DataFrame, kind: str, name: str) -> DataFrame:
    return (category_events(actions).where(F.col("kind") == kind)
            .groupBy("category_id").agg(F.count(F.lit(1)).alias(name)))


def category_click_counts(actions: DataFrame) -> DataFrame:
    return _kind_counts(actions, CLICK, "click_count")


def category_order_counts(actions: DataFrame) -> DataFrame:
    return _kind_counts(actions, ORDER, "order_count")


def category_pay_counts(actions: DataFrame) -> DataFrame:
    return _kind_counts(actions, PAY, "pay_count")


def category_counts(actions: DataFrame) -> DataFrame:
    """(category_id, click_count, order_count, pay_count) for every visited category;
    a kind never seen counts 0."""
    kind = F.col("kind")
    return category_events(actions).groupBy("category_id").agg(
        F.count_if(kind == CLICK).alias("click_count"),
        F.count_if(kind == ORDER).alias("order_count"),
        F.count_if(kind == PAY).alias("pay_count"),
    )


def rank_order() -> list:
    """click, order, pay descending; category id ascending breaks ties."""
    return [F.col("click_count").desc(), F.col("order_count").desc(),
            F.col("pay_count").desc(), F.col("category_id").asc()]


def category_ranked(actions: DataFrame) -> DataFrame:
    """Every visited category with its rank by (click, order, pay) descending, id ascending.

    The per-category counts are ranked by ranges (``ranking.global_row_number``), so no task sees all categories.
    """
    ranked = global_row_number(category_counts(actions), rank_order())
    return ranked.withColumn("rank", F.col("rank").cast("int"))


def top_categories(actions: DataFrame, k: int = 10) -> DataFrame:
    """The first ``k`` categories in rank order (planned as TakeOrderedAndProject)."""
    return category_counts(actions).orderBy(*rank_order()).limit(k)


def category_session_clicks(actions: DataFrame) -> DataFrame:
    """(category_id, session_id, click_count): clicks per session and category."""
    return (actions.where(F.col("click_category_id").isNotNull())
            .groupBy(F.col("click_category_id").alias("category_id"), "session_id")
            .agg(F.count(F.lit(1)).alias("click_count")))


def top_sessions_per_category(actions: DataFrame, k_categories: int = 10,
                              k_sessions: int = 10) -> DataFrame:
    """(category_id, session_id, click_count, rank) for the top sessions of each top category.

    The top-category list holds at most ``k_categories`` rows, so broadcasting it is
    bounded. ``row_number() <= k`` is planned with a map-side WindowGroupLimit, so a
    category with a huge number of sessions is cut to k rows per task before its shuffle.
    """
    top = top_categories(actions, k_categories).select("category_id")
    # keep only clicks of the top categories before counting per (category, session), so
    # the aggregate's shuffle carries k categories' clicks, not every category's
    clicks = actions.join(F.broadcast(top.withColumnRenamed("category_id", "click_category_id")),
                          "click_category_id", "left_semi")
    per = category_session_clicks(clicks)
    w = Window.partitionBy("category_id").orderBy(F.col("click_count").desc(), F.col("session_id"))
    return (per.withColumn("rank", F.row_number().over(w))
            .where(F.col("rank") <= F.lit(k_sessions)))


def top_session_detail(actions: DataFrame, k_categories: int = 10, k_sessions: int = 10,
                       distinct: bool = False) -> DataFrame:
    """Action rows of the top sessions, one copy per (category, session) it ranks in.

    Duplicates are intentional (as in the reference): a session that is top in two
    categories appears twice, tagged with each category. ``distinct=True`` returns each
    action row once, without the category. The top-session list has at most
    k_categories * k_sessions rows (broadcast-bounded).
    """
    top = top_sessions_per_category(actions, k_categories, k_sessions).select("category_id", "session_id")
    if distinct:
        return actions.join(F.broadcast(top.select("session_id").distinct()), "session_id", "left_semi")
    return actions.join(F.broadcast(top), "session_id", "inner")
