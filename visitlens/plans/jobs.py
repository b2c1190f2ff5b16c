"""The reference's three batch jobs as functions returning lazy result tables.

Each returns ``{result_table_name: DataFrame}`` with ``task_id`` stamped on every row;
write them with ``visitlens.sources.sinks``. DataFrames reused by several results are
checkpointed to the shared folder, or on request persisted (``MEMORY_AND_DISK``: recomputed
from lineage if an executor is lost); call ``release(results)`` after writing.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.operators import areas, categories as cat, extract, funnel, sessions as ses
from visitlens.plans.params import TaskParams
from visitlens.session import checkpoint_dir

_PERSISTED = "_visitlens_persisted"


def _stamp(df: DataFrame, task_id: int) -> DataFrame:
    return df.select(F.lit(task_id).cast("int").alias("task_id"), *df.columns)


#: The stored columns of an action in the detail table, in order.
DETAIL_COLUMNS = ["user_id", "session_id", "page_id", "action_time", "search_keyword", "click_category_id", "click_product_id",
                  "order_category_ids", "order_product_ids", "pay_category_ids", "pay_product_ids"]


def _stat_table(stat: DataFrame) -> DataFrame:
    """The aggregate under the stored column names (1s_3s ... 60)."""
    return stat.select(*[F.col(c).alias(c.removeprefix("visit_").removeprefix("step_")) for c in stat.columns])


def _materialize(df: DataFrame, how: str) -> DataFrame:
    """``persist``: cached, recomputed from lineage if an executor is lost.
    ``checkpoint``: written to the shared ``spark.checkpoint.dir`` (lineage cut)."""
    if how == "checkpoint":
        checkpoint_dir(df.sparkSession)
        return df.checkpoint(eager=True)
    return df.persist(StorageLevel.MEMORY_AND_DISK)


def run_session_job(actions: DataFrame, users: DataFrame, params: TaskParams, task_id: int,
                    extract_total: int = 100, seed: str = "42", top_categories: int = 10,
                    top_sessions: int = 10, materialize: str = "checkpoint") -> dict[str, DataFrame]:
    """Session analysis: aggregate stat, random extract (+ detail), top categories,
    top sessions per category (+ detail). The filtered sessions and their action rows
    feed several results, so they are materialised once (``materialize``)."""
    scanned = ses.scan_actions_by_date(actions, params.start_date, params.end_date)
    sessions = ses.session_user_join(ses.session_rollup(scanned), users)
    filtered = _materialize(ses.filter_sessions(sessions, params), materialize)
    detail = _materialize(ses.session_detail(scanned, filtered), materialize)
    picked = extract.random_extract(filtered, extract_total, seed)
    top = cat.top_categories(detail, top_categories)
    top_sess = cat.top_sessions_per_category(detail, top_categories, top_sessions)
    # the sample holds at most ``extract_total`` sessions: a bounded broadcast
    sampled = detail.join(F.broadcast(picked.select("session_id")), "session_id", "left_semi")
    # one copy per (category, session) ranked, tagged with the category; at most
    # top_categories * top_sessions pairs are broadcast
    ranked = detail.join(F.broadcast(top_sess.select("category_id", "session_id")), "session_id", "inner")
    results = {
        "session_aggr_stat": _stamp(_stat_table(ses.session_aggr_stat(filtered)), task_id),
        "session_random_extract": _stamp(picked, task_id),
        "session_detail": _stamp(sampled.select(*DETAIL_COLUMNS).unionByName(ranked.select(*DETAIL_COLUMNS)), task_id),
        "top10_category": _stamp(top, task_id),
        "top10_category_session": _stamp(top_sess.select("category_id", "session_id", "click_count"), task_id),
        "top10_session_detail": _stamp(ranked, task_id),
    }
    results[_PERSISTED] = [filtered, detail]  # type: ignore[assignment]
    return results


def run_funnel_job(actions: DataFrame, params: TaskParams, task_id: int) -> dict[str, DataFrame]:
    """Page funnel: per-step conversion rates and their packed string."""
    scanned = ses.scan_actions_by_date(actions, params.start_date, params.end_date)
    flow = params.target_page_flow or []
    rates = funnel.page_convert_rate(scanned, flow)
    return {
        "page_convert_rate": _stamp(rates, task_id),
        "page_split_convert_rate": _stamp(funnel.page_convert_rate_string(rates), task_id),
    }


def run_area_job(actions: DataFrame, cities: DataFrame, products: DataFrame, params: TaskParams,
                 task_id: int, k: int = 3) -> dict[str, DataFrame]:
    """Top-k products per area."""
    clicks = ses.scan_click_actions(actions, params.start_date, params.end_date)
    apc = areas.area_product_clicks(areas.area_click_basic(clicks, cities))
    top = areas.area_top_products(areas.area_product_full(apc, products), k)
    return {"area_top3_product": _stamp(top, task_id)}


def release(results: dict) -> None:
    for df in results.get(_PERSISTED, []):
        df.unpersist()


def tables(results: dict) -> dict[str, DataFrame]:
    return {k: v for k, v in results.items() if k != _PERSISTED}
