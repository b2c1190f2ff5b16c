"""Query catalog: every operator as a (spark, sf_dir) -> DataFrame callable, with the
DuckDB SQL that computes the same rows from the same parquet tables.

Parameters are the reference task's parameters, fixed per query (FIXTURES.md §2.3).
Every query reads the given tables (through ``visitlens.sources.fixtures``) in full;
where a query is restricted, the restriction is the operator's own parameter (a task's
date range, a one-hour trend window, a top-k).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.functions.columns import (
    date_hour_key, minute_key, pack_record, packed_field, parse_action_time,
)
from visitlens.functions.sql import register_sql_functions
from visitlens.operators import ads, areas, categories as cat, extract, funnel, merges, sessions as ses
from visitlens.plans.oracle import LEVEL_CASE, STEP_BOUNDS, VISIT_BOUNDS, with_prelude
from visitlens.plans.params import TaskParams
from visitlens.session import checkpoint_dir
from visitlens.sources import fixtures as fx
from visitlens.sources.keyed_table import KeyedTable
from visitlens.sources.layout import store_actions, stored_session_detail, stored_sessions

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}
ORACLE_BODY: dict[str, str] = {}


def register(name: str, sql: str | None = None, ctes: str = ""):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE_BODY[name] = sql
            ORACLE[name] = with_prelude(sql, ctes)
        return fn
    return deco


# ------------------------------------------------------------------ parameters

SCAN_START, SCAN_END = "2024-01-08", "2024-01-14"
EXTRACT_DATE = "2024-01-08"
EXTRACT_TOTAL = 100
EXTRACT_SEED = "42"
FLOW = "1,2,3,4,5,6,7,8,9".split(",")
BLACKLIST_THRESHOLD = 4
TREND_AS_OF = "2024-01-15 12:00:00"

FILTERS: dict[str, TaskParams] = {
    "age": TaskParams(start_age=10, end_age=40),
    "professional": TaskParams(professionals=["BUILDING", "MACHINERY"]),
    "city": TaskParams(cities=["city1", "city2", "city3", "city5", "city8"]),
    "sex": TaskParams(sex=["male"]),
    "keywords": TaskParams(keywords=["kw1", "kw2"]),
    "categories": TaskParams(category_ids=["3", "4"]),
    "all": TaskParams(start_age=10, end_age=40, sex=["male"], keywords=["kw1", "kw2"],
                      category_ids=["3", "4"]),
}

FILTER_SQL: dict[str, str] = {
    "age": "age BETWEEN 10 AND 40",
    "professional": "professional IN ('BUILDING', 'MACHINERY')",
    "city": "city IN ('city1', 'city2', 'city3', 'city5', 'city8')",
    "sex": "sex IN ('male')",
    "keywords": "list_has_any(kw_list, ['kw1', 'kw2'])",
    "categories": "list_has_any(cat_list, [3, 4])",
}
FILTER_SQL["all"] = " AND ".join(f"({FILTER_SQL[k]})" for k in ("age", "sex", "keywords", "categories"))


# ------------------------------------------------------------------ shared pieces

def _actions(spark: SparkSession, sf: str) -> DataFrame:
    return fx.user_visit_action(spark, sf)


def _sessions(spark: SparkSession, sf: str, start: str | None = None, end: str | None = None) -> DataFrame:
    return ses.session_rollup(ses.scan_actions_by_date(_actions(spark, sf), start, end))


def _sessions_users(spark: SparkSession, sf: str) -> DataFrame:
    return ses.session_user_join(_sessions(spark, sf), fx.user_info(spark, sf))


def _filtered(spark: SparkSession, sf: str, which: str) -> DataFrame:
    return ses.filter_sessions(_sessions_users(spark, sf), FILTERS[which])


def _sess_cte(src: str = "uva", name: str = "sess") -> str:
    """DuckDB session roll-up of the action rows in ``src``."""
    return f"""
{name}_raw AS (
  SELECT session_id, min(user_id) AS user_id,
         min(strptime(action_time, '%Y-%m-%d %H:%M:%S')) AS start_ts,
         max(strptime(action_time, '%Y-%m-%d %H:%M:%S')) AS end_ts,
         count(*) AS step_length,
         string_agg(DISTINCT search_keyword, ',' ORDER BY search_keyword)
             FILTER (WHERE search_keyword <> '') AS search_keywords,
         nullif(array_to_string(list_sort(list_distinct(list(click_category_id))), ','), '')
             AS click_category_ids,
         list_distinct(list(search_keyword) FILTER (WHERE search_keyword <> '')) AS kw_list,
         list_distinct(list(click_category_id)) AS cat_list
  FROM {src} GROUP BY session_id),
{name} AS (
  SELECT session_id, user_id, start_ts, strftime(start_ts, '%Y-%m-%d %H:%M:%S') AS start_time,
         date_diff('second', start_ts, end_ts) AS visit_length, step_length,
         search_keywords, click_category_ids, kw_list, cat_list
  FROM {name}_raw)"""


SESS_COLS = ", ".join(ses.SESSION_COLUMNS)
SU_CTE = _sess_cte() + """,
su AS (SELECT s.*, u.age, u.professional, u.city, u.sex
       FROM sess s JOIN user_info u ON s.user_id = u.user_id)"""


def _ratio_sql(n: str, d: str) -> str:
    return f"CASE WHEN {d} > 0 THEN ((200 * {n} + {d}) // (2 * {d})) / CAST(100 AS DOUBLE) END"


# ------------------------------------------------------------------ scans

@register("scan_actions_by_date",
          f"SELECT * FROM uva WHERE session_date BETWEEN '{SCAN_START}' AND '{SCAN_END}'")
def q_scan_actions_by_date(spark, sf):
    return ses.scan_actions_by_date(_actions(spark, sf), SCAN_START, SCAN_END)


@register("scan_click_actions",
          f"""SELECT city_id, click_product_id AS product_id FROM uva
              WHERE click_product_id IS NOT NULL AND session_date BETWEEN '{SCAN_START}' AND '{SCAN_END}'""")
def q_scan_click_actions(spark, sf):
    return ses.scan_click_actions(_actions(spark, sf), SCAN_START, SCAN_END)


# ------------------------------------------------------------------ roll-up (A1-A5)

@register("session_base", f"SELECT {SESS_COLS} FROM sess", _sess_cte())
def q_session_base(spark, sf):
    return _sessions(spark, sf).select(*ses.SESSION_COLUMNS)


@register("session_base_two_level", f"SELECT {SESS_COLS}, len(coalesce(kw_list, [])) AS n_keywords, len(coalesce(cat_list, [])) AS n_categories FROM sess", _sess_cte())
def q_session_base_two_level(spark, sf):
    sessions, _ = ses.session_rollup_two_level(_actions(spark, sf))
    return sessions.select(*ses.SESSION_COLUMNS, "n_keywords", "n_categories")


# a low bound, so that values go to the side table at every scale
@register("session_overflow_values",
          "SELECT v.* FROM v JOIN (SELECT session_id, kind FROM v GROUP BY ALL HAVING count(*) > 3) USING (session_id, kind)",
          """v AS (SELECT session_id, 'keyword' AS kind, search_keyword AS value FROM uva WHERE search_keyword <> ''
                 UNION SELECT session_id, 'category', CAST(click_category_id AS VARCHAR) FROM uva WHERE click_category_id IS NOT NULL)""")
def q_session_overflow_values(spark, sf):
    return ses.session_rollup_two_level(_actions(spark, sf), max_values=3)[1]


def _stored(spark, sf) -> str:
    name = f"visitlens_actions_{uuid.uuid4().hex}"
    store_actions(_actions(spark, sf), name, buckets=8, path=f"{checkpoint_dir(spark).rstrip('/')}/{name}")
    return name


@register("stored_session_base", f"SELECT {SESS_COLS} FROM sess", _sess_cte())
def q_stored_session_base(spark, sf):
    return stored_sessions(spark, _stored(spark, sf)).select(*ses.SESSION_COLUMNS)


@register("stored_session_detail",
          f"""SELECT * FROM uva WHERE session_date BETWEEN '{SCAN_START}' AND '{SCAN_END}' AND session_id IN (
                SELECT session_id FROM uva WHERE session_date BETWEEN '{SCAN_START}' AND '{SCAN_END}' GROUP BY ALL HAVING count(*) > 2)""")
def q_stored_session_detail(spark, sf):
    name = _stored(spark, sf)
    long = stored_sessions(spark, name, SCAN_START, SCAN_END).where("step_length > 2")
    return stored_session_detail(spark, name, long, SCAN_START, SCAN_END)


@register("session_keywords", "SELECT session_id, search_keywords FROM sess", _sess_cte())
def q_session_keywords(spark, sf):
    return _sessions(spark, sf).select("session_id", "search_keywords")


@register("session_click_categories", "SELECT session_id, click_category_ids FROM sess", _sess_cte())
def q_session_click_categories(spark, sf):
    return _sessions(spark, sf).select("session_id", "click_category_ids")


# ------------------------------------------------------------------ join + filters

_SU_OUT = SESS_COLS + ", age, professional, city, sex"


@register("session_user_join", f"SELECT {_SU_OUT} FROM su", SU_CTE)
def q_session_user_join(spark, sf):
    return _sessions_users(spark, sf).select(*ses.SESSION_COLUMNS, *ses.USER_COLUMNS)


def _filter_query(which: str) -> Query:
    def q(spark, sf):
        return _filtered(spark, sf, which).select(*ses.SESSION_COLUMNS, *ses.USER_COLUMNS)
    return q


for _which in ("age", "professional", "city", "sex", "keywords", "categories", "all"):
    register(f"session_filter_{_which}", f"SELECT {_SU_OUT} FROM su WHERE {FILTER_SQL[_which]}",
             SU_CTE)(_filter_query(_which))


@register("session_filter_equal", f"SELECT {_SU_OUT} FROM su WHERE professional = 'FURNITURE'", SU_CTE)
def q_session_filter_equal(spark, sf):
    return (_sessions_users(spark, sf).where(ses.value_equals("professional", "FURNITURE"))
            .select(*ses.SESSION_COLUMNS, *ses.USER_COLUMNS))


# ------------------------------------------------------------------ detail

@register("session_detail",
          f"SELECT * FROM uva WHERE session_id IN (SELECT session_id FROM su WHERE {FILTER_SQL['all']})",
          SU_CTE)
def q_session_detail(spark, sf):
    return ses.session_detail(_actions(spark, sf), _filtered(spark, sf, "all"))


# the same with a low threshold, so that the salted path is taken at every scale
@register("session_detail_hot",
          f"SELECT * FROM uva WHERE session_id IN (SELECT session_id FROM su WHERE {FILTER_SQL['all']})",
          SU_CTE)
def q_session_detail_hot(spark, sf):
    return ses.session_detail(_actions(spark, sf), _filtered(spark, sf, "all"), hot_session_rows=3)


# ------------------------------------------------------------------ histograms, ratios

def _bucket_case(col: str, buckets) -> str:
    parts = []
    for name, lo, hi in buckets:
        cond = f"{col} >= {lo}" + ("" if hi is None else f" AND {col} < {hi}")
        parts.append(f"WHEN {cond} THEN '{name}'")
    return "CASE " + " ".join(parts) + " END"


@register("session_visit_histogram",
          f"""SELECT bucket, count(*) AS session_count FROM (
                SELECT {_bucket_case('visit_length', VISIT_BOUNDS)} AS bucket FROM sess)
              WHERE bucket IS NOT NULL GROUP BY bucket""", _sess_cte())
def q_session_visit_histogram(spark, sf):
    return ses.visit_length_histogram(_sessions(spark, sf))


@register("session_step_histogram",
          f"""SELECT bucket, count(*) AS session_count FROM (
                SELECT {_bucket_case('step_length', STEP_BOUNDS)} AS bucket FROM sess)
              WHERE bucket IS NOT NULL GROUP BY bucket""", _sess_cte())
def q_session_step_histogram(spark, sf):
    return ses.step_length_histogram(_sessions(spark, sf))


def _aggr_stat_sql(src: str) -> str:
    counts = ["count(*) AS session_count"]
    ratios = ["session_count"]
    for prefix, col, buckets in (("visit", "visit_length", VISIT_BOUNDS),
                                 ("step", "step_length", STEP_BOUNDS)):
        for name, lo, hi in buckets:
            cond = f"{col} >= {lo}" + ("" if hi is None else f" AND {col} < {hi}")
            counts.append(f"count_if({cond}) AS n_{prefix}_{name}")
            ratios.append(f"{_ratio_sql(f'n_{prefix}_{name}', 'session_count')} AS {prefix}_{name}")
    return f"SELECT {', '.join(ratios)} FROM (SELECT {', '.join(counts)} FROM {src})"


@register("session_aggr_stat", _aggr_stat_sql(f"su WHERE {FILTER_SQL['age']}"), SU_CTE)
def q_session_aggr_stat(spark, sf):
    return ses.session_aggr_stat(_filtered(spark, sf, "age"))


@register("session_hourly_counts",
          """SELECT strftime(start_ts, '%Y-%m-%d') AS date, CAST(hour(start_ts) AS INTEGER) AS hour,
                    count(*) AS session_count FROM sess GROUP BY ALL""", _sess_cte())
def q_session_hourly_counts(spark, sf):
    return ses.session_hourly_counts(_sessions(spark, sf))


@register("session_daily_counts",
          """SELECT strftime(start_ts, '%Y-%m-%d') AS date, count(*) AS session_count
             FROM sess GROUP BY ALL""", _sess_cte())
def q_session_daily_counts(spark, sf):
    return ses.session_daily_counts(_sessions(spark, sf))


# ------------------------------------------------------------------ random extract

_EXTRACT_CTES = f"""
ext_src AS (SELECT * FROM uva WHERE session_date BETWEEN '{EXTRACT_DATE}' AND '{EXTRACT_DATE}'),
{_sess_cte('ext_src', 'xs').strip()},
hourly AS (SELECT strftime(start_ts, '%Y-%m-%d') AS date, CAST(hour(start_ts) AS INTEGER) AS hour,
                  count(*) AS session_count FROM xs GROUP BY ALL),
quota AS (
  SELECT date, hour, session_count, day_session_count, day_quota,
         least((session_count * day_quota) // day_session_count, session_count) AS hour_quota
  FROM (SELECT *, CAST(sum(session_count) OVER (PARTITION BY date) AS BIGINT) AS day_session_count,
               {EXTRACT_TOTAL} // (SELECT count(DISTINCT date) FROM hourly) AS day_quota
        FROM hourly)),
drawn AS (
  SELECT session_id, start_time, search_keywords, click_category_ids,
         strftime(start_ts, '%Y-%m-%d') AS date, CAST(hour(start_ts) AS INTEGER) AS hour,
         row_number() OVER (PARTITION BY strftime(start_ts, '%Y-%m-%d'), hour(start_ts)
                            ORDER BY md5(session_id || '{EXTRACT_SEED}'), session_id) AS rn
  FROM xs),
picked AS (
  SELECT d.session_id, d.start_time, d.search_keywords, d.click_category_ids
  FROM drawn d JOIN quota q ON d.date = q.date AND d.hour = q.hour
  WHERE d.rn <= q.hour_quota)"""


def _extract_sessions(spark, sf):
    return _sessions(spark, sf, EXTRACT_DATE, EXTRACT_DATE)


@register("session_extract_quota",
          "SELECT date, hour, session_count, day_session_count, day_quota, hour_quota FROM quota",
          _EXTRACT_CTES)
def q_session_extract_quota(spark, sf):
    return extract.extract_quota(_extract_sessions(spark, sf), EXTRACT_TOTAL)


@register("session_random_extract", "SELECT * FROM picked", _EXTRACT_CTES)
def q_session_random_extract(spark, sf):
    return extract.random_extract(_extract_sessions(spark, sf), EXTRACT_TOTAL, EXTRACT_SEED)


@register("session_extract_detail",
          "SELECT * FROM ext_src WHERE session_id IN (SELECT session_id FROM picked)", _EXTRACT_CTES)
def q_session_extract_detail(spark, sf):
    src = ses.scan_actions_by_date(_actions(spark, sf), EXTRACT_DATE, EXTRACT_DATE)
    picked = extract.random_extract(ses.session_rollup(src), EXTRACT_TOTAL, EXTRACT_SEED)
    return ses.session_detail(src, picked)


# the same sampler over the whole table (every day; 3000 draws so that hourly quotas of
# ~100 daily draws are not all truncated to zero)
MONTH_TOTAL = 3000
_EXTRACT_MONTH_CTES = (_EXTRACT_CTES
                       .replace(f"WHERE session_date BETWEEN '{EXTRACT_DATE}' AND '{EXTRACT_DATE}'", "")
                       .replace(f"{EXTRACT_TOTAL} // (SELECT", f"{MONTH_TOTAL} // (SELECT"))


@register("session_extract_quota_month",
          "SELECT date, hour, session_count, day_session_count, day_quota, hour_quota FROM quota",
          _EXTRACT_MONTH_CTES)
def q_session_extract_quota_month(spark, sf):
    return extract.extract_quota(_sessions(spark, sf), MONTH_TOTAL)


@register("session_random_extract_month", "SELECT * FROM picked", _EXTRACT_MONTH_CTES)
def q_session_random_extract_month(spark, sf):
    return extract.random_extract(_sessions(spark, sf), MONTH_TOTAL, EXTRACT_SEED)


@register("session_extract_detail_month",
          "SELECT * FROM uva WHERE session_id IN (SELECT session_id FROM picked)", _EXTRACT_MONTH_CTES)
def q_session_extract_detail_month(spark, sf):
    picked = extract.random_extract(_sessions(spark, sf), MONTH_TOTAL, EXTRACT_SEED)
    return ses.session_detail(_actions(spark, sf), picked)


# ------------------------------------------------------------------ categories

_CAT_CTES = """
cat_ev AS (
  SELECT session_id, action_id, click_category_id AS category_id, 'click' AS kind
  FROM uva WHERE click_category_id IS NOT NULL
  UNION ALL
  SELECT session_id, action_id, TRY_CAST(trim(x) AS BIGINT), 'order' FROM (
    SELECT session_id, action_id, unnest(string_split(order_category_ids, ',')) AS x
    FROM uva WHERE order_category_ids IS NOT NULL) WHERE TRY_CAST(trim(x) AS BIGINT) IS NOT NULL
  UNION ALL
  SELECT session_id, action_id, TRY_CAST(trim(x) AS BIGINT), 'pay' FROM (
    SELECT session_id, action_id, unnest(string_split(pay_category_ids, ',')) AS x
    FROM uva WHERE pay_category_ids IS NOT NULL) WHERE TRY_CAST(trim(x) AS BIGINT) IS NOT NULL),
cat_counts AS (
  SELECT category_id, CAST(count_if(kind = 'click') AS BIGINT) AS click_count,
         CAST(count_if(kind = 'order') AS BIGINT) AS order_count,
         CAST(count_if(kind = 'pay') AS BIGINT) AS pay_count
  FROM cat_ev GROUP BY category_id),
cat_top AS (
  SELECT * FROM cat_counts
  ORDER BY click_count DESC, order_count DESC, pay_count DESC, category_id LIMIT 10),
cat_sess AS (
  SELECT click_category_id AS category_id, session_id, count(*) AS click_count
  FROM uva WHERE click_category_id IS NOT NULL GROUP BY ALL),
top_sess AS (
  SELECT * FROM (
    SELECT cs.*, CAST(row_number() OVER (PARTITION BY cs.category_id
                                         ORDER BY cs.click_count DESC, cs.session_id) AS INTEGER) AS rank
    FROM cat_sess cs WHERE cs.category_id IN (SELECT category_id FROM cat_top))
  WHERE rank <= 10)"""


@register("category_events_exploded", "SELECT * FROM cat_ev", _CAT_CTES)
def q_category_events_exploded(spark, sf):
    return cat.category_events(_actions(spark, sf))


@register("category_visited", "SELECT DISTINCT category_id FROM cat_ev", _CAT_CTES)
def q_category_visited(spark, sf):
    return cat.category_visited(_actions(spark, sf))


for _kind, _fn in (("click", cat.category_click_counts), ("order", cat.category_order_counts),
                   ("pay", cat.category_pay_counts)):
    register(f"category_{_kind}_counts",
             f"SELECT category_id, count(*) AS {_kind}_count FROM cat_ev WHERE kind = '{_kind}' GROUP BY ALL",
             _CAT_CTES)((lambda f: (lambda spark, sf: f(_actions(spark, sf))))(_fn))


@register("category_counts", "SELECT * FROM cat_counts", _CAT_CTES)
def q_category_counts(spark, sf):
    return cat.category_counts(_actions(spark, sf))


@register("category_ranked",
          """SELECT *, CAST(row_number() OVER (ORDER BY click_count DESC, order_count DESC, pay_count DESC,
                                               category_id) AS INTEGER) AS rank FROM cat_counts""", _CAT_CTES)
def q_category_ranked(spark, sf):
    return cat.category_ranked(_actions(spark, sf))


@register("top10_category", "SELECT * FROM cat_top", _CAT_CTES)
def q_top10_category(spark, sf):
    return cat.top_categories(_actions(spark, sf), 10)


@register("category_session_clicks", "SELECT * FROM cat_sess", _CAT_CTES)
def q_category_session_clicks(spark, sf):
    return cat.category_session_clicks(_actions(spark, sf))


@register("top10_category_session", "SELECT * FROM top_sess", _CAT_CTES)
def q_top10_category_session(spark, sf):
    return cat.top_sessions_per_category(_actions(spark, sf), 10, 10)


@register("top10_session_detail",
          "SELECT u.*, t.category_id FROM uva u JOIN top_sess t ON u.session_id = t.session_id",
          _CAT_CTES)
def q_top10_session_detail(spark, sf):
    return cat.top_session_detail(_actions(spark, sf), 10, 10)


# ------------------------------------------------------------------ funnel

_FLOW_VALUES = ", ".join(f"({i}, {FLOW[i - 1]}, {FLOW[i]}, '{FLOW[i - 1]}_{FLOW[i]}')"
                         for i in range(1, len(FLOW)))
_FUNNEL_CTES = f"""
trans AS (
  SELECT * FROM (
    SELECT session_id, action_id,
           lag(page_id) OVER (PARTITION BY session_id
                              ORDER BY strptime(action_time, '%Y-%m-%d %H:%M:%S'), action_id) AS prev_page_id,
           page_id
    FROM uva) WHERE prev_page_id IS NOT NULL),
steps AS (SELECT * FROM (VALUES {_FLOW_VALUES}) AS t(pos, prev_page_id, page_id, split)),
split_pv AS (
  SELECT s.pos, s.split, coalesce(c.pv, 0) AS pv
  FROM steps s LEFT JOIN (SELECT prev_page_id, page_id, count(*) AS pv FROM trans GROUP BY ALL) c
    ON s.prev_page_id = c.prev_page_id AND s.page_id = c.page_id),
start_pv AS (SELECT CAST({FLOW[0]} AS BIGINT) AS page_id, count(*) AS pv FROM uva WHERE page_id = {FLOW[0]}),
rates AS (
  SELECT pos, split, pv, prev_pv, {_ratio_sql('pv', 'prev_pv')} AS convert_rate
  FROM (SELECT *, lag(pv) OVER (ORDER BY pos) AS prev_pv FROM (
          SELECT 0 AS pos, NULL AS split, pv FROM start_pv
          UNION ALL SELECT pos, split, pv FROM split_pv))
  WHERE pos >= 1)"""


def _transitions(spark, sf):
    return funnel.page_transitions(_actions(spark, sf))


@register("page_transitions", "SELECT * FROM trans", _FUNNEL_CTES)
def q_page_transitions(spark, sf):
    return funnel.page_transitions(_actions(spark, sf))


@register("page_transitions_skew_safe", "SELECT * FROM trans", _FUNNEL_CTES)
def q_page_transitions_skew_safe(spark, sf):
    return funnel.page_transitions_skew_safe(_actions(spark, sf))


@register("page_start_pv", "SELECT * FROM start_pv", _FUNNEL_CTES)
def q_page_start_pv(spark, sf):
    return funnel.page_start_pv(_actions(spark, sf), FLOW)


@register("page_split_pv", "SELECT * FROM split_pv", _FUNNEL_CTES)
def q_page_split_pv(spark, sf):
    return funnel.page_split_pv(_transitions(spark, sf), FLOW)


@register("page_convert_rate", "SELECT * FROM rates", _FUNNEL_CTES)
def q_page_convert_rate(spark, sf):
    actions = _actions(spark, sf)
    return funnel.page_convert_rate(actions, FLOW, funnel.page_transitions(actions))


@register("page_convert_rate_string",
          "SELECT string_agg(split || '=' || CAST(convert_rate AS VARCHAR), '|' ORDER BY pos) AS convert_rate FROM rates",
          _FUNNEL_CTES)
def q_page_convert_rate_string(spark, sf):
    actions = _actions(spark, sf)
    return funnel.page_convert_rate_string(funnel.page_convert_rate(actions, FLOW))


# ------------------------------------------------------------------ areas

_LEVEL_CASE = LEVEL_CASE
_AREA_CTES = f"""
basic AS (
  SELECT CAST(c.city_id AS BIGINT) AS city_id, c.city_name, c.area, u.click_product_id AS product_id
  FROM uva u JOIN city_info c ON u.city_id = c.city_id
  WHERE u.click_product_id IS NOT NULL),
apc AS (
  SELECT area, product_id, count(*) AS click_count,
         string_agg(DISTINCT city_id || ':' || city_name, ',' ORDER BY city_id || ':' || city_name) AS city_infos
  FROM basic GROUP BY area, product_id),
full_ AS (
  SELECT a.area, a.product_id, a.click_count, a.city_infos, p.product_name,
         CASE WHEN json_extract_string(p.extend_info, '$.product_status') = '0' THEN 'self'
              ELSE 'third party' END AS product_status
  FROM apc a JOIN product_info p ON a.product_id = p.product_id)"""


def _area_basic(spark, sf):
    clicks = ses.scan_click_actions(_actions(spark, sf), None, None)
    return areas.area_click_basic(clicks, fx.city_info(spark))


@register("area_click_basic", "SELECT * FROM basic", _AREA_CTES)
def q_area_click_basic(spark, sf):
    return _area_basic(spark, sf)


@register("area_product_clicks", "SELECT * FROM apc", _AREA_CTES)
def q_area_product_clicks(spark, sf):
    return areas.area_product_clicks(_area_basic(spark, sf))


@register("area_product_full", "SELECT * FROM full_", _AREA_CTES)
def q_area_product_full(spark, sf):
    return areas.area_product_full(areas.area_product_clicks(_area_basic(spark, sf)), fx.product_info(spark, sf))


@register("area_top3_product",
          f"""SELECT area, {_LEVEL_CASE} AS area_level, product_id, click_count, city_infos, product_name,
                     product_status FROM (
                SELECT *, row_number() OVER (PARTITION BY area ORDER BY click_count DESC, product_id) AS rank
                FROM full_) WHERE rank <= 3""", _AREA_CTES)
def q_area_top3_product(spark, sf):
    full = areas.area_product_full(areas.area_product_clicks(_area_basic(spark, sf)), fx.product_info(spark, sf))
    return areas.area_top_products(full, 3)


@register("area_level",
          f"SELECT area, {_LEVEL_CASE} AS area_level, count(*) AS click_count FROM basic GROUP BY area",
          _AREA_CTES)
def q_area_level(spark, sf):
    return (_area_basic(spark, sf).groupBy("area")
            .agg(F.count(F.lit(1)).alias("click_count"))
            .select("area", areas.area_level(F.col("area")).alias("area_level"), "click_count"))


@register("udf_concat_long_string",
          "SELECT product_id, city_id || ':' || city_name AS city_info FROM basic", _AREA_CTES)
def q_udf_concat_long_string(spark, sf):
    register_sql_functions(spark)
    return _area_basic(spark, sf).select(
        "product_id", F.expr("concat_long_string(city_id, city_name, ':')").alias("city_info"))


@register("udf_json_field",
          "SELECT product_id, json_extract_string(extend_info, '$.product_status') AS product_status FROM product_info")
def q_udf_json_field(spark, sf):
    register_sql_functions(spark)
    return fx.product_info(spark, sf).select(
        "product_id", F.expr("json_field(extend_info, 'product_status')").alias("product_status"))


@register("udaf_group_concat_distinct",
          """SELECT area, string_agg(DISTINCT city_id || ':' || city_name, ','
                                     ORDER BY city_id || ':' || city_name) AS city_infos
             FROM basic GROUP BY area""", _AREA_CTES)
def q_udaf_group_concat_distinct(spark, sf):
    register_sql_functions(spark)
    infos = _area_basic(spark, sf).select(
        "area", F.expr("concat_long_string(city_id, city_name, ':')").alias("info"))
    return infos.groupBy("area").agg(
        F.expr("listagg(DISTINCT info, ',') WITHIN GROUP (ORDER BY info)").alias("city_infos"))


# ------------------------------------------------------------------ scalar keys

_PACK_KEYS = [("sessionid", "session_id"), ("searchKeywords", "search_keywords"),
              ("clickCategoryIds", "click_category_ids"), ("visitLength", "visit_length"),
              ("stepLength", "step_length"), ("startTime", "start_time")]


@register("packed_record_parse",
          """SELECT session_id, search_keywords, click_category_ids, CAST(visit_length AS VARCHAR) AS visit_length,
                    CAST(step_length AS VARCHAR) AS step_length, start_time FROM sess""", _sess_cte())
def q_packed_record_parse(spark, sf):
    s = _sessions(spark, sf)
    packed = s.select(pack_record({k: F.col(c) for k, c in _PACK_KEYS}).alias("rec"))
    return packed.select(*[packed_field(F.col("rec"), k).alias(c) for k, c in _PACK_KEYS])


@register("event_date_keys",
          """SELECT action_id,
                    strftime(t, '%Y-%m-%d_%H') AS date_hour,
                    strftime(t, '%Y-%m-%d %H:%M:%S') AS time_str,
                    strftime(t, '%Y%m%d') AS date_key,
                    strftime(strptime(strftime(t, '%Y%m%d'), '%Y%m%d'), '%Y-%m-%d') AS date_from_key,
                    strftime(t, '%Y%m%d%H%M') AS minute_key,
                    substr(strftime(t, '%Y%m%d%H%M'), 9, 2) AS hour,
                    substr(strftime(t, '%Y%m%d%H%M'), 11, 2) AS minute
             FROM (SELECT action_id, strptime(action_time, '%Y-%m-%d %H:%M:%S') AS t FROM uva)""")
def q_event_date_keys(spark, sf):
    a = _actions(spark, sf).select("action_id", parse_action_time(F.col("action_time")).alias("t"))
    mk = minute_key(F.col("t"))
    dk = F.date_format("t", "yyyyMMdd")
    return a.select(
        "action_id", date_hour_key(F.col("t")).alias("date_hour"),
        F.date_format("t", "yyyy-MM-dd HH:mm:ss").alias("time_str"),
        dk.alias("date_key"),
        F.date_format(F.to_date(dk, "yyyyMMdd"), "yyyy-MM-dd").alias("date_from_key"),
        mk.alias("minute_key"), F.substring(mk, 9, 2).alias("hour"), F.substring(mk, 11, 2).alias("minute"))


# ------------------------------------------------------------------ ads

_AD_CTES = f"""
pb AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date, user_id, ad_id, CAST(ts AS DATE) AS batch, count(*) AS n
  FROM ad_clicks GROUP BY ALL),
listed AS (
  SELECT user_id, min(batch) AS first_batch FROM (
    SELECT *, sum(n) OVER (PARTITION BY date, user_id, ad_id ORDER BY batch
                           ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS running FROM pb)
  WHERE running >= {BLACKLIST_THRESHOLD} GROUP BY user_id),
kept AS (
  SELECT c.* FROM ad_clicks c LEFT JOIN listed l ON c.user_id = l.user_id
  WHERE l.first_batch IS NULL OR CAST(c.ts AS DATE) <= l.first_batch),
stat AS (
  SELECT strftime(ts, '%Y%m%d') AS date, province, city, ad_id, count(*) AS click_count
  FROM kept GROUP BY ALL),
prov AS (
  SELECT date, province, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count FROM stat GROUP BY ALL),
top3 AS (
  SELECT date, province, ad_id, click_count FROM (
    SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, ad_id) AS rank
    FROM prov) WHERE rank <= 3),
trend AS (
  SELECT strftime(m, '%Y-%m-%d') AS date, strftime(m, '%H') AS hour, strftime(m, '%M') AS minute,
         ad_id, click_count
  FROM (SELECT date_trunc('minute', ts) AS m, ad_id, count(*) AS click_count FROM kept GROUP BY ALL))"""


def _kept(spark, sf):
    return ads.blacklist_filter(fx.ad_clicks(spark, sf), BLACKLIST_THRESHOLD)


def _ms(df: DataFrame) -> DataFrame:
    return df.select(F.unix_millis("ts").alias("ts_ms"), "province", "city", "user_id", "ad_id")


@register("ad_log_parse", "SELECT epoch_us(ts) // 1000 AS ts_ms, province, city, user_id, ad_id FROM ad_clicks")
def q_ad_log_parse(spark, sf):
    clicks, _rejects = ads.parse_ad_log(fx.ad_log_lines(spark, sf))
    return _ms(clicks)


@register("ad_blacklist_users", "SELECT user_id, strftime(first_batch, '%Y-%m-%d') AS first_batch FROM listed",
          _AD_CTES)
def q_ad_blacklist_users(spark, sf):
    return (ads.blacklist_first_batch(fx.ad_clicks(spark, sf), BLACKLIST_THRESHOLD)
            .select("user_id", F.date_format("first_batch", "yyyy-MM-dd").alias("first_batch")))


@register("ad_blacklist_filter", "SELECT epoch_us(ts) // 1000 AS ts_ms, province, city, user_id, ad_id FROM kept",
          _AD_CTES)
def q_ad_blacklist_filter(spark, sf):
    return _ms(_kept(spark, sf))


@register("ad_blacklist_filter_pages", "SELECT epoch_us(ts) // 1000 AS ts_ms, province, city, user_id, ad_id FROM kept",
          _AD_CTES)
def q_ad_blacklist_filter_pages(spark, sf):
    return _ms(ads.blacklist_filter_pages(fx.ad_clicks(spark, sf), BLACKLIST_THRESHOLD))


@register("ad_blacklist_filter_hot", "SELECT epoch_us(ts) // 1000 AS ts_ms, province, city, user_id, ad_id FROM kept",
          _AD_CTES)
def q_ad_blacklist_filter_hot(spark, sf):
    return _ms(ads.blacklist_filter(fx.ad_clicks(spark, sf), BLACKLIST_THRESHOLD, hot_user_rows=60))


@register("ad_user_daily_clicks",
          "SELECT strftime(ts, '%Y-%m-%d') AS date, user_id, ad_id, count(*) AS click_count FROM kept GROUP BY ALL",
          _AD_CTES)
def q_ad_user_daily_clicks(spark, sf):
    return ads.user_daily_clicks(_kept(spark, sf))


@register("ad_stat", "SELECT * FROM stat", _AD_CTES)
def q_ad_stat(spark, sf):
    return ads.ad_stat(_kept(spark, sf))


@register("ad_province_clicks", "SELECT * FROM prov", _AD_CTES)
def q_ad_province_clicks(spark, sf):
    return ads.province_clicks(ads.ad_stat(_kept(spark, sf)))


@register("ad_province_top3", "SELECT * FROM top3", _AD_CTES)
def q_ad_province_top3(spark, sf):
    return ads.province_top_ads(ads.ad_stat(_kept(spark, sf)), 3)


@register("ad_click_trend", "SELECT * FROM trend", _AD_CTES)
def q_ad_click_trend(spark, sf):
    return ads.click_trend(_kept(spark, sf))


@register("ad_click_trend_last_hour",
          f"""SELECT strftime(m, '%Y-%m-%d') AS date, strftime(m, '%H') AS hour, strftime(m, '%M') AS minute,
                     ad_id, click_count
              FROM (SELECT date_trunc('minute', ts) AS m, ad_id, count(*) AS click_count FROM kept
                    WHERE ts > TIMESTAMP '{TREND_AS_OF}' - INTERVAL 60 MINUTE AND ts <= TIMESTAMP '{TREND_AS_OF}'
                    GROUP BY ALL)""", _AD_CTES)
def q_ad_click_trend_last_hour(spark, sf):
    return ads.click_trend_window(_kept(spark, sf), TREND_AS_OF, 60)


# Independent of the operator's running sums: a dense grid of slide ends and a frame of 360 panes.
_SLIDE_CTES = _AD_CTES + """,
panes AS (SELECT ad_id, CAST(floor(epoch(ts) / 10) AS BIGINT) AS pane, count(*) AS n FROM kept GROUP BY ALL),
grid AS (
  SELECT ad_id, unnest(range(lo + 1, hi + 361)) AS e
  FROM (SELECT ad_id, min(pane) AS lo, max(pane) AS hi FROM panes GROUP BY ad_id)),
slides AS (
  SELECT g.ad_id, e, CAST(sum(coalesce(n, 0)) OVER (PARTITION BY g.ad_id ORDER BY e
                          ROWS BETWEEN 359 PRECEDING AND CURRENT ROW) AS BIGINT) AS click_count
  FROM grid g LEFT JOIN panes p ON p.ad_id = g.ad_id AND p.pane = g.e - 1)"""


@register("ad_click_trend_sliding",
          "SELECT e * 10 AS window_end_s, ad_id, click_count FROM slides WHERE click_count > 0", _SLIDE_CTES)
def q_ad_click_trend_sliding(spark, sf):
    return ads.sliding_trend(_kept(spark, sf)).select(F.unix_seconds("window_end").alias("window_end_s"), "ad_id", "click_count")


@register("ad_click_trend_peaks",
          """SELECT ad_id, max(click_count) AS peak_clicks, arg_min(e, (-click_count, e)) * 10 AS peak_end_s,
                    count(*) * 10 AS active_seconds
             FROM slides WHERE click_count > 0 GROUP BY ad_id""", _SLIDE_CTES)
def q_ad_click_trend_peaks(spark, sf):
    return ads.sliding_peaks(_kept(spark, sf)).select("ad_id", "peak_clicks", F.unix_seconds("peak_end").alias("peak_end_s"), "active_seconds")


@register("ad_user_sessions",
          """SELECT user_id, epoch_us(min(ts)) // 1000 AS start_ms, epoch_us(max(ts)) // 1000 AS end_ms, count(*) AS click_count,
                    count(DISTINCT ad_id) AS ads
             FROM (SELECT *, sum(begins) OVER (PARTITION BY user_id ORDER BY ts RANGE UNBOUNDED PRECEDING) AS visit
                   FROM (SELECT *, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER (PARTITION BY user_id ORDER BY ts)) >= 86400000000
                                        THEN 1 ELSE 0 END AS begins FROM ad_clicks))
             GROUP BY user_id, visit""")
def q_ad_user_sessions(spark, sf):
    visits = ads.user_sessions(fx.ad_clicks(spark, sf), gap_seconds=86_400)
    return visits.select("user_id", F.unix_millis("session_start").alias("start_ms"), F.unix_millis("session_end").alias("end_ms"),
                         "click_count", "ads")


# merges: the earlier half-minute's stat is the stored table, the later half the update

_MERGE_CTES = _AD_CTES + """,
st_a AS (SELECT strftime(ts, '%Y%m%d') AS date, province, city, ad_id, count(*) AS click_count
         FROM kept WHERE second(ts) < 30 GROUP BY ALL),
st_b AS (SELECT strftime(ts, '%Y%m%d') AS date, province, city, ad_id, count(*) AS click_count
         FROM kept WHERE second(ts) >= 30 GROUP BY ALL)"""
_STAT_KEYS = ["date", "province", "city", "ad_id"]


def _halves(spark, sf):
    # one aggregate with a count for each half; both frames read its one shuffle
    both = (_kept(spark, sf).select(ads.date_key(F.col("ts")).alias("date"), "province", "city", "ad_id", (F.second("ts") < 30).alias("early"))
            .groupBy(*_STAT_KEYS).agg(F.count_if("early").alias("n_early"), F.count_if(~F.col("early")).alias("n_late")))
    half = lambda n: both.where(F.col(n) > 0).select(*_STAT_KEYS, F.col(n).alias("click_count"))
    return half("n_early"), half("n_late")


@register("merge_overwrite",
          f"""SELECT * FROM st_a a WHERE NOT EXISTS (
                SELECT 1 FROM st_b b WHERE a.date = b.date
                  AND a.province = b.province AND a.city = b.city AND a.ad_id = b.ad_id)
              UNION ALL SELECT * FROM st_b""", _MERGE_CTES)
def q_merge_overwrite(spark, sf):
    a, b = _halves(spark, sf)
    return merges.merge_overwrite(a, b, _STAT_KEYS)


@register("merge_add",
          """SELECT date, province, city, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count
             FROM (SELECT * FROM st_a UNION ALL SELECT * FROM st_b) GROUP BY ALL""", _MERGE_CTES)
def q_merge_add(spark, sf):
    a, b = _halves(spark, sf)
    return merges.merge_add(a, b, _STAT_KEYS, ["click_count"])


_TOP3_OF = """SELECT date, province, ad_id, click_count FROM (
    SELECT *, row_number() OVER (PARTITION BY date, province ORDER BY click_count DESC, ad_id) AS rank
    FROM (SELECT date, province, ad_id, CAST(sum(click_count) AS BIGINT) AS click_count FROM {src} GROUP BY ALL))
  WHERE rank <= 3"""


@register("merge_replace_group",
          f"""SELECT * FROM ({_TOP3_OF.format(src='st_a')}) a WHERE NOT EXISTS (
                SELECT 1 FROM ({_TOP3_OF.format(src='st_b')}) b
                WHERE a.date = b.date AND a.province = b.province)
              UNION ALL SELECT * FROM ({_TOP3_OF.format(src='st_b')})""",
          _MERGE_CTES)
def q_merge_replace_group(spark, sf):
    a, b = _halves(spark, sf)
    top_a = ads.province_top_ads(a, 3)
    top_b = ads.province_top_ads(b, 3)
    return merges.merge_replace_group(top_a, top_b, ["date", "province"])


# the same merges through the stored merge-on-read table: two commits, the second one folded

def _stat_store(spark: SparkSession, schema: str, keys: list[str], group: list[str] | None = None) -> KeyedTable:
    path = f"{checkpoint_dir(spark).rstrip('/')}/keyed-{uuid.uuid4().hex}"
    return KeyedTable(spark, path, schema, keys, ["click_count"], group, buckets=8)


_STAT_DDL = "date string, province string, city string, ad_id bigint, click_count bigint"


@register("keyed_table_overwrite", ORACLE_BODY["merge_overwrite"], _MERGE_CTES)
def q_keyed_table_overwrite(spark, sf):
    a, b = _halves(spark, sf)
    store = _stat_store(spark, _STAT_DDL, _STAT_KEYS)
    store.overwrite(a, 0)
    store.overwrite(b, 1)
    return store.current()


@register("keyed_table_add", ORACLE_BODY["merge_add"], _MERGE_CTES)
def q_keyed_table_add(spark, sf):
    a, b = _halves(spark, sf)
    store = _stat_store(spark, _STAT_DDL, _STAT_KEYS)
    store.add(a, 0)
    store.compact(0, least=1)
    store.add(b, 1)
    return store.current()


@register("keyed_table_replace_group", ORACLE_BODY["merge_replace_group"], _MERGE_CTES)
def q_keyed_table_replace_group(spark, sf):
    a, b = _halves(spark, sf)
    store = _stat_store(spark, "date string, province string, ad_id bigint, click_count bigint", ["date", "province", "ad_id"],
                        ["date", "province"])
    store.replace_groups(ads.province_top_ads(a, 3), 0)
    store.replace_groups(ads.province_top_ads(b, 3), 1)
    return store.current()
