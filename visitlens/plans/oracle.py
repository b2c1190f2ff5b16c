"""DuckDB SQL mirror of ``visitlens.sources.fixtures`` (used only for correctness checks).

``with_prelude(body)`` prefixes a query with CTEs ``uva`` (user_visit_action),
``user_info``, ``product_info``, ``city_info`` and ``ad_clicks`` built from the
pre-registered views ``events``, ``customer`` and ``part``.
"""

from __future__ import annotations

# Fixed values, written out here on their own so that a wrong value in the library shows.
_CITY_VALUES = """(0, '北京', '华北'), (1, '上海', '华东'), (2, '南京', '华东'), (3, '广州', '华南'), (4, '三亚', '华南'),
    (5, '武汉', '华中'), (6, '长沙', '华中'), (7, '西安', '西北'), (8, '成都', '西南'), (9, '哈尔滨', '东北')"""
_PROVINCES = "'Jiangsu', 'Jiangsu', 'Hubei', 'Hubei', 'Hunan', 'Hunan', 'Henan', 'Henan', 'Hebei', 'Hebei'"
_CITIES = ("'Nanjing', 'Suzhou', 'Wuhan', 'Jingzhou', 'Changsha', 'Xiangtan', 'Zhengzhou', 'Luoyang', "
           "'Shijiazhuang', 'Zhangjiakou'")
VISIT_BOUNDS = [("1s_3s", 1, 4), ("4s_6s", 4, 7), ("7s_9s", 7, 10), ("10s_30s", 10, 30), ("30s_60s", 30, 60),
                ("1m_3m", 60, 180), ("3m_10m", 180, 600), ("10m_30m", 600, 1800), ("30m", 1800, None)]
STEP_BOUNDS = [("1_3", 1, 4), ("4_6", 4, 7), ("7_9", 7, 10), ("10_30", 10, 30), ("30_60", 30, 60), ("60", 60, None)]
LEVEL_CASE = """CASE WHEN area IN ('华北', '华东') THEN 'A level' WHEN area IN ('华南', '华中') THEN 'B level'
    WHEN area IN ('西北', '西南') THEN 'C level' ELSE 'D level' END"""

PRELUDE = f"""
uva_e AS (
  SELECT event_id, user_id, event_type,
         CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
         CAST(ts AS DATE) AS d,
         hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS sod,
         weekofyear(ts) AS wk
  FROM events),
uva AS (
  SELECT strftime(d, '%Y-%m-%d') AS session_date,
         user_id,
         's' || user_id || '-' || CASE WHEN user_id % 10 = 0 THEN 'm'
                                       WHEN user_id % 10 = 1 THEN 'w' || wk
                                       ELSE strftime(d, '%Y%m%d') END AS session_id,
         1 + (k % 9) AS page_id,
         strftime(CAST(d AS TIMESTAMP) + to_seconds((user_id % 24) * 3600
                  + (sod // (24 * (1 + user_id % 61)))), '%Y-%m-%d %H:%M:%S') AS action_time,
         CASE WHEN event_type = 'view' THEN 'kw' || (k % 10) END AS search_keyword,
         CASE WHEN event_type = 'click' THEN k % 20 END AS click_category_id,
         CASE WHEN event_type = 'click' THEN k END AS click_product_id,
         CASE WHEN event_type = 'signup' THEN (k % 20) || ',' || ((k + 7) % 20) END AS order_category_ids,
         CASE WHEN event_type = 'signup' THEN k || ',' || ((k + 7) % 100) END AS order_product_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k % 20 AS VARCHAR) END AS pay_category_ids,
         CASE WHEN event_type = 'purchase' THEN CAST(k AS VARCHAR) END AS pay_product_ids,
         event_id % 10 AS city_id,
         event_id AS action_id
  FROM uva_e),
user_info AS (
  SELECT c_custkey AS user_id, 'user' || c_custkey AS username, c_name AS name,
         CAST(c_custkey % 60 AS INTEGER) AS age, c_mktsegment AS professional,
         'city' || c_nationkey AS city,
         CASE WHEN c_custkey % 2 = 0 THEN 'male' ELSE 'female' END AS sex
  FROM customer),
product_info AS (
  SELECT p_partkey AS product_id, p_name AS product_name,
         '{{"product_status": ' || (p_size % 2) || '}}' AS extend_info
  FROM part),
city_info AS (
  SELECT * FROM (VALUES {_CITY_VALUES}) AS t(city_id, city_name, area)),
ad_clicks AS (
  SELECT CAST(ts AS TIMESTAMP) AS ts,
         [{_PROVINCES}][user_id % 10 + 1] AS province,
         [{_CITIES}][user_id % 10 + 1] AS city,
         user_id,
         (event_id // 7) % 5 AS ad_id
  FROM events)
"""


def with_prelude(body: str, extra_ctes: str = "") -> str:
    """Prefix ``body`` (a SELECT) with the fixture CTEs and optional extra CTEs."""
    ctes = PRELUDE.strip()
    if extra_ctes.strip():
        ctes += ",\n" + extra_ctes.strip().rstrip(",")
    return f"WITH {ctes}\n{body.strip()}"
