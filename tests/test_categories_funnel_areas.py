from pyspark.sql import functions as F

from conftest import SF001, rows
from test_sessions import ACTION_SCHEMA, action
from visitlens.operators import areas, categories as cat, funnel
from visitlens.sources import fixtures as fx


def test_category_counts_with_empty_elements(spark):
    acts = spark.createDataFrame([
        action("a", 1, "2024-01-08 01:00:00", cat=1, aid=1),
        action("a", 1, "2024-01-08 01:00:01", cat=12, aid=2),
        action("a", 1, "2024-01-08 01:00:02", order="1,,12,x", aid=3),
        action("b", 2, "2024-01-08 01:00:03", pay="", aid=4),
        action("b", 2, "2024-01-08 01:00:04", pay="12", aid=5),
    ], ACTION_SCHEMA)
    assert rows(cat.category_counts(acts)) == [(1, 1, 1, 0), (12, 1, 1, 1)]
    assert rows(cat.category_visited(acts)) == [(1,), (12,)]
    # join form (distinct categories, three left joins, null -> 0) gives the same rows
    visited = cat.category_visited(acts)
    joined = (visited.join(cat.category_click_counts(acts), "category_id", "left")
              .join(cat.category_order_counts(acts), "category_id", "left")
              .join(cat.category_pay_counts(acts), "category_id", "left").na.fill(0))
    assert rows(joined, "category_id", "click_count", "order_count", "pay_count") == rows(cat.category_counts(acts))


def test_top_categories_ties_and_duplicated_detail(spark):
    data = []
    aid = 0
    # 12 categories, each clicked exactly once by session s0 and once by its own session:
    # all tie on counts, so the id decides rank; s0 is top in every category
    for c in range(12):
        for sid in ("s0", f"x{c}"):
            aid += 1
            data.append(action(sid, 1, "2024-01-08 01:00:00", cat=c, aid=aid))
    acts = spark.createDataFrame(data, ACTION_SCHEMA)
    top = [r["category_id"] for r in cat.top_categories(acts, 10).collect()]
    assert top == list(range(10))
    ranked = {r["category_id"]: r["rank"] for r in cat.category_ranked(acts).collect()}
    assert ranked[0] == 1 and ranked[11] == 12
    ts = cat.top_sessions_per_category(acts, 10, 1)
    assert rows(ts, "category_id", "session_id") == sorted(((c, "s0") for c in range(10)), key=repr)
    detail = cat.top_session_detail(acts, 10, 1)
    # s0 has 12 actions and ranks in 10 categories: 120 detail rows, duplicates kept
    assert detail.count() == 120
    assert cat.top_session_detail(acts, 10, 1, distinct=True).count() == 12


def _flow_actions(spark, pages):
    return spark.createDataFrame(
        [action("s", 1, f"2024-01-08 01:00:{i:02d}", page=p, aid=i) for i, p in enumerate(pages)], ACTION_SCHEMA)


def test_funnel_missing_and_repeated_split(spark):
    acts = _flow_actions(spark, [1, 2, 3, 1, 2, 5])
    rates = {r["split"]: (r["pv"], r["prev_pv"], r["convert_rate"])
             for r in funnel.page_convert_rate(acts, ["1", "2", "3", "4"]).collect()}
    assert rates == {"1_2": (2, 2, 1.0), "2_3": (1, 2, 0.5), "3_4": (0, 1, 0.0)}
    rep = funnel.page_split_pv(funnel.page_transitions(acts), ["1", "2", "1", "2"])
    assert rows(rep) == [(1, "1_2", 2), (2, "2_1", 0), (3, "1_2", 2)]
    assert funnel.page_convert_rate(acts, ["1"]).count() == 0
    s = funnel.page_convert_rate_string(funnel.page_convert_rate(acts, ["1", "2", "3"])).first()
    assert s["convert_rate"] == "1_2=1.0|2_3=0.5"


def test_skew_safe_transitions_equal_plain(spark):
    # one huge session spread over every range partition, plus the fixture's sessions
    big = _flow_actions(spark, [(i * 7) % 9 + 1 for i in range(60)])
    for acts in (big, fx.user_visit_action(spark, SF001)):
        plain = rows(funnel.page_transitions(acts))
        for seconds in (1, 7, 10 ** 9):      # a piece for every second / one for the whole session
            assert plain == rows(funnel.page_transitions(acts, seconds)) and len(plain) > 0
        assert plain == rows(funnel.page_transitions_skew_safe(acts))


def test_area_top_products(spark):
    clicks = spark.createDataFrame(
        [(0, 10), (0, 10), (1, 10), (0, 11), (1, 11), (2, 12), (2, 12), (3, 13), (42, 10)],
        "city_id long, product_id long")
    products = spark.createDataFrame(
        [(10, "p10", '{"product_status": 0}'), (11, "p11", '{"product_status": 1}'),
         (12, "p12", "{}"), (13, "p13", '{"product_status": 0}')],
        "product_id long, product_name string, extend_info string")
    basic = areas.area_click_basic(clicks, fx.city_info(spark))
    assert basic.count() == 8                            # city 42 is not in city_info
    apc = areas.area_product_clicks(basic)
    infos = {(r["area"], r["product_id"]): (r["click_count"], r["city_infos"]) for r in apc.collect()}
    assert infos[("华北", 10)] == (2, "0:北京")
    assert infos[("华东", 12)] == (2, "2:南京")
    full = areas.area_product_full(apc, products)
    status = {r["product_id"]: r["product_status"] for r in full.collect()}
    assert status == {10: "self", 11: "third party", 12: "third party", 13: "self"}
    top = areas.area_top_products(full, 1)
    got = {r["area"]: (r["product_id"], r["area_level"]) for r in top.collect()}
    # 华东: products 10, 11, 12 with 1, 1, 2 clicks -> 12; 华北: 10 (2) over 11 (1)
    assert got["华东"] == (12, "A level") and got["华北"] == (10, "A level") and got["华南"] == (13, "B level")
    lv = spark.createDataFrame([("东北",), ("西南",), ("x",)], "area string")
    assert rows(lv.select(areas.area_level(F.col("area")))) == [("C level",), ("D level",), ("D level",)]


def test_topk_groups_never_exceed_k(spark):
    from conftest import SF01
    from visitlens.operators import ads, sessions as ses

    acts = fx.user_visit_action(spark, SF01)
    full = areas.area_product_full(areas.area_product_clicks(
        areas.area_click_basic(ses.scan_click_actions(acts, None, None), fx.city_info(spark))),
        fx.product_info(spark, SF01))
    assert areas.area_top_products(full, 3).groupBy("area").count().where("count > 3").count() == 0
    ts = cat.top_sessions_per_category(acts, 10, 10)
    assert ts.select("category_id").distinct().count() == 10
    assert ts.groupBy("category_id").count().where("count > 10").count() == 0
    top3 = ads.province_top_ads(ads.ad_stat(fx.ad_clicks(spark, SF01)), 3)
    assert top3.groupBy("date", "province").count().where("count > 3").count() == 0
    assert cat.top_categories(acts, 10).count() == 10
