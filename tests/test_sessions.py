from pyspark.sql import functions as F

from visitlens.operators import extract, sessions as ses
from visitlens.plans.params import TaskParams, task_by_id, task_params
from visitlens.sources import fixtures as fx

ACTION_SCHEMA = ("session_date string, user_id long, session_id string, page_id long, action_time string, "
                 "search_keyword string, click_category_id long, click_product_id long, "
                 "order_category_ids string, order_product_ids string, pay_category_ids string, "
                 "pay_product_ids string, city_id long, action_id long")


def action(sid, uid, t, kw=None, cat=None, page=1, aid=0, order=None, pay=None):
    return ("2024-01-08", uid, sid, page, t, kw, cat, cat, order, order, pay, pay, 0, aid)


def edge_actions(spark):
    data = [
        # unpadded hour, keyword that is a substring of another, category 1 beside 12
        action("a", 1, "2024-01-08 5:00:00", kw="kw1", aid=1),
        action("a", 1, "2024-01-08 05:00:09", kw="kw10", aid=2),
        action("a", 1, "2024-01-08 10:00:00", cat=12, aid=3),
        action("a", 1, "2024-01-08 10:00:01", cat=1, aid=4),
        action("a", 1, "2024-01-08 10:00:02", kw="", aid=5),
        # one action: 0 s visit
        action("b", 2, "2024-01-08 07:00:00", aid=6),
        # unknown user
        action("c", 99, "2024-01-08 07:00:00", kw="kw1", aid=7),
        # null click category, no keyword
        action("d", 3, "2024-01-08 08:00:00", aid=8),
        action("d", 3, "2024-01-08 08:00:02", aid=9),
    ]
    return spark.createDataFrame(data, ACTION_SCHEMA)


def users(spark):
    return spark.createDataFrame([(1, 20, "p1", "c1", "male"), (2, None, "p2", "c2", "female"),
                                  (3, 40, "p1", "c1", "female")],
                                 "user_id long, age int, professional string, city string, sex string")


def test_rollup_edges(spark):
    s = ses.session_rollup(edge_actions(spark))
    got = {r["session_id"]: r for r in s.collect()}
    assert got["a"]["search_keywords"] == "kw1,kw10"
    assert got["a"]["click_category_ids"] == "1,12"
    assert got["a"]["visit_length"] == 5 * 3600 + 2 and got["a"]["step_length"] == 5
    assert got["a"]["start_time"] == "2024-01-08 05:00:00"
    assert got["b"]["visit_length"] == 0 and got["b"]["search_keywords"] is None
    assert got["d"]["click_category_ids"] is None


def test_join_and_filters(spark):
    su = ses.session_user_join(ses.session_rollup(edge_actions(spark)), users(spark))
    assert sorted(r["session_id"] for r in su.collect()) == ["a", "b", "d"]  # unknown user vanishes

    def kept(params):
        return sorted(r["session_id"] for r in ses.filter_sessions(su, params).collect())

    assert kept(TaskParams(start_age=10, end_age=30)) == ["a"]            # null age fails
    assert kept(TaskParams(start_age=10)) == ["a", "b", "d"]               # one bound only: no constraint
    assert kept(TaskParams(keywords=["kw1"])) == ["a"]                     # no keyword fails
    assert kept(TaskParams(keywords=["kw"])) == []                         # exact element, not substring
    assert kept(TaskParams(category_ids=["1"])) == ["a"]
    assert kept(TaskParams(sex=["female"], professionals=["p1"])) == ["d"]
    assert kept(TaskParams()) == ["a", "b", "d"]
    eq = su.where(ses.value_equals("city", "c2"))
    assert [r["session_id"] for r in eq.collect()] == ["b"]


def test_detail_and_stats(spark):
    acts = edge_actions(spark)
    su = ses.session_user_join(ses.session_rollup(acts), users(spark))
    sel = ses.filter_sessions(su, TaskParams(sex=["female"]))
    assert sorted(r["action_id"] for r in ses.session_detail(acts, sel).collect()) == [6, 8, 9]
    stat = ses.session_aggr_stat(su).first()
    assert stat["session_count"] == 3
    assert stat["visit_1s_3s"] == 0.33 and stat["visit_3m_10m"] == 0.0 and stat["visit_30m"] == 0.33
    assert stat["step_1_3"] == 0.67 and stat["step_4_6"] == 0.33
    empty = ses.session_aggr_stat(su.where(F.lit(False))).first()
    assert empty["session_count"] == 0 and empty["visit_1s_3s"] is None


def test_histogram_invariant_on_fixture(spark):
    s = ses.session_rollup(fx.user_visit_action(spark, "/root/testdata/sf0.001"))
    total = s.count()
    zero = s.where(F.col("visit_length") == 0).count()
    hist = sum(r["session_count"] for r in ses.visit_length_histogram(s).collect())
    assert hist + zero == total
    assert sum(r["session_count"] for r in ses.step_length_histogram(s).collect()) == total


def test_random_extract_quota_invariants(spark):
    acts = ses.scan_actions_by_date(fx.user_visit_action(spark, "/root/testdata/sf0.01"), "2024-01-08", "2024-01-08")
    s = ses.session_rollup(acts)
    quota = {(r["date"], r["hour"]): r["hour_quota"] for r in extract.extract_quota(s, 100).collect()}
    picked = extract.random_extract(s, 100, "42")
    per_hour = {}
    for r in picked.join(s.select("session_id", F.hour("start_ts").alias("hour")), "session_id").collect():
        per_hour[r["hour"]] = per_hour.get(r["hour"], 0) + 1
    for (d, h), q in quota.items():
        assert per_hour.get(h, 0) == q
    ids = [r["session_id"] for r in picked.collect()]
    assert len(ids) == len(set(ids)) == sum(quota.values())
    # deterministic: same seed, same sample
    assert sorted(ids) == sorted(r["session_id"] for r in extract.random_extract(s, 100, "42").collect())


def test_task_params(spark):
    p = TaskParams.from_json('{"startAge":["10"],"endAge":["40"],"keywords":["kw1,kw2"],"targetPageFlow":["1,2,3"]}')
    assert (p.start_age, p.end_age, p.keywords, p.target_page_flow, p.sex) == (10, 40, ["kw1", "kw2"], ["1", "2", "3"], None)
    tasks = fx.task_table(spark)
    got = {r["task_id"]: r for r in task_params(tasks).collect()}
    assert got[1]["start_age"] == 0 and got[1]["end_age"] == 100 and got[1]["keywords"] is None
    assert got[3]["target_page_flow"] == [str(i) for i in range(1, 10)]
    assert task_by_id(tasks, 4).start_date == "2024-01-16"
    try:
        task_by_id(tasks, 77)
        raise AssertionError("expected KeyError")
    except KeyError:
        pass
