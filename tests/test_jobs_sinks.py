import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF001, rows
from visitlens.operators import ads, funnel, sessions as ses
from visitlens.plans import jobs
from visitlens.plans.params import TaskParams
from visitlens.sources import fixtures as fx, sinks


def test_session_job_and_sinks(spark):
    acts, users = fx.user_visit_action(spark, SF001), fx.user_info(spark, SF001)
    params = TaskParams(start_date="2024-01-01", end_date="2024-01-31", start_age=0, end_age=100)
    res = jobs.run_session_job(acts, users, params, task_id=1, materialize="checkpoint")
    out = tempfile.mkdtemp(prefix="vl-job-")
    for name, df in jobs.tables(res).items():
        sinks.append(df, os.path.join(out, name))
    jobs.release(res)
    stat = spark.read.parquet(os.path.join(out, "session_aggr_stat")).first()
    assert stat["task_id"] == 1 and stat["session_count"] == ses.session_rollup(acts).count()
    # the stored tables' columns, in order
    assert list(stat.asDict()) == ["task_id", "session_count", "1s_3s", "4s_6s", "7s_9s", "10s_30s", "30s_60s", "1m_3m", "3m_10m",
                                   "10m_30m", "30m", "1_3", "4_6", "7_9", "10_30", "30_60", "60"]
    kept = spark.read.parquet(os.path.join(out, "session_detail"))
    assert kept.columns == ["task_id", "user_id", "session_id", "page_id", "action_time", "search_keyword", "click_category_id",
                            "click_product_id", "order_category_ids", "order_product_ids", "pay_category_ids", "pay_product_ids"]
    assert kept.count() >= spark.read.parquet(os.path.join(out, "top10_session_detail")).count()
    top = spark.read.parquet(os.path.join(out, "top10_category"))
    assert top.count() == 10 and rows(top.select("task_id").distinct()) == [(1,)]
    detail = spark.read.parquet(os.path.join(out, "top10_session_detail"))
    top_sess = spark.read.parquet(os.path.join(out, "top10_category_session"))
    assert detail.select("session_id").distinct().count() == top_sess.select("session_id").distinct().count()
    sinks.truncate(spark, os.path.join(out, "top10_category"), "task_id int, category_id long")
    assert spark.read.parquet(os.path.join(out, "top10_category")).count() == 0


def test_funnel_and_area_jobs(spark):
    acts = fx.user_visit_action(spark, SF001)
    p = TaskParams(start_date="2024-01-01", end_date="2024-01-31", target_page_flow=["1", "2", "3"])
    res = jobs.run_funnel_job(acts, p, task_id=3)
    s = res["page_split_convert_rate"].first()
    assert s["task_id"] == 3 and s["convert_rate"].startswith("1_2=")
    area = jobs.run_area_job(acts, fx.city_info(spark), fx.product_info(spark, SF001), p, task_id=2)
    top = area["area_top3_product"]
    assert top.groupBy("area").count().where(F.col("count") > 3).count() == 0
    expected = funnel.page_convert_rate(acts, ["1", "2", "3"])
    assert rows(res["page_convert_rate"].drop("task_id")) == rows(expected)


def test_versioned_table_upserts_are_replay_safe(spark):
    path = tempfile.mkdtemp(prefix="vl-vt-") + "/ad_user_click_count"
    t = sinks.VersionedTable(spark, path, "date string, user_id long, ad_id long, click_count long")
    clicks = fx.ad_clicks(spark, SF001)
    days = sorted(r[0] for r in clicks.select(ads.day(F.col("ts"))).distinct().collect())[:4]
    for v, d in enumerate(days):
        batch = ads.user_daily_clicks(clicks.where(ads.day(F.col("ts")) == d))
        t.upsert_add(batch, ["date", "user_id", "ad_id"], ["click_count"], version=v)
        if v == 2:   # replay of version 2
            t.upsert_add(batch, ["date", "user_id", "ad_id"], ["click_count"], version=v)
    want = ads.user_daily_clicks(clicks.where(ads.day(F.col("ts")).isin(days)))
    assert rows(t.current()) == rows(want.select("date", "user_id", "ad_id", "click_count"))
    assert t.latest_version() == 3
    t.upsert_overwrite(want.withColumn("click_count", F.lit(1).cast("long")), ["date", "user_id", "ad_id"], 4)
    assert {r["click_count"] for r in t.current().collect()} == {1}
    top = sinks.VersionedTable(spark, path + "_top", "date string, province string, ad_id long, click_count long")
    stat = ads.ad_stat(clicks)
    top.commit(ads.province_top_ads(stat), 0)
    newer = ads.province_top_ads(stat).where(F.col("date") == "20240102").withColumn("click_count", F.lit(0).cast("long"))
    top.replace_groups(newer, ["date", "province"], 1)
    cur = top.current()
    assert cur.where("date = '20240102'").agg(F.sum("click_count")).first()[0] == 0
    assert cur.count() == ads.province_top_ads(stat).count()


def test_cluster_settings():
    from visitlens.session import cluster_settings
    big = cluster_settings(100 << 40, executor_cores=8, executors=1000)
    assert big["spark.sql.shuffle.partitions"] == "200000"
    small = cluster_settings(10 << 30, executor_cores=8, executors=10)
    assert small["spark.sql.shuffle.partitions"] == "160"          # two waves of 80 slots
    assert small["spark.sql.adaptive.enabled"] == "true"


def test_cli_runs_jobs_from_task_table(spark):
    from visitlens.plans import cli

    base = tempfile.mkdtemp(prefix="vl-cli-")
    inp = {name: os.path.join(base, name) for name in ("actions", "users", "products", "cities")}
    fx.user_visit_action(spark, SF001).write.parquet(inp["actions"])
    fx.user_info(spark, SF001).write.parquet(inp["users"])
    fx.product_info(spark, SF001).write.parquet(inp["products"])
    fx.city_info(spark).write.parquet(inp["cities"])
    tasks = os.path.join(base, "tasks.json")
    fx.task_table(spark).coalesce(1).write.json(tasks)
    out = os.path.join(base, "out")
    cli.main(["session", "--task-id", "1", "--tasks", tasks + "/", "--actions", inp["actions"],
              "--users", inp["users"], "--out", out], spark=spark)
    stat = spark.read.parquet(os.path.join(out, "session_aggr_stat")).first()
    assert stat["task_id"] == 1 and stat["session_count"] > 0
    cli.main(["funnel", "--task-id", "3", "--params", '{"targetPageFlow": ["1,2,3"]}',
              "--actions", inp["actions"], "--out", out], spark=spark)
    assert spark.read.parquet(os.path.join(out, "page_split_convert_rate")).first()["task_id"] == 3
    cli.main(["area", "--task-id", "4", "--tasks", tasks + "/", "--actions", inp["actions"],
              "--cities", inp["cities"], "--products", inp["products"], "--out", out], spark=spark)
    assert spark.read.parquet(os.path.join(out, "area_top3_product")).count() >= 0


def test_empty_task_parameters_mean_no_constraint(spark):
    from visitlens.plans.params import TaskParams, task_params

    text = '{"keywords":[""],"startAge":[""],"endAge":[],"cities":["a,b,,"],"sex":[","],"categoryIds":["1,,2"]}'
    wanted = (None, None, None, ["a", "b"], None, ["1", "", "2"])
    p = TaskParams.from_json(text)
    assert (p.keywords, p.start_age, p.end_age, p.cities, p.sex, p.category_ids) == wanted
    r = task_params(spark.createDataFrame([(1, text)], "task_id int, task_param string")).first()
    assert (r.keywords, r.start_age, r.end_age, r.cities, r.sex, r.category_ids) == wanted
