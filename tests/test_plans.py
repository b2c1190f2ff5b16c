"""Plan-shape checks: the properties the scale design relies on."""

import tempfile

from conftest import SF001
from visitlens.operators import ads, areas, categories as cat, extract, sessions as ses
from visitlens.sources import fixtures as fx


def plan(df):
    """Final adaptive plan: the DataFrame's own query execution is run (test-sized data)."""
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


def test_date_scan_prunes_partitions(spark):
    path = tempfile.mkdtemp(prefix="vl-uva-") + "/user_visit_action"
    fx.user_visit_action(spark, SF001).write.partitionBy("session_date").parquet(path)
    stored = spark.read.parquet(path)
    df = ses.scan_click_actions(stored, "2024-01-08", "2024-01-09")
    p = df._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(session_date" in p and "2024-01-08" in p
    assert "PushedFilters: [IsNotNull(click_product_id)]" in p
    # only the two columns the projection needs are read
    assert "ReadSchema: struct<click_product_id:bigint,city_id:bigint>" in p


def test_topk_plans_limit_before_shuffle(spark):
    acts = fx.user_visit_action(spark, SF001)
    p = plan(cat.top_sessions_per_category(acts, 10, 10))
    assert "WindowGroupLimit" in p and "Partial" in p
    assert "TakeOrderedAndProject(limit=10" in p
    full = areas.area_product_full(areas.area_product_clicks(
        areas.area_click_basic(ses.scan_click_actions(acts, None, None), fx.city_info(spark))),
        fx.product_info(spark, SF001))
    assert "WindowGroupLimit" in plan(areas.area_top_products(full, 3))
    s = ses.session_rollup(acts)
    assert "salt" in plan(extract.random_extract(s, 3000, "42"))  # cut within (hour, salt) first
    stat = ads.ad_stat(fx.ad_clicks(spark, SF001))
    assert "WindowGroupLimit" in plan(ads.province_top_ads(stat, 3))


def test_rollup_is_partially_aggregated(spark):
    p = plan(ses.session_rollup(fx.user_visit_action(spark, SF001)))
    assert "partial_min" in p and "partial_collect_set" in p
    p = plan(cat.category_counts(fx.user_visit_action(spark, SF001)))
    assert "partial_count" in p


def test_broadcast_only_after_size_check(spark):
    from visitlens.operators.joins import broadcast_if_small
    big = spark.range(50).withColumnRenamed("id", "k")
    small = spark.range(5).withColumnRenamed("id", "k")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        hinted = big.join(broadcast_if_small(small, max_rows=10), "k")
        assert "BroadcastHashJoin" in plan(hinted)
        unhinted = big.join(broadcast_if_small(big.select("k"), max_rows=10), "k")
        assert "BroadcastHashJoin" not in plan(unhinted)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_hot_session_join_is_split_by_aqe(spark):
    """A session holding most rows, below the salting threshold: both join sides are
    shuffle stages (the salted join re-shuffles the session side), so AQE's skew handling
    splits the hot partition across tasks (broadcast disabled to force a shuffle)."""
    from pyspark.sql import functions as F
    from test_sessions import ACTION_SCHEMA, action

    rows = [action("hot", 1, "2024-01-08 01:00:00", aid=i) for i in range(20000)]
    rows += [action(f"s{j}", 2, "2024-01-08 01:00:00", aid=100000 + j) for j in range(400)]
    acts = spark.createDataFrame(rows, ACTION_SCHEMA).repartition(8)
    sessions = ses.session_rollup(acts)
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "1k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        detail = ses.session_detail(acts, sessions.where(F.col("step_length") > 0))
        p = plan(detail)
        assert "SortMergeJoin(skew=true)" in p and "AQEShuffleRead skewed" in p
        assert detail.count() == 20400
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_salted_join_equals_plain_join_and_spreads_hot_key(spark):
    from pyspark.sql import functions as F
    from visitlens.operators.joins import salted_join

    big = spark.createDataFrame([("hot", i) for i in range(3000)] + [(f"k{j}", j) for j in range(200)]
                                + [("absent", 1)], "k string, v long")
    small = spark.createDataFrame([("hot", "H")] + [(f"k{j}", f"s{j}") for j in range(0, 200, 2)],
                                  "k string, tag string")
    hot = spark.createDataFrame([("hot",)], "k string")
    for how in ("inner", "left", "left_semi", "left_anti"):
        want = sorted(map(tuple, big.join(small, "k", how).collect()), key=repr)
        got = sorted(map(tuple, salted_join(big, small, "k", hot, how, salts=8).collect()), key=repr)
        assert got == want, how
    # shuffle path (a broadcast join would leave rows where they are, which is fine too)
    conf = {"spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        joined = salted_join(big, small, "k", hot, "inner", salts=8)
        tasks = joined.where("k = 'hot'").select(F.spark_partition_id().alias("p")).distinct().count()
        assert tasks >= 3
    finally:
        for k in conf:
            spark.conf.unset(k)


def test_hot_session_detail_and_blacklist_use_salting(spark):
    from test_sessions import ACTION_SCHEMA, action
    from visitlens.operators import ads

    rows = [action("hot", 1, "2024-01-08 01:00:00", aid=i) for i in range(3000)]
    rows += [action(f"s{j}", 2, "2024-01-08 01:00:00", aid=100000 + j) for j in range(50)]
    acts = spark.createDataFrame(rows, ACTION_SCHEMA)
    sessions = ses.session_rollup(acts)
    assert ses.session_detail(acts, sessions, hot_session_rows=100).count() == 3050
    assert ses.session_detail(acts, sessions.where("session_id = 'hot'"), hot_session_rows=100).count() == 3000
    clicks = fx.ad_clicks(spark, SF001)
    assert sorted(map(tuple, ads.blacklist_filter(clicks, 3, hot_user_rows=10).collect())) == \
        sorted(map(tuple, ads.blacklist_filter(clicks, 3).collect()))
