"""Stored actions: no shuffle on the session; sessions with very many distinct values."""

import tempfile
import uuid

import pytest
from conftest import SF001, rows
from pyspark.sql import functions as F
from test_sessions import ACTION_SCHEMA, action
from visitlens.operators import sessions as ses
from visitlens.sources import fixtures as fx
from visitlens.sources.layout import store_actions, stored_session_detail, stored_sessions


@pytest.fixture
def stored(spark):
    name = f"uva_{uuid.uuid4().hex}"
    store_actions(fx.user_visit_action(spark, SF001), name, 4, tempfile.mkdtemp(prefix="vl-lay-") + "/t")
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield name
    for k, v in old.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)
    spark.sql(f"DROP TABLE {name}")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_shuffle_on_session_and_dates_are_pruned(spark, stored):
    dates = ("2024-01-08", "2024-01-20")
    sessions = stored_sessions(spark, stored, *dates)
    p = plan(sessions)
    assert "Exchange" not in p and "PartitionFilters: [isnotnull(session_date" in p and "Bucketed: true" in p
    chosen = sessions.where("step_length > 1")
    detail = stored_session_detail(spark, stored, chosen, *dates, hot_session_rows=10**9)
    p = plan(detail)
    assert "Exchange" not in p and "SortMergeJoin" in p
    acts = ses.scan_actions_by_date(fx.user_visit_action(spark, SF001), *dates)
    want = ses.session_rollup(acts)
    assert rows(sessions) == rows(want)
    want = ses.session_detail(acts, want.where("step_length > 1"))
    assert rows(detail, *want.columns) == rows(want)
    # a session above the limit: salted, same rows
    hot = stored_session_detail(spark, stored, chosen, *dates, hot_session_rows=2)
    assert "Exchange" in plan(hot) and rows(hot, *want.columns) == rows(want)


def test_dates_are_appended_one_file_per_bucket(spark):
    name, path = f"uva_{uuid.uuid4().hex}", tempfile.mkdtemp(prefix="vl-lay-") + "/t"
    acts = fx.user_visit_action(spark, SF001)
    for d in ("2024-01-08", "2024-01-09"):
        store_actions(acts.where(F.col("session_date") == d), name, 4, path)
    assert rows(spark.table(name), *acts.columns) == rows(acts.where("session_date in ('2024-01-08', '2024-01-09')"))
    files = spark.table(name).select("session_date", F.input_file_name().alias("f")).distinct().groupBy("session_date").count().collect()
    assert all(r["count"] <= 4 for r in files)
    spark.sql(f"DROP TABLE {name}")


def test_two_level_equals_one_level(spark):
    acts = fx.user_visit_action(spark, SF001).unionByName(spark.createDataFrame(
        [action("odd", 1, "2024-01-08 1:00:00", aid=1), action("odd", 1, "bad", aid=2)], ACTION_SCHEMA), allowMissingColumns=True)
    one = ses.session_rollup(acts)
    two, overflow = ses.session_rollup_two_level(acts)
    assert rows(two.select(*one.columns)) == rows(one) and overflow.count() == 0
    two, overflow = ses.session_rollup_two_level(acts, max_values=2)
    flat = two.select("session_id", F.explode("keywords").alias("value")).unionByName(
        overflow.where("kind = 'keyword'").select("session_id", "value"))
    assert rows(flat) == rows(one.select("session_id", F.explode("keywords").alias("value")))
    for kind, column, values in (("keyword", "keywords", ["kw1", "kw2"]), ("category", "categories", ["3", "4", "x"])):
        want = one.where(ses.array_overlaps(column, values))
        assert rows(ses.sessions_with_values(two, overflow, kind, values), "session_id") == rows(want, "session_id")
    assert overflow.count() > 0 and two.where("n_keywords > 2 and keywords is not null").count() == 0


def test_session_of_a_million_keywords(spark):
    n = 1_000_000
    acts = spark.range(n + 2000).select(
        F.when(F.col("id") < n, F.lit("huge")).otherwise(F.concat(F.lit("s"), F.col("id") % 50)).alias("session_id"),
        F.lit(1).cast("long").alias("user_id"), F.lit("2024-01-08 01:00:00").alias("action_time"),
        F.concat(F.lit("kw"), F.col("id")).alias("search_keyword"), (F.col("id") % 7).alias("click_category_id"))
    sessions, overflow = ses.session_rollup_two_level(acts)
    by = {r.session_id: r for r in sessions.collect()}
    assert by["huge"].n_keywords == n and by["huge"].keywords is None and by["huge"].step_length == n
    assert by["huge"].categories == list(range(7)) and len(by["s0"].keywords) == 40 and len(by) == 51
    assert overflow.count() == n and overflow.select("value").distinct().count() == n
    hit = ses.sessions_with_values(sessions, overflow, "keyword", ["kw999999", f"kw{n}"])
    assert rows(hit, "session_id") == sorted([("huge",), (f"s{n % 50}",)])
