"""Global row numbers across partitions; the one-pass draw against a plain version."""

import hashlib
import random

from conftest import SF001, rows
from pyspark.sql import functions as F
from visitlens.operators import categories as cat, extract, sessions as ses
from visitlens.operators.ranking import global_row_number
from visitlens.sources import fixtures as fx


def test_row_numbers_over_many_partitions_with_ties(spark):
    rng = random.Random(1)
    data = [(i, rng.choice([0, 0, 0, 1, 5, None]), rng.choice("ab")) for i in range(3000)]  # most rows share one value
    df = spark.createDataFrame(data, "id long, n int, g string").repartition(7)
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for parts in ("1", "5", "40"):
            spark.conf.set("spark.sql.shuffle.partitions", parts)
            out = global_row_number(df, [F.col("n").desc(), F.col("g").asc(), F.col("id").asc()])
            want = sorted(data, key=lambda r: (-(-1 if r[1] is None else r[1]), r[2], r[0]))
            assert sorted((r["rank"], r.id) for r in out.collect()) == [(k, r[0]) for k, r in enumerate(want, 1)]
            assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
        # ties get numbers of their own
        tied = global_row_number(df, [F.col("g").asc()], "place").collect()
        assert sorted(r.place for r in tied) == list(range(1, 3001))
        assert max(r.place for r in tied if r.g == "a") < min(r.place for r in tied if r.g == "b")
        assert global_row_number(df.limit(0), [F.col("id").asc()]).collect() == []
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_category_rank_has_no_global_window(spark):
    out = cat.category_ranked(fx.user_visit_action(spark, SF001))
    assert "Window" not in out._jdf.queryExecution().executedPlan().toString()
    assert [r["rank"] for r in out.orderBy("rank").collect()] == list(range(1, out.count() + 1))


def plain_draw(sessions, total, seed):
    hours = {}
    for r in sessions:
        hours.setdefault((r.start_ts.date(), r.start_ts.hour), []).append(r.session_id)
    days = {d for d, _ in hours}
    picked = []
    for (d, _), ids in hours.items():
        of_day = sum(len(x) for (e, _), x in hours.items() if e == d)
        quota = min(len(ids) * (total // len(days)) // of_day, len(ids))
        picked += sorted(ids, key=lambda i: (hashlib.md5((i + seed).encode()).hexdigest(), i))[:quota]
    return sorted(picked)


def test_draw_reads_sessions_once(spark, monkeypatch):
    sessions = ses.session_rollup(fx.user_visit_action(spark, SF001))
    raw = sessions.collect()
    for total, salts in ((100, 64), (3000, 64), (300, 1), (90, 3), (0, 64)):
        monkeypatch.setattr(extract, "SALTS", salts)
        out = extract.random_extract(sessions, total, "42")
        assert [r.session_id for r in out.orderBy("session_id").collect()] == plain_draw(raw, total, "42")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "FileScan" not in plan and "parquet" not in plan.lower()  # all comes from the one checkpointed pass
    assert rows(extract.quota_of_hours(extract.hour_samples(sessions, 90, "42").where("rn = 1").groupBy("date", "hour")
                                       .agg(F.sum("n").alias("session_count")), 90)) == rows(extract.extract_quota(sessions, 90))
