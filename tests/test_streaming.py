import os
import tempfile

from pyspark.sql import functions as F

from conftest import SF001, rows
from visitlens.operators import ads
from visitlens.sources import fixtures as fx
from visitlens.streaming import AdClickStreamJob, click_trend_updates, running_ad_stat, text_lines

THRESHOLD = 3
DAYS_PER_FILE = 3


def batch_of(ts):
    """Batch id of the file a click lands in: three consecutive days per file."""
    return F.floor((F.dayofyear(ts) - 1) / DAYS_PER_FILE)


def write_day_files(spark, directory, days=None):
    """One text file of ad lines per three-day group (oldest first, increasing mtimes)."""
    ts = F.timestamp_millis(F.split("value", " ")[0].cast("bigint"))
    lines = fx.ad_log_lines(spark, SF001).withColumn("day", F.format_string("%03d", batch_of(ts).cast("int")))
    by_day = {}
    for r in lines.collect():
        by_day.setdefault(r["day"], []).append(r["value"])
    chosen = sorted(by_day) if days is None else [d for d in sorted(by_day) if d in days]
    os.makedirs(directory, exist_ok=True)
    for i, d in enumerate(chosen):
        p = os.path.join(directory, f"clicks-{d}.txt")
        with open(p, "w") as f:
            f.write("\n".join(by_day[d]) + "\n")
        os.utime(p, (1_700_000_000 + i, 1_700_000_000 + i))
    return sorted(by_day)


def run(spark, job, src, ckpt):
    q = job.start(text_lines(spark, src, max_files_per_trigger=1), ckpt, {"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None


def expected(spark):
    clicks = fx.ad_clicks(spark, SF001)
    kept = ads.blacklist_filter(clicks, THRESHOLD, batch_of(F.col("ts")))
    return clicks, kept


def check_against_batch(spark, job):
    clicks, kept = expected(spark)
    assert rows(job.blacklist()) == rows(ads.blacklist_users(clicks, THRESHOLD, batch_of(F.col("ts"))))
    assert rows(job.user_clicks(), "date", "user_id", "ad_id", "click_count") == \
        rows(ads.user_daily_clicks(kept), "date", "user_id", "ad_id", "click_count")
    assert rows(job.ad_stat(), "date", "province", "city", "ad_id", "click_count") == \
        rows(ads.ad_stat(kept), "date", "province", "city", "ad_id", "click_count")
    assert rows(job.province_top(), "date", "province", "ad_id", "click_count") == \
        rows(ads.province_top_ads(ads.ad_stat(kept), 3), "date", "province", "ad_id", "click_count")
    assert rows(job.click_trend()) == rows(ads.click_trend(kept).select(*job.click_trend().columns))


def test_stream_job_equals_batch_form(spark):
    base = tempfile.mkdtemp(prefix="vl-stream-")
    src = os.path.join(base, "in")
    write_day_files(spark, src)
    job = AdClickStreamJob(spark, os.path.join(base, "tables"), threshold=THRESHOLD, compact_every=3)
    run(spark, job, src, os.path.join(base, "ckpt"))
    assert job.blacklist().count() > 0
    # ten batches, folded into the base tables after batches 2, 5 and 8
    assert spark.read.parquet(os.path.join(base, "tables", "user_clicks_base")).select("upto").distinct().count() == 3
    check_against_batch(spark, job)
    job.compact(2)          # re-running an old compaction changes nothing
    check_against_batch(spark, job)


def test_restart_from_checkpoint(spark):
    base = tempfile.mkdtemp(prefix="vl-restart-")
    src = os.path.join(base, "in")
    all_days = write_day_files(spark, src, days=set())
    first = set(all_days[:4])
    write_day_files(spark, src, days=first)
    job = AdClickStreamJob(spark, os.path.join(base, "tables"), threshold=THRESHOLD)
    run(spark, job, src, os.path.join(base, "ckpt"))
    # the rest arrives later; a new query resumes from the same checkpoint
    write_day_files(spark, src, days=set(all_days))
    for i, d in enumerate(all_days):
        os.utime(os.path.join(src, f"clicks-{d}.txt"), (1_700_000_000 + i, 1_700_000_000 + i))
    run(spark, job, src, os.path.join(base, "ckpt"))
    check_against_batch(spark, job)


def test_replayed_batch_is_idempotent(spark):
    base = tempfile.mkdtemp(prefix="vl-replay-")
    job = AdClickStreamJob(spark, os.path.join(base, "tables"), threshold=2)
    lines = fx.ad_log_lines(spark, SF001).limit(300)
    lines = spark.createDataFrame(lines.collect(), "value string")
    job.process(lines, 0)
    once = (rows(job.ad_stat()), rows(job.user_clicks()), rows(job.blacklist()))
    job.process(lines, 0)        # the same micro-batch delivered again
    assert (rows(job.ad_stat()), rows(job.user_clicks()), rows(job.blacklist())) == once
    bad = spark.createDataFrame([("not a line",)], "value string")
    job.process(bad, 1)
    assert rows(job.rejects(), "raw") == [("not a line",)]


def test_state_store_forms(spark):
    base = tempfile.mkdtemp(prefix="vl-state-")
    src = os.path.join(base, "in")
    write_day_files(spark, src)
    clicks_stream, _ = ads.parse_ad_log(text_lines(spark, src, max_files_per_trigger=3))
    out = {}

    def sink(name, keys):
        def f(df, _bid):
            for r in df.collect():               # a test sink: tiny update sets
                out.setdefault(name, {})[tuple(r[k] for k in keys)] = r["click_count"]
        return f

    stat_keys = ["date", "province", "city", "ad_id"]
    trend_keys = ["date", "hour", "minute", "ad_id"]
    q1 = (running_ad_stat(clicks_stream).writeStream.outputMode("update")
          .foreachBatch(sink("stat", stat_keys)).option("checkpointLocation", os.path.join(base, "c1"))
          .trigger(availableNow=True).start())
    q2 = (click_trend_updates(clicks_stream).writeStream.outputMode("update")
          .foreachBatch(sink("trend", trend_keys)).option("checkpointLocation", os.path.join(base, "c2"))
          .trigger(availableNow=True).start())
    q3 = (running_ad_stat(clicks_stream, retention="40 days").writeStream.outputMode("update")
          .foreachBatch(sink("stat_ret", stat_keys)).option("checkpointLocation", os.path.join(base, "c3"))
          .trigger(availableNow=True).start())
    for q in (q1, q2, q3):
        q.awaitTermination(300)
        assert q.exception() is None
    clicks = fx.ad_clicks(spark, SF001)
    want_stat = {tuple(r[k] for k in stat_keys): r["click_count"] for r in ads.ad_stat(clicks).collect()}
    want_trend = {tuple(r[k] for k in trend_keys): r["click_count"] for r in ads.click_trend(clicks).collect()}
    assert out["stat"] == want_stat
    assert out["stat_ret"] == want_stat
    assert out["trend"] == want_trend


def test_cli_ads_stream(spark):
    from visitlens.plans import cli

    base = tempfile.mkdtemp(prefix="vl-cli-ads-")
    src = os.path.join(base, "in")
    groups = write_day_files(spark, src, days=set())
    write_day_files(spark, src, days=set(groups[:2]))
    cli.main(["ads", "--lines", src, "--state", os.path.join(base, "tables"),
              "--checkpoint", os.path.join(base, "ckpt"), "--threshold", str(THRESHOLD),
              "--available-now"], spark=spark)
    job = AdClickStreamJob(spark, os.path.join(base, "tables"), threshold=THRESHOLD)
    assert job.ad_stat().count() > 0 and job.user_clicks().count() > 0
