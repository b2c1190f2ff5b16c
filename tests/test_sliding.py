"""The sliding trend against a plain version, at block borders, and in the stream job."""

import datetime as dt
import os
import tempfile
from collections import Counter

from conftest import SF001, rows
from test_streaming import THRESHOLD, expected, run, write_day_files
from visitlens.operators import ads
from visitlens.sources import fixtures as fx
from visitlens.streaming import AdClickStreamJob

EPOCH = dt.datetime(1970, 1, 1)


def plain(clicks, slide, window):
    out = Counter()
    for ts, ad in clicks:
        pane = int((ts - EPOCH).total_seconds() // slide)
        for e in range(pane + 1, pane + 1 + window // slide):
            out[e * slide, ad] += 1
    return {(EPOCH + dt.timedelta(seconds=e), ad, n) for (e, ad), n in out.items()}


def frame(spark, clicks):
    return spark.createDataFrame([(t, "p", "c", 1, a) for t, a in clicks] or [], "ts timestamp, province string, city string, user_id long, ad_id long")


def test_sliding_equals_plain_windows(spark):
    t = dt.datetime(2024, 1, 1, 23, 30, 3)
    clicks = [(t, 1), (t, 1), (t + dt.timedelta(seconds=6, milliseconds=999), 1), (t + dt.timedelta(seconds=7), 1),
              (dt.datetime(2024, 1, 1, 23, 59, 59), 2), (dt.datetime(2024, 1, 2), 2), (dt.datetime(2024, 1, 2, 0, 30), 2),
              (dt.datetime(2024, 1, 1, 23, 0), 3), (dt.datetime(1969, 12, 31, 23, 59, 55), 4), (dt.datetime(2024, 1, 5, 12), 1)]
    for slide, window in ((10, 3600), (10, 10), (60, 600), (3600, 86400)):
        got = ads.sliding_trend(frame(spark, clicks), slide, window).collect()
        assert len(got) == len({(r.window_end, r.ad_id) for r in got})
        assert {tuple(r) for r in got} == plain(clicks, slide, window)
    assert ads.sliding_trend(frame(spark, [])).collect() == []


def test_peaks(spark):
    clicks = [(r.ts, r.ad_id) for r in fx.ad_clicks(spark, SF001).collect()]
    want = {}
    for end, ad, n in plain(clicks, 10, 3600):
        best = want.setdefault(ad, [0, None, 0])
        best[2] += 10
        if n > best[0] or n == best[0] and end < best[1]:
            best[:2] = n, end
    assert {r.ad_id: list(r)[1:] for r in ads.sliding_peaks(fx.ad_clicks(spark, SF001)).collect()} == want


def test_no_click_is_replicated_over_windows(spark):
    """The plan makes at most three changes of a pane, and spreads finished runs only at the end."""
    df = ads.sliding_trend(fx.ad_clicks(spark, SF001))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert "Expand" not in plan
    top = plan[:plan.index("Window")]
    assert top.count("explode(sequence(first_end") == 1 and "explode(sequence" not in plan[len(top):]
    assert "partial_sum" in df._jdf.queryExecution().executedPlan().toString()


def test_stream_job_slides(spark):
    base = tempfile.mkdtemp(prefix="vl-slide-")
    src = os.path.join(base, "in")
    write_day_files(spark, src)
    job = AdClickStreamJob(spark, os.path.join(base, "tables"), threshold=THRESHOLD, compact_every=4)
    run(spark, job, src, os.path.join(base, "ckpt"))
    _, kept = expected(spark)
    lo, hi = "2024-01-09 12:00:05", "2024-01-11 01:00:00"
    want = ads.sliding_trend(kept).where(f"window_end between timestamp'{lo}' and timestamp'{hi}'")
    got = job.sliding_trend(lo, hi)
    assert rows(got) == rows(want) and got.count() > 0
    assert rows(job.click_trend("2024-01-10 00:30:40", 1200)) == rows(
        ads.click_trend(kept.where("ts >= timestamp'2024-01-09 04:31:00' and ts < timestamp'2024-01-10 00:31:00'")))
