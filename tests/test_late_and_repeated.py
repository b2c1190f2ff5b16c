"""Late clicks are kept aside, repeated ones dropped, visits closed: batch and stream alike."""

import datetime as dt
import os
import tempfile

from conftest import SF001, rows
from pyspark.sql import functions as F
from test_streaming import write_day_files
from visitlens.operators import ads
from visitlens.sources import fixtures as fx
from visitlens.streaming import AdClickStreamJob, ad_stream, text_lines, user_session_updates, without_repeats

FIELDS = ["ts", "province", "city", "user_id", "ad_id"]


def lines_of(spark, clicks):
    return spark.createDataFrame([(f"{int(t.replace(tzinfo=dt.timezone.utc).timestamp() * 1000)} p c {u} {a}",) for t, u, a in clicks] or [],
                                 "value string")


def test_late_and_kept_make_the_input(spark, monkeypatch):
    monkeypatch.setattr(ad_stream, "PAGES_COMPACT_EVERY", 2)
    job = AdClickStreamJob(spark, tempfile.mkdtemp(prefix="vl-late-") + "/t", threshold=10**6, lateness_seconds=3600)
    t = dt.datetime(2024, 1, 1, 12)
    h = lambda x: t + dt.timedelta(hours=x)
    batches = [[(h(0), 1, 1), (h(-9), 1, 2)],                     # no watermark yet: nothing is late
               [(h(5), 2, 1), (h(-1), 2, 2), (h(-1.001), 2, 3)],  # watermark 11:00
               [],                                                 # it stays
               [(h(4), 3, 1), (h(3.99), 3, 2), (h(0), 3, 3)],     # watermark 16:00
               [(h(3.5), 4, 1)]]                                  # all late
    late = [(2, 3), (3, 2), (3, 3), (4, 1)]
    for k, b in enumerate(batches):
        job.process(lines_of(spark, b), k)
        if k in (1, 3):
            job.process(lines_of(spark, b), k)  # delivered again
    assert rows(job.late_clicks(), "user_id", "ad_id") == late
    kept = rows(job.user_clicks(), "user_id", "ad_id", "click_count")
    assert sorted([(u, a, 1) for u, a in late] + kept) == sorted((u, a, 1) for b in batches for _, u, a in b)


def test_without_lateness_nothing_is_late(spark):
    job = AdClickStreamJob(spark, tempfile.mkdtemp(prefix="vl-late-") + "/t", threshold=10**6)
    t = dt.datetime(2024, 1, 1)
    job.process(lines_of(spark, [(t, 1, 1)]), 0)
    job.process(lines_of(spark, [(t - dt.timedelta(days=9), 1, 2)]), 1)
    assert job.user_clicks().count() == 2 and job.late_clicks().count() == 0


def collected(query_of, stream, mode):
    out, base = [], tempfile.mkdtemp(prefix="vl-col-")
    q = (query_of(stream).writeStream.outputMode(mode).foreachBatch(lambda df, _: out.extend(df.collect()))
         .option("checkpointLocation", base).trigger(availableNow=True).start())
    q.awaitTermination(200)
    assert q.exception() is None
    return out


def test_repeated_lines_count_once(spark):
    src = tempfile.mkdtemp(prefix="vl-rep-")
    write_day_files(spark, src)
    names = sorted(os.listdir(src))
    for k, n in enumerate(names):  # every file again, right after itself
        with open(os.path.join(src, n)) as f:
            text = f.read()
        again = os.path.join(src, n.replace(".txt", "-again.txt"))
        with open(again, "w") as f:
            f.write(text + text)
        os.utime(os.path.join(src, n), (1_700_000_000 + 2 * k,) * 2)
        os.utime(again, (1_700_000_001 + 2 * k,) * 2)
    stream, _ = ads.parse_ad_log(text_lines(spark, src, max_files_per_trigger=1))
    got = collected(lambda s: without_repeats(s, "10 days"), stream, "append")
    want = ads.parse_ad_log(fx.ad_log_lines(spark, SF001))[0].distinct()  # lines hold milliseconds
    assert sorted(tuple(r) for r in got) == sorted(tuple(r) for r in want.select(*FIELDS).collect())


def plain_visits(clicks, gap):
    out = []
    for u in {c.user_id for c in clicks}:
        own = sorted((c.ts, c.ad_id) for c in clicks if c.user_id == u)
        visit = [own[0]]
        for c in own[1:] + [None]:
            if c is None or (c[0] - visit[-1][0]).total_seconds() >= gap:
                out.append((u, visit[0][0], visit[-1][0], len(visit), len({a for _, a in visit})))
                visit = []
            visit.append(c)
    return sorted(out)


def test_visits_in_batch_and_stream(spark):
    clicks, _ = ads.parse_ad_log(fx.ad_log_lines(spark, SF001))
    raw = clicks.collect()
    for gap in (1, 1800, 86_400, 40 * 86_400):
        got = ads.user_sessions(clicks, gap).select("user_id", "session_start", "session_end", "click_count", "ads")
        assert rows(got) == sorted(plain_visits(raw, gap), key=repr)
    edge = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, s), "p", "c", u, 1) for u, ss in ((1, (0, 9, 19)), (2, (0, 10, 11))) for s in ss],
                                 "ts timestamp, province string, city string, user_id long, ad_id long")
    assert rows(ads.user_sessions(edge, 10), "user_id", "click_count") == [(1, 1), (1, 2), (2, 1), (2, 2)]
    src = tempfile.mkdtemp(prefix="vl-vis-")
    write_day_files(spark, src)
    with open(os.path.join(src, "zz.txt"), "w") as f:  # a click far ahead closes all visits
        f.write("1893456000000 p c 999999 1\n")
    os.utime(os.path.join(src, "zz.txt"), (1_800_000_000,) * 2)
    stream, _ = ads.parse_ad_log(text_lines(spark, src, max_files_per_trigger=3))
    got = collected(lambda s: user_session_updates(s, "1 day", "2 days"), stream, "append")
    assert sorted(tuple(r) for r in got if r.user_id != 999999) == sorted(v[:4] for v in plain_visits(raw, 86_400))
