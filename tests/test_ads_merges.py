import datetime as dt

from conftest import SF001, rows
from visitlens.operators import ads, merges
from visitlens.sources import fixtures as fx


def test_parse_rejects_malformed(spark):
    lines = spark.createDataFrame([("1704067200000 Hubei Wuhan 7 3",), ("1704067200000 Hubei Wuhan 7",),
                                   ("x Hubei Wuhan 7 3",), ("",), (None,)], "value string")
    clicks, rejects = ads.parse_ad_log(lines)
    got = clicks.collect()
    assert len(got) == 1 and got[0]["user_id"] == 7 and got[0]["ad_id"] == 3
    assert got[0]["ts"] == dt.datetime(2024, 1, 1, 0, 0)
    assert rejects.count() == 4


def simulate(clicks_rows, threshold):
    """Direct batch-by-batch simulation of the streaming blacklist (batch = day)."""
    by_batch = {}
    for r in clicks_rows:
        by_batch.setdefault(r["ts"].date(), []).append(r)
    listed, counts, kept = set(), {}, []
    for b in sorted(by_batch):
        batch_kept = [r for r in by_batch[b] if r["user_id"] not in listed]
        kept += batch_kept
        for r in batch_kept:
            k = (r["ts"].date(), r["user_id"], r["ad_id"])
            counts[k] = counts.get(k, 0) + 1
        for k, n in counts.items():
            if n >= threshold:
                listed.add(k[1])
    return listed, kept


def test_blacklist_closed_form_matches_simulation(spark):
    clicks = fx.ad_clicks(spark, SF001)
    raw = clicks.collect()
    for threshold in (2, 3, 5):
        listed, kept = simulate(raw, threshold)
        assert {r["user_id"] for r in ads.blacklist_users(clicks, threshold).collect()} == listed
        got = sorted((r["ts"], r["user_id"], r["ad_id"]) for r in ads.blacklist_filter(clicks, threshold).collect())
        assert got == sorted((r["ts"], r["user_id"], r["ad_id"]) for r in kept)


def test_threshold_crossed_inside_batch(spark):
    t0 = dt.datetime(2024, 1, 1, 10, 0)
    data = [(t0 + dt.timedelta(minutes=i), "Hubei", "Wuhan", 1, 1) for i in range(3)] + \
           [(t0 + dt.timedelta(days=1), "Hubei", "Wuhan", 1, 1), (t0 + dt.timedelta(days=1), "Hubei", "Wuhan", 2, 1)]
    clicks = spark.createDataFrame(data, "ts timestamp, province string, city string, user_id long, ad_id long")
    kept = ads.blacklist_filter(clicks, 3)
    # user 1 reaches 3 during day 1: all of day 1 is kept, day 2 dropped
    assert rows(kept, "user_id") == [(1,), (1,), (1,), (2,)]


def test_stat_top_trend(spark):
    t0 = dt.datetime(2024, 1, 1, 10, 0, 5)
    data = [(t0, "Hubei", "Wuhan", 1, 1), (t0, "Hubei", "Jingzhou", 2, 1), (t0, "Hubei", "Wuhan", 3, 2),
            (t0, "Hubei", "Wuhan", 3, 3), (t0, "Hubei", "Wuhan", 4, 4), (t0, "Hubei", "Wuhan", 4, 4),
            (t0 + dt.timedelta(minutes=70), "Hunan", "Changsha", 5, 9)]
    clicks = spark.createDataFrame(data, "ts timestamp, province string, city string, user_id long, ad_id long")
    stat = ads.ad_stat(clicks)
    assert rows(ads.province_clicks(stat).where("province = 'Hubei'"), "ad_id", "click_count") == \
        [(1, 2), (2, 1), (3, 1), (4, 2)]
    top = rows(ads.province_top_ads(stat, 3), "province", "ad_id")
    assert top == [("Hubei", 1), ("Hubei", 2), ("Hubei", 4), ("Hunan", 9)]   # tie 2 vs 3 -> lower id
    trend = rows(ads.click_trend_window(clicks, "2024-01-01 11:00:00", 60), "hour", "minute", "ad_id", "click_count")
    assert trend == [("10", "00", 1, 2), ("10", "00", 2, 1), ("10", "00", 3, 1), ("10", "00", 4, 2)]


def test_merges(spark):
    target = spark.createDataFrame([("d1", "p", 1, 5), ("d1", "p", 2, 3), ("d2", "q", 1, 1)],
                                   "date string, province string, ad_id long, click_count long")
    updates = spark.createDataFrame([("d1", "p", 2, 10), ("d3", "p", 1, 7)],
                                    "date string, province string, ad_id long, click_count long")
    keys = ["date", "province", "ad_id"]
    assert rows(merges.merge_overwrite(target, updates, keys)) == \
        [("d1", "p", 1, 5), ("d1", "p", 2, 10), ("d2", "q", 1, 1), ("d3", "p", 1, 7)]
    assert rows(merges.merge_add(target, updates, keys, ["click_count"])) == \
        [("d1", "p", 1, 5), ("d1", "p", 2, 13), ("d2", "q", 1, 1), ("d3", "p", 1, 7)]
    assert rows(merges.merge_replace_group(target, updates, ["date", "province"])) == \
        [("d1", "p", 2, 10), ("d2", "q", 1, 1), ("d3", "p", 1, 7)]


def test_ad_log_times_out_of_range_are_rejected(spark):
    lines = spark.createDataFrame([(f"{ms} p c 1 2",) for ms in
                                   ("9223372036854775807", "999999999999999", "-5", "253402300800000", "1704067200000")], "value string")
    clicks, rejects = ads.parse_ad_log(lines)
    assert clicks.count() == 1 and rejects.count() == 4
    assert clicks.select(ads.day(clicks.ts).alias("d")).first().d == "2024-01-01"


def test_ad_fixture_lists_some_but_not_most_users(spark):
    from visitlens.plans import catalog
    from visitlens.sources import fixtures as fx

    for sf in ("/root/testdata/sf0.001", "/root/testdata/sf0.01"):
        clicks = fx.ad_clicks(spark, sf)
        listed = ads.blacklist_users(clicks, catalog.BLACKLIST_THRESHOLD).count()
        users = clicks.select("user_id").distinct().count()
        assert 0 < listed < users / 2
        for name in ("merge_overwrite", "merge_add", "merge_replace_group", "ad_stat", "ad_click_trend"):
            assert catalog.QUERIES[name](spark, sf).count() > 0
