"""Bitmap pages of ids; the blacklist as pages in the batch form and the stream."""

import os
import tempfile

from conftest import SF001, rows
from pyspark.sql import functions as F
from test_streaming import THRESHOLD, check_against_batch, run, write_day_files
from visitlens.operators import ads, membership as mem
from visitlens.sources import fixtures as fx
from visitlens.streaming import AdClickStreamJob, ad_stream

IDS = [0, 1, 7, 8, 32767, 32768, 32769, 65536, 10**12, -1, -32768, -40000, 1, 1]


def test_every_id_is_found_and_no_other(spark):
    ids = spark.createDataFrame([(i,) for i in IDS] + [(None,)], "u long")
    pages = mem.id_pages(ids, "u")
    near = sorted({i + d for i in IDS for d in (-32768, -8, -1, 0, 1, 8, 32768)})
    asked = spark.createDataFrame([(i, "x") for i in near] + [(None, "n")], "u long, _x string")
    for most in (100, 0):  # broadcast, and shuffled with salted hot pages
        got = rows(mem.without(asked, pages, "u", max_pages=most))
        assert got == sorted([(i, "x") for i in near if i not in IDS] + [(None, "n")], key=repr)
    assert mem.without(asked, pages.limit(0), "u").count() == len(near) + 1


def test_pages_merge(spark):
    part = lambda xs: mem.id_pages(spark.createDataFrame([(i,) for i in xs], "u long"), "u")
    merged = mem.merge_pages(part(IDS[:5]), part(IDS[4:9]), part(IDS[8:]))
    assert rows(merged.select("page", F.hex("bits"))) == rows(part(IDS).select("page", F.hex("bits")))
    assert merged.agg(F.sum(F.bitmap_count("bits"))).first()[0] == len(set(IDS))


def test_filter_by_pages_equals_filter_by_join(spark):
    clicks = fx.ad_clicks(spark, SF001)
    batch = F.date_trunc("hour", F.col("ts"))
    for threshold, b in ((2, None), (3, None), (2, batch)):
        want = rows(ads.blacklist_filter(clicks, threshold, b))
        for most in (4096, 0):
            assert rows(ads.blacklist_filter_pages(clicks, threshold, b, max_pages=most)) == want
    plan = ads.blacklist_filter_pages(clicks, 3)._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftAnti" not in plan


def test_stream_reads_only_folded_pages(spark, monkeypatch):
    monkeypatch.setattr(ad_stream, "PAGES_COMPACT_EVERY", 3)
    base = tempfile.mkdtemp(prefix="vl-pages-")
    src = os.path.join(base, "in")
    write_day_files(spark, src)
    job = AdClickStreamJob(spark, os.path.join(base, "tables"), threshold=THRESHOLD)
    run(spark, job, src, os.path.join(base, "ckpt"))
    check_against_batch(spark, job)
    pages = job.blacklist_pages()
    assert pages.current().agg(F.sum(F.bitmap_count("bits"))).first()[0] == job.blacklist().count()
    # ten batches, folded after 2, 5 and 8: what is left is the last bases and the batches after them
    assert len(pages._children(f"{pages.path}/base")) <= 2 and len(pages._children(f"{pages.path}/delta")) <= 4
