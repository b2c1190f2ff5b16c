"""The append log as a source of the ad stream: restarts, replays, unfinished appends."""

import os
import shutil
import tempfile

import pytest
from pyspark.sql import functions as F

from conftest import SF001, rows
from test_streaming import THRESHOLD, batch_of, check_against_batch
from visitlens.sources import append_log, fixtures as fx
from visitlens.streaming import AdClickStreamJob


def put(spark, log, groups):
    """Append the ad lines of the given three-day groups, one append each."""
    ts = F.timestamp_millis(F.split("value", " ")[0].cast("bigint"))
    lines = fx.ad_log_lines(spark, SF001).withColumn("group", batch_of(ts)).persist()
    for g in groups:
        append_log.append(lines.where(F.col("group") == g).select(F.lit("x").alias("other"), "value").repartition(3), log, g)
    lines.unpersist()


def drain(spark, job, log, ckpt):
    q = job.start(append_log.stream(spark, log), ckpt, {"availableNow": True})
    q.awaitTermination(300)
    assert q.exception() is None


def test_restart_and_replay_over_the_log(spark):
    base = tempfile.mkdtemp(prefix="vl-log-")
    log, ckpt = os.path.join(base, "log"), os.path.join(base, "ckpt")
    job = AdClickStreamJob(spark, os.path.join(base, "tables"), threshold=THRESHOLD)
    groups = sorted(r.g for r in fx.ad_clicks(spark, SF001).select(batch_of(F.col("ts")).alias("g")).distinct().collect())
    for g in groups:                       # every append is a micro-batch of a restarted query
        put(spark, log, [g])
        drain(spark, job, log, ckpt)
    check_against_batch(spark, job)
    # the last batch died after its writes and before its commit: it is planned and run again
    done = os.path.join(ckpt, "commits")
    last = max(int(n) for n in os.listdir(done) if n.isdigit())
    assert last == len(groups) - 1
    for n in (str(last), f".{last}.crc"):
        if os.path.exists(os.path.join(done, n)):
            os.remove(os.path.join(done, n))
    drain(spark, job, log, ckpt)
    assert max(int(n) for n in os.listdir(done) if n.isdigit()) == last
    check_against_batch(spark, job)


def numbers(spark, log, ckpt, out):
    q = (append_log.stream(spark, log, "n long").writeStream.format("parquet").option("path", out)
         .option("checkpointLocation", ckpt).trigger(availableNow=True).start())
    q.awaitTermination(120)
    return rows(spark.read.schema("n long").parquet(out), "n")


def test_unfinished_empty_and_missing_appends(spark):
    base = tempfile.mkdtemp(prefix="vl-log-")
    log, ckpt, out = (os.path.join(base, x) for x in ("log", "ckpt", "out"))
    os.makedirs(out)
    assert numbers(spark, log, ckpt, out) == []                      # no log yet
    append_log.append(spark.range(0, 5).select(F.col("id").alias("n")), log, 0)
    append_log.append(spark.range(0).select(F.col("id").alias("n")), log, 1)
    append_log.append(spark.range(5, 8).select(F.col("id").alias("n")), log, 2)
    append_log.append(spark.range(8, 9).select(F.col("id").alias("n")), log, 4)  # numbers may have gaps
    os.remove(os.path.join(log, "append=2", "_SUCCESS"))
    assert numbers(spark, log, ckpt, out) == [(n,) for n in range(5)]  # 4 waits for 2
    append_log.append(spark.range(5, 8).select(F.col("id").alias("n")), log, 2)
    append_log.append(spark.createDataFrame([(None,)], "n long"), log, 5)
    assert sorted(numbers(spark, log, ckpt, out), key=repr) == sorted([(n,) for n in range(9)] + [(None,)], key=repr)
    append_log.append(spark.range(9, 9).select(F.col("id").alias("n")), log, 5)  # read already: not read again
    assert len(numbers(spark, log, ckpt, out)) == 10


def test_offsets_name_the_same_rows(spark):
    base = tempfile.mkdtemp(prefix="vl-log-")
    for n in range(3):
        append_log.append(spark.range(10 * n, 10 * n + 10).select(F.col("id").alias("n")).repartition(2), base, n)
    reader = append_log.AppendLogReader(base, ["n"])
    read = lambda a, b: sorted(v for p in reader.partitions({"append": a}, {"append": b})
                               for batch in reader.read(p) for v in batch.column(0).to_pylist())
    assert reader.latestOffset() == {"append": 2}
    assert read(-1, 0) == list(range(10)) and read(0, 2) == list(range(10, 30)) and read(2, 2) == []
    assert append_log.AppendLogReader("file://" + base, ["n"]).latestOffset() == {"append": 2}
    shutil.rmtree(os.path.join(base, "append=2"))
    with pytest.raises(RuntimeError):
        read(1, 2)
    with pytest.raises(ValueError):
        append_log.append(spark.range(1), base, -1)
