"""The merge-on-read table against a dictionary: commits, replays, folding, time travel, upkeep, bytes written."""

import random
import tempfile

import pytest
from conftest import rows
from pyspark.sql import functions as F

from visitlens.sources.keyed_table import KeyedTable

DDL = "g string, k long, n long, note string"


def table(spark, **kw):
    return KeyedTable(spark, tempfile.mkdtemp(prefix="vl-keyed-") + "/t", DDL, ["g", "k"], ["n"], **{"group": ["g"], "buckets": 4} | kw)


def frame(spark, data):
    return spark.createDataFrame(data, DDL)


class Plain:
    def __init__(self):
        self.rows = {}

    def apply(self, op, data):
        if op == "replace_groups":
            gone = {g for g, *_ in data}
            self.rows = {k: v for k, v in self.rows.items() if k[0] not in gone}
        for g, k, n, note in data:
            old = self.rows.get((g, k))
            self.rows[g, k] = (n + old[0], note) if op == "add" and old else (n, note)

    def list(self):
        return sorted(((*k, *v) for k, v in self.rows.items()), key=repr)


def test_random_commits_with_replays_folding_and_vacuum(spark):
    rng, t, plain, states = random.Random(3), table(spark), Plain(), []
    for version in range(9):
        op = rng.choice(["overwrite", "add", "add", "replace_groups"])
        keys = rng.sample([(g, k) for g in "abcde" for k in range(6)], rng.randint(0, 9))
        data = [(g, k, rng.randint(-3, 9), f"v{version}") for g, k in keys]
        getattr(t, op)(frame(spark, data), version)
        if version in (2, 6):  # the same micro-batch again
            getattr(t, op)(frame(spark, data), version)
        if version == 4:
            assert t.compact(4, least=2)
            getattr(t, op)(frame(spark, data), version)  # again after it was folded
        plain.apply(op, data)
        states.append(plain.list())
        if version in (1, 3, 4, 6, 8):
            assert rows(t.current()) == states[-1], version
    assert rows(t.current(before=8)) == states[7] and rows(t.current(before=3)) == states[2]
    assert t.compact(7, least=1)
    assert t.compact(7, least=1) == []
    assert rows(t.current()) == states[8]
    assert t.vacuum(keep_from=8)
    assert rows(t.current()) == states[8] and rows(t.current(before=8)) == states[7]
    assert t.vacuum(keep_from=8) == []
    left = {name for name in t._children(f"{t.path}/delta")}
    assert left == {"version=8"}


def test_empty_table_and_empty_commit(spark):
    t = table(spark)
    assert t.current().collect() == [] and t.current().columns == ["g", "k", "n", "note"]
    t.overwrite(frame(spark, []), 0)
    assert t.current().collect() == [] and t.compact(0, 1) == [] and t.vacuum(1) == []
    t.add(frame(spark, [("a", 1, 2, None), ("a", 1, 3, None), (None, None, 1, "x")]), 1)
    assert rows(t.current()) == sorted([("a", 1, 5, None), (None, None, 1, "x")], key=repr)


def test_unfinished_commit_is_not_read(spark):
    t = table(spark)
    t.overwrite(frame(spark, [("a", 1, 1, "x")]), 0)
    data = frame(spark, [("a", 1, 9, "torn"), ("b", 1, 9, "torn")])
    data.withColumn("op", F.lit(0)).withColumn("bucket", t._bucket()).write.partitionBy("bucket").parquet(f"{t.path}/delta/version=1")
    assert rows(t.current()) == [("a", 1, 1, "x")]
    t.overwrite(frame(spark, [("c", 1, 2, "y")]), 1)  # the retry replaces what was torn
    assert rows(t.current()) == [("a", 1, 1, "x"), ("c", 1, 2, "y")]


def test_bytes_follow_the_update_not_the_table(spark):
    t = KeyedTable(spark, tempfile.mkdtemp(prefix="vl-keyed-") + "/t", "k long, n long", ["k"], ["n"], buckets=4)
    t.overwrite(spark.range(200_000).selectExpr("id as k", "xxhash64(id) as n"), 0)
    t.compact(0, least=1)
    for version, size in ((1, 10), (2, 1000)):
        t.add(spark.range(size).selectExpr("id * 7 as k", "id as n"), version)
    assert t.written_bytes(1) < t.written_bytes(2) < t.written_bytes(0) / 50
    assert t.current().count() == 200_000
    assert t.current().where("k = 7").first().n == spark.sql("select xxhash64(7L) n").first().n + 2


def test_only_touched_buckets_fold_and_only_needed_files_are_read(spark):
    t = table(spark, group=None, buckets=8)
    t.overwrite(frame(spark, [("a", k, 1, "x") for k in range(64)]), 0)
    t.compact(0, least=1)
    one = frame(spark, [("a", 1, 2, "y")])
    for version in (1, 2, 3):
        t.add(one, version)
    folded = t.compact(3, least=3)
    assert len(folded) == 1
    plan = t.current()._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "Window" not in plan  # no delta is left: nothing to merge
    assert t.current().count() == 64 and t.current().where("k = 1").first().n == 7


def test_keys_must_be_columns(spark):
    with pytest.raises(ValueError):
        KeyedTable(spark, "/tmp/none", DDL, ["z"])
    with pytest.raises(ValueError):
        KeyedTable(spark, "/tmp/none", DDL, ["g"], group=["k"])
