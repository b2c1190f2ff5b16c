from fractions import Fraction

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from test_sessions import ACTION_SCHEMA, action
from visitlens.functions import half_up_ratio, pack_record, packed_field
from visitlens.operators import funnel


def exact_half_up(n, d):
    q = Fraction(n, d) * 100
    return float((q + Fraction(1, 2)).__floor__()) / 100


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 10 ** 9), st.integers(1, 10 ** 9)), min_size=1, max_size=200))
def test_half_up_ratio_equals_exact_rational_rounding(spark, pairs):
    pairs = [(min(n, d * 3), d) for n, d in pairs]
    df = spark.createDataFrame(pairs, "n long, d long")
    got = [r["r"] for r in df.select(half_up_ratio(F.col("n"), F.col("d")).alias("r")).collect()]
    assert got == [exact_half_up(n, d) for n, d in pairs]


@settings(max_examples=5, deadline=None)
@given(st.lists(st.text(alphabet="abcxyz019,:- ", min_size=0, max_size=12), min_size=3, max_size=3))
def test_packed_record_roundtrip(spark, values):
    df = spark.createDataFrame([tuple(values)], "a string, b string, c string")
    rec = df.select(pack_record({"a": F.col("a"), "b": F.col("b"), "c": F.col("c")}).alias("r"))
    got = rec.select(*[packed_field(F.col("r"), k).alias(k) for k in "abc"]).first()
    assert [got[k] for k in "abc"] == [v if v != "" else None for v in values]


def test_hot_session_is_split_across_tasks(spark):
    # one session with 3000 actions (three quarters of all rows) plus 100 small sessions
    rows = [action("hot", 1, f"2024-01-08 {i // 3600:02d}:{(i // 60) % 60:02d}:{i % 60:02d}",
                   page=i % 9 + 1, aid=i) for i in range(3000)]
    rows += [action(f"s{j}", 2, f"2024-01-08 01:00:{k:02d}", page=k + 1, aid=10000 + j * 10 + k)
             for j in range(100) for k in range(10)]
    acts = spark.createDataFrame(rows, ACTION_SCHEMA)
    by_session = {}
    for r in acts.collect():
        by_session.setdefault(r.session_id, []).append((r.action_time, r.action_id, r.page_id))
    wanted = sorted((k, b[1], a[2], b[2]) for k, v in by_session.items() for a, b in zip(sorted(v), sorted(v)[1:]))
    assert len(wanted) == 2999 + 100 * 9
    # the same rows whether or not Spark reuses the shuffle that both branches read
    for reuse in ("true", "false"):
        spark.conf.set("spark.sql.exchange.reuse", reuse)
        try:
            assert sorted(tuple(r) for r in funnel.page_transitions(acts, 300).collect()) == wanted
        finally:
            spark.conf.unset("spark.sql.exchange.reuse")
    # a table without action ids, as the reference stores it
    bare = funnel.page_transitions(acts.drop("action_id"), 300)
    assert sorted((r[0], r[2], r[3]) for r in bare.collect()) == sorted((k, a, b) for k, _, a, b in wanted)
