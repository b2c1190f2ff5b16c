from pyspark.sql import functions as F

from conftest import rows
from visitlens.functions import (
    STEP_BUCKETS, VISIT_BUCKETS, bucket_label, concat_long_string, group_concat_distinct,
    half_up_ratio, json_field, pack_record, packed_field, parse_action_time, register_sql_functions,
    split_ids,
)


def test_half_up_ratio_exact_ties(spark):
    df = spark.createDataFrame([(3, 200), (1, 3), (2, 3), (1, 8), (0, 5), (5, 0), (7, 7)], "n long, d long")
    got = rows(df.select("n", "d", half_up_ratio(F.col("n"), F.col("d")).alias("r")), "n", "d", "r")
    assert dict(((n, d), r) for n, d, r in got) == {
        (3, 200): 0.02, (1, 3): 0.33, (2, 3): 0.67, (1, 8): 0.13, (0, 5): 0.0, (5, 0): None, (7, 7): 1.0}


def test_buckets_zero_in_none(spark):
    df = spark.createDataFrame([(v,) for v in (0, 1, 3, 4, 9, 10, 29, 30, 59, 60, 179, 180, 599, 600, 1799, 1800)],
                               "v long")
    got = dict(rows(df.select("v", bucket_label(F.col("v"), VISIT_BUCKETS).alias("b"))))
    assert got[0] is None and got[1] == "1s_3s" and got[3] == "1s_3s" and got[4] == "4s_6s"
    assert got[10] == "10s_30s" and got[29] == "10s_30s" and got[30] == "30s_60s"
    assert got[60] == "1m_3m" and got[1799] == "10m_30m" and got[1800] == "30m"
    steps = dict(rows(df.select("v", bucket_label(F.col("v"), STEP_BUCKETS).alias("b"))))
    assert steps[0] is None and steps[60] == "60" and steps[59] == "30_60"


def test_packed_record_roundtrip_and_edges(spark):
    df = spark.createDataFrame([
        ("a=1|kw=|c=x=y|d=7|",), ("kw=foo|a=2",), ("a=3|",), ("|a=|a=4|",), (None,)], "rec string")
    got = rows(df.select(packed_field(F.col("rec"), "a").alias("a"), packed_field(F.col("rec"), "kw").alias("kw"),
                         packed_field(F.col("rec"), "c").alias("c"), packed_field(F.col("rec"), "d").alias("d")))
    assert sorted(got, key=repr) == sorted([("1", None, None, "7"), ("2", "foo", None, None),
                                            ("3", None, None, None), ("4", None, None, None),
                                            (None, None, None, None)], key=repr)
    packed = spark.range(1).select(pack_record({"sessionid": F.lit("s1"), "visitLength": F.lit(5),
                                                "searchKeywords": F.lit(None).cast("string")}).alias("r"))
    assert packed.first()["r"] == "sessionid=s1|visitLength=5|searchKeywords=|"
    back = packed.select(packed_field(F.col("r"), "visitLength").alias("v"),
                         packed_field(F.col("r"), "searchKeywords").alias("k")).first()
    assert back["v"] == "5" and back["k"] is None


def test_split_ids_drops_empty_and_malformed(spark):
    df = spark.createDataFrame([("1,2",), ("3,,x, 4",), ("",), (None,)], "s string")
    got = [r["ids"] for r in df.select(split_ids(F.col("s")).alias("ids")).collect()]
    assert got == [[1, 2], [3, 4], [], None]


def test_parse_action_time_unpadded_hour(spark):
    df = spark.createDataFrame([("2024-01-01 5:03:02",), ("2024-01-01 05:03:02",), ("garbage",)], "s string")
    got = [r["t"] for r in df.select(F.date_format(parse_action_time(F.col("s")), "HH:mm:ss").alias("t")).collect()]
    assert got == ["05:03:02", "05:03:02", None]


def test_udf_surface(spark):
    register_sql_functions(spark)
    r = spark.sql("""SELECT concat_long_string(CAST(7 AS BIGINT), 'x', ':') a,
                            concat_long_string(CAST(NULL AS BIGINT), NULL, ':') b,
                            json_field('{"product_status": 0}', 'product_status') c,
                            json_field('{}', 'product_status') d""").first()
    assert (r["a"], r["b"], r["c"], r["d"]) == ("7:x", "null:null", "0", None)
    df = spark.createDataFrame([(1, 2, "b"), (1, 1, "a"), (1, 2, "b"), (2, None, None)], "k int, i long, s string")
    got = rows(df.groupBy("k").agg(group_concat_distinct(concat_long_string(F.col("i"), F.col("s"))).alias("g"),
                                   group_concat_distinct(json_field(F.lit('{"a": 1}'), "a")).alias("j")))
    assert got == [(1, "1:a,2:b", "1"), (2, "null:null", "1")]


def test_packed_and_json_fields_as_the_reference_reads_them(spark):
    from visitlens.functions.columns import json_field, packed_field

    df = spark.createDataFrame([("a=b=|c=d=e|f=|", '{"x.y": "1", "z": "2"}')], "r string, j string")
    r = df.select(*[packed_field(F.col("r"), k).alias(k) for k in "acf"], json_field(F.col("j"), "x.y").alias("xy"), json_field(F.col("j"), "z").alias("z")).first()
    assert (r.a, r.c, r.f, r.xy, r.z) == ("b", None, None, "1", "2")


def test_value_in_reads_comma_separated_attributes(spark):
    from visitlens.operators.sessions import value_in

    df = spark.createDataFrame([("a,b",), ("c",), (None,)], "v string")
    assert [r.v for r in df.where(value_in("v", ["b", "c"])).collect()] == ["a,b", "c"]
