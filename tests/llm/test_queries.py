"""Registered queries and the pipeline on the smallest tables."""

import sys
from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

from test_documents import brute_components, quality_rules_pass

sys.path.insert(0, str(Path(__file__).parents[2]))

import __spark_entry__ as entry_mod  # noqa: E402
import corpus_pipeline  # noqa: E402
from visitlens.llm import packing, quality_knn  # noqa: E402
from visitlens.llm.queries import KEEP_SCORE, ORACLE, QUERIES, byte_lengths, quality_model  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_all_registered():
    names = set(entry_mod.queries())
    assert {n.split("_")[0] for n in QUERIES} == {f"op{k}" for k in range(1, 14)} and set(QUERIES) | {"pipeline"} <= names


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_sql(spark, name):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    rel = con.sql(ORACLE[name])
    got = QUERIES[name](spark, SF).select(*rel.columns).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(rel.fetchall(), key=repr)


def test_rules_sql_on_awkward_texts(spark):
    """Every white space of the word class, also inside lines, and none beyond it."""
    from helpers import AWKWARD
    from visitlens.llm import quality_rules

    rows = AWKWARD + [(60, "a\x0bb c\x0dd e\x0cf\tg\x1ch\x85i\u00a0j"), (61, "\x0b\x0c\n\x0b\n\r\n \r\nx\r\nx\r\n"), (62, "l\x0bm\nl\x0bm\nl m\n" * 20)]
    con = duckdb.connect()
    con.sql("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [(i, t if t is None else t.replace("\x00", "\x01")) for i, t in rows])
    rel = con.sql(ORACLE["op4_quality_rules"])
    docs = spark.createDataFrame([(i, t if t is None else t.replace("\x00", "\x01")) for i, t in rows], "doc_id long, text string")
    got = quality_rules.apply_policy(quality_rules.ledger(docs)).select(*rel.columns).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(rel.fetchall(), key=repr)
    assert {r.n_words for r in got if r.doc_id == 60} == {7}


def test_pipeline_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    model = quality_model(spark, SF)
    good = [i for i, t in texts.items() if model.score(quality_knn.features([t or ""]))[0] >= KEEP_SCORE]
    passing = [i for i in good if quality_rules_pass(texts[i])]
    kept = {i for i, _, c in brute_components([(i, texts[i]) for i in passing], 5, 80) if i == c}
    got = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in got} == kept
    whole = {}
    for r in got:
        whole[r.doc_id] = whole.get(r.doc_id, 0) + r.length
    assert whole == {i: len(texts[i].encode()) + 1 for i in kept}
    alone = packing.pack(byte_lengths(docs.filter(F.col("doc_id").isin(sorted(kept))))).collect()
    assert sorted((r.bin_used, r.bin_capacity) for r in got) == sorted((r.bin_used, r.bin_capacity) for r in alone)


def test_stages_keep_columns_and_awkward_rows(spark):
    from helpers import AWKWARD

    docs = spark.createDataFrame([(i, t, None, None, None, "x") for i, t in AWKWARD],
                                 "doc_id long, text string, lang string, source string, n_chars long, X_score string")
    for frame in (docs, docs.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, frame, SF)
            assert out.columns == docs.columns
            out.collect()
        corpus_pipeline.STAGES[-1][1](spark, frame, SF).collect()
