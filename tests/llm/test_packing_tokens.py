"""Packing in tokens."""

from collections import Counter

from helpers import AWKWARD, docs, empty
from visitlens.llm.pretokens import keys_of
from visitlens.llm.queries import BYTE_MODEL, QUERIES, token_lengths

SF = "/root/testdata/sf0.001"


def n_tokens(text):
    return len(keys_of(BYTE_MODEL).encode_whole(text)) if text else 0


def test_token_lengths(spark):
    got = Counter((r.doc_id, r.length) for r in token_lengths(docs(spark)).collect())
    assert got == Counter((i, n_tokens(t) + 1 if t else None) for i, t in AWKWARD)
    assert token_lengths(empty(spark)).collect() == []


def test_packing_query_packs_tokens(spark):
    """Documents that fit into a permitted length in tokens stay whole."""
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    whole = Counter()
    for r in QUERIES["op5_packing"](spark, SF).collect():
        whole[r.doc_id] += r.length
    assert whole == {i: n_tokens(t) + 1 if t else 0 for i, t in texts.items()}
