"""The pipeline's dedup on ids with several texts."""

import sys
from collections import Counter
from pathlib import Path

from helpers import PROSE

sys.path.insert(0, str(Path(__file__).parents[2]))

import corpus_pipeline  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_dedup_ids_with_several_texts(spark):
    other, copy = " ".join(f"v{i}" for i in range(60)), PROSE + " again"
    rows = [(1, PROSE), (2, copy), (2, other), (2, other), (3, other.upper()), (4, "one two"), (4, "three four five"),
            (5, ""), (5, " "), (5, None), (6, PROSE), (6, PROSE.upper()), (7, "alone"), (7, "ALONE"), (None, PROSE), (None, PROSE)]
    table = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, X_hash string")
    out = corpus_pipeline.dedup(spark, table, SF)
    assert out.columns == table.columns
    got = Counter((r.doc_id, (r.text or "").strip().lower()) for r in out.collect())
    assert got == Counter([(1, PROSE.lower()), (2, other), (4, "one two"), (4, "three four five"), (5, ""), (7, "alone"), (None, PROSE.lower()), (None, PROSE.lower())])
