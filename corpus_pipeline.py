"""The corpus pipeline: classify, apply rules, drop near-duplicates, pack.

Counted as part of ``visitlens.llm``. ``STAGES`` lists the stages in order; each takes
(spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
one's docs. All stages but the last return documents with the input's columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm import near_dedup, packing, quality_knn, quality_rules
from visitlens.llm.common import fresh_path, fresh_prefix
from visitlens.llm.queries import KEEP_SCORE, byte_lengths, quality_model


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality classifier: documents scored below KEEP_SCORE go."""
    return quality_knn.keep_good(docs, quality_model(spark, sf_dir), KEEP_SCORE)


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Quality rules: documents that the newest policy rejects go."""
    return quality_rules.keep_passing(docs)


def dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """MinHash near-dedup on five-word shingles at 0.8: the document with the smallest id of each group stays, once.

    Rows are told apart by id and text: of an id with several texts, those that are alike stay
    once, and an unlike one is judged on its own. Documents without an id link with nothing and stay.
    """
    stay = near_dedup.survivors(docs, width=5, percent=80)
    mark = fresh_prefix(docs) + "hash"
    named = docs.filter(F.col("doc_id").isNotNull()).withColumn(mark, near_dedup.text_hash())
    kept = named.join(stay, (F.col("doc_id").cast("long") == F.col("stay_id")) & (F.col(mark) == F.col("stay_hash")), "left_semi")
    return kept.dropDuplicates(["doc_id", mark]).drop(mark).unionByName(docs.filter(F.col("doc_id").isNull()))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best-fit packing: a row for each piece of a document, with its sequence and place in it."""
    return packing.pack(byte_lengths(docs))


STAGES = [("quality_classifier", classify), ("quality_rules", rules), ("minhash_near_dedup", dedup), ("best_fit_packing", pack)]

#: SQL can't express the classifier's vectors, the sketches or the packing plan; tests/llm checks them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written under the shared checkpoint folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = fresh_path(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
