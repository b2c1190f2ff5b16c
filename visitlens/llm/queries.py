"""One registered query per operator over its whole table, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm import collocations, context_stream, embedding_dedup, near_dedup, packing, quality_knn, quality_rules, reply_trees, sentencepiece_fst, token_counts, token_files, toxicity, whitening
from visitlens.llm.common import fresh_path

#: Production parameters.
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
BYTE_MODEL = public_tokenizers.path("byte_bpe_50k.json")

#: Documents of at least this score are predicted good.
KEEP_SCORE = 0.7

#: Documents of at least this score are predicted toxic.
TOXIC_SCORE = 0.3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentencepiece_fst.round_trip(table(spark, sf_dir, "documents"), PIECE_MODEL)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), PIECE_MODEL, limit=4096)


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), width=4, percent=80)


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.apply_policy(quality_rules.ledger(table(spark, sf_dir, "documents")))


OP4_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT rid, doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(t, chr(10)), lambda l: regexp_matches(l, '[^\x20\x09-\x0D]')) AS ls FROM d),
win AS (
  SELECT rid, i, struct_pack(a := ws[i], b := ws[i + 1], c := ws[i + 2]) AS k
  FROM w, unnest(range(1, len(ws) - 1)) AS u(i)),
twice AS (SELECT rid, k FROM win GROUP BY rid, k HAVING count(*) > 1),
covered AS (
  SELECT rid, count(DISTINCT i + o) AS n FROM win JOIN twice USING (rid, k), (VALUES (0), (1), (2)) AS s(o) GROUP BY rid),
m AS (
  SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(list_sum([length(x) FOR x IN ws]), 0)::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(ls) - len(list_distinct(ls)))::BIGINT AS n_dup_lines, coalesce(n, 0)::BIGINT AS n_repeat_words, len(ls)::BIGINT AS n_lines
  FROM w LEFT JOIN covered USING (rid)),
b AS (
  SELECT *, (CASE WHEN n_words < 50 THEN 1 ELSE 0 END + CASE WHEN 100 * n_repeat_words > 50 * n_words THEN 2 ELSE 0 END
    + CASE WHEN 100 * n_symbols > 15 * n_words THEN 4 ELSE 0 END + CASE WHEN 100 * n_dup_lines > 10 * n_words THEN 8 ELSE 0 END
    + CASE WHEN word_chars < 2 * n_words THEN 16 ELSE 0 END + CASE WHEN word_chars > 20 * n_words THEN 32 ELSE 0 END
    + CASE WHEN 100 * n_dup_lines > 40 * n_lines THEN 64 ELSE 0 END)::BIGINT AS failed
  FROM m)
SELECT *, failed & 3 <> 0 AS base_failed, failed = 0 AS kept FROM b
"""


def byte_lengths(docs: DataFrame) -> DataFrame:
    """Lengths for packing: a byte-level model's tokens (UTF-8 bytes) and one end; nothing for a null or empty text."""
    n = F.octet_length("text").cast("long")
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.when(n > 0, n + 1).alias("length"))


def token_lengths(docs: DataFrame, path: str = BYTE_MODEL) -> DataFrame:
    """Lengths for packing: a model's tokens and one end; nothing for a null or empty text."""
    n = F.col("n_tokens")
    return token_files.lengths(docs, path).select("doc_id", F.when(n > 0, n + 1).alias("length"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(token_lengths(table(spark, sf_dir, "documents")))


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"), at_least=0.95)


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fresh_path(spark, "token-files")
    token_files.write(table(spark, sf_dir, "documents"), BYTE_MODEL, out, end_id=0)
    return token_files.read(spark, out)


def op8_context_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = context_stream.score(table(spark, sf_dir, "documents"), id_remainder(7) != 2)
    return scored.select("doc_id", (id_remainder(7) == 2).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score", "bits_per_byte")


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and conversation -7, whose texts hold the format's control strings."""
    odd = "\\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", odd), (-7, 1, "assistant", odd)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text").unionByName(extra)
    return reply_trees.digests(reply_trees.conversations(reply_trees.chain_messages(rows)))


def id_remainder(n: int) -> Column:
    """crc32 of the id as text, modulo n."""
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % F.lit(n)


def quality_model(spark: SparkSession, sf_dir: str) -> quality_knn.Voters:
    """Learned from the labelled rows of ``documents`` whose remainder isn't 2."""
    return quality_knn.fit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), id_remainder(4) != 2)


def op10_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality_knn.score(table(spark, sf_dir, "documents"), quality_model(spark, sf_dir))
    return scored.select("doc_id", (id_remainder(4) == 2).alias("held_out"), "score",
                         (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"))


def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, table(spark, sf_dir, "labels"), id_remainder(4) != 2))
    return scored.select("doc_id", (id_remainder(4) == 2).alias("held_out"), "score",
                         (F.col("score") >= TOXIC_SCORE).cast("int").alias("predicted"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"), least=100, most=5, top=2000)


OP12_SQL = r"""
WITH t AS (
  SELECT coalesce(lang, 'und') AS lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
p AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS p FROM t),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws FROM p),
g AS (
  SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS s
  FROM w, unnest(range(1, 6)) AS a(k), unnest(range(1, len(ws) - k + 2)) AS b(i)),
f AS (SELECT lang, k, s, count(*) AS f FROM g GROUP BY lang, k, s),
n AS (SELECT lang, sum(f)::BIGINT AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT lang, k, s, f AS a, string_split(s, ' ') AS ws FROM f WHERE k > 1 AND f >= 100),
sub AS (
  SELECT lang, array_to_string(ws[i:i + m - 1], ' ') AS s, max(a) AS g
  FROM c, unnest(range(2, k)) AS x(m), unnest(range(1, k - m + 2)) AS y(i) GROUP BY ALL),
cut AS (
  SELECT c.lang, c.s, c.a, j, l.f AS l, r.f AS r, n.n, (1000::HUGEINT * c.a * n.n) // (l.f::HUGEINT * r.f) AS score
  FROM c LEFT JOIN sub ON sub.lang = c.lang AND sub.s = c.s, unnest(range(1, c.k)) AS z(j)
  JOIN f l ON l.lang = c.lang AND l.s = array_to_string(c.ws[1:j], ' ')
  JOIN f r ON r.lang = c.lang AND r.s = array_to_string(c.ws[j + 1:c.k], ' ')
  JOIN n ON n.lang = c.lang
  WHERE sub.g IS NULL OR 100 * sub.g < 100 * c.a),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, s ORDER BY score, j) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, s) AS rank FROM best)
SELECT lang, rank::BIGINT AS rank, s AS phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked WHERE rank <= 2000
"""


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    model = whitening.fit(vectors, components=32, scale=64.0, offset=1_000_000)
    return whitening.by_component(whitening.whiten(vectors, model), model)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_sentencepiece": op1_sentencepiece,
    "op2_token_counts": op2_token_counts,
    "op3_near_dedup": op3_near_dedup,
    "op4_quality_rules": op4_quality_rules,
    "op5_packing": op5_packing,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_token_files": op7_token_files,
    "op8_context_tree": op8_context_tree,
    "op9_chat_format": op9_chat_format,
    "op10_quality_classifier": op10_quality_classifier,
    "op11_toxicity": op11_toxicity,
    "op12_collocations": op12_collocations,
    "op13_whitening": op13_whitening,
}

#: Queries that SQL can express; the others are tested against brute force in tests/llm.
ORACLE: dict[str, str] = {"op4_quality_rules": OP4_SQL, "op12_collocations": OP12_SQL}
