"""Quality scores by nearest-neighbour voting in a latent-semantic space.

Every document becomes a vector of hashed features. Terms: its words and pairs of words. Style: sequences of byte kinds,
marks and measures of repetition, word length, case and size. All are bounded, dampened frequencies, weighted by
inverse document frequency. A truncated SVD of the labelled sample's weighted vectors gives the latent space, in which
terms that occur in the same documents lie together. The sample's latent vectors (a bounded table) are broadcast;
each document's exact cosines with all of them come from blocked matrix products, and the nearest ones vote with
their similarity.

Only the sample of labelled rows is bounded (``sample`` rows of each class, a parameter): it
is what a classifier may be fitted on. Scores are computed for all documents from whole texts.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import _SPACE, append_from_text, fresh_prefix, id_text, mix64, text_slices, word_hashes

#: Labelled rows of each class to fit on, hashed features of style and of terms, latent dimensions, voting neighbours.
SAMPLE, STYLE, TERMS, LATENT, NEIGHBOURS = 1500, 1024, 3072, 64, 25
FEATURES = STYLE + TERMS
#: Weights of words and of pairs of words beside those of style, which are 1 each.
WORD_WEIGHT, PAIR_WEIGHT = 0.5, 0.25
#: Documents in one block of cosines.
BLOCK = 512

#: Kinds of bytes: lower case, upper case, digit, white space, mark, any byte of a longer character.
_KIND = np.full(256, 4, np.uint8)
_KIND[97:123], _KIND[65:91], _KIND[48:58], _KIND[128:] = 0, 1, 2, 5
_KIND[_SPACE] = 3


def _bucket(values: np.ndarray, family: int) -> np.ndarray:
    return (mix64(values.astype(np.uint64) + np.uint64(family << 40)) % np.uint64(STYLE)).astype(np.int64)


def _terms(values: np.ndarray) -> np.ndarray:
    return STYLE + (mix64(values) % np.uint64(TERMS)).astype(np.int64)


def features(texts: list[str]) -> np.ndarray:
    """One row per text of square roots of feature shares; an empty text has a feature of its own.

    Families: words and pairs of words (A-Z lower-cased), sequences of four byte kinds, single marks, and bounded measures (shares of
    distinct word pairs, of words equal to the one before, of distinct words, mean word
    length, upper case, marks a word, number of words), each spread over the two nearest of
    its grid points.
    """
    out = np.zeros((len(texts), FEATURES))
    if not texts:
        return out
    blobs = [t.encode() for t in texts]
    raw = np.frombuffer(b"\n".join(blobs) + b"\n", np.uint8)
    ends = np.cumsum([len(b) + 1 for b in blobs])
    kinds = _KIND[raw].astype(np.int64)
    owner = np.repeat(np.arange(len(texts)), [len(b) + 1 for b in blobs])
    n_bytes = np.array([len(b) for b in blobs])

    def add(buckets: np.ndarray, who: np.ndarray, weight: float) -> None:
        """Shares of the values' buckets within their texts."""
        total = np.bincount(who, minlength=len(texts))
        places, times = np.unique(who * FEATURES + buckets, return_counts=True)
        out.ravel()[places] += weight * times / total[places // FEATURES]

    if len(raw) > 3:
        grams = ((kinds[:-3] * 6 + kinds[1:-2]) * 6 + kinds[2:-1]) * 6 + kinds[3:]
        inside = owner[:-3] == owner[3:]
        add(_bucket(grams[inside], 1), owner[:-3][inside], 1.0)
    marks = kinds == 4
    add(_bucket(raw[marks], 2), owner[marks], 1.0)
    hashes, starts = word_hashes(texts)
    n_words = np.diff(starts)
    whose = np.repeat(np.arange(len(texts)), n_words)
    add(_terms(hashes), whose, WORD_WEIGHT)
    if len(hashes) > 1:
        beside = whose[1:] == whose[:-1]
        with np.errstate(over="ignore"):
            add(_terms((hashes[:-1] * np.uint64(3) + hashes[1:])[beside]), whose[1:][beside], PAIR_WEIGHT)

    def measure(family: int, values: np.ndarray, steps: int, there: np.ndarray) -> None:
        """A value in 0 to 1 as weights of the two nearest of ``steps`` grid points."""
        at = np.clip(values, 0, 1) * (steps - 1)
        low = np.floor(at).astype(np.int64)
        rows = np.flatnonzero(there)
        for point, share in ((low, 1 - (at - low)), (np.minimum(low + 1, steps - 1), at - low)):
            np.add.at(out, (rows, _bucket(point[rows], family)), share[rows])

    words = np.maximum(n_words, 1)
    distinct, pairs = np.zeros(len(texts)), np.zeros(len(texts))
    for k, (a, b) in enumerate(zip(starts[:-1].tolist(), starts[1:].tolist())):
        if b > a:
            distinct[k] = len(np.unique(hashes[a:b]))
            with np.errstate(over="ignore"):
                pairs[k] = len(np.unique(hashes[a:b - 1] * np.uint64(3) + hashes[a + 1:b]))
    same = np.zeros(len(texts))
    if len(hashes) > 1:
        again = (hashes[1:] == hashes[:-1]) & (whose[1:] == whose[:-1])
        same = np.bincount(whose[1:][again], minlength=len(texts)).astype(float)
    space_before = np.concatenate(([0], np.cumsum(kinds == 3)))
    spaces = space_before[ends] - space_before[ends - n_bytes - 1]
    upper_before = np.concatenate(([0], np.cumsum(kinds == 1)))
    letters_before = np.concatenate(([0], np.cumsum(kinds < 2)))
    upper = upper_before[ends] - upper_before[ends - n_bytes - 1]
    letters = letters_before[ends] - letters_before[ends - n_bytes - 1]
    marks_before = np.concatenate(([0], np.cumsum(marks)))
    n_marks = marks_before[ends] - marks_before[ends - n_bytes - 1]
    some, several = n_words > 0, n_words > 1
    # repetition is judged against how much of it a text of this length has anyway
    measure(11, pairs / np.maximum(n_words - 1, 1), 9, several)
    measure(12, same / np.maximum(n_words - 1, 1), 9, several)
    measure(13, np.log1p(np.maximum(n_bytes - spaces, 0) / words) / 4, 17, some)
    measure(14, upper / np.maximum(letters, 1), 9, letters > 0)
    measure(15, n_marks / words / 2, 17, some)
    measure(16, distinct / words, 5, several)
    measure(17, np.log1p(n_words) / 12, 7, some)
    out[~some, 0] += 1.0
    return np.sqrt(out)


@dataclass(frozen=True)
class Voters:
    """The fitted classifier: latent projection, labelled latent vectors (rows of length one) and their labels."""
    weights: np.ndarray
    projection: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    prior: float

    def latent(self, rows: np.ndarray) -> np.ndarray:
        z = (rows * self.weights) @ self.projection
        return (z / np.maximum(np.sqrt((z * z).sum(axis=1, keepdims=True)), 1e-12)).astype(np.float32)

    def score(self, rows: np.ndarray) -> np.ndarray:
        """Similarity-weighted share of label 1 among the nearest; classes weigh as if equally many."""
        out = np.full(len(rows), self.prior)
        if not len(self.labels):
            return out
        k = min(NEIGHBOURS, len(self.labels))
        for at in range(0, len(rows), BLOCK):
            near = self.latent(rows[at:at + BLOCK]) @ self.vectors.T
            top = np.argpartition(-near, k - 1, axis=1)[:, :k] if k < near.shape[1] else np.tile(np.arange(k), (len(near), 1))
            votes = np.clip(np.take_along_axis(near, top, axis=1), 0, None).astype(np.float64) ** 8 + 1e-12
            out[at:at + BLOCK] = (votes * self.labels[top]).sum(axis=1) / votes.sum(axis=1)
        return np.clip(out, 0, 1)


def _leading(scaled: np.ndarray, most: int) -> np.ndarray:
    """The leading right singular vectors as columns, by subspace iteration from a fixed start."""
    start = np.random.default_rng(7).standard_normal((scaled.shape[1], min(most + 16, *scaled.shape))).astype(scaled.dtype)
    basis = np.linalg.qr(start)[0]
    for _ in range(8):
        basis = np.linalg.qr(scaled.T @ (scaled @ basis))[0]
    values, turn = np.linalg.eigh((b := scaled @ basis).T @ b)
    keep = min(most, int((values > 1e-6 * values[-1]).sum()) or 1)
    return (basis @ turn[:, ::-1][:, :keep]).astype(np.float64)


def fit_vectors(rows: np.ndarray, labels: np.ndarray, latent: int = LATENT) -> Voters:
    """Weights (rare features count more: inverse document frequencies), SVD and latent vectors."""
    if not len(rows):
        return Voters(np.ones(FEATURES), np.zeros((FEATURES, 1)), np.zeros((0, 1), np.float32), np.zeros(0), 0.5)
    weights = np.log((1 + len(rows)) / (1 + (rows > 0).sum(axis=0))) + 1
    projection = _leading((rows * weights).astype(np.float32), latent)
    model = Voters(weights, projection, np.zeros((0, projection.shape[1]), np.float32), np.zeros(0), float(labels.mean()))
    return Voters(weights, projection, np.concatenate([model.latent(rows[a:a + BLOCK]) for a in range(0, len(rows), BLOCK)]),
                  labels.astype(np.float64), model.prior)


def _feature_rows(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = batch.column(2)
            at = 0
            for ids, texts in text_slices([batch.select([0, 1])], 1 << 20):
                rows = features(texts).astype(np.float32)
                yield pa.RecordBatch.from_arrays([ids, labels.slice(at, len(texts)), pa.array([zlib.compress(r.tobytes(), 1) for r in rows], pa.binary())], names=["doc_id", "label", "row"])
                at += len(texts)

    return docs.select("doc_id", "text", "label").mapInArrow(run, "doc_id long, label int, row binary")


def fit(docs: DataFrame, labels: DataFrame, training: Column, sample: int = SAMPLE, label_col: str = "quality") -> Voters:
    """Fit on at most ``sample`` rows of each label (the first by a hash of the id) among ``training`` rows.

    ``training``: a condition on doc_id. Rows whose label is null or neither 0 nor 1 teach
    nothing; of an id with several labels the greatest counts. Only the sample's hashed feature rows (2 * sample *
    FEATURES numbers) come to the driver. Without any labelled row, every score is 0.5.
    """
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
             .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).filter(training)
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    order = F.xxhash64("doc_id", F.lit(11))
    chosen = [known.filter(F.col("label") == v).orderBy(order, "doc_id").limit(sample) for v in (0, 1)]
    chosen = F.broadcast(chosen[0].unionByName(chosen[1]))  # at most 2 * sample rows
    rows = _feature_rows(id_text(docs).join(chosen, "doc_id")).dropDuplicates(["doc_id"]).collect()
    rows.sort(key=lambda r: r.doc_id)
    matrix = np.frombuffer(b"".join(zlib.decompress(bytes(r.row)) for r in rows), np.float32).reshape(-1, FEATURES)
    return fit_vectors(matrix, np.array([r.label for r in rows], np.float64))


def score(docs: DataFrame, model: Voters) -> DataFrame:
    """doc_id, score: a row for each row of ``docs`` (null text: empty), null ids and repeated rows included.

    An empty table gives none; other columns are ignored. Very long texts are scored whole.
    """
    return _scored(id_text(docs), model, "score").drop("text")


def _scored(docs: DataFrame, model: Voters, name: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return append_from_text(docs, lambda texts: [pa.array(sent.value.score(features(texts)))], f"{name} double")


def keep_good(docs: DataFrame, model: Voters, at_least: float) -> DataFrame:
    """The rows of ``docs``, all columns as they are, with at least this score. No shuffle."""
    name = fresh_prefix(docs) + "score"
    return _scored(docs, model, name).filter(F.col(name) >= at_least).select(*docs.columns)
