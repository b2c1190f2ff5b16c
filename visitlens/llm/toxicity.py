"""Toxicity by weak supervision: many voters, a generative label model, a linear classifier on its posteriors.

Voters: lexicons of words and word beginnings, mined from a labelled sample and dealt over several voters, and
patterns of writing that need no labels. The label model is a latent class model whose voters depend on the class
and, where the data show it, on one other voter each (a forest of correlations); expectation maximisation
estimates accuracies and correlations from labelled and unlabelled sample rows alike, the human label being one more
voter that most rows lack. A logistic classifier on terms and votes is trained on the posterior labels.

Only the fitting sample is bounded (parameters below). All documents are scored, from whole texts, without a shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import _LOWER, HashIndex, append_from_text, cuts, id_text, materialize, mix64, span_hashes

#: Labelled rows of each class and unlabelled rows to fit on; most terms; lexicon voters of each family of terms.
SAMPLE, UNLABELLED, TERMS, LEXICONS = 4000, 4000, 4096, 6
#: Terms are whole words and their first bytes.
PREFIXES = (4, 5, 6)
#: A lexicon's term must be this much likelier in toxic rows, as share of balanced classes.
PRECISION = 0.9
#: Weight of squares of the classifier's coefficients.
RIDGE = 2e-4
#: Chance that the human label of a row is right; the one accuracy that isn't estimated, as all others hang on it.
TRUST = 0.9999

_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), *range(128, 256)]] = True
_UPPER, _LETTER, _DIGIT = (np.zeros(256, bool) for _ in range(3))
_UPPER[65:91] = _LETTER[65:91] = _LETTER[97:123] = _DIGIT[48:58] = True
_MASK = np.zeros(256, bool)
_MASK[list(b"#*$%@")] = True
PATTERNS = ("shouting", "repeated_marks", "masked_word", "digits_in_word", "stretched_word", "short")


def _starts(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(all bytes with a line feed after each text, where each text ends)."""
    blobs = [t.encode() for t in texts]
    return np.frombuffer(b"\n".join(blobs) + b"\n", np.uint8), np.cumsum([len(b) + 1 for b in blobs])


def terms(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, text's place, family) of every word and word beginning; words are runs of letters, digits and bytes from 128."""
    raw, ends = _starts(texts)
    raw = _LOWER[raw]
    inside = _WORD[raw]
    before = np.concatenate(([False], inside[:-1]))
    begin, end = np.flatnonzero(inside & ~before), np.flatnonzero(before & ~inside)
    begins, stops, kinds = [begin], [end], [np.zeros(len(begin), np.uint64)]
    for k, n in enumerate(PREFIXES, 1):
        long = begin[end - begin > n]
        begins.append(long)
        stops.append(long + n)
        kinds.append(np.full(len(long), k, np.uint64))
    first, kind = np.concatenate(begins), np.concatenate(kinds)
    hashes = mix64(span_hashes(raw, first, np.concatenate(stops)) + kind)
    return hashes, np.searchsorted(ends, first, side="right"), kind.astype(np.int64)


def patterns(texts: list[str]) -> np.ndarray:
    """A row per text: which patterns of writing it shows."""
    raw, ends = _starts(texts)
    begins = np.concatenate(([0], ends[:-1]))

    def count(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags)))
        return sums[ends] - sums[begins]

    def follows(flags: np.ndarray, by: int) -> np.ndarray:
        return np.concatenate((flags[by:], np.zeros(by, bool)))

    letter, digit, mark, masked = _LETTER[raw], _DIGIT[raw], (raw == 33) | (raw == 63), _MASK[raw]
    same = np.concatenate((raw[1:] == raw[:-1], [False]))
    word = _WORD[_LOWER[raw]]
    n_words = count(word & ~np.concatenate(([False], word[:-1])))
    n_letters = count(letter)
    return np.stack([
        (count(_UPPER[raw]) > 0.3 * n_letters) & (n_letters >= 20),
        count(mark & follows(mark, 1)) > 0,
        count(letter & follows(masked, 1) & follows(masked, 2)) > 0,
        count(letter & follows(digit, 1) & follows(letter, 2)) > 0,
        count(letter & same & follows(same, 1)) > 0,
        n_words < 30], axis=1)


# ---------------------------------------------------------------- the label model
@dataclass(frozen=True)
class LabelModel:
    """Class share, and per voter the one it depends on (-1: none) and P(vote | class, that voter's vote)."""
    share: float
    parent: np.ndarray
    fires: np.ndarray  # voter x class x parent's vote

    def posterior(self, votes: np.ndarray, labels: np.ndarray) -> np.ndarray:
        """P(class 1) of each row; labels: 0, 1, or -1 where there is none."""
        logs = np.tile(np.log([1 - self.share, self.share]), (len(votes), 1))
        for j, p in enumerate(self.parent):
            other = votes[:, p] if p >= 0 else np.zeros(len(votes), np.int64)
            chance = self.fires[j][:, other].T
            logs += np.log(np.where(votes[:, j:j + 1] == 1, chance, 1 - chance))
        known = labels >= 0
        logs[known] += np.log(np.where(labels[known, None] == [0, 1], TRUST, 1 - TRUST))
        return 1 / (1 + np.exp(np.clip(logs[:, 0] - logs[:, 1], -700, 700)))


def _estimate(votes: np.ndarray, post: np.ndarray, parent: np.ndarray) -> LabelModel:
    weight = np.stack([1 - post, post], axis=1)
    fires = np.empty((votes.shape[1], 2, 2))
    for j, p in enumerate(parent):
        for other in (0, 1):
            here = weight if p < 0 else weight * (votes[:, p:p + 1] == other)
            fires[j, :, other] = (here[votes[:, j] == 1].sum(axis=0) + 0.1) / (here.sum(axis=0) + 1)
    return LabelModel(float((post.sum() + 0.1) / (len(post) + 1)), parent, fires)


def _forest(votes: np.ndarray, post: np.ndarray, least: float = 0.005) -> np.ndarray:
    """Each voter's parent in a maximum spanning forest of mutual information given the class."""
    n, m = votes.shape
    gain = np.zeros((m, m))
    for w in (1 - post, post):
        total = w.sum() + 1e-9
        both = (votes * w[:, None]).T @ votes / total
        one = np.diag(both)
        for x, y, joint in ((1, 1, both), (1, 0, one[:, None] - both), (0, 1, one[None, :] - both), (0, 0, 1 - one[:, None] - one[None, :] + both)):
            alone = np.outer(one if x else 1 - one, one if y else 1 - one)
            joint = np.clip(joint, 1e-12, None)
            gain += total / n * joint * np.log(joint / np.clip(alone, 1e-12, None))
    parent = np.full(m, -1)
    done, best, link = np.zeros(m, bool), np.zeros(m), np.full(m, -1)
    for _ in range(m):  # Prim's algorithm; a voter without a good link begins a new tree
        j = int(np.argmax(np.where(done, -1, best)))
        parent[j], done[j] = (link[j] if best[j] > least else -1), True
        better = ~done & (gain[j] > best)
        best[better], link[better] = gain[j][better], j
    return parent


def label_model(votes: np.ndarray, labels: np.ndarray, rounds: int = 30) -> tuple[LabelModel, np.ndarray]:
    """(model, posterior): accuracies first, then correlations and accuracies, by expectation maximisation.

    It starts from the labels, so that class 1 is theirs; rows without one start at the share of those with.
    """
    votes = votes.astype(np.int64)
    known = labels >= 0
    start = (labels[known].sum() + 0.5) / (known.sum() + 1)
    post = np.where(known, np.where(labels == 1, 0.98, 0.02), start)
    parent = np.full(votes.shape[1], -1)
    first = known if known.any() else np.ones(len(votes), bool)
    model = _estimate(votes[first], post[first], parent)
    for step in range(2):
        for _ in range(rounds):
            post = model.posterior(votes, labels)
            model = _estimate(votes, post, parent)
        if step == 0:
            parent = _forest(votes, post)
            model = _estimate(votes, post, parent)
    return model, model.posterior(votes, labels)


# ---------------------------------------------------------------- the linear classifier
def _minimise(loss, start: np.ndarray, steps: int = 200, kept: int = 8) -> np.ndarray:
    """Limited-memory quasi-Newton descent; ``loss`` gives value and gradient."""
    x, (value, slope) = start, loss(start)
    moves: list[tuple[np.ndarray, np.ndarray, float]] = []
    for _ in range(steps):
        d, alphas = slope.copy(), []
        for s, y, rho in reversed(moves):
            alphas.append(rho * (s @ d))
            d -= alphas[-1] * y
        if moves:
            s, y, _ = moves[-1]
            d *= (s @ y) / (y @ y)
        for (s, y, rho), alpha in zip(moves, reversed(alphas)):
            d += (alpha - rho * (y @ d)) * s
        step, down = 1.0 if moves else 1 / max(1.0, float(np.abs(slope).sum())), slope @ d
        while True:
            new = x - step * d
            new_value, new_slope = loss(new)
            if new_value <= value - 1e-4 * step * down or step < 1e-10:
                break
            step /= 2
        s, y = new - x, new_slope - slope
        if s @ y > 1e-14:
            moves = [*moves[1 - kept:], (s, y, 1 / (s @ y))]
        done = value - new_value < 1e-9
        x, value, slope = new, new_value, new_slope
        if done:
            break
    return x


def logistic(doc: np.ndarray, term: np.ndarray, dense: np.ndarray, target: np.ndarray, n_terms: int, ridge: float = RIDGE) -> np.ndarray:
    """Coefficients (terms, dense columns, constant) for soft targets; (doc, term): which terms a row has."""
    n, m = dense.shape

    def loss(w: np.ndarray) -> tuple[float, np.ndarray]:
        z = np.bincount(doc, w[term], n) + dense @ w[n_terms:-1] + w[-1]
        chance = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
        value = (np.logaddexp(0, z) - target * z).mean() + ridge / 2 * (w[:-1] @ w[:-1])
        error = (chance - target) / n
        slope = np.concatenate([np.bincount(term, error[doc], n_terms), dense.T @ error, [error.sum()]])
        slope[:-1] += ridge * w[:-1]
        return value, slope

    return _minimise(loss, np.zeros(n_terms + m + 1))


@dataclass(frozen=True)
class Toxicity:
    """The fitted classifier: term hashes, the lexicon each belongs to (-1: none), coefficients; ``prior`` alone if nothing was learned."""
    keys: np.ndarray
    lexicon: np.ndarray
    n_lexicons: int
    weights: np.ndarray
    prior: float

    def features(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text's place, term) of every known term that a text has, and all voters' votes."""
        hashes, owner, _ = terms(texts)
        index = HashIndex(self.keys)
        at = index.find(hashes)
        hit = at >= 0
        pairs = np.unique(owner[hit] * max(1, len(self.keys)) + at[hit])
        doc, term = np.divmod(pairs, max(1, len(self.keys)))
        votes = np.zeros((len(texts), self.n_lexicons + len(PATTERNS)), np.int64)
        named = self.lexicon[term] >= 0
        votes[doc[named], self.lexicon[term[named]]] = 1
        if len(texts):
            votes[:, self.n_lexicons:] = patterns(texts)
        return doc, term, votes

    def score(self, texts: list[str]) -> np.ndarray:
        """P(label 1) of each text."""
        if not len(self.weights):
            return np.full(len(texts), self.prior)
        doc, term, votes = self.features(texts)
        n = len(self.keys)
        z = np.bincount(doc, self.weights[term], len(texts)) + votes @ self.weights[n:-1] + self.weights[-1]
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))


# ---------------------------------------------------------------- fitting on Spark
def _sample(docs: DataFrame, labels: DataFrame, training: Column, sample: int, unlabelled: int, label_col: str) -> DataFrame:
    """text, label (null: none): at most ``sample`` rows of each class and ``unlabelled`` others, near copies mostly left out."""
    known = (labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label_col).cast("int").alias("label"))
             .filter(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull()).filter(training)
             .groupBy("doc_id").agg(F.max("label").alias("label")))
    texts = id_text(docs)
    order = F.xxhash64("doc_id", F.lit(23))
    ids = texts.select("doc_id").filter(F.col("doc_id").isNotNull()).filter(training)
    others = ids.join(known, "doc_id", "left_anti").orderBy(order, "doc_id").limit(unlabelled).distinct().withColumn("label", F.lit(None).cast("int"))
    chosen = [known.filter(F.col("label") == v).orderBy(order, "doc_id").limit(sample) for v in (0, 1)] + [others]
    chosen = F.broadcast(chosen[0].unionByName(chosen[1]).unionByName(chosen[2]))  # 2 * sample + unlabelled rows at most

    def marks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Two smallest hashes of three terms in a row: near copies share at least one of them as a rule."""
        for batch in batches:
            for a, b in cuts(batch.column(0), 1 << 20):
                texts = batch.column(0).slice(a, b - a).to_pylist()
                hashes, owner, kind = terms(texts)
                hashes, owner = hashes[kind == 0], owner[kind == 0]
                out = np.zeros((2, len(texts)), np.int64)
                for k, (x, y) in enumerate(zip(np.searchsorted(owner, np.arange(len(texts))), np.searchsorted(owner, np.arange(len(texts)), "right"))):
                    w = hashes[x:y]
                    with np.errstate(over="ignore"):
                        rows = mix64(w[:-2] + w[1:-1] * np.uint64(3) + w[2:] * np.uint64(7)) if len(w) > 2 else w
                    if len(rows):
                        out[0, k], out[1, k] = rows.min().astype(np.int64), mix64(rows).min().astype(np.int64)
                yield pa.RecordBatch.from_arrays([*(c.slice(a, b - a) for c in batch.columns), *map(pa.array, out)],
                                                 names=["text", "label", "doc_id", "mark0", "mark1"])

    rows = texts.join(chosen, "doc_id").select("text", "label", "doc_id").mapInArrow(marks, "text string, label int, doc_id long, mark0 long, mark1 long")
    for mark in ("mark0", "mark1"):  # of rows with one mark and label, the one with the least id stays
        rows = rows.groupBy(mark, "label").agg(F.min(F.struct("doc_id", *{"mark0", "mark1"} - {mark}, "text")).alias("first")).select(mark, "label", "first.*")
    return materialize(rows.select("text", "label"), "toxicity-sample")


def _term_counts(sample: DataFrame) -> DataFrame:
    """term, family, toxic, clean: sample texts of each label that hold the term."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            labels = np.asarray(batch.column(1))
            for a, b in cuts(batch.column(0), 1 << 20):
                hashes, owner, kind = terms(batch.column(0).slice(a, b - a).to_pylist())
                order = np.lexsort((owner, hashes))
                hashes, owner, kind = hashes[order], owner[order], kind[order]
                new = np.ones(len(hashes), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
                hashes, toxic, kind = hashes[new], labels[a:b][owner[new]], kind[new]
                at = np.flatnonzero(np.concatenate(([True], hashes[1:] != hashes[:-1]))) if len(hashes) else np.zeros(0, int)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes[at].astype(np.int64)), pa.array(kind[at], pa.int32()),
                     *(pa.array(np.add.reduceat(toxic == v, at, dtype=np.int64) if len(at) else np.zeros(0, np.int64)) for v in (1, 0))],
                    names=["term", "family", "toxic", "clean"])

    rows = sample.filter(F.col("label").isNotNull()).select("text", "label")
    return (rows.mapInArrow(run, "term long, family int, toxic long, clean long")
            .groupBy("term", "family").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")))


def fit(docs: DataFrame, labels: DataFrame, training: Column, sample: int = SAMPLE, unlabelled: int = UNLABELLED,
        n_terms: int = TERMS, label_col: str = "toxic") -> Toxicity:
    """Fit on at most ``sample`` labelled rows of each class and ``unlabelled`` others (the first by a hash of the id).

    ``training``: a condition on doc_id that all of them meet. Labels that are null or neither 0 nor 1 teach nothing; of an
    id with several the greatest counts. Only ``n_terms`` term hashes and the sample's rows of them come to
    the driver. Without labelled rows of both classes every score is the share of label 1 (0 without any).
    """
    rows = _sample(docs, labels, training, sample, unlabelled, label_col)
    n = {r.label: r.n for r in rows.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    n1, n0 = n.get(1, 0), n.get(0, 0)
    if not n1 or not n0:
        return Toxicity(np.zeros(0, np.uint64), np.zeros(0, np.int64), 0, np.zeros(0), float(n1 > 0))
    # two more clean rows than seen, so that rare terms must earn their place
    share = (F.col("toxic") / n1) / ((F.col("clean") + 2) / n0)
    best = (_term_counts(rows).filter(F.col("toxic") > 1).withColumn("lift", share).filter("lift > 2")
            .withColumn("gain", F.col("toxic") * F.log("lift")).orderBy(F.desc("gain"), "term", "family").limit(n_terms).collect())
    best = list({r.term: r for r in best}.values())
    keys = np.array([r.term for r in best], np.int64).astype(np.uint64)
    n_lexicons = LEXICONS * (1 + len(PREFIXES))
    lexicon = np.array([r.family * LEXICONS + int(mix64(np.array([r.term], np.int64).astype(np.uint64))[0] % np.uint64(LEXICONS))
                        if r.lift / (1 + r.lift) >= PRECISION else -1 for r in best], np.int64)
    model = Toxicity(keys, lexicon, n_lexicons, np.zeros(0), n1 / (n1 + n0))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in cuts(batch.column(0), 1 << 20):
                doc, term, votes = model.features(batch.column(0).slice(a, b - a).to_pylist())
                at = np.searchsorted(doc, np.arange(b - a + 1))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1).slice(a, b - a), pa.array([term[x:y].astype(np.int32).tobytes() for x, y in zip(at, at[1:])], pa.binary()),
                     pa.array([v.astype(np.uint8).tobytes() for v in votes], pa.binary())], names=["label", "terms", "votes"])

    got = rows.select("text", "label").mapInArrow(run, "label int, terms binary, votes binary").collect()
    got.sort(key=lambda r: (r.label is None, r.label, bytes(r.terms), bytes(r.votes)))
    known = np.array([-1 if r.label is None else r.label for r in got])
    votes = np.array([np.frombuffer(bytes(r.votes), np.uint8) for r in got]).astype(np.int64)
    term = np.concatenate([np.frombuffer(bytes(r.terms), np.int32) for r in got]).astype(np.int64)
    doc = np.repeat(np.arange(len(got)), [len(bytes(r.terms)) // 4 for r in got])
    _, post = label_model(votes, known)
    return Toxicity(keys, lexicon, n_lexicons, logistic(doc, term, votes.astype(float), post, len(keys)), model.prior)


def score(docs: DataFrame, model: Toxicity) -> DataFrame:
    """doc_id, score: a row for each row of ``docs`` (null text: empty), null ids and repeated rows included.

    An empty table gives none; other columns are ignored. Very long texts are scored whole; an empty text has the
    score of a text without any term.
    """
    sent = docs.sparkSession.sparkContext.broadcast(model)
    return append_from_text(id_text(docs), lambda texts: [pa.array(sent.value.score(texts))], "score double").drop("text")
