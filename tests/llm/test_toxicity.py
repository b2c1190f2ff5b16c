"""Toxicity: the label model on made voters, scores against a plain version, held-out rows, awkward rows."""

import re

import numpy as np
import pytest
from helpers import AWKWARD, LOWER, docs, empty

from visitlens.llm import toxicity as tox
from visitlens.llm.queries import TOXIC_SCORE, id_remainder, op11_toxicity, table

SF = "/root/testdata/sf0.01"
BENCH = "/root/testdata/sf0.1"


def voters(n, seed):
    """Rows of a hidden class, five voters of known accuracy and three copies of a poor one."""
    g = np.random.default_rng(seed)
    y = (g.random(n) < 0.3).astype(int)
    chances = [(0.05, 0.8), (0.1, 0.7), (0.02, 0.6), (0.15, 0.75), (0.05, 0.5)]
    columns = [g.random(n) < np.where(y == 1, b, a) for a, b in chances]
    poor = g.random(n) < np.where(y == 1, 0.45, 0.3)
    columns += [poor ^ (g.random(n) < 0.02) for _ in range(3)]
    return y, np.stack(columns, axis=1).astype(int), chances


def test_label_model_finds_accuracies_and_correlations():
    y, votes, chances = voters(20_000, 4)
    labels = np.where(np.arange(len(y)) < 60, y, -1)  # a few rows say which class is which
    model, post = tox.label_model(votes, labels)
    assert abs(model.share - 0.3) < 0.02
    for j, (a, b) in enumerate(chances):
        if model.parent[j] < 0:
            assert abs(model.fires[j, 0, 0] - a) < 0.03 and abs(model.fires[j, 1, 0] - b) < 0.04
    # the three copies hang together, and on no good voter
    assert {j for j in (5, 6, 7) if model.parent[j] in (5, 6, 7)} and sum(model.parent[j] in (5, 6, 7) for j in range(8)) == 2
    found = ((post > 0.5) == y).mean()
    alone = max(((votes[:, j] == y).mean() for j in range(8)))
    majority = ((votes.sum(axis=1) >= 4) == y).mean()
    assert found > max(alone, majority) + 0.02
    assert (np.abs(post[:60] - y[:60]) < 0.5).all()


def test_logistic_separates():
    g = np.random.default_rng(0)
    doc, term = np.repeat(np.arange(300), 5), g.integers(0, 40, 1500)
    y = np.bincount(doc, (term == 3).astype(float), 300) > 0
    w = tox.logistic(doc, term, np.zeros((300, 2)), np.where(y, 0.95, 0.05), 40, ridge=1e-4)
    z = np.bincount(doc, w[term], 300) + w[-1]
    assert ((z > 0) == y).all() and np.argmax(w[:40]) == 3


def plain_score(text, model):
    text = text or ""
    have = set()
    for w in set(re.findall(rb"[0-9a-z\x80-\xff]+", text.translate(LOWER).encode())):
        have |= set(tox.terms([w.decode()])[0].tolist())
    z, votes = model.weights[-1], set()
    for k, (key, lexicon) in enumerate(zip(model.keys.tolist(), model.lexicon.tolist())):
        if key in have:
            z += model.weights[k]
            votes |= {lexicon} - {-1}
    letters = re.findall("[A-Za-z]", text)
    fires = [len(letters) >= 20 and len(re.findall("[A-Z]", text)) > 0.3 * len(letters), re.search("[!?][!?]", text), re.search(r"[A-Za-z][#*$%@]{2}", text),
             re.search("[A-Za-z][0-9][A-Za-z]", text), re.search(r"([A-Za-z])\1\1", text),
             len(re.findall(rb"[0-9a-z\x80-\xff]+", text.translate(LOWER).encode())) < 30]
    votes |= {model.n_lexicons + k for k, f in enumerate(fires) if f}
    return 1 / (1 + np.exp(-(z + sum(model.weights[len(model.keys) + v] for v in votes))))


@pytest.fixture(scope="module")
def model(spark):
    return tox.fit(table(spark, SF, "documents"), table(spark, SF, "labels"), id_remainder(4) != 2)


def test_scores_against_plain_version(spark, model):
    rows = [(r.doc_id, r.text) for r in table(spark, SF, "documents").filter("doc_id % 40 = 0").collect()]
    rows += AWKWARD + [(70, "SHOUTING ALL THE WAY THROUGH THIS"), (71, "what?! idi0t foo*** sooo")]
    got = tox.score(docs(spark, rows), model).collect()
    assert [r.doc_id for r in got] == [i for i, _ in rows]
    for r, (_, t) in zip(got, rows):
        assert r.score == pytest.approx(plain_score(t, model), rel=1e-9)


def test_fit_is_repeatable(spark, model):
    again = tox.fit(table(spark, SF, "documents").repartition(7), table(spark, SF, "labels").repartition(3), id_remainder(4) != 2)
    assert (again.keys == model.keys).all() and np.allclose(again.weights, model.weights, atol=1e-6)


def test_held_out(spark):
    truth = {r.doc_id: r.toxic for r in table(spark, BENCH, "labels").collect()}
    out = op11_toxicity(spark, BENCH)
    assert dict(out.dtypes) == {"doc_id": "bigint", "held_out": "boolean", "score": "double", "predicted": "int"}
    rows = out.collect()
    assert len(rows) == table(spark, BENCH, "documents").count() and all(r.predicted == (r.score >= TOXIC_SCORE) for r in rows)
    held = [(r.score, r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    toxic, clean = [h for h in held if h[2] == 1], [h for h in held if h[2] == 0]
    wins = sum((a[0] > b[0]) + (a[0] == b[0]) / 2 for a in toxic for b in clean) / len(toxic) / len(clean)
    assert wins > 0.97 and np.mean([h[1] for h in toxic]) > 0.85 and np.mean([h[1] for h in clean]) < 0.02


def test_awkward_tables(spark):
    labels = spark.createDataFrame([(1, 1), (2, 0), (2, None), (None, 1), (5, 7), (2, 0), (99, 1)], "doc_id long, toxic int")
    out = tox.score(docs(spark), tox.fit(docs(spark), labels, id_remainder(4) >= 0)).collect()
    assert len(out) == len(AWKWARD) and all(0 <= r.score <= 1 for r in out)
    none = tox.fit(docs(spark), labels.limit(0), id_remainder(4) >= 0)
    assert {r.score for r in tox.score(docs(spark), none).collect()} == {0.0}
    assert tox.score(empty(spark), none).collect() == []
    assert tox.fit(empty(spark), labels, id_remainder(4) >= 0).prior == 0.0
    assert tox.score(empty(spark), tox.fit(docs(spark), labels, id_remainder(4) >= 0)).collect() == []
