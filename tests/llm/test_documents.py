import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import AWKWARD, PROSE, docs, empty, measures, roots, shingles
from visitlens.llm import near_dedup, quality_knn, quality_rules


def brute_components(rows, width, percent):
    """(id, set size, component) of each row with an id; equal results for equal rows."""
    named = [(i, shingles(t, width)) for i, t in rows if i is not None]
    links = [(a, b) for a in range(len(named)) for b in range(a) if named[a][1] and named[b][1]
             and 100 * len(named[a][1] & named[b][1]) >= percent * len(named[a][1] | named[b][1])]
    root = roots(len(named), links)
    least = {}
    for r, (i, _) in zip(root, named):
        least[r] = min(i, least.get(r, i))
    return [(i, len(s), least[r]) for r, (i, s) in zip(root, named)]


def check_near(spark, rows, width, percent=80):
    got = near_dedup.near_duplicates(docs(spark, rows), width, percent).collect()
    wanted = [(i, n, c, i == c) for i, n, c in brute_components(rows, width, percent)]
    wanted += [(None, len(shingles(t, width)), None, True) for i, t in rows if i is None]
    assert sorted(map(tuple, got), key=repr) == sorted(wanted, key=repr)


def test_near_duplicates_awkward(spark):
    check_near(spark, AWKWARD + [(20, "ONE"), (20, "two three"), (21, "two three")], 4)


def test_near_duplicates_group_of_near_copies(spark):
    """Copies of copies, many of them below the threshold with each other, more than one block of a cell."""
    rng = random.Random(4)
    base = [f"w{rng.randint(0, 5000)}" for _ in range(120)]
    rows = []
    for k in range(180):
        w = list(base)
        for _ in range(rng.randint(0, 6)):
            w[rng.randrange(len(w))] = f"n{rng.randint(0, 9999)}"
        rows.append((k, " ".join(w)))
    rows += [(500 + k, f"{PROSE} {' '.join(f'z{k}{j}' for j in range(k))}") for k in range(15)]
    rows += [(900 + k, " ".join(base)) for k in range(30)]
    check_near(spark, rows, 5)


@pytest.mark.parametrize("crowd", [32, 1])
def test_near_duplicates_common_passage(spark, monkeypatch, crowd):
    """A passage in unlike texts fills buckets with them; their pairs aren't listed, and near copies among them are still found."""
    monkeypatch.setattr(near_dedup, "CROWD", crowd, raising=False)
    rng = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = []
    for k in range(700):
        own = [f"o{k}x{i}" for i in range(rng.randint(60, 100))]
        rows.append((k, f"{passage} {' '.join(own)}"))
        if k % 10 == 0:  # copies on either side of the threshold
            for c in range(2):
                at = rng.sample(range(len(own)), rng.randint(1, 4))
                rows.append((1000 * (c + 1) + k, f"{passage} {' '.join(f'e{k}x{c}' if i in at else w for i, w in enumerate(own))}"))
    compared = []
    whole = near_dedup._likely_blocks

    def likely_blocks(pairs, percent):
        compared.append(pairs.count())
        return whole(pairs, percent)

    monkeypatch.setattr(near_dedup, "_likely_blocks", likely_blocks)
    check_near(spark, rows, 5)
    assert compared[0] < 4 * len(rows)


def test_near_duplicates_least_agreeing():
    assert [near_dedup.least_agreeing(p) for p in (0, 80, 100)] == [4, 76, 128]


def test_near_duplicates_empty(spark):
    assert near_dedup.near_duplicates(empty(spark)).collect() == []


def test_sketches_merge_and_estimate():
    rng = np.random.default_rng(2)
    whole = rng.integers(0, 2**63, 3000, dtype=np.uint64)
    one, two = whole[:2000], whole[1000:]
    a, b = near_dedup.registers(one), near_dedup.registers(two)
    assert (near_dedup.merge(a, b) == near_dedup.registers(whole)).all()
    j = near_dedup.joint_estimate(np.array([2000.0]), np.array([2000.0]), np.array([(a > b).sum()]), np.array([(a < b).sum()]))
    assert abs(j[0] - 1 / 3) < 0.2
    sets = [np.unique(rng.integers(0, 60, 40, dtype=np.uint64)) for _ in range(9)]
    assert (near_dedup.intersections(sets, sets[:5]) == [[len(np.intersect1d(x, y)) for y in sets[:5]] for x in sets]).all()


def test_rules_ledger(spark):
    book = quality_rules.ledger(docs(spark))
    got = {(r.doc_id, *(r[m] for m in quality_rules.MEASURES)) for r in book.collect()}
    assert got == {(i, *measures(t)) for i, t in AWKWARD}
    assert book.count() == len(AWKWARD)
    verdicts = quality_rules.apply_policy(book).collect()
    for r in verdicts:
        base = r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words
        assert r.base_failed == base and (not r.base_failed or not r.kept)
        assert (r.failed == 0) == r.kept
    assert quality_rules.ledger(empty(spark)).collect() == []


def test_rules_ablations(spark):
    book = quality_rules.ledger(docs(spark))
    failed = [r.failed for r in book.collect()]
    got = {r.rule: (r.n_failed, r.n_alone, r.n_rejected_without) for r in quality_rules.ablations(book).collect()}
    for name, bit in quality_rules.BITS.items():
        one = 1 << bit
        assert got[name] == (sum(f & one != 0 for f in failed), sum(f == one for f in failed), sum(f not in (0, one) for f in failed))


def test_rules_keep_columns(spark):
    kept = quality_rules.keep_passing(docs(spark))
    assert kept.columns == docs(spark).columns
    good = [i for i, t in AWKWARD if i and quality_rules_pass(t)]
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id) == sorted(good)


def quality_rules_pass(text):
    n, chars, symbols, dup, repeat, lines = measures(text)
    return not (n < 50 or 100 * repeat > 50 * n or 100 * symbols > 15 * n or 100 * dup > 10 * n or chars < 2 * n or chars > 20 * n
                or 100 * dup > 40 * lines)


def test_banner_lines_fail_by_lines(spark):
    """A long line that is most of the lines, among distinct ones: too few repeats a word for the older rule."""
    banner, own = " ".join(f"b{k}" for k in range(20)), lambda k: " ".join(f"x{k}{j}" for j in range(30))
    lines = [x for k in range(10) for x in ((banner, own(k)) if k < 9 else (own(k),))]
    texts = [(1, "\n".join(lines)), (2, "\n".join(own(k) for k in range(10)))]
    got = {r.doc_id: r for r in quality_rules.apply_policy(quality_rules.ledger(docs(spark, texts))).collect()}
    assert got[1].failed == quality_rules.mask("duplicate_lines") and not got[1].kept and not got[1].base_failed and got[2].kept
    old = quality_rules.apply_policy(quality_rules.ledger(docs(spark, texts)), 2)
    assert all(r.kept for r in old.collect())


def labelled(spark):
    rng = random.Random(1)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 8))) for _ in range(500)]
    rows, labels = [], []
    for k in range(400):
        w = [rng.choice(vocabulary) for _ in range(rng.randint(30, 120))]
        bad = k % 4 == 0
        rows.append((k, " ".join(x.upper() + "!!" for x in w) if bad else " ".join(w) + "."))
        labels.append((k, 0 if bad else 1, None))
    labels += [(0, None, None), (None, 1, None), (7, 1, None), (399, 5, None)]
    return docs(spark, rows), spark.createDataFrame(labels, "doc_id long, quality int, text string")


def test_classifier_held_out(spark):
    table, labels = labelled(spark)
    training = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2
    model = quality_knn.fit(table, labels, training, sample=100)
    got = {r.doc_id: r.score for r in quality_knn.score(table, model).collect()}
    held = [k for k in got if zlib.crc32(str(k).encode()) % 4 == 2]
    assert len(held) > 50 and all((got[k] >= 0.7) == (k % 4 != 0) for k in held)
    # the score is the vote over all labelled vectors, nearest first
    rows = quality_knn.features(["some plain words here", "SOME!! LOUD!! WORDS!!"])
    near = model.latent(rows) @ model.vectors.T
    for at, scored in zip(near, model.score(rows)):
        top = np.sort(np.argsort(-at)[:quality_knn.NEIGHBOURS])
        votes = np.clip(at[top], 0, None).astype(float) ** 8 + 1e-12
        assert scored == pytest.approx((votes * model.labels[top]).sum() / votes.sum(), abs=1e-3)


def test_classifier_awkward(spark):
    table, labels = labelled(spark)
    model = quality_knn.fit(table, labels, F.lit(True), sample=50)
    got = quality_knn.score(docs(spark), model).collect()
    assert len(got) == len(AWKWARD) and all(0 <= r.score <= 1 for r in got)
    assert quality_knn.score(empty(spark), model).collect() == []
    untaught = quality_knn.fit(table, labels.limit(0), F.lit(True))
    assert {r.score for r in quality_knn.score(docs(spark), untaught).collect()} == {0.5}
    kept = quality_knn.keep_good(docs(spark), model, 0.7)
    assert kept.columns == docs(spark).columns


def test_classifier_learns_vocabulary_alone(spark):
    """Good and bad texts of equal style: the same word lengths, marks and repetition, other words."""
    rng = random.Random(6)
    lists = [["".join(rng.choice("bcdfgmnprst") if k % 2 == 0 else rng.choice("aeiou") for k in range(6)) for _ in range(60)] for _ in range(2)]
    rows = [(k, " ".join(rng.choice(lists[k % 2]) for _ in range(60)).capitalize() + ".") for k in range(400)]
    labels = spark.createDataFrame([(k, k % 2) for k, _ in rows], "doc_id long, quality int")
    training = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 != 2
    got = {r.doc_id: r.score for r in quality_knn.score(docs(spark, rows), quality_knn.fit(docs(spark, rows), labels, training)).collect()}
    held = [k for k in got if zlib.crc32(str(k).encode()) % 4 == 2]
    assert len(held) > 50 and all((got[k] >= 0.5) == (k % 2 == 1) for k in held)
    one, two = quality_knn.features(["The cat sat on a mat.", "Fro xyz qud zz q jkl."])
    assert np.abs(one - two).max() > 0.05


def test_classifier_against_plain_version(spark):
    """Features one text at a time, a full singular value decomposition, all cosines, sorted neighbours."""
    table, labels = labelled(spark)
    model = quality_knn.fit(table, labels, F.col("doc_id") % 3 != 0, sample=90)
    texts = {r.doc_id: r.text for r in table.collect()}
    truth = {}
    for r in labels.collect():
        if r.doc_id is not None and r.doc_id % 3 and r.quality in (0, 1):
            truth[r.doc_id] = max(r.quality, truth.get(r.doc_id, 0))
    order = {r.doc_id: r.h for r in spark.createDataFrame([(k,) for k in truth], "doc_id long").select("doc_id", F.xxhash64("doc_id", F.lit(11)).alias("h")).collect()}
    ids = sorted(k for v in (0, 1) for k in sorted((k for k in truth if truth[k] == v), key=order.get)[:90])
    rows = np.concatenate([quality_knn.features([texts[k]]) for k in ids])
    weights = np.log((1 + len(rows)) / (1 + (rows > 0).sum(axis=0))) + 1
    _, s, v = np.linalg.svd(rows * weights, full_matrices=False)
    space = v[:quality_knn.LATENT].T
    unit = lambda z: z / np.linalg.norm(z, axis=1, keepdims=True)
    known, y = unit(rows * weights @ space), np.array([truth[k] for k in ids])
    asked = [k for k in texts if k % 3 == 0][:60]
    got = {r.doc_id: r.score for r in quality_knn.score(table, model).collect()}
    for k, near in zip(asked, unit(np.concatenate([quality_knn.features([texts[k]]) for k in asked]) * weights @ space) @ known.T):
        top = np.argsort(-near)[:quality_knn.NEIGHBOURS]
        votes = np.clip(near[top], 0, None) ** 8 + 1e-12
        assert got[k] == pytest.approx((votes * y[top]).sum() / votes.sum(), abs=0.02)


def test_features_do_not_depend_on_the_slice():
    texts = [t or "" for _, t in AWKWARD] + ["Words of plain prose, twice: words of plain prose."]
    whole = quality_knn.features(texts)
    assert np.allclose(whole, np.concatenate([quality_knn.features([t]) for t in texts]))
