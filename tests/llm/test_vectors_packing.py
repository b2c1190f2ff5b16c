import random
from collections import Counter

import numpy as np

from helpers import roots
from visitlens.llm import embedding_dedup, packing
from visitlens.llm.components import components


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 3, True) for i, v in rows], "vec_id long, embedding array<float>, n_links int, kept boolean")


def test_vectors_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    rows = [(int(k), rng.standard_normal(16).tolist()) for k in range(200)]
    centre = rng.standard_normal(16)
    rows += [(300 + k, (centre + 0.13 * rng.standard_normal(16)).tolist()) for k in range(150)]
    rows += [(500 + k, rows[5][1]) for k in range(40)] + [(600, [2 * x for x in rows[5][1]]), (600, rows[5][1])]
    odd = [(700, None), (701, []), (702, [0.0] * 16), (703, [1.0, None] + [0.0] * 14), (704, [float("nan")] * 16),
           (705, [float("inf")] + [1.0] * 15), (706, [1.0, 2.0]), (707, [1.0, 2.0]), (None, rows[5][1])]
    got = sorted((tuple(r) for r in embedding_dedup.near_duplicates(vectors(spark, rows + odd), 0.95).collect()), key=repr)
    m = np.array([v for _, v in rows], np.float32).astype(float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    hit = m @ m.T >= 0.95
    np.fill_diagonal(hit, False)
    root = roots(len(rows), zip(*np.nonzero(hit)))
    least = {}
    for r, (i, _) in zip(root, rows):
        least[r] = min(i, least.get(r, i))
    wanted = [(i, int(n), least[r], i == least[r]) for (i, _), n, r in zip(rows, hit.sum(axis=1), root)]
    wanted += [(i, 1, 706, i == 706) if i in (706, 707) else (i, 0, i, True) for i, _ in odd]
    wanted = sorted(wanted, key=repr)
    exact = sum(a == b for a, b in zip(got, wanted)) / len(wanted)
    assert len(got) == len(wanted)
    # no link below the threshold, recall of links at least 0.9 (here nearly all)
    assert all(g[1] <= w[1] for g, w in zip(got, wanted)) and exact > 0.97
    assert sum(g[1] for g in got) >= 0.99 * sum(w[1] for w in wanted)
    assert embedding_dedup.near_duplicates(vectors(spark, [])).collect() == []


def test_forest_connects_what_links_connect():
    rng = np.random.default_rng(0)
    for rows, columns, share in ((1, 1, 1.0), (30, 40, 0.03), (30, 40, 0.5), (50, 50, 0.01), (4, 7, 0.0)):
        hit = rng.random((rows, columns)) < share
        i, j = embedding_dedup.forest(hit)
        every, some = (roots(rows + columns, [(a, rows + b) for a, b in zip(*x)]) for x in (np.nonzero(hit), (i, j)))
        same = lambda r: {(a, b) for a in range(rows + columns) for b in range(a) if r[a] == r[b]}
        assert hit[i, j].all() and same(every) == same(some) and len(i) < rows + columns


def test_topic_of_unlinked_vectors_makes_few_pairs(spark, monkeypatch):
    """Vectors alike at 0.9, hardly any at 0.95: pairs of cells don't grow with the square of the topic."""
    rng = np.random.default_rng(9)
    n, d = 1500, 64
    centre = rng.standard_normal(d)
    centre /= np.linalg.norm(centre)
    noise = rng.standard_normal((n, d))
    noise -= np.outer(noise @ centre, centre)
    m = centre * np.sqrt(0.9) + noise / np.linalg.norm(noise, axis=1, keepdims=True) * np.sqrt(0.1)
    pairs, whole = [], embedding_dedup.cell_pairs
    monkeypatch.setattr(embedding_dedup, "cell_pairs", lambda x: pairs.append(whole(x).count()) or whole(x))
    rows = [(k, v) for k, v in enumerate(m.astype(np.float32).tolist())]
    got = embedding_dedup.near_duplicates(vectors(spark, rows), 0.95).collect()
    u = embedding_dedup.unit(m.astype(np.float32).astype(float))
    hit = u @ u.T >= 0.95
    np.fill_diagonal(hit, False)
    assert pairs[0] < 20 * n
    assert all(r.n_links <= w for r, w in zip(sorted(got), hit.sum(axis=1))) and sum(r.n_links for r in got) >= 0.95 * hit.sum()


def test_components_chain_and_repeats(spark):
    links = [(k, k + 1) for k in range(60)] + [(70, 70), (80, 81), (81, 80), (80, 81)]
    got = {r.node: r.label for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(61)} | {80: 80, 81: 80}
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def one_by_one(items, sizes, overhead):
    bins = []
    for n in sorted(items, reverse=True):
        fits = [b for b in bins if b[0] - b[1] >= n]
        b = min(fits, key=lambda b: b[0] - b[1]) if fits else None
        if b is None:
            b = [min(s for s in sizes if s >= n) if len(sizes) > 1 else sizes[0], 0]
            bins.append(b)
        b[1] += n
    return sorted(b[1] for b in bins)


def test_plan_equals_packing_one_by_one():
    rng = random.Random(0)
    for _ in range(60):
        items = [rng.randint(1, 64) if rng.random() < 0.7 else rng.choice([7, 16, 33]) for _ in range(rng.randint(0, 150))]
        p = packing.plan(Counter(items), [64], 3)
        used = one_by_one(items, [64], 3)
        count = np.diff(np.append(p.bins, len(used))) if len(p.bins) else []
        assert sorted(np.repeat(p.used, count).tolist()) == used


def test_pack_whole(spark):
    rng = random.Random(2)
    rows = [(k, rng.choice([1, 5, 40, 41, 60, 64, 65, 200, 1000])) for k in range(600)] + [(7, 40), (7, 40), (None, 33), (601, None), (602, 0), (603, -4)]
    table = spark.createDataFrame([(i, n, "x") for i, n in rows], "doc_id long, length long, bin_id string")
    got = packing.pack(table, capacities=(16, 32, 64), overhead=2).collect()
    assert Counter((r.doc_id, r.length) for r in got) == Counter(
        (i, min(n - at, 64)) for i, n in ((i, max(n or 0, 0)) for i, n in rows) for at in range(0, max(n, 1), 64))
    bins = {}
    for r in got:
        assert (r.bin_id is None) == (r.length == 0)
        if r.bin_id is not None:
            bins.setdefault((r.bin_id, r.bin_used, r.bin_capacity), []).append((r.bin_offset, r.length))
    assert len({b[0] for b in bins}) == len(bins)
    for (_, used, capacity), parts in bins.items():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at == used <= capacity and capacity == min(s for s in (16, 32, 64) if s >= used)
    for worth in packing.WORTHS:
        totals = Counter(r.length for r in got if r.length)
        assert sum({b[0]: b[2] + 2 for b in bins}.values()) <= packing._best_fit(totals, [16, 32, 64], 2, worth).cost
    sequences = packing.sequences(packing.pack(table, capacities=(16, 32, 64))).collect()
    assert all(sum(p.length for p in s.parts) == s.bin_used for s in sequences)
    assert packing.pack(table.limit(0)).collect() == []
