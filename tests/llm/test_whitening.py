"""Whitening against numpy's eigenvectors, and the solver on awkward matrices."""

import numpy as np
import pytest

from visitlens.llm import whitening
from visitlens.llm.queries import op13_whitening

SF = "/root/testdata/sf0.001"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<double>, n int, component string")


def brute(vectors, k):
    x = np.floor(64 * np.array(vectors, float)).astype(np.int64) + 1_000_000
    n, s = len(x), x.sum(axis=0)
    c = (n * x - s) / n
    cov = c.T @ c / n
    e, v = np.linalg.eigh(cov)
    e, v = e[::-1][:k], v[:, ::-1][:, :k]
    return n, ((n * x - s) ** 2).sum(axis=1), c @ v / np.sqrt(e), e / np.trace(cov), cov, e


def matrices():
    g = np.random.default_rng(5)
    yield g.standard_normal((40, 12))
    yield g.standard_normal((200, 30)) * 10.0 ** -np.arange(30)  # graded
    yield np.eye(9)  # all values equal
    yield np.vstack([np.eye(8)] * 3) @ np.diag([3, 3, 3, 2, 2, 1, 1, 1])
    yield np.linalg.qr(g.standard_normal((50, 20)))[0] @ np.diag(np.r_[np.ones(10), 1 + 1e-13 * np.arange(10)]) @ np.linalg.qr(g.standard_normal((20, 20)))[0]
    yield g.standard_normal((30, 3)) @ g.standard_normal((3, 10))  # rank 3
    yield np.repeat(g.standard_normal((4, 6)), 5, axis=0)
    yield np.zeros((3, 4))
    yield np.array([[2.0]])


@pytest.mark.parametrize("k", range(9))
def test_solver(k):
    m = list(matrices())[k]
    d = m.shape[1]
    r = whitening.triangle(np.zeros((d, d)), m)
    a, b, right = whitening.bidiagonal(r)
    want = np.linalg.svd(m, compute_uv=False)
    want = np.r_[want, np.zeros(d - len(want))]
    values = whitening.dqds(a, b)
    top = max(want[0], 1e-300)
    assert np.abs(np.sqrt(np.maximum(values, 0)) - want).max() <= 1e-13 * top
    if k == 1:  # small values to high relative accuracy for the bidiagonal matrix
        exact = np.linalg.svd(np.diag(a) + np.diag(b, 1), compute_uv=False)
        assert np.abs(np.sqrt(values[:12]) / exact[:12] - 1).max() < 1e-3
    some = int((want > 1e-8 * top).sum())
    got, z = whitening.right_vectors(a, b, some or 1)
    if want[0] == 0:
        assert len(got) == 0
        return
    v = right @ z
    assert np.abs(v.T @ v - np.eye(v.shape[1])).max() < 1e-10
    assert np.abs(m.T @ (m @ v) - v * got).max() < 1e-11 * top ** 2


def test_dqds_of_random_bidiagonals():
    g = np.random.default_rng(3)
    for d in (2, 3, 5, 17, 64, 150):
        a, b = g.standard_normal(d), g.standard_normal(d - 1)
        want = np.linalg.svd(np.diag(a) + np.diag(b, 1), compute_uv=False)
        assert np.abs(np.sqrt(whitening.dqds(a, b)) - want).max() < 1e-12 * want[0]


def check(got, ids, vectors, k):
    n, deviation, white, explained, cov, e = brute(vectors, k)
    assert len(got) == len(ids) * len(e)
    place = {i: p for p, i in enumerate(ids)}
    w = np.zeros_like(white)
    for r in got:
        p = place[r.vec_id]
        assert (r.n, r.deviation) == (n, deviation[p])
        assert r.explained == pytest.approx(explained[r.component - 1], rel=1e-10) and r.identity_error < 1e-8
        w[p, r.component - 1] = r.whitened
    assert np.abs(w.T @ w / n - np.eye(len(e))).max() < 1e-9
    for c in range(len(e)):  # signs are free
        assert min(np.abs(w[:, c] - white[:, c]).max(), np.abs(w[:, c] + white[:, c]).max()) < 1e-6


def test_query(spark):
    rows = spark.read.parquet(f"{SF}/embeddings.parquet").collect()
    rows = [r for r in rows if r.embedding is not None and all(x is not None and np.isfinite(x) for x in r.embedding)]
    out = op13_whitening(spark, SF)
    assert dict(out.dtypes) == {"vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint", "whitened": "double",
                                "explained": "double", "identity_error": "double"}
    check(out.collect(), [r.vec_id for r in rows], [r.embedding for r in rows], 32)


def test_awkward_rows(spark):
    g = np.random.default_rng(1)
    good = [(i, [float(x) for x in g.standard_normal(5)]) for i in range(40)]
    bad = [(90, None), (91, []), (92, [1.0, None, 1.0, 1.0, 1.0]), (93, [float("nan")] * 5), (94, [float("inf"), 0.0, 0.0, 0.0, 0.0]),
           (95, [1.0, 2.0]), (96, [1e300] * 5)]
    df = frame(spark, bad[:3] + good + bad[3:]).repartition(5)
    model = whitening.fit(df)
    check(whitening.by_component(whitening.whiten(df, model), model).collect(), [i for i, _ in good], [v for _, v in good], 5)


def test_repeated_rows_null_ids_and_no_variance(spark):
    g = np.random.default_rng(2)
    v = [[float(x) for x in g.standard_normal(3)] + [1.5] for _ in range(6)]  # the last dimension never varies
    df = frame(spark, [(1, v[0]), (1, v[0]), (None, v[1]), (2, v[2]), (3, v[3]), (4, v[4])])
    model = whitening.fit(df)
    assert len(model.values) == 3 and model.identity_error < 1e-9
    out = whitening.by_component(whitening.whiten(df, model), model).collect()
    assert sorted(r.component for r in out) == [1] * 6 + [2] * 6 + [3] * 6 and sum(r.vec_id is None for r in out) == 3
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 3):
        df = frame(spark, rows)
        model = whitening.fit(df)
        assert whitening.by_component(whitening.whiten(df, model), model).collect() == []


def test_deviation_beyond_64_bits(spark):
    df = frame(spark, [(1, [2.0 ** 40, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0])])
    model = whitening.fit(df)
    got = {r.vec_id: r.deviation for r in whitening.whiten(df, model).collect()}
    x = np.array([[2 ** 46, 0], [0, 64], [64, 0]], object)
    want = ((3 * x - x.sum(axis=0)) ** 2).sum(axis=1)
    assert got == {i + 1: (int(w) if w < 1 << 63 else None) for i, w in enumerate(want)}
