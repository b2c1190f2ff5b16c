"""Whitening of embeddings by a bidiagonal qd solver.

Entries become integers, so counts, sums and squared deviations are exact. Centred rows are reduced by
blockwise QR in the tasks; only triangles of the dimension's size leave them and are reduced again. On the
last triangle, whatever the number of rows: Householder reflections to a bidiagonal matrix, dqds for its
singular values (squared, to high relative accuracy), twisted factorisations for its singular vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import let_workers_import, materialize

#: Rows of a QR block beyond the triangle; tasks that reduce the first tasks' triangles (as many come to the driver).
BLOCK_ROWS, MERGERS = 1024, 16
_EPS = np.finfo(float).eps


# ---------------------------------------------------------------- the solver, on matrices of the dimension's size
def triangle(r: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """The triangle of QR of ``r`` above ``rows``; at most as many rows as columns."""
    return np.linalg.qr(np.vstack([r, rows]), mode="r")


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) of U' r V by Householder reflections; r is square."""
    a, d = r.copy(), r.shape[1]
    v = np.eye(d)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        top = np.abs(x).max(initial=0)
        if top == 0 or len(x) < 2:
            return None
        u = x / top
        u[0] += np.copysign(np.sqrt(u @ u), u[0])
        return u / np.sqrt(u @ u)

    for k in range(d):
        if (u := reflector(a[k:, k])) is not None:
            a[k:, k:] -= 2 * np.outer(u, u @ a[k:, k:])
        if k < d - 1 and (u := reflector(a[k, k + 1:])) is not None:
            a[k:, k + 1:] -= 2 * np.outer(a[k:, k + 1:] @ u, u)
            v[:, k + 1:] -= 2 * np.outer(v[:, k + 1:] @ u, u)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v


def _shift(q: list[float], e: list[float]) -> float:
    """The smaller eigenvalue of the last two by two, a little less."""
    a, b, c = q[-2] + e[-1], q[-1] * e[-1], q[-1]
    half, root = (a + c) / 2, np.hypot((a - c) / 2, np.sqrt(b))
    return max(0.0, float((a * c - b) / (half + root))) * (1 - 1e-3) if half + root > 0 else 0.0


def _dqds_step(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float], float] | None:
    """One differential quotient-difference transform with a shift, and a lower bound of the values that are left.

    None if the shift is above the least value. The bound is one over the trace of the inverse.
    """
    new_q, new_e, d, inverse = [], [], q[0] - shift, 0.0
    for i in range(len(e)):
        if d < 0:
            return None
        inverse += 1 / d if d > 1e-300 else 1e300
        x = d + e[i]
        t = q[i + 1] / x if x else 1.0
        new_q.append(x)
        new_e.append(e[i] * t)
        d = d * t - shift
    if d < 0:
        return None
    inverse += 1 / d if d > 1e-300 else 1e300
    return new_q + [d], new_e, 1 / inverse


def dqds(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared singular values, falling, of the bidiagonal matrix with diagonal ``a`` and superdiagonal ``b``."""
    top = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if top == 0:
        return np.zeros(len(a))
    out: list[float] = []
    parts = [([float(x) for x in (a / top) ** 2], [float(x) for x in (b / top) ** 2], 0.0)]
    while parts:
        q, e, shifted = parts.pop()
        if q[0] < q[-1]:  # the least values belong at the end
            q, e = q[::-1], e[::-1]
        bound, steps = 0.0, 0
        while len(q) > 1:
            # a part that takes unusually long splits at what rounding can't tell from zero
            least = _EPS * _EPS if steps < 40 * len(q) else _EPS
            floor = 1e-300 if steps < 40 * len(q) else _EPS * _EPS
            i = next((i for i in range(len(e) - 1, -1, -1) if e[i] <= least * (shifted + min(q[i], q[i + 1])) or e[i] <= floor), -1)
            if i == len(e) - 1:
                out.append(q.pop() + shifted)
                e.pop()
                continue
            if i >= 0:
                parts.append((q[:i + 1], e[:i], shifted))
                q, e = q[i + 1:], e[i + 1:]
                continue
            for shift in (_shift(q, e), bound * (1 - 1e-6), 0.0):
                if (step := _dqds_step(q, e, shift)) is not None:
                    (q, e, bound), shifted = step, shifted + shift
                    break
            steps += 1
            if steps > 400 * len(q):
                raise ArithmeticError("dqds doesn't converge")
        out.append(q[0] + shifted)
    return np.sort(np.array(out))[::-1] * top * top


def _twisted(diag: np.ndarray, low: np.ndarray, value: float) -> tuple[np.ndarray, float]:
    """(unit vector, correction of the value): the twisted factorisation of L D L' - value with the least pivot."""
    n, tiny = len(diag), 1e-290
    plus, minus, s, p = np.zeros(n - 1), np.zeros(n - 1), np.zeros(n), np.zeros(n)
    s[0] = -value
    for i in range(n - 1):
        x = s[i] + diag[i]
        plus[i] = diag[i] * low[i] / (x if x else tiny)
        s[i + 1] = plus[i] * low[i] * s[i] - value
    p[-1] = diag[-1] - value
    for i in range(n - 2, -1, -1):
        x = diag[i] * low[i] ** 2 + p[i + 1]
        t = diag[i] / (x if x else tiny)
        minus[i] = low[i] * t
        p[i] = p[i + 1] * t - value
    pivots = s + p + value
    k = int(np.nanargmin(np.abs(np.where(np.isfinite(pivots), pivots, np.inf))))
    z = np.zeros(n)
    z[k] = 1
    for i in range(k - 1, -1, -1):
        z[i] = -plus[i] * z[i + 1]
    for i in range(k, n - 1):
        z[i + 1] = -minus[i] * z[i]
    size = z @ z
    return z / np.sqrt(size), float(pivots[k] / size)


def right_vectors(a: np.ndarray, b: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """(squared singular values, right singular vectors as columns) of a bidiagonal matrix, the ``most`` greatest, falling.

    The matrix splits where its superdiagonal vanishes. Vectors of one block whose values are close are
    made orthogonal; where they fall together, the next one comes from steps of inverse iteration.
    """
    d = len(a)
    top = max(np.abs(a).max(initial=0), np.abs(b).max(initial=0))
    if top == 0:
        return np.zeros(0), np.zeros((d, 0))
    ends = [*(np.flatnonzero(np.abs(b) <= _EPS / 4 * (np.abs(a[:-1]) + np.abs(a[1:]))) + 1).tolist(), d]
    blocks = [(x, y, dqds(a[x:y], b[x:y - 1])) for x, y in zip([0, *ends[:-1]], ends)]
    least = np.sort(np.concatenate([v for _, _, v in blocks]))[::-1][:most][-1]
    found = []
    for x, y, values in blocks:
        diagonal = np.where(np.abs(a[x:y]) < 1e-18 * top, 1e-18 * top, a[x:y])
        diag, low = diagonal ** 2, b[x:y - 1] / diagonal[:-1]
        square = np.diag(diagonal) + np.diag(b[x:y - 1], 1)
        square = square.T @ square
        earlier: list[tuple[float, np.ndarray]] = []
        for value in values[values >= least].tolist():
            z, more = _twisted(diag, low, value)
            if abs(more) < 1e-8 * max(value, 1e-290):
                better, _ = _twisted(diag, low, value + more)
                z = better if np.isfinite(better).all() else z
            near = [v for u, v in earlier if u - value < 1e-3 * u]
            if near:
                basis = np.array(near)
                rest = z - basis.T @ (basis @ z)
                for seed in range(3):
                    if np.sqrt(rest @ rest) > 0.5:
                        break
                    rest = np.random.default_rng(seed).standard_normal(y - x)
                    shifted = square - (value * (1 + 4 * _EPS) + 1e-300) * np.eye(y - x)
                    for _ in range(3):
                        rest -= basis.T @ (basis @ rest)
                        rest = np.linalg.lstsq(shifted, rest, rcond=None)[0]
                        rest /= np.sqrt(rest @ rest)
                    rest -= basis.T @ (basis @ rest)
                rest -= basis.T @ (basis @ rest)
                z = rest / np.sqrt(rest @ rest)
            earlier.append((value, z))
            full = np.zeros(d)
            full[x:y] = z
            found.append((value, x, full))
    found.sort(key=lambda f: (-f[0], f[1]))
    found = found[:most]
    return np.array([f[0] for f in found]), np.array([f[2] for f in found]).reshape(-1, d).T


# ---------------------------------------------------------------- fitting on Spark
@dataclass(frozen=True)
class Whitening:
    """What all rows were fitted to: count, sums of the integer entries, covariance's trace, greatest eigenvalues, their
    unit vectors as columns, and the largest absolute entry of the whitened rows' covariance minus the identity."""
    n: int
    sums: tuple[int, ...]
    trace: float
    values: np.ndarray
    vectors: np.ndarray
    scale: float
    offset: int
    identity_error: float = 0.0

    @property
    def dims(self) -> int:
        return len(self.sums)

    def scaled(self) -> np.ndarray:
        return self.vectors / np.sqrt(self.values)

    def centred(self, x: np.ndarray) -> np.ndarray:
        """n * x - sums, exact: 64-bit integers, or Python's where those don't hold it."""
        bound = self.n * int(np.abs(x).max(initial=0)) + max((abs(s) for s in self.sums), default=0)
        kind = np.int64 if bound < 1 << 62 else object
        return x.astype(kind) * self.n - np.array(self.sums, kind)

    def deviations(self, centred: np.ndarray) -> list[int | None]:
        """Sums of squares; none where it doesn't fit into 64 bits."""
        if len(centred) and self.dims * int(np.abs(centred).max()) ** 2 >= 1 << 63:
            sums = (centred.astype(object) ** 2).sum(axis=1).tolist()
            return [s if s < 1 << 63 else None for s in sums]
        return (centred.astype(np.int64) ** 2).sum(axis=1).tolist()


def _valid(column: pa.Array, scale: float, offset: int) -> tuple[np.ndarray, np.ndarray]:
    """(lengths: -1 for rows that fall away, entries of all others one after the other as integers)."""
    lists = column.fill_null([]) if column.null_count else column
    offsets = np.asarray(lists.offsets, dtype=np.int64)
    lengths = np.diff(offsets)
    # entries that no 64-bit integer holds count as non-finite
    flat = np.asarray(lists.values.slice(offsets[0], offsets[-1] - offsets[0]).cast(pa.float64()).fill_null(np.nan))
    with np.errstate(over="ignore", invalid="ignore"):
        whole = np.floor(flat * scale)
    bad = ~(np.abs(whole) < 2.0 ** 62)
    owner = np.repeat(np.arange(len(lengths)), lengths)
    drop = (np.bincount(owner[bad], minlength=len(lengths)) > 0) | (lengths == 0)
    return np.where(drop, -1, lengths), whole[~drop[owner]].astype(np.int64) + offset


def _blocks(batches: Iterator[pa.RecordBatch], column: int, dims: int, scale: float, offset: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Rows of ``dims`` valid entries, with their integer entries, in blocks."""
    for whole in batches:
        for at in range(0, whole.num_rows, BLOCK_ROWS):
            batch = whole.slice(at, BLOCK_ROWS)
            lengths, flat = _valid(batch.column(column), scale, offset)
            stay = lengths == dims
            if stay.any():
                x = flat[np.repeat(stay[lengths > 0], lengths[lengths > 0])].reshape(-1, dims)
                yield batch.filter(pa.array(stay)), x


def _sums(vectors: DataFrame, scale: float, offset: int) -> DataFrame:
    """dims, pos, high, low, n: exact sums of the integer entries per vector length, as two halves of 32 bits."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, list] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, BLOCK_ROWS):
                lengths, flat = _valid(whole.column(0).slice(at, BLOCK_ROWS), scale, offset)
                lengths = lengths[lengths > 0]
                for d in np.unique(lengths).tolist():
                    x = flat[np.repeat(lengths == d, lengths)].reshape(-1, d)
                    s = sums.setdefault(d, [np.zeros(d, np.int64), np.zeros(d, np.int64), 0])
                    s[0] += (x >> 32).sum(axis=0)
                    s[1] += (x & 0xFFFFFFFF).sum(axis=0)
                    s[2] += len(x)
        for d, (high, low, n) in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(d, d), pa.int32()), pa.array(np.arange(d), pa.int32()), pa.array(high),
                                              pa.array(low), pa.array(np.full(d, n))], names=["dims", "pos", "high", "low", "n"])

    return (vectors.mapInArrow(run, "dims int, pos int, high long, low long, n long")
            .groupBy("dims", "pos").agg(*[F.sum(c).alias(c) for c in ("high", "low", "n")]))


def _triangles(rows: DataFrame, dims: int, as_rows) -> DataFrame:
    """Each task's rows (``as_rows`` turns its batches into blocks) reduced to the rows of one triangle."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r, waiting, size = np.zeros((0, dims)), [], 0
        for block in as_rows(batches):
            waiting.append(block)
            size += len(block)
            if size >= max(BLOCK_ROWS, 4 * dims):
                r, waiting, size = triangle(r, np.vstack(waiting)), [], 0
        if size:
            r = triangle(r, np.vstack(waiting))
        r = r[np.abs(r).max(axis=1, initial=0) > 0]
        yield pa.RecordBatch.from_arrays([pa.array([x.tobytes() for x in r], pa.binary())], names=["row"])

    return rows.mapInArrow(run, "row binary")


def _read_rows(dims: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for batch in batches:
            if batch.num_rows:
                yield np.frombuffer(b"".join(batch.column(0).to_pylist()), float).reshape(-1, dims)
    return read


def _second_moments(vectors: DataFrame, model: Whitening) -> np.ndarray:
    """The covariance of the whitened rows, from sums of products in the tasks."""
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, w = np.zeros((k + 1, k)), model.scaled()
        for _, x in _blocks(batches, 0, model.dims, model.scale, model.offset):
            y = (model.centred(x).astype(float) / model.n) @ w
            total[:k] += y.T @ y
            total[k] += y.sum(axis=0)
        at = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(at[0].ravel(), pa.int32()), pa.array(at[1].ravel(), pa.int32()), pa.array(total.ravel())],
                                         names=["i", "j", "total"])

    rows = vectors.mapInArrow(run, "i int, j int, total double").groupBy("i", "j").agg(F.sum("total").alias("total")).collect()
    got = np.zeros((k + 1, k))
    for r in rows:
        got[r.i, r.j] = r.total
    mean = got[k] / model.n
    return got[:k] / model.n - np.outer(mean, mean)


def fit(vectors: DataFrame, components: int = 32, scale: float = 64.0, offset: int = 1_000_000, vector_col: str = "embedding") -> Whitening:
    """Fit on all valid rows. An entry c counts as the integer floor(scale * c) + offset.

    Vectors that are null, empty or hold null or non-finite entries fall away, and so do those of another length
    than the commonest one (of equally common ones the longest). Components without variance (within rounding) can't
    be whitened and are left out, so there are at most as many as dimensions, and none for an empty table or equal rows.
    """
    let_workers_import(vectors.sparkSession)
    only = vectors.select(F.col(vector_col).alias("vector"))
    sums = materialize(_sums(only, scale, offset), "vector-sums")
    most = sums.filter("pos = 0").orderBy(F.desc("n"), F.desc("dims")).limit(1).collect()
    if not most:
        return Whitening(0, (), 0.0, np.zeros(0), np.zeros((0, 0)), scale, offset)
    n, dims = most[0].n, most[0].dims
    total = {r.pos: (r.high << 32) + r.low for r in sums.filter(F.col("dims") == dims).collect()}
    start = Whitening(n, tuple(total[p] for p in range(dims)), 0.0, np.zeros(0), np.zeros((dims, 0)), scale, offset)

    def centred(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
        for _, x in _blocks(batches, 0, dims, scale, offset):
            yield start.centred(x).astype(float) / n

    first = _triangles(only, dims, centred)
    # any rows may be reduced together, so those of the tasks' triangles are dealt by their content
    merged = _triangles(first.repartition(MERGERS, "row"), dims, _read_rows(dims))
    r = np.zeros((0, dims))
    for row in merged.collect():  # at most MERGERS triangles and those of AQE's own splits
        r = np.vstack([r, np.frombuffer(bytes(row.row), float)])
        if len(r) >= 4 * dims:
            r = triangle(np.zeros((0, dims)), r)
    r = triangle(np.zeros((dims, dims)), r) / np.sqrt(n)
    diagonal, above, right = bidiagonal(r)
    values, z = right_vectors(diagonal, above, min(components, dims))
    some = values > max(n, dims) * _EPS * values[0] if len(values) else np.zeros(0, bool)
    model = Whitening(n, start.sums, float((r * r).sum()), values[some], right @ z[:, some], scale, offset)
    if not some.any():
        return model
    error = float(np.abs(_second_moments(only, model) - np.eye(int(some.sum()))).max())
    return Whitening(n, model.sums, model.trace, model.values, model.vectors, scale, offset, error)


def whiten(vectors: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, deviation, whitened (array of doubles, a number per component): a row for each valid row of ``vectors``.

    deviation: the exact sum over dimensions of (n * x - sum)^2, null if no 64-bit integer holds it. Rows that ``fit``
    leaves out give none; null ids and repeated rows stay; other columns are ignored.
    """
    let_workers_import(vectors.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = model.scaled()
        for batch, x in _blocks(batches, 1, model.dims, model.scale, model.offset):
            centred = model.centred(x)
            y = (centred.astype(float) / model.n) @ w
            ends = pa.array(np.arange(len(y) + 1) * y.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(model.deviations(centred), pa.int64()),
                                              pa.ListArray.from_arrays(ends, pa.array(y.ravel()))], names=["vec_id", "deviation", "whitened"])

    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("vector"))
    return rows.mapInArrow(run, "vec_id long, deviation long, whitened array<double>")


def by_component(whitened: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, component (from 1), n, deviation, whitened, explained, identity_error: a row per row and component."""
    shares: Column = F.array(*[F.lit(float(v / model.trace)) for v in model.values]).cast("array<double>")
    rows = whitened.select("vec_id", "deviation", F.posexplode("whitened").alias("k", "whitened"))
    return rows.select("vec_id", (F.col("k") + 1).alias("component"), F.lit(model.n).cast("long").alias("n"), "deviation", "whitened",
                       F.get(shares, F.col("k")).alias("explained"), F.lit(model.identity_error).alias("identity_error"))
