"""Near-duplicate vectors by p-stable hashing and exact cosines.

Vectors are scaled to length one. In each of many tables a vector's bucket is a list of
``floor((a . v + b) / w)`` over Gaussian directions a; near vectors share some bucket.

Equal vectors are one class. A class joins the cell of a hub: the first, in a fixed random
order, of the buckets' hubs whose cosine with it reaches CELL_LIKENESS, well below the threshold (else it is its own
cell), so vectors of one topic share few cells even where they link with nothing. Each cell, and each pair of cells
that share a bucket, is compared whole, in blocks of vectors by matrix products: every
pair of classes is compared at most once, a group of thousands of alike vectors makes a few
block pairs instead of millions of rows, and only counts and a spanning forest of a block pair's links leave
a task.

With 20 directions of width 2 in each of 112 tables, two vectors of cosine 0.95 share no
bucket with probability (1 - 0.0676)^112 = 4e-4, nearer ones less; cells only add comparisons.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import let_workers_import, materialize, mix64
from visitlens.llm.components import components

TABLES, DIRECTIONS, WIDTH = 112, 20, 2.0
#: Cosine of a class with the hub of its cell.
CELL_LIKENESS = 0.8
#: Vectors in a block of a cell.
BLOCK = 128
#: Rows of block pairs that a Python worker holds at a time.
BATCH_ROWS = 256

_planes: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _projections(dims: int) -> tuple[np.ndarray, np.ndarray]:
    if dims not in _planes:
        rng = np.random.default_rng(1000 + dims)
        _planes[dims] = rng.standard_normal((dims, TABLES * DIRECTIONS)), rng.uniform(0, WIDTH, TABLES * DIRECTIONS)
    return _planes[dims]


def unit(rows: np.ndarray) -> np.ndarray:
    """Rows scaled to length one, in double precision (first by the largest component, against overflow)."""
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.sqrt((rows * rows).sum(axis=1, keepdims=True))


def _unpack(blobs: list[bytes], dims: int) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.float64).reshape(-1, dims)


def buckets(rows: np.ndarray) -> np.ndarray:
    """One 64-bit bucket per row and table."""
    a, b = _projections(rows.shape[1])
    steps = np.floor((rows @ a + b) / WIDTH).astype(np.int64).astype(np.uint64).reshape(len(rows), TABLES, DIRECTIONS)
    with np.errstate(over="ignore"):
        factors = mix64(np.arange(1, DIRECTIONS + 1, dtype=np.uint64)) | np.uint64(1)
        keys = mix64((steps * factors).sum(axis=2, dtype=np.uint64) + np.uint64(rows.shape[1]))
        return mix64(keys + mix64(np.arange(TABLES, dtype=np.uint64) + np.uint64(1))).view(np.int64)


def _packed(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, dims, packed): packed is null where a vector links with nothing."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, packed = [], []
            for vector in batch.column(1).to_pylist():
                row = np.array([np.nan if x is None else x for x in vector or ()], np.float64)
                good = len(row) and np.isfinite(row).all() and row.any()
                dims.append(len(row))
                packed.append((row + 0.0).tobytes() if good else None)  # + 0.0: one kind of zero
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(dims, pa.int32()), pa.array(packed, pa.binary())], names=["vec_id", "dims", "packed"])

    let_workers_import(vectors.sparkSession)
    return vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v")).mapInArrow(
        run, "vec_id long, dims int, packed binary")


def _in_buckets(classes: DataFrame) -> DataFrame:
    """(bucket, rep): a row for each table."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            reps, dims = np.asarray(batch.column(0), dtype=np.int64), np.asarray(batch.column(1))
            blobs = batch.column(2).to_pylist()
            for d in np.unique(dims).tolist():
                of = np.flatnonzero(dims == d)
                for at in range(0, len(of), 512):
                    part = of[at:at + 512]
                    keys = buckets(unit(_unpack([blobs[i] for i in part], d)))
                    yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(np.repeat(reps[part], TABLES))], names=["bucket", "rep"])

    return classes.select("rep", "dims", "packed").mapInArrow(run, "bucket long, rep long")


def _confirmed(pairs: DataFrame, classes: DataFrame, at_least: float) -> DataFrame:
    """The pairs (rep, hub) whose cosine reaches the threshold."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.asarray(batch.column("dims"))
            keep = np.zeros(batch.num_rows, bool)
            x, y = batch.column("x").to_pylist(), batch.column("y").to_pylist()
            for d in np.unique(dims).tolist():
                of = np.flatnonzero(dims == d)
                u, v = (unit(_unpack([z[i] for i in of], d)) for z in (x, y))
                keep[of] = (u * v).sum(axis=1) >= at_least
            yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("hub")], names=["rep", "hub"]).filter(pa.array(keep))

    one = classes.select("rep", "dims", F.col("packed").alias("x"))
    two = classes.select(F.col("rep").alias("hub"), "dims", F.col("packed").alias("y"))
    return pairs.join(one, "rep").join(two, ["hub", "dims"]).select("rep", "hub", "dims", "x", "y").mapInArrow(run, "rep long, hub long")


def forest(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of links that connect all that the links ``hit`` connect, found layer by layer."""
    seen_row, seen_column, out = np.zeros(hit.shape[0], bool), np.zeros(hit.shape[1], bool), []
    for start in np.flatnonzero(hit.any(axis=1)).tolist():
        if seen_row[start]:
            continue
        seen_row[start], rows = True, np.array([start])
        while len(rows):
            columns = np.flatnonzero(hit[rows].any(axis=0) & ~seen_column)
            out.append((rows[hit[np.ix_(rows, columns)].argmax(axis=0)], columns))
            seen_column[columns] = True
            more = np.flatnonzero(hit[:, columns].any(axis=1) & ~seen_row)
            out.append((more, columns[hit[np.ix_(more, columns)].argmax(axis=1)] if len(more) else more))
            seen_row[more], rows = True, more
    return tuple(np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64) for k in (0, 1))


def _block_links(pairs: DataFrame, at_least: float) -> DataFrame:
    """(rep, n, other): per block pair, how many vectors each one links with (by class sizes; no ``other``), and the links of a
    spanning forest (n 0)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                batch = whole.slice(at, BATCH_ROWS)
                reps, counts, others = [], [], []
                for row in batch.to_pylist():
                    x, y = (unit(_unpack([row[k]], row["dims"])) for k in ("vx", "vy"))
                    rx, ry = (np.frombuffer(row[k], np.int64) for k in ("rx", "ry"))
                    sx, sy = (np.frombuffer(row[k], np.int64) for k in ("sx", "sy"))
                    hit = x @ y.T >= at_least
                    if row["same"]:  # a block with itself: every ordered pair is in the matrix
                        np.fill_diagonal(hit, False)
                    if not hit.any():
                        continue
                    for mine, sizes, link in ((rx, sy, hit),) if row["same"] else ((rx, sy, hit), (ry, sx, hit.T)):
                        n = link @ sizes
                        some = np.flatnonzero(n)
                        reps.append(mine[some])
                        counts.append(n[some])
                        others.append(np.full(len(some), -1))
                    i, j = forest(hit)
                    reps.append(rx[i])
                    counts.append(np.zeros(len(i), np.int64))
                    others.append(ry[j])
                flat = [np.concatenate(z) if z else np.empty(0, np.int64) for z in (reps, counts, others)]
                yield pa.RecordBatch.from_arrays([*(pa.array(z.astype(np.int64)) for z in flat[:2]), pa.array(flat[2].astype(np.int64), mask=flat[1] > 0)],
                                                 names=["rep", "n", "other"])

    return pairs.mapInArrow(run, "rep long, n long, other long")


def cell_pairs(in_bucket: DataFrame) -> DataFrame:
    """(cx, cy): pairs of different cells that share a bucket (bucket, cell)."""
    one, two = in_bucket.alias("p"), in_bucket.alias("q")
    return one.join(two, F.col("p.bucket") == F.col("q.bucket")).filter("p.cell < q.cell").select(
        F.col("p.cell").alias("cx"), F.col("q.cell").alias("cy")).distinct()


def near_duplicates(vectors: DataFrame, at_least: float = 0.95, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """vec_id, n_links, component_id, kept: a row for each row of ``vectors``.

    n_links: other rows whose cosine is at least ``at_least``; component_id: the smallest vec_id
    reachable by links, itself included; kept: vec_id = component_id. Vectors that are null,
    empty, zero or hold null or non-finite components link with nothing, as do vectors of
    different lengths. Rows of one id and one vector count as rows of their own. A null id
    links with nothing, has a null component and is kept. An empty table gives none; other
    columns are ignored.
    """
    rows = materialize(_packed(vectors, id_col, vector_col), "vectors")
    good = rows.filter(F.col("packed").isNotNull() & F.col("vec_id").isNotNull())
    kinds = materialize(good.groupBy("dims", "packed").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("size"))
                        .withColumn("rep", F.xxhash64("packed", "dims")), "vector-classes")
    classes = kinds.select("rep", "dims", "packed", "size", "least")

    placed = materialize(_in_buckets(classes), "vector-buckets")
    pick = F.struct(F.xxhash64("rep").alias("h"), "rep")
    shared = placed.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min(pick).alias("hub")).filter("n > 1")
    shared = materialize(shared.select("bucket", F.col("hub.rep").alias("hub")), "vector-hubs")
    met = materialize(placed.join(shared, "bucket"), "vector-met")
    stars = _confirmed(met.filter("rep != hub").select("rep", "hub").distinct(), classes, min(at_least, CELL_LIKENESS))
    first = stars.groupBy("rep").agg(F.min(F.struct(F.xxhash64("hub").alias("h"), "hub")).alias("best"))
    first = materialize(first.select("rep", F.col("best.hub").alias("hub")), "vector-first-hubs")
    # a hub stays in the cell that it names, so a cell's members are all like its hub
    named = first.select(F.col("hub").alias("rep")).distinct().withColumn("names", F.lit(True))
    cells = (classes.select("rep", "dims", "packed", "size").join(first, "rep", "left").join(named, "rep", "left")
             .withColumn("cell", F.when(F.col("names"), F.col("rep")).otherwise(F.coalesce("hub", "rep")))
             .drop("hub", "names"))
    cells = materialize(cells, "vector-cells")
    n_blocks = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("members")).select(
        "cell", F.ceil(F.col("members") / BLOCK).cast("int").alias("n_blocks"))
    n_blocks = materialize(n_blocks, "vector-cell-sizes")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for row in batch.to_pylist():
                m = row["members"]
                out.append({"cell": row["cell"], "block": row["block"], "dims": row["dims"],
                            "r": np.array([x["rep"] for x in m], np.int64).tobytes(),
                            "s": np.array([x["size"] for x in m], np.int64).tobytes(), "v": b"".join(x["packed"] for x in m)})
            yield pa.RecordBatch.from_pylist(out, schema=_BLOCKS)

    dealt = cells.join(n_blocks, "cell").withColumn("block", F.pmod(F.xxhash64("rep", F.lit(5)), F.col("n_blocks")).cast("int"))
    blocks = dealt.groupBy("cell", "block", "dims").agg(F.collect_list(F.struct("rep", "size", "packed")).alias("members"))
    blocks = materialize(blocks.mapInArrow(pack, "cell long, block int, dims int, r binary, s binary, v binary"), "vector-blocks")

    # pairs of cells that share a bucket, and every cell with itself
    in_bucket = materialize(met.join(cells.select("rep", "cell"), "rep").select("bucket", "cell").distinct(), "vector-bucket-cells")
    near = cell_pairs(in_bucket)
    own = n_blocks.join(cells.groupBy("cell").agg(F.count(F.lit(1)).alias("m")).filter("m > 1"), "cell").select(
        F.col("cell").alias("cx"), F.col("cell").alias("cy"))
    side = lambda c: n_blocks.select(F.col("cell").alias(f"c{c}"), F.col("n_blocks").alias(f"n{c}"))
    tasks = near.unionByName(own).join(side("x"), "cx").join(side("y"), "cy")
    tasks = tasks.withColumn("bx", F.explode(F.sequence(F.lit(0), F.col("nx") - 1))).withColumn("by", F.explode(F.sequence(F.lit(0), F.col("ny") - 1)))
    tasks = tasks.filter("cx != cy or bx <= by").select("cx", "bx", "cy", "by", F.expr("cx = cy and bx = by").alias("same"))
    block = lambda c: blocks.select(F.col("cell").alias(f"c{c}"), F.col("block").alias(f"b{c}"), "dims",
                                    *[F.col(k).alias(f"{k}{c}") for k in "rsv"])
    tasks = tasks.join(block("x"), ["cx", "bx"]).join(block("y"), ["cy", "by", "dims"]).select(
        "same", "dims", "rx", "sx", "vx", "ry", "sy", "vy")
    found = materialize(_block_links(tasks, at_least), "vector-links")
    counts = found.groupBy("rep").agg(F.sum("n").alias("n"))
    links = found.filter(F.col("other").isNotNull()).select(F.col("rep").alias("a"), F.col("other").alias("b"))
    labels = materialize(components(links), "vector-labels")
    least = labels.join(classes.select("rep", "least"), labels.node == classes.rep).groupBy("label").agg(F.min("least").alias("component_id"))
    of_class = (classes.join(counts, "rep", "left").join(labels.withColumnRenamed("node", "rep"), "rep", "left").join(least, "label", "left")
                .select("dims", "packed", (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"),
                        F.coalesce("component_id", "least").alias("component_id")))
    of_class = materialize(of_class, "vector-results")
    known = F.col("vec_id").isNotNull()
    out = rows.join(of_class, ["dims", "packed"], "left").select(
        "vec_id", F.when(known, F.coalesce("n_links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
        F.when(known, F.coalesce("component_id", "vec_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


_BLOCKS = pa.schema([("cell", pa.int64()), ("block", pa.int32()), ("dims", pa.int32()), ("r", pa.binary()), ("s", pa.binary()), ("v", pa.binary())])
