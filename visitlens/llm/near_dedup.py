"""Near-duplicate documents by SetSketch registers, banding, likelihood and exact checks.

A document's set of word shingles is summarised by registers: truncated minima on an
exponential scale, ``K = floor(1 - log_b(h / a))`` of the least exponential hash value h.
Registers merge by maximum, and two sets agree in a register with about the probability of
their Jaccard similarity. Four registers of 16 bits make one band.

1. Documents with equal sets are one class; only classes go on.
2. In every bucket (classes with one band value) all classes are paired with one hub, so a
   bucket of n classes makes n - 1 pairs, whatever n. The joint likelihood of the registers and the
   known set sizes estimates their similarity; a class joins the cell of the first hub, in a
   fixed random order, that is at least somewhat like it (CELL_LIKENESS). So a group of
   thousands of near copies is one cell, or a few, whether or not its members link with each other.
3. Cells that share a bucket of at most CROWD cells are paired. A passage that many unlike texts
   hold gathers more cells in a bucket. The classes of such buckets are paired by their rare registers instead:
   two at the threshold agree in 76 of the 128 registers, so each forgets its 75 commonest values and
   still shares one of the others; the passage's values are among the forgotten ones.
4. Paired cells, and cells with themselves, are compared whole, in blocks: first
   the registers (pairs of blocks without a likely pair go no further; likely means an
   estimate of at least the threshold less five standard deviations), then the full sets, whose intersections are
   products of incidence matrices. Only a spanning forest of each block pair's links leaves
   the task, never its pairs.
5. Links make components.

With 32 bands a pair of similarity 0.8 meets in no bucket with probability (1 - 0.8^4)^32 < 6e-8, and
agrees in fewer than 76 registers with probability below 3e-8.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from visitlens.llm.common import id_text, materialize, mix64, slices, text_slices, word_hashes
from visitlens.llm.components import components

REGISTERS, BAND = 128, 4
#: Estimated similarity at which a class joins a hub's cell; it decides what is compared together, not what is linked.
CELL_LIKENESS = 0.3
#: Cells of a bucket that are paired with each other; it decides how pairs are found, not which.
CROWD = 32
#: Classes in a block of a cell, shingles in a slice of an incidence matrix.
BLOCK, SLICE = 128, 4096
#: The sketch's scale: base and rate. Largest value with 32-bit hashes: about 25,200.
BASE, RATE = 1.001, 20.0
#: A surrogate node id, for a class whose smallest document id names another class already.
SURROGATE = 1 << 62

_rng = np.random.default_rng(7)
_A = _rng.integers(0, 2**32, REGISTERS, dtype=np.uint32) | np.uint32(1)
_B = _rng.integers(0, 2**32, REGISTERS, dtype=np.uint32)


# ---------------------------------------------------------------- sets and sketches
def shingle_sets(texts: list[str], width: int) -> list[np.ndarray]:
    """Every text's set of ``width``-word shingles as sorted 64-bit hashes.

    Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased. A text of fewer words has its
    whole sequence as the only shingle; a text without words has none.
    """
    words, starts = word_hashes(texts)
    n = len(words)
    rolled = np.zeros(max(0, n - width + 1), np.uint64)
    factors = mix64(np.arange(1, width + 1, dtype=np.uint64)) | np.uint64(1)
    with np.errstate(over="ignore"):
        for k in range(width):
            rolled += words[k:n - width + 1 + k] * factors[k]
        rolled = mix64(rolled)
        out = []
        for a, b in zip(starts[:-1].tolist(), starts[1:].tolist()):
            if b - a >= width:
                s = np.sort(rolled[a:b - width + 1])
                out.append(s[np.concatenate(([True], s[1:] != s[:-1]))])
            elif b > a:
                out.append(mix64((words[a:b] * factors[:b - a]).sum(keepdims=True, dtype=np.uint64) + np.uint64(b - a)))
            else:
                out.append(np.empty(0, np.uint64))
    return out


def registers(hashes: np.ndarray) -> np.ndarray:
    """The SetSketch registers (uint16) of a set of hashes; all 0 for an empty set."""
    half = REGISTERS // 2
    least = np.full(REGISTERS, 0xFFFFFFFF, np.uint32)
    low, high = hashes.astype(np.uint32), (hashes >> np.uint64(32)).astype(np.uint32)
    for at in range(0, len(hashes), 2048):
        for part, span in ((low, slice(0, half)), (high, slice(half, None))):
            values = part[at:at + 2048, None] * _A[span] + _B[span]
            np.minimum(least[span], values.min(axis=0), out=least[span])
    if not len(hashes):
        return np.zeros(REGISTERS, np.uint16)
    x = -np.log1p(-(least.astype(np.float64) + 0.5) / 2**32) / RATE
    return np.clip(np.floor(1 - np.log(x) / np.log(BASE)), 0, 65535).astype(np.uint16)


def merge(one: np.ndarray, other: np.ndarray) -> np.ndarray:
    """Registers of a union."""
    return np.maximum(one, other)


def joint_estimate(n_a: np.ndarray, n_b: np.ndarray, above: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Similarities of greatest likelihood, given set sizes and how many registers of a are above and below b's."""
    u = n_a / (n_a + n_b)
    v = 1 - u
    equal = REGISTERS - above - below
    step = (BASE - 1) / BASE

    def likelihood(j):
        p = -np.log1p(-np.clip(u - v * j, 1e-12, None) * step) / np.log(BASE)
        q = -np.log1p(-np.clip(v - u * j, 1e-12, None) * step) / np.log(BASE)
        return above * np.log(p) + below * np.log(q) + equal * np.log(np.clip(1 - p - q, 1e-12, None))

    low, high = np.zeros(len(u)), np.minimum(u / v, v / u)
    golden = (np.sqrt(5) - 1) / 2
    for _ in range(24):  # the likelihood has one maximum
        left, right = high - golden * (high - low), low + golden * (high - low)
        up = likelihood(left) < likelihood(right)
        low, high = np.where(up, left, low), np.where(up, high, right)
    return (low + high) / 2


def _sketches(docs: DataFrame, width: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for ids, texts in text_slices([batch.select([0, 1])], 1 << 20):
                text_hash = batch.column(2).slice(at, len(texts))
                at += len(texts)
                yield sketch(ids, texts, text_hash)

    def sketch(ids: pa.Array, texts: list[str], text_hash: pa.Array) -> pa.RecordBatch:
        sets = shingle_sets(texts, width)
        with np.errstate(over="ignore"):
            marks = np.array([[s.sum(dtype=np.uint64), np.bitwise_xor.reduce(mix64(s ^ np.uint64(0x5851F42D4C957F2D)))] for s in sets], np.uint64)
        marks = marks.reshape(-1, 2).view(np.int64)
        return pa.RecordBatch.from_arrays(
            [ids, text_hash, pa.array([len(s) for s in sets], pa.int64()), pa.array(marks[:, 0]), pa.array(marks[:, 1]),
             pa.array([registers(s).tobytes() for s in sets], pa.binary())],
            names=["doc_id", "text_hash", "n_shingles", "mark1", "mark2", "registers"])

    return id_text(docs).withColumn("text_hash", text_hash()).mapInArrow(
        run, "doc_id long, text_hash long, n_shingles long, mark1 long, mark2 long, registers binary")


def text_hash() -> Column:
    """What tells texts of one id apart."""
    return F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))


def _bands(nodes: DataFrame) -> DataFrame:
    """(bucket, node): a row for each band."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        salt = mix64(np.arange(REGISTERS // BAND, dtype=np.uint64) + np.uint64(1))
        for batch in batches:
            if not batch.num_rows:
                continue
            words = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint64).reshape(batch.num_rows, -1)
            keys = mix64(words ^ salt).view(np.int64)
            node = np.repeat(np.asarray(batch.column(0), dtype=np.int64), keys.shape[1])
            yield pa.RecordBatch.from_arrays([pa.array(keys.ravel()), pa.array(node)], names=["bucket", "node"])

    return nodes.select("node", "registers").mapInArrow(run, "bucket long, node long")


def _least_estimate(percent: int) -> float:
    j = percent / 100
    return j - 5 * np.sqrt(j * (1 - j) / REGISTERS)


def least_agreeing(percent: int) -> int:
    """Registers in which two sets of that similarity agree at least, but for a chance below 6e-8; a band, as they share a bucket."""
    j, below = percent / 100, 0.0
    for k in range(REGISTERS):
        below += comb(REGISTERS, k) * j**k * (1 - j)**(REGISTERS - k)
        if below >= 6e-8:
            return max(k, BAND)
    return REGISTERS


def _registers(blobs: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blobs), np.uint16).reshape(-1, REGISTERS)


def _alike(pairs: DataFrame, nodes: DataFrame, at_least: float) -> DataFrame:
    """(node, hub) of the pairs whose similarity is estimated at ``at_least`` or more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = _registers(batch.column("rx").to_pylist()), _registers(batch.column("ry").to_pylist())
            n_x, n_y = (np.asarray(batch.column(c), dtype=np.float64) for c in ("nx", "ny"))
            j = joint_estimate(n_x, n_y, (x > y).sum(axis=1), (x < y).sum(axis=1))
            yield batch.select(["node", "hub"]).filter(pa.array(j >= at_least))

    one = nodes.select("node", F.col("n_shingles").alias("nx"), F.col("registers").alias("rx"))
    two = nodes.select(F.col("node").alias("hub"), F.col("n_shingles").alias("ny"), F.col("registers").alias("ry"))
    sized = pairs.join(one, "node").join(two, "hub").filter(F.least("nx", "ny") >= at_least * F.greatest("nx", "ny"))
    return sized.select("node", "hub", "nx", "ny", "rx", "ry").mapInArrow(run, "node long, hub long")


def _register_values(classes: DataFrame) -> DataFrame:
    """(node, cell, block, value): a row for each register; different registers have different values."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places = np.arange(REGISTERS, dtype=np.int64) << 16
        for batch in slices(batches):
            values = places | _registers(batch.column("registers").to_pylist())
            row = pa.array(np.repeat(np.arange(batch.num_rows), REGISTERS))
            of = batch.select(["node", "cell", "block"]).take(row)
            yield pa.RecordBatch.from_arrays([*of.columns, pa.array(values.ravel())], names=["node", "cell", "block", "value"])

    return classes.select("node", "cell", "block", "registers").mapInArrow(run, "node long, cell long, block int, value long")


def _rare_pairs(classes: DataFrame, percent: int) -> DataFrame:
    """(cx, bx, cy, by): blocks of different cells that hold classes with a rare register in common.

    Values are ordered by the number of classes that have them. Of two classes that agree in ``least_agreeing``
    registers, each drops one value fewer, its commonest ones: the rarest value that they share stays in both.
    """
    values = _register_values(classes)
    common = values.groupBy("value").agg(F.count(F.lit(1)).alias("held")).filter("held > 1")
    turn = F.row_number().over(Window.partitionBy("node").orderBy(F.desc("held"), "value"))
    rare = values.join(common, "value").withColumn("turn", turn).filter(F.col("turn") >= least_agreeing(percent))
    rare = materialize(rare.select("value", "cell", "block").distinct(), "near-rare-values")
    side = lambda c: rare.select("value", F.col("cell").alias(f"c{c}"), F.col("block").alias(f"b{c}"))
    return side("x").join(side("y"), "value").filter("cx < cy").select("cx", "bx", "cy", "by").distinct()


def _likely_blocks(pairs: DataFrame, percent: int) -> DataFrame:
    """(cx, bx, cy, by) of the block pairs with a likely pair of different classes."""
    def fitting(n_x: np.ndarray, n_y: np.ndarray) -> np.ndarray:
        return 100 * np.minimum(n_x, n_y) >= percent * np.maximum(n_x, n_y)

    def likely(n_x: np.ndarray, n_y: np.ndarray, above: np.ndarray, below: np.ndarray) -> np.ndarray:
        return joint_estimate(n_x, n_y, above, below) >= _least_estimate(percent)

    def any_likely(n_x, x, n_y, y, same: bool) -> bool:
        for at in range(0, len(n_x), 16):  # 16 rows against a whole block at a time
            pick = fitting(n_x[at:at + 16, None], n_y)
            if same:
                pick &= np.arange(at, at + len(pick))[:, None] < np.arange(len(n_y))
            if not pick.any():
                continue
            u = x[at:at + 16, None, :]
            above, below = (u > y).sum(axis=2)[pick], (u < y).sum(axis=2)[pick]
            i, j = np.nonzero(pick)
            if likely(n_x[at + i], n_y[j], above, below).any():
                return True
        return False

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_x, r_x, n_y, r_y = (batch.column(c).to_pylist() for c in ("nx", "rx", "ny", "ry"))
            keep = np.zeros(batch.num_rows, bool)
            alone = np.array([len(a) == 8 and len(b) == 8 for a, b in zip(n_x, n_y)], bool)
            of = np.flatnonzero(alone)
            if len(of):  # pairs of single classes, all at once
                a, b = (np.frombuffer(b"".join(n[k] for k in of), np.float64) for n in (n_x, n_y))
                x, y = (_registers([r[k] for k in of]) for r in (r_x, r_y))
                keep[of] = fitting(a, b) & likely(a, b, (x > y).sum(axis=1), (x < y).sum(axis=1))
            same = [a == b and c == d for a, b, c, d in zip(*(batch.column(c).to_pylist() for c in ("cx", "cy", "bx", "by")))]
            for k in np.flatnonzero(~alone).tolist():
                keep[k] = any_likely(np.frombuffer(n_x[k], np.float64), _registers([r_x[k]]), np.frombuffer(n_y[k], np.float64), _registers([r_y[k]]), same[k])
            yield batch.select(["cx", "bx", "cy", "by"]).filter(pa.array(keep))

    return pairs.mapInArrow(run, "cx long, bx int, cy long, by int")


def intersections(one: list[np.ndarray], two: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of every set of ``one`` with every set of ``two`` (sorted hashes)."""
    if len(one) * len(two) <= 16:
        return np.array([[len(np.intersect1d(x, y, assume_unique=True)) for y in two] for x in one], np.int64).reshape(len(one), len(two))
    shared = np.intersect1d(np.concatenate(one), np.concatenate(two))
    out = np.zeros((len(one), len(two)), np.int64)
    sides = []
    for sets in (one, two):
        whole, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
        at = np.searchsorted(shared, whole)
        there = at < len(shared)
        there[there] = shared[at[there]] == whole[there]
        order = np.argsort(at[there], kind="stable")
        sides.append((at[there][order], owner[there][order], len(sets)))
    for low in range(0, len(shared), SLICE):
        slabs = []
        for column, owner, n in sides:
            a, b = np.searchsorted(column, (low, low + SLICE))
            slab = np.zeros((n, SLICE), np.float32)
            slab[owner[a:b], column[a:b] - low] = 1
            slabs.append(slab)
        out += (slabs[0] @ slabs[1].T).astype(np.int64)
    return out


def _forest(hit: np.ndarray, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
    """Links that connect what the links ``hit`` (left x right) connect, one fewer than the nodes of each tree."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.setdefault(x, x) != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    out = []
    for i, j in zip(*(z.tolist() for z in np.nonzero(hit))):
        a, b = find(int(left[i])), find(int(right[j]))
        if a != b:
            parent[a] = b
            out.append((int(left[i]), int(right[j])))
    return out


def _squeezed(docs: DataFrame, nodes: DataFrame, width: int) -> DataFrame:
    """(node, squeezed): the compressed text of each class's smallest document."""
    import zstandard

    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdCompressor(level=3)
        for ids, texts in text_slices(batches, 1 << 20):
            yield pa.RecordBatch.from_arrays([ids, pa.array([coder.compress(t.encode()) for t in texts], pa.binary())], names=["doc_id", "squeezed"])

    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Only the text with the class's mark, should an id have several texts."""
        coder = zstandard.ZstdDecompressor()
        for batch in batches:
            keep = []
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                sets = shingle_sets([coder.decompress(x).decode() for x in part.column("squeezed").to_pylist()], width)
                with np.errstate(over="ignore"):
                    keep += [int(s.sum(dtype=np.uint64).view(np.int64)) == m for s, m in zip(sets, part.column("mark1").to_pylist())]
            yield batch.select(["node", "squeezed"]).filter(pa.array(keep, pa.bool_()))

    packed = id_text(docs).mapInArrow(squeeze, "doc_id long, squeezed binary")
    named = nodes.select("node", F.col("rep").alias("doc_id"), "mark1")
    return packed.join(named, "doc_id").select("node", "mark1", "squeezed").mapInArrow(mark, "node long, squeezed binary").dropDuplicates(["node"])


def _links(pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """(a, b): for each block pair a spanning forest of its pairs with 100 * intersection >= percent * union of the full sets."""
    import zstandard

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = zstandard.ZstdDecompressor()

        def side(members) -> tuple[np.ndarray, list[np.ndarray], np.ndarray]:
            sets = shingle_sets([coder.decompress(m["squeezed"]).decode() for m in members], width)
            return np.array([m["node"] for m in members]), sets, np.array([len(s) for s in sets])

        for batch in batches:
            out = []
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                (x, sx, nx), (y, sy, ny) = side(row["mx"]), side(row["my"])
                both = intersections(sx, sy)
                hit = (100 * both >= percent * (nx[:, None] + ny - both)) & (x[:, None] != y)
                out += _forest(hit, x, y)
            yield pa.RecordBatch.from_arrays([pa.array([p[k] for p in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    return pairs.mapInArrow(run, "a long, b long")


# ---------------------------------------------------------------- the operator
def _pack_sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        members = batch.column(2).to_pylist()
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1),
             pa.array([np.array([m["n_shingles"] for m in row], np.float64).tobytes() for row in members], pa.binary()),
             pa.array([b"".join(m["registers"] for m in row) for row in members], pa.binary())], names=["cell", "block", "n", "r"])


def block_ids(pairs: DataFrame) -> DataFrame:
    """The distinct (cell, block) of block pairs."""
    sides = [pairs.select(F.col(f"c{c}").alias("cell"), F.col(f"b{c}").alias("block")) for c in "xy"]
    return sides[0].unionByName(sides[1]).distinct()


def near_duplicates(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: a row for each row of ``docs``.

    Documents are linked when the Jaccard similarity of their shingle sets is at least
    ``percent`` / 100. component_id: the smallest doc_id reachable by links, itself included;
    kept: doc_id = component_id. Null, empty or blank texts have an empty set and link with
    nothing; a null id gets a null component and is kept. Repeated rows get equal results; an
    id with several texts has one row each, judged by its own text. An empty table gives none;
    other columns are ignored. A text is handled whole.
    """
    return _judged(docs, width, percent).select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("component_id", "doc_id")).cast("long").alias("component_id")
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def survivors(docs: DataFrame, width: int = 5, percent: int = 80) -> DataFrame:
    """stay_id, stay_hash: the id and ``text_hash`` of one row of each component, the smallest; of an id's empty sets, of one.

    Texts of one id are judged each on its own: an unlike one stays. Rows without an id aren't among them.
    """
    named = _judged(docs, width, percent).filter(F.col("doc_id").isNotNull())
    least = F.min(F.struct("doc_id", "text_hash")).alias("s")
    some = named.filter("n_shingles > 0").groupBy("component").agg(least).select("s.doc_id", "s.text_hash")
    none = named.filter("n_shingles = 0").groupBy("doc_id").agg(F.min("text_hash").alias("text_hash"))
    return some.unionByName(none).toDF("stay_id", "stay_hash")


def _judged(docs: DataFrame, width: int, percent: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id, component (a component's own number): a row for each row of ``docs``."""
    sketched = materialize(_sketches(docs, width), "near-sketches")
    whole = sketched.filter((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    key = ["n_shingles", "mark1", "mark2"]
    classes = whole.groupBy(*key).agg(F.min("doc_id").alias("rep"))
    turn = F.row_number().over(Window.partitionBy("rep").orderBy("mark1", "mark2"))
    own = F.lit(SURROGATE).bitwiseOR(F.shiftrightunsigned(F.xxhash64("mark1", "mark2"), 2))
    classes = classes.withColumn("node", F.when(turn == 1, F.col("rep")).otherwise(own))
    classes = materialize(classes, "near-classes")
    nodes = materialize(whole.withColumnRenamed("doc_id", "rep").join(classes, ["rep", *key])
                        .dropDuplicates(["node"]), "near-nodes")

    bands = _bands(nodes)
    pick = F.struct(F.xxhash64("node").alias("h"), "node")
    buckets = materialize(bands.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.min(pick).alias("hub"))
                          .filter("n > 1").select("bucket", F.col("hub.node").alias("hub")), "near-buckets")
    shared = materialize(bands.join(buckets, "bucket"), "near-shared")
    stars = _alike(shared.filter("node != hub").select("node", "hub").distinct(), nodes, CELL_LIKENESS)
    first = stars.groupBy("node").agg(F.min(F.struct(F.xxhash64("hub").alias("h"), "hub")).alias("best"))
    first = materialize(first.select("node", F.col("best.hub").alias("hub")), "near-first-hubs")
    # a hub stays in the cell that it names; classes that share no bucket have nothing to compare
    named = first.select(F.col("hub").alias("node")).distinct().withColumn("names", F.lit(True))
    cells = (nodes.join(shared.select("node").distinct(), "node", "left_semi").join(first, "node", "left").join(named, "node", "left")
             .withColumn("cell", F.when(F.col("names"), F.col("node")).otherwise(F.coalesce("hub", "node"))))
    sizes = cells.groupBy("cell").agg(F.count(F.lit(1)).alias("members"))
    dealt = cells.join(sizes, "cell").withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int")).withColumn(
        "block", F.pmod(F.xxhash64("node", F.lit(5)), F.col("blocks")).cast("int"))
    dealt = materialize(dealt.select("node", "cell", "block", "blocks", "members", "rep", "mark1", "n_shingles", "registers"), "near-cells")

    # pairs of cells that share a bucket, and cells of several classes with themselves
    met = materialize(shared.join(dealt.select("node", "cell", "blocks"), "node").select("bucket", "cell", "blocks").distinct(), "near-bucket-cells")
    crowds = materialize(met.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > CROWD).select("bucket"), "near-crowds")
    few = met.join(crowds, "bucket", "left_anti")
    one = few.select("bucket", F.col("cell").alias("cx"), F.col("blocks").alias("kx"))
    two = few.select("bucket", F.col("cell").alias("cy"), F.col("blocks").alias("ky"))
    near = one.join(two, "bucket").filter("cx < cy").select("cx", "kx", "cy", "ky").distinct()
    own = dealt.filter("members > 1").select(F.col("cell").alias("cx"), F.col("blocks").alias("kx"), F.col("cell").alias("cy"), F.col("blocks").alias("ky")).distinct()
    pairs = near.unionByName(own)
    for c in "xy":
        pairs = pairs.withColumn(f"b{c}", F.explode(F.sequence(F.lit(0), F.col(f"k{c}") - 1)))
    pairs = pairs.filter("cx != cy or bx <= by").select("cx", "bx", "cy", "by")
    crowded = shared.join(crowds, "bucket", "left_semi").select("node").distinct()
    pairs = pairs.unionByName(_rare_pairs(dealt.join(crowded, "node", "left_semi"), percent)).distinct()

    sketch_blocks = materialize(dealt.groupBy("cell", "block").agg(F.sort_array(F.collect_list(F.struct("node", "n_shingles", "registers"))).alias("m"))
                                .mapInArrow(_pack_sketches, "cell long, block int, n binary, r binary"), "near-sketch-blocks")
    block = lambda of, c, *kept: of.select(F.col("cell").alias(f"c{c}"), F.col("block").alias(f"b{c}"), *[F.col(k).alias(f"{k}{c}") for k in kept])
    compared = pairs.join(block(sketch_blocks, "x", "n", "r"), ["cx", "bx"]).join(block(sketch_blocks, "y", "n", "r"), ["cy", "by"])
    # few bytes, much work: dealt evenly over a set number of tasks, which Spark doesn't merge
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    likely = materialize(_likely_blocks(compared.repartition(tasks), percent), "near-block-pairs")

    wanted = block_ids(likely)
    chosen = dealt.join(wanted, ["cell", "block"], "left_semi").select("node", "rep", "mark1", "cell", "block")
    texts = _squeezed(docs, chosen, width).join(chosen.select("node", "cell", "block"), "node")
    text_blocks = materialize(texts.groupBy("cell", "block").agg(F.collect_list(F.struct("node", "squeezed")).alias("m")), "near-text-blocks")
    links = _links(likely.join(block(text_blocks, "x", "m"), ["cx", "bx"]).join(block(text_blocks, "y", "m"), ["cy", "by"]).select("mx", "my").repartition(tasks), width, percent)
    labels = components(materialize(links, "near-links"))

    least = labels.join(nodes.select("node", "rep"), "node").groupBy("label").agg(F.min("rep").alias("component_id"))
    of_node = classes.join(labels, "node", "left").join(least, "label", "left")
    of_class = materialize(of_node.select(*key, F.coalesce("component_id", "rep").alias("component_id"), F.coalesce("label", "node").alias("component")), "near-components")
    return sketched.drop("registers").join(of_class, key, "left").select("doc_id", "text_hash", "n_shingles", "component_id", "component")
