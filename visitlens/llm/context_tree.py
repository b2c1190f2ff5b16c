"""Trees of context-tree weighting over bytes.

A byte is eight binary decisions, each with a context tree of its own over the bytes before it (at most DEPTH). Every
node estimates its decisions with the Krichevsky-Trofimov rule; a node's weighted probability is half its own
estimate and half the product of its children's, which mixes all depths. The code length of a text is the sum over its
decisions, each predicted by the mixture along its path (``context_stream``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import materialize

#: Context bytes (at most 7), and entries of the broadcast table of frequent words.
DEPTH, FREQUENT = 6, 1 << 19
#: The end of a text as a word of its own: its hash.
END_HASH = 0
_SYM = np.uint64(0xFF)
#: Events whose trees a task builds at a time; those of one triple of last bytes stay together.
CHUNK = 1 << 16


def _log_gamma_half(n: np.ndarray) -> np.ndarray:
    """log Gamma(n + 1/2), by recursion up to 8 and Stirling's series."""
    x = n + 0.5
    shift = np.zeros_like(x)
    small = x < 8
    while small.any():
        shift[small] -= np.log(x[small])
        x = np.where(small, x + 1, x)
        small = x < 8
    return shift + (x - 0.5) * np.log(x) - x + 0.5 * np.log(2 * np.pi) + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5)


def kt_log(zeros: np.ndarray, ones: np.ndarray) -> np.ndarray:
    """Natural logarithm of the Krichevsky-Trofimov probability of a sequence with these counts."""
    total = zeros + ones
    # Gamma(total + 1) from the half-integer function at total + 1/2
    return _log_gamma_half(zeros) + _log_gamma_half(ones) - np.log(np.pi) - _log_gamma_half(total + 0.5)


def _mix(own: np.ndarray, below: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(log weighted probability, weight of stopping) of half ``own`` and half ``below`` (both logs)."""
    whole = np.logaddexp(own, below) - np.log(2)
    return whole, np.exp(own - np.log(2) - whole)


def _decisions(pair: np.ndarray, counts: np.ndarray):
    """Nodes of a level from its (context << 8 | byte) pairs: (nodes, zeros, ones, node of each pair and bit)."""
    byte, context = pair & _SYM, pair & ~_SYM
    bit = np.arange(8, dtype=np.uint64)
    prefix = (np.uint64(1) << bit) | (byte[:, None] >> (np.uint64(8) - bit))
    nodes, which = np.unique((context[:, None] | prefix).ravel(), return_inverse=True)
    ones = ((byte[:, None] >> (np.uint64(7) - bit)) & np.uint64(1)).ravel().astype(bool)
    weight = np.repeat(counts, 8)
    return nodes, np.bincount(which, weight * ~ones, len(nodes)), np.bincount(which, weight * ones, len(nodes)), which.reshape(-1, 8)


def _parent(node: np.ndarray) -> np.ndarray:
    return ((node >> np.uint64(16)) << np.uint64(8)) | (node & _SYM)


class Subtree:
    """Levels TOP to DEPTH of all trees over events that hold every event of their last TOP bytes."""
    TOP = 3

    def __init__(self, keys: np.ndarray, counts: np.ndarray):
        self.pair = ((keys >> np.uint64(64 - 8 * DEPTH)) << np.uint64(8)) | (keys & _SYM)
        pair, counts = self.pair, counts.astype(np.float64)
        self.levels = []
        for depth in range(DEPTH, self.TOP - 1, -1):
            nodes, zeros, ones, which = _decisions(pair, counts)
            if depth == DEPTH:
                self.which = which
            own = kt_log(zeros, ones)
            if self.levels:
                child = self.levels[-1]
                up = np.searchsorted(nodes, _parent(child["nodes"]))
                child["up"] = up
                whole, stop = _mix(own, np.bincount(up, child["whole"], len(nodes)))
            else:
                whole, stop = own, np.ones(len(nodes))
            self.levels.append({"nodes": nodes, "zeros": zeros, "ones": ones, "whole": whole, "stop": stop})
            if depth > self.TOP:
                pair, of = np.unique(_parent(pair), return_inverse=True)
                counts = np.bincount(of, counts, len(pair))

    def top(self) -> dict[str, np.ndarray]:
        return self.levels[-1]

    def log10(self, above) -> np.ndarray:
        """log10 probability of each event; ``above(nodes)``: (sum so far of weight * estimate, weight left) above TOP's nodes."""
        told, left = above(self.levels[-1]["nodes"])
        for k in range(len(self.levels) - 1, -1, -1):
            level = self.levels[k]
            if k < len(self.levels) - 1:
                told, left = told[level["up"]], left[level["up"]]
            told = told + left * level["stop"] * (level["ones"] + 0.5) / (level["zeros"] + level["ones"] + 1)
            left = left * (1 - level["stop"])
        bits = ((self.pair & _SYM)[:, None] >> np.arange(7, -1, -1, dtype=np.uint64)) & np.uint64(1)
        one = told[self.which]
        return np.log10(np.where(bits == 1, one, 1 - one)).sum(axis=1)


class Crown:
    """Levels 0 and 1 of the trees (at most 256 * 255 nodes), from the sums of their level-2 nodes."""

    def __init__(self, nodes: np.ndarray, zeros: np.ndarray, ones: np.ndarray, below: np.ndarray):
        order = np.argsort(nodes)
        self.nodes, zeros, ones, below = (x[order] for x in (nodes, zeros, ones, below))
        whole, stop = _mix(kt_log(zeros, ones), below)
        root, up = np.unique(self.nodes & _SYM, return_inverse=True)
        z, o, w = (np.bincount(up, x, len(root)) for x in (zeros, ones, whole))
        _, root_stop = _mix(kt_log(z, o), w)
        left = 1 - root_stop[up]
        self.told = (root_stop * (o + 0.5) / (z + o + 1))[up] + left * stop * (ones + 0.5) / (zeros + ones + 1)
        self.left = left * (1 - stop)

    def __call__(self, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.searchsorted(self.nodes, nodes)
        return self.told[at], self.left[at]


def _chunks(keys: np.ndarray) -> Iterator[np.ndarray]:
    """Places of the events in pieces of about CHUNK, each with all events of its triples of last bytes."""
    order = np.argsort(keys)
    last = keys[order] >> np.uint64(40)
    begins = np.concatenate(([0], np.flatnonzero(np.diff(last)) + 1, [len(keys)]))
    a = 0
    while a < len(keys):
        b = int(begins[max(np.searchsorted(begins, a + CHUNK, side="right") - 1, np.searchsorted(begins, a, side="right"))])
        yield order[a:b]
        a = b


def _columns(batches: list[pa.RecordBatch], names: list[str]) -> list[np.ndarray]:
    return [np.concatenate([np.asarray(b.column(c)) for b in batches]) for c in names]


def _parent_column(node: str) -> Column:
    return F.shiftleft(F.shiftrightunsigned(node, 16), 8).bitwiseOR(F.col(node).bitwiseAND(F.lit(0xFF)))


def event_scores(counted: DataFrame) -> DataFrame:
    """(key, log10): the trained trees' probability of every event of ``counted`` (key, c); a count ``n`` stays, if there.

    Events are dealt by their last three context bytes: everything below those in the trees
    stays in one task, whose size is the number of distinct contexts and bytes there, not of
    words, and which builds them in pieces. Nodes of three and of two bytes are rows of tables, so the events of a
    frequent pair of bytes are in as many tasks as bytes stand before it. What is above
    comes from sums of at most 256 * 255 rows.
    """
    def tops(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batches = [b for b in batches if b.num_rows]
        if not batches:
            return
        keys, counts = _columns(batches, ["key", "c"])
        keys = keys.view(np.uint64)
        for some in _chunks(keys):
            top = Subtree(keys[some], counts[some]).top()
            yield pa.RecordBatch.from_arrays([pa.array(top["nodes"].view(np.int64)), *(pa.array(top[k]) for k in ("zeros", "ones", "whole"))],
                                             names=["node", "zeros", "ones", "whole"])

    def mixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            zeros, ones, below = (np.asarray(b.column(k)) for k in (1, 2, 3))
            whole, stop = _mix(kt_log(zeros, ones), below)
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array(whole), pa.array(stop)], names=["node", "zeros", "ones", "whole", "stop"])

    def downwards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            node, zeros, ones, stop = (np.asarray(b.column(k)) for k in ("node", "zeros", "ones", "stop"))
            told, left = crown.value(_parent(node.view(np.uint64)))
            yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(told + left * stop * (ones + 0.5) / (zeros + ones + 1)), pa.array(left * (1 - stop))],
                                             names=["above", "told", "left"])

    stay = [c for c in counted.columns if c == "n"]

    def scores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        events, above = [], []
        for b in batches:
            is_event = b.column("told").is_null()
            events.append(b.select(["key", "c", *stay]).filter(is_event))
            above.append(b.select(["key", "told", "left"]).filter(b.column("told").is_valid()))
        if not events:
            return
        nodes, told, left = _columns(above, ["key", "told", "left"])
        order = np.argsort(nodes)
        nodes, told, left = nodes[order].view(np.uint64), told[order], left[order]

        def look(of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            at = np.searchsorted(nodes, of)
            return told[at], left[at]

        keys, counts, *kept = _columns(events, ["key", "c", *stay])
        for some in _chunks(keys.view(np.uint64)):
            log10 = Subtree(keys[some].view(np.uint64), counts[some]).log10(look)
            yield pa.RecordBatch.from_arrays([pa.array(keys[some]), *(pa.array(k[some]) for k in kept), pa.array(log10)], names=["key", *stay, "log10"])

    events = counted.select(F.shiftrightunsigned("key", 40).alias("last"), "key", "c", *stay)
    top = materialize(events.repartition("last").select("key", "c").mapInArrow(tops, "node long, zeros double, ones double, whole double"), "ctw-tops")
    add = [F.sum(k).alias(k) for k in ("zeros", "ones", "whole")]
    pairs = top.groupBy(_parent_column("node").alias("node")).agg(*add).select("node", "zeros", "ones", "whole")
    pairs = materialize(pairs.mapInArrow(mixed, "node long, zeros double, ones double, whole double, stop double"), "ctw-pairs")
    sums = pairs.groupBy(_parent_column("node").alias("node")).agg(*add).collect()
    columns = [np.array([r[k] for r in sums], np.float64) for k in ("zeros", "ones", "whole")]
    crown = counted.sparkSession.sparkContext.broadcast(Crown(np.array([r.node for r in sums], np.uint64), *columns))
    down = pairs.select("node", "zeros", "ones", "stop").mapInArrow(downwards, "above long, told double, left double")
    above = top.select("node", _parent_column("node").alias("above")).join(down, "above").select(
        F.shiftrightunsigned("node", 8).alias("last"), F.col("node").alias("key"), "told", "left")
    both = events.unionByName(above, allowMissingColumns=True).repartition("last").select("key", "c", *stay, "told", "left")
    return both.mapInArrow(scores, ", ".join(["key long", *[f"{c} long" for c in stay], "log10 double"]))
