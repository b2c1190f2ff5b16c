"""Variable-capacity best-fit packing.

Documents are packed into sequences of several permitted lengths together: pieces go, longest
first, into the open sequence with the least room that takes them; if none does, the size is
opened whose cost, less the worth of the room left, is least; at the end every sequence is cut
down to the smallest permitted length that holds its contents. Several worths of room are
tried and the cheapest plan is used.

Pieces of one length are interchangeable, so the plan is made from the histogram of lengths
(at most as many rows as the longest permitted length), with runs of equal sequences handled
as intervals. It is the plan that packing all pieces one by one would give, whatever the
number of partitions, and its size depends on the permitted lengths, not on the documents.
Each piece then finds its sequence from its length and its rank among the pieces of that length.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections import defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from visitlens.llm.common import let_workers_import, materialize

#: Permitted sequence lengths, the cost of a sequence besides its length, worths of room tried.
CAPACITIES, OVERHEAD, WORTHS = (2048, 4096, 8192, 16384), 64, (0.0, 0.5, 0.9, 1.0)
#: Parts into which the pieces of one length are dealt for numbering them.
SALTS = 64
_SPAN = 1 << 44  # ranks within a length are below this


@dataclass(frozen=True)
class Plan:
    """Where pieces go: sorted starts (length * _SPAN + rank) of runs, their first sequence and offset;
    sorted first sequences of equal sequences, with their contents and permitted length; the total cost."""
    runs: np.ndarray
    run_bin: np.ndarray
    run_offset: np.ndarray
    bins: np.ndarray
    used: np.ndarray
    capacity: np.ndarray
    cost: int


def plan(histogram: dict[int, int], capacities: Sequence[int] = CAPACITIES, overhead: int = OVERHEAD,
         worths: Sequence[float] = WORTHS) -> Plan:
    """The cheapest plan for pieces of the histogram (length -> count, lengths from 1 to the largest capacity)."""
    sizes = sorted(capacities)
    return min((_best_fit(histogram, sizes, overhead, w) for w in worths), key=lambda p: p.cost)


def _best_fit(histogram: dict[int, int], sizes: list[int], overhead: int, worth: float) -> Plan:
    runs: list[tuple[int, int, int]] = []  # (start, bin, offset)
    room: dict[int, list[tuple[int, int, int]]] = defaultdict(list)  # room -> (first bin, bins, used)
    rooms: list[int] = []  # the keys of room with entries, sorted
    opened = 0

    def put(left: int, first: int, count: int, used: int) -> None:
        if not room[left]:
            insort(rooms, left)
        room[left].append((first, count, used))

    def fill(left: int, first: int, count: int, used: int, length: int, rank: int, n: int) -> int:
        """Put pieces into equal sequences, each filled before the next, as the room left is then the tightest."""
        each = left // length
        for some, layers in ((min(count, (n - rank) // each), each), (1, (n - rank) % each)):
            if some and layers and count and rank < n:
                for layer in range(layers):
                    runs.append((length * _SPAN + rank, first, used + layer * length))
                    rank += some
                put(left - layers * length, first, some, used + layers * length)
                first, count = first + some, count - some
        if count:
            put(left, first, count, used)
        return rank

    for length in sorted(histogram, reverse=True):
        n, rank = histogram[length], 0
        while rank < n:
            at = bisect_left(rooms, length)
            if at < len(rooms):
                left = rooms[at]
                first, count, used = room[left].pop()
                if not room[left]:
                    rooms.pop(at)
                rank = fill(left, first, count, used, length, rank, n)
            else:  # all other pieces of this length open sequences
                size = min((s for s in sizes if s >= length), key=lambda s: (s + overhead - worth * (s - length), s))
                count = -(-(n - rank) // (size // length))
                rank = fill(size, opened, count, 0, length, rank, n)
                opened += count
    groups = sorted(g for groups in room.values() for g in groups)
    first, count, used = (np.array([g[k] for g in groups], np.int64) for k in range(3))
    capacity = np.array(sizes, np.int64)[np.searchsorted(sizes, used)] if groups else used
    runs.sort()
    start, to, offset = (np.array([r[k] for r in runs], np.int64) for k in range(3))
    return Plan(start, to, offset, first, used, capacity, int(((capacity + overhead) * count).sum()))


def pieces(lengths: DataFrame, largest: int) -> DataFrame:
    """doc_id, piece, begin, length: documents cut into pieces of the largest permitted length and a rest.

    A null or zero length makes one piece of length 0.
    """
    n = F.greatest(F.coalesce(F.col("length").cast("long"), F.lit(0)), F.lit(0))
    last = F.greatest(F.ceil(n / F.lit(largest)).cast("int") - 1, F.lit(0))
    cut = lengths.select("doc_id", n.alias("total"), F.explode(F.sequence(F.lit(0), last)).alias("piece"))
    begin = F.col("piece").cast("long") * F.lit(largest)
    return cut.select("doc_id", "piece", begin.alias("begin"), F.least(F.col("total") - begin, F.lit(largest)).cast("long").alias("length"))


def pack(lengths: DataFrame, capacities: Sequence[int] = CAPACITIES, overhead: int = OVERHEAD,
         worths: Sequence[float] = WORTHS) -> DataFrame:
    """doc_id, piece, begin, length, bin_id, bin_offset, bin_used, bin_capacity: a row for each piece.

    ``lengths``: doc_id, length. Every piece of positive length is in one sequence, at
    ``bin_offset``; no two overlap; ``bin_capacity`` is the smallest permitted length that
    holds the sequence's ``bin_used``. Pieces of length 0 (null, zero or negative lengths)
    have no sequence (nulls). Null ids and repeated rows are packed like any row. An empty
    table gives none; other columns are ignored.

    The histogram and the counts by length and part (at most SALTS times the largest
    capacity) go through the driver; no document does.
    """
    let_workers_import(lengths.sparkSession)
    largest = max(capacities)
    cut = pieces(lengths.select("doc_id", "length"), largest)
    salted = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", F.lit(3)), F.lit(SALTS)).cast("int"))
    items = materialize(salted, "pack-pieces")
    positive = items.filter("length > 0")
    counts = np.zeros((largest + 1, SALTS), np.int64)
    for row in positive.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")).collect():
        counts[row.length, row.salt] = row.n
    totals = counts.sum(axis=1)
    done = plan({int(k): int(totals[k]) for k in np.flatnonzero(totals)}, capacities, overhead, worths)
    sent = lengths.sparkSession.sparkContext.broadcast((done, np.cumsum(counts, axis=1) - counts))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, before = sent.value
        for batch in batches:
            length, salt, turn = (np.asarray(batch.column(c), dtype=np.int64) for c in ("length", "salt", "turn"))
            key = length * _SPAN + before[length, salt] + turn - 1
            run = np.searchsorted(where.runs, key, side="right") - 1
            bin_id = where.run_bin[run] + key - where.runs[run]
            group = np.searchsorted(where.bins, bin_id, side="right") - 1
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in ("doc_id", "piece", "begin", "length")), pa.array(bin_id), pa.array(where.run_offset[run]),
                 pa.array(where.used[group]), pa.array(where.capacity[group])], names=_PLACED)

    kind = lengths.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, begin long, length long, bin_id long, bin_offset long, bin_used long, bin_capacity long"
    turn = F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece"))
    placed = positive.withColumn("turn", turn).mapInArrow(place, schema)
    nothing = items.filter("length <= 0").select("doc_id", "piece", "begin", "length", *[F.lit(None).cast("long").alias(c) for c in _PLACED[4:]])
    return placed.unionByName(nothing)


_PLACED = ["doc_id", "piece", "begin", "length", "bin_id", "bin_offset", "bin_used", "bin_capacity"]


def sequences(placed: DataFrame) -> DataFrame:
    """bin_id, bin_capacity, bin_used, parts: a row for each sequence, its pieces in order (bounded by the largest capacity)."""
    part = F.struct("bin_offset", "doc_id", "piece", "begin", "length")
    return placed.filter(F.col("bin_id").isNotNull()).groupBy("bin_id", "bin_capacity", "bin_used").agg(
        F.sort_array(F.collect_list(part)).alias("parts"))
