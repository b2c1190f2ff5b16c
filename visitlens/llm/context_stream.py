"""Language-model scores by context-tree weighting over the running bytes of texts.

A text is coded byte by byte as it stands (A-Z lower-cased), white space included, and the byte
EDGE, which no UTF-8 text holds, at its end. The contexts of a byte are the DEPTH bytes before
it, whatever they are: blanks and earlier words count, and EDGE bytes stand before a text.
Trees, mixing and code lengths are those of ``context_tree``.

An event is a byte with its DEPTH context bytes. Tasks count the distinct events of their texts and
send them on packed; the trees give every distinct event one log probability; a text adds up
those of its events. Frequent events (a table of at most FREQUENT_EVENTS) are added up where
the text is read; only rare ones are joined with the table of all events. The unigram baseline
is computed along, in the same way, from the words.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import _LOWER, HashIndex, id_text, materialize, text_slices, word_hashes
from visitlens.llm.context_tree import DEPTH, END_HASH, FREQUENT, event_scores

#: The byte at the end of a text and before its beginning.
EDGE = 0xFF
#: Entries of the broadcast table of frequent events.
FREQUENT_EVENTS = 1 << 21
#: Entries that a task gathers before it adds up equal ones, and distinct ones at which it sends them on.
GATHER, SEND = 1 << 21, 3 << 19
#: Bytes of text counted or scored at a time.
SLICE = 1 << 20

Counts = tuple[np.ndarray, np.ndarray, np.ndarray]  # distinct sorted keys, training counts, all counts


def stream_events(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(keys, starts): per coded byte, the DEPTH bytes before it (last one highest) and the byte (lowest); where each text's begin."""
    gap = bytes([EDGE]) * 8
    blobs = [t.encode() for t in texts]
    raw = _LOWER[np.frombuffer(b"".join([gap, *(x for b in blobs for x in (b, gap))]), np.uint8)]
    sizes = np.array([len(b) for b in blobs], np.int64)
    before = np.ndarray(len(raw) - 8, "<u8", raw, strides=(1,))  # the eight bytes before raw[8:], last one highest
    unseen = np.uint64(64 - 8 * DEPTH)
    keys = before >> unseen
    keys <<= unseen
    keys |= raw[8:]
    coded = np.ones(len(keys), bool)  # of the gap after a text, only its first byte
    coded[(np.cumsum(sizes + 8)[:, None] - 1 - np.arange(7)).ravel()] = False
    return keys[coded], np.concatenate(([0], np.cumsum(sizes + 1)))


# ---------------------------------------------------------------- counting
def _add_up(parts: list[Counts]) -> Counts:
    keys = np.concatenate([p[0] for p in parts])
    order = np.argsort(keys)
    keys = keys[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))[:len(keys)])
    c, n = (np.add.reduceat(np.concatenate([p[k] for p in parts])[order], first) if len(first) else np.empty(0, np.int64) for k in (1, 2))
    return keys[first], c, n


class _Gathered:
    """Counts of a task, equal keys added up at every GATHER entries."""

    def __init__(self) -> None:
        self.parts: list[Counts] = []
        self.size = 0

    def add(self, part: Counts) -> None:
        self.parts.append(part)
        self.size += len(part[0])

    def seen(self, keys: np.ndarray, taught: np.ndarray) -> None:
        for some, teaches in ((keys[taught], 1), (keys[~taught], 0)):
            kinds, n = np.unique(some, return_counts=True)
            self.add((kinds, n * teaches, n))

    def squeeze(self) -> int:
        """Distinct keys, as far as they're known to be."""
        if self.size > GATHER:
            self.parts = [_add_up(self.parts)]
            self.size = len(self.parts[0][0])
            return self.size
        return 0

    def take(self) -> Counts | None:
        out = _add_up(self.parts) if self.parts else None
        self.parts, self.size = [], 0
        return out


def _pack(counts: Counts) -> bytes:
    """Differences of the sorted keys and the counts, byte planes compressed."""
    columns = (np.diff(counts[0], prepend=np.uint64(0)), *counts[1:])
    return zlib.compress(np.concatenate([x.astype("<u8").view(np.uint8).reshape(-1, 8).T.ravel() for x in columns]), 1)


def _unpack(blob: bytes) -> Counts:
    planes = np.frombuffer(zlib.decompress(blob), np.uint8).reshape(3, 8, -1)
    delta, c, n = (np.ascontiguousarray(p.T).view("<u8").ravel() for p in planes)
    return np.cumsum(delta, dtype=np.uint64), c.astype(np.int64), n.astype(np.int64)


def _count(docs: DataFrame, parts: int) -> DataFrame:
    """(word, key, c, n): training counts and all counts of distinct words (by hash) and distinct events.

    ``parts``: into which counts are dealt, events by their last two context bytes.
    """
    schema = pa.schema([("part", pa.int32()), ("word", pa.bool_()), ("blob", pa.binary())])

    def out(counts: Counts | None, word: bool) -> Iterator[pa.RecordBatch]:
        if counts is None:
            return
        part = ((counts[0] if word else counts[0] >> np.uint64(48)) % np.uint64(parts)).astype(np.int32)
        order = np.argsort(part, kind="stable")
        part, *counts = part[order], *(x[order] for x in counts)
        at = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(part)]
        spans = [(a, b) for a, b in zip(at, at[1:]) if b > a]
        yield pa.RecordBatch.from_arrays(
            [pa.array(part[[a for a, _ in spans]]), pa.array(np.full(len(spans), word)),
             pa.array([_pack(tuple(x[a:b] for x in counts)) for a, b in spans], pa.binary())], schema=schema)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, events = _Gathered(), _Gathered()
        for batch in batches:
            at = 0
            for _, texts in text_slices([batch.select([0, 1])], SLICE):
                train = np.asarray(batch.column(2).slice(at, len(texts)).cast(pa.int8()), dtype=bool)
                at += len(texts)
                hashes, starts = word_hashes(texts)
                words.seen(hashes, np.repeat(train, np.diff(starts)))
                words.add((np.array([END_HASH], np.uint64), np.array([train.sum()]), np.array([len(texts)])))
                keys, starts = stream_events(texts)
                events.seen(keys, np.repeat(train, np.diff(starts)))
                for kept, word in ((words, True), (events, False)):
                    if kept.squeeze() > SEND:
                        yield from out(kept.take(), word)
        for kept, word in ((words, True), (events, False)):
            yield from out(kept.take(), word)

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = {True: _Gathered(), False: _Gathered()}
        for batch in batches:
            for word, blob in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                kept[word].add(_unpack(blob))
                kept[word].squeeze()
        for word, some in kept.items():
            counts = some.take()
            if counts is not None:
                keys, c, n = counts
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), word)), pa.array(keys.view(np.int64)), pa.array(c), pa.array(n)],
                                                 names=["word", "key", "c", "n"])

    packed = docs.select("doc_id", "text", "train").mapInArrow(count, "part int, word boolean, blob binary")
    return packed.repartition("part").select("part", "word", "blob").mapInArrow(combine, "word boolean, key long, c long, n long")


# ---------------------------------------------------------------- texts
#: Parts of the rows of one count, of which some may still fit into a table.
_SHARES = 1024


def _heaviest(table: DataFrame, room: int) -> Column:
    """A condition that holds for about the ``room`` rows of the greatest counts ``n``, never for more.

    Counts go by their first 16 bits; of the rows of the first count that doesn't fit as a whole, those with the
    smallest remainders of a hash of ``key`` are taken. The driver gets a number per such count and per remainder.
    """
    low = "greatest(length(bin(n)) - 16, 0)"
    step, share = F.expr(f"shiftleft(shiftright(n, {low}), {low})"), F.pmod(F.xxhash64("key"), F.lit(_SHARES))
    least = None  # the smallest count that fits as a whole
    for r in sorted(table.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("rows")).collect(), key=lambda r: -r.step):
        if r.rows <= room:
            least, room = r.step, room - r.rows
            continue
        part = dict(table.where(step == F.lit(r.step)).groupBy(share.alias("share")).agg(F.count(F.lit(1)).alias("rows")).collect())
        shares = 0
        while shares < _SHARES and part.get(shares, 0) <= room:
            room -= part.get(shares, 0)
            shares += 1
        some = (step == F.lit(r.step)) & (share < F.lit(shares))
        return some if least is None else (step >= F.lit(least)) | some
    return F.lit(False) if least is None else step >= F.lit(least)


def _arrays(table: DataFrame, kinds: dict[str, type]) -> list[np.ndarray]:
    got = table.select(*kinds).toArrow()
    return [np.asarray(got.column(k).combine_chunks()).astype(t) if got.num_rows else np.empty(0, t) for k, t in kinds.items()]


def _pairs(whose: np.ndarray, which: np.ndarray, kinds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs of a text and a number below ``kinds``, and how often each is there."""
    pair, times = np.unique(whose * kinds + which, return_counts=True)
    return pair // max(kinds, 1), pair % max(kinds, 1), times


_SUM_COLUMNS = ("row long, doc_id long, n_bytes long, n_tokens long, n_known long, base double, log10 double, "
                "word boolean, key long, times long")
_SUM_NAMES = ["row", "doc_id", "n_bytes", "n_tokens", "n_known", "base", "log10", "word", "key", "times"]


def _text_sums(docs: DataFrame, table) -> DataFrame:
    """Per text one row (row, doc_id, n_bytes, n_tokens, n_known, base, log10) over its frequent words and events,
    and a row (row, word, key, times) for each of its other distinct words and events."""
    def rare(rows: np.ndarray, word: bool, keys: np.ndarray, times: np.ndarray) -> pa.RecordBatch:
        n = len(rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(rows), *(pa.nulls(n, pa.int64()) for _ in range(4)), *(pa.nulls(n, pa.float64()) for _ in range(2)),
             pa.array(np.full(n, word)), pa.array(keys.view(np.int64)), pa.array(times.astype(np.int64))], names=_SUM_NAMES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, row = TaskContext.get().partitionId() << 40, 0
        hashes, known, base, events, log10 = table.value
        index = HashIndex(hashes)
        for ids, texts in text_slices(batches, SLICE):
            count = len(texts)
            rows = task + row + np.arange(count)
            row += count
            found, starts = word_hashes(texts)
            whose = np.repeat(np.arange(count), np.diff(starts))
            where = index.find(found)
            often = where >= 0
            known_sum, base_sum = (np.bincount(whose[often], x[where[often]], count) for x in (known, base))
            if not often.all():
                kinds, which = np.unique(found[~often], return_inverse=True)
                who, kind, times = _pairs(whose[~often], which, len(kinds))
                yield rare(rows[who], True, kinds[kind], times)
            n_tokens = np.diff(starts) + 1

            keys, starts = stream_events(texts)
            kinds, which = np.unique(keys, return_inverse=True)
            at = np.minimum(np.searchsorted(events, kinds), max(len(events) - 1, 0))
            hit = events[at] == kinds if len(events) else np.zeros(len(kinds), bool)
            value = np.zeros(len(kinds))
            value[hit] = log10[at[hit]]
            sums = np.add.reduceat(value[which], starts[:-1])
            if not hit.all():
                place = np.flatnonzero(~hit[which])
                who, kind, times = _pairs(np.searchsorted(starts, place, side="right") - 1, which[place], len(kinds))
                yield rare(rows[who], False, kinds[kind], times)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows), ids, pa.array(np.diff(starts) - 1), pa.array(n_tokens), pa.array(known_sum.astype(np.int64)),
                 pa.array(base_sum.astype(np.float64)), pa.array(sums), pa.nulls(count, pa.bool_()), pa.nulls(count, pa.int64()), pa.nulls(count, pa.int64())],
                names=_SUM_NAMES)

    return docs.select("doc_id", "text").mapInArrow(run, _SUM_COLUMNS)


def score(docs: DataFrame, training: Column, frequent: int = FREQUENT, frequent_events: int = FREQUENT_EVENTS) -> DataFrame:
    """doc_id, n_bytes, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte: a row for each row of ``docs``.

    ``training``: a condition on doc_id; those rows' texts teach the model, all rows are scored.
    base_score: sum over tokens (words and one end) of log10((c + 1) / (N + V + 1)) with a
    token's count c, all N and distinct V training tokens. score: the model's log10
    probability of the text; bits_per_byte: its code length over the bytes coded, which are the
    text's n_bytes and one end.

    Null or empty text: its end alone. A null condition (null id) teaches nothing; null ids and repeated rows are kept,
    repeated training rows count as often as they are there. Without any training text all
    counts are 0 and every decision has probability 1/2. An empty table gives none; other
    columns are ignored. The driver gets sums, at most ``frequent`` words and ``frequent_events`` events.
    """
    spark = docs.sparkSession
    rows = id_text(docs).withColumn("train", F.coalesce(training, F.lit(False)))
    counted = materialize(_count(rows, 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))), "ctw-counts")
    events = materialize(event_scores(counted.filter(~F.col("word")).select("key", "c", "n")), "ctw-event-scores")
    words = counted.filter("word")
    whole = words.agg(F.sum("c").alias("tokens"), F.count(F.when(F.col("c") > 0, 1)).alias("kinds")).first()
    tokens, kinds = whole.tokens or 0, whole.kinds or 0
    base = F.log10((F.col("c") + 1) / F.lit(float(tokens + kinds + 1)))
    words = words.select("key", "n", (F.col("c") > 0).cast("long").alias("known"), base.alias("base"))
    end = words.filter(F.col("key") == END_HASH).first()  # added to every text below
    end_known, end_base = (end.known, end.base) if end else (0, 0.0)
    words = words.filter(F.col("key") != END_HASH)

    often, often_event = _heaviest(words, frequent), _heaviest(events, frequent_events)
    hashes, *of_words = _arrays(words.filter(often), {"key": np.int64, "known": np.int64, "base": np.float64})
    keys, log10 = _arrays(events.filter(often_event), {"key": np.int64, "log10": np.float64})
    order = np.argsort(keys.view(np.uint64))
    table = spark.sparkContext.broadcast((hashes.view(np.uint64), *of_words, keys.view(np.uint64)[order], log10[order]))

    sums = materialize(_text_sums(rows, table), "ctw-text-sums")
    table.destroy()  # its only reader is a stored table now
    zero = F.lit(0.0)
    others = words.filter(~often).select(F.lit(True).alias("word"), "key", "known", "base", zero.alias("log10")).unionByName(
        events.filter(~often_event).select(F.lit(False).alias("word"), "key", F.lit(0).cast("long").alias("known"), zero.alias("base"), "log10"))
    rare = sums.filter(F.col("key").isNotNull()).select("row", "word", "key", "times").join(others, ["word", "key"])
    rare = rare.groupBy("row").agg(*[F.sum(F.col("times") * F.col(k)).alias(f"rare_{k}") for k in ("known", "base", "log10")])
    out = sums.filter(F.col("key").isNull()).drop("word", "key", "times").join(rare, "row", "left")
    add = lambda c, r, e: F.col(c) + F.coalesce(F.col(r), F.lit(0)) + F.lit(e)
    out = out.select("doc_id", "n_bytes", "n_tokens", add("n_known", "rare_known", end_known).cast("long").alias("n_known"),
                     F.lit(tokens).cast("long").alias("train_tokens"), add("base", "rare_base", end_base).alias("base_score"),
                     add("log10", "rare_log10", 0.0).alias("score"))
    return out.withColumn("bits_per_byte", -F.col("score") * F.lit(float(np.log2(10))) / (F.col("n_bytes") + 1))
