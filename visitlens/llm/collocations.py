"""Phrase collocations: mergeable Misra-Gries summaries find every frequent n-gram, a second pass counts them.

First pass: tasks hash the n-grams of their texts, add up equal ones of a chunk and send them, packed and
sorted, to hash partitions of n-grams. Each partition merges what it gets into one Misra-Gries summary. Its
capacity is SLACK times the partition's mass over the least count, so that no counter has lost more than a
SLACK-th of the least count: every n-gram that frequent survives, whatever the tasks' shares of it.

Second pass: a Bloom filter of fixed size over the survivors is broadcast; n-grams that pass it are added up
in each task, sent in blocks to hash partitions and added up by their words: counts are exact, false survivors
fall away.

Scores, cuts and containment are joins and aggregates over the frequent phrases alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from visitlens.llm.common import _LOWER, HashIndex, cuts, let_workers_import, materialize, mix64, span_hashes
from visitlens.operators.joins import broadcast_if_small

#: A counter loses at most 1 / SLACK of the least count; bits of the survivors' Bloom filter (16 MB).
SLACK, FILTER_BITS = 4, 27
#: Text of one hash partition; n-grams that a task adds up before sending; phrases it counts before sending.
PART_BYTES, CHUNK, KNOWN = 4 << 20, 5 << 18, 1 << 18
#: Most hash partitions; beyond 256 GB of text a partition's summary grows instead.
MAX_PARTS = 1 << 16

_BREAK = np.zeros(256, bool)
_BREAK[[*b".,;:!?", *range(0x0A, 0x0E)]] = True
_GAP = _BREAK.copy()
_GAP[[0x20, 0x09]] = True
_P = np.uint64(0x9E3779B97F4A7C15)


class Grams:
    """Hashes of all n-grams of a slice of texts, and their words on demand."""

    def __init__(self, texts: list[str], langs: np.ndarray, most: int):
        blobs = [t.encode() for t in texts]
        raw = _LOWER[np.frombuffer(b"\n".join(blobs) + b"\n", np.uint8)]
        gap = _GAP[raw]
        before = np.concatenate(([True], gap[:-1]))
        self.begin, self.end = np.flatnonzero(before & ~gap), np.flatnonzero(gap & ~before)
        self.blob = raw.tobytes()
        self.owner = np.searchsorted(np.cumsum([len(b) + 1 for b in blobs]), self.begin, side="right")
        piece = np.cumsum(_BREAK[raw])[self.begin]
        words = span_hashes(raw, self.begin, self.end)
        #: for each length from 1: the first words of its n-grams and their hashes
        self.first, self.hashes = [], []
        at = np.arange(len(words))
        with np.errstate(over="ignore"):
            last = mix64(words ^ langs[self.owner]) if len(words) else words
            for k in range(1, most + 1):
                if k > 1:
                    inside = at + k - 1 < len(words)
                    at, last = at[inside], last[inside]
                    inside = piece[at] == piece[at + k - 1]
                    at, last = at[inside], last[inside]
                    last = mix64(last * _P + words[at + k - 1])
                self.first.append(at)
                self.hashes.append(last)

    def phrase(self, first: int, k: int) -> bytes:
        return b" ".join(self.blob[self.begin[first]:self.end[first + k - 1]].split())


def _add_up(keys: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order and their counts; without ``counts``, ``keys`` itself is sorted."""
    if counts is None:
        keys.sort()
    else:
        order = np.argsort(keys, kind="stable")
        keys, counts = keys[order], counts[order]
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    at = np.concatenate(([0], np.flatnonzero(keys[1:] != keys[:-1]) + 1))
    return keys[at], np.diff(at, append=len(keys)) if counts is None else np.add.reduceat(counts, at)


def _squeeze(values: np.ndarray) -> bytes:
    """Non-negative integers as compressed planes of bytes."""
    return pa.compress(values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), codec="zstd", asbytes=True)


def _unsqueeze(blob: bytes, n: int) -> np.ndarray:
    planes = np.frombuffer(pa.decompress(blob, 8 * n, codec="zstd", asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, n).T).view("<u8").ravel()


class Summary:
    """A Misra-Gries summary as sorted keys and counters; ``lost``: the most that a counter lacks."""

    def __init__(self, capacity: int):
        self.capacity, self.lost = capacity, 0
        self.keys, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.waiting: list[tuple[np.ndarray, np.ndarray]] = []

    def add(self, keys: np.ndarray, counts: np.ndarray) -> None:
        self.waiting.append((keys, counts))
        if sum(len(k) for k, _ in self.waiting) >= max(self.capacity, CHUNK // 4):
            self.merge()

    def merge(self) -> None:
        """Counters of equal keys add up; then all lose the one after the capacity-th, if there is one."""
        if not self.waiting:
            return
        keys, counts = (np.concatenate(x) for x in zip((self.keys, self.counts), *self.waiting))
        self.waiting = []
        keys, counts = _add_up(keys, counts)
        if len(keys) > self.capacity:
            at = len(keys) - self.capacity - 1
            less = np.partition(counts, at)[at]
            stay = counts > less
            keys, counts, self.lost = keys[stay], counts[stay] - less, self.lost + int(less)
        self.keys, self.counts = keys, counts

    def reaching(self, least: int) -> np.ndarray:
        """All keys that may have occurred ``least`` times."""
        self.merge()
        return self.keys[self.counts + self.lost >= least]


def _lang_hashes(column: pa.Array) -> np.ndarray:
    return np.asarray(column, dtype=np.int64).astype(np.uint64)


def _sent(texts: DataFrame, most: int, bits: int, parts: int) -> DataFrame:
    """Packed n-gram counts by hash partition: rows of kind 0 hold the mass, of kind 1 a block of cells."""
    edges = np.array([-(-(p << bits) // parts) for p in range(parts + 1)], np.uint64)

    def blocks(waiting: list[np.ndarray], mass: np.ndarray) -> pa.RecordBatch:
        cells = np.concatenate(waiting)
        waiting.clear()
        cells >>= np.uint64(64 - bits)
        cells, counts = _add_up(cells)
        at = np.searchsorted(cells, edges)
        sums = np.concatenate(([0], np.cumsum(counts)))
        mass += np.diff(sums[at])
        some = np.flatnonzero(np.diff(at))
        gaps = np.diff(cells, prepend=np.uint64(0))
        gaps[at[some]] = cells[at[some]] - edges[some]
        cut = list(zip(at[some].tolist(), at[some + 1].tolist()))
        return pa.RecordBatch.from_arrays(
            [pa.array(some, pa.int32()), pa.array(np.ones(len(some)), pa.int32()), pa.array([b - a for a, b in cut], pa.int64()),
             pa.array([_squeeze(gaps[a:b]) for a, b in cut], pa.binary()), pa.array([_squeeze(counts[a:b]) for a, b in cut], pa.binary())],
            names=["part", "kind", "n", "cells", "counts"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size, mass = [], 0, np.zeros(parts, np.int64)
        for batch in batches:
            langs = _lang_hashes(batch.column(0))
            for a, b in cuts(batch.column(1), 1 << 20):
                for hashes in Grams(batch.column(1).slice(a, b - a).to_pylist(), langs[a:b], most).hashes:
                    waiting.append(hashes)
                    size += len(hashes)
                if size >= CHUNK:
                    yield blocks(waiting, mass)
                    size = 0
        if size:
            yield blocks(waiting, mass)
        some = np.flatnonzero(mass)
        none = pa.nulls(len(some), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), pa.array(np.zeros(len(some)), pa.int32()), pa.array(mass[some]), none, none],
                                         names=["part", "kind", "n", "cells", "counts"])

    return texts.select("lang_hash", "text").mapInArrow(run, "part int, kind int, n long, cells binary, counts binary")


def _bit_positions(cells: np.ndarray) -> list[np.ndarray]:
    mixed, mask = mix64(cells), np.uint64((1 << FILTER_BITS) - 1)
    return [mixed & mask, (mixed >> np.uint64(FILTER_BITS)) & mask]


def _survivor_bits(sent: DataFrame, least: int, bits: int, parts: int) -> DataFrame:
    """Positions in the Bloom filter of all cells that may have occurred ``least`` times."""
    def out(part: int, summary: Summary | None) -> pa.RecordBatch:
        cells = summary.reaching(least) if summary else np.zeros(0, np.uint64)
        cells = cells + np.uint64(-(-(part << bits) // parts))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(_bit_positions(cells)).astype(np.int64))], names=["bit"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, mass, summary = -1, 0, None
        for batch in batches:
            parts_of, kinds, ns = (batch.column(k).to_pylist() for k in range(3))
            for i, (p, kind, n) in enumerate(zip(parts_of, kinds, ns)):
                if p != part:
                    if summary:
                        yield out(part, summary)
                    part, mass, summary = p, 0, None
                if kind == 0:  # all of a partition's mass comes before its first block
                    mass += n
                    continue
                summary = summary or Summary(SLACK * mass // least + 1)
                gaps = _unsqueeze(batch.column(3)[i].as_py(), n)
                summary.add(np.cumsum(gaps, dtype=np.uint64), _unsqueeze(batch.column(4)[i].as_py(), n).astype(np.int64))
        if summary:
            yield out(part, summary)

    dealt = sent.repartition(max(1, parts // 2), "part").sortWithinPartitions("part", "kind")
    return dealt.mapInArrow(run, "bit long")


def _filter(bits: DataFrame) -> np.ndarray:
    """The Bloom filter, gathered as pages of 32,768 bits: at most 2^FILTER_BITS bits whatever the input."""
    pages = bits.groupBy(F.shiftright("bit", 15).alias("page")).agg(
        F.bitmap_construct_agg(F.col("bit").bitwiseAND(F.lit(32767).cast("long"))).alias("bits")).collect()
    out = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    for r in pages:
        out[r.page << 12:r.page + 1 << 12] = np.frombuffer(bytes(r.bits), np.uint8)
    return out


_PHRASES = "part int, lang array<string>, phrase array<string>, n_words array<int>, f array<long>"


def _counted(texts: DataFrame, most: int, bits: int, parts: int, survivors: np.ndarray) -> DataFrame:
    """Blocks of phrases by hash partition with their counts in a task: n-grams that pass the filter; the phrase of no
    words counts all words."""
    sent = texts.sparkSession.sparkContext.broadcast(survivors)

    class Counts:
        """Counts of distinct n-grams by their hashes."""

        def __init__(self):
            self.index, self.keys, self.counts = HashIndex(), [], np.zeros(0, np.int64)
            self.langs: list[str] = []
            self.phrases: list[bytes] = []
            self.sizes: list[int] = []

        def add(self, grams: Grams, names: list[str], k: int, first: np.ndarray, hashes: np.ndarray) -> None:
            keys, where, n = np.unique(hashes, return_index=True, return_counts=True)
            place = self.index.find(keys)
            new = np.flatnonzero(place < 0)
            if len(new):
                place[new] = self.index.size + np.arange(len(new))
                self.index.add(keys[new])
                self.keys.append(keys[new])
                at = first[where[new]]
                self.langs += [names[i] for i in grams.owner[at].tolist()]
                self.phrases += [grams.phrase(i, k) for i in at.tolist()]
                self.sizes += [k] * len(new)
                self.counts = np.concatenate([self.counts, np.zeros(len(new), np.int64)])
            self.counts[place] += n

        def blocks(self, total: dict[tuple[str, int], int]) -> pa.RecordBatch:
            keys = np.concatenate([*self.keys, np.array([h for _, h in total], np.int64).astype(np.uint64)])
            flat = [pa.array(self.langs + [lang for lang, _ in total], pa.string()),
                    pa.array(self.phrases + [b""] * len(total), pa.binary()).cast(pa.string()),
                    pa.array(self.sizes + [0] * len(total), pa.int32()),
                    pa.array(np.concatenate([self.counts, np.array(list(total.values()), np.int64)]))]
            part = (keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
            order = np.argsort(part, kind="stable")
            some, at = np.unique(part[order], return_index=True)
            at = pa.array(np.append(at, len(order)), pa.int32())
            lists = [pa.ListArray.from_arrays(at, column.take(pa.array(order))) for column in flat]
            return pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), *lists], names=["part", "lang", "phrase", "n_words", "f"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        passing, counts = sent.value, Counts()
        total: dict[tuple[str, int], int] = {}
        for batch in batches:
            lang_hashes = _lang_hashes(batch.column(0))
            for a, b in cuts(batch.column(1), 1 << 20):
                names = batch.column(2).slice(a, b - a).to_pylist()
                grams = Grams(batch.column(1).slice(a, b - a).to_pylist(), lang_hashes[a:b], most)
                n = np.bincount(grams.owner, minlength=b - a).tolist()
                for key, words in zip(zip(names, lang_hashes[a:b].astype(np.int64).tolist()), n):
                    total[key] = total.get(key, 0) + words
                for k, (first, hashes) in enumerate(zip(grams.first, grams.hashes), 1):
                    hit = np.ones(len(hashes), bool)
                    for at in _bit_positions(hashes >> np.uint64(64 - bits)):
                        hit &= (passing[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1
                    counts.add(grams, names, k, first[hit], hashes[hit])
                if counts.index.size >= KNOWN:
                    yield counts.blocks({})
                    counts = Counts()
        yield counts.blocks(total)

    return texts.select("lang_hash", "text", "lang").mapInArrow(run, _PHRASES)


def _added(blocks: DataFrame, least: int, parts: int) -> DataFrame:
    """lang, phrase, n_words, f: the blocks of each partition added up by language and words."""
    columns = ["lang", "phrase", "n_words", "f"]

    def add(tables: list[pa.Table]) -> pa.Table:
        got = pa.concat_tables(tables).group_by(columns[:3]).aggregate([("f", "sum")])
        return got.rename_columns(["f" if c == "f_sum" else c for c in got.column_names]).select(columns)

    def out(waiting: list[pa.Table]) -> Iterator[pa.RecordBatch]:
        if waiting:
            done = add(waiting)
            yield from done.filter(pc.or_(pc.greater_equal(done["f"], least), pc.equal(done["n_words"], 0))).to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, waiting, size = -1, [], 0
        for batch in batches:
            for i, p in enumerate(batch.column(0).to_pylist()):
                if p != part:
                    yield from out(waiting)
                    part, waiting, size = p, [], 0
                waiting.append(pa.table([batch.column(k)[i].values for k in range(1, 5)], names=columns))
                size += waiting[-1].num_rows
                if size > 2 * waiting[0].num_rows + KNOWN // 4:  # what is kept is the sums so far, at the front
                    waiting = [add(waiting)]
                    size = waiting[0].num_rows
        yield from out(waiting)

    dealt = blocks.repartition(max(1, parts // 2), "part").sortWithinPartitions("part")
    return dealt.mapInArrow(run, "lang string, phrase string, n_words int, f long")


def frequent_phrases(docs: DataFrame, least: int = 100, most: int = 5, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """lang, phrase, n_words, f: exact counts of all phrases of 1 to ``most`` words that occur ``least`` times in their
    language, and the count of all words (the phrase of no words, whatever its count)."""
    let_workers_import(docs.sparkSession)
    lang = F.coalesce(F.col(lang_col).cast("string"), F.lit("und"))
    texts = docs.select(lang.alias("lang"), F.xxhash64(lang).alias("lang_hash"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = texts.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
    parts = min(max(1, size // PART_BYTES), MAX_PARTS)
    # cells have 256 times as many values as there can be n-grams, so few share one; a shared cell only adds a survivor
    bits = min(max(32, (size * most // 2).bit_length() + 8), 46)
    survivors = _filter(_survivor_bits(_sent(texts, most, bits, parts), least, bits, parts))
    return materialize(_added(_counted(texts, most, bits, parts, survivors), least, parts), "phrases")


def _part(words: Column, start: Column, length: Column) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def collocations(docs: DataFrame, least: int = 100, most: int = 5, top: int = 2000, percent: int = 100, text_col: str = "text",
                 lang_col: str = "lang") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: each language's ``top`` phrases of 2 to ``most`` words.

    Texts (A-Z in lower case) are cut at ``[.,;:!?\\x0A-\\x0D]`` into pieces and those into words
    ``[^\\x20\\x09]+``. a: the phrase's count (``least`` or more), n: all words of the language. The phrase is cut in two
    where floor(1000 * a * n / (l * r)) is least (l, r: counts of the parts; ties to the shorter first part). Phrases
    inside a longer candidate that occurs at least ``percent`` % as often are dropped. Order: score, a descending, phrase in
    UTF-8 byte order.

    Null language: ``und``. Null, empty and blank texts hold no words; repeated rows count again; an empty table gives
    no rows; other columns are ignored. Very long texts are counted whole.
    """
    counts = frequent_phrases(docs, least, most, text_col, lang_col)
    n = broadcast_if_small(counts.filter("n_words = 0").select("lang", F.col("f").alias("n")))
    words = F.split("phrase", " ")
    size = F.col("n_words")
    candidates = counts.filter("n_words > 1").select("lang", "phrase", "n_words", F.col("f").alias("a"))

    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda m: F.transform(
        F.sequence(F.lit(1), size - m + 1), lambda at: _part(words, at, m))))
    longer = (candidates.filter("n_words > 2").select("lang", "a", F.explode(inner).alias("phrase"))
              .groupBy("lang", "phrase").agg(F.max("a").alias("of_longer")))
    stay = (candidates.join(longer, ["lang", "phrase"], "left")
            .filter(F.col("of_longer").isNull() | (100 * F.col("of_longer") < percent * F.col("a"))).drop("of_longer"))

    part = counts.filter("n_words > 0").select("lang", "phrase", "f")
    k = F.col("k")
    halves = (stay.withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
              .select("lang", "phrase", "a", "k", _part(words, F.lit(1), k).alias("left"), _part(words, k + 1, size - k).alias("right")))
    halves = halves.join(part.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"])
    halves = halves.join(part.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"]).join(n, "lang")
    # decimal arithmetic of 38 digits: products pass 64 bits, the quotient doesn't
    score = F.expr("(cast(1000 * a as decimal(19, 0)) * cast(n as decimal(19, 0))) div (cast(l as decimal(19, 0)) * cast(r as decimal(19, 0)))")
    best = (halves.withColumn("score", score).groupBy("lang", "phrase")
            .agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"), F.first("a").alias("a"), F.first("n").alias("n")))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
            .withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
            .select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score"))
