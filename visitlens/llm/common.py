"""Helpers shared by the operators: column picking, checkpoints, worker caches, word arrays."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from visitlens.session import checkpoint_dir

#: Rows of an Arrow batch that a task turns into Python strings at a time.
SLICE_ROWS = 256


def let_workers_import(spark: SparkSession) -> None:
    """In local mode, Python workers find this package where the driver did.

    On a cluster the package is installed or shipped with --py-files.
    """
    sc = spark.sparkContext
    if sc.master.startswith("local") and "PYTHONPATH" not in sc.environment:
        sc.environment["PYTHONPATH"] = str(Path(__file__).parents[2])


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only id and text (null text: empty); other columns, whatever their names, fall away."""
    let_workers_import(docs.sparkSession)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the shared checkpoint folder and read it back.

    Cuts the lineage without a machine-local copy: the files outlive any executor.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batches: Iterable[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of at most ``rows`` rows, so that few texts are Python objects at once."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


class WorkerCache(dict):
    """key -> compute(key) with two generations of at most ``limit`` entries each.

    A dict subclass, so that ``map(cache.__getitem__, keys)`` stays in C for hits. When the
    young generation is full it becomes the old one; keys still in use move back on their
    next miss, the others vanish with the old generation.
    """

    def __init__(self, compute, limit: int):
        super().__init__()
        self.compute, self.limit, self.old = compute, limit, {}

    def __missing__(self, key):
        value = self.old.get(key)
        if value is None:
            value = self.compute(key)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[key] = value
        return value


# ---------------------------------------------------------------- words of many texts at once
_P = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2^64
_P_INV = np.uint64(pow(int(_P), -1, 1 << 64))
_BYTE = np.random.default_rng(20240101).integers(1, 2**63, 256, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit integers (the finaliser of SplitMix64)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def powers(base: np.uint64, n: int) -> np.ndarray:
    """base^0 to base^(n-1) modulo 2^64; those of usual lengths are kept."""
    if n > len(_powers.get(int(base), ())):
        out = np.full(max(n, _KEPT_POWERS), base, np.uint64)
        out[0] = 1
        with np.errstate(over="ignore"):
            np.multiply.accumulate(out, out=out)
        if n > _KEPT_POWERS:
            return out
        _powers[int(base)] = out
    return _powers[int(base)][:n]


_KEPT_POWERS = 1 << 22
_powers: dict[int, np.ndarray] = {}


def span_hashes(raw: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the spans of a byte array: differences of prefix sums modulo 2^64."""
    with np.errstate(over="ignore"):
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTE[raw] * powers(_P, len(raw)), dtype=np.uint64, out=sums[1:])
        return mix64((sums[end] - sums[begin]) * powers(_P_INV, len(raw) + 1)[begin])


def word_hashes(texts: list[str], lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the words ``[^\\x20\\x09-\\x0D]+`` of all texts, and where each text's begin.

    Returns (hashes, starts) with ``starts`` one longer than ``texts``. The whole batch is
    one byte array; a word's hash is a difference of prefix sums modulo 2^64.
    """
    blobs = [t.encode() for t in texts]
    raw = np.frombuffer(b"\n".join(blobs) + b"\n", np.uint8)
    ends_of_text = np.cumsum([len(b) + 1 for b in blobs])
    if lower:
        raw = _LOWER[raw]
    space = _SPACE[raw]
    before = np.concatenate(([True], space[:-1]))
    begin = np.flatnonzero(before & ~space)
    end = np.flatnonzero(space & ~before)
    hashes = span_hashes(raw, begin, end)
    starts = np.concatenate(([0], np.searchsorted(begin, ends_of_text))).astype(np.int64)
    return hashes, starts


def cuts(column: pa.Array, max_bytes: int) -> list[tuple[int, int]]:
    """Ranges of rows with about ``max_bytes`` of text each; a longer single text comes alone."""
    if not len(column):
        return []
    sizes = np.asarray(pc.fill_null(pc.binary_length(column), 0), dtype=np.int64)
    part = (np.cumsum(sizes) - sizes) // max_bytes
    at = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(column)]
    return list(zip(at, at[1:]))


def text_slices(batches: Iterable[pa.RecordBatch], max_bytes: int = 8 << 20) -> Iterator[tuple[pa.Array, list[str]]]:
    """(ids, texts) of (id, text) batches in pieces of about ``max_bytes`` of text."""
    for batch in batches:
        ids, column = batch.column(0), batch.column(1)
        for a, b in cuts(column, max_bytes):
            yield ids.slice(a, b - a), column.slice(a, b - a).to_pylist()


def fresh_prefix(df: DataFrame) -> str:
    """A prefix for new columns that no column of ``df`` begins with, in any case."""
    prefix = "x_"
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix = "x" + prefix
    return prefix


def append_from_text(docs: DataFrame, compute: Callable[[list[str]], list[pa.Array]], fields: str,
                     text_col: str = "text", max_bytes: int = 1 << 20) -> DataFrame:
    """All columns of ``docs`` and those of ``fields`` (DDL), computed from slices of texts (null: empty).

    Map-only: rows stay where they are. The new names must differ from the columns of ``docs``.
    """
    let_workers_import(docs.sparkSession)
    new = StructType.fromDDL(fields)
    at, names = docs.columns.index(text_col), [*docs.columns, *new.fieldNames()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in cuts(batch.column(at), max_bytes):
                piece = batch.slice(a, b - a)
                texts = [t or "" for t in piece.column(at).to_pylist()]
                yield pa.RecordBatch.from_arrays([*piece.columns, *compute(texts)], names=names)

    return docs.mapInArrow(run, StructType([*docs.schema.fields, *new.fields]))


class HashIndex:
    """Positions of distinct 64-bit hashes, found for whole arrays at once (open addressing in numpy)."""

    def __init__(self, keys: np.ndarray | None = None):
        self.size = 0
        self._empty(4)
        if keys is not None:
            self.add(keys)

    def _empty(self, bits: int) -> None:
        self.bits = bits
        self.keys = np.zeros(1 << bits, np.uint64)
        self.at = np.full(1 << bits, -1, np.int32)

    def add(self, keys: np.ndarray) -> None:
        """Distinct new keys get the next positions."""
        position = np.arange(self.size, self.size + len(keys), dtype=np.int32)
        self.size += len(keys)
        if 2 * self.size > len(self.at):
            there = self.at >= 0
            keys, position = np.concatenate([self.keys[there], keys]), np.concatenate([self.at[there], position])
            self._empty(int(4 * self.size).bit_length())
        slot = self._first(keys)
        left = np.arange(len(keys))
        while len(left):
            now = left[self.at[slot[left]] < 0]
            self.at[slot[now]] = position[now]  # of several that want one slot, the last gets it
            self.keys[slot[now]] = keys[now]
            left = left[self.at[slot[left]] != position[left]]
            slot[left] = (slot[left] + 1) & (len(self.at) - 1)

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> np.uint64(64 - self.bits)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The position of each key, -1 where it isn't there."""
        slot = self._first(keys)
        found = self.at[slot]
        left = np.flatnonzero((found >= 0) & (self.keys[slot] != keys))
        while len(left):
            slot[left] = (slot[left] + 1) & (len(self.at) - 1)
            here = self.at[slot[left]]
            found[left] = here
            left = left[(here >= 0) & (self.keys[slot[left]] != keys[left])]
        return found


class KeyedEncoder:
    """Ids of whole texts from a growing table of the ids of their keys.

    A key begins at the start of a text and at every blank or line feed. ``plain(text)`` says
    whether a text's ids are its keys' ids one after the other; ``of_key`` encodes a key and
    ``of_text`` any other text. Keys are known by a 64-bit hash and their length. At ``limit``
    keys the table starts anew, so its size is bounded.
    """

    def __init__(self, plain: Callable[[str], bool], of_key: Callable[[str], bytes], of_text: Callable[[str], bytes],
                 kind: np.dtype, limit: int = 1 << 21):
        self.plain, self.of_key, self.of_text, self.kind, self.limit = plain, of_key, of_text, kind, limit
        self._clear()

    def _clear(self) -> None:
        self.index = HashIndex()
        self.start, self.count, self.length = (np.zeros(1 << 10, np.int32) for _ in range(3))
        self.pool, self.filled = np.zeros(1 << 12, self.kind), 0

    def _learn(self, hashes: np.ndarray, blob: bytes, begin: np.ndarray, end: np.ndarray) -> None:
        ids = [self.of_key(blob[a:b].decode()) for a, b in zip(begin.tolist(), end.tolist())]
        n = np.array([len(x) for x in ids], np.int64) // self.kind.itemsize
        new = np.frombuffer(b"".join(ids), self.kind)
        at = self.index.size
        while at + len(n) > len(self.start):
            self.start, self.count, self.length = (np.concatenate([x, np.zeros_like(x)]) for x in (self.start, self.count, self.length))
        while self.filled + len(new) > len(self.pool):
            self.pool = np.concatenate([self.pool, np.zeros_like(self.pool)])
        self.start[at:at + len(n)] = self.filled + np.cumsum(n) - n
        self.count[at:at + len(n)], self.length[at:at + len(n)] = n, end - begin
        self.pool[self.filled:self.filled + len(new)] = new
        self.filled += len(new)
        self.index.add(hashes)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, how many each text has)."""
        plain = [bool(t) and self.plain(t) for t in texts]
        ids, sizes = self._encode_plain([t for t, p in zip(texts, plain) if p])
        if all(plain):
            return ids, sizes
        whole = [b"" if p else self.of_text(t) for t, p in zip(texts, plain)]
        lengths = np.array([len(w) // self.kind.itemsize for w in whole], np.int64)
        lengths[plain] = sizes
        parts, at = [], 0
        for w, p, n in zip(whole, plain, lengths.tolist()):
            parts.append(ids[at:at + n] if p else np.frombuffer(w, self.kind))
            at += n if p else 0
        return np.concatenate(parts) if parts else ids, lengths

    def _encode_plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if not texts:
            return np.empty(0, self.kind), np.empty(0, np.int64)
        blobs = [t.encode() for t in texts]
        blob = b"".join(blobs)
        raw = np.frombuffer(blob, np.uint8)
        ends = np.cumsum([len(b) for b in blobs])
        first = (raw == 0x20) | (raw == 0x0A)
        first[0] = True
        first[ends[:-1]] = True
        begin = np.flatnonzero(first)
        end = np.append(begin[1:], len(raw))
        hashes = span_hashes(raw, begin, end)
        at = self.index.find(hashes)
        if (at < 0).any():
            if self.index.size > self.limit:
                self._clear()
                at[:] = -1
            _, new = np.unique(hashes[at < 0], return_index=True)
            new = np.flatnonzero(at < 0)[new]
            self._learn(hashes[new], blob, begin[new], end[new])
            at = self.index.find(hashes)
        n = self.count[at].astype(np.int64)
        stops = np.cumsum(n)
        ids = self.pool[np.repeat(self.start[at] - (stops - n), n) + np.arange(stops[-1])]
        if (wrong := np.flatnonzero(self.length[at] != end - begin)).size:  # another key of the same hash
            parts = np.split(ids, stops[:-1])
            for k in wrong.tolist():
                parts[k] = np.frombuffer(self.of_key(blob[begin[k]:end[k]].decode()), self.kind)
                n[k] = len(parts[k])
            ids, stops = np.concatenate(parts), np.cumsum(n)
        return ids, np.diff(stops[np.searchsorted(begin, ends) - 1], prepend=0)
