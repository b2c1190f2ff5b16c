"""Token counts by a two-tier lookup on the map side.

Tier one is a broadcast table of the lengths of the most frequent pre-tokens; tier two is a
bounded cache in each Python worker, filled by the tokenizer's library on a miss. No
pre-token is ever shuffled: the table comes from one bounded summary per task.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import WorkerCache, id_text, slices
from visitlens.llm.pretokens import keys_of

#: Entries of the broadcast table, of one task's summary, and of a worker cache's generation.
TABLE_ENTRIES, SUMMARY_ENTRIES, CACHE_ENTRIES = 1 << 16, 1 << 13, 1 << 18
#: Tasks that merge the summaries; each sends one row to the driver.
MERGE_TASKS = 16
#: Longer pre-tokens are encoded each time and never kept, so entries are of bounded size.
KEY_CHARS = 64

_workers: dict[str, tuple] = {}


def frequent_pretokens(docs: DataFrame, path: str, entries: int = TABLE_ENTRIES,
                       summary: int = SUMMARY_ENTRIES) -> list[str]:
    """The most frequent pre-tokens over all texts, at most ``entries``.

    Every task keeps a space-saving summary (heaviest ``4 * summary`` at any time), sends its
    ``summary`` heaviest as one compressed row, and summaries are merged in two steps, so no
    task or driver ever holds more than some of these bounded rows. It is only a cache's
    content: it has no influence on any count.
    """
    def summarise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, seen = keys_of(path), Counter()
        for piece in slices(batches):
            for text in piece.column(1).to_pylist():
                seen.update(keys.split(text) or ())
            if len(seen) > 8 * summary:
                seen = Counter(dict(seen.most_common(4 * summary)))
        yield pa.RecordBatch.from_pylist([{"blob": _pack(seen, summary)}], schema=pa.schema([("blob", pa.binary())]))

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = Counter()
        for batch in batches:
            for blob in batch.column(0).to_pylist():
                seen.update(_unpack(blob))
                if len(seen) > 4 * entries:
                    seen = Counter(dict(seen.most_common(2 * entries)))
        yield pa.RecordBatch.from_pylist([{"blob": _pack(seen, entries)}], schema=pa.schema([("blob", pa.binary())]))

    parts = id_text(docs).mapInArrow(summarise, "blob binary")
    merged = parts.repartition(MERGE_TASKS).mapInArrow(merge, "blob binary")
    seen: Counter = Counter()
    for row in merged.collect():  # MERGE_TASKS rows of at most ``entries`` pre-tokens each
        seen.update(_unpack(bytes(row.blob)))
    return [k for k, _ in seen.most_common(entries)]


def _pack(seen: Counter, entries: int) -> bytes:
    top = [(k, n) for k, n in seen.most_common(entries) if len(k) <= KEY_CHARS]
    return zlib.compress("\0".join(f"{n} {k}" for k, n in top if "\0" not in k).encode(), 1)


def _unpack(blob: bytes) -> dict[str, int]:
    out = {}
    for item in zlib.decompress(blob).decode().split("\0"):
        n, _, key = item.partition(" ")
        if n:
            out[key] = int(n)
    return out


def length_table(keys: list[str], path: str) -> bytes:
    """The broadcast table: one length byte per key, then the keys (compressed)."""
    coder = keys_of(path)
    kept = [(k, n) for k in keys if (n := len(coder.encode(k))) < 256]
    lengths = np.array([n for _, n in kept], np.uint8).tobytes()
    head = len(kept).to_bytes(4, "little")
    return zlib.compress(head + lengths + "\0".join(k for k, _ in kept).encode(), 1)


def _worker(path: str, table: bytes):
    """This worker's lookup: the broadcast table, then the cache, then the library."""
    tag = f"{path}:{zlib.crc32(table)}"
    if tag not in _workers:
        _workers.clear()
        coder = keys_of(path)
        raw = zlib.decompress(table)
        n = int.from_bytes(raw[:4], "little")
        fixed = dict(zip(raw[4 + n:].decode().split("\0"), raw[4:4 + n]))
        cache = WorkerCache(lambda k: len(coder.encode(k)), CACHE_ENTRIES)
        _workers[tag] = (coder, _Tiers(fixed, cache))
    return _workers[tag]


class _Tiers(dict):
    """Tier one as a dict; a miss goes to tier two."""

    def __init__(self, fixed: dict[str, int], cache: WorkerCache):
        super().__init__(fixed)
        self.cache = cache

    def __missing__(self, key: str) -> int:
        return self.cache[key] if len(key) <= KEY_CHARS else self.cache.compute(key)


def token_counts(docs: DataFrame, path: str, limit: int = 4096, table: bytes | None = None) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit: one row per row of ``docs``.

    ``path``: a SentencePiece ``.model`` or a byte-level tokenizers ``.json`` file (readable on
    the executors). Counts are those of the library without added special tokens. Null or
    empty text: 0 bytes, 0 tokens. Null ids are kept; repeated rows give repeated rows; an
    empty table gives none; other columns are ignored. ``limit`` only sets ``over_limit``.
    """
    if table is None:
        table = length_table(frequent_pretokens(docs, path), path)
    shipped = docs.sparkSession.sparkContext.broadcast(table)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, tiers = _worker(path, shipped.value)
        look = tiers.__getitem__
        for piece in slices(batches):
            counts = []
            for text in piece.column(1).to_pylist():
                keys = coder.split(text)
                counts.append(len(coder.encode_whole(text)) if keys is None else sum(map(look, keys)))
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), pc.binary_length(piece.column(1)).cast(pa.int64()),
                 pa.array(counts, pa.int64())], names=["doc_id", "n_bytes", "n_tokens"])

    counted = id_text(docs).mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > F.lit(limit))
