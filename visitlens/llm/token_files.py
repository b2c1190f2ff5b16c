"""Token ids in a binary file format of Simple-8b words.

Documents are written in ascending id order. A block holds whole documents: a header, the
documents' ids and lengths, and the ids packed into 64-bit words. A word's top four bits are
a selector for how many ids share the other sixty; an id too wide for a word is escaped
(selector 0, the next word holds it raw). Blocks are rows of a Parquet table ``shard, before,
n_ids, body`` (``before``: the shard's ids ahead of the block), written by Spark's committed writer, so a lost executor leaves no torn file and
any store that Spark reaches will do. A block is decoded on its own, all words of one
selector at a time.
"""

from __future__ import annotations

import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.llm.common import KeyedEncoder, WorkerCache, id_text, slices, text_slices
from visitlens.llm.pretokens import keys_of

#: Fixed values of the format: ids per word by selector (0 is the escape) and the bits of each.
PER_WORD = (0, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
BITS = (0, *(60 // n for n in PER_WORD[1:]))
MAGIC, VERSION = 0x53384231, 1
#: A block is closed once it has this many ids (one longer document still is one block).
BLOCK_IDS = 1 << 17
#: Text that a task encodes at once.
TEXT_BYTES = 1 << 20
#: Entries of a generation of the workers' cache of pre-tokens; longer pre-tokens aren't kept.
PRETOKEN_ENTRIES, KEY_CHARS = 1 << 18, 64
BLOCK_COLUMNS = "shard int, before long, n_ids long, body binary"

_SELECTOR = np.zeros(61, np.uint64)
_SELECTOR[list(PER_WORD[1:])] = np.arange(1, len(PER_WORD))


_SMALL_WIDTH = np.array([max(1, i.bit_length()) for i in range(1 << 16)], np.uint8)


def _widths(ids: np.ndarray) -> np.ndarray:
    """Bits that each id needs, at least one."""
    width = _SMALL_WIDTH[ids & np.uint64(0xFFFF)]
    for shift in (16, 32, 48):
        high = ids >> np.uint64(shift)
        if not high.any():
            break
        width = np.where(high != 0, shift + _SMALL_WIDTH[high & np.uint64(0xFFFF)], width)
    return width.astype(np.uint8)


def pack(ids: np.ndarray) -> np.ndarray:
    """Simple-8b words (uint64) of unsigned ids; as many ids as possible in every word."""
    ids = np.ascontiguousarray(ids, np.uint64)
    n = len(ids)
    if not n:
        return np.empty(0, np.uint64)
    width = _widths(ids)
    # fit[i]: ids that the word starting at i takes, 0 for an escape
    fit = np.zeros(n, np.uint8)
    widest, reach = width.copy(), 1
    for count in sorted(PER_WORD[1:]):
        if count > n:
            break
        while reach < count:
            np.maximum(widest[:n - reach], width[reach:], out=widest[:n - reach])
            reach += 1
        here, fits = fit[:n - count + 1], widest[:n - count + 1] <= 60 // count
        if not fits.any():
            break  # wider windows hold ids as wide and have fewer bits for each
        np.maximum(here, fits * np.uint8(count), out=here)
    jump = np.maximum(fit, 1).tolist()
    at, i = [], 0
    while i < n:
        at.append(i)
        i += jump[i]
    at = np.array(at)
    taken = fit[at]
    words = np.zeros(len(at), np.uint64)
    for count in np.unique(taken).tolist():
        of = np.flatnonzero(taken == count)
        if count:
            bits = 60 // count
            cols = ids[at[of][:, None] + np.arange(count)]
            packed = np.bitwise_or.reduce(cols << (np.arange(count, dtype=np.uint64) * np.uint64(bits)), axis=1)
            words[of] = packed | (_SELECTOR[count] << np.uint64(60))
    escapes = np.flatnonzero(taken == 0)
    return np.insert(words, escapes + 1, ids[at[escapes]]) if len(escapes) else words


def unpack(words: np.ndarray, n_ids: int) -> np.ndarray:
    """The ids of ``pack``'s words."""
    out = np.empty(n_ids, np.uint64)
    selector = (words >> np.uint64(60)).astype(np.int64)
    raw = np.zeros(len(words), bool)
    for i in np.flatnonzero(selector == 0).tolist():  # a raw word may look like an escape itself
        if not raw[i]:
            raw[i + 1] = True
    escape = (selector == 0) & ~raw
    selector[raw] = 0
    counts = np.array(PER_WORD)[selector] + escape
    starts = np.cumsum(counts) - counts
    at = np.flatnonzero(escape)
    out[starts[at]] = words[at + 1]
    for s in np.unique(selector[selector > 0]).tolist():
        of = np.flatnonzero(selector == s)
        n, bits = PER_WORD[s], BITS[s]
        shifts = np.arange(n, dtype=np.uint64) * np.uint64(bits)
        out[starts[of][:, None] + np.arange(n)] = (words[of][:, None] >> shifts) & np.uint64((1 << bits) - 1)
    return out


def block_bytes(doc_ids: list[int | None], lengths: list[int], ids: np.ndarray) -> bytes:
    """Header (magic, version, documents, ids, words), document ids, null marks, lengths, words."""
    words = pack(ids)
    head = np.array([MAGIC, VERSION, len(doc_ids), len(ids), len(words)], "<u8")
    named = np.array([0 if d is None else d for d in doc_ids], "<i8")
    nulls = np.array([d is None for d in doc_ids], "<u1")
    return b"".join((head.tobytes(), named.tobytes(), np.array(lengths, "<u8").tobytes(), words.astype("<u8").tobytes(), nulls.tobytes()))


def read_block(body: bytes) -> tuple[list[int | None], np.ndarray, np.ndarray]:
    """(document ids, lengths, ids) of a block."""
    magic, version, docs, n_ids, n_words = np.frombuffer(body, "<u8", 5).tolist()
    if magic != MAGIC or version != VERSION:
        raise ValueError("not a block of this format")
    named = np.frombuffer(body, "<i8", docs, 40).tolist()
    lengths = np.frombuffer(body, "<u8", docs, 40 + 8 * docs).astype(np.int64)
    words = np.frombuffer(body, "<u8", n_words, 40 + 16 * docs)
    nulls = np.frombuffer(body, "<u1", docs, 40 + 16 * docs + 8 * n_words)
    return [None if x else d for d, x in zip(named, nulls)], lengths, unpack(words, n_ids)


_workers: dict[str, KeyedEncoder] = {}


def _coder(path: str) -> KeyedEncoder:
    """This worker's encoder: a table of keys over a cache of their pre-tokens over the library."""
    if path not in _workers:
        _workers.clear()
        keys = keys_of(path)
        pre = WorkerCache(lambda k: array("I", keys.encode_pretoken(k)).tobytes(), PRETOKEN_ENTRIES)
        of_key = lambda k: b"".join([pre[p] if len(p) <= KEY_CHARS else pre.compute(p) for p in keys.pretokens(k)])
        _workers[path] = KeyedEncoder(keys.plain, of_key, lambda t: array("I", keys.encode_whole(t)).tobytes(), np.dtype("<u4"))
    return _workers[path]


def lengths(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens: a row for each row of ``docs``, without an end id (null or empty text: 0). Map-only."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _coder(path)
        for ids, texts in text_slices(batches, TEXT_BYTES):
            yield pa.RecordBatch.from_arrays([ids, pa.array(coder.encode(texts)[1].astype(np.int64))], names=["doc_id", "n_tokens"])

    return id_text(docs).mapInArrow(run, "doc_id long, n_tokens long")


def write(docs: DataFrame, path: str, out: str, end_id: int = 0, block_ids: int = BLOCK_IDS) -> None:
    """Encode every whole text, append ``end_id``, and write blocks in ascending doc_id order.

    Null or empty text: only the end id. Null ids come first (Spark's order). Rows with the
    same id stand in any order next to each other; the order of equal ids is not defined, all
    are written. An empty table writes an empty table. Sorting is by range partitions, so a
    shard is one range of ids; only ids and texts are shuffled.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        coder = _coder(path)
        shard = TaskContext.get().partitionId()
        names: list[int | None] = []
        lengths: list[int] = []
        parts: list[np.ndarray] = []
        waiting = before = 0

        def flush() -> pa.RecordBatch:
            ids = np.concatenate(parts)
            row = {"shard": shard, "before": before, "n_ids": len(ids), "body": block_bytes(names, lengths, ids)}
            return pa.RecordBatch.from_pylist([row], schema=_BLOCK)

        for docs_of, texts in text_slices(batches, TEXT_BYTES):
            ids, sizes = coder.encode(texts)
            with_end = np.full(len(ids) + len(sizes), end_id, "<u4")
            inside = np.ones(len(with_end), bool)
            inside[np.cumsum(sizes + 1) - 1] = False
            with_end[inside] = ids
            names += docs_of.to_pylist()
            lengths += (sizes + 1).tolist()
            parts.append(with_end)
            waiting += len(with_end)
            if waiting >= block_ids:
                yield flush()
                names, lengths, parts, before, waiting = [], [], [], before + waiting, 0
        if names:
            yield flush()

    ordered = id_text(docs).repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    ordered.mapInArrow(run, BLOCK_COLUMNS).write.option("compression", "zstd").parquet(out)


_BLOCK = pa.schema([("shard", pa.int32()), ("before", pa.int64()), ("n_ids", pa.int64()), ("body", pa.binary())])


def read(spark: SparkSession, path: str) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens, ids_crc32 (of all its ids as
    little-endian unsigned 32-bit integers), read from the files of ``write``.

    A block's start is its shard's start plus its own ``before``. The shards' totals, of which
    there are as many as write tasks, are summed up on the driver and sent to all tasks; no
    body is shuffled or joined.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, 1):
            start = starts.value[piece.column(0)[0].as_py()] + piece.column(1)[0].as_py()
            body = piece.column(2)[0].as_py()
            names, lengths, ids = read_block(body)
            ends = np.cumsum(lengths)
            raw = memoryview(ids.astype("<u4").tobytes())
            crc = [zlib.crc32(raw[4 * (e - n):4 * e]) for e, n in zip(ends.tolist(), lengths.tolist())]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(start + ends - lengths, pa.int64()),
                 pa.array(lengths, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "start", "n_tokens", "ids_crc32"])

    blocks = spark.read.schema(BLOCK_COLUMNS).parquet(path)
    sums = sorted((r.shard, r.total) for r in blocks.groupBy("shard").agg(F.sum("n_ids").alias("total")).collect())
    ends = np.cumsum([n for _, n in sums]).tolist()
    starts = spark.sparkContext.broadcast({shard: end - n for (shard, n), end in zip(sums, ends)})
    return blocks.select("shard", "before", "body").mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def decode_texts(spark: SparkSession, path: str, model: str) -> DataFrame:
    """doc_id, text: the texts of the files' ids without their end id (exact for byte-level models)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = keys_of(model).tokenizer
        for piece in slices(batches, 1):
            names, lengths, ids = read_block(piece.column(0)[0].as_py())
            ends = np.cumsum(lengths)
            texts = [tokenizer.decode(ids[e - n:e - 1].tolist(), skip_special_tokens=False) for e, n in zip(ends, lengths)]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(texts, pa.string())], names=["doc_id", "text"])

    bodies = spark.read.schema(BLOCK_COLUMNS).parquet(path).select("body")
    return bodies.mapInArrow(run, "doc_id long, text string")
