"""Quality rules as a bitmask ledger.

Every rule is evaluated once per document. The ledger keeps the measurements and one bit per
failed rule; versioned policies are masks over those bits, so applying another policy or
asking what one rule alone removes never reads a text again.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.llm.common import _SPACE, append_from_text, fresh_prefix, id_text, word_hashes

#: Symbols counted by ``n_symbols`` (fixed value).
SYMBOLS = b"#*$%&|<>"
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines")

_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(SYMBOLS)] = True


@dataclass(frozen=True)
class Rule:
    """A named test on the measurements; true: the document fails it."""
    name: str
    bit: int
    fails: Column = field(compare=False)


def rules(prefix: str = "") -> list[Rule]:
    """All rules in the order of their bits, on measurements named with ``prefix``. Bits are never reused for another rule."""
    c = lambda name: F.col(prefix + name)
    tests = [
        ("too_few_words", c("n_words") < 50),
        ("repeated_windows", 100 * c("n_repeat_words") > 50 * c("n_words")),
        ("symbols_per_word", 100 * c("n_symbols") > 15 * c("n_words")),
        ("duplicate_lines_per_word", 100 * c("n_dup_lines") > 10 * c("n_words")),
        ("short_words", c("word_chars") < 2 * c("n_words")),
        ("long_words", c("word_chars") > 20 * c("n_words")),
        ("duplicate_lines", 100 * c("n_dup_lines") > 40 * c("n_lines")),
    ]
    return [Rule(name, i, F.coalesce(test, F.lit(True))) for i, (name, test) in enumerate(tests)]


BITS = {"too_few_words": 0, "repeated_windows": 1, "symbols_per_word": 2, "duplicate_lines_per_word": 3,
        "short_words": 4, "long_words": 5, "duplicate_lines": 6}


def mask(*names: str) -> int:
    return sum(1 << BITS[n] for n in set(names))


#: Versioned policies: a document is kept if none of the policy's bits is set. Version 1 is the base.
POLICIES: dict[int, int] = {
    1: mask("too_few_words", "repeated_windows"),
    2: mask("too_few_words", "repeated_windows", "symbols_per_word", "duplicate_lines_per_word", "short_words", "long_words"),
    3: mask(*BITS),
}


def _measure(texts: list[str]) -> list[np.ndarray]:
    """The measurements of a batch of texts; all counting is on one byte array."""
    blobs = [t.encode() for t in texts]
    n = len(blobs)
    raw = np.frombuffer(b"\n".join(blobs) + b"\n", np.uint8)
    text_end = np.cumsum([len(b) + 1 for b in blobs])
    text_begin = np.concatenate(([0], text_end[:-1]))

    def per_text(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate(([0], np.cumsum(flags, dtype=np.int64)))
        return sums[text_end] - sums[text_begin]

    hashes, starts = word_hashes(texts, lower=False)
    n_words = np.diff(starts)
    word_chars = per_text(~_SPACE[raw] & ((raw & 0xC0) != 0x80))  # continuation bytes are no code points
    n_symbols = per_text(_SYMBOL[raw])

    # lines: \n-split; equal bytes within a text and at least one word
    line_end = np.flatnonzero(raw == 10)
    line_begin = np.concatenate(([0], line_end[:-1] + 1))
    words_before = np.concatenate(([0], np.cumsum(~_SPACE[raw])))
    wordy = words_before[line_end] > words_before[line_begin]
    owner = np.searchsorted(text_end, line_begin, side="right")
    dup = np.zeros(n, np.int64)
    blob = raw.tobytes()
    seen: set[bytes] = set()
    at = -1
    for k, a, b in zip(owner[wordy].tolist(), line_begin[wordy].tolist(), line_end[wordy].tolist()):
        if k != at:
            seen, at = set(), k
        line = blob[a:b]
        if line in seen:
            dup[k] += 1
        else:
            seen.add(line)

    # words in three-word windows that occur twice or more in their text
    repeat = np.zeros(n, np.int64)
    for k in np.flatnonzero(n_words > 3).tolist():
        _, ids = np.unique(hashes[starts[k]:starts[k + 1]], return_inverse=True)
        base = np.int64(ids.max()) + 1
        if base < 1 << 21:
            window = (ids[:-2] * base + ids[1:-1]) * base + ids[2:]
        else:  # more distinct words than three fit into 63 bits: number the pairs first
            _, pair = np.unique(ids[:-1] * base + ids[1:], return_inverse=True)
            window = pair[:-1] * base + ids[2:]
        _, which, counts = np.unique(window, return_inverse=True, return_counts=True)
        twice = counts[which] > 1
        if twice.any():
            covered = np.zeros(len(ids), bool)
            for shift in range(3):
                covered[shift:shift + len(twice)] |= twice
            repeat[k] = covered.sum()
    return [n_words, word_chars, n_symbols, dup, repeat, np.bincount(owner[wordy], minlength=n)]


def ledger(docs: DataFrame) -> DataFrame:
    """doc_id, the measurements (long) and ``failed`` (long): bit b set where rule b fails.

    Null text: no words, so all measurements are 0 and the rules see that. A repeated line
    counts from its second time on. Null ids and repeated rows are kept, an empty table gives
    an empty ledger, other columns are ignored. A single text is measured whole.
    """
    return _book(id_text(docs)).drop("text")


def _book(docs: DataFrame, prefix: str = "") -> DataFrame:
    """``docs`` with the measurements and ``failed`` appended, under names with ``prefix``."""
    measured = append_from_text(docs, lambda texts: [pa.array(x, pa.int64()) for x in _measure(texts)],
                                ", ".join(f"{prefix}{m} long" for m in MEASURES))
    bits = [F.when(r.fails, F.lit(1 << r.bit).cast("long")).otherwise(F.lit(0).cast("long")) for r in rules(prefix)]
    total = bits[0]
    for b in bits[1:]:
        total = total.bitwiseOR(b)
    return measured.withColumn(f"{prefix}failed", total)


def keep_passing(docs: DataFrame, version: int = max(POLICIES)) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that the policy keeps. No shuffle."""
    prefix = fresh_prefix(docs)
    passing = F.col(f"{prefix}failed").bitwiseAND(F.lit(POLICIES[1] | POLICIES[version]).cast("long")) == 0
    return _book(docs, prefix).filter(passing).select(*docs.columns)


def apply_policy(book: DataFrame, version: int = max(POLICIES)) -> DataFrame:
    """The ledger with ``base_failed`` (policy 1) and ``kept`` (no bit of the policy is set)."""
    hit = lambda m: F.col("failed").bitwiseAND(F.lit(m).cast("long")) != 0
    return book.withColumn("base_failed", hit(POLICIES[1])).withColumn("kept", ~hit(POLICIES[1] | POLICIES[version]))


def ablations(book: DataFrame, version: int = max(POLICIES)) -> DataFrame:
    """Per rule of a policy: documents failing it, failing it alone, and rejected without it.

    One aggregate by mask (at most 2^rules groups, combined on the map side); everything else
    is bit arithmetic on those groups.
    """
    policy = F.lit(POLICIES[version]).cast("long")
    groups = book.groupBy(F.col("failed").bitwiseAND(policy).alias("hit")).agg(F.count(F.lit(1)).alias("n"))
    names = F.array(*[F.struct(F.lit(name).alias("rule"), F.lit(1 << bit).cast("long").alias("bit"))
                      for name, bit in BITS.items() if POLICIES[version] >> bit & 1])
    one = groups.select("hit", "n", F.explode(names).alias("r")).select("hit", "n", "r.rule", "r.bit")
    count = lambda test: F.coalesce(F.sum(F.when(test, F.col("n"))), F.lit(0))
    return one.groupBy("rule").agg(
        count(F.col("hit").bitwiseAND(F.col("bit")) != 0).alias("n_failed"),
        count(F.col("hit") == F.col("bit")).alias("n_alone"),
        count((F.col("hit") != 0) & (F.col("hit") != F.col("bit"))).alias("n_rejected_without"))
