"""Phrase collocations against brute force; summaries that must not lose frequent keys."""

import re
from collections import Counter

import numpy as np
import pytest
from helpers import AWKWARD, LOWER, empty

from visitlens.llm import collocations as col


def brute(rows, least, most, top, percent=100):
    f, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, most + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    candidates = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    inside = {}
    for (lang, p), a in candidates.items():
        for i in range(len(p)):
            for j in range(i + 2, len(p) + 1):
                if j - i < len(p):
                    inside[lang, p[i:j]] = max(inside.get((lang, p[i:j]), 0), a)
    out = {}
    for (lang, p), a in candidates.items():
        if 100 * inside.get((lang, p), 0) >= percent * a:
            continue
        n = total[lang]
        score, k = min((1000 * a * n // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]], n))
    return sorted((lang, r, p.decode(), -a, x, y, n, -s) for lang, rows in out.items()
                  for r, (s, a, p, x, y, n) in enumerate(sorted(rows)[:top], 1))


ODD = [("A b\tc  d. a B c D, a b c d", "x"), ("a b c d a b c d", "x"), ("aa aa aa aa aa aa", None), ("aa aa", "und"), ("\x0b a b \x0c a b", ""),
       ("é É é É. é É", "x"), ("new york is new york! New York", "y"), ("\x00 \x01 \x00 \x01 \x00 \x01", "y"), ("b a b a b a b", "y")]


@pytest.mark.parametrize("least,most,top,percent", [(1, 5, 2000, 100), (2, 5, 2000, 100), (2, 3, 3, 50), (3, 2, 2000, 100), (40, 5, 5, 100)])
def test_against_brute_force(spark, least, most, top, percent):
    rows = [(t, lang) for k, (_, t) in enumerate(AWKWARD) for lang in (("en", None, "und", "")[k % 4],) if not t or len(t) < 40_000] + ODD + ODD[:3]
    df = spark.createDataFrame([(t, lang, 1, 2) for t, lang in rows], "text string, lang string, rank int, f int").repartition(3)
    got = sorted(map(tuple, col.collocations(df, least, most, top, percent).collect()))
    assert got == brute(rows, least, most, top, percent)


def test_very_long_text_and_empty_table(spark):
    long = " ".join(f"w{i % 500} v" for i in range(60_000))
    rows = [(long, "a"), (None, "a"), ("", None)]
    df = spark.createDataFrame(rows, "text string, lang string")
    assert sorted(map(tuple, col.collocations(df).collect())) == brute(rows, 100, 5, 2000)
    assert col.collocations(empty(spark).selectExpr("text", "source as lang")).collect() == []


def test_many_small_shares_survive(spark, monkeypatch):
    """A phrase found once in each of many partitions, among many rare ones, and summaries that must forget."""
    monkeypatch.setattr(col, "PART_BYTES", 1 << 14)
    g = np.random.default_rng(7)
    rows = [(" ".join(f"r{x}" for x in g.integers(0, 10**6, 300)) + ". hot phrase. " + ("warm one" if k % 2 else ""), "z") for k in range(120)]
    df = spark.createDataFrame(rows, "text string, lang string").repartition(24)
    assert sorted(map(tuple, col.collocations(df, 50).collect())) == brute(rows, 50, 5, 2000)


def test_summary_keeps_what_is_frequent():
    g = np.random.default_rng(1)
    keys = np.concatenate([g.integers(0, 1 << 40, 200_000), np.repeat(np.arange(50) * 7, 60)]).astype(np.uint64)
    g.shuffle(keys)
    s = col.Summary(4 * len(keys) // 60 + 1)
    for part in np.array_split(keys, 37):
        s.add(*col._add_up(part))
    got = set(s.reaching(60).tolist())
    assert {k * 7 for k in range(50)} <= got and s.lost <= 15
    values = np.array([0, 1, 255, 256, 2**40, 2**63], np.uint64)
    assert (col._unsqueeze(col._squeeze(values), 6) == values).all()


def test_products_beyond_64_bits(spark):
    from pyspark.sql import functions as F
    a, n, x, y = 9_000_000_000_000, 8_000_000_000_000_000, 9_000_000_000_001, 9_100_000_000_000
    got = spark.range(1).select(F.expr(f"(cast({1000 * a} as decimal(19, 0)) * cast({n} as decimal(19, 0))) div (cast({x} as decimal(19, 0)) * cast({y} as decimal(19, 0)))").alias("s")).first().s
    assert got == 1000 * a * n // (x * y)
