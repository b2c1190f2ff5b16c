import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from helpers import AWKWARD, LOWER, PROSE, docs, empty, words
from visitlens.llm import context_stream as cs
from visitlens.llm import context_tree as ct


def steps(text):
    b = (text or "").translate(LOWER).encode() + b"\xff"
    padded = b"\xff" * ct.DEPTH + b
    return [(padded[i:i + ct.DEPTH][::-1], b[i]) for i in range(len(b))]


def brute_scores(texts, train):
    """Code lengths by the recursion over all nodes; contexts run through the whole text."""
    seen, kt = Counter(), lambda z, o: math.lgamma(z + .5) + math.lgamma(o + .5) - math.log(math.pi) - math.lgamma(z + o + 1)
    for (context, byte), n in Counter(s for k in train for s in steps(texts[k])).items():
        for d in range(ct.DEPTH + 1):
            for j in range(8):
                seen[context[:d], (1 << j) | (byte >> (8 - j)), (byte >> (7 - j)) & 1] += n
    nodes, below = {(a, u) for a, u, _ in seen}, defaultdict(float)
    stop = {}
    for a, u in sorted(nodes, key=lambda n: -len(n[0])):
        whole = own = kt(seen[a, u, 0], seen[a, u, 1])
        stop[a, u] = 1.0
        if len(a) < ct.DEPTH:
            whole = np.logaddexp(own, below[a, u]) - math.log(2)
            stop[a, u] = math.exp(own - math.log(2) - whole)
        below[a[:-1], u] += whole if a else 0
    known = {}

    def log10(context, byte):
        if (context, byte) not in known:
            total = 0.0
            for j in range(8):
                u, told, left = (1 << j) | (byte >> (8 - j)), 0.0, 1.0
                for d in range(ct.DEPTH + 1):
                    z, o = seen[context[:d], u, 0], seen[context[:d], u, 1]
                    s = stop.get((context[:d], u), 1.0 if d == ct.DEPTH else 0.5)
                    told += left * s * (o + .5) / (z + o + 1)
                    left *= 1 - s
                total += math.log10(told if byte >> (7 - j) & 1 else 1 - told)
            known[context, byte] = total
        return known[context, byte]

    return [sum(log10(*s) for s in steps(t)) for t in texts]


@pytest.mark.parametrize("frequent, events", [(0, 0), (4, 300), (10_000, 1 << 21)])
def test_running_scores(spark, monkeypatch, frequent, events):
    """Equal to brute force, whatever is broadcast; the long texts are whole."""
    rows = AWKWARD + [(14, " " * 5000), (15, "\t\n  x\n\n\n   y" * 40)]
    texts = [t for _, t in rows]
    train = [k for k, (i, _) in enumerate(rows) if i is not None and i % 3]
    tokens = [words((t or "").translate(LOWER)) + ["\n"] for t in texts]
    counts = Counter(w for k in train for w in tokens[k])
    room = sum(counts.values()) + len(counts) + 1
    wanted = [(i, len(w), sum(counts[x] > 0 for x in w), sum(math.log10((counts[x] + 1) / room) for x in w), s, -s * math.log2(10) / (len((t or "").encode()) + 1))
              for (i, t), w, s in zip(rows, tokens, brute_scores(texts, train))]
    got = [(r.doc_id, r.n_tokens, r.n_known, r.base_score, r.score, r.bits_per_byte)
           for r in cs.score(docs(spark, rows), F.col("doc_id") % 3 != 0, frequent, events).collect()]
    order = lambda r: (repr(r[0]), r[1])
    for g, w in zip(sorted(got, key=order), sorted(wanted, key=order), strict=True):
        assert g[:3] == w[:3] and g[3:] == pytest.approx(w[3:], rel=1e-8)


def test_order_of_words_counts(spark):
    """A text whose words are shuffled gets another score: contexts reach across blanks."""
    shuffled = PROSE.split(" ")
    random.Random(1).shuffle(shuffled)
    rows = [(k, PROSE) for k in range(3)] + [(10, PROSE), (11, " ".join(shuffled))]
    got = {r.doc_id: r for r in cs.score(docs(spark, rows), F.col("doc_id") < 10).collect()}
    assert got[10].base_score == pytest.approx(got[11].base_score) and got[10].score > got[11].score + 10


def test_untaught_and_empty(spark):
    """Every byte costs eight bits, blanks too."""
    got = {r.doc_id: r for r in cs.score(docs(spark, [(1, "ab"), (2, None), (3, " " * 1000)]), F.lit(False)).collect()}
    for i, n in ((1, 3), (2, 1), (3, 1001)):
        assert got[i].score == pytest.approx(-8 * n * math.log10(2)) and got[i].bits_per_byte == pytest.approx(8)
    assert cs.score(empty(spark), F.lit(True)).collect() == []


def test_six_context_bytes(spark):
    """Texts that differ only six bytes before a byte teach different scores."""
    assert ct.DEPTH >= 6
    rows = [(k, "pabcdeX") for k in range(9)] + [(10 + k, "qabcdeY") for k in range(9)] + [(30, "pabcdeX"), (31, "pabcdeY")]
    got = {r.doc_id: r.score for r in cs.score(docs(spark, rows), F.col("doc_id") < 30).collect()}
    assert got[30] > got[31] + 0.5


def test_packed_counts():
    keys = np.array([3, 7, 2**64 - 1], np.uint64)
    got = cs._unpack(cs._pack((keys, np.array([0, 5, 1 << 40]), np.array([1, 5, 1 << 41]))))
    assert [x.tolist() for x in got] == [keys.tolist(), [0, 5, 1 << 40], [1, 5, 1 << 41]]


def test_heaviest_rows_fit(spark):
    """Counts far above 16 bits, ties, more rows than room: never an empty table, never more than there is room for."""
    cases = {"great": [70_000 + 900 * k for k in range(10)], "tied": [100_000] * 5000 + [3] * 50, "small": list(range(1, 200)),
             "one": [1 << 50], "mixed": [1 << k for k in range(1, 60)] * 3}
    for counts in cases.values():
        table = spark.createDataFrame([(k, n) for k, n in enumerate(counts)], "key long, n long")
        for room in (0, 1, 9, 100, 4000, 10_000):
            got = sorted(r.n for r in table.where(cs._heaviest(table, room)).collect())
            heaviest = sorted(counts)[-room:] if room else []
            assert len(got) <= room and got == sorted(heaviest)[len(heaviest) - len(got):]
            assert len(got) >= min(room, len(counts)) - max(12, len(counts) // 200) or not room


def test_scores_do_not_depend_on_the_tables(spark):
    rows = [(i, t) for i, t in AWKWARD if t is None or len(t) < 5000]
    want = None
    for frequent, events in ((0, 0), (3, 40), (10_000, 100_000)):
        got = sorted((repr(r.doc_id), r.n_tokens, r.n_known, round(r.base_score, 6), round(r.score, 6))
                     for r in cs.score(docs(spark, rows), F.col("doc_id") % 3 != 0, frequent, events).collect())
        want = want or got
        assert got == want


def test_chunks_keep_triples_together(monkeypatch):
    rng = np.random.default_rng(3)
    for size, chunk in ((0, 5), (1, 5), (3000, 1), (3000, 70), (3000, 10_000)):
        monkeypatch.setattr(ct, "CHUNK", chunk)
        keys = rng.integers(0, 40, size, dtype=np.uint64) << np.uint64(40) | rng.integers(0, 1 << 20, size, dtype=np.uint64)
        keys[:size // 3] = (np.uint64(7) << np.uint64(40)) | keys[:size // 3] & np.uint64(0xFFFFF)  # a hot triple
        pieces = list(ct._chunks(keys))
        assert sorted(np.concatenate(pieces).tolist() if pieces else []) == list(range(size))
        triples = [set((keys[p] >> np.uint64(40)).tolist()) for p in pieces]
        assert all(a.isdisjoint(b) for a, b in zip(triples, triples[1:]))
        assert all(len(p) <= chunk or len(t) == 1 for p, t in zip(pieces, triples))
