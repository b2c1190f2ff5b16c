import hashlib
import math
import random
from collections import defaultdict

import numpy as np
import pytest

from visitlens.llm import context_tree as ct
from visitlens.llm import reply_trees


def test_kt_estimates():
    z, o = np.array([0.0, 0, 3, 1000]), np.array([0.0, 1, 2, 7])
    exact = [math.lgamma(a + .5) + math.lgamma(b + .5) - math.log(math.pi) - math.lgamma(a + b + 1) for a, b in zip(z, o)]
    assert ct.kt_log(z, o) == pytest.approx(exact, rel=1e-9, abs=1e-9)


def test_template_round_trip():
    rng = random.Random(0)
    parts = ["\\", "#", "##", "###", "### ", "<", "</turn>", " </turn>\n", "/turn>", " ", "\n", "a", ":", "### Assistant: ", "é", "\\#"]
    for _ in range(5000):
        turns = [(rng.choice(["user", "assistant", "system", "A:b", "", "x\ny", "User", "##", "=q"]), "".join(rng.choice(parts) for _ in range(rng.randint(0, 9))))
                 for _ in range(rng.randint(0, 4))]
        text, spans = reply_trees.format_path(turns)
        assert reply_trees.read_path(text) == turns
        assert [reply_trees.unescape(text[a:b]) for a, b in spans] == [t for r, t in turns if r == "assistant"]


TREE = "message string, parent string, tree long, role string, text string, score double, rank int"


def test_trees_rank_branches(spark):
    rows = [("r", None, 1, "user", "hi", 0.0, 9), ("a", "r", 1, "assistant", "low", 0.1, 9), ("b", "r", 1, "assistant", "high", 0.9, 9),
            ("b1", "b", 1, "user", None, None, 9), ("b2", "b", 1, None, "more", 0.8, 9), ("s", None, 2, "user", "alone", None, 9),
            ("x", "gone", 3, "user", "orphan", 1.0, 9), ("c1", "c2", 4, "user", "cycle", 1.0, 9), ("c2", "c1", 4, "user", "cycle", 1.0, 9),
            ("s", None, 2, "user", "alone", None, 9)]
    table = spark.createDataFrame(rows, TREE)
    got = {(r.tree, r.leaf): (r["rank"], reply_trees.read_path(r.formatted)) for r in reply_trees.conversations(table, keep=None).collect()}
    assert got == {(1, "b2"): (1, [("user", "hi"), ("assistant", "high"), ("user", "more")]),
                   (1, "b1"): (2, [("user", "hi"), ("assistant", "high"), ("user", "")]),
                   (1, "a"): (3, [("user", "hi"), ("assistant", "low")]), (2, "s"): (1, [("user", "alone")]), (3, "x"): (1, [("user", "orphan")])}
    best = reply_trees.conversations(table).collect()
    assert sorted((r.tree, r.leaf) for r in best) == [(1, "b2"), (2, "s"), (3, "x")]
    assert reply_trees.conversations(table.limit(0)).collect() == []


@pytest.mark.parametrize("size", [1, 2, 3, 9])
def test_cycles_end(spark, size):
    """A cycle, a message that answers into it, and a chain that does, beside good trees."""
    rows = [(f"c{k}", f"c{(k + 1) % size}", 1, "user", "round", 1.0, 0) for k in range(size)]
    rows += [("leaf", "c0", 1, "user", "into", 9.0, 0)] + [(f"l{k}", f"l{k - 1}" if k else "leaf", 1, "user", "deep", 9.0, 0) for k in range(5)]
    rows += [("r", None, 2, "user", "a", 0.0, 0)] + [(f"g{k}", f"g{k - 1}" if k else "r", 2, "user", str(k), 0.0, 0) for k in range(12)]
    rows += [("self", "self", 3, "user", "x", 1.0, 0), ("one", None, 3, "user", "alone", 1.0, 0)]
    got = {r.tree: reply_trees.read_path(r.formatted) for r in reply_trees.conversations(spark.createDataFrame(rows, TREE), keep=None).collect()}
    assert got == {2: [("user", t) for t in ("a", *map(str, range(12)))], 3: [("user", "alone")]}


def test_random_trees_against_brute_force(spark):
    """Bushy and deep trees with ties, null scores and answers to what isn't there."""
    rng, rows = random.Random(8), []
    for tree in range(6):
        for k in range(rng.choice([1, 5, 40, 90])):
            parent = None if k == 0 else f"{tree}:{rng.randrange(max(0, k - rng.choice([1, 3, 90])), k):03d}"
            rows.append((f"{tree}:{k:03d}", "gone" if rng.random() < 0.02 else parent, tree, "user", f"t{k}", rng.choice([None, 0.0, 0.5, 0.5, 1.0]), 0))
    by = {r[0]: r for r in rows}
    wanted = defaultdict(list)
    for m, _, tree, *_ in rows:
        if m not in {r[1] for r in rows}:
            path = [m]
            while by[path[-1]][1] in by:
                path.append(by[path[-1]][1])
            wanted[tree].append((-sum(by[x][5] or 0 for x in path) / len(path), m, [by[x][4] for x in reversed(path)]))
    for keep in (1, 3, None):
        got = defaultdict(list)
        for r in reply_trees.conversations(spark.createDataFrame(rows, TREE), keep=keep).collect():
            got[r.tree].append((r["rank"], r.leaf, [t for _, t in reply_trees.read_path(r.formatted)]))
        for tree, paths in wanted.items():
            assert sorted(got[tree]) == [(k, leaf, told) for k, (_, leaf, told) in enumerate(sorted(paths)[:keep], 1)]


def test_chains(spark):
    """Long conversations, null turns, roles and texts, ties and repeated rows."""
    rows = [(1, k, "user" if k % 2 == 0 else "assistant", f"turn {k} ### </turn> \\") for k in range(70)]
    rows += [(2, 0, "user", "x"), (2, 0, "user", "x"), (2, None, None, None), (None, 5, "assistant", "no id"), (3, 1, "assistant", None)]
    table = spark.createDataFrame([(*r, "z") for r in rows], "conv_id long, turn long, role string, text string, message string")
    got = {r.conv_id: r for r in reply_trees.digests(reply_trees.conversations(reply_trees.chain_messages(table))).collect()}
    for conv in (1, 2, 3, None):
        turns = sorted(((-1 if t is None else t, r or "user", x or "") for c, t, r, x in rows if c == conv))
        told = "".join(f"{r}\n{x}\n" for _, r, x in turns)
        loss = "".join(x for _, r, x in turns if r == "assistant")
        assert got[conv].n_turns == len(turns)
        assert got[conv].turns_sha256 == hashlib.sha256(told.encode()).hexdigest()
        assert (got[conv].loss_chars, got[conv].loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
