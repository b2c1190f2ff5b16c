"""Conversations from reply trees.

Messages point at the message they answer. Iterative self-joins with doubled steps give every
message its distance from the root and its root (log2 of the depth rounds, so a tree of a
thousand replies needs ten); a leaf's path back to the root is listed with the same doubled
pointers. Branches are ranked by score within their tree, and each chosen path is formatted
as one conversation.

The format, with a loss mask over the assistant's texts:

    ### <Role>: <text> </turn>\\n

``###`` and ``</turn>`` are control strings. Inside a text a backslash stands before every
backslash, before every ``#`` that two more follow and before every ``<`` that ``/turn>``
follows; reading back, a backslash is dropped and the character after it taken as it is.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from visitlens.llm.common import SLICE_ROWS, let_workers_import, materialize, slices

#: Roles with a name of their own in the format.
SHOWN = {"user": "User", "assistant": "Assistant", "system": "System"}
OPEN, CLOSE = "### ", " </turn>\n"
_ESCAPE = re.compile(r"[\\]|#(?=##)|<(?=/turn>)")
_UNESCAPE = re.compile(r"\\(.)", re.S)
#: A turn read back: an unescaped mark, a role, an escaped text, the end mark.
_HEAD = re.compile(r"### ((?:[^\\:\n]|\\.)*): ", re.S)
_BODY = re.compile(r"(?:[^\\<]|\\.|<(?!/turn>))*", re.S)


def escape(text: str) -> str:
    return _ESCAPE.sub(lambda m: "\\" + m[0], text)


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"\1", text)


def _show_role(role: str) -> str:
    """A named role in capitals' style; any other one behind "=", escaped as it stands before a colon on one line."""
    return SHOWN.get(role) or "=" + re.sub(r"[\\:\n#<]", lambda m: "\\" + m[0], role)


def _read_role(shown: str) -> str:
    return unescape(shown[1:]) if shown[:1] == "=" else shown.lower()


def format_path(turns: list[tuple[str, str]], loss_roles: tuple[str, ...] = ("assistant",)) -> tuple[str, list[tuple[int, int]]]:
    """The formatted conversation and the loss spans (code point offsets of the escaped texts)."""
    parts, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{_show_role(role)}: ", escape(text)
        if role in loss_roles:
            spans.append((at + len(head), at + len(head) + len(body)))
        parts += (head, body, CLOSE)
        at += len(head) + len(body) + len(CLOSE)
    return "".join(parts), spans


def read_path(formatted: str) -> list[tuple[str, str]]:
    """The (role, text) turns of a formatted conversation."""
    turns, at = [], 0
    while at < len(formatted):
        head = _HEAD.match(formatted, at)
        body = _BODY.match(formatted, head.end())
        if not formatted.startswith("</turn>\n", body.end()):
            raise ValueError("a turn has no end mark")
        # the blank before the end mark belongs to the mark
        turns.append((_read_role(head[1]), unescape(formatted[head.end():body.end() - 1])))
        at = body.end() + len("</turn>\n")
    return turns


def climb(messages: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(reached, hops). reached: message, total, depth for every message that leads to a root: the sum of the scores and
    the number of messages on its path. hops[k]: (message, up), the ancestor 2^k steps up, where there is one.

    ``messages``: message, parent (null: a root), score (null: 0). Ids are unique over all trees. A parent that isn't
    there makes its children roots. Each round doubles the pointers by a join with themselves, on keys that are
    unique on one side, and adds up scores along them. Where no message is finished by a round, none ever will be: if one
    has depth d, its ancestors have all depths below. What is left then is a cycle or leads into one, and has no path.
    """
    known = messages.select(F.col("message").alias("known"))
    state = messages.join(known, messages["parent"] == known["known"], "left").select(
        "message", F.col("known").alias("up"), F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("total"), F.lit(1).cast("long").alias("depth"))
    state = materialize(state, "reply-climb")
    finished, unfinished, hops = [state.filter(F.col("up").isNull())], state.filter(F.col("up").isNotNull()), []
    while not unfinished.isEmpty():
        hops.append(unfinished.select("message", "up"))
        below = unfinished.alias("a")
        step = (below.join(_union([unfinished, *finished]).alias("b"), F.col("a.up") == F.col("b.message"))
                .select("a.message", F.col("b.up").alias("up"), (F.col("a.total") + F.col("b.total")).alias("total"),
                        (F.col("a.depth") + F.col("b.depth")).alias("depth")))
        step = materialize(step, "reply-climb")
        done = step.filter(F.col("up").isNull())
        if done.isEmpty():
            break
        finished.append(done)
        unfinished = step.filter(F.col("up").isNotNull())
    return materialize(_union(finished).select("message", "total", "depth"), "reply-reached"), hops


def _union(parts: list[DataFrame]) -> DataFrame:
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def ranked_branches(messages: DataFrame, reached: DataFrame, keep: int | None = None) -> DataFrame:
    """(tree, leaf, branch_score, rank): branches of a tree by mean score, then leaf; at most ``keep`` of each if given.

    A branch is a message that nothing answers, with all its ancestors. No path is listed for it.
    """
    leaves = messages.select("tree", "message").join(messages.select(F.col("parent").alias("message")), "message", "left_anti")
    branches = leaves.join(reached, "message").select("tree", F.col("message").alias("leaf"), (F.col("total") / F.col("depth")).alias("branch_score"))
    order = Window.partitionBy("tree").orderBy(F.col("branch_score").desc(), "leaf")
    ranked = branches.withColumn("rank", F.row_number().over(order))
    return ranked if keep is None else ranked.filter(F.col("rank") <= F.lit(keep))


def paths(leaves: DataFrame, hops: list[DataFrame]) -> DataFrame:
    """(tree, leaf, rank, up, message): the messages from each given leaf (tree, leaf, rank) up to its root; a row each."""
    reached = leaves.select("tree", "leaf", "rank", F.lit(0).cast("long").alias("up"), F.col("leaf").alias("message"))
    reached = materialize(reached, "reply-paths")
    for k in range(len(hops) - 1, -1, -1):  # every distance has one sum of powers of two
        higher = (reached.alias("r").join(hops[k].alias("h"), F.col("r.message") == F.col("h.message"))
                  .select("r.tree", "r.leaf", "r.rank", (F.col("r.up") + F.lit(1 << k)).alias("up"), F.col("h.up").alias("message")))
        reached = reached.unionByName(higher)
        if k % 4 == 0:
            reached = materialize(reached, "reply-paths")
    return reached


def conversations(messages: DataFrame, keep: int | None = 1) -> DataFrame:
    """tree, leaf, rank, formatted, loss (array of (start, stop) code point offsets).

    ``messages``: message, parent, tree, role, text, score (any further columns are ignored).
    The best ``keep`` branches of each tree (None: all); only those paths are listed. Messages on a cycle, or that answer
    into one, belong to no root and are in no conversation. Null role: "user"; null text: empty.
    Repeated rows are one message; an empty table gives no conversation. A formatted conversation is
    one row, so a path's texts must fit into one task's memory.
    """
    let_workers_import(messages.sparkSession)
    clean = materialize(messages.select(
        "message", "parent", "tree", F.coalesce(F.col("role"), F.lit("user")).alias("role"),
        F.coalesce(F.col("text"), F.lit("")).alias("text"), F.col("score").cast("double").alias("score"))
        .dropDuplicates(["message"]), "messages")
    reached, hops = climb(clean.select("message", "parent", "score"))
    turns = paths(ranked_branches(clean, reached, keep), hops).join(clean.select("message", "role", "text"), "message")
    listed = turns.groupBy("tree", "leaf", "rank").agg(
        F.sort_array(F.collect_list(F.struct((-F.col("up")).alias("at"), "role", "text"))).alias("turns"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, SLICE_ROWS // 4):
            done = [format_path([(t["role"], t["text"]) for t in turns]) for turns in piece.column(3).to_pylist()]
            spans = [[{"start": a, "stop": b} for a, b in loss] for _, loss in done]
            yield pa.RecordBatch.from_arrays(
                [*piece.columns[:3], pa.array([text for text, _ in done], pa.string()), pa.array(spans, _SPANS)],
                names=["tree", "leaf", "rank", "formatted", "loss"])

    kind = {f.name: f.dataType.simpleString() for f in listed.schema.fields}
    return listed.select("tree", "leaf", "rank", "turns").mapInArrow(
        run, f"tree {kind['tree']}, leaf {kind['leaf']}, rank int, formatted string, loss array<struct<start:long,stop:long>>")


_SPANS = pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))


def chain_messages(table: DataFrame, conv: str = "conv_id", turn: str = "turn") -> DataFrame:
    """Messages of plain conversations: each turn answers the one before it (by turn, then role and text).

    Null turns come first. A turn that repeats a whole row is a turn of its own.
    """
    order: list[Column] = [F.col(turn).asc_nulls_first(), F.col("role"), F.col("text")]
    numbered = table.select(F.col(conv).cast("long").alias("tree"), F.col("role"), F.col("text"),
                            F.row_number().over(Window.partitionBy(conv).orderBy(*order)).alias("n"))
    name = lambda n: F.concat_ws(":", F.coalesce(F.col("tree").cast("string"), F.lit("null")), n.cast("string"))
    return numbered.select(name(F.col("n")).alias("message"),
                           F.when(F.col("n") > 1, name(F.col("n") - 1)).alias("parent"),
                           "tree", "role", "text", F.lit(0.0).alias("score"))


def digests(formatted: DataFrame) -> DataFrame:
    """conv_id and digests of what is read back from formatted conversations and their loss spans."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for piece in slices(batches, SLICE_ROWS // 4):
            rows = []
            for text, spans in zip(piece.column(1).to_pylist(), piece.column(2).to_pylist()):
                turns = read_path(text)
                loss = "".join(unescape(text[s["start"]:s["stop"]]) for s in spans)
                rows.append({"n_turns": len(turns),
                             "turns_sha256": hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
                             "loss_chars": len(loss), "loss_sha256": hashlib.sha256(loss.encode()).hexdigest(),
                             "formatted_chars": len(text)})
            out = pa.RecordBatch.from_pylist(rows, schema=_DIGESTS)
            yield pa.RecordBatch.from_arrays([piece.column(0), *out.columns], names=["conv_id", *_DIGESTS.names])

    return formatted.select("tree", "formatted", "loss").mapInArrow(
        run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


_DIGESTS = pa.schema([("n_turns", pa.int64()), ("turns_sha256", pa.string()), ("loss_chars", pa.int64()),
                      ("loss_sha256", pa.string()), ("formatted_chars", pa.int64())])
