"""One-step page conversion along a target page flow.

Transitions are consecutive page views inside a session, ordered by action time (the
action id, or without one a hash of the row, breaks ties). A session is cut into pieces of
a fixed length of time, so a piece is a function of the row alone: ``lag`` runs inside
(session, piece), and the first row of a piece takes its predecessor from the last row of
the piece before it. No task owns a whole session, whatever its size, there is one
plan for all sessions, and only the first and last row of each piece are shuffled again.

The flow itself is a parameter (a handful of pages); its step table is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from visitlens.functions.columns import half_up_ratio, parse_action_time

#: Length of a piece of a session, in seconds.
DEFAULT_PIECE_SECONDS = 3600


def _ordered(actions: DataFrame) -> DataFrame:
    ties = F.col("action_id") if "action_id" in actions.columns else F.xxhash64(*actions.columns)
    return actions.select("session_id", ties.alias("action_id"), "page_id",
                          parse_action_time(F.col("action_time")).alias("action_ts"))


def page_transitions(actions: DataFrame, piece_seconds: int = DEFAULT_PIECE_SECONDS) -> DataFrame:
    """(session_id, action_id, prev_page_id, page_id) for every action after the first
    of its session whose predecessor has a page.

    Rows with an unparsable time are the session's first piece.
    """
    seconds = F.unix_timestamp(F.col("action_ts").cast("timestamp"))
    pieces = _ordered(actions).withColumn("piece", F.floor(seconds / F.lit(piece_seconds)))
    order = ["action_ts", "action_id"]
    here = Window.partitionBy("session_id", "piece").orderBy(*order)
    local = (pieces.withColumn("prev_page_id", F.lag("page_id").over(here))
             .withColumn("is_first", F.row_number().over(here) == 1)
             .withColumn("is_last", F.lead(F.lit(1)).over(here).isNull()))
    # at most two rows of a piece: in a session's order, a piece's first row follows the last of the piece before
    whole = Window.partitionBy("session_id").orderBy(*order)
    ends = (local.where("is_first or is_last").withColumn("prev_page_id", F.lag("page_id").over(whole))
            .where("is_first"))
    cols = ["session_id", "action_id", "prev_page_id", "page_id"]
    return (local.where("not is_first").select(*cols).unionByName(ends.select(*cols))
            .where(F.col("prev_page_id").isNotNull()))


def page_transitions_skew_safe(actions: DataFrame, piece_seconds: int = 60) -> DataFrame:
    """``page_transitions`` with pieces of a minute, for sessions with very many actions an hour."""
    return page_transitions(actions, piece_seconds)


def flow_steps(spark: SparkSession, flow: list[str]) -> DataFrame:
    """(pos, prev_page_id, page_id, split) for each consecutive pair of the flow; pos
    starts at 1. Built from the parameter list - at most len(flow) - 1 rows - with
    ``range`` and an array literal, so no local data is shipped from Python."""
    pages = F.array(*[F.lit(int(p)).cast("bigint") for p in flow])
    names = F.array(*[F.lit(p) for p in flow])      # the split keeps the parameter's text
    pos = F.col("id").cast("int")
    return spark.range(1, max(len(flow), 1)).select(
        pos.alias("pos"), F.element_at(pages, pos).alias("prev_page_id"),
        F.element_at(pages, pos + 1).alias("page_id"),
        F.concat(F.element_at(names, pos), F.lit("_"), F.element_at(names, pos + 1)).alias("split"))


def page_start_pv(actions: DataFrame, flow: list[str]) -> DataFrame:
    """(page_id, pv): all views of the flow's first page (views, not sessions)."""
    first = int(flow[0])
    return (actions.where(F.col("page_id") == F.lit(first))
            .agg(F.count(F.lit(1)).alias("pv"))
            .select(F.lit(first).cast("bigint").alias("page_id"), "pv"))


def page_split_pv(transitions: DataFrame, flow: list[str]) -> DataFrame:
    """(pos, split, pv): transitions matching each flow step; a step never seen has 0.

    Each distinct pair is counted once (a pair repeated in the flow is not double
    counted) and reported at every position where it occurs.
    """
    spark = transitions.sparkSession
    steps = flow_steps(spark, flow)
    pairs = steps.select("prev_page_id", "page_id").distinct()
    counted = (transitions.join(F.broadcast(pairs), ["prev_page_id", "page_id"])
               .groupBy("prev_page_id", "page_id").agg(F.count(F.lit(1)).alias("pv")))
    return (steps.join(counted, ["prev_page_id", "page_id"], "left")
            .select("pos", "split", F.coalesce("pv", F.lit(0)).cast("bigint").alias("pv")))


def page_convert_rate(actions: DataFrame, flow: list[str], transitions: DataFrame | None = None,
                      places: int = 2) -> DataFrame:
    """(pos, split, pv, prev_pv, convert_rate): each step's views over the previous
    step's (the first step over the first page's views), half-up rounded."""
    if len(flow) < 2:
        spark = actions.sparkSession
        return spark.createDataFrame([], "pos int, split string, pv bigint, prev_pv bigint, convert_rate double")
    tr = transitions if transitions is not None else page_transitions(actions)
    split_pv = page_split_pv(tr, flow)
    # the first page's views become position 0, so lag over the positions gives every
    # step its predecessor; the window sees len(flow) rows
    start = page_start_pv(actions, flow).select(
        F.lit(0).alias("pos"), F.lit(None).cast("string").alias("split"), "pv")
    w = Window.orderBy("pos")
    return (start.unionByName(split_pv)
            .withColumn("prev_pv", F.lag("pv").over(w))
            .where(F.col("pos") >= 1)
            .select("pos", "split", "pv", "prev_pv",
                    half_up_ratio(F.col("pv"), F.col("prev_pv"), places).alias("convert_rate")))


def page_convert_rate_string(rates: DataFrame) -> DataFrame:
    """One row ``convert_rate`` = ``split=rate|split=rate`` in flow order."""
    item = F.struct("pos", F.concat("split", F.lit("="), F.col("convert_rate").cast("string")).alias("s"))
    return rates.agg(F.array_join(F.transform(F.array_sort(F.collect_list(item)),
                                              lambda x: x["s"]), "|").alias("convert_rate"))
