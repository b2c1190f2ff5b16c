"""How ``user_visit_action`` is stored: partitioned by date, bucketed by session.

A date range is then a partition filter, and roll-up, detail join and every other operator keyed by session
read their rows where they lie: no shuffle on ``session_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from visitlens.operators import sessions as ses

#: Columns of the layout.
DATE, SESSION = "session_date", "session_id"


def store_actions(actions: DataFrame, table: str, buckets: int, path: str | None = None, mode: str = "append") -> DataFrame:
    """Write action rows as a catalogue table (external at ``path``, else in the warehouse) and give it back.

    Rows are dealt by (date, bucket) first, so every date has one file per bucket and no task more than that.
    ``buckets``: about a date's bytes over 128 MB, the same for every append.
    """
    bucket = F.expr(f"pmod(hash({SESSION}), {buckets})")  # Spark's own bucket of a row
    writer = (actions.repartition(F.col(DATE), bucket).write.mode(mode).format("parquet").partitionBy(DATE)
              .bucketBy(buckets, SESSION).sortBy(SESSION))
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(table)
    return actions.sparkSession.table(table)


def stored_sessions(spark: SparkSession, table: str, start_date: str | None = None, end_date: str | None = None) -> DataFrame:
    """The session roll-up of the stored actions of a date range: each bucket is rolled up where it is read."""
    return ses.session_rollup(ses.scan_actions_by_date(spark.table(table), start_date, end_date))


def stored_session_detail(spark: SparkSession, table: str, sessions: DataFrame, start_date: str | None = None,
                          end_date: str | None = None, hot_session_rows: int | None = None) -> DataFrame:
    """Action rows of the given sessions (a selection of ``stored_sessions``): buckets are joined with buckets.

    A bucket is read by one task, so a session with more than an even share of all rows (or ``hot_session_rows``) would make
    that task long. If there is one among ``sessions`` (checked by one aggregate), the rows are joined salted
    instead (``sessions.session_detail``).
    """
    rows = ses.scan_actions_by_date(spark.table(table), start_date, end_date)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    limit = hot_session_rows if hot_session_rows is not None else rows.count() // parts
    longest = sessions.agg(F.max("step_length")).first()[0]
    if longest is not None and longest > limit:
        return ses.session_detail(rows, sessions, hot_session_rows)
    return rows.join(sessions.select(SESSION), SESSION, "left_semi")
