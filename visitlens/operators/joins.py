"""Join helpers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

DEFAULT_MAX_BROADCAST_ROWS = 100_000


def broadcast_if_small(df: DataFrame, max_rows: int = DEFAULT_MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only after checking that ``df`` has at most ``max_rows`` rows.

    For sources without size statistics (a JDBC dimension), neither the planner nor AQE
    can see that the side is small. The check reads at most ``max_rows + 1`` rows per
    partition (a limit), so it stays cheap even when the table turns out to be large; a
    larger table is returned unhinted and joins by shuffle (AQE still re-plans it).
    """
    n = df.limit(max_rows + 1).count()
    return F.broadcast(df) if n <= max_rows else df


DEFAULT_SALTS = 32


def hot_keys(counts: DataFrame, key: str, n: str, rows: DataFrame, more_than: int | None = None) -> DataFrame:
    """The keys of ``counts`` (one row per key) with more than ``more_than`` rows.

    By default more than an even share of ``rows``, total / shuffle partitions, so that there
    are at most as many hot keys as partitions, whatever the input. The total reads no column.
    """
    if more_than is not None:
        limit = F.lit(more_than)
    else:
        parts = int(counts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        limit = rows.agg(F.count(F.lit(1))).scalar() / F.lit(parts)
    return counts.where(F.col(n) > limit).select(key)


def salted_join(big: DataFrame, small: DataFrame, on: str, hot: DataFrame, how: str = "inner",
                salts: int = DEFAULT_SALTS, salt_on: list[str] | None = None) -> DataFrame:
    """Equi-join on ``on`` that spreads hot keys over ``salts`` tasks.

    ``hot`` (a column ``on``) lists the keys known to be heavy on the ``big`` side;
    ``hot_keys`` makes one (at most as many as shuffle partitions). It carries no hint: Spark
    broadcasts it when it measures small. Rows of ``big`` with a hot key get a salt from a hash of
    ``salt_on`` (by default three other columns; deterministic, so retried tasks agree); the matching
    ``small`` rows are replicated once per salt. Other keys keep salt 0. The result has
    the same rows as ``big.join(small, on, how)`` for ``how`` in inner, left,
    left_semi, left_anti - but no task holds all rows of a hot key. Both sides are
    shuffled on (key, salt), so AQE's own skew splitting also remains available.
    """
    hot = hot.select(on).distinct().withColumn("_hot", F.lit(True))
    mixed = salt_on or [c for c in big.columns if c != on][:3] or [on]
    salt = F.pmod(F.xxhash64(*mixed), F.lit(salts).cast("bigint"))
    b = (big.join(hot, on, "left")
         .withColumn("_salt", F.when(F.col("_hot"), salt)
                     .otherwise(F.lit(0).cast("bigint")))
         .drop("_hot"))
    zero = F.lit(0).cast("bigint")
    replicas = F.when(F.col("_hot"), F.sequence(zero, F.lit(salts - 1).cast("bigint"))).otherwise(F.array(zero))
    s = (small.join(hot, on, "left")
         .withColumn("_salt", F.explode(replicas))
         .drop("_hot"))
    return b.join(s, [on, "_salt"], how).drop("_salt")
