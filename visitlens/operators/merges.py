"""Keyed merges of result tables (the reference's upsert DAOs) as DataFrame algebra.

Each returns the new table contents; writers (``visitlens.sources.sinks``) persist it.
All are one shuffle on the keys (anti join / aggregate), no per-row lookups.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def merge_overwrite(target: DataFrame, updates: DataFrame, keys: list[str]) -> DataFrame:
    """Upsert where an update replaces the stored row with the same keys."""
    kept = target.join(updates.select(*keys).distinct(), keys, "left_anti")
    return kept.unionByName(updates.select(*target.columns))


def merge_add(target: DataFrame, updates: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """Upsert where update values are added to the stored values (new keys inserted)."""
    both = target.select(*keys, *values).unionByName(updates.select(*keys, *values))
    return both.groupBy(*keys).agg(*[F.sum(v).cast("bigint").alias(v) for v in values])


def merge_replace_group(target: DataFrame, updates: DataFrame, group_keys: list[str]) -> DataFrame:
    """Every group (by ``group_keys``) present in ``updates`` is replaced as a whole."""
    kept = target.join(updates.select(*group_keys).distinct(), group_keys, "left_anti")
    return kept.unionByName(updates.select(*target.columns))
