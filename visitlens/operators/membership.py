"""Sets of integer ids as bitmap pages: 4 KB for every 32,768 neighbouring ids.

A set of n ids takes at most (greatest id / 8) bytes, is tested by one bit and grows by OR-ing pages: no distinct,
no anti join with all its members.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.operators.joins import broadcast_if_small, hot_keys, salted_join

#: Most pages that are broadcast: 16 MB, the ids below 134 million.
MAX_BROADCAST_PAGES = 4096


def id_pages(ids: DataFrame, column: str, by: list[str] | None = None) -> DataFrame:
    """(by..., page, bits): the ids of ``column`` (of each ``by`` group); repeated ids count once, nulls fall away."""
    i = F.col(column).cast("bigint")
    return (ids.where(F.col(column).isNotNull())
            .select(*(by or []), F.bitmap_bucket_number(i).alias("page"), F.bitmap_bit_position(i).alias("bit"))
            .groupBy(*(by or []), "page").agg(F.bitmap_construct_agg("bit").alias("bits")))


def merge_pages(*parts: DataFrame) -> DataFrame:
    """(page, bits): the ids that any of ``parts`` holds."""
    both = parts[0].select("page", "bits")
    for p in parts[1:]:
        both = both.unionByName(p.select("page", "bits"))
    return both.groupBy("page").agg(F.bitmap_or_agg("bits").alias("bits"))


def holds(bits: Column, ids: Column) -> Column:
    """Whether a page holds the id (false for a null page)."""
    at = F.bitmap_bit_position(ids.cast("bigint"))
    byte = F.conv(F.hex(F.substring(bits, (at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.coalesce(F.getbit(byte, (at % 8).cast("int")) == 1, F.lit(False))


def page_of(ids: Column) -> Column:
    return F.bitmap_bucket_number(ids.cast("bigint"))


def without(rows: DataFrame, pages: DataFrame, column: str, max_pages: int = MAX_BROADCAST_PAGES) -> DataFrame:
    """The rows whose id no page holds; rows without an id stay. No pages are compared, each row looks up one bit.

    Pages are broadcast if they are few (checked); otherwise both sides are shuffled by page, hot pages
    (all rows of a dense range of ids) salted.
    """
    with_page = rows.withColumn("_page", page_of(F.col(column)))
    named = pages.select(F.col("page").alias("_page"), F.col("bits").alias("_bits"))
    hint = broadcast_if_small(named, max_pages)
    if hint is not named:
        joined = with_page.join(hint, "_page", "left")
    else:
        hot = hot_keys(with_page.groupBy("_page").agg(F.count(F.lit(1)).alias("n")), "_page", "n", rows)
        joined = salted_join(with_page, named, "_page", hot, "left", salt_on=[column])
    return joined.where(~holds(F.col("_bits"), F.col(column)) | F.col(column).isNull()).select(*rows.columns)
