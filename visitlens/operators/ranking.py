"""Row numbers over a whole table without one task that sees all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from visitlens.session import checkpoint_dir

#: ``monotonically_increasing_id`` holds the partition above this bit and the row's place in it below.
_PLACE_BITS = 33


def global_row_number(df: DataFrame, order: list[Column], name: str = "rank") -> DataFrame:
    """``df`` with ``name`` (bigint, from 1): each row's place in ``order`` over the whole table.

    Rows are dealt by ranges of ``order`` and sorted inside their partitions, so a row's number is its place in
    its partition after the sizes of the partitions before it: one number per partition comes to the driver. The sorted
    rows are checkpointed to the shared folder, so that places and sizes are those of one deal.
    Rows equal in ``order`` get numbers of their own, in no defined order.
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    at = F.monotonically_increasing_id()
    dealt = (df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_at", at)
             .withColumn("_part", F.shiftright("_at", _PLACE_BITS)).checkpoint())
    before, offsets = 0, []
    for r in dealt.groupBy("_part").agg(F.count(F.lit(1)).alias("n")).orderBy("_part").collect():
        offsets.append((r["_part"], before))
        before += r["n"]
    starts = spark.createDataFrame(offsets, "_part bigint, _before bigint")  # a row per partition
    place = F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1)) + 1
    return dealt.join(F.broadcast(starts), "_part").select(*df.columns, (F.col("_before") + place).alias(name))
