"""As-of join: each row with the latest row of another table at or before its time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def as_of(left: DataFrame, right: DataFrame, keys: list[str], time: str, slice_seconds: int) -> DataFrame:
    """Rows of ``left`` with ``found``: the other columns of the newest row of ``right`` with equal keys whose time is not
    later, and ``found_time``; both null where there is none. Of rows at the same time the greatest counts.

    Both tables are laid together and cut into slices of time. Inside a slice the newest row so far comes from a window; what
    the slices before leave is one row per key and slice, carried forward over slices alone. So a key that most rows have is
    ordered slice by slice, never as a whole, and a gap of any length costs one carried row. Null keys and times find nothing.
    """
    rest = [c for c in right.columns if c not in (*keys, time)]
    slot = F.floor(F.unix_micros(time) / (slice_seconds * 1_000_000)).alias("_slice")
    there = right.select(*keys, F.col(time).alias("_time"), slot, F.struct(F.col(time).alias("t"), F.struct(*rest).alias("found")).alias("_frame"), F.lit(None).alias("_row"))
    there = there.dropna(subset=[*keys, "_time"])
    here = left.select(*keys, F.col(time).alias("_time"), slot, F.lit(None).alias("_frame"), F.struct(*left.columns).alias("_row"))
    both = there.unionByName(here.where(F.col("_time").isNotNull()))
    slices = both.groupBy(*keys, "_slice").agg(F.max("_frame").alias("_last"))
    earlier = W.partitionBy(*keys).orderBy("_slice").rowsBetween(W.unboundedPreceding, -1)
    carried = slices.select(*keys, "_slice", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    # frames before rows of the same time; frames of the same time in their order
    so_far = W.partitionBy(*keys, "_slice").orderBy("_time", F.col("_row").isNotNull(), "_frame").rowsBetween(W.unboundedPreceding, 0)
    placed = both.withColumn("_seen", F.last("_frame", ignorenulls=True).over(so_far)).where(F.col("_row").isNotNull())
    joined = placed.join(carried.hint("merge"), [*keys, "_slice"], "left").withColumn("_best", F.coalesce("_seen", "_carried"))
    nothing = left.where(F.col(time).isNull()).select("*", F.lit(None).alias("found_time"), F.lit(None).alias("found"))
    return joined.select("_row.*", F.col("_best.t").alias("found_time"), F.col("_best.found").alias("found")).unionByName(nothing)
