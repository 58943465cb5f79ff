"""Checks on decoded streams: sequence gaps, azimuth gaps, bin counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SEQUENCE_MODULUS = 65536
GAP_WARNING_DEG = 1.1


def sequence_gaps(messages: DataFrame, keys: list[str], order: str = "msg_seq", number: str = "sequence_num") -> DataFrame:
    """Rows whose sequence number is not the previous one plus one, modulo 2^16."""
    prev = F.lag(number).over(W.partitionBy(*keys).orderBy(order))
    return (
        messages.withColumn("previous", prev)
        .where(F.col("previous").isNotNull())
        .withColumn("expected", F.pmod(F.col("previous") + 1, F.lit(SEQUENCE_MODULUS)))
        .where(F.col(number) != F.col("expected"))
    )


def milli_degrees(azimuth):
    return F.floor((azimuth * F.lit(1000.0).cast("float")).cast("float").cast("double") + F.lit(0.5)).cast("int")


def azimuth_gaps(rads: DataFrame, keys: list[str]) -> DataFrame:
    """Unique azimuths and the widest gap around the circle, in milli-degrees, per group.

    Azimuths are deduplicated before the window, so a group holds at most 360,200 rows however many radials it has.
    """
    unique = rads.select(*keys, milli_degrees(F.col("azimuth")).alias("az")).distinct()
    step = F.col("az") - F.lag("az").over(W.partitionBy(*keys).orderBy("az"))
    return (
        unique.withColumn("step", step)
        .groupBy(*keys)
        .agg(
            F.count("*").alias("unique_azimuths"),
            F.greatest(F.coalesce(F.max("step"), F.lit(0)), F.lit(360000) - F.max("az") + F.min("az")).alias("max_gap_milli"),
        )
        .withColumn("flagged", F.col("max_gap_milli") > int(GAP_WARNING_DEG * 1000))
    )


def bin_counts(bins: DataFrame) -> DataFrame:
    return bins.groupBy("volume_id", "product").agg(
        F.count("*").alias("total_bins"), F.count_distinct(milli_degrees(F.col("azimuth"))).alias("unique_azimuths")
    )


def sample_bins(bins: DataFrame, n: int = 20) -> DataFrame:
    """First bins of the first sweep, in stream order."""
    return bins.where(F.col("sweep_id") == 0).orderBy("volume_id", "product", "msg_seq", "gate").limit(n)
