"""Per-station statistics from the audit trail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import timekeys as t


def station_stats(audit: DataFrame) -> DataFrame:
    """Totals and last activity per station; works on a batch table and, in update mode, on a stream.

    All parts are sums and maxima, so Spark keeps one small state row per station and combines before the shuffle; a
    station with a third of all rows is no hot spot.
    """
    fetched = F.col("frames_fetched") > 0
    return audit.groupBy("station").agg(
        F.sum("frames_fetched").alias("frames_fetched"),
        F.sum("frames_failed").alias("frames_failed"),
        F.max("fetch_ns").alias("last_fetch_ns"),
        # Objects of a batch are fetched in parallel, so the latest frame is the one with the latest timestamp.
        F.max(F.when(fetched, F.col("timestamp"))).alias("last_frame_timestamp"),
        F.max("key").alias("last_processed_key"),
    )


def totals(stats: DataFrame) -> DataFrame:
    """One row over all stations."""
    return stats.agg(
        F.coalesce(F.sum("frames_fetched"), F.lit(0)).alias("frames_fetched"),
        F.coalesce(F.sum("frames_failed"), F.lit(0)).alias("frames_failed"),
        F.coalesce(F.max("last_fetch_ns"), F.lit(0)).alias("last_fetch_timestamp"),
        F.count("*").alias("total_stations_tracked"),
    ).withColumn("success_rate", t.success_rate(F.col("frames_fetched"), F.col("frames_failed")))


def recent(stats: DataFrame, n: int = 50) -> DataFrame:
    """The stations with the latest activity."""
    return stats.orderBy(F.desc("last_fetch_ns"), "station").limit(n)


def dashboard(stats: DataFrame, terminal_rows: int = 24, used_rows: int = 19) -> DataFrame:
    """Station lines for a terminal of the given height, alphabetical."""
    lines = stats.select(
        "station",
        "frames_fetched",
        F.coalesce("last_frame_timestamp", F.lit("N/A")).alias("last_frame"),
        t.clock_from_ns(F.col("last_fetch_ns")).alias("last_fetch"),
    )
    return lines.orderBy("station").limit(max(1, terminal_rows - used_rows))
