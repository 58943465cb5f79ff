"""Event-time windows, sessions and duplicates over observations of stations.

All take rows (station, time, ...) of a table or a stream. On a stream the watermark bounds the state: in append mode a window
leaves once, when no row for it can come any more, and equals the window of a batch over the same rows.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _counted(rows: DataFrame, window) -> DataFrame:
    sums = rows.groupBy(window.alias("w"), "station").agg(F.count("*").alias("volumes"), F.max("time").alias("last_time"))
    return sums.select("station", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "volumes", "last_time")


def per_window(rows: DataFrame, size: str, slide: str | None = None, delay: str = "1 hour") -> DataFrame:
    """Volumes per station and window, tumbling or sliding. Counts combine before the shuffle, so a busy station is no hot key."""
    return _counted(rows.withWatermark("time", delay), F.window("time", size, slide))


def sessions(rows: DataFrame, gap: str, delay: str = "1 hour") -> DataFrame:
    """Observation sessions per station: volumes that follow each other by less than ``gap``. ``end`` is the last time plus
    the gap. Rows are merged to sessions where they lie, before the shuffle."""
    rows.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    return _counted(rows.withWatermark("time", delay), F.session_window("time", gap))


def first_of_each(rows: DataFrame, keys: list[str], delay: str) -> DataFrame:
    """The first row per key on a stream. A key is remembered for ``delay`` after its time; rows older than the watermark with
    which the batch before ran are dropped and counted by ``late_rows``."""
    return rows.withWatermark("time", delay).dropDuplicatesWithinWatermark(keys)


def late_rows(progress: Iterable) -> int:
    """Rows that came after the watermark had passed them, from a query's progress reports."""
    return sum(op.numRowsDroppedByWatermark for report in progress for op in report.stateOperators)
