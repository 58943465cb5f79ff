"""As-of joins and event-time windows on the mapped tables; the streams read the events in order of time."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import asof
from ..session import scratch_path
from ..streaming import windows
from . import mapping as m
from .registry import query

SLICES = 4
DAY = 86400
_SLICE_SQL = f"least(floor((epoch_us(ts) - lo) * {SLICES} / (hi - lo + 1)), {SLICES - 1})"

_EVENT_TIMES = """ev AS (SELECT event_id, 'K' || lpad(CAST(user_id % 200 AS VARCHAR), 3, '0') AS station,
    TIMESTAMP '1992-01-01' + to_days(CAST((event_id * 7919) % 2557 AS INTEGER)) + to_minutes((event_id % 48) * 30) AS time FROM events)"""


@query(
    f"""WITH {_EVENT_TIMES}, fr AS (SELECT 'K' || lpad(CAST(o_custkey % 150 AS VARCHAR), 3, '0') AS station,
        CAST(o_orderdate AS TIMESTAMP) + to_hours(o_orderkey % 24) AS time, max({{'product': o_orderstatus, 'frame': o_orderkey}}) AS f FROM orders GROUP BY ALL)
      SELECT e.event_id, e.station, e.time, f.time AS found_time, f.f.product AS product, f.f.frame AS frame
      FROM ev e ASOF LEFT JOIN fr f ON e.station = f.station AND e.time >= f.time"""
)
def as_of_frames(spark, sf):
    """The latest frame of the station at or before each event, with ties, long gaps and stations without frames."""
    e, o = m.table(spark, sf, "events"), m.table(spark, sf, "orders")
    start = F.lit(dt.datetime(1992, 1, 1)).cast("timestamp_ntz")
    minutes = F.pmod(F.col("event_id") * 7919, F.lit(2557)) * 1440 + F.col("event_id") % 48 * 30
    named = lambda n, width: F.concat(F.lit("K"), F.lpad((n % width).cast("string"), 3, "0")).alias("station")
    rows = e.select("event_id", named(F.col("user_id"), 200), (start + F.make_dt_interval(mins=minutes.cast("int"))).alias("time"))
    hour = F.make_dt_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    frames = o.select(
        named(F.col("o_custkey"), 150), (F.col("o_orderdate").cast("timestamp_ntz") + hour).alias("time"), F.col("o_orderstatus").alias("product"), F.col("o_orderkey").alias("frame")
    )
    utc = [r.withColumn("time", F.col("time").cast("timestamp")) for r in (rows, frames)]
    found = asof.as_of(*utc, ["station"], "time", 30 * DAY)
    times = [F.col(c).cast("timestamp_ntz").alias(c) for c in ("time", "found_time")]
    return found.select("event_id", "station", *times, "found.product", "found.frame")


def observations(spark, sf) -> DataFrame:
    e = m.table(spark, sf, "events")
    station = F.concat(F.lit("K"), F.lpad((F.col("user_id") % 40).cast("string"), 3, "0"))
    return e.select(station.alias("station"), F.col("ts").cast("timestamp").alias("time"), "event_id")


_OBS = "obs AS (SELECT 'K' || lpad(CAST(user_id % 40 AS VARCHAR), 3, '0') AS station, ts AS time, event_id FROM events)"


def _slices(rows: DataFrame, times: int) -> list[DataFrame]:
    """The rows cut into spans of time, in order; every row is ``times`` in its span."""
    micros = F.unix_micros("time")
    low, high = rows.agg(F.min(micros), F.max(micros)).first()
    if low is None:
        return []
    number = F.least(F.floor((micros - low) * SLICES / (high - low + 1)), F.lit(SLICES - 1))
    cut = rows.withColumn("slice", number)
    parts = [cut.where(F.col("slice") == i).drop("slice") for i in range(SLICES)]
    return [part if times == 1 else part.withColumn("copy", F.explode(F.sequence(F.lit(1), F.lit(times)))).drop("copy") for part in parts]


def _streamed(spark, parts: list[DataFrame], schema, apply):
    """Streams the parts one after another and returns (what ``apply`` made of them in append mode, progress reports).

    A last row far ahead, of no station, moves the clock on, so that everything before it is closed."""
    source, out = scratch_path(spark, "observations"), scratch_path(spark, "windows")
    ahead = spark.createDataFrame([("", dt.datetime(2200, 1, 1), -1)], schema)
    files = spark.sparkContext.defaultParallelism
    for i, part in enumerate([*(part.repartition(files) for part in parts), ahead.coalesce(1)]):
        part.write.parquet(f"{source}/part={i}")
    # files come in order of their time of change, so a trigger takes one part
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(f"{source}/part=*")
    writer = apply(stream).writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", scratch_path(spark, "checkpoint"))
    run = writer.trigger(availableNow=True).start()
    run.awaitTermination()
    return spark.read.schema(apply(stream).schema).parquet(out).where("station <> ''"), run.recentProgress


def _ntz(rows: DataFrame) -> DataFrame:
    return rows.select(*[F.col(c).cast("timestamp_ntz").alias(c) if t == "timestamp" else F.col(c) for c, t in rows.dtypes])


def _windowed(spark, sf, apply) -> DataFrame:
    rows = observations(spark, sf)
    return _ntz(_streamed(spark, _slices(rows, 1), rows.schema, apply)[0])


@query(
    f"""WITH {_OBS} SELECT station, time_bucket(INTERVAL 10 MINUTE, time) AS start, time_bucket(INTERVAL 10 MINUTE, time) + INTERVAL 10 MINUTE AS end,
      count(*) AS volumes, max(time) AS last_time FROM obs GROUP BY ALL"""
)
def stream_tumbling_windows(spark, sf):
    """Volumes per station and 10 minutes, each window once, closed by the watermark."""
    return _windowed(spark, sf, lambda rows: windows.per_window(rows, "10 minutes"))


@query(
    f"""WITH {_OBS}, w AS (SELECT station, time, time_bucket(INTERVAL 10 MINUTE, time) - to_minutes(k * 10) AS start FROM obs, range(3) r(k))
      SELECT station, start, start + INTERVAL 30 MINUTE AS end, count(*) AS volumes, max(time) AS last_time FROM w GROUP BY ALL"""
)
def stream_sliding_windows(spark, sf):
    """Volumes per station and 30 minutes, every 10 minutes."""
    return _windowed(spark, sf, lambda rows: windows.per_window(rows, "30 minutes", "10 minutes"))


@query(
    f"""WITH {_OBS}, g AS (SELECT *, CASE WHEN time >= lag(time) OVER s + INTERVAL 2 HOUR THEN 1 ELSE 0 END AS fresh FROM obs WINDOW s AS (PARTITION BY station ORDER BY time, event_id)),
      n AS (SELECT *, sum(fresh) OVER (PARTITION BY station ORDER BY time, event_id ROWS UNBOUNDED PRECEDING) AS number FROM g)
      SELECT station, min(time) AS start, max(time) + INTERVAL 2 HOUR AS end, count(*) AS volumes, max(time) AS last_time FROM n GROUP BY station, number"""
)
def stream_sessions(spark, sf):
    """Observation sessions per station, parted by two hours without a volume."""
    return _windowed(spark, sf, lambda rows: windows.sessions(rows, "2 hours"))


@query(
    f"""WITH {_OBS}, span AS (SELECT min(epoch_us(ts)) AS lo, max(epoch_us(ts)) AS hi FROM events),
      late AS (SELECT count(*) AS n FROM events, span WHERE {_SLICE_SQL} = 0)
      SELECT station, strftime(time, '%Y%m%d_%H%M%S') AS stamp, CAST(1 AS BIGINT) AS n FROM obs GROUP BY ALL
      UNION ALL SELECT 'late', NULL, n FROM late"""
)
def stream_first_of_each(spark, sf):
    """Keys that are listed three times and come again days later: one row per station and second, and the number of late rows."""
    rows = observations(spark, sf)
    parts, again = _slices(rows, 3), _slices(rows, 1)[:1]
    stamp = F.date_format("time", "yyyyMMdd_HHmmss").alias("stamp")
    keyed = lambda stream: windows.first_of_each(stream.select("station", "time", stamp), ["station", "stamp"], "1 minute")
    kept, reports = _streamed(spark, [*parts, *again], rows.schema, keyed)
    late = spark.createDataFrame([("late", None, windows.late_rows(reports))], "station string, stamp string, n bigint")
    return kept.groupBy("station", "stamp").agg(F.count("*").alias("n")).unionAll(late)
