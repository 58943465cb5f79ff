"""As-of joins and event-time windows against row-by-row versions."""

import datetime as dt
import random

import pytest
from polarscan.operators import asof
from polarscan.streaming import windows

T0 = dt.datetime(2024, 1, 1)


def at(seconds):
    return None if seconds is None else T0 + dt.timedelta(seconds=seconds)


@pytest.mark.parametrize("slice_seconds", [7, 100, 10**6])
def test_as_of_equals_search(spark, slice_seconds):
    draw = random.Random(slice_seconds)
    stations = ["A"] * 6 + ["B", "C", None]
    left = [(i, draw.choice(stations), draw.choice([None, *range(-500, 1000, 7)])) for i in range(150)]
    left += [(1000, "A", 50), (1000, "A", 50), (1001, "none", 5), (1002, "A", 10**7)]
    right = [(draw.choice(stations), draw.choice([None, *range(0, 400, 13), 50]), draw.choice("xyz"), i % 5) for i in range(120)]
    frame = spark.createDataFrame([(i, s, at(t), "clash") for i, s, t in left], "id int, station string, time timestamp, product string").repartition(4)
    frames = spark.createDataFrame([(s, at(t), p, n) for s, t, p, n in right], "station string, time timestamp, product string, n int").repartition(3)
    got = asof.as_of(frame, frames, ["station"], "time", slice_seconds)
    assert got.columns == ["id", "station", "time", "product", "found_time", "found"]
    want = []
    for i, s, t in left:
        hits = [(ft, p, n) for fs, ft, p, n in right if None not in (s, t, ft) and fs == s and ft <= t]
        best = max(hits, default=(None, None, None))
        want.append((i, s, at(t), at(best[0]), best[1:]))
    rows = [(r.id, r.station, r.time, r.found_time, tuple(r.found) if r.found else (None, None)) for r in got.collect()]
    assert sorted(rows, key=repr) == sorted(want, key=repr)


def test_as_of_with_empty_tables(spark):
    schema = "station string, time timestamp, n int"
    some, none = spark.createDataFrame([("A", T0, 1)], schema), spark.createDataFrame([], schema)
    assert [tuple(r) for r in asof.as_of(some, none, ["station"], "time", 60).collect()] == [("A", T0, 1, None, None)]
    assert asof.as_of(none, some, ["station"], "time", 60).count() == 0


def streamed(spark, folder, batches, apply):
    schema = "station string, time timestamp"
    for i, batch in enumerate(batches):
        rows = spark.createDataFrame([(s, at(t)) for s, t in batch], schema)
        rows.coalesce(1).write.parquet(str(folder / f"in/part={i}"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder / "in/part=*"))
    run = apply(stream).writeStream.outputMode("append").format("parquet").option("path", str(folder / "out"))
    run = run.option("checkpointLocation", str(folder / "checkpoint")).trigger(availableNow=True).start()
    run.awaitTermination()
    everything = spark.createDataFrame([(s, at(t)) for batch in batches for s, t in batch], schema)
    got = spark.read.schema(apply(everything).schema).parquet(str(folder / "out"))
    return got, everything, run.recentProgress


@pytest.mark.parametrize("kind", ["tumbling", "sliding", "sessions"])
def test_windows_of_a_stream_are_those_of_a_batch(spark, tmp_path, kind):
    apply = {
        "tumbling": lambda rows: windows.per_window(rows, "1 minute", delay="30 seconds"),
        "sliding": lambda rows: windows.per_window(rows, "1 minute", "20 seconds", delay="30 seconds"),
        "sessions": lambda rows: windows.sessions(rows, "25 seconds", delay="30 seconds"),
    }[kind]
    draw = random.Random(2)
    batches = [[(draw.choice("AAAB"), 200 * i + draw.randint(0, 199)) for _ in range(25)] for i in range(3)]
    got, everything, _ = streamed(spark, tmp_path, [*batches, [("", 10**6)]], apply)
    want = apply(everything)
    rows = lambda frame: sorted(map(tuple, frame.where("station <> ''").collect()))
    assert rows(got) == rows(want) and got.count() > 3


def test_first_of_each_counts_late_rows(spark, tmp_path):
    batches = [[("A", 10), ("A", 10), ("B", 12)], [("A", 10), ("C", 100)], [("F", 101)], [("A", 10), ("D", 55), ("E", 100)]]
    apply = lambda rows: windows.first_of_each(rows, ["station", "time"], "40 seconds")
    got, _, reports = streamed(spark, tmp_path, batches, apply)
    # the last batch comes behind the watermark of 60 seconds that the second one has set and the third one knows
    assert sorted((r.station, r.time) for r in got.collect()) == [("A", at(10)), ("B", at(12)), ("C", at(100)), ("E", at(100)), ("F", at(101))]
    assert windows.late_rows(reports) == 2


def test_late_rows_of_no_report():
    assert windows.late_rows([]) == 0
