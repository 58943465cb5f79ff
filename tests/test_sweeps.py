"""Sweep numbers of long streams: ranges of any size give what one pass over the stream gives."""

import random

import pytest
from polarscan.operators import framing, index, radials

SCHEMA = "volume_id string, msg_seq int, msg_type int, radial_status int, elev_num int"


def numbered(rows):
    """One pass, in order."""
    out, sweep, number = {}, {}, {}
    for volume, seq, kind, status, elev in sorted(rows):
        first = volume not in sweep
        started = first or status in (0, 3, 5)
        sweep[volume] = sweep.get(volume, -1) + (started or (kind == 31 and elev != number.get(volume)))
        if kind == 31:
            number[volume] = elev
        elif started:
            number[volume] = 255
        out[volume, seq] = sweep[volume]
    return out


@pytest.mark.parametrize("size", [1, 5, 64])
def test_ranges_do_not_change_sweep_numbers(spark, monkeypatch, size):
    monkeypatch.setattr(radials, "RANGE", size)
    rnd = random.Random(size)
    rows = [
        (f"v{v}", seq, 1 if rnd.random() < (0.9 if v % 2 else 0.2) else 31, rnd.choice([1, 1, 1, 1, 0, 3, 5]), rnd.choice([1, 1, 1, 2, 255]))
        for v in range(12)
        for seq in sorted(rnd.sample(range(200), 60))
    ]
    got = radials.sweep_segments(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {(r["volume_id"], r["msg_seq"]): r["sweep_id"] for r in got} == numbered(rows)


def test_framing_numbers_sweeps_the_same_way():
    rnd = random.Random(3)
    rows, sweeps, got = [], framing._Sweeps(), {}
    for seq in range(300):
        kind, status, elev = rnd.choice([1, 31, 31]), rnd.choice([1, 1, 1, 0, 3]), rnd.choice([1, 1, 2])
        head = bytearray(72)
        head[1 if kind == 1 else 21], head[22], head[31] = status, elev, 1
        rows.append(("v", seq, kind, status, elev))
        got["v", seq] = sweeps.add(kind, bytes(head))
    assert got == numbered(rows)
    assert sweeps.add(31, bytes(71)) is None and sweeps.add(2, bytes(72)) is None and sweeps.add(31, bytes(72)) is None


def test_upsert_keeps_one_row_per_key(spark):
    one = spark.createDataFrame([("a", 1), ("a", 5), ("b", 2)], "k string, n int")
    two = spark.createDataFrame([("b", 1), ("c", 3), ("c", 4)], "k string, n int")
    assert sorted(map(tuple, index.upsert(one, two, ["k"]).collect())) == [("a", 5), ("b", 1), ("c", 4)]
    wide = [d.withColumn("m", d.n) for d in (one, two)]
    assert sorted(map(tuple, index.upsert(*wide, ["k"]).collect())) == [("a", 5, 5), ("b", 1, 1), ("c", 4, 4)]
    plan = index.upsert(one, two, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan
