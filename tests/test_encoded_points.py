"""Encoded points against quadruples put in order by numpy."""

import base64

import numpy as np
from polarscan.functions import bytes_be
from polarscan.operators import points, raster
from pyspark.sql import functions as F


def test_points_are_encoded_in_stream_order_whatever_order_they_come_in(spark):
    draw = np.random.default_rng(2)
    rows = [(f"v{v}", p, s, m, g, *draw.normal(0, 900, 4).astype("f4").tolist()) for v in range(9) for p in ("a", "b") for s in range(2) for m in range(s * 4, s * 4 + 4) for g in sorted(draw.choice(99, 11, replace=False).tolist())]
    rows += [("v0", "a", 0, 1, 200, 3.0, 2.0, 1.0, 0.5), ("v0", "a", 0, 1, 200, 1.0, 2.0, 3.0, 0.5)]  # one gate twice
    frame = spark.createDataFrame(rows, "volume_id string, product string, sweep_id int, msg_seq int, gate int, x float, y float, z float, value float")
    want = {}
    for r in rows:
        want.setdefault(r[:2], []).append((*r[2:5], bytes_be.halves(np.array(r[5:], "f4")).tobytes()))
    want = {k: b"".join(q for *_, q in sorted(v)) for k, v in want.items()}
    for given in (frame.coalesce(1), frame.orderBy(F.rand(4)).repartition(5)):
        got = {(r["volume_id"], r["product"]): base64.b64decode(r["encoded"]) for r in points.encode_points_f16(given).collect()}
        assert got == want


def exchanges(frame) -> int:
    return frame._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_points_are_shuffled_once(spark):
    frame = spark.createDataFrame([("v", "a", 0, 0, 0, 1.0, 1.0, 1.0, 1.0)], "volume_id string, product string, sweep_id int, msg_seq int, gate int, x float, y float, z float, value float")
    assert exchanges(points.encode_points_f16(frame)) == 1


def test_cells_of_a_volume_are_spread_behind_the_only_exchange(spark):
    names = "volume_id string, product string, tilt_idx int, tilt float, num_rays int, ngates int, grid_first float, grid_spacing float, azimuth float, range_m float, value float"
    bins = spark.createDataFrame([("v", "velocity", 0, 0.5, 360, 9, 0.0, 250.0, a, 500.0, v) for a, v in ((1.1, 3.0), (1.6, 9.0), (359.6, 5.0))], names)
    cells = raster.cells_3d(bins)
    plan = cells._jdf.queryExecution().executedPlan().toString()
    assert exchanges(cells) == 1 and plan.index("Generate") < plan.index("Exchange hashpartitioning")
    got = {r["ray"]: r["q"] for r in cells.collect()}
    assert set(got) == {0, 2, 3, 4, 719} and got[3] == got[4] > got[2] and got[0] == got[719]
