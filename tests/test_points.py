"""Positions of points in double precision."""

import math

from polarscan.functions.geometry import EFFECTIVE_RADIUS_M as R
from polarscan.operators import points


def test_positions_are_not_rounded_to_single_precision(spark):
    bins = spark.createDataFrame([("v", "velocity", 0, 0, 0, 33.125, 99625.0, 5.0)], "volume_id string, product string, sweep_id int, msg_seq int, gate int, azimuth float, range_m float, value float")
    sweeps = spark.createDataFrame([("v", 0, 0.5)], "volume_id string, sweep_id int, elevation_deg float")
    frames = spark.createDataFrame([("v", "velocity", 413.0)], "volume_id string, product string, height_asl float")
    e, a, base = math.radians(0.5), math.radians(33.125), R + 413
    theta = math.atan2(99625 * math.cos(e), base + 99625 * math.sin(e))
    exact = R * theta * math.sin(a)
    got = points.positions(bins, sweeps, frames).first()["x"]
    single = points.to_points3d(bins, sweeps, frames).first()["x"]
    assert abs(got - exact) < 1e-8 < abs(single - exact)
