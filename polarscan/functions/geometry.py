"""Beam geometry on a 4/3 effective-earth radius."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_RADIUS_M = 6371000.0
EFFECTIVE_RADIUS_M = EARTH_RADIUS_M * (4.0 / 3.0)


def _d(x: Column | float) -> Column:
    return (x if isinstance(x, Column) else F.lit(float(x))).cast("double")


def _radians(deg: Column) -> Column:
    return _d(deg) * F.pi() / F.lit(180.0)


def beam_height(range_m: Column, elevation: Column, radar_height: Column | float) -> Column:
    """Height above sea level of the beam centre, in metres."""
    r, base = _d(range_m), F.lit(EFFECTIVE_RADIUS_M) + _d(radar_height)
    return F.sqrt(r * r + base * base + F.lit(2.0) * r * base * F.sin(_radians(elevation))) - F.lit(EFFECTIVE_RADIUS_M)


def earth_angle(range_m: Column, elevation: Column, radar_height: Column | float) -> Column:
    r, e = _d(range_m), _radians(elevation)
    base = F.lit(EFFECTIVE_RADIUS_M) + _d(radar_height)
    return F.atan2(r * F.cos(e), base + r * F.sin(e))


def ground_arc(range_m: Column, elevation: Column, radar_height: Column | float) -> Column:
    return F.lit(EFFECTIVE_RADIUS_M) * earth_angle(range_m, elevation, radar_height)


def beam_x(range_m: Column, azimuth: Column, elevation: Column, radar_height: Column | float) -> Column:
    return ground_arc(range_m, elevation, radar_height) * F.sin(_radians(azimuth))


def beam_y(range_m: Column, azimuth: Column, elevation: Column, radar_height: Column | float) -> Column:
    return ground_arc(range_m, elevation, radar_height) * F.cos(_radians(azimuth))


def beam_z(range_m: Column, elevation: Column, radar_height: Column | float) -> Column:
    """Height relative to the radar's tangent plane."""
    height = beam_height(range_m, elevation, radar_height)
    theta = earth_angle(range_m, elevation, radar_height)
    base = F.lit(EFFECTIVE_RADIUS_M) + _d(radar_height)
    return (F.lit(EFFECTIVE_RADIUS_M) + height) * F.cos(theta) - base
