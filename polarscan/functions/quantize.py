"""Value scaling: calibration, 0.1 rounding, 8-bit codes, polar cell indexes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import f32 as f

MIN_DBZ = -32.0
LEGACY_OFFSET, LEGACY_SCALE = 66.0, 2.0
RAY_EPSILON = 0.01


def calibrate(raw: Column, offset: Column | float, scale: Column | float) -> Column:
    return f.div(f.sub(raw, offset), scale)


def calibrate_legacy(raw: Column) -> Column:
    return f.mul(f.sub(raw, LEGACY_OFFSET), 0.5)


def round_tenth(value: Column) -> Column:
    return f.mul(f.round_half_away(f.mul(value, 10.0)), 0.1)


def gate_range(first_gate: Column | float, gate: Column, spacing: Column | float) -> Column:
    return f.add(first_gate, f.mul(gate, spacing))


def _unit(value: Column, low: Column | float, high: Column | float) -> Column:
    return F.least(F.greatest(f.div(f.sub(value, low), f.sub(high, low)), f.f32(0.0)), f.f32(1.0))


def quantize(value: Column, low: Column | float, high: Column | float) -> Column:
    """0..255 code of ``value`` on [low, high]; 0 for NaN."""
    code = F.floor(f.mul(_unit(value, low, high), 255.0).cast("double") + F.lit(0.5)).cast("int")
    return F.when(F.isnan(f.f32(value)), F.lit(0)).otherwise(code)


def quantize_truncating(value: Column, low: float, high: float) -> Column:
    """The offline dialect: scale, clamp to 0..255, drop the fraction."""
    scaled = f.mul(f.div(f.sub(value, low), f.f32(high) - f.f32(low)), 255.0)
    return F.floor(F.least(F.greatest(scaled, f.f32(0.0)), f.f32(255.0))).cast("int")


def dequantize(code: Column, low: Column | float, high: Column | float) -> Column:
    low = low if isinstance(low, Column) else F.lit(float(low))
    high = high if isinstance(high, Column) else F.lit(float(high))
    return low.cast("double") + code.cast("double") / F.lit(255.0) * (high.cast("double") - low.cast("double"))


def quantize_azimuth(azimuth: Column) -> Column:
    """0..65535 code of an angle on [0, 360]."""
    return F.floor(f.mul(_unit(azimuth, 0.0, 360.0), 65535.0).cast("double") + F.lit(0.5)).cast("int")


def tilt_key(elevation: Column) -> Column:
    return f.round_half_away(f.mul(elevation, 100.0)).cast("int")


def elevation_group(elevation: Column) -> Column:
    return f.div(f.round_half_away(f.mul(elevation, 10.0)), 10.0)


def gate_index(range_m: Column, first_gate: Column | float, spacing: Column | float) -> Column:
    return F.floor(f.div(f.sub(range_m, first_gate), spacing)).cast("int")


def ray_index(azimuth: Column, num_rays: Column | int, epsilon: float = RAY_EPSILON) -> Column:
    """Ray bin of an azimuth in a ring of ``num_rays`` (360 or 720), wrapped into 0..num_rays-1."""
    n = num_rays if isinstance(num_rays, Column) else F.lit(num_rays)
    per_degree = f.div(n, 360.0)
    return F.pmod(F.floor(f.add(f.mul(azimuth, per_degree), epsilon)).cast("int"), n).cast("int")


def cell_index(ray: Column, gate: Column, num_gates: Column | int, tilt_idx: Column | None = None, num_rays: int = 720) -> Column:
    n = num_gates if isinstance(num_gates, Column) else F.lit(num_gates)
    ring = ray.cast("bigint") if tilt_idx is None else tilt_idx.cast("bigint") * F.lit(num_rays) + ray.cast("bigint")
    return ring * n.cast("bigint") + gate.cast("bigint")


def downsampled_gates(num_gates: Column, factor: int = 1) -> Column:
    return F.floor((num_gates + F.lit(factor - 1)) / F.lit(factor)).cast("int")
