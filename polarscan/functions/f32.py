"""Single-precision arithmetic on columns.

Spark widens ``float / float`` and ``float * int`` to double, so every step is cast back: results then equal IEEE
float32 arithmetic, which the decode and quantize formulas are defined in.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def f32(x: Column | float | int) -> Column:
    return (x if isinstance(x, Column) else F.lit(float(x))).cast("float")


def add(a, b) -> Column:
    return (f32(a) + f32(b)).cast("float")


def sub(a, b) -> Column:
    return (f32(a) - f32(b)).cast("float")


def mul(a, b) -> Column:
    return (f32(a) * f32(b)).cast("float")


def div(a, b) -> Column:
    """float32 quotient; null for a zero divisor."""
    return F.try_divide(f32(a), f32(b)).cast("float")


def round_half_away(x: Column) -> Column:
    """Nearest whole number, halves away from zero, as double."""
    x = x.cast("double")
    return F.signum(x) * F.floor(F.abs(x) + F.lit(0.5)).cast("double")
