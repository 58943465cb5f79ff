"""Big-endian field access on binary columns, and byte-level encodings."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _off(offset: Column | int) -> Column:
    return offset if isinstance(offset, Column) else F.lit(offset)


def take(blob: Column, offset: Column | int, n: Column | int) -> Column:
    return F.substring(blob, (_off(offset) + F.lit(1)).cast("int"), _off(n).cast("int"))


def has_bytes(blob: Column, offset: Column | int, n: Column | int) -> Column:
    return F.octet_length(blob) >= _off(offset) + _off(n)


def pointer_ok(pointer: Column, need: Column | int, size: Column | int) -> Column:
    """A block pointer is usable when it is set and ``need`` bytes fit behind it."""
    return (pointer != 0) & (pointer <= _off(size)) & (pointer + _off(need) <= _off(size))


def be_uint(blob: Column, offset: Column | int, n: int) -> Column:
    return F.conv(F.hex(take(blob, offset, n)), 16, 10).cast("bigint")


def be_u8(blob: Column, offset: Column | int) -> Column:
    return be_uint(blob, offset, 1).cast("int")


def be_u16(blob: Column, offset: Column | int) -> Column:
    return be_uint(blob, offset, 2).cast("int")


def be_i16(blob: Column, offset: Column | int) -> Column:
    u = be_uint(blob, offset, 2)
    return F.when(u >= 32768, u - 65536).otherwise(u).cast("smallint")


def be_u32(blob: Column, offset: Column | int) -> Column:
    return be_uint(blob, offset, 4)


def be_f32(blob: Column, offset: Column | int) -> Column:
    """IEEE-754 single: sign, 8-bit exponent, 23-bit fraction, exact in double before the final cast."""
    bits = be_u32(blob, offset)
    sign = F.when(F.shiftright(bits, 31).bitwiseAND(F.lit(1)) == 1, F.lit(-1.0)).otherwise(F.lit(1.0))
    exponent = F.shiftright(bits, 23).bitwiseAND(F.lit(255))
    fraction = bits.bitwiseAND(F.lit(0x7FFFFF)).cast("double")
    infinite = F.when(fraction == 0, F.lit(float("inf"))).otherwise(F.lit(float("nan")))
    magnitude = (
        F.when(exponent == 255, infinite)
        .when(exponent == 0, fraction * F.lit(2.0**-149))
        .otherwise((fraction + F.lit(8388608.0)) * F.pow(F.lit(2.0), (exponent - 150).cast("double")))
    )
    return (sign * magnitude).cast("float")


def text(blob: Column, offset: Column | int, n: int) -> Column:
    """Fixed-width characters up to the first NUL."""
    return F.regexp_extract(F.decode(take(blob, offset, n), "ISO-8859-1"), "^[^\\x00]*", 0)


def base64_plain(blob: Column) -> Column:
    """Base64 on one line: the built-in function may break lines, depending on the session."""
    return F.regexp_replace(F.base64(blob), "[\r\n]", "")


def halves(values: np.ndarray) -> np.ndarray:
    """IEEE half bits of float32 values, dropping the excess fraction bits instead of rounding them."""
    bits = np.ascontiguousarray(values, dtype="<f4").view("<u4")
    sign = ((bits >> 16) & 0x8000).astype(np.uint32)
    exponent = ((bits >> 23) & 0xFF).astype(np.int32)
    fraction = bits & 0x7FFFFF
    rebased = exponent - 112
    tiny_shift = np.clip(14 - rebased, 0, 31).astype(np.uint32)
    tiny = ((fraction | 0x800000) >> tiny_shift) & 0x3FF
    normal = (np.clip(rebased, 0, 31).astype(np.uint32) << 10) | (fraction >> 13)
    out = np.select(
        [
            (exponent == 255) & (fraction != 0),
            (exponent == 255) | (rebased >= 31),
            (exponent == 0) | (rebased < -10),
            rebased <= 0,
        ],
        [0x7E00 | (fraction >> 13), np.uint32(0x7C00), np.uint32(0), tiny],
        default=normal,
    )
    return (sign | out).astype("<u2")


@F.pandas_udf(T.IntegerType())
def f16_bits(value: pd.Series) -> pd.Series:
    return pd.Series(halves(value.to_numpy(dtype="f4", na_value=np.nan)).astype("i4"), index=value.index)
