"""Fixed expected values for scalar functions, and properties of packing."""

import bz2
import math
import struct

import numpy as np
import pytest
import volume_writer as w
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from polarscan import products as pr
from polarscan.functions import bytes_be as b
from polarscan.functions import geometry as g
from polarscan.functions import quantize as q
from polarscan.functions import timekeys as t
from polarscan.operators import pack
from polarscan.operators.moments import value_table
from polarscan.operators.raster import _pack, code_table
from polarscan.sources import containers

CODES = {
    "reflectivity": [(-32, 0), (-31.5, 1), (-15.678, 33), (0, 65), (32, 129), (50.123, 166), (64, 194), (94.5, 255)],
    "velocity": [(-100, 0), (-99.7, 0), (-50, 64), (0, 128), (25.5, 160), (100, 255)],
    "spectrum_width": [(0, 0), (0.1, 0), (0.2, 1), (4, 16), (64, 255)],
    "differential_reflectivity": [(-8, 0), (-1, 112), (0, 128), (0.5, 135), (8, 255)],
    "differential_phase": [(0, 0), (0.5, 0), (90, 64), (180, 128), (360, 255)],
    "correlation_coefficient": [(0, 0), (0.5, 116), (0.95, 220), (1.0, 232), (1.1, 255)],
}


def rows(spark, data, schema):
    return spark.createDataFrame(data, schema)


def test_quantized_codes(spark):
    data = [(p, float(v), c) for p, pairs in CODES.items() for v, c in pairs]
    p = F.col("p")
    df = rows(spark, data, "p string, v float, want int").withColumn("got", q.quantize(F.col("v"), pr.value_min_of(p), pr.value_max_of(p)))
    assert [r for r in df.collect() if r["got"] != r["want"]] == []


def test_quantize_round_trip_error(spark):
    values = [-32.0, -31.5, 0.0, 32.0, 64.0, 94.5, 50.123, -15.678]
    code = q.quantize(F.col("v"), -32.0, 94.5)
    df = rows(spark, [(v,) for v in values], "v float").select("v", q.dequantize(code, -32.0, 94.5).alias("back"))
    assert all(abs(r["v"] - r["back"]) <= 126.5 / 255 for r in df.collect())


def test_nan_quantizes_to_nothing(spark):
    df = rows(spark, [(math.nan,)], "v float").select(q.quantize(F.col("v"), -32.0, 94.5).alias("q"))
    assert df.first()["q"] == 0


def test_gate_and_ray_indexes(spark):
    gates = [(500.0, 0), (749.9, 0), (750.0, 1), (999.9, 1), (1000.0, 2), (499.0, -1), (250.0, -1)]
    got = rows(spark, gates, "r float, want int").select("want", q.gate_index(F.col("r"), 500.0, 250.0).alias("got")).collect()
    assert all(r["got"] == r["want"] for r in got)
    rays = [(0.0, 0, 0), (0.5, 0, 1), (1.0, 1, 2), (179.9, 179, 359), (180.0, 180, 360), (359.5, 359, 719), (359.9, 359, 719), (-0.05, 359, 719)]
    df = rows(spark, rays, "az float, a int, b int").select("*", q.ray_index(F.col("az"), 360).alias("x"), q.ray_index(F.col("az"), 720).alias("y"))
    assert [(r["az"], r["x"], r["y"]) for r in df.collect() if (r["x"], r["y"]) != (r["a"], r["b"])] == []


def test_big_endian_reads_and_pointers(spark):
    blob = bytes.fromhex("12345678") + struct.pack(">fffhH", -2.5, 1e-40, math.inf, -300, 65535)
    x = F.col("x")
    r = rows(spark, [(bytearray(blob),)], "x binary").select(
        b.be_u16(x, 0), b.be_u32(x, 0), b.be_f32(x, 4), b.be_f32(x, 8), b.be_f32(x, 12), b.be_i16(x, 16), b.be_u16(x, 18)
    ).first()
    assert r[0] == 0x1234 and r[1] == 0x12345678 and r[2] == -2.5 and r[4] == math.inf and r[5] == -300 and r[6] == 65535
    assert abs(r[3] - 1e-40) < 1e-44
    checks = [(100, 50, 1000, True), (0, 50, 1000, False), (200, 50, 100, False), (50, 100, 100, False), (50, 50, 100, True), (50, 60, 100, False), (1000, 1, 1000, False)]
    df = rows(spark, checks, "p int, n int, s int, want boolean").withColumn("got", b.pointer_ok(F.col("p"), F.col("n"), F.col("s")))
    assert all(r["got"] == r["want"] for r in df.collect())


def test_float16_bits(spark):
    pairs = [(0.1, 0x2E66), (1.0, 0x3C00), (-2.5, 0xC100), (65504.0, 0x7BFF), (70000.0, 0x7C00), (1e-6, 0x0010), (0.0, 0), (1e-9, 0)]
    df = rows(spark, pairs, "v float, want int").withColumn("got", b.f16_bits("v"))
    assert [(r["v"], hex(r["got"])) for r in df.collect() if r["got"] != r["want"]] == []
    assert int(b.halves(np.array([math.inf], "f4"))[0]) == 0x7C00 and int(b.halves(np.array([math.nan], "f4"))[0]) & 0x7E00 == 0x7E00


def test_beam_positions(spark):
    cases = [
        (2125.0, 0.0, 0.5, 0.0, 0.0, 2124.9143, 18.543888),
        (100000.0, 90.0, 0.5, 400.0, 99976.594, 0.0, 872.65356),
        (230000.0, 225.0, 19.5, 384.0, -151893.70, -151893.70, 76775.578),
    ]
    r, az, el, h = (F.col(c) for c in ("r", "az", "el", "h"))
    df = rows(spark, cases, "r double, az double, el double, h double, x double, y double, z double").select(
        "x", "y", "z", g.beam_x(r, az, el, h).alias("gx"), g.beam_y(r, az, el, h).alias("gy"), g.beam_z(r, el, h).alias("gz")
    )
    for row in df.collect():
        assert max(abs(row["x"] - row["gx"]), abs(row["y"] - row["gy"]), abs(row["z"] - row["gz"])) < 0.02


def test_tables_agree_with_columns(spark):
    """The lookup tables of the packing step give what the column expressions give, for every raw code."""
    for product, word, offset, scale in (("reflectivity", 8, 66.0, 2.0), ("differential_phase", 16, 2.0, 2.8361), ("correlation_coefficient", 8, -60.5, 300.0)):
        low, high = pr.value_range(product)
        floor_at = -32.0 if product == "reflectivity" else None
        value = q.round_tenth(q.calibrate(F.col("raw"), offset, scale))
        keep = (F.col("raw") > 1) & ((q.calibrate(F.col("raw"), offset, scale) >= -32.0) if floor_at else F.lit(True))
        code = F.when(keep, q.quantize(value, low, high)).otherwise(F.lit(0))
        got = spark.range(1 << word).withColumnRenamed("id", "raw").select("raw", code.alias("q"), value.alias("v")).orderBy("raw").toPandas()
        assert (got["q"].to_numpy() == code_table(word, offset, scale, floor_at, low, high, False)).all()
        assert (got["v"].to_numpy() == value_table(word, offset, scale, floor_at)[0]).all()


def test_tilt_names_round_half_to_even(spark):
    names = rows(spark, [(0.25,), (0.75,), (0.48,), (12.0,), (-0.5,)], "v float").select(t.tilt_file(F.col("v")).alias("n"))
    assert [r["n"] for r in names.collect()] == ["0.2.RDA", "0.8.RDA", "0.5.RDA", "12.0.RDA", "-0.5.RDA"]


def test_mask_of_sixteen_cells(spark):
    grid = np.zeros(16, "u1")
    grid[[0, 7, 8]] = [42, 84, 99]
    assert _pack(grid) == (bytes([0x81, 0x80]), bytes([42, 84, 99]))
    cells = rows(spark, [("f", 0), ("f", 7), ("f", 8)], "frame string, bit_idx bigint")
    got = {r["byte_idx"]: r["byte"] for r in pack.mask_bytes(cells, ["frame"]).collect()}
    assert got == {0: 0x81, 1: 0x80}
    packed = rows(spark, [("f", bytearray([0x81, 0x80]), bytearray([42, 84, 99]))], "frame string, bitmask binary, values binary")
    assert [(r["bit_idx"], r["q"]) for r in pack.unpack_cells(packed, ["frame"]).orderBy("bit_idx").collect()] == [(0, 42), (7, 84), (8, 99)]
    looked = packed.select(*[pack.value_at("bitmask", "values", F.lit(i)).alias(str(i)) for i in (0, 1, 7, 8, 15, 99)]).first()
    assert list(looked) == [42, 0, 84, 99, 0, 0]


@settings(max_examples=60, deadline=None)
@given(st.lists(st.integers(0, 255), min_size=1, max_size=400))
def test_pack_then_unpack(values):
    grid = np.array(values, "u1")
    mask, packed = _pack(grid)
    back = np.zeros(len(grid), "u1")
    back[np.flatnonzero(np.unpackbits(np.frombuffer(mask, "u1"))[: len(grid)])] = np.frombuffer(packed, "u1")
    assert (back == grid).all() and len(mask) == -(-len(grid) // 8)


@settings(max_examples=30, deadline=None)
@given(st.floats(-70, 70, width=32), st.floats(0.5, 300, width=32))
def test_codes_never_fall_as_raw_rises(offset, scale):
    table = code_table(8, offset, scale, None, -100.0, 100.0, False)[2:]
    assert (np.diff(table.astype(int)) >= 0).all()


def test_containers():
    head, text = w.volume_header(), b"\1" * 5000
    good = w.ldm(head, [text, text])
    assert containers.unpack_volume(good) == head + text + text
    assert containers.unpack_volume(good[:-30]) == head + text
    assert containers.unpack_volume(bz2.compress(text)) == text
    assert containers.unpack_volume(bz2.compress(text)[:-8]) is None
    assert containers.unpack_volume(head + bz2.compress(text)) == text
    assert containers.unpack_volume(head + text) == head + text
    assert containers.unpack_volume(head + text, strict=True) is None
    assert containers.unpack_volume(b"tiny") == b"tiny"
    assert containers.unpack_volume(b"") is None
    packed = containers.gzip_best(text)
    assert containers.gunzip(packed) == text and containers.gunzip(packed[:-9]) == b"" and containers.gunzip(b"junk") == b""
    assert containers.gzip_best(b"") == b"" and containers.gunzip(b"") == b""


def test_product_lookup_rules(spark):
    assert pr.moment_code("cross_correlation_ratio") == 6 and pr.moment_code("unheard") == 1 and pr.value_range("unheard") == (-32.0, 94.5)
    assert pr.product_dim(spark).count() == 7


@pytest.mark.parametrize("key,want", [("2026/02/13/KTLX/KTLX20260213_162244_V06", "20260213_162244")])
def test_object_keys(spark, key, want):
    k = F.col("k")
    r = rows(spark, [(key,)], "k string").select(t.object_timestamp(k), t.object_station(k), t.is_volume_key(k)).first()
    assert tuple(r) == (want, "KTLX", True)
