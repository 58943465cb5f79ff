"""Frames packed many at a time equal frames packed one by one."""

import numpy as np
import pyarrow as pa
import pytest
from polarscan.operators import pack, raster


def given(spark):
    draw = np.random.default_rng(12)
    moments, cuts = [], []
    for v in range(60):
        for product, spacing in (("reflectivity", 250.0), ("velocity", 300.0)):
            radials = int(draw.integers(0, 40)) if v != 7 else 900
            gates = int(draw.integers(1, 60))
            for sweep in range(3):
                rays = 720 if (v + sweep) % 3 == 0 else 360
                for tilt in {sweep, (sweep + v) % 3}:  # some sweeps feed two tilts
                    cuts.append((f"v{v}", product, sweep, tilt, float(tilt), 720 if (v + tilt) % 3 == 0 else 360, 40, 2000.0, 250.0))
            for r in range(radials):
                raw = draw.integers(0, 256, gates, dtype="u1") * (draw.random(gates) < 0.4)
                moments.append((f"v{v}", product, int(draw.integers(0, 3)), float(np.float32(draw.random() * 359)), gates, 8, 2.0, 66.0, 1800.0, spacing, bytearray(raw.astype("u1").tobytes())))
    m = spark.createDataFrame(moments, "volume_id string, product string, sweep_id int, azimuth float, num_gates int, word_size int, scale float, offset float, first_gate float, gate_spacing float, gates binary")
    c = spark.createDataFrame(sorted(set(cuts)), "volume_id string, product string, sweep_id int, tilt_idx int, tilt float, num_rays int, ngates int, first_gate float, gate_spacing float")
    return m, c


@pytest.mark.parametrize("slabs", [True, False])
def test_frames_at_once_equal_frames_one_by_one(spark, slabs, monkeypatch):
    m, c = given(spark)
    for profile in (raster.INGEST, raster.OFFLINE):
        got = sorted(map(tuple, raster.pack_tilts(m, c, profile, 2, slabs).collect()))
        with monkeypatch.context() as patch:
            patch.setattr(raster, "_slices", lambda batch: (batch.slice(i, 1) for i in range(batch.num_rows)))
            want = sorted(map(tuple, raster.pack_tilts(m, c, profile, 2, slabs).collect()))
        assert got == want and len(got) > 300 and any(r[7] for r in got)


def test_slices_are_bounded_by_rows_and_gates():
    batch = pa.RecordBatch.from_pydict({"num_gates": pa.array([5, None, raster.GATES_AT_ONCE, raster.GATES_AT_ONCE + 9, 1] + [1] * 5000, pa.int32())})
    parts = list(raster._slices(batch))
    assert sum(p.num_rows for p in parts) == batch.num_rows and [p.num_rows for p in parts[:4]] == [2, 1, 1, 2048]


def test_volumes_and_cells_of_many_packs(spark):
    """Volumes put together from their slabs' bytes, and cells of all packs of a batch, against one at a time in numpy."""
    draw = np.random.default_rng(3)
    rows, want, want_cells = [], [], set()
    for v in range(300):
        masks, codes = [], []
        for t in range(int(draw.integers(1, 5))):
            bits = draw.random(720 * 3) < (0.0 if v % 5 == 0 else 0.05)
            values = draw.integers(1, 256, int(bits.sum()), dtype="u1")
            masks.append(np.packbits(bits).tobytes()), codes.append(values.tobytes())
            own = (b"\x01", b"\x02") if t % 2 else (masks[-1], codes[-1])
            slab = (masks[-1], codes[-1]) if t % 2 else (None, None)
            rows.append((f"v{v}", "velocity", t, float(t), 3, *own, *slab))
        if any(codes):
            want.append((f"v{v}", "velocity", 720, 3, [float(t) for t in range(len(masks))], b"".join(masks), b"".join(codes)))
            at = np.flatnonzero(np.unpackbits(np.frombuffer(b"".join(masks), "u1")))
            want_cells |= {(f"v{v}", int(i), c) for i, c in zip(at, b"".join(codes))}
    names = "volume_id string, product string, tilt_idx int, tilt float, num_gates int, bitmask binary, values binary, slab_mask binary, slab_values binary"
    packs = spark.createDataFrame(rows, names).repartition(5)
    for parts in (1, 3):
        volumes = raster.volume_packs(packs, parts)
        assert sorted(tuple(bytes(x) if isinstance(x, bytearray) else x for x in r) for r in volumes.collect()) == sorted(want)
        assert {tuple(r) for r in pack.unpack_cells(volumes, ["volume_id"]).collect()} == want_cells


def test_slabs_of_a_volume_may_arrive_in_several_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "3")
    try:
        test_volumes_and_cells_of_many_packs(spark)
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
