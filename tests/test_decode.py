"""Synthetic volumes through the Spark decode, compared with the sequential model."""

import struct

import numpy as np
import pytest
import volume_writer as w
from model import Model

from polarscan.operators import framing, metadata, radials, raster
from polarscan.plans.decode import decode, frame_files
from polarscan.products import ALL_PRODUCTS
from polarscan.sources.containers import unpack_volume

RNG = np.random.default_rng(7)


def gates(n, low=0, high=200):
    g = RNG.integers(low, high, n)
    return [int(x) for x in np.where(RNG.random(n) < 0.5, 0, g)]


def all_moments(_=0):
    return [
        w.vol_block(),
        w.rad_block(),
        w.moment_block(b"VEL", gates(40), scale=2.0, offset=129.0),
        w.moment_block(b"SW ", gates(40), scale=2.0, offset=129.0),
        w.moment_block(b"ZDR", gates(40), scale=16.0, offset=128.0),
        w.moment_block(b"PHI", gates(40, 0, 1000), word=16, scale=2.8361, offset=2.0),
        w.moment_block(b"RHO", gates(40), scale=300.0, offset=-60.5),
    ]


def split_message(payload, parts, seq):
    size = -(-len(payload) // parts)
    size += size % 2
    pieces = [payload[i : i + size] for i in range(0, len(payload), size)]
    return [w.message(31, piece.ljust(496, b"\0") if len(piece) < 496 else piece, seq, len(pieces), i + 1) for i, piece in enumerate(pieces)]


def build_cases():
    ref = lambda n=60: (lambda i: gates(n))
    cases = {}
    cases["minimal"] = w.sweep31(0.5, 4, ref(16), 3)
    cases["multi"] = [m for s, e in enumerate((0.5, 1.5, 2.4)) for m in w.sweep31(e, 12, ref(), 0, s + 1, all_moments)]
    cases["split_cut"] = w.sweep31(0.5, 360, ref(12), 3, 1) + w.sweep31(0.5, 360, ref(12), 0, 2)
    cases["close_tilts"] = [m for s, e in enumerate((0.480, 0.488, 0.48, 0.53)) for m in w.sweep31(e, 8, ref(), 0, s + 1)]
    body = w.radial31(10.0, 0.5, [w.moment_block(b"REF", [i % 200 for i in range(1500)])], 0)
    parts = split_message(body, 3, 77)
    again = w.message(31, b"\x09" * 600, 77, 3, 2)
    cases["segmented"] = [parts[2], parts[1], again, parts[0]] + w.sweep31(0.5, 3, ref(), 1)
    noisy = w.sweep31(0.5, 5, ref(), 0)
    cases["noise"] = [b"\0" * 900, w.slot(2, b"\1" * 600), noisy[0], b"\xff" * 333, noisy[1], b"\xee" * 5000, noisy[2], b"\0" * 12 + noisy[3]]
    bad = [
        w.radial31(1.0, 0.5, [w.moment_block(b"REF", gates(30))], 0, pointers=[0]),
        w.radial31(2.0, 0.5, [w.moment_block(b"REF", gates(30))], pointers=[90000]),
        w.radial31(3.0, 0.5, [w.moment_block(b"REF", gates(30))], count=0),
        w.radial31(4.0, 0.5, [w.moment_block(b"REF", gates(30))], count=11),
        w.radial31(5.0, 0.5, [w.moment_block(b"REF", gates(30), ng=8001)]),
        w.radial31(6.0, 0.5, [w.moment_block(b"REF", gates(30), word=12)]),
        w.radial31(7.0, 0.5, [w.moment_block(b"REF", gates(30), scale=0.0)]),
        w.radial31(400.0, 0.5, [w.moment_block(b"REF", gates(30))]),
        w.radial31(8.0, 95.0, [w.moment_block(b"REF", gates(30))]),
        w.radial31(-0.05, 0.5, [w.moment_block(b"REF", gates(30))]),
        w.radial31(359.99, 0.5, [w.moment_block(b"REF", gates(30), word=0)]),
    ]
    cases["corrupt"] = [w.message(31, b, i) for i, b in enumerate(bad)]
    cases["legacy"] = [w.slot(1, w.radial1(i * 3.0, 0.5 + i // 10, gates(460), 0 if i % 10 == 0 else 1)) for i in range(20)]
    cases["mixed_gates"] = w.sweep31(0.5, 6, ref(20)) + [
        w.message(31, radial) for radial in (w.radial31(i * 60.0, 1.5, [w.moment_block(b"REF", gates(50), 1000, 500)], 0 if i == 0 else 1, 2) for i in range(6))
    ]
    cases["mixed_types"] = [
        w.message(31, w.radial31(i * 10.0, 0.5, [w.moment_block(b"REF", gates(30))], 1, 1)) if i % 3 else w.slot(1, w.radial1(i * 10.0, 0.6, gates(30)))
        for i in range(12)
    ]
    return cases


CASES = build_cases()


def container(i, name, messages):
    head, body = w.volume_header(), b"".join(messages)
    if i % 3 == 0:
        cut = len(messages) // 2
        return w.ldm(head, [b"".join(messages[:cut]) or b"\0", b"".join(messages[cut:])])
    if i % 3 == 1:
        import bz2

        return head + bz2.compress(head + body)
    return head + body


BLOBS = {name: container(i, name, msgs) for i, (name, msgs) in enumerate(CASES.items())}


def model_of(blob):
    model = Model(ALL_PRODUCTS)
    for seq, row in enumerate(framing.messages_of(unpack_volume(blob))):
        if row[-1] is not None:
            model.add(seq, row[-2], row[-1])
    return model


@pytest.fixture(scope="module")
def models():
    return {name: model_of(blob) for name, blob in BLOBS.items()}


@pytest.fixture(scope="module")
def decoded(spark):
    rows = [(name, name, "HINT", "20260101_000000", bytearray(blob)) for name, blob in BLOBS.items()]
    schema = "volume_id string, path string, station string, ts_key string, content binary"
    return decode(spark.createDataFrame(rows, schema))


def test_framing_finds_every_radial():
    for name, count in (("minimal", 4), ("multi", 36), ("split_cut", 720), ("segmented", 7), ("legacy", 20)):
        assert len(list(framing.messages_of(unpack_volume(BLOBS[name])))) == count, name


def test_framing_skips_noise():
    found = [r[-1] for r in framing.messages_of(unpack_volume(BLOBS["noise"])) if r[-2] == 31]
    assert [p for p in found if p is not None] == [m[16:] for m in w_messages("noise")]


def w_messages(name):
    return [m.lstrip(b"\0") for m in CASES[name] if len(m) > 400 and m.lstrip(b"\0")[3:4] == b"\x1f"]


def test_segments_first_copy_wins_and_order():
    rows = [r for r in framing.messages_of(unpack_volume(BLOBS["segmented"])) if r[-1] is not None]
    assert struct.unpack_from(">f", rows[0][-1], 12)[0] == 10.0
    assert b"\x09" * 50 not in rows[0][-1]


def test_inconsistent_segment_counts_are_refused():
    s = framing._Segments()
    assert s.add(5, 31, 3, 1, b"a") is None
    assert s.add(5, 31, 2, 2, b"b") is None
    assert s.add(5, 31, 3, 2, b"b") is None
    assert s.add(5, 31, 3, 3, b"c") == (31, b"abc")
    assert s.add(5, 31, 2001, 1, b"x") is None
    assert s.add(5, 31, 3, 4, b"x") is None


def test_bins_equal_the_model(decoded, models):
    got = {}
    for r in decoded.bins().collect():
        got.setdefault(r["volume_id"], []).append(tuple(r[1:]))
    for name, model in models.items():
        want = sorted((b[0], b[1], b[2], b[3], float(b[4]), float(b[5]), float(b[6])) for b in model.bins)
        assert sorted(got.get(name, [])) == want, name


def test_sweeps_equal_the_model(decoded, models):
    got = {}
    for r in decoded.sweeps.orderBy("sweep_id").collect():
        got.setdefault(r["volume_id"], []).append((r["elevation_deg"], r["elev_num"], r["ray_count"]))
    for name, model in models.items():
        assert got.get(name, []) == [(float(s["elevation"]), s["elev_num"], s["rays"]) for s in model.sweeps], name


def test_frames_equal_the_model(decoded, models):
    rows = {(r["volume_id"], r["product"]): r for r in decoded.frames.collect()}
    assert len(rows) == len(models) * 6
    for name, model in models.items():
        for product in ALL_PRODUCTS:
            r = rows[name, product]
            n, first, spacing = model.geometry.get(product, (0, 0, 0))
            assert (r["ngates"], r["first_gate"], r["gate_spacing"]) == (n, float(first), float(spacing)), (name, product)
            assert (r["nrays"], r["nsweeps"]) == (model.count, len(model.sweeps))
            assert r["available_tilts"] == [float(t) for t in model.tilts()]
            last, best = model.span[product]
            assert (r["unambiguous_range"], r["max_range"]) == (last or 230000.0, best or 230000.0), (name, product)
            if model.site:
                assert r["vcp"] == model.site[5] and r["height_asl"] == model.site[2]
            assert (r["station"], r["timestamp"]) == ("KTLX", "20260212_162244")


def test_packed_grids_equal_the_model(decoded, models):
    packs = {(r["volume_id"], r["product"], r["tilt_idx"]): r for r in decoded.tilt_packs().collect()}
    volumes = {(r["volume_id"], r["product"]): r for r in raster.volume_packs(decoded.tilt_packs()).collect()}
    seen = 0
    for name, model in models.items():
        for product in ALL_PRODUCTS:
            grids = model.grids(product)
            if grids is None:
                assert (name, product, 0) not in packs
                continue
            for t, grid in enumerate(grids[0]):
                r = packs[name, product, t]
                assert r["num_rays"] == grid.shape[0]
                assert bytes(r["bitmask"]) == np.packbits(grid.reshape(-1) > 0).tobytes(), (name, product, t)
                assert bytes(r["values"]) == grid[grid > 0].tobytes()
                seen += 1
            flat = grids[1].reshape(-1)
            if flat.any():
                assert bytes(volumes[name, product]["bitmask"]) == np.packbits(flat > 0).tobytes()
                assert bytes(volumes[name, product]["values"]) == flat[flat > 0].tobytes()
            else:
                assert (name, product) not in volumes
    assert seen == len(packs)


def test_cells_from_bins_equal_packed(decoded, models):
    cells = {}
    for r in raster.cells_2d(decoded.bins(), decoded.cuts()).collect():
        cells.setdefault((r["volume_id"], r["product"], r["tilt_idx"]), {})[r["ray"], r["gate"]] = r["q"]
    for name, model in models.items():
        for product in ALL_PRODUCTS:
            for t, grid in enumerate((model.grids(product) or ([],))[0]):
                want = {(int(r), int(g)): int(grid[r, g]) for r, g in zip(*np.nonzero(grid))}
                assert cells.get((name, product, t), {}) == want


def test_nyquist_last_wins(decoded):
    rows = metadata.sweep_nyquist(decoded.ranges, decoded.sweeps).where("volume_id = 'multi'").collect()
    assert len(rows) == 3 and all(abs(r["nyquist_all"] - 26.0) < 1e-5 for r in rows)


def test_close_tilts_share_a_file_name(decoded):
    from polarscan.sources import rda

    rows = rda.one_per_path(frame_files(decoded, save_volumes=False)).where("product = 'reflectivity'")
    names = [r["filename"] for r in rda.tilt_files(decoded.tilt_packs().where("volume_id = 'close_tilts'"), decoded.frames).collect()]
    assert names.count("0.5.RDA") == 3
    assert rows.where("filename = '0.5.RDA'").count() == 1


def test_lazy_decode_gives_the_same_sweeps(spark, decoded):
    rows = [("multi", "p", "S", "t", bytearray(BLOBS["multi"]))]
    df = spark.createDataFrame(rows, "volume_id string, path string, station string, ts_key string, content binary")
    lazy = decode(df, ["reflectivity"], write_radials=False)
    cols = ["sweep_id", "elevation_deg", "ray_count"]
    want = decoded.sweeps.where("volume_id = 'multi'").select(*cols).orderBy("sweep_id").collect()
    assert lazy.sweeps.select(*cols).orderBy("sweep_id").collect() == want


def test_unreadable_volumes_keep_their_frames(spark):
    rows = [("short", "p", "S", "t", bytearray(b"AR2V")), ("junk", "p", "S", "t", bytearray(w.volume_header(magic=b"XXXX0006.") + b"\1" * 500))]
    df = spark.createDataFrame(rows, "volume_id string, path string, station string, ts_key string, content binary")
    got = decode(df, ["reflectivity"]).frames.collect()
    assert [(r["volume_id"], r["nsweeps"], r["elevation_deg"]) for r in got] == [("junk", 0, 999.0)]


def test_packing_plan_has_one_wide_exchange(decoded):
    plan = decoded.tilt_packs()._jdf.queryExecution().explainString(
        decoded.frames.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    )
    assert "REPARTITION_BY_NUM" in plan
    top = plan.split("SortMergeJoin")[0]
    assert "Exchange" not in top, "grouping must reuse the join's partitioning"
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_radials_module_constants():
    assert radials.NEW_SWEEP_STATUSES == (0, 3, 5)
