"""Volumes of a message or two: work per volume stays small, and results are those of dense grids."""

import numpy as np
import pyarrow as pa
import pytest
from polarscan.operators import framing, raster
from polarscan.queries import synth


def test_messages_of_many_volumes_leave_together():
    contents = [synth.content_of(u, synth.radials_of(np.arange(u, u + 2), np.arange(2))) for u in range(60)]
    batch = pa.RecordBatch.from_arrays([pa.array([str(u) for u in range(60)]), pa.array(contents, pa.binary())], names=["volume_id", "content"])
    out = list(framing._messages(iter([batch]), (), False))
    assert len(out) == 1 and out[0].num_rows == 120
    assert out[0].column("volume_id").to_pylist() == [str(u) for u in range(60) for _ in range(2)]
    assert out[0].column("msg_seq").to_pylist() == [0, 1] * 60


@pytest.mark.parametrize("rays, gates", [(360, 400), (720, 21), (360, 3)])
def test_few_gates_are_packed_like_many(rays, gates):
    draw = np.random.default_rng(rays * gates)
    for n in (0, 1, 7, rays * gates // raster.SPARSE, rays * gates):
        grid, wanted = raster._Grid(rays * gates), np.zeros(rays * gates, "u1")
        for part in np.array_split(draw.integers(0, rays * gates, n), 3):
            code = draw.integers(1, 256, len(part)).astype("u1")
            grid.add(part, code)
            np.maximum.at(wanted, part, code)
        assert (grid.dense is None) == (n <= rays * gates // raster.SPARSE)
        assert grid.packed() == (np.packbits(wanted).tobytes(), wanted[wanted > 0].tobytes())


def test_full_tilts_are_their_own_slabs(spark, sf_dir):
    from polarscan.plans import decode as d

    packs = d.decode(synth.volumes(spark, sf_dir), ["reflectivity"]).tilt_packs(raster.OFFLINE)
    rows = packs.collect()
    assert rows and all(r["num_rays"] == 720 and r["slab_mask"] is None for r in rows)
    joined = {}
    for r in sorted(rows, key=lambda r: r["tilt_idx"]):
        mask, values = joined.get(r["volume_id"], (b"", b""))
        joined[r["volume_id"]] = (mask + r["bitmask"], values + r["values"])
    whole = {r["volume_id"]: (bytes(r["bitmask"]), bytes(r["values"])) for r in raster.volume_packs(packs).collect()}
    assert whole == {v: x for v, x in joined.items() if x[1]}
