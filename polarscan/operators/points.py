"""Bins to points in space, and their compact encoding."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import bytes_be as b
from ..functions import geometry as g

NO_DATA_AT_OR_BELOW = -100.0


def sited(radials: DataFrame, sweeps: DataFrame, frames: DataFrame) -> DataFrame:
    """Radials with their sweep's elevation and their site's height. Both are joined on one exchange by volume, with gates still packed."""
    cut = sweeps.select("volume_id", "sweep_id", "elevation_deg")
    site = frames.select("volume_id", "product", "height_asl")
    return radials.repartition("volume_id").join(cut, ["volume_id", "sweep_id"]).join(site, ["volume_id", "product"])


def positions(bins: DataFrame, sweeps: DataFrame | None = None, frames: DataFrame | None = None) -> DataFrame:
    """(x, y, z, value) per bin, in metres from the radar and in double precision. Points keep their bin's order columns. Without
    ``sweeps`` and ``frames`` bins carry the elevation and height of their radial."""
    joined = bins.where(F.col("value") > NO_DATA_AT_OR_BELOW)
    if sweeps is not None:
        joined = joined.join(sweeps.select("volume_id", "sweep_id", "elevation_deg"), ["volume_id", "sweep_id"])
    if frames is not None:
        joined = joined.join(frames.select("volume_id", "product", "height_asl"), ["volume_id", "product"])
    r, az, el, h = F.col("range_m"), F.col("azimuth"), F.col("elevation_deg"), F.col("height_asl")
    return joined.select(
        "volume_id",
        "product",
        "sweep_id",
        "msg_seq",
        "gate",
        g.beam_x(r, az, el, h).alias("x"),
        g.beam_y(r, az, el, h).alias("y"),
        g.beam_z(r, el, h).alias("z"),
        "value",
    )


def to_points3d(bins: DataFrame, sweeps: DataFrame | None = None, frames: DataFrame | None = None) -> DataFrame:
    """``positions`` in single precision, the form in which points are encoded."""
    return positions(bins, sweeps, frames).withColumns({c: F.col(c).cast("float") for c in "xyz"})


_RUNS = pa.schema([("volume_id", pa.string()), ("product", pa.string()), ("sweep_id", pa.int32()), ("msg_seq", pa.int32()), ("gates", pa.binary()), ("points", pa.binary())])
_ENCODED = pa.schema([("volume_id", pa.string()), ("product", pa.string()), ("points", pa.binary())])
ENCODED_BYTES = 4 << 20  # of frames that leave together, but for a single larger one


def _pieces(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """One binary value from each end to the next."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer((ends * data.itemsize).astype("i4").tobytes()), pa.py_buffer(data.tobytes())])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Points that arrive one after the other from one radial become a row of half-precision quadruples and their gates."""
    for batch in batches:
        if not batch.num_rows:
            continue
        changed = np.zeros(batch.num_rows, bool)
        changed[0] = True
        for name in _RUNS.names[:4]:
            codes = batch.column(name).dictionary_encode().indices.to_numpy(zero_copy_only=False)
            changed[1:] |= codes[1:] != codes[:-1]
        starts = np.flatnonzero(changed)
        ends = np.r_[starts, batch.num_rows]
        four = np.stack([batch.column(c).to_numpy(zero_copy_only=False).astype("f4") for c in ("x", "y", "z", "value")], axis=1)
        quads = b.halves(four).reshape(four.shape).view("<u8").reshape(-1)
        keys = batch.select(_RUNS.names[:4]).take(pa.array(starts)).columns
        yield pa.RecordBatch.from_arrays([*keys, _pieces(batch.column("gate").to_numpy().astype("<i4"), ends), _pieces(quads, ends)], schema=_RUNS)


def _frame_points(held: list[pa.RecordBatch]) -> bytes:
    """Points of one frame in stream order; those of one gate by their bytes."""
    runs = pa.Table.from_batches(held).combine_chunks()
    gate, quads = (np.frombuffer(b"".join(runs.column(c).to_pylist()), kind) for c, kind in (("gates", "<i4"), ("points", ">u8")))
    sizes = pc.binary_length(runs.column("gates")).to_numpy() // 4
    sweep, seq = (np.repeat(runs.column(c).to_numpy(), sizes) for c in ("sweep_id", "msg_seq"))
    return quads[np.lexsort((quads, gate, seq, sweep))].tobytes()


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of runs arrive frame by frame; one row a frame leaves."""
    held, key, out, size = [], None, [], 0

    def leaving() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _ENCODED)], schema=_ENCODED)

    for batch in batches:
        ids, kinds = batch.column("volume_id").to_pylist(), batch.column("product").to_pylist()
        names = list(zip(ids, kinds))
        starts = [i for i in range(len(names)) if i == 0 or names[i] != names[i - 1]]
        for low, high in zip(starts, [*starts[1:], len(names)]):
            if key is not None and key != names[low]:
                out.append((*key, _frame_points(held)))
                held, size = [], size + len(out[-1][2])
                if size >= ENCODED_BYTES:
                    yield leaving()
                    out, size = [], 0
            key = names[low]
            held.append(batch.slice(low, high - low))
    if key is not None:
        out.append((*key, _frame_points(held)))
        yield leaving()


def encode_points_f16(points: DataFrame) -> DataFrame:
    """Base64 of each frame's points as half-precision quadruples, in stream order.

    Points of a radial are joined before the only exchange, so a point is shuffled as its 8 bytes and its gate; a frame belongs to
    one input object and is put in order by one task.
    """
    runs = points.select(*_RUNS.names[:4], "gate", "x", "y", "z", "value").mapInArrow(_runs, "volume_id string, product string, sweep_id int, msg_seq int, gates binary, points binary")
    # work per row and not per byte, so parts are not left to coalescing by size
    parts = int(points.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    frames = runs.repartition(parts, "volume_id", "product").sortWithinPartitions("volume_id", "product", "sweep_id", "msg_seq")
    whole = frames.mapInArrow(_joined, "volume_id string, product string, points binary")
    return whole.select("volume_id", "product", b.base64_plain(F.col("points")).alias("encoded"))
