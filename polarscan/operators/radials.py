"""Volumes to radials and data blocks, all radials of a batch at once; sweeps of streams with Spark expressions."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import from_arrow_type

from .. import products as pr
from ..functions import f32 as f
from ..sources.containers import HEADER_BYTES
from .framing import EAST, GENERIC_HEADER_BYTES, GENERIC_TYPE, HEADER_TYPE, LEGACY_ELEV_NUM, LEGACY_TYPE, LOWEST, MAX_BLOCKS, NEW_SWEEP_STATUSES, STEEPEST, WEST
from .framing import usable_radials

# Fixed values of the record layouts.
BLOCK_HEADER_BYTES, VOLUME_BLOCK_BYTES, RADIAL_BLOCK_BYTES, MOMENT_BLOCK_BYTES = 4, 44, 20, 28
LEGACY_DATA_AT = 46
ANGLE_STEP = 360.0 / 65536.0

BLOCK_BATCH_BYTES = 8 << 20
RANGE = 8192  # sequence numbers of a stream that one task orders


def angles_in_range(azimuth: Column, elevation: Column) -> Column:
    return (
        (azimuth >= f.f32(WEST)) & (azimuth <= f.f32(EAST)) & (elevation >= f.f32(LOWEST)) & (elevation <= f.f32(STEEPEST))
    )


def sweep_segments(rads: DataFrame) -> DataFrame:
    """Adds ``sweep_id``: a sweep starts at a start status, at a change of elevation number, or at the first radial.

    A legacy radial has no elevation number, so only status or being first starts a sweep there, and the number
    a following generic radial is compared with is the fixed legacy one. Feed narrow columns: the windows sort them.

    A volume's stream is cut into ranges of ``RANGE`` sequence numbers, so that an endless one spreads over many tasks. Each
    range is told the number that holds at its start and how many sweeps start before it; only these totals, one row a range,
    are ordered over a whole volume.
    """
    keys = ["volume_id", "_range"]
    stream = W.partitionBy(*keys).orderBy("msg_seq")
    totals = W.partitionBy("volume_id").orderBy("_range")
    earlier = totals.rowsBetween(W.unboundedPreceding, -1)
    legacy = F.col("msg_type") == 1 if "msg_type" in rads.columns else F.lit(False)
    starts = F.col("radial_status").isin(*NEW_SWEEP_STATUSES)
    number_after = F.when(~legacy, F.col("elev_num").cast("int")).when(starts, F.lit(LEGACY_ELEV_NUM))
    ranged = rads.withColumn("_range", F.floor(F.col("msg_seq") / RANGE)).withColumn("_after", number_after)

    # The first radial of a volume that opens with legacy ones leaves the legacy number too.
    left = F.max_by("_after", F.when(F.col("_after").isNotNull(), F.col("msg_seq")))
    opening = F.row_number().over(totals) == 1
    passed_on = F.coalesce("_left", F.when(F.col("_opening"), F.lit(LEGACY_ELEV_NUM)))
    told = (
        ranged.groupBy(*keys)
        .agg(left.alias("_left"))
        .withColumn("_opening", opening)
        .withColumn("_before", F.coalesce(F.last(passed_on, ignorenulls=True).over(earlier), F.lit(LEGACY_ELEV_NUM)))
        .select(*keys, "_opening", "_before")
    )
    current = F.coalesce(F.last("_after", ignorenulls=True).over(stream.rowsBetween(W.unboundedPreceding, -1)), F.col("_before"))
    started = starts | (F.col("_opening") & (F.row_number().over(stream) == 1))
    is_new = F.coalesce(started | (~legacy & (F.col("elev_num") != current)), F.lit(False)).cast("int")
    marked = ranged.join(told, keys).withColumn("_new", is_new)
    counts = marked.groupBy(*keys).agg(F.sum("_new").alias("_n"))
    offsets = counts.select(*keys, F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    running = F.sum("_new").over(stream.rowsBetween(W.unboundedPreceding, 0)) + F.col("_offset") - 1
    return marked.join(offsets, keys).select(*rads.columns, running.cast("int").alias("sweep_id"))


RADIAL_COLUMNS = ["volume_id", "msg_seq", "sweep_id", "msg_type", "azimuth", "elevation", "radial_status", "elev_num"]
_BLOCKS = pa.schema(
    [("volume_id", pa.string()), ("msg_seq", pa.int32()), ("sweep_id", pa.int32()), ("msg_type", pa.int32()), ("azimuth", pa.float32())]
    + [("elevation", pa.float32()), ("radial_status", pa.int32()), ("elev_num", pa.int32()), ("head", pa.binary()), ("leads", pa.bool_())]
    + [("block_no", pa.int32()), ("kind", pa.string()), ("name", pa.string()), ("lat", pa.float64()), ("lon", pa.float64())]
    + [(c, pa.float32()) for c in ("height_asl", "sys_diff_refl", "sys_diff_phase")]
    + [("vcp", pa.int32()), ("nyquist", pa.float32()), ("unambiguous_range", pa.float32()), ("num_gates", pa.int32())]
    + [("first_gate", pa.float32()), ("gate_spacing", pa.float32()), ("word", pa.int32()), ("scale", pa.float32()), ("offset", pa.float32())]
    + [("gate_bytes", pa.int32()), ("gates", pa.binary())]
)
_PAD = bytes(128)  # fields are read before it is known whether they are there


def _code(name: bytes) -> int | None:
    return next((code for _, code, prefix, _, _ in pr.PRODUCTS if name.decode("latin-1").startswith(prefix)), None)


def _block_batch(rows: list[tuple], codes: list[int], gates: bool) -> pa.RecordBatch:
    """Rows (volume, sequence, sweep, type, payload) of usable radials and volume headers to rows of blocks. All radials of the
    batch at once: a field is gathered from one buffer at the positions of all blocks."""
    ids, seqs, sweeps, types, payloads = zip(*rows)
    size = np.fromiter(map(len, payloads), np.int64, len(rows))
    begin = np.cumsum(size) - size
    text = b"".join(payloads) + _PAD
    data = np.frombuffer(text, np.uint8)

    def u8(at):
        return data[at].astype(np.int64)

    def u16(at):
        return u8(at) << 8 | u8(at + 1)

    def u32(at):
        return u16(at) << 16 | u16(at + 2)

    def f32(at):
        return u32(at).astype(np.uint32).view(np.float32)

    kind = np.array(types)
    legacy, generic = kind == LEGACY_TYPE, kind == GENERIC_TYPE
    step = np.float32(ANGLE_STEP)
    radial = {
        "azimuth": np.where(legacy, u16(begin + 8).astype(np.float32) * step, f32(begin + 12)),
        "elevation": np.where(legacy, u16(begin + 16).astype(np.float32) * step, f32(begin + 24)),
        "radial_status": np.where(legacy, u8(begin + 1), u8(begin + 21)),
        "elev_num": np.where(legacy, LEGACY_ELEV_NUM, u8(begin + 22)),
    }

    # Usable pointers of the generic radials; a legacy payload is one block; a radial without any keeps one row.
    numbers = np.arange(MAX_BLOCKS)
    own = np.flatnonzero(generic)
    pointer = u32(begin[own, None] + GENERIC_HEADER_BYTES - 4 * MAX_BLOCKS + 4 * numbers)
    usable = (numbers < u16(begin[own] + 30)[:, None]) & (pointer != 0) & (pointer + BLOCK_HEADER_BYTES <= size[own, None])
    which, number = np.nonzero(usable)
    old_rows = np.flatnonzero(legacy)
    bare = np.setdiff1d(np.arange(len(rows)), np.r_[own[which], old_rows])
    row = np.r_[own[which], old_rows, bare]
    number = np.r_[number, np.zeros(len(old_rows) + len(bare), np.int64)]
    at = np.r_[pointer[usable], np.zeros(len(old_rows), np.int64), np.full(len(bare), -1)]
    order = np.lexsort((number, row))
    row, number, at = row[order], number[order], at[order]
    leads = np.r_[True, row[1:] != row[:-1]]

    there, base = at >= 0, begin[row] + np.maximum(at, 0)
    room = np.where(there, size[row] - at, 0)
    is_old = there & legacy[row]
    tag = np.where(is_old, int.from_bytes(b"LREF"), u32(base))
    tags, tag_at = np.unique(tag, return_inverse=True)
    spelt = [int(x).to_bytes(4) for x in tags]
    tag_code = [_code(x[1:]) for x in spelt]
    wanted = np.array([x in codes for x in tag_code])[tag_at]
    first, rest = tag >> 24, tag & 0xFFFFFF
    vol, rad = (int.from_bytes(x) for x in (b"VOL", b"RAD"))
    new = there & ~is_old
    named = new & (first != ord("L"))
    site = named & (rest == vol) & (room >= VOLUME_BLOCK_BYTES)
    span = named & (rest == rad) & (room >= RADIAL_BLOCK_BYTES)
    old = is_old & (room >= LEGACY_DATA_AT)
    moment = new & (first == ord("D")) & (rest != vol) & (rest != rad) & (room >= MOMENT_BLOCK_BYTES)
    kept = np.flatnonzero(leads | ~moment | wanted)

    def single(x):
        return x.astype(np.float32)

    with np.errstate(all="ignore"):
        height = single((u16(base + 16) ^ 0x8000) - 0x8000) + single(u16(base + 18))
        nyquist = np.where(span, single(u16(base + 16)) * np.float32(0.01), single(u16(base + 28)) * np.float32(0.1))
        reach = single(np.where(span, u16(base + 6), u16(base + 26))) * np.float32(100.0)
    with_data = (new & (first == ord("D")) & wanted & (room >= MOMENT_BLOCK_BYTES)) | is_old
    asked = np.where(is_old, u16(base + 24), u16(base + 8) * np.where(u8(base + 19) == 16, 2, 1))
    skipped = np.where(is_old, LEGACY_DATA_AT, MOMENT_BLOCK_BYTES)
    length = np.clip(asked, 0, np.maximum(room - skipped, 0))
    given, radials_there = moment | old, kind[row] != HEADER_TYPE
    columns = {
        **{c: (v[row], radials_there) for c, v in radial.items()},
        "msg_seq": (np.array(seqs)[row], None),
        "sweep_id": (np.array([-1 if x is None else x for x in sweeps])[row], radials_there),
        "msg_type": (kind[row], None),
        "leads": (leads, None),
        "block_no": (number, there),
        "lat": (f32(base + 8), site),
        "lon": (f32(base + 12), site),
        "height_asl": (height, site),
        "sys_diff_refl": (f32(base + 32), site),
        "sys_diff_phase": (f32(base + 36), site),
        "vcp": (u16(base + 40), site),
        "nyquist": (nyquist, span | old),
        "unambiguous_range": (reach, span | old),
        "num_gates": (np.where(is_old, u16(base + 24), u16(base + 8)), given),
        "first_gate": (np.where(is_old, u16(base + 20), u16(base + 10)), given),
        "gate_spacing": (np.where(is_old, u16(base + 22), u16(base + 12)), given),
        "word": (np.where(is_old, 8, u16(base + 18)), given),
        "scale": (np.where(is_old, np.float32(2.0), f32(base + 20)), given),
        "offset": (np.where(is_old, np.float32(66.0), f32(base + 24)), given),
        "gate_bytes": (length, with_data),
    }
    volumes = pa.array(ids, pa.string())
    low = base + skipped
    arrays = []
    for field in _BLOCKS if gates else list(_BLOCKS)[:-1]:
        if field.name in columns:
            values, valid = columns[field.name]
            with np.errstate(invalid="ignore"):  # signalling NaN in a field
                values = values[kept].astype(field.type.to_pandas_dtype(), copy=False)
            arrays.append(pa.array(values, field.type, mask=None if valid is None else ~valid[kept], from_pandas=False))
        elif field.name == "volume_id":
            arrays.append(volumes.take(pa.array(row[kept])))
        elif field.name == "head":
            arrays.append(pa.array([payloads[i] if types[i] == HEADER_TYPE else None for i in row[kept].tolist()], pa.binary()))
        elif field.name in ("kind", "name"):
            cut = slice(0, 1) if field.name == "kind" else slice(1, 4)
            words = pa.array([x[cut].decode("latin-1") for x in spelt], pa.string())
            arrays.append(words.take(pa.array(tag_at.reshape(-1)[kept], mask=~there[kept])))
        else:
            spans = zip(with_data[kept].tolist(), low[kept].tolist(), (low + length)[kept].tolist())
            arrays.append(pa.array([text[i:j] if x else None for x, i, j in spans], pa.binary()))
    return pa.RecordBatch.from_arrays(arrays, names=_BLOCKS.names[: len(arrays)])


def block_rows(volumes: DataFrame, codes: list[int], gates: bool = True, strict: bool = False) -> DataFrame:
    """One row per block with its fields in typed columns, null where another kind of block has them.

    A radial without blocks, and a volume header, keep one row. The first row of a radial has ``leads`` set, so radials
    can be read from here without the rest: in columnar storage every later step reads just its columns. Left out are moments
    of other ``codes``, but for the row that leads a radial, and on request all gates.
    """
    fields = list(_BLOCKS) if gates else list(_BLOCKS)[:-1]
    schema = T.StructType([T.StructField(x.name, from_arrow_type(x.type)) for x in fields])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for volume_id, blob in zip(batch.column(0), batch.column(1)):
                name, blob = volume_id.as_py(), blob.as_py()
                if blob is None or len(blob) < HEADER_BYTES:
                    continue
                rows.append((name, -1, None, HEADER_TYPE, blob[:HEADER_BYTES]))
                for seq, sweep, kind, payload in usable_radials(blob, strict):
                    rows.append((name, seq, sweep, kind, payload))
                    size += len(payload) + 64
                    if size >= BLOCK_BATCH_BYTES:
                        yield _block_batch(rows, codes, gates)
                        rows, size = [], 0
            if rows:
                yield _block_batch(rows, codes, gates)

    return volumes.select("volume_id", "content").mapInArrow(run, schema)


def radials_of(rows: DataFrame) -> DataFrame:
    return rows.where((F.col("msg_type") != 0) & F.col("leads")).select(*RADIAL_COLUMNS)


def site_blocks(rows: DataFrame) -> DataFrame:
    """Volume blocks: location, height, coverage pattern and dual-polarization offsets."""
    fields = ["lat", "lon", "height_asl", "sys_diff_refl", "sys_diff_phase", "vcp"]
    return rows.where(F.col("vcp").isNotNull()).select("volume_id", "msg_seq", "block_no", *fields)


def range_blocks(rows: DataFrame) -> DataFrame:
    """Nyquist velocity (m/s) and unambiguous range (m) of radial blocks and legacy radials; zero means "not given"."""
    given = rows.where(F.col("nyquist").isNotNull())
    return given.select("volume_id", "sweep_id", "msg_seq", "block_no", "msg_type", "nyquist", "unambiguous_range")


def moment_blocks(rows: DataFrame, low_byte_word_size: bool = False) -> DataFrame:
    """Moments that pass the checks, one row each, gates still packed. Legacy reflectivity is (raw - 66) / 2.

    ``low_byte_word_size`` reads only the low byte of the word size, for writers that use the high byte otherwise.
    """
    word = F.col("word") % 256 if low_byte_word_size else F.col("word")
    sized = rows.where(F.col("num_gates") > 0).withColumn("word_size", F.when(word == 0, F.lit(8)).otherwise(word))
    usable = (
        (F.col("gate_spacing") != 0)
        & F.col("word_size").isin(8, 16)
        & (F.col("scale") != 0)
        & ~F.isnan("scale")
    )
    complete = F.col("gate_bytes") >= F.col("num_gates") * F.col("word_size") / 8
    kept = sized.where(((F.col("msg_type") == 1) | usable) & complete)
    fields = ["num_gates", "first_gate", "gate_spacing", "word_size", "scale", "offset", *(c for c in ("gates",) if c in rows.columns)]
    return kept.select("volume_id", "sweep_id", "msg_seq", "msg_type", "block_no", "azimuth", "name", *fields)
