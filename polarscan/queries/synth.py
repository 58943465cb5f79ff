"""Binary volumes written by Spark from the events table, so that decode queries work on data that grows with it.

A volume is one user's events within a block of 65536 event ids, so a busy user spreads over many volumes, each well
below the message limit of framing. Spark partitions and orders the events; a task fills the messages of many volumes at
once as an array of fixed-size records and compresses them.
"""

from __future__ import annotations

import bz2
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import timekeys as t
from ..session import scratch_path
from . import mapping as m

BLOCK_IDS = 65536
RECORD_RADIALS = 8
EVENTS_PER_TASK = 1 << 17
MESSAGES_AT_ONCE = 4096
GATES, STRIDE = 400, 50
VEL_GATES = 20
FIRST_GATE, SPACING = 2125, 250
JULIAN, MS = 19724, 3723000

# Elevations in 64ths of a degree by cut number; cut = block of 512 event ids.
CUT_64THS = [32, 57, 83, 115, 154]
CUT_IDS = 512


def _moment(prefix: str, gates: tuple) -> list[tuple]:
    fields = [("name", "S4"), ("_", "V4"), ("gates", ">u2"), ("first", ">u2"), ("spacing", ">u2"), ("_2", "V4"), ("word", ">u2"), ("scale", ">f4"), ("offset", ">f4")]
    return [(prefix + f, kind) for f, kind in fields] + [(f"{prefix}data", *gates)]


# One type-31 message: header, volume, radial and reflectivity block, room for a 16-bit velocity block.
RADIAL = np.dtype(
    [("halves", ">u2"), ("channel", "u1"), ("type", "u1"), ("sequence", ">u2"), ("julian", ">u2"), ("ms", ">u4"), ("segments", ">u2"), ("segment", ">u2")]
    + [("site", "S4"), ("at", ">u4"), ("day", ">u2"), ("number", ">u2"), ("azimuth", ">f4"), ("_a", "V2"), ("size", ">u2"), ("spacing", "u1"), ("status", "u1")]
    + [("elev_num", "u1"), ("_b", "u1"), ("elevation", ">f4"), ("_c", "V2"), ("blocks", ">u2"), ("pointers", ">u4", 10)]
    + [("vol", "S4"), ("vol_size", ">u2"), ("version", ">u2"), ("lat", ">f4"), ("lon", ">f4"), ("height", ">u2"), ("feed", ">u2"), ("_d", "V12")]
    + [("diff_refl", ">f4"), ("diff_phase", ">f4"), ("vcp", ">u2"), ("_e", "V2")]
    + [("rad", "S4"), ("rad_size", ">u2"), ("range", ">u2"), ("_f", "V8"), ("nyquist", ">u2"), ("_g", "V2")]
    + _moment("ref_", ("u1", GATES))
    + _moment("vel_", (">u2", VEL_GATES))
)
MESSAGE_HEADER = 16


def ref_raw(event_id, gate):
    """Raw reflectivity of the gates that carry data."""
    return (event_id * 7 + gate * 13) % 256


def vel_raw(event_id, gate):
    return (event_id * 31 + gate * 101) % 1000


def radials_of(e: np.ndarray, k: np.ndarray) -> np.ndarray:
    """One message per event; every second one also has velocities."""
    out = np.zeros(len(e), RADIAL)
    size = RADIAL.itemsize - MESSAGE_HEADER
    cut = e // CUT_IDS % len(CUT_64THS)
    at = [RADIAL.fields[x][1] - MESSAGE_HEADER for x in ("vol", "rad", "ref_name", "vel_name")]
    odd = np.flatnonzero(e % 2 == 1)
    same = {
        "halves": RADIAL.itemsize // 2, "type": 31, "julian": JULIAN, "ms": MS, "segments": 1, "segment": 1, "site": b"KTLX", "at": MS, "day": JULIAN,
        "number": 1, "size": size, "spacing": 1, "blocks": 4, "vol": b"RVOL", "vol_size": 44, "version": 0x0100, "lat": 35.5, "lon": 97.5, "diff_phase": 60.0,
        "rad": b"RRAD", "rad_size": 20, "ref_name": b"DREF", "ref_gates": GATES, "ref_first": FIRST_GATE, "ref_spacing": SPACING, "ref_word": 8,
        "ref_scale": 2.0, "ref_offset": 66.0,
    }
    own = {
        "sequence": e % 65536, "azimuth": e * 37 % 2880 / 8, "status": e % 29 != 0, "elev_num": cut + 1, "elevation": np.array(CUT_64THS)[cut] / 64,
        "height": 370, "feed": k, "diff_refl": k / 8, "vcp": 200 + k, "range": k % 3 * k, "nyquist": k % 4 * 100,
    }
    for name, value in {**same, **own}.items():
        out[name] = value
    out["pointers"][:, :3] = at[:3]
    out["pointers"][odd, 3] = at[3]
    gate = (e % STRIDE)[:, None] + np.arange(0, GATES, STRIDE)
    out["ref_data"][np.arange(len(e))[:, None], gate] = ref_raw(e[:, None], gate)
    velocity = {"name": b"DVEL", "gates": VEL_GATES, "first": FIRST_GATE, "spacing": SPACING, "word": 16, "scale": 2.0, "offset": 129.0}
    for name, value in {**velocity, "data": vel_raw(e[odd, None], np.arange(VEL_GATES))}.items():
        out[f"vel_{name}"][odd] = value
    return out


VOLUME_KEY_SQL = f"user_id || '-' || (event_id // {BLOCK_IDS})"


def header_of(user: int) -> bytes:
    return b"AR2V0006.001" + struct.pack(">II", JULIAN, (MS + user * 1000) % 2**32) + b"K%03d" % (user % 1000)


def content_of(user: int, messages: np.ndarray) -> bytes:
    """Sized bzip2 records, one plain bzip2 stream, or header plus stream, by user."""
    head = header_of(user)
    if user % 3 == 0:
        parts = [bz2.compress(messages[at : at + RECORD_RADIALS].tobytes(), 1) for at in range(0, len(messages), RECORD_RADIALS)]
        return head + b"".join(struct.pack(">I", len(z)) + z for z in parts)
    whole = bz2.compress(head + messages.tobytes(), 1)
    return head + whole if user % 3 == 2 else whole


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (user_id, block, event_id, k) arrive in that order; only the volume that is still open is held, at most ``BLOCK_IDS`` rows."""

    def written(rows: np.ndarray) -> Iterator[pa.RecordBatch]:
        user, block, e, k = rows
        starts = np.flatnonzero(np.r_[True, (user[1:] != user[:-1]) | (block[1:] != block[:-1])])
        ends = np.r_[starts[1:], len(user)]
        first = 0
        while first < len(starts):  # whole volumes of some thousand messages at a time, at least one
            last = max(first + 1, int(np.searchsorted(ends, starts[first] + MESSAGES_AT_ONCE, "right")))
            low = starts[first]
            messages = radials_of(e[low : ends[last - 1]], k[low : ends[last - 1]])
            content = [content_of(int(user[a]), messages[a - low : b - low]) for a, b in zip(starts[first:last], ends[first:last])]
            names = [f"{user[a]}-{block[a]}" for a in starts[first:last]]
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array(content, pa.binary())], names=["volume_id", "content"])
            first = last

    held = np.zeros((4, 0), np.int64)
    for batch in batches:
        if not batch.num_rows:
            continue
        held = np.concatenate([held, np.stack([c.to_numpy() for c in batch.columns])], axis=1)
        open_at = int(np.flatnonzero((held[0] != held[0, -1]) | (held[1] != held[1, -1])).max(initial=-1)) + 1
        if open_at:
            yield from written(held[:, :open_at])
            held = held[:, open_at:]
    if held.shape[1]:
        yield from written(held)


def build_volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One exchange of narrow rows by volume; its parts are counted by rows, as each row becomes a message of 648 bytes."""
    events = m.table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("bigint")
    block = F.floor(F.col("event_id") / BLOCK_IDS).cast("bigint")
    rows = events.select(F.col("user_id").cast("bigint"), block.alias("block"), F.col("event_id").cast("bigint"), k.alias("k"))
    rows = rows.dropna()  # a message has all three
    parts = max(spark.sparkContext.defaultParallelism, -(-events.count() // EVENTS_PER_TASK))
    ordered = rows.repartition(parts, "user_id", "block").sortWithinPartitions("user_id", "block", "event_id")
    made = ordered.mapInArrow(_contents, "volume_id string, content binary")
    return made.select(
        "volume_id",
        F.concat(F.lit("events/"), "volume_id").alias("path"),
        F.lit("HINT").alias("station"),
        F.lit("20240101_000000").alias("ts_key"),
        "content",
    )


_written: dict[tuple[str, str], str] = {}


def volumes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The written volumes as a table; they are built once per application and data folder."""
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _written:
        path = scratch_path(spark, "volumes")
        # One file per task at least: unpacking is far more work than its few bytes suggest.
        build_volumes(spark, sf_dir).write.parquet(path)
        _written[key] = path
    return spark.read.parquet(_written[key])


def write_objects(rows: DataFrame, root: str) -> DataFrame:
    """Writes volumes as objects of one day, ``root/2024/01/01/STATION/NAME``; the returned rows are the written keys."""
    user = F.split("volume_id", "-")[0].cast("bigint")
    block = F.split("volume_id", "-")[1].cast("bigint")
    station = F.concat(F.lit("K"), F.lpad((user % 1000).cast("string"), 3, "0"))
    second = (F.floor(user / 1000) * 3600 + block) % 86400
    name = F.concat(station, F.lit("20240101_"), t.clock(second), F.lit("_V06_"), "volume_id")
    keyed = rows.select(F.concat_ws("/", F.lit(f"{root}/2024/01/01"), station, name).alias("path"), "content")

    def run(batches):
        for batch in batches:
            for path, content in zip(batch.column(0), batch.column(1)):
                target = path.as_py()
                system, inner = pafs.FileSystem.from_uri(target) if "://" in target else (pafs.LocalFileSystem(), target)
                system.create_dir(inner.rsplit("/", 1)[0], recursive=True)
                with system.open_output_stream(inner) as out:
                    out.write(content.as_py())
            yield pa.RecordBatch.from_arrays([batch.column(0)], names=["path"])

    return keyed.mapInArrow(run, "path string")
