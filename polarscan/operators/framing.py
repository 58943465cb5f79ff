"""Volume bytes to message rows.

Framing is sequential inside one object, so it is the one step done by a Python generator: one volume in, its messages
out, a batch at a time, no shuffle. The pass also numbers the sweeps, because it holds the radials in order: later steps
join on that number, without windows or ranges.
"""

from __future__ import annotations

import re
import struct
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas
from ..functions import bytes_be as b
from ..functions import timekeys
from ..sources.containers import HEADER_BYTES, MAGICS, unpack_volume

# Fixed values of the message framing.
HEADER = struct.Struct(">HBBHHIHH")
RESYNC_BYTES = 4096
SLOT_BYTES, SLOT_PREFIX, SLOT_MAX_MESSAGE = 2432, 12, 2420
UNSLOTTED_TYPES = (29, 31)
START_OF_VOLUME = 3
NEW_SWEEP_STATUSES = (0, 3, 5)
LEGACY_TYPE, GENERIC_TYPE = 1, 31
GENERIC_HEADER_BYTES, LEGACY_MIN_BYTES, MAX_BLOCKS = 72, 32, 10
LEGACY_ELEV_NUM = 255
LEGACY_ELEVATION = struct.Struct(">H")
LEGACY_STEEPEST = 16384  # 90 degrees, in steps of 360 / 65536; azimuths in such steps never leave the circle
# Usable angles; azimuths are compared in single precision.
WEST, EAST = (struct.unpack(">f", struct.pack(">f", x))[0] for x in (-0.1, 360.1))
LOWEST, STEEPEST = -5.0, 90.0

BATCH_BYTES = 16 << 20
BATCH_ROWS = 8192

# Looks ahead for the header shape: size below 2^15, type 1..32, day number high byte at least 0x27.
_CANDIDATE = re.compile(rb"(?s)(?=[\x00-\x7f]..[\x01-\x20]..[\x27-\xff])")
_NONZERO = re.compile(rb"[^\x00]")


def _is_header(data: bytes, at: int) -> bool:
    if at + HEADER.size > len(data):
        return False
    size, _, kind, _, julian, _, _, _ = HEADER.unpack_from(data, at)
    return 1 <= kind <= 32 and 8 <= size < 32768 and julian > 10000


def _next_header(data: bytes, start: int) -> int | None:
    for match in _CANDIDATE.finditer(data, start):
        if _is_header(data, match.start()):
            return match.start()
    return None


def _headers(data: bytes) -> Iterator[tuple[int, tuple]]:
    """(position, header fields) of each message whose body lies within the data."""
    archive = data.startswith(MAGICS) and len(data) >= HEADER_BYTES
    at, ahead = (HEADER_BYTES if archive else 0), -1
    while at + HEADER.size <= len(data):
        if archive:
            nonzero = _NONZERO.search(data, at)
            if nonzero is None:
                return
            at = nonzero.start()
        if _is_header(data, at):
            found = at
        elif _is_header(data, at + SLOT_PREFIX):
            found = at + SLOT_PREFIX
        else:
            if ahead <= at:
                ahead = _next_header(data, at + 1)
                if ahead is None:
                    return
            reach = RESYNC_BYTES if archive else SLOT_PREFIX
            if not archive or ahead > at + reach:
                at = max(at + 1, ahead - reach)
                continue
            found = ahead
        fields = HEADER.unpack_from(data, found)
        body = fields[0] * 2
        if found + body > len(data):
            at = found + 1
            continue
        yield found, fields
        slotted = archive and body < SLOT_MAX_MESSAGE and fields[2] not in UNSLOTTED_TYPES
        at = found + (SLOT_BYTES - SLOT_PREFIX if slotted else body)


class _Segments:
    """Pieces of multi-part messages waiting for the rest, by sequence number; the first copy of a piece wins."""

    def __init__(self) -> None:
        self.pending: dict[int, tuple[int, int, dict[int, bytes]]] = {}

    def add(self, seq: int, kind: int, count: int, number: int, piece: bytes) -> tuple[int, bytes] | None:
        if count <= 1:
            return kind, piece
        if not 1 <= number <= count:
            return None
        first_kind, first_count, pieces = self.pending.setdefault(seq, (kind, count, {}))
        if count != first_count:
            return None
        pieces.setdefault(number, piece)
        if len(pieces) < count:
            return None
        del self.pending[seq]
        return first_kind, b"".join(pieces[i] for i in range(1, count + 1))


def radial_state(kind: int, payload: bytes) -> tuple[int, int | None] | None:
    """(status, elevation number) of a usable radial, else null; a legacy radial has no elevation number."""
    if kind == LEGACY_TYPE:
        if len(payload) < LEGACY_MIN_BYTES or LEGACY_ELEVATION.unpack_from(payload, 16)[0] > LEGACY_STEEPEST:
            return None
        return payload[1], None
    if kind != GENERIC_TYPE or len(payload) < GENERIC_HEADER_BYTES:
        return None
    (azimuth,), (elevation,) = struct.unpack_from(">f", payload, 12), struct.unpack_from(">f", payload, 24)
    (blocks,) = struct.unpack_from(">H", payload, 30)
    if not (1 <= blocks <= MAX_BLOCKS and WEST <= azimuth <= EAST and LOWEST <= elevation <= STEEPEST):
        return None
    return payload[21], payload[22]


def starts_volume(kind: int, payload: bytes) -> bool:
    """A usable generic radial whose status announces a new volume; unfinished messages are dropped there."""
    return kind == GENERIC_TYPE and (radial_state(kind, payload) or (None,))[0] == START_OF_VOLUME


class _Sweeps:
    """Numbers the sweeps of one volume: one starts at a start status, a changed elevation number, or the first radial.

    A legacy radial that starts a sweep leaves the fixed legacy number for a following generic radial to differ from.
    """

    def __init__(self) -> None:
        self.sweep, self.number = -1, None

    def add(self, kind: int, payload: bytes) -> int | None:
        state = radial_state(kind, payload)
        if state is None:
            return None
        status, number = state
        started = status in NEW_SWEEP_STATUSES or self.sweep < 0
        if started or (number is not None and number != self.number):
            self.sweep += 1
        if number is not None:
            self.number = number
        elif started:
            self.number = LEGACY_ELEV_NUM
        return self.sweep


def messages_of(data: bytes) -> Iterator[tuple]:
    """(offset, type, sequence, julian, ms, segments, segment, complete type or None, assembled payload or None)."""
    if len(data) < HEADER_BYTES:
        return
    segments = _Segments()
    for at, (size, _, kind, seq, julian, ms, n, number) in _headers(data):
        done = segments.add(seq, kind, n, number, data[at + HEADER.size : at + size * 2])
        if done and starts_volume(*done):
            segments.pending.clear()
        yield (at, kind, seq, julian, ms, n, number) + (done or (None, None))


_ARROW = pa.schema(
    [
        ("volume_id", pa.string()),
        ("msg_seq", pa.int32()),
        ("offset", pa.int64()),
        ("type", pa.int32()),
        ("sequence_num", pa.int32()),
        ("julian", pa.int32()),
        ("ms", pa.int64()),
        ("num_segments", pa.int32()),
        ("segment_num", pa.int32()),
        ("complete_type", pa.int32()),
        ("sweep_id", pa.int32()),
        ("payload", pa.binary()),
    ]
)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(col, f.type) for col, f in zip(zip(*rows), _ARROW)], schema=_ARROW)


HEADER_TYPE = 0


def usable_radials(blob: bytes, strict: bool = False) -> Iterator[tuple[int, int, int, bytes]]:
    """(sequence, sweep, type, payload) of the radials of one volume that pass the size, block-count and angle checks."""
    sweeps = _Sweeps()
    for seq, row in enumerate(messages_of(unpack_volume(blob, strict) or b"")):
        sweep = None if row[-1] is None else sweeps.add(row[-2], row[-1])
        if sweep is not None:
            yield seq, sweep, row[-2], row[-1]


def _messages(batches: Iterator[pa.RecordBatch], keep_types: tuple[int, ...], strict: bool) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0  # of many volumes, as a volume may have one message only
    for batch in batches:
        for volume_id, blob in zip(batch.column(0).to_pylist(), batch.column(1)):
            blob = blob.as_py()
            if blob is None or len(blob) < HEADER_BYTES:
                continue
            sweeps = _Sweeps()
            data = unpack_volume(blob, strict) or b""
            for seq, row in enumerate(messages_of(data)):
                payload = row[-1] if row[-2] in keep_types else None
                sweep = None if row[-1] is None else sweeps.add(row[-2], row[-1])
                rows.append((volume_id, seq, *row[:-1], sweep, payload))
                size += len(payload or b"") + 64
                if size >= BATCH_BYTES or len(rows) >= BATCH_ROWS:
                    yield _batch(rows)
                    rows, size = [], 0
    if rows:
        yield _batch(rows)


def frame_messages(volumes: DataFrame, keep_types: tuple[int, ...] = (1, 31), strict: bool = False) -> DataFrame:
    """Message rows of each volume, usable radials with their sweep's number. Payloads of other complete types than
    ``keep_types`` are left out.
    """

    return volumes.select("volume_id", "content").mapInArrow(lambda batches: _messages(batches, keep_types, strict), schemas.MESSAGES)


def header_fields(rows: DataFrame) -> DataFrame:
    """(volume_id, head, hints) to station and timestamp: the header's, or the hints for a bare bzip2 stream."""
    head = F.col("head")
    bare = b.take(head, 0, 2) == F.lit(b"BZ")
    return rows.select(
        "volume_id",
        F.when(bare, F.col("station_hint")).otherwise(b.text(head, 20, 4)).alias("station"),
        F.when(bare, F.col("ts_hint"))
        .otherwise(timekeys.julian_to_key(b.be_u32(head, 12), b.be_u32(head, 16)))
        .alias("timestamp"),
    )


def hints(volumes: DataFrame) -> DataFrame:
    """What the caller says about each volume; content is not read for it."""
    return volumes.select("volume_id", F.col("station").alias("station_hint"), F.col("ts_key").alias("ts_hint"))


def volume_headers(volumes: DataFrame) -> DataFrame:
    """Station and timestamp of each volume, for callers that decode nothing else."""
    head = F.substring("content", 1, HEADER_BYTES).alias("head")
    narrow = volumes.select("volume_id", F.col("station").alias("station_hint"), F.col("ts_key").alias("ts_hint"), head)
    return header_fields(narrow.where(F.octet_length("head") >= HEADER_BYTES))
