"""Writes small synthetic volumes, field by field, for tests."""

from __future__ import annotations

import bz2
import struct

JULIAN, MS = 20497, 58964000  # 2026-02-13 16:22:44


def volume_header(station: str = "KTLX", magic: bytes = b"AR2V0006.", julian: int = JULIAN, ms: int = MS) -> bytes:
    return struct.pack(">12sII4s", magic + b"001", julian, ms, station.encode())


def message(kind: int, body: bytes, seq: int = 0, n: int = 1, number: int = 1) -> bytes:
    # A size below 256 halfwords starts with a zero byte, which framing takes for padding; keep clear of that.
    body = body.ljust(496, b"\0") + b"\0" * (len(body) % 2)
    return struct.pack(">HBBHHIHH", (16 + len(body)) // 2, 0, kind, seq, JULIAN, MS, n, number) + body


def slot(kind: int, body: bytes, seq: int = 0, n: int = 1, number: int = 1) -> bytes:
    """A message in a fixed 2432-byte slot with a 12-byte prefix."""
    return (b"\0" * 12 + message(kind, body, seq, n, number)).ljust(2432, b"\0")


def vol_block(lat=35.3, lon=-97.3, site=370, feed=20, refl=0.5, phase=60.0, vcp=35) -> bytes:
    return struct.pack(">c3sHBBffhHfffffHH", b"R", b"VOL", 44, 1, 0, lat, lon, site, feed, 0.0, 0.0, 0.0, refl, phase, vcp, 0)


def rad_block(range_hm=1500, nyquist=2600) -> bytes:
    return struct.pack(">c3sHHffHH", b"R", b"RAD", 20, range_hm, 0.0, 0.0, nyquist, 0)


def moment_block(name: bytes, gates, first=2125, spacing=250, word=8, scale=2.0, offset=66.0, ng=None) -> bytes:
    data = struct.pack(f">{len(gates)}{'H' if word == 16 else 'B'}", *gates)
    head = struct.pack(
        ">c3sIHHHHHHff", b"D", name, 0, len(gates) if ng is None else ng, first, spacing, 0, 0, word, scale, offset
    )
    return head + data


def radial31(azimuth, elevation, blocks, status=1, elev_num=1, count=None, pointers=None) -> bytes:
    at, offsets = 72, []
    for block in blocks:
        offsets.append(at)
        at += len(block)
    offsets = (pointers or offsets)[:10]
    head = struct.pack(
        ">4sIHHfBBHBBBBfBBH10I",
        b"KTLX",
        MS,
        JULIAN,
        1,
        azimuth,
        0,
        0,
        at,
        1,
        status,
        elev_num,
        0,
        elevation,
        0,
        0,
        len(blocks) if count is None else count,
        *(offsets + [0] * (10 - len(offsets))),
    )
    return head + b"".join(blocks)


def radial1(azimuth, elevation, gates, status=1, first=1000, spacing=1000, span=460, nyquist=88) -> bytes:
    step = 360.0 / 65536.0
    body = bytearray(46)
    body[1] = status
    struct.pack_into(">H", body, 8, round(azimuth / step) % 65536)
    struct.pack_into(">H", body, 16, round(elevation / step) % 65536)
    struct.pack_into(">HHH", body, 20, first, spacing, len(gates))
    struct.pack_into(">HH", body, 26, span, nyquist)
    return bytes(body) + bytes(gates)


def sweep31(elevation, rays, gates_of, status0=0, elev_num=1, blocks_of=None, step=None) -> list[bytes]:
    step = step or 360.0 / rays
    out = []
    for i in range(rays):
        blocks = (blocks_of(i) if blocks_of else []) + [moment_block(b"REF", gates_of(i))]
        out.append(message(31, radial31(i * step, elevation, blocks, status0 if i == 0 else 1, elev_num), seq=i))
    return out


def ldm(header: bytes, bodies: list[bytes], negative_last: bool = True) -> bytes:
    out = [header]
    for i, body in enumerate(bodies):
        packed = bz2.compress(body)
        size = -len(packed) if negative_last and i == len(bodies) - 1 else len(packed)
        out.append(struct.pack(">i", size) + packed)
    return b"".join(out)
