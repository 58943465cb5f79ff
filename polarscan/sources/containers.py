"""Compressed volume containers: plain bzip2, a header followed by sized bzip2 records, or no compression."""

from __future__ import annotations

import bz2
import struct
import zlib

HEADER_BYTES = 24
MAGICS = (b"ARCHIVE2", b"AR2V")


def bunzip_one(data: bytes) -> bytes | None:
    """One complete bzip2 stream; None when it is damaged or cut short. Bytes behind it are ignored."""
    stream = bz2.BZ2Decompressor()
    try:
        out = stream.decompress(data)
    except (OSError, ValueError, EOFError):
        return None
    return out if stream.eof else None


def _records(data: bytes):
    """Bodies of the sized records; a size running past the end means "the rest"."""
    at = HEADER_BYTES
    while at + 4 < len(data):
        (word,) = struct.unpack_from(">i", data, at)
        size = abs(word)
        if size == 0:
            return
        at += 4
        yield data[at : at + size]
        at += min(size, len(data) - at)


def unpack_records(data: bytes) -> bytes | None:
    """Header plus all records up to the first unreadable one; None when not even one record is readable."""
    parts = []
    for body in _records(data):
        part = bunzip_one(body)
        if part is None:
            break
        parts.append(part)
    return data[:HEADER_BYTES] + b"".join(parts) if parts else None


def unpack_volume(data: bytes, strict: bool = False) -> bytes | None:
    """Plain volume bytes, or None. ``strict`` refuses uncompressed input of 28 bytes or more."""
    if not data:
        return None
    if len(data) > 2 and data[:2] == b"BZ":
        return bunzip_one(data)
    if len(data) < HEADER_BYTES + 4:
        return data
    out = unpack_records(data)
    if out is None and data[HEADER_BYTES : HEADER_BYTES + 2] == b"BZ":
        out = bunzip_one(data[HEADER_BYTES:])
    if out is None and not strict and data.startswith(MAGICS):
        out = data
    return out


def gunzip(data: bytes) -> bytes:
    """Gzip content, or nothing at all when damaged or cut short."""
    stream = zlib.decompressobj(wbits=31)
    try:
        out = stream.decompress(data) + stream.flush()
    except zlib.error:
        return b""
    return out if stream.eof else b""


def gzip_best(data: bytes) -> bytes:
    if not data:
        return b""
    stream = zlib.compressobj(level=9, wbits=31)
    return stream.compress(data) + stream.flush()
