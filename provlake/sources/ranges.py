"""Zip archives over byte ranges: the listing from the tail, members by range with their checksum, batches and retries."""

from __future__ import annotations

import struct
import time
import zlib
from collections.abc import Callable

from provlake.sources.binary import zip_members

Fetch = Callable[[int, int], bytes]
TAIL = 22 + 65_535 + 20
MOST_DIRECTORY = 256 << 20


class TooMany(RuntimeError):
    """The server asks for patience: seconds to wait, or None."""

    def __init__(self, after: float | None = None) -> None:
        super().__init__("too many requests")
        self.after = after


def retrying(fetch: Callable, attempts: int = 5, most: float = 60.0, sleep: Callable[[float], None] = time.sleep) -> Callable:
    """``fetch`` again after the server's wish or doubling waits; the last failure is raised."""

    def call(*args):
        for n in range(attempts):
            try:
                return fetch(*args)
            except (TooMany, OSError) as e:
                if n + 1 == attempts:
                    raise
                sleep(min(most, getattr(e, "after", None) or 2.0 ** (n + 1)))

    return call


def directory(fetch: Fetch, size: int) -> list[tuple] | None:
    """Members of an archive of ``size`` bytes from its tail alone (64-bit forms too); None if it has no readable directory."""
    start = max(0, size - TAIL)
    tail = fetch(start, size)
    at = tail.rfind(b"PK\x05\x06")
    if at < 0 or len(tail) < at + 22:
        return None
    count, length, first = struct.unpack_from("<HLL", tail, at + 10)
    if 0xFFFFFFFF in (length, first) or count == 0xFFFF:
        loc = tail.rfind(b"PK\x06\x07", 0, at)
        if loc < 0:
            return None
        (z,) = struct.unpack_from("<Q", tail, loc + 8)
        record = tail[z - start :] if z >= start else fetch(z, min(size, z + 56))
        if record[:4] != b"PK\x06\x06":
            return None
        count, length, first = struct.unpack_from("<QQQ", record, 32)
    if first + length > size or length > MOST_DIRECTORY:
        return None
    block = tail[first - start : first - start + length] if first >= start else fetch(first, first + length)
    # the block as an archive of its own: its directory starts at 0
    return zip_members(block + struct.pack("<4sHHHHLLH", b"PK\x05\x06", 0, 0, min(count, 0xFFFE), min(count, 0xFFFE), length, 0, 0)) if count < 0xFFFF else _long(block, count)


def _long(block: bytes, count: int) -> list[tuple] | None:
    end = struct.pack("<4sQHHLLQQQQ", b"PK\x06\x06", 44, 45, 45, 0, 0, count, count, len(block), 0)
    loc = struct.pack("<4sLQL", b"PK\x06\x07", 0, len(block), 1)
    return zip_members(block + end + loc + struct.pack("<4sHHHHLLH", b"PK\x05\x06", 0, 0, 0xFFFF, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFF, 0))


def member(fetch: Fetch, row: tuple) -> bytes | None:
    """A stored or deflated member's bytes; None if its form is another one or its checksum is wrong."""
    _, method, comp, full, crc, offset, *_ = row
    head = fetch(offset, offset + 30)
    if head[:4] != b"PK\x03\x04":
        return None
    n, extra = struct.unpack_from("<HH", head, 26)
    a = offset + 30 + n + extra
    return unpack(fetch(a, a + comp), method, full, crc)


def unpack(raw: bytes, method: int, full: int, crc: int) -> bytes | None:
    try:
        data = raw if method == 0 else zlib.decompress(raw, -15) if method == 8 else None
    except zlib.error:
        return None
    return data if data is not None and len(data) == full and zlib.crc32(data) == crc else None


def members(fetch_many: Callable[[list[tuple[int, int]]], list[bytes]], rows: list[tuple], most: int = 256, most_bytes: int = 256 << 20) -> dict[str, bytes | None]:
    """Members by batches of ranges, each answer found again by its place and checked by itself.

    A range reaches over the local header's longest likely form, so that one request holds header and data."""
    from provlake.sources.search import batches

    rows = sorted(rows, key=lambda r: r[5])
    spans = [(r[5], r[5] + 30 + len(r[0].encode()) + 512 + r[2]) for r in rows]
    groups: dict[int, list[int]] = {}
    for i, b in enumerate(batches([y - x for x, y in spans], most, most_bytes)):
        groups.setdefault(b, []).append(i)
    out: dict[str, bytes | None] = {}
    for at in groups.values():
        for i, part in zip(at, fetch_many([spans[i] for i in at])):
            name, method, comp, full, crc, *_ = rows[i]
            n, extra = struct.unpack_from("<HH", part, 26) if part[:4] == b"PK\x03\x04" else (0, 0)
            a = 30 + n + extra
            out[name] = unpack(part[a : a + comp], method, full, crc) if part[:4] == b"PK\x03\x04" else None
    return out
