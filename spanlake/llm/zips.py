"""ZIP archives of stored members: written in one pass, and read by ranges through their central and ZIP64 directories."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Callable
from dataclasses import dataclass

#: Fixed values of the ZIP format: signatures, and the marks that send a reader to the ZIP64 records.
LOCAL, CENTRAL, DESCRIPTOR, END, END64, LOCATOR64 = 0x04034B50, 0x02014B50, 0x08074B50, 0x06054B50, 0x06064B50, 0x07064B50
FULL16, FULL32 = 0xFFFF, 0xFFFFFFFF
#: The end record lies within its own size and the longest comment of the file's end.
END_SIZE, LONGEST_COMMENT = 22, 65535

Read = Callable[[int, int], bytes]


@dataclass
class Member:
    name: str
    method: int
    flags: int
    crc: int
    packed: int
    size: int
    header: int

    def data_at(self, read: Read) -> int:
        """Where the member's bytes begin, by its local header."""
        if self.flags & 1:
            raise ValueError(f"{self.name} is encrypted")
        raw = read(self.header, 30)
        if len(raw) < 30 or struct.unpack_from("<I", raw)[0] != LOCAL:
            raise ValueError(f"no local header of {self.name}")
        name, extra = struct.unpack_from("<HH", raw, 26)
        return self.header + 30 + name + extra


def _wide(extra: bytes, size: int, packed: int, header: int) -> tuple[int, int, int]:
    """Sizes and place with those that are full taken from the ZIP64 extra field."""
    at = 0
    while at + 4 <= len(extra):
        kind, n = struct.unpack_from("<HH", extra, at)
        if kind == 1:
            field, got = extra[at + 4 : at + 4 + n], []
            for v in (size, packed, header):
                if v == FULL32:
                    if len(field) < 8:
                        raise ValueError("short ZIP64 field")
                    v, field = struct.unpack_from("<Q", field)[0], field[8:]
                got.append(v)
            return got[0], got[1], got[2]
        at += 4 + n
    if FULL32 in (size, packed, header):
        raise ValueError("no ZIP64 field")
    return size, packed, header


def directory(read: Read, length: int) -> list[Member]:
    """All members by the central directory; `read(offset, size)` reads a range of a file of that length."""
    tail = min(length, END_SIZE + LONGEST_COMMENT)
    raw = read(length - tail, tail)
    at = len(raw) - END_SIZE
    while at >= 0:
        at = raw.rfind(struct.pack("<I", END), 0, at + 4)
        if at < 0 or at + END_SIZE + struct.unpack_from("<H", raw, at + 20)[0] == len(raw):
            break
        at -= 1
    if at < 0:
        raise ValueError("no end of central directory")
    count, size, start = struct.unpack_from("<HII", raw, at + 10)
    if count == FULL16 or FULL32 in (size, start):
        locator = read(length - tail + at - 20, 20)
        if struct.unpack_from("<I", locator)[0] != LOCATOR64:
            raise ValueError("no ZIP64 locator")
        end = read(struct.unpack_from("<Q", locator, 8)[0], 56)
        if struct.unpack_from("<I", end)[0] != END64:
            raise ValueError("no ZIP64 end of central directory")
        count, size, start = struct.unpack_from("<QQQ", end, 32)
    raw, at, out = read(start, size), 0, []
    for _ in range(count):
        if at + 46 > len(raw) or struct.unpack_from("<I", raw, at)[0] != CENTRAL:
            raise ValueError("broken central directory")
        flags, method = struct.unpack_from("<HH", raw, at + 8)
        crc, packed, plain = struct.unpack_from("<III", raw, at + 16)
        n, e, c = struct.unpack_from("<HHH", raw, at + 28)
        header = struct.unpack_from("<I", raw, at + 42)[0]
        name = raw[at + 46 : at + 46 + n].decode("utf-8" if flags & 0x800 else "cp437")
        plain, packed, header = _wide(raw[at + 46 + n : at + 46 + n + e], plain, packed, header)
        out.append(Member(name, method, flags, crc, packed, plain, header))
        at += 46 + n + e + c
    return out


class Writer:
    """Stored members, written in one pass to anything with write(); sizes and checksums follow the data."""

    def __init__(self, out, zip64: bool = True):
        self.out, self.zip64, self.at, self.members = out, zip64, 0, []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def open(self, name: str) -> None:
        raw = name.encode()
        extra = struct.pack("<HHQQ", 1, 16, 0, 0) if self.zip64 else b""
        size = FULL32 if self.zip64 else 0
        self.members.append(Member(name, 0, 0x808, 0, 0, 0, self.at))
        self._put(struct.pack("<IHHHHHIIIHH", LOCAL, 45 if self.zip64 else 20, 0x808, 0, 0, 33, 0, size, size, len(raw), len(extra)) + raw + extra)

    def write(self, data: bytes) -> int:
        """Append to the open member; where in it the data begins."""
        m = self.members[-1]
        start = m.size
        m.crc, m.size = zlib.crc32(data, m.crc), m.size + len(data)
        self._put(data)
        return start

    def end(self) -> None:
        m = self.members[-1]
        m.packed = m.size
        self._put(struct.pack("<IIQQ" if self.zip64 else "<IIII", DESCRIPTOR, m.crc, m.size, m.size))

    def close(self) -> None:
        start = self.at
        for m in self.members:
            raw = m.name.encode()
            extra = struct.pack("<HHQQQ", 1, 24, m.size, m.size, m.header) if self.zip64 else b""
            size, header = (FULL32, FULL32) if self.zip64 else (m.size, m.header)
            version = 45 if self.zip64 else 20
            self._put(struct.pack("<IHHHHHHIIIHHHHHII", CENTRAL, version, version, 0x808, 0, 0, 33, m.crc, size, size, len(raw), len(extra), 0, 0, 0, 0, header) + raw + extra)
        n, size = len(self.members), self.at - start
        if self.zip64:
            end = self.at
            self._put(struct.pack("<IQHHIIQQQQ", END64, 44, 45, 45, 0, 0, n, n, size, start))
            self._put(struct.pack("<IIQI", LOCATOR64, 0, end, 1))
        many, place = (FULL16, FULL32) if self.zip64 else (n, start)
        self._put(struct.pack("<IHHHHIIH", END, 0, 0, many, many, FULL32 if self.zip64 else size, place, 0))
