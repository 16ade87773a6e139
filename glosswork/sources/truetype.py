"""TrueType outlines: tables, characters, components; subsets of a font for the characters in use."""

from __future__ import annotations

import struct
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from glosswork.sources.files import read_bytes

VERSION = 0x00010000
#: Tables that a subset keeps as they are, besides those it rebuilds.
COPIED = ("OS/2", "cvt ", "fpgm", "gasp", "name", "prep")
WORDS, SCALE, MORE, XY_SCALE, MATRIX = 0x0001, 0x0008, 0x0020, 0x0040, 0x0080


class FontError(ValueError):
    """A font that cannot be read as it stands."""


class Font:
    def __init__(self, data: bytes):
        self.data = data
        version, count = self._at(">IH", data, 0)
        if version != VERSION:
            raise FontError(f"not TrueType: {version:#x}")
        self.tables = {}
        for k in range(count):
            tag, _, start, size = self._at(">4sIII", data, 12 + 16 * k)
            self.tables[tag.decode("latin-1")] = (start, size)
        (self.glyphs,) = self._at(">H", self.table("maxp"), 4)
        (long,) = self._at(">h", self.table("head"), 50)
        kind = ">%dI" if long == 1 else ">%dH"
        offsets = self._at(kind % (self.glyphs + 1), self.table("loca"), 0)
        self.loca = offsets if long == 1 else tuple(2 * x for x in offsets)

    @staticmethod
    def _at(kind: str, data: bytes, at: int) -> tuple:
        if at < 0 or at + struct.calcsize(kind) > len(data):
            raise FontError(f"{struct.calcsize(kind)} bytes at {at} of {len(data)}")
        return struct.unpack_from(kind, data, at)

    def table(self, tag: str) -> bytes:
        if tag not in self.tables:
            raise FontError(f"no table {tag}")
        start, size = self.tables[tag]
        if start + size > len(self.data):
            raise FontError(f"table {tag} is cut off")
        return self.data[start : start + size]

    def outline(self, gid: int) -> bytes:
        if not 0 <= gid < self.glyphs:
            raise FontError(f"no glyph {gid}")
        return self.table("glyf")[self.loca[gid] : max(self.loca[gid], self.loca[gid + 1])]

    def characters(self) -> dict[int, int]:
        """Code point to glyph, of the last subtable of format 12."""
        cmap = self.table("cmap")
        (count,) = self._at(">H", cmap, 2)
        subtables = [self._at(">I", cmap, 8 + 8 * k)[0] for k in range(count)]
        wanted = [s for s in subtables if self._at(">H", cmap, s)[0] == 12]
        if not wanted:
            raise FontError("no character map of format 12")
        out = {}
        (groups,) = self._at(">I", cmap, wanted[-1] + 12)
        for k in range(groups):
            low, high, gid = self._at(">III", cmap, wanted[-1] + 16 + 12 * k)
            out.update((c, gid + c - low) for c in range(low, high + 1) if gid + c - low <= 0xFFFF)
        return out

    def parts(self, gid: int) -> list[tuple[int, int]]:
        """(component glyph, byte of its number) of a composite outline."""
        own = self.outline(gid)
        if len(own) < 10 or self._at(">h", own, 0)[0] >= 0:
            return []
        out, at, more = [], 10, True
        while more:
            flags, part = self._at(">HH", own, at)
            out.append((part, at + 2))
            at += 4 + (4 if flags & WORDS else 2) + (8 if flags & MATRIX else 4 if flags & XY_SCALE else 2 if flags & SCALE else 0)
            more = bool(flags & MORE)
        return out

    def closure(self, gids: Iterable[int]) -> list[int]:
        """Glyph 0, the given glyphs, and all they are made of, in order."""
        keep, todo = set(), [0, *gids]
        while todo:
            gid = todo.pop()
            if gid not in keep:
                keep.add(gid)
                todo += [p for p, _ in self.parts(gid)]
        return sorted(keep)


def _checksum(data: bytes) -> int:
    data += b"\0" * (-len(data) % 4)
    return sum(struct.unpack(f">{len(data) // 4}I", data)) & 0xFFFFFFFF


def subset(font: Font, codes: Iterable[int]) -> bytes:
    """A font of the given characters: glyphs renumbered in order, outlines, widths and character map rebuilt, checksums set."""
    known = font.characters()
    wanted = sorted(c for c in set(codes) if c in known)
    gids = font.closure(known[c] for c in wanted)
    new = {old: i for i, old in enumerate(gids)}
    glyf, loca = bytearray(), [0]
    for old in gids:
        own = bytearray(font.outline(old))
        for part, at in font.parts(old):
            struct.pack_into(">H", own, at, new[part])
        glyf += own + b"\0" * (-len(own) % 4)
        loca.append(len(glyf))
    (metrics,) = Font._at(">H", font.table("hhea"), 34)
    widths = font.table("hmtx")
    hmtx = bytearray()
    for old in gids:
        (width,) = Font._at(">H", widths, 4 * min(old, metrics - 1))
        (side,) = Font._at(">h", widths, 4 * old + 2 if old < metrics else 4 * metrics + 2 * (old - metrics))
        hmtx += struct.pack(">Hh", width, side)
    groups: list[list[int]] = []
    for c in wanted:
        g = new[known[c]]
        if groups and groups[-1][1] + 1 == c and groups[-1][2] + c - groups[-1][0] == g:
            groups[-1][1] = c
        else:
            groups.append([c, c, g])
    body = b"".join(struct.pack(">III", *g) for g in groups)
    cmap = struct.pack(">HHHHI", 0, 1, 3, 10, 12) + struct.pack(">HHIII", 12, 0, 16 + len(body), 0, len(groups)) + body
    head, maxp, hhea = (bytearray(font.table(t)) for t in ("head", "maxp", "hhea"))
    struct.pack_into(">I", head, 8, 0)
    struct.pack_into(">h", head, 50, 1)
    struct.pack_into(">H", maxp, 4, len(gids))
    struct.pack_into(">H", hhea, 34, len(gids))
    tables = {t: font.table(t) for t in COPIED if t in font.tables} | {"cmap": cmap, "glyf": bytes(glyf), "head": bytes(head), "hhea": bytes(hhea), "hmtx": bytes(hmtx), "loca": struct.pack(f">{len(loca)}I", *loca), "maxp": bytes(maxp), "post": struct.pack(">IIhhIIIII", 0x00030000, 0, 0, 0, 0, 0, 0, 0, 0)}
    power = 1 << (len(tables).bit_length() - 1)
    out = bytearray(struct.pack(">IHHHH", VERSION, len(tables), 16 * power, power.bit_length() - 1, 16 * (len(tables) - power)))
    at, bodies = 12 + 16 * len(tables), bytearray()
    where = {}
    for tag, data in sorted(tables.items()):
        where[tag] = at + len(bodies)
        out += struct.pack(">4sIII", tag.encode("latin-1"), _checksum(data), where[tag], len(data))
        bodies += data + b"\0" * (-len(data) % 4)
    out += bodies
    struct.pack_into(">I", out, where["head"] + 8, (0xB1B0AFBA - _checksum(bytes(out))) & 0xFFFFFFFF)
    return bytes(out)


def verify(font: Font, small: Font, codes: Iterable[int]) -> list[int]:
    """Characters whose outline in the subset is not that of the font, component by component."""

    def flat(f: Font, gid: int) -> tuple:
        own = bytearray(f.outline(gid))
        parts = f.parts(gid)
        for _, at in parts:
            own[at : at + 2] = b"\0\0"
        return bytes(own).rstrip(b"\0"), tuple(flat(f, p) for p, _ in parts)

    a, b = font.characters(), small.characters()
    return sorted(c for c in set(codes) if c in a and (c not in b or flat(font, a[c]) != flat(small, b[c])))


def read_font(spark: SparkSession, path: str) -> Font:
    return Font(read_bytes(spark, path))


def character_table(spark: SparkSession, font: Font) -> DataFrame:
    """(code, gid), at most one row a code point."""
    return spark.createDataFrame(sorted(font.characters().items()), "code int, gid int")


def component_edges(spark: SparkSession, font: Font) -> DataFrame:
    """(src, dst) from composite glyphs to their parts; fonts have at most 65,536 glyphs."""
    return spark.createDataFrame([(g, p) for g in range(font.glyphs) for p, _ in font.parts(g)], "src int, dst int")


def missing_characters(used: DataFrame, available: DataFrame) -> DataFrame:
    """Code points in use that the font has not."""
    return used.select("code").subtract(available.select("code"))
