"""ToUnicode character maps: text to (code, text) rows. Malformed input is an error, never a guess."""

from __future__ import annotations

import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glosswork.session import ship_package

_TOKEN = re.compile(r"<<|<([^>]*)>|(\[)|(\])|([A-Za-z][A-Za-z0-9_]*)", re.A)
_HEX = re.compile(r"[0-9A-Fa-f]+\Z")


class CMapError(ValueError):
    """A character map that cannot be read as it stands."""


def _digits(raw: str) -> str:
    h = "".join(raw.split())
    if h and not _HEX.match(h):
        raise CMapError(f"not hexadecimal: {h!r}")
    return h


def source_code(raw: str) -> int:
    h = _digits(raw)
    if not 1 <= len(h) <= 4:
        raise CMapError(f"source code of one or two bytes expected: {h!r}")
    return int(h, 16)


def destination(h: str) -> str:
    """UTF-16BE if the digits fill whole units, else one code point."""
    if not h:
        return ""
    if len(h) % 4 == 0:
        try:
            return bytes.fromhex(h).decode("utf-16-be")
        except UnicodeDecodeError as e:
            raise CMapError(f"lone surrogate in {h!r}") from e
    code = int(h, 16)
    if code > 0x10FFFF or 0xD800 <= code <= 0xDFFF:
        raise CMapError(f"no code point: {h!r}")
    return chr(code)


def _blocks(tokens: list[tuple[str, str]], name: str) -> Iterator[list[tuple[str, str]]]:
    block = None
    for kind, value in tokens:
        if (kind, value) == ("word", f"begin{name}") and block is None:
            block = []
        elif (kind, value) == ("word", f"end{name}") and block is not None:
            yield block
            block = None
        elif block is not None:
            block.append((kind, value))
    if block is not None:
        yield block


def _shifted(h: str, by: int) -> str:
    """The whole big-endian value plus ``by``; it may not outgrow its digits."""
    if not h:
        raise CMapError("range without destination")
    out = f"{int(h, 16) + by:0{len(h)}X}" if len(h) <= 32 else ""
    if len(out) != len(h):
        raise CMapError(f"range overflows {h!r}")
    return out


def parse_cmap(text: str) -> dict[int, str]:
    tokens = []
    for m in _TOKEN.finditer(text):
        if m[1] is not None:
            tokens.append(("hex", m[1]))
        elif m[2] or m[3]:
            tokens.append(("array", m[0]))
        elif m[4]:
            tokens.append(("word", m[4]))
    out: dict[int, str] = {}
    for block in _blocks(tokens, "bfchar"):
        for k in range(0, len(block), 2):
            pair = block[k : k + 2]
            if len(pair) < 2 or any(kind != "hex" for kind, _ in pair):
                raise CMapError(f"bfchar is malformed near {pair}")
            out[source_code(pair[0][1])] = destination(_digits(pair[1][1]))
    for block in _blocks(tokens, "bfrange"):
        k = 0
        while k < len(block):
            ends = block[k : k + 2]
            if len(ends) < 2 or any(kind != "hex" for kind, _ in ends):
                raise CMapError(f"bfrange is malformed near {ends}")
            low, high = source_code(ends[0][1]), source_code(ends[1][1])
            if low > high:
                raise CMapError(f"range {low:#x} to {high:#x} is inverted")
            if k + 2 >= len(block):
                raise CMapError("bfrange is not terminated")
            kind, value = block[k + 2]
            if kind == "hex":
                h = _digits(value)
                for code in range(low, high + 1):
                    out[code] = destination(_shifted(h, code - low))
                k += 3
                continue
            if value != "[":
                raise CMapError("bfrange is not terminated")
            end = next((i for i in range(k + 3, len(block)) if block[i] == ("array", "]")), len(block))
            items = block[k + 3 : end]
            if any(kind != "hex" for kind, _ in items):
                raise CMapError(f"bfrange is malformed near {items}")
            if len(items) != high - low + 1:
                raise CMapError(f"range {low:#x} to {high:#x} has {len(items)} destinations")
            for code, (_, item) in zip(range(low, high + 1), items, strict=True):
                out[code] = destination(_digits(item))
            k = end + 1
    return out


@F.udtf(returnType="code int, text string")
class CMapRows:
    """The rows of one character map."""

    def eval(self, cmap: str):
        yield from sorted(parse_cmap(cmap or "").items())


def font_codes(fonts: DataFrame) -> DataFrame:
    """(page, font, two_byte, style, code, text) from fonts (page, font, two_byte, style, cmap). A null map has no rows, so each of its codes is unmapped."""
    ship_package(fonts.sparkSession)
    return fonts.where("cmap is not null").lateralJoin(CMapRows(F.col("cmap").outer())).drop("cmap")


def decode_codes(drawn: DataFrame, codes: DataFrame) -> DataFrame:
    """``drawn`` (page, font, code, ...) with ``text``; null if the map has none or it holds NUL."""
    known = codes.where(~F.col("text").contains("\x00")).select("page", "font", "code", "text")
    return drawn.join(known, ["page", "font", "code"], "left")
