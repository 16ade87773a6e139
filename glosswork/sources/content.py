"""Content streams: bytes to tokens to drawn codes to text runs."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glosswork.session import ship_package
from glosswork.sources.cmap import decode_codes

#: A page's stream is larger than this only if something is wrong.
LARGEST_STREAM = 64 << 20
_SPACE, _DELIMITER = b"\x00\t\n\x0c\r ", b"()<>[]{}/%"
_REGULAR = re.compile(rb"[^\x00\t\n\x0c\r ()<>\[\]{}/%]+")
_ESCAPES = {ord("n"): 10, ord("r"): 13, ord("t"): 9, ord("b"): 8, ord("f"): 12}


class ContentError(ValueError):
    """A content stream that cannot be read as it stands."""


def _literal(src: bytes, start: int) -> tuple[bytes, int]:
    out, depth, i = bytearray(), 1, start + 1
    while i < len(src):
        b = src[i]
        if b == 0x5C:
            octal = re.compile(rb"[0-7]{1,3}").match(src, i + 1)
            if octal:
                out.append(int(octal[0], 8) & 0xFF)
                i = octal.end()
                continue
            if i + 1 >= len(src):
                break
            nxt = src[i + 1]
            if src[i + 1 : i + 3] == b"\r\n":
                i += 3
                continue
            if nxt not in b"\r\n":
                out.append(_ESCAPES.get(nxt, nxt))
            i += 2
            continue
        depth += (b == 0x28) - (b == 0x29)
        if depth == 0:
            return bytes(out), i + 1
        out.append(b)
        i += 1
    raise ContentError(f"string not closed at byte {start}")


def tokenize(src: bytes) -> Iterator[tuple[str, object]]:
    """(kind, value): str, name, number, mark or op. Inline images are an error."""
    i = 0
    while i < len(src):
        b = src[i : i + 1]
        if b in (b"{", b"}") or b in _SPACE:
            i += 1
        elif b == b"%":
            end = re.compile(rb"[\r\n]").search(src, i)
            i = end.start() if end else len(src)
        elif b == b"(":
            value, i = _literal(src, i)
            yield "str", value
        elif src[i : i + 2] in (b"<<", b">>"):
            yield "mark", src[i : i + 2].decode()
            i += 2
        elif b == b"<":
            end = src.find(b">", i)
            if end < 0:
                raise ContentError(f"hex string not closed at byte {i}")
            digits = src[i + 1 : end].translate(None, _SPACE)
            if not re.fullmatch(rb"[0-9A-Fa-f]*", digits):
                raise ContentError(f"not hexadecimal in the string at byte {i}")
            yield "str", bytes.fromhex((digits + b"0" * (len(digits) % 2)).decode())
            i = end + 1
        elif b == b">":
            i += 1
        elif b in (b"[", b"]"):
            yield "mark", b.decode()
            i += 1
        elif b == b"/":
            m = _REGULAR.match(src, i + 1)
            yield "name", m[0].decode("utf-8", "replace") if m else ""
            i = m.end() if m else i + 1
        elif m := _REGULAR.match(src, i):
            word = m[0].decode("utf-8", "replace")
            if word[0] in "+-.0123456789":
                try:
                    yield "number", float(word)
                except ValueError as e:
                    raise ContentError(f"unreadable number {word!r} at byte {i}") from e
            elif word == "BI":
                raise ContentError(f"inline image at byte {i}")
            else:
                yield "op", word
            i = m.end()
        else:
            i += 1


def drawn(src: bytes) -> Iterator[tuple[int, float, float, str, bytes]]:
    """(run_no, x, y, font, codes) of each shown string, in drawing order. Strings before any font is set show nothing."""
    if len(src) > LARGEST_STREAM:
        raise ContentError(f"stream of {len(src)} bytes")
    font, x, y, n = None, 0.0, 0.0, 0
    operands: list[tuple[str, object]] = []
    for kind, value in tokenize(src):
        if kind != "op":
            operands.append((kind, value))
            continue
        numbers = [v for k, v in operands if k == "number"]
        if value == "Tf":
            font = next((v for k, v in reversed(operands) if k == "name"), font)
        elif value == "Tm" and len(numbers) >= 6:
            x, y = numbers[-2:]
        elif value in ("Td", "TD") and len(numbers) >= 2:
            x, y = x + numbers[-2], y + numbers[-1]
        elif value in ("Tj", "'", '"', "TJ") and font is not None:
            for k, v in operands:
                if k == "str":
                    yield n, x, y, font, v
                    n += 1
        operands.clear()


def shown_strings(pages: DataFrame) -> DataFrame:
    """(book, page, width, run_no, x, y, font, codes) from pages (book, page, width, content binary)."""
    ship_package(pages.sparkSession)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            rows = [(p.book, p.page, p.width, *d) for p in pdf.itertuples() for d in drawn(bytes(p.content))]
            yield pd.DataFrame(rows, columns=["book", "page", "width", "run_no", "x", "y", "font", "codes"])

    return pages.select("book", "page", "width", "content").mapInPandas(run, "book string, page int, width double, run_no int, x double, y double, font string, codes binary")


def render(strings: DataFrame, fonts: DataFrame, codes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(runs, unmapped): text runs (book, page, width, run_no, x, y, text, style) and codes without text (book, page, font, code).

    ``fonts``: page, font, two_byte, style; strings in other fonts show nothing. Codes without text are reported, never guessed.
    """
    own = strings.join(fonts.select("page", "font", "two_byte", "style"), ["page", "font"])
    hexed = F.hex("codes")
    width = F.when(F.col("two_byte"), 4).otherwise(2)
    count = F.floor(F.length(hexed) / width).cast("int")
    pieces = F.when(count > 0, F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.conv(F.substr(hexed, i * width + 1, width), 16, 10).cast("int"))).otherwise(F.array().cast("array<int>"))
    each = own.select("book", "page", "width", "run_no", "x", "y", "style", "font", F.posexplode(pieces).alias("at", "code"))
    met = decode_codes(each, codes)
    unmapped = met.where("text is null").select("book", "page", "font", "code")
    keys = ["book", "page", "width", "run_no", "x", "y", "style"]
    runs = met.where("text is not null").groupBy(*keys).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "text"))), lambda s: s["text"]), "").alias("text"))
    return runs.where("text <> ''").select("book", "page", "width", "run_no", "x", "y", "text", "style"), unmapped


def unmapped_report(unmapped: DataFrame) -> DataFrame:
    """(code, n, pages) of unmapped codes, most frequent first."""
    return unmapped.groupBy("code").agg(F.count("*").alias("n"), F.countDistinct("page").alias("pages")).orderBy(F.desc("n"), "code")


def kept_codes(unmapped: DataFrame, accepted: tuple[int, ...]) -> DataFrame:
    return unmapped.where(~F.col("code").isin(*accepted))


def number_runs(runs: DataFrame) -> DataFrame:
    return runs.withColumn("run_no", F.row_number().over(Window.partitionBy("book", "page").orderBy("run_no")))
