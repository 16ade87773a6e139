"""Scanned pages: Group 4 bitonal images, cropping by fractions, PNG.

Rows are coded against the row above by vertical, horizontal and pass modes (ITU-T T.6).
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession

from glosswork.session import ship_package
from glosswork.sources.pdf import Document, Stream

# Run codes of ITU-T T.4, for 0 to 63, then for 64 to 1728 in steps of 64, then those of both colours from 1792.
WHITE = (
    "00110101 000111 0111 1000 1011 1100 1110 1111 10011 10100 00111 01000 001000 000011 110100 110101 "
    "101010 101011 0100111 0001100 0001000 0010111 0000011 0000100 0101000 0101011 0010011 0100100 0011000 00000010 00000011 00011010 "
    "00011011 00010010 00010011 00010100 00010101 00010110 00010111 00101000 00101001 00101010 00101011 00101100 00101101 00000100 00000101 00001010 "
    "00001011 01010010 01010011 01010100 01010101 00100100 00100101 01011000 01011001 01011010 01011011 01001010 01001011 00110010 00110011 00110100 "
    "11011 10010 010111 0110111 00110110 00110111 01100100 01100101 01101000 01100111 011001100 011001101 011010010 011010011 011010100 011010101 "
    "011010110 011010111 011011000 011011001 011011010 011011011 010011000 010011001 010011010 011000 010011011"
).split()
BLACK = (
    "0000110111 010 11 10 011 0011 0010 00011 000101 000100 0000100 0000101 0000111 00000100 00000111 000011000 "
    "0000010111 0000011000 0000001000 00001100111 00001101000 00001101100 00000110111 00000101000 00000010111 00000011000 000011001010 000011001011 000011001100 000011001101 000001101000 000001101001 "
    "000001101010 000001101011 000011010010 000011010011 000011010100 000011010101 000011010110 000011010111 000001101100 000001101101 000011011010 000011011011 000001010100 000001010101 000001010110 000001010111 "
    "000001100100 000001100101 000001010010 000001010011 000000100100 000000110111 000000111000 000000100111 000000101000 000001011000 000001011001 000000101011 000000101100 000001011010 000001100110 000001100111 "
    "0000001111 000011001000 000011001001 000001011011 000000110011 000000110100 000000110101 0000001101100 0000001101101 0000001001010 0000001001011 0000001001100 0000001001101 0000001110010 0000001110011 0000001110100 "
    "0000001110101 0000001110110 0000001110111 0000001010010 0000001010011 0000001010100 0000001010101 0000001011010 0000001011011 0000001100100 0000001100101"
).split()
BOTH = "00000001000 00000001100 00000001101 000000010010 000000010011 000000010100 000000010101 000000010110 000000010111 000000011100 000000011101 000000011110 000000011111".split()
MODES = {"0001": "pass", "001": "horizontal", "1": 0, "011": 1, "000011": 2, "0000011": 3, "010": -1, "000010": -2, "0000010": -3}
END_OF_BLOCK = "000000000001"


def _runs(codes: list[str]) -> dict[str, int]:
    out = {code: k if k < 64 else 64 * (k - 63) for k, code in enumerate(codes)}
    return out | {code: 1792 + 64 * k for k, code in enumerate(BOTH)}


RUNS = (_runs(WHITE), _runs(BLACK))
LONGEST = 13


class ScanError(ValueError):
    """An image that cannot be read as it stands."""


class _Bits:
    def __init__(self, data: bytes):
        self.bits = np.unpackbits(np.frombuffer(data, np.uint8)).astype(np.uint8)
        self.text = (self.bits + 48).tobytes().decode("ascii")
        self.at = 0

    def code(self, table: dict) -> object:
        for n in range(1, LONGEST + 1):
            key = self.text[self.at : self.at + n]
            if len(key) < n:
                break
            if key in table:
                self.at += n
                return table[key]
        raise ScanError(f"no code at bit {self.at}")

    def run(self, colour: int) -> int:
        total = 0
        while True:
            n = self.code(RUNS[colour])
            total += n
            if n < 64:
                return total


def decode_group4(data: bytes, width: int, height: int | None = None) -> np.ndarray:
    """Rows of booleans, True for black, up to ``height`` rows or the end of the block."""
    bits, rows = _Bits(data), []
    above = [width, width]
    while height is None or len(rows) < height:
        if bits.text.startswith(END_OF_BLOCK, bits.at) or bits.at >= len(bits.text):
            break
        changes, a0, colour = [], -1, 0
        while a0 < width:
            # The first change above, right of a0, to the other colour; changes to black stand at even places.
            k = next((i for i in range(colour, len(above), 2) if above[i] > a0), None)
            b1 = above[k] if k is not None else width
            mode = bits.code(MODES)
            if mode == "pass":
                a0 = above[k + 1] if k is not None and k + 1 < len(above) else width
                continue
            if mode == "horizontal":
                first = bits.run(colour)
                second = bits.run(1 - colour)
                a1 = max(a0, 0) + first
                changes += [a1, a1 + second]
                a0 = a1 + second
                continue
            a0 = b1 + mode
            changes.append(a0)
            colour = 1 - colour
        if any(not 0 <= c <= width for c in changes) or any(x > y for x, y in zip(changes, changes[1:], strict=False)):
            raise ScanError(f"row {len(rows)} does not fit {width}")
        row = np.zeros(width + 1, np.int8)
        for i, c in enumerate(changes):
            row[c] += 1 if i % 2 == 0 else -1
        rows.append(np.cumsum(row[:width]).astype(bool))
        above = [*changes, width, width]
        if len(above) % 2:
            above.append(width)
    if height is not None and len(rows) < height:
        raise ScanError(f"{len(rows)} rows of {height}")
    return np.array(rows, bool).reshape(len(rows), width)


def crop(image: np.ndarray, left: float, top: float, right: float, bottom: float) -> np.ndarray:
    """The part between fractions of width and height; at least one pixel each way."""
    if not (0 <= left < right <= 1 and 0 <= top < bottom <= 1):
        raise ScanError(f"crop {left}, {top}, {right}, {bottom}")
    h, w = image.shape
    x0, y0 = int(left * w), int(top * h)
    return image[y0 : max(y0 + 1, round(bottom * h)), x0 : max(x0 + 1, round(right * w))]


def png(image: np.ndarray) -> bytes:
    """A one-bit grey PNG, black for True."""
    h, w = image.shape
    rows = np.hstack([np.zeros((h, 1), np.uint8), np.packbits(~image, axis=1)])

    def chunk(kind: bytes, body: bytes) -> bytes:
        return struct.pack(">I", len(body)) + kind + body + struct.pack(">I", zlib.crc32(kind + body))

    return b"\x89PNG\r\n\x1a\n" + chunk(b"IHDR", struct.pack(">IIBBBBB", w, h, 1, 0, 0, 0, 0)) + chunk(b"IDAT", zlib.compress(rows.tobytes(), 9)) + chunk(b"IEND", b"")


def page_images(doc: Document) -> Iterator[tuple[int, np.ndarray]]:
    """(page, image) of Group 4 images, in page order."""
    for n, page in enumerate(doc.pages(), 1):
        resources = doc.get(page.get("Resources")) or {}
        for ref in (doc.get(resources.get("XObject")) or {}).values():
            x = doc.get(ref)
            if not isinstance(x, Stream) or doc.get(x.head.get("Filter")) not in ("CCITTFaxDecode", ["CCITTFaxDecode"]):
                continue
            parms = doc.get(x.head.get("DecodeParms")) or {}
            parms = doc.get(parms[0]) if isinstance(parms, list) else parms
            if doc.get(parms.get("K")) != -1:
                raise ScanError(f"page {n}: not Group 4")
            image = decode_group4(x.raw, int(doc.get(parms.get("Columns")) or 1728), int(doc.get(x.head["Height"])))
            yield n, ~image if doc.get(parms.get("BlackIs1")) else image


def scan_crops(spark: SparkSession, path: str, crops: DataFrame) -> DataFrame:
    """(path, page, row_no, png): crops (row_no, page, x0, y0, x1, y1), a human-written list, of scanned files."""
    ship_package(spark)
    wanted = [tuple(r) for r in crops.select("row_no", "page", "x0", "y0", "x1", "y1").collect()]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for f in pdf.itertuples():
                for page, image in page_images(Document(bytes(f.content))):
                    rows = [(f.path, page, n, png(crop(image, *box))) for n, p, *box in wanted if p == page]
                    yield pd.DataFrame(rows, columns=["path", "page", "row_no", "png"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(run, "path string, page int, row_no int, png binary")
