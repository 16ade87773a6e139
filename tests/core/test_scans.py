"""Group 4 images against an encoder written here from the rules of the standard."""

import itertools
import struct
import zlib

import numpy as np
import pytest

from glosswork.sources import scans
from glosswork.sources.pdf import Document


def run_code(n, colour):
    codes = {v: k for k, v in scans.RUNS[colour].items()}
    out = ""
    while n > 2560 + 63:
        out, n = out + codes[2560], n - 2560
    if n >= 64:
        out, n = out + codes[n // 64 * 64], n % 64
    return out + codes[n]


def encode(image):
    """Each row by the standard's flow: pass, vertical within three, else horizontal."""
    modes = {v: k for k, v in scans.MODES.items()}
    h, w = image.shape
    bits, above = "", np.zeros(w, bool)

    def change(row, at, colour):
        """First place right of ``at`` where the row turns to the other colour than ``colour``."""
        for x in range(at + 1, w):
            if row[x] != colour and (x == 0 and not colour or x > 0 and row[x - 1] == colour):
                return x
        return w

    for row in image:
        a0, colour = -1, False
        while a0 < w:
            a1 = next((x for x in range(max(a0, 0), w) if row[x] != colour), w)
            b1 = change(above, a0, colour)
            b2 = next((x for x in range(b1 + 1, w) if above[x] == colour), w)
            if b2 < a1:
                bits, a0 = bits + modes["pass"], b2
            elif abs(a1 - b1) <= 3:
                bits, a0, colour = bits + modes[a1 - b1], a1, not colour
            else:
                a2 = next((x for x in range(a1, w) if row[x] == colour), w)
                bits += modes["horizontal"] + run_code(a1 - max(a0, 0), int(colour)) + run_code(a2 - a1, int(not colour))
                a0 = a2
        above = row
    bits += scans.END_OF_BLOCK * 2
    bits += "0" * (-len(bits) % 8)
    return int(bits, 2).to_bytes(len(bits) // 8, "big")


def test_codes_are_free_of_prefixes():
    for table in (*scans.RUNS, scans.MODES):
        assert not [1 for a, b in itertools.permutations(table, 2) if b.startswith(a)]
        assert not [c for c in table if scans.END_OF_BLOCK.startswith(c)]
    assert [len(t) for t in scans.RUNS] == [104, 104]


@pytest.mark.parametrize(("h", "w", "density"), [(1, 1, 0.5), (12, 40, 0.5), (20, 33, 0.1), (8, 200, 0.02), (6, 5300, 0.0005), (9, 64, 1.0), (5, 64, 0.0)])
def test_round_trip(h, w, density):
    r = np.random.default_rng(h * w)
    image = r.random((h, w)) < density
    image[h // 2 :] |= np.roll(image[: h - h // 2], 1, axis=1)
    data = encode(image)
    assert (scans.decode_group4(data, w, h) == image).all() and (scans.decode_group4(data, w) == image).all()


def test_errors():
    with pytest.raises(scans.ScanError):
        scans.decode_group4(b"\x00\x00\x00", 8, 1)
    with pytest.raises(scans.ScanError):
        scans.decode_group4(encode(np.zeros((1, 8), bool)), 8, 2)
    with pytest.raises(scans.ScanError):
        scans.crop(np.zeros((2, 2), bool), 0.5, 0, 0.5, 1)


def read_png(data):
    w, h = struct.unpack(">II", data[16:24])
    size = struct.unpack(">I", data[33:37])[0]
    rows = np.frombuffer(zlib.decompress(data[41 : 41 + size]), np.uint8).reshape(h, -1)[:, 1:]
    return ~np.unpackbits(rows, axis=1)[:, :w].astype(bool)


def test_crops_of_a_file(spark, tmp_path):
    image = np.random.default_rng(1).random((30, 50)) < 0.3
    body = encode(image)
    src = (
        b"%%PDF-1.4\n1 0 obj << /Type /Catalog /Pages 2 0 R >> endobj 2 0 obj << /Kids [3 0 R] /MediaBox [0 0 1 1] >> endobj "
        b"3 0 obj << /Type /Page /Resources << /XObject << /I 4 0 R >> >> >> endobj "
        b"4 0 obj << /Width 50 /Height 30 /Filter /CCITTFaxDecode /DecodeParms << /K -1 /Columns 50 >> /Length %d >> stream\n%s\nendstream endobj trailer << /Root 1 0 R >>" % (len(body), body)
    )
    assert (next(scans.page_images(Document(src)))[1] == image).all()
    (tmp_path / "s.pdf").write_bytes(src)
    crops = spark.createDataFrame([(0, 1, 0.0, 0.0, 1.0, 1.0), (1, 1, 0.2, 0.5, 0.6, 0.9), (2, 7, 0.0, 0.0, 1.0, 1.0)], "row_no int, page int, x0 double, y0 double, x1 double, y1 double")
    got = {r.row_no: read_png(bytes(r.png)) for r in scans.scan_crops(spark, str(tmp_path / "s.pdf"), crops).collect()}
    assert got.keys() == {0, 1} and (got[0] == image).all() and (got[1] == image[15:27, 10:30]).all()
