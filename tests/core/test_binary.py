"""PDF files and fonts, made here byte by byte."""

import struct
import zlib

import pytest

from glosswork.operators.layout import group_lines
from glosswork.plans.catalog import composite_closure
from glosswork.sources import content, pdf, truetype
from glosswork.sources.cmap import font_codes

CMAP = b"beginbfchar <41> <963F> <42> <0042> endbfchar"
DRAW = b"/F1 9 Tf 1 0 0 1 10 700 Tm (AB) Tj 1 0 0 1 300 650 Tm (B) Tj"


def stream(n, data, extra=b"", squeeze=True):
    body = zlib.compress(data) if squeeze else data
    kind = b"/Filter /FlateDecode " if squeeze else b""
    return b"%d 0 obj << %s%s/Length %d >> stream\n%s\nendstream endobj\n" % (n, kind, extra, len(body), body)


def plain_file():
    return (
        b"%PDF-1.4\n1 0 obj << /Type /Catalog /Pages 2 0 R >> endobj\n"
        b"2 0 obj << /Type /Pages /Kids [3 0 R 8 0 R] /Count 2 /MediaBox [0 0 400 800] /Resources << /Font << /F1 5 0 R /F2 7 0 R >> >> >> endobj\n"
        b"3 0 obj << /Type /Page /Parent 2 0 R /Contents [4 0 R 9 0 R] >> endobj\n"
        + stream(4, DRAW)
        + b"5 0 obj << /Type /Font /Subtype /TrueType /BaseFont /ABCDEF+NomNaTong /ToUnicode 6 0 R >> endobj\n"
        + stream(6, CMAP, squeeze=False)
        + b"7 0 obj << /Type /Font /Subtype /Type0 /BaseFont /Times#20Italic >> endobj\n"
        + b"8 0 obj << /Type /Page /MediaBox [10 0 110.5 9] /Parent 2 0 R /Note (a \\) (b) c) >> endobj\n"
        + stream(9, b"1 0 0 1 10 600 Tm (C) Tj")
        + b"trailer << /Root 1 0 R >>\n%%EOF"
    )


def packed_file():
    objects = [(1, b"<< /Type /Catalog /Pages 2 0 R >>"), (2, b"<< /Type /Pages /Kids [3 0 R] /MediaBox [0 0 8 9] >>"), (3, b"<< /Type /Page >>")]
    heads, bodies = b"", b""
    for n, b in objects:
        heads += b"%d %d " % (n, len(bodies))
        bodies += b + b" "
    return b"%PDF-1.5\n" + stream(4, heads + bodies, b"/Type /ObjStm /N 3 /First %d " % len(heads)) + stream(5, b"", b"/Type /XRef /Root 1 0 R ") + b"%%EOF"


def test_a_file_to_lines(spark, tmp_path):
    (tmp_path / "b.pdf").write_bytes(plain_file())
    pages, fonts = pdf.read_pdf(spark, str(tmp_path / "b.pdf"))
    assert [(p.page, p.width) for p in pages.orderBy("page").collect()] == [(1, 400.0), (2, 100.5)]
    assert {(f.page, f.font, f.two_byte, f.style, f.cmap is None) for f in fonts.collect()} == {(n, "F1", False, "han", False) for n in (1, 2)} | {(n, "F2", True, "italic", True) for n in (1, 2)}
    runs, unmapped = content.render(content.shown_strings(pages), fonts, font_codes(fonts))
    assert [(r.page, r.column, r.text) for r in group_lines(runs).orderBy("page", "line_no").collect()] == [(1, "left", "阿B"), (1, "right", "B")]
    assert [(u.page, u.font, u.code) for u in unmapped.collect()] == [(1, "F1", 0x43)]


def test_object_streams():
    doc = pdf.Document(packed_file())
    assert [doc.width(p) for p in doc.pages()] == [8.0] and [doc.content(p) for p in doc.pages()] == [b""]


@pytest.mark.parametrize("src", [b"no", b"%PDF-1.4\ntrailer << /Root 1 0 R /Encrypt 2 0 R >>", b"%PDF-1.4\n", b"%PDF-1.4\n1 0 obj << /Pages 2 0 R >> endobj 2 0 obj << /Kids [2 0 R] >> endobj trailer << /Root 1 0 R >>"])
def test_broken_files(src):
    with pytest.raises(pdf.PdfError):
        list(pdf.Document(src).pages())


def test_filters():
    doc = pdf.Document(b"%PDF-1.4\n")
    assert doc.bytes_of(pdf.Stream({"Filter": [pdf.Name("ASCIIHexDecode"), pdf.Name("FlateDecode")]}, zlib.compress(b"x").hex().encode() + b">")) == b"x"
    rows = bytes([2, 1, 2, 3, 2, 1, 1, 1, 1, 5, 1, 1])
    assert doc.bytes_of(pdf.Stream({"DecodeParms": {"Predictor": 12, "Columns": 3}}, rows)) == bytes([1, 2, 3, 2, 3, 4, 5, 6, 7])
    with pytest.raises(pdf.PdfError):
        doc.bytes_of(pdf.Stream({"Filter": pdf.Name("DCTDecode")}, b""))


def make_font():
    """Glyphs: 0 empty, 1 to 3 plain, 4 made of 1 and 2, 5 made of 4 (scaled) and 3."""
    simple = lambda k: struct.pack(">hhhhh", 1, 0, 0, k, k) + bytes([k] * 6)
    composite = lambda *parts: struct.pack(">hhhhh", -1, 0, 0, 9, 9) + b"".join(parts)
    glyphs = [b"", simple(1), simple(2), simple(3), composite(struct.pack(">HHhh", 0x21, 1, 0, 0), struct.pack(">HHbb", 0x0, 2, 0, 0)), composite(struct.pack(">HHbbh", 0x28, 4, 0, 0, 1), struct.pack(">HHhh", 0x1, 3, 0, 0))]
    loca, glyf = [0], b""
    for g in glyphs:
        glyf += g + b"\0" * (-len(g) % 4)
        loca.append(len(glyf))
    groups = [(0x41, 0x43, 1), (0x20000, 0x20001, 4)]
    cmap = struct.pack(">HHHHI", 0, 1, 3, 10, 12) + struct.pack(">HHIII", 12, 0, 16 + 24, 0, 2) + b"".join(struct.pack(">III", *g) for g in groups)
    head, hhea = bytearray(54), bytearray(36)
    struct.pack_into(">h", head, 50, 1)
    struct.pack_into(">H", hhea, 34, 2)
    tables = {"cmap": cmap, "glyf": glyf, "head": bytes(head), "hhea": bytes(hhea), "hmtx": struct.pack(">HhHhhhhh", 500, 1, 600, 2, 3, 4, 5, 6), "loca": struct.pack(">7I", *loca), "maxp": struct.pack(">IH", 0x10000, 6)}
    out, body, at = struct.pack(">IHHHH", 0x10000, len(tables), 0, 0, 0), b"", 12 + 16 * len(tables)
    for tag, data in tables.items():
        out += struct.pack(">4sIII", tag.encode(), 0, at + len(body), len(data))
        body += data + b"\0" * (-len(data) % 4)
    return truetype.Font(out + body)


def test_font_tables(spark):
    font = make_font()
    assert font.characters() == {0x41: 1, 0x42: 2, 0x43: 3, 0x20000: 4, 0x20001: 5}
    assert font.closure([5]) == [0, 1, 2, 3, 4, 5] and font.closure([2]) == [0, 2]
    edges = truetype.component_edges(spark, font)
    got = composite_closure(edges, spark.createDataFrame([(5,)], "node int"))
    assert sorted(r.node for r in got.collect()) == [1, 2, 3, 4, 5]
    used = spark.createDataFrame([(0x41,), (0x99,)], "code int")
    assert [r.code for r in truetype.missing_characters(used, truetype.character_table(spark, font)).collect()] == [0x99]


def test_subsets_keep_outlines():
    font = make_font()
    small = truetype.Font(truetype.subset(font, [0x42, 0x20000, 0x999]))
    assert (small.glyphs, small.characters()) == (4, {0x42: 2, 0x20000: 3})
    assert truetype.verify(font, small, [0x42, 0x20000]) == [] and truetype.verify(font, small, [0x43]) == [0x43]
    assert struct.unpack(">HhHhHhHh", small.table("hmtx")) == (500, 1, 600, 2, 600, 3, 600, 5)
    assert truetype._checksum(small.data) == 0xB1B0AFBA
    with pytest.raises(truetype.FontError):
        truetype.Font(b"OTTO" + b"\0" * 40)
    with pytest.raises(truetype.FontError):
        truetype.Font(font.data[:60])
