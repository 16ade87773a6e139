"""Readers and writers: character maps, content streams, files, settings."""

import io
import json
import zipfile

import pytest
from pyspark.sql import functions as F

from glosswork.operators.layout import group_lines
from glosswork.sources import content, files, settings
from glosswork.sources.cmap import CMapError, CMapRows, font_codes, parse_cmap

ALL_FORMS = """/CIDInit /ProcSet findresource begin << /Registry (Adobe) >> def
2 beginbfchar <0003> <0041> <5126> <D862DC32> endbfchar
3 beginbfrange <0010> <0012> <0061> <0020> <0022> [<0078> <0079> <00E9>] <0030> <0031> <00E0> endbfrange"""


def test_cmap_forms():
    assert parse_cmap(ALL_FORMS) == {0x03: "A", 0x5126: "\U00028832", 0x10: "a", 0x11: "b", 0x12: "c", 0x20: "x", 0x21: "y", 0x22: "é", 0x30: "à", 0x31: "á"}
    assert parse_cmap("1 beginbfchar <01> <1F600> endbfchar") == {1: "😀"}


@pytest.mark.parametrize(
    "body",
    [
        "beginbfchar <0001> <D800> endbfchar",
        "beginbfchar <00001> <0041> endbfchar",
        "beginbfchar <> <0041> endbfchar",
        "beginbfchar <0001> <00ZZ> endbfchar",
        "beginbfchar <0001> endbfchar",
        "beginbfchar <0001> [ <0041> ] endbfchar",
        "beginbfrange <0002> <0001> <0041> endbfrange",
        "beginbfrange <0001> <0003> [<0041>] endbfrange",
        "beginbfrange <0001> <0002> <FFFF> endbfrange",
        "beginbfrange <0001> <0002> endbfrange",
        "beginbfchar <0001> <110000> endbfchar",
    ],
)
def test_cmap_errors(body):
    with pytest.raises(CMapError):
        parse_cmap(body)


def test_cmap_rows(spark):
    assert [tuple(r) for r in CMapRows(F.lit(ALL_FORMS)).limit(2).collect()] == [(3, "A"), (16, "a")]


def kinds(src):
    return list(content.tokenize(src))


def test_tokens():
    assert kinds(b"(a(b)\\)\\n\\101\\\n) <4 1 4> /F1 [ -1.5 .5 ] << >> % c\nTj") == [("str", b"a(b))\nA"), ("str", b"A@"), ("name", "F1"), ("mark", "["), ("number", -1.5), ("number", 0.5), ("mark", "]"), ("mark", "<<"), ("mark", ">>"), ("op", "Tj")]


@pytest.mark.parametrize("src", [b"(a", b"<41", b"<4G>", b"BI x", b"1.2.3 Td", b"- Td"])
def test_token_errors(src):
    with pytest.raises(content.ContentError):
        kinds(src)


def test_drawn():
    src = b"(lost) Tj /F1 12 Tf 1 0 0 1 10 700 Tm (a) Tj 5 -10 Td [(b) -20 (c)] TJ 9 Td (d) '"
    assert list(content.drawn(src)) == [(0, 10.0, 700.0, "F1", b"a"), (1, 15.0, 690.0, "F1", b"b"), (2, 15.0, 690.0, "F1", b"c"), (3, 15.0, 690.0, "F1", b"d")]


def test_a_page_from_bytes_to_lines(spark):
    src = b"/F2 9 Tf 1 0 0 1 10 700 Tm <00030010> Tj /F1 9 Tf 1 0 0 1 60 700 Tm (A\x02) Tj 1 0 0 1 300 700 Tm (B) Tj /F9 1 Tf (x) Tj"
    pages = spark.createDataFrame([("b", 1, 400.0, bytearray(src))], "book string, page int, width double, content binary")
    one = "beginbfchar <41> <0041> <42> <0000> endbfchar"
    fonts = spark.createDataFrame([(1, "F2", True, "han", ALL_FORMS), (1, "F1", False, "italic", one), (1, "F3", False, "bold", None)], "page int, font string, two_byte boolean, style string, cmap string")
    runs, unmapped = content.render(content.shown_strings(pages), fonts, font_codes(fonts))
    lines = group_lines(runs).orderBy("line_no").collect()
    assert [(r.column, r.text, [tuple(s) for s in r.segments]) for r in lines] == [("left", "AaA", [("han", "Aa"), ("italic", "A")])]
    # A destination of NUL is no text.
    assert sorted((r.font, r.code) for r in unmapped.collect()) == [("F1", 2), ("F1", 0x42)]
    assert [tuple(r) for r in content.unmapped_report(unmapped).collect()] == [(2, 1, 1), (0x42, 1, 1)]


def test_versions_stop_the_read(spark, tmp_path):
    good = {"schema_version": 2, "pdf_page": 1, "width": 10.0, "lines": [{"column": "left", "y": 1.0, "segments": [{"style": "bold", "text": "x"}, {"style": "han", "text": "y"}]}], "unmapped": [{"font": "F", "code": 7}]}
    (tmp_path / "p.jsonl").write_text(json.dumps(good))
    lines, unmapped = files.page_lines(files.read_pages(spark, str(tmp_path / "p.jsonl")))
    assert lines.head().text == "xy" and unmapped.head().code == 7
    (tmp_path / "q.jsonl").write_text(json.dumps(good | {"schema_version": 1}))
    with pytest.raises(Exception, match="record version"):
        files.read_pages(spark, str(tmp_path / "q.jsonl")).collect()


def test_page_records_round_trip(spark, tmp_path):
    segments = "array<struct<style:string,text:string>>"
    lines = spark.createDataFrame([(1, 1, "left", 5.0, [("bold", "b")]), (1, 0, "left", 9.5, [("han", "a"), ("bold", "c")])], f"page int, line_no int, column string, y double, segments {segments}")
    unmapped = spark.createDataFrame([(2, "F", 7)], "page int, font string, code int")
    widths = spark.createDataFrame([(1, 10.5), (2, 11.0)], "page int, width double")
    records = files.page_records(lines, unmapped, widths)
    files.write_json(records, str(tmp_path / "pages"), ["pdf_page"])
    back = files.read_pages(spark, str(tmp_path / "pages"))
    again, codes = files.page_lines(back)
    assert [(r.page, r.line_no, r.y, r.text) for r in again.orderBy("line_no").collect()] == [(1, 0, 9.5, "ac"), (1, 1, 5.0, "b")]
    assert [(r.page, r.font, r.code) for r in codes.collect()] == [(2, "F", 7)]
    assert tuple(files.extraction_report(back).head()) == (2, 1, 2, 1, 1)


def test_reports(spark, tmp_path):
    from glosswork.operators import gates

    report = gates.gate_row(gates.one_row(spark, 1), 2, 1, "x").unionByName(gates.gate_row(gates.one_row(spark, 0), 1, 0))
    mark = gates.fingerprint("a\n".encode())
    files.write_report(report, str(tmp_path / "g.json"), "book", mark)
    back, found = files.read_report(spark, str(tmp_path / "g.json"))
    assert found == mark and [(r.gate, r.status, r.note) for r in back.orderBy("gate").collect()] == [(1, "green", ""), (2, "green", "x")]
    (tmp_path / "h.json").write_text(json.dumps({"version": 9}))
    with pytest.raises(ValueError, match="version 9"):
        files.read_report(spark, str(tmp_path / "h.json"))


def test_dossier_round_trip(spark, tmp_path):
    path = str(tmp_path / "d.toml")
    rows = spark.createDataFrame([(0, "k1", 'a "q" \\ \n', 5), (1, "k2", "b", 6)], "row_no int, key string, text string, page int")
    assert files.write_dossier(rows, path, "row", "# head", ["text", "page"]) == 0
    signed = (tmp_path / "d.toml").read_text().replace('verified_by = ""', 'verified_by = "me"', 1)
    (tmp_path / "d.toml").write_text(signed)
    (tmp_path / ".d.toml.crc").unlink(missing_ok=True)
    assert files.write_dossier(rows, path, "row", "# head", ["text", "page"]) == 1
    (tmp_path / ".d.toml.crc").unlink(missing_ok=True)
    back = files.read_dossier(spark, path, "row", "key string, text string, page int, verified_by string").orderBy("row_no").collect()
    assert [tuple(r) for r in back] == [(0, "k1", 'a "q" \\ \n', 5, "me"), (1, "k2", "b", 6, "")]
    assert files.read_dossier(spark, path, "other", "key string").count() == 0


def test_spreadsheet(spark, tmp_path):
    main = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    rel = 'xmlns:r="http://schemas.openxmlformats.org/officeDocument/2006/relationships"'
    with zipfile.ZipFile(tmp_path / "i.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {main} {rel}><sheets><sheet name="x" r:id="r1"/><sheet name="I" r:id="r2"/></sheets></workbook>')
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships"><Relationship Id="r1" Target="worksheets/a.xml"/><Relationship Id="r2" Target="worksheets/b.xml"/></Relationships>')
        z.writestr("xl/sharedStrings.xml", f"<sst {main}><si><t>glyph</t></si><si><t> 阿 </t></si><si><r><t>A,</t></r><r><t>Ả</t></r></si></sst>")
        z.writestr("xl/worksheets/b.xml", f'<worksheet {main}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="B1" t="s"><v>0</v></c></row><row><c r="A2" t="s"><v>1</v></c><c r="B2" t="s"><v>2</v></c></row><row><c r="A3" t="inlineStr"><is><t>乙</t></is></c></row></sheetData></worksheet>')
    assert [tuple(r) for r in files.read_index_xlsx(spark, str(tmp_path / "i.xlsx"), "I").collect()] == [(1, "阿", "A,Ả")]
    with pytest.raises(ValueError, match="no sheet"):
        files.read_index_xlsx(spark, str(tmp_path / "i.xlsx"), "J")


def test_replacement_is_all_or_nothing(spark, tmp_path):
    root = str(tmp_path / "store")
    files.replace_tables({"a": spark.range(3), "b": spark.range(1)}, root)
    bad = spark.range(2).select(F.raise_error(F.lit("no")).cast("int").alias("id"))
    with pytest.raises(Exception, match="no"):
        files.replace_tables({"a": spark.range(9), "b": bad}, root)
    assert files.open_tables(spark, root, ["a"])["a"].count() == 3
    files.replace_tables({"a": spark.range(9)}, root)
    assert files.open_tables(spark, root, ["a"])["a"].count() == 9


def test_shards(spark, tmp_path):
    entries = spark.range(1, 251).select(F.col("id").cast("int").alias("seq"), F.concat(F.lit("r"), "id").alias("reading"))
    files.write_shards(entries, str(tmp_path / "s"))
    assert [r.seq for r in files.read_shard(spark, str(tmp_path / "s"), 2, "seq int, reading string").orderBy("seq").collect()] == list(range(201, 251))
    assert sorted(p.name for p in (tmp_path / "s").glob("shard=*")) == ["shard=0", "shard=1", "shard=2"]
    assert json.loads(files.api_rows(entries.where("seq = 1")).head().json) == {"seq": 1, "reading": "r1"}


def test_settings():
    s = settings.load("export GLOSSWORK_DATA='x'\n# c\n\nGLOSSWORK_PAGE_SIZE=5\nGLOSSWORK_PASSWORD=hush", {"GLOSSWORK_PAGE_SIZE": "7", "GLOSSWORK_LOG": " "})
    assert (s["GLOSSWORK_DATA"], s.count("GLOSSWORK_PAGE_SIZE"), s["GLOSSWORK_LOG"]) == ("x", 7, "info")
    assert s.scrub("at hush:") == "at ***:"
    for text in ("", "GLOSSWORK_DATA=x\nGLOSSWORK_PAGE_SIZE=0", "no equals"):
        with pytest.raises(settings.SettingsError):
            settings.load(text, {})
    assert io.StringIO("").read() == ""


def test_size_report(spark, tmp_path):
    import gzip

    data = {"index.json": b"a" * 5000, "shard=0/part-0.json": b"b" * 300, "shard=1/part-0.json": bytes(range(256)), "extra/x.json": b"c"}
    for name, body in data.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(body)
    packed = {n: len(gzip.compress(b, 9)) for n, b in data.items()}
    shards = [packed[n] for n in data if n.startswith("shard=")]
    got = {r.part: tuple(r)[1:] for r in files.size_report(spark, str(tmp_path)).collect()}
    assert got == {
        "index.json": (1, 5000, packed["index.json"], packed["index.json"]),
        "shards": (2, 556, sum(shards), max(shards)),
        "extra": (1, 1, packed["extra/x.json"], packed["extra/x.json"]),
        "total": (4, 5557, sum(packed.values()), max(packed.values())),
    }
