"""Text and domain functions against plain Python."""

import unicodedata

import pytest
from pyspark.sql import functions as F

from glosswork.functions import domain as D
from glosswork.functions import text as T


def column(spark, values, f, kind="string"):
    rows = [(i, v) for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, f"i int, v {kind}")
    return [r.x for r in df.select("i", f(F.col("v")).alias("x")).orderBy("i").collect()]


def test_fold_drops_marks_and_tells_d_with_stroke(spark):
    words = ["Lõm", "Lôm", "Lốm", "Lồm", "Lỗm", "Ẩm", "Ượt", "Đại", "đ", "Lõm", None, ""]
    assert column(spark, words, T.fold) == ["lom"] * 5 + ["am", "uot", "dai", "d", "lom", None, ""]


def test_fold_equals_unicode_data(spark):
    chars = [chr(c) for c in range(0xC0, 0x2000) if unicodedata.category(chr(c)).startswith("L")]
    # Marks of other scripts stay as they are; composed or not is the same text.
    assert [unicodedata.normalize("NFD", x) for x in column(spark, chars, T.fold)] == [unicodedata.normalize("NFD", T.fold_text(c)) for c in chars]


def test_trim_knows_every_white_space(spark):
    assert column(spark, ["  a b　", "\t\n", "x"], T.trim) == ["a b", "", "x"]
    assert column(spark, ["a   b\nc"], T.squeeze) == ["a b c"]
    assert column(spark, [" a b ", None], T.visible_length) == [2, None]


def test_slug_stem(spark):
    assert column(spark, ["  A  di   đà  ", "Lõm", "--", "x'y"], T.slug_stem) == ["a-di-da", "lom", "", "x-y"]


def test_nfc(spark):
    assert column(spark, ["Lõm", None], T.nfc) == ["Lõm", None]


def test_join_text(spark):
    df = spark.createDataFrame([("a", "b"), ("", "b"), ("a", ""), ("a ", "b")], "l string, r string")
    assert [r.x for r in df.select(T.join_text(F.col("l"), F.col("r")).alias("x")).collect()] == ["a b", "b", "a", "a b"]


def test_numbers_dates_and_addresses(spark):
    assert column(spark, [7, 1234, 1234567], T.thousands, "long") == ["7", "1.234", "1.234.567"]
    assert [str(x) for x in column(spark, [0, 59, 20000], T.civil_date, "int")] == ["1970-01-01", "1970-03-01", "2024-10-04"]
    assert column(spark, ["a b*~é"], T.percent_encode) == ["a%20b%2A~%C3%A9"]


def test_placeholders(spark):
    assert column(spark, ["a ― b", "a--b", "a-b", "a|", "–"], T.has_placeholder) == [True, True, False, True, True]
    assert column(spark, ["― gươm--x |"], T.form_parts) == [["―", " gươm", "--", "x ", "|"]]


@pytest.mark.parametrize(("form", "reading", "value", "n", "residual"), [("― gươm", "Lõm", "Lõm gươm", 1, 0), ("Chính giữa ―", "Lõm", "Chính giữa Lõm", 1, 0), ("-- a-b ―", "$1\\", "$1\\ a-b $1\\", 2, 0), ("| x", "A", "| x", 0, 1), ("―――", "A", "AAA", 3, 0)])
def test_expand_reading(spark, form, reading, value, n, residual):
    df = spark.createDataFrame([(form, reading)], "f string, r string")
    assert tuple(df.select(T.expand_reading(F.col("f"), F.col("r")).alias("x")).head().x) == (value, n, residual)


def test_expand_han(spark):
    df = spark.createDataFrame([("| 意", "阿"), ("| 意", None)], "f string, g string")
    assert [r.x for r in df.select(T.expand_han(F.col("f"), F.col("g")).alias("x")).collect()] == ["阿 意", None]


def test_wiki_text(spark):
    cases = {
        "a {{SIC|b|c}} d": "a b d",
        "a {{x|b}} d": "a d",
        "[[p|q]] and [[r]]": "q and r",
        "''i'' and '''b''' it's": "i and b it's",
        "a<br/>b <ref name=x>c</ref>": "ab c",
        "{{unclosed": "{{unclosed",
        "a > b": "a b",
    }
    assert column(spark, list(cases), T.wiki_plain) == list(cases.values())
    assert column(spark, ["a |- b ― c"], T.placeholder_key) == ["a @ b @ c"]
    assert column(spark, ["«Ạ», (B)! - c."], T.witness_fold) == ["ạ b @ c"]


def test_witness_glyphs(spark):
    fields = ["𣑕", "{{?|trên:壯, dưới:卵}}", "", "⿰木", "", "ab"]
    assert column(spark, fields, T.unicode_glyph) == ["𣑕", None, None, None, None, None]
    assert column(spark, fields, T.shape_note) == [None, "trên:壯, dưới:卵", None, None, None, None]


def test_letters(spark):
    readings = ["Đại", "da", "ăn", "Ích", "ỷ", "Êm", "Z", "", "Ư"]
    assert column(spark, readings, D.letter_of) == ["Đ", "D", "A", "Y", "Y", "E", None, None, "U"]
    assert column(spark, ["A", "Đ", "Y", "X", "W"], D.letter_rank) == [0, 4, 8, 21, None]
    assert column(spark, ["Đ", "A"], D.letter_name) == ["dd", "a"]


def test_pages(spark):
    assert column(spark, [1, 2, 3, 9, 10, 11, 1038, 1039], D.printed_page, "int") == [None, None, 3, 9, None, 10, 1037, None]
    every = list(range(1, 1039))
    addresses = column(spark, every, D.page_address, "int")
    assert len(set(addresses)) == 1038 and column(spark, addresses, D.page_of_address) == every
    assert column(spark, ["pdf-11", "010", "2", "x"], D.page_of_address) == [None] * 4


def test_glyph_kinds_styles_and_scripts(spark):
    assert column(spark, ["阿", "𨇣", "", "\U000f0001", None], D.glyph_kind) == ["bmp", "ext_b", "pua", "pua", "image_only"]
    assert column(spark, ["ABCDEF+UnBatang#20Bold", "X+Times,Italic", "A-BoldOblique", "Times-Bold", "Times"], D.font_style) == ["han", "italic", "italic", "bold", "regular"]
    assert column(spark, ["Lõm", "惡", "a𨇣"], D.is_han_nom) == [False, True, True]
    assert column(spark, ["CHỮ A", "Chữ", "12", "A" * 41], D.is_heading) == [True, False, False, False]


def test_labels(spark):
    df = spark.createDataFrame([(["c.", "n."],)], "l array<string>")
    assert df.select(D.pos_names(F.col("l")).alias("x")).head().x == ["chu_nho", "chu_nom"]
    bad = spark.createDataFrame([(["z."],)], "l array<string>")
    with pytest.raises(Exception, match="unknown label"):
        bad.select(D.pos_names(F.col("l")).alias("x")).collect()
