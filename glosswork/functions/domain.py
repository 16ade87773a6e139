"""Domain rules of the dictionary: letters, labels, glyph kinds, pages, styles, scripts."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from glosswork.functions.text import accent_table, trim

# The 22 letters in printed order, and their names in storage.
LETTERS = "A B C D Đ E G H Y K L M N O P Q R S T U V X".split()
LETTER_NAMES = ["dd" if x == "Đ" else x.lower() for x in LETTERS]
# Part-of-speech labels in print, in storage, and the order in which they are tried.
POS = {"c.": "chu_nho", "n.": "chu_nom", "cn.": "chu_nho_dung_nom"}
LABELS = ("cn.", "c.", "n.")
GLYPH_KINDS = ("bmp", "ext_b", "pua", "image_only")
STYLES = ("regular", "italic", "bold", "han")
# The page range of the source and its body.
LAST_PAGE, BODY_PAGE, LAST_PRINTED = 1038, 11, 1037

#: Characters that open a headword: everything the kind calls other than ``bmp``, and the unified and compatibility blocks.
GLYPH_CLASS = r"\x{3400}-\x{9FFF}\x{F900}-\x{FAFF}\x{E000}-\x{F8FF}\x{20000}-\x{3FFFF}\x{F0000}-\x{10FFFD}"
#: Characters of the Han column.
HAN_CLASS = r"\x{2E80}-\x{2FDF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3134F}"
#: Characters that make a query a glyph query.
HAN_NOM = r"[\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}\x{E000}-\x{F8FF}\x{F0000}-\x{10FFFD}]"


def _lookup(keys, values, c: Column) -> Column:
    out = F.lit(None)
    for k, v in zip(reversed(list(keys)), reversed(list(values)), strict=True):
        out = F.when(c == k, F.lit(v)).otherwise(out)
    return out


@lru_cache(maxsize=1)
def initials() -> tuple[str, str]:
    """Every character that folds to a letter, and its letter: one lookup instead of a fold in each branch of a rank."""
    bare = dict(zip(*accent_table(), strict=True))
    out = {}
    for code in range(0x41, 0x2200):
        char = chr(code)
        letter = "Đ" if char in "Đđ" else bare.get(char, char).lower().upper()
        letter = "Y" if letter == "I" else letter
        if letter in LETTERS and letter != char:
            out[char] = letter
    return "".join(out), "".join(out.values())


def letter_of(reading: Column) -> Column:
    """The letter under which a reading stands: Đ is told from D before folding, i and y stand under Y; null if none."""
    src, dst = initials()
    letter = F.translate(F.substring(reading, 1, 1), src, dst)
    return F.when(letter.isin(*LETTERS), letter)


def letter_rank(letter: Column) -> Column:
    """Place in printed order, from 0; null for anything else."""
    return (F.nullif(F.array_position(F.array(*[F.lit(x) for x in LETTERS]), letter), F.lit(0)) - 1).cast("int")


def letter_name(letter: Column) -> Column:
    return _lookup(LETTERS, LETTER_NAMES, letter)


def pos_names(labels: Column) -> Column:
    """Stored names of an ordered label list; unknown labels are an error."""
    return F.transform(labels, lambda x: F.coalesce(_lookup(POS, POS.values(), x), F.raise_error(F.concat(F.lit("unknown label "), x)).cast("string")))


def pos_labels(names: Column, separator: str = " ") -> Column:
    return F.array_join(F.transform(names, lambda x: _lookup(POS.values(), POS, x)), separator)


def glyph_kind(glyph: Column) -> Column:
    """bmp, ext_b or pua by code point; image_only without a glyph."""
    code = F.ascii(glyph)
    pua = ((code >= 0xE000) & (code <= 0xF8FF)) | ((code >= 0xF0000) & (code <= 0x10FFFD))
    return F.when(glyph.isNull(), "image_only").when(pua, "pua").when((code >= 0x20000) & (code <= 0x3FFFF), "ext_b").otherwise("bmp")


def printed_page(pdf_page: Column) -> Column:
    """The number printed on a page: 3 to 9 as counted, one less from 11 on, none on 1, 2 and 10."""
    return F.when(pdf_page.between(3, 9), pdf_page).when(pdf_page.between(BODY_PAGE, LAST_PAGE), pdf_page - 1)


def pdf_page(printed: Column) -> Column:
    """The inverse of ``printed_page``."""
    return F.when(printed.between(3, 9), printed).when(printed.between(10, LAST_PRINTED), printed + 1)


def page_address(page: Column) -> Column:
    """The one spelling of a page in addresses: its printed number, or ``pdf-N`` where it has none."""
    return F.coalesce(printed_page(page).cast("string"), F.concat(F.lit("pdf-"), page.cast("string")))


def page_of_address(address: Column) -> Column:
    """The page of an address; null for other spellings."""
    plain = F.when(address.rlike("^[1-9][0-9]{0,3}$"), address.try_cast("int"))
    bare = F.when(address.rlike("^pdf-[1-9][0-9]{0,3}$"), F.regexp_extract(address, "([0-9]+)$", 1).try_cast("int"))
    bare = F.when(bare.between(1, LAST_PAGE) & printed_page(bare).isNull(), bare)
    return F.coalesce(pdf_page(plain), bare)


# Parts of the names of Han fonts.
HAN_FONTS = ("Nom Na Tong", "NomNaTong", "BabelStone", "ZenKai", "UnBatang")


def font_style(base_font: Column) -> Column:
    """Style by the font's name without its subset prefix; Han fonts are tested first."""
    name = F.regexp_replace(F.replace(base_font, F.lit("#20"), F.lit(" ")), r"(?s)^[^+]*\+", "")
    han = F.lit(False)
    for part in HAN_FONTS:
        han = han | name.contains(part)
    return F.when(han, "han").when(name.contains("Italic") | name.contains("Oblique"), "italic").when(name.contains("Bold"), "bold").otherwise("regular")


def is_han_nom(c: Column) -> Column:
    """Any character of the scripts that send a query to glyph search."""
    return c.rlike(HAN_NOM)


def is_heading(c: Column) -> Column:
    """At most 40 characters, some letter, and no lower-case letter."""
    own = trim(c)
    return (F.length(own) <= 40) & own.rlike(r"\p{IsAlphabetic}") & ~own.rlike(r"\p{IsLowercase}")
