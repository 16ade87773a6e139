"""Text functions on columns. White space means Unicode white space throughout.

Spark's ``trim`` strips only U+0020 and Java's ``\\s`` is ASCII, so patterns carry ``(?U)``.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: A space that only ``(?U)`` patterns recognise.
SPACE = r"(?U)\s"


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is evaluated once, however often the body names it."""
    return F.get(F.transform(F.array(value), lambda x: body(x)), F.lit(0))


def trim(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)^\s+|\s+\z", "")


def rtrim(c: Column) -> Column:
    return F.regexp_replace(c, r"(?U)\s+\z", "")


def squeeze(c: Column) -> Column:
    """Trim, and turn each run of white space into one space."""
    return trim(F.regexp_replace(c, r"(?U)\s+", " "))


def is_blank(c: Column) -> Column:
    return ~c.rlike(r"(?U)\S")


def visible_length(c: Column) -> Column:
    """Code points that are not white space."""
    return F.length(F.regexp_replace(c, r"(?U)\s+", ""))


@lru_cache(maxsize=1)
def accent_table() -> tuple[str, str]:
    """Single characters whose canonical decomposition is one character plus marks U+0300..U+036F, and that character.

    Generated from the Unicode data of the running Python.
    """
    src, dst = [], []
    for code in range(0xC0, 0x2000):
        char = chr(code)
        bare = "".join(x for x in unicodedata.normalize("NFD", char) if not "̀" <= x <= "ͯ")
        if len(bare) == 1 and bare != char:
            src.append(char)
            dst.append(bare)
    return "".join(src) + "đĐ", "".join(dst) + "dD"


def fold(c: Column) -> Column:
    """The search key: marks removed, đ to d, lower case."""
    src, dst = accent_table()
    return F.lower(F.translate(F.regexp_replace(c, "[̀-ͯ]", ""), src, dst))


def fold_text(s: str) -> str:
    """The same key for a Python string, such as a query."""
    bare = "".join(x for x in unicodedata.normalize("NFD", s) if not "̀" <= x <= "ͯ")
    return bare.replace("đ", "d").replace("Đ", "D").lower()


def nfc(c: Column) -> Column:
    """Canonical composition; Spark has no built-in, so an Arrow function is used, once, at ingest."""
    return F.pandas_udf(_compose, "string")(c)


def _compose(s: pd.Series) -> pd.Series:
    return s.map(lambda x: None if x is None else unicodedata.normalize("NFC", x))


def slug_stem(c: Column) -> Column:
    """Folded text with runs outside a-z and 0-9 as single hyphens, none at the ends."""
    return F.regexp_replace(F.regexp_replace(fold(c), "[^a-z0-9]+", "-"), "^-|-$", "")


def join_text(left: Column, right: Column) -> Column:
    """One space between, unless either is empty or the left ends in white space."""
    return F.when(right == "", left).when((left == "") | left.rlike(r"(?U)\s\z"), F.concat(left, right)).otherwise(F.concat_ws(" ", left, right))


def join_ordered(parts: Column) -> Column:
    """``join_text`` over an array of trimmed texts."""
    return F.array_join(F.filter(parts, lambda x: x != ""), " ")


def percent_encode(c: Column) -> Column:
    """RFC 3986: unreserved characters stay."""
    out = F.url_encode(c)
    return F.replace(F.replace(F.replace(out, F.lit("+"), F.lit("%20")), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def thousands(c: Column) -> Column:
    """Dots between groups of three digits."""
    return F.regexp_replace(c.cast("string"), r"\B(?=(\d{3})+$)", ".")


def civil_date(days: Column) -> Column:
    """The date so many days after 1970-01-01."""
    return F.date_add(F.lit("1970-01-01").cast("date"), days)


# Marks that stand for a repeated headword.
GLYPH_MARK = "|"
READING_MARKS = "―—–"
MARK_PAIR = "--"


def has_placeholder(c: Column) -> Column:
    """Any placeholder mark, or two hyphens; one hyphen is none."""
    return c.rlike(r"[―—–|]|--")


def form_parts(c: Column) -> Column:
    """The form cut into placeholder marks and the text between them, in order."""
    return F.regexp_extract_all(c, F.lit(r"--|[―—–|]|(?:(?!--)[^―—–|])+"), F.lit(0))


def expand_reading(form: Column, reading: Column) -> Column:
    """struct(value, substitutions, residual): reading marks replaced by the reading as it is."""
    def made(pieces: Column, value: Column) -> Column:
        return F.struct(value.alias("value"), (F.size(pieces) - 1).alias("substitutions"), (F.length(value) - F.length(F.replace(value, F.lit("|"), F.lit("")))).alias("residual"))

    # The reading is no replacement pattern: it may hold any character.
    joined = lambda pieces: F.replace(F.array_join(pieces, "\x00"), F.lit("\x00"), reading)
    return let(F.split(form, "--|[―—–]", -1), lambda pieces: let(joined(pieces), lambda value: made(pieces, value)))


def expand_han(form: Column, glyph: Column) -> Column:
    """The form with ``|`` replaced by the glyph; null where the entry has no glyph."""
    return F.replace(form, F.lit("|"), glyph)


def count_marks(c: Column, marks: str) -> Column:
    return F.length(c) - F.length(F.translate(c, marks, ""))


# --- wikitext -----------------------------------------------------------------


def wiki_plain(c: Column) -> Column:
    """Markup removed: templates go, but the first argument of SIC stays; links show their last part; tags and quote runs go."""
    out = F.regexp_replace(c, r"(?is)\{\{\s*sic\s*\|([^|}]*(?:\}(?!\})[^|}]*)*)(?:\|.*?)?\}\}", "\x01$1\x02")
    out = F.regexp_replace(out, r"(?s)\{\{.*?\}\}", "")
    out = F.regexp_replace(out, r"(?U)\x01\s*|\s*\x02", "")
    out = F.regexp_replace(out, r"(?s)\[\[(?:(?!\]\]).)*?([^|\[\]]*)\]\]", "$1")
    out = F.regexp_replace(out, r"(?s)<[^>]*(?:>|\z)|>", "")
    return squeeze(F.regexp_replace(out, "'{2,}", ""))


def placeholder_key(c: Column) -> Column:
    """Plain text with each run of marks and hyphens as one ``@``."""
    return squeeze(F.regexp_replace(wiki_plain(c), r"[|―—–-]+", "@"))


def witness_fold(c: Column) -> Column:
    """The comparison key of two editions: marks as ``@``, punctuation as spaces, lower case; accents stay."""
    return squeeze(F.lower(F.translate(placeholder_key(c), ".,;:!?()\"'«»", " " * 12)))


def shape_note(c: Column) -> Column:
    """What stands after the first bar inside ``{{ }}``; null without such a note."""
    note = trim(F.regexp_replace(F.regexp_extract(c, r"(?s)\{\{(.*?)\}\}", 1), r"(?s)^[^|]*\|", ""))
    return F.when(c.rlike(r"(?s)\{\{.*?\}\}") & (note != ""), note)


def unicode_glyph(c: Column) -> Column:
    """The field if it is one character, neither private use nor a description character."""
    own = trim(c)
    special = r"[\x{E000}-\x{F8FF}\x{F0000}-\x{FFFFD}\x{100000}-\x{10FFFD}\x{2FF0}-\x{2FFF}]"
    return F.when((F.length(own) == 1) & ~own.rlike(special), own)
