"""Roles of printed lines: one ordered cascade, first match wins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glosswork.functions.domain import BODY_PAGE, GLYPH_CLASS
from glosswork.functions.entry import has_italic
from glosswork.functions.text import has_placeholder, trim

# Heights of running head and page number, their tolerance, and section titles.
HEAD_Y, FOOT_Y, TOLERANCE = 797.89, 25.89, 0.005
BOOK_TITLE, SECTION = "ĐẠI NAM QUẤC ÂM TỰ VỊ", "CHỮ "
ROLES = ("running_head", "page_number", "section_title", "headword", "continued_headword", "sub_entry", "continuation")
CONTENT = ("headword", "continued_headword", "sub_entry", "continuation")

#: A run of labels ends the text; what precedes the first of them is neither label nor word.
ENDS_WITH_LABELS = r"(?sU)^(?:.*\S)?(?<![cn]\.)(?:\s+(?:cn\.|c\.|n\.)+)+\s*\z"
STARTS_WITH_LABEL = r"(?U)^\s*(?:cn|c|n)\.\s"
GLYPH_AND_LABEL = rf"(?sU)^\s*[{GLYPH_CLASS}].*(?<=\s)(?:cn|c|n)\.(?:\s|\z)"


def ends_with_labels(c: Column) -> Column:
    return c.rlike(ENDS_WITH_LABELS)


def starts_with_label(c: Column) -> Column:
    return c.rlike(STARTS_WITH_LABEL)


def glyph_and_label(c: Column) -> Column:
    return c.rlike(GLYPH_AND_LABEL)


def line_role(y: Column, text: Column, body: Column, italic: Column) -> Column:
    own = trim(text)
    title = (own == BOOK_TITLE) | (own.startswith(SECTION) & (F.length(own) <= len(SECTION) + 1))
    return (
        F.when(body & (F.abs(y - HEAD_Y) < TOLERANCE), "running_head")
        .when(F.abs(y - FOOT_Y) < TOLERANCE, "page_number")
        .when(title, "section_title")
        .when(ends_with_labels(own) | glyph_and_label(own), "headword")
        .when(starts_with_label(own), "continued_headword")
        .when(italic & has_placeholder(own), "sub_entry")
        .otherwise("continuation")
    )


def sub_entry_signal(italic: Column, placeholder: Column) -> Column:
    return F.when(italic & placeholder, "both").when(italic, "italic_only").when(placeholder, "placeholder_only").otherwise("neither")


def is_content(role: Column) -> Column:
    return role.isin(*CONTENT)


def classify(lines: DataFrame) -> DataFrame:
    """``lines`` with ``role``, ``signal`` and ``ambiguous``."""
    italic, own = has_italic(F.col("segments")), trim(F.col("text"))
    signal = sub_entry_signal(italic, has_placeholder(own))
    return lines.withColumns({"role": line_role(F.col("y"), F.col("text"), F.col("page") >= BODY_PAGE, italic), "signal": signal}).withColumn("ambiguous", (F.col("signal") == "placeholder_only") & is_content(F.col("role")))
