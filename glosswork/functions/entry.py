"""Splitting of headword and sub-entry lines into fields, as column expressions.

A field is cut from the line and trimmed; nothing is guessed. A line that does not have
the shape gives null, and the gates count it.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from glosswork.functions.domain import GLYPH_CLASS, HAN_CLASS
from glosswork.functions.text import fold, is_blank, let, rtrim, trim, visible_length

#: Labels at the end of a line: each follows white space or another label.
LABEL_RUN = r"(?U)((?:(?:(?<=\s)|(?<=[cn]\.))(?:cn|c|n)\.\s*)+)\z"
#: A label inside a line: everything before, the label, everything after.
LABEL_INSIDE = r"(?sU)^(.*(?<=\s))((?:cn|c|n)\.)(?=\s)(.*)\z"
#: Labels at the head of a line, each followed by white space.
LABEL_HEAD = r"(?sU)^\s*((?:(?:cn|c|n)\.\s+)+)(.*)\z"
LABEL = r"(cn|c|n)\."

HEADWORD_TYPE = "struct<glyph:string,image_marker:string,reading:string,alternate:string,labels:array<string>,trailing:string>"


def _labels(run: Column) -> Column:
    return F.regexp_extract_all(run, F.lit(LABEL), F.lit(0))


def _null_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def split_headword(line: Column) -> Column:
    """struct(glyph, image_marker, reading, alternate, labels, trailing), or null if the line is no headword.

    Labels stand at the end; a line that opens with a glyph may instead have its last label before further text.
    """
    opens = line.rlike(rf"(?U)^\s*[{GLYPH_CLASS}]")

    def by_run(own: Column, run: Column) -> Column:
        at_end = run != ""
        middle = F.when(~at_end & opens, F.regexp_extract(line, LABEL_INSIDE, 2)).otherwise(F.lit(""))
        head = F.when(at_end, F.left(own, F.length(own) - F.length(run))).when(opens, F.regexp_extract(line, LABEL_INSIDE, 1))
        trailing = F.when(at_end, F.lit("")).otherwise(trim(F.regexp_extract(line, LABEL_INSIDE, 3)))
        labels = F.when(at_end, _labels(run)).otherwise(F.array(middle))
        good = at_end | ((middle != "") & (trailing != ""))
        return F.when(good, let(head, lambda h: let(trailing, lambda t: _head_fields(h, labels, t))))

    return let(rtrim(line), lambda own: let(F.regexp_extract(own, LABEL_RUN, 1), lambda run: by_run(own, run)))


def _head_fields(head: Column, labels: Column, trailing: Column) -> Column:
    """Glyph, marker, reading and alternate of what stands before the labels; null without a reading."""

    def by_rest(glyph: Column, marker: Column, rest: Column) -> Column:
        # The last opening parenthesis and the first closing one after it.
        alternate = F.regexp_extract(rest, r"(?s)(\([^()]*\))[^(]*\z", 1)
        reading = trim(F.when(alternate != "", F.regexp_extract(rest, r"(?s)^(.*)\([^()]*\)[^(]*\z", 1)).otherwise(rest))
        fields = lambda r: F.struct(
            _null_if_empty(glyph).alias("glyph"),
            _null_if_empty(marker).alias("image_marker"),
            r.alias("reading"),
            _null_if_empty(alternate).alias("alternate"),
            labels.alias("labels"),
            _null_if_empty(trailing).alias("trailing"),
        )
        return let(reading, lambda r: F.when(r != "", fields(r)))

    def after_glyph(glyph: Column, rest: Column) -> Column:
        marker = F.regexp_extract(rest, r"(?U)^\s*(\*+)", 1)
        return let(marker, lambda m: let(F.when(m != "", F.regexp_replace(rest, r"(?U)^\s*\*+", "")).otherwise(rest), lambda r: by_rest(glyph, m, r)))

    glyph = F.regexp_extract(head, rf"(?U)^\s*([{GLYPH_CLASS}])", 1)
    return let(glyph, lambda g: let(F.when(g != "", F.regexp_replace(head, rf"(?U)^\s*[{GLYPH_CLASS}]", "")).otherwise(head), lambda r: after_glyph(g, r)))


def split_continued(line: Column) -> Column:
    """struct(labels, definition) of a line that opens with labels, or null."""
    labels = F.regexp_extract(line, LABEL_HEAD, 1)
    return F.when(labels != "", F.struct(_labels(labels).alias("labels"), _null_if_empty(trim(F.regexp_extract(line, LABEL_HEAD, 2))).alias("definition")))


def has_stray_label(reading: Column) -> Column:
    """A word of the reading that is a label but for its dot."""
    return reading.rlike(r"(?U)(?:^|\s)(?:cn|c|n)\.*(?=\s|\z)")


def gloss_initial(labels: Column, gloss: Column) -> Column:
    """struct(letter, dropped) where the last of several labels is really the lost capital of a gloss that opens in lower case."""
    last = F.element_at(labels, -1)
    opening = F.substring(trim(gloss), 1, 1)
    letter = F.substring(last, 1, 1)
    pair = F.concat(letter, F.substring(fold(opening), 1, 1))
    onset = pair.rlike("^.[aeiouy]$") | pair.isin("ch", "gh", "gi", "kh", "ng", "nh", "ph", "qu", "th", "tr")
    good = (F.size(labels) >= 2) & (F.length(last) == 2) & opening.rlike(r"\p{IsLowercase}") & onset
    return F.when(good, F.struct(F.upper(letter).alias("letter"), last.alias("dropped")))


def repair_gloss(labels: Column, gloss: Column) -> Column:
    """struct(labels, gloss) after ``gloss_initial``: every label equal to the dropped one goes."""
    fix = gloss_initial(labels, gloss)
    return F.when(fix.isNotNull(), F.struct(F.array_remove(labels, fix["dropped"]).alias("labels"), F.concat(fix["letter"], gloss).alias("gloss"))).otherwise(F.struct(labels.alias("labels"), gloss.alias("gloss")))


# --- styled segments ----------------------------------------------------------


def line_text(segments: Column) -> Column:
    return F.array_join(F.transform(segments, lambda s: s["text"]), "")


def is_italic_content(segment: Column) -> Column:
    return (segment["style"] == "italic") & ~is_blank(segment["text"])


def has_italic(segments: Column) -> Column:
    return F.exists(segments, is_italic_content)


def leading_style(segments: Column) -> Column:
    """Style of the first segment with content; null without one."""
    return F.try_element_at(F.filter(segments, lambda s: ~is_blank(s["text"])), F.lit(1))["style"]


def _joined(segments: Column, first: Column, count: Column) -> Column:
    return line_text(F.slice(segments, first, count))


def split_sub_entry(segments: Column) -> Column:
    """struct(han_form, form, definition, italic_segments), or null without italic content.

    The form starts with the first italic content and ends with the last. Han characters, bars, commas and spaces at its
    head go back to the Han column if a bar is among them; a full stop right after it belongs to it if text follows.
    """

    def by_place(first: Column, last: Column) -> Column:
        before = _joined(segments, F.lit(1), first - 1)
        middle = _joined(segments, first, last - first + 1)
        after = _joined(segments, last + 1, F.greatest(F.size(segments) - last, F.lit(0)))
        return let(before, lambda b: let(middle, lambda m: let(after, lambda a: by_text(b, m, a))))

    def by_text(before: Column, middle: Column, after: Column) -> Column:
        lead = F.regexp_extract(middle, rf"(?U)^[|,\s{HAN_CLASS}]*", 0)
        moved = let(lead, lambda x: F.when(x.contains("|") & (F.length(x) < F.length(middle)), x).otherwise(F.lit("")))
        stop = F.regexp_extract(after, r"(?sU)^(\s*\.)(?=.*\S)", 1)
        return let(moved, lambda m: let(stop, lambda s: fields(before, middle, after, m, s)))

    def fields(before: Column, middle: Column, after: Column, moved: Column, stop: Column) -> Column:
        han = trim(F.concat(before, moved))
        form = trim(F.concat(F.substr(middle, F.length(moved) + 1), stop))
        definition = trim(F.substr(after, F.length(stop) + 1))
        start = F.length(before) + F.length(moved)
        counted = F.aggregate(
            segments,
            F.struct(F.lit(0).alias("at"), F.lit(0).alias("n")),
            lambda acc, s: F.struct((acc["at"] + F.length(s["text"])).alias("at"), (acc["n"] + (is_italic_content(s) & (acc["at"] + F.length(s["text"]) > start)).cast("int")).alias("n")),
        )["n"]
        made = lambda f: F.struct(_null_if_empty(han).alias("han_form"), f.alias("form"), _null_if_empty(definition).alias("definition"), counted.alias("italic_segments"))
        return let(form, lambda f: F.when(f != "", made(f)))

    # Null without italic content, and then so is all that follows.
    marks = F.transform(segments, is_italic_content)
    first = F.nullif(F.array_position(marks, F.lit(True)), F.lit(0)).cast("int")
    last = (F.size(segments) - F.nullif(F.array_position(F.reverse(marks), F.lit(True)), F.lit(0)) + 1).cast("int")
    return let(first, lambda x: let(last, lambda y: F.when(x.isNotNull(), by_place(x, y))))


def covered_length(*fields: Column) -> Column:
    """Visible characters in fields that do not overlap."""
    out = F.lit(0)
    for f in fields:
        out = out + F.coalesce(visible_length(f), F.lit(0))
    return out
