"""From page records to checked tables: classify, assemble, split, gate, build, load."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glosswork.functions.domain import BODY_PAGE, LAST_PAGE, glyph_kind, is_heading, letter_name, letter_of, printed_page
from glosswork.functions.text import fold, is_blank, join_ordered, slug_stem, trim
from glosswork.operators import assemble as A
from glosswork.operators import gates as G
from glosswork.operators.dossier import by_page_range, signed, unowned
from glosswork.operators.lines import FOOT_Y, HEAD_Y, TOLERANCE, classify
from glosswork.operators.search import search_document
from glosswork.store import Scratch

#: Entries that one window sees where a whole book is compared in order.
PLACES = 5000


class Parsed:
    """A parsed book: ``lines``, ``entries``, ``subs``, ``readings`` and ``fields``.

    Each stage is read by several later ones, so it is written to shared storage once, when it is first asked for.
    """

    def __init__(self, lines: DataFrame, readings: DataFrame, leaf: str = "page"):
        self._scratch, self._given, self._leaf = Scratch(lines.sparkSession, "parse"), readings, leaf
        self.lines = self._scratch.write(A.assemble(classify(lines), leaf=leaf), "staged")

    @cached_property
    def _entries(self) -> DataFrame:
        return self._scratch.write(A.entries_of(self.lines, leaf=self._leaf), "entries")

    @cached_property
    def _subs(self) -> DataFrame:
        return self._scratch.write(A.sub_entries(self.lines, self._entries, leaf=self._leaf), "subs")

    @cached_property
    def entries(self) -> DataFrame:
        return A.read_entries(self._entries, self._given).withColumn("seq", F.col("entry_no").cast("int"))

    @cached_property
    def subs(self) -> DataFrame:
        return A.read_subs(self._entries, self._subs, self._given).withColumn("seq", F.col("entry_no").cast("int"))

    @cached_property
    def readings(self) -> DataFrame:
        return A.found_readings(self._entries, self._subs, self._given)

    @cached_property
    def fields(self) -> DataFrame:
        return G.line_fields(self.lines)


def parse_book(lines: DataFrame, readings: DataFrame, *, leaf: str = "page") -> Parsed:
    """Lines (book, page, line_no, y, segments, text) to entries and sub-entries with ``seq`` in book order.

    ``readings``: (page, row_no, was, now, verified_by), applied after wrapped forms are joined. ``leaf`` orders the pages.
    """
    return Parsed(lines, readings, leaf)


def parse_gates(parsed: Parsed, unmapped: DataFrame, label_typos: int, coverage_typos: int) -> DataFrame:
    """Gates 1, 2, 3 and 8; what is allowed is the number of dossier rows."""
    return (
        G.gate_row(G.unmapped_codes(unmapped), 1, 0)
        .unionByName(G.gate_row(G.headword_coverage(parsed.fields), 2, label_typos))
        .unionByName(G.gate_row(G.conservation(parsed.fields), 3, coverage_typos))
        .unionByName(G.gate_row(G.scan_gate(parsed.readings), 8, 0))
    )


def reconcile_gates(entries: DataFrame, index: DataFrame, missing: DataFrame, differing: DataFrame, texts: DataFrame, errata: DataFrame) -> DataFrame:
    """Gates 4, 5 and 7. ``entries`` has book, seq, reading, glyph and gloss."""
    verdicts = G.reconcile_index(entries, index)
    placed = entries.withColumn("_place", F.floor(F.col("seq") / PLACES))
    faults = G.collation_faults(placed, ["book"], "seq", page="_place").agg(F.count("*").alias("measured"))
    return (
        G.gate_row(G.index_gate(verdicts, missing, differing), 4, 0)
        .unionByName(G.gate_row(faults, 5, 0))
        .unionByName(G.gate_row(G.errata_gate(G.errata_verdicts(entries, texts, errata)), 7, 0))
    )


def mint_slugs(entries: DataFrame, stem: str = "reading", order: str = "seq") -> DataFrame:
    """``entries`` with ``slug``: the n-th entry of a stem, in order, is bare, then -2, -3 and so on. An empty stem is an error."""
    own = entries.withColumn("_stem", slug_stem(F.col(stem)))
    own = own.withColumn("_stem", F.when(F.col("_stem") == "", F.raise_error(F.lit("empty slug")).cast("string")).otherwise(F.col("_stem")))
    n = F.row_number().over(Window.partitionBy("_stem").orderBy(order))
    return own.withColumn("slug", F.when(n == 1, F.col("_stem")).otherwise(F.concat_ws("-", "_stem", n.cast("string")))).drop("_stem")


def page_table(lines: DataFrame, entries: DataFrame) -> DataFrame:
    """All pages of the source with printed number, letter of their first entry, and running heads."""
    spark = lines.sparkSession
    pages = spark.range(1, LAST_PAGE + 1).select(F.col("id").cast("int").alias("page"))
    heads = lines.where((F.abs(F.col("y") - HEAD_Y) < TOLERANCE) & (F.col("page") >= BODY_PAGE)).groupBy("page").agg(F.max(F.when(F.col("column") == "left", trim(F.col("text")))).alias("head_first"), F.max(F.when(F.col("column") != "left", trim(F.col("text")))).alias("head_last"))
    letters = G.letters_per_page(entries).select("page", letter_name(F.col("letter")).alias("letter"))
    return pages.join(letters, "page", "left").join(heads, "page", "left").withColumn("printed_page", printed_page(F.col("page")))


def front_matter(lines: DataFrame) -> DataFrame:
    """(page, title, body) of the pages before the body: the first heading, and the lines in order."""
    own = lines.where((F.col("page") < BODY_PAGE) & ~is_blank(F.col("text")) & (F.abs(F.col("y") - FOOT_Y) >= TOLERANCE))
    ordered = F.array_sort(F.collect_list(F.struct("line_no", trim(F.col("text")).alias("t"), is_heading(F.col("text")).alias("h"))))
    out = own.groupBy("page").agg(ordered.alias("_l"))
    title = F.coalesce(F.try_element_at(F.filter("_l", lambda s: s["h"]), F.lit(1))["t"], F.element_at("_l", 1)["t"])
    return out.select("page", title.alias("title"), F.array_join(F.transform("_l", lambda s: s["t"]), "\n").alias("body"))


def glyph_table(entries: DataFrame) -> DataFrame:
    """Distinct glyphs by code point, numbered from 1."""
    own = entries.where("glyph is not null").select("glyph").distinct().withColumn("codepoint", F.ascii("glyph"))
    return own.withColumns({"id": F.row_number().over(Window.orderBy("codepoint")), "kind": glyph_kind(F.col("glyph"))})


def build_tables(parsed: Parsed, ambiguous: DataFrame, typos: DataFrame, notes: DataFrame) -> dict[str, DataFrame]:
    """The store: entry, sub_entry, glyph, page, front_matter. A dossier line that no entry owns stops the load.

    ``ambiguous``: row_no, page, text. ``typos``: page, line. ``notes``: row_no, printed_page, reading, theirs, verified_by.
    """
    sub_text = parsed.subs.groupBy("seq").agg(F.array_sort(F.collect_list(F.struct("sub_seq", join_ordered(F.array("form_expanded", "definition")).alias("t")))).alias("_s"))
    entries = mint_slugs(parsed.entries).join(sub_text, "seq", "left").withColumn("sub_text", F.coalesce(F.array_join(F.transform("_s", lambda s: s["t"]), " "), F.lit(""))).drop("_s")
    texts = parsed.subs.join(entries.select("seq", "page"), "seq").select("seq", "page", F.explode(F.array("definition", "form")).alias("text")).unionByName(entries.select("seq", "page", F.col("gloss").alias("text")))
    owned = by_page_range(texts, ambiguous)
    G.require_empty(unowned(ambiguous, owned), "ambiguous lines that no entry owns")
    typo = entries.join(typos, "page").where(F.col("line").contains(F.col("reading"))).select("seq").distinct().withColumn("_typo", F.lit(True))
    shape = signed(notes).groupBy("printed_page", "reading").agg(F.max_by("theirs", "row_no").alias("shape_note"))
    flagged = owned.select("seq").distinct().withColumn("_flag", F.lit(True))
    glyphs = glyph_table(entries)
    own = entries.join(typo, "seq", "left").join(flagged, "seq", "left").join(shape, ["printed_page", "reading"], "left").join(glyphs.select("glyph", F.col("id").alias("glyph_id")), "glyph", "left")
    review = F.col("trailing").isNotNull() | F.coalesce("_typo", F.lit(False)) | F.coalesce("_flag", F.lit(False))
    own = own.withColumns({"needs_review": review, "shape_note": F.when(F.col("glyph").isNull(), F.col("shape_note")), "reading_norm": fold(F.col("reading")), "letter": letter_name(letter_of(F.col("reading")))})
    own = search_document(own, {"A": "reading", "B": "gloss", "C": "sub_text"}).drop("_typo", "_flag")
    return {"entry": own, "sub_entry": parsed.subs, "glyph": glyphs, "page": page_table(parsed.lines, own), "front_matter": front_matter(parsed.lines)}
