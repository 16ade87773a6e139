"""Entry assembly over the continuous line stream, field splitting, and wrapped forms.

Nothing is folded row by row: an entry number is a running count of heads, a block number a
running count of sub-entries since its head, inherited headwords are a carry, and wrapped
forms are islands between non-empty definitions.

``leaf`` names the column that orders the pages of a book. It is the page itself unless a
book has several volumes, whose pages repeat; an entry may go on from one volume to the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glosswork.functions.domain import glyph_kind, pos_names, printed_page
from glosswork.functions.entry import HEADWORD_TYPE, repair_gloss, split_continued, split_headword, split_sub_entry
from glosswork.functions.text import expand_han, expand_reading, join_ordered, trim
from glosswork.operators.lines import is_content
from glosswork.operators.ordered import carry_forward, computed_once
from glosswork.store import Scratch

# Fixed value: how many residual forms a report lists.
RESIDUAL = 2000


def assemble(lines: DataFrame, *, leaf: str = "page") -> DataFrame:
    """Classified ``lines`` with ``entry_no`` (0: before the first head), ``block_no`` (0: head or gloss) and ``orphan``.

    Lines without content get nulls. Lines are dealt by page once; their counts inside the page are written, and one row a page is accumulated.
    """
    content = is_content(F.col("role"))
    head = F.col("role").isin("headword", "continued_headword")
    inside = Window.partitionBy("book", leaf).orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("book").orderBy(leaf).rowsBetween(Window.unboundedPreceding, -1)
    local = lines.withColumns({"_heads": F.sum(head.cast("int")).over(inside), "_subs": F.sum((F.col("role") == "sub_entry").cast("int")).over(inside)})
    # The sub-entries counted at the last head of the page so far; null before the first.
    local = local.withColumn("_start", F.last(F.when(head, F.col("_subs")), ignorenulls=True).over(inside))
    local = Scratch(lines.sparkSession, "assemble").write(local, "local")
    totals = local.groupBy("book", leaf).agg(*[F.max(c).alias(f"_t{c}") for c in ("_heads", "_subs", "_start")])
    totals = totals.withColumns({f"_o{c}": F.coalesce(F.sum(f"_t{c}").over(before), F.lit(0)) for c in ("_heads", "_subs")})
    totals = totals.select("book", leaf, "_o_heads", "_o_subs", F.last(F.col("_o_subs") + F.col("_t_start"), ignorenulls=True).over(before).alias("_o_start"))
    heads = F.col("_heads") + F.col("_o_heads")
    block = F.coalesce(F.col("_subs") - F.col("_start"), F.col("_subs") + F.col("_o_subs") - F.col("_o_start"))
    out = local.join(totals, ["book", leaf]).withColumns({"block_no": F.when(content & (heads > 0), block), "entry_no": F.when(content, heads), "orphan": content & (heads == 0)})
    return out.drop("_heads", "_subs", "_start", "_o_heads", "_o_subs", "_o_start")


def partition_faults(lines: DataFrame, *, leaf: str = "page") -> DataFrame:
    """(book, page, line_no, fault) of content lines in no or several blocks, and other lines in any."""
    per = lines.groupBy("book", *dict.fromkeys([leaf, "page"]), "line_no").agg(F.max(is_content(F.col("role"))).alias("content"), F.count("block_no").alias("n"), F.max("orphan").alias("orphan"))
    fault = F.when(F.col("content") & ~F.col("orphan") & (F.col("n") == 0), "missing").when(F.col("n") > 1, "duplicated").when(~F.col("content") & (F.col("n") > 0), "unexpected")
    return per.withColumn("fault", fault).where("fault is not null").select("book", "page", "line_no", "fault")


def merge_wrapped(subs: DataFrame, by: list[str], order: str = "block_no") -> DataFrame:
    """Sub-entries without definition are joined to the next one; one with nothing after it stays.

    Takes and gives (by..., order, han_form, han_expanded, form, form_expanded, definition, needs_review); ``merged`` counts joins.
    """
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    closed = (trim(F.coalesce("definition", F.lit(""))) != "").cast("long")
    island = subs.withColumn("_closed", closed).withColumn("_island", F.coalesce(F.sum("_closed").over(before), F.lit(0)))
    parts = F.array_sort(F.collect_list(F.struct(order, "han_form", "han_expanded", "form", "form_expanded", "definition")))
    grouped = island.groupBy(*by, "_island").agg(parts.alias("_p"), F.bool_or("needs_review").alias("needs_review"), (F.count("*") - 1).alias("merged"))

    def joined(name: str):
        kept = F.filter(F.transform("_p", lambda s: s[name]), lambda x: x.isNotNull())
        return F.when(F.size(kept) > 0, join_ordered(kept))

    return grouped.select(
        *by,
        F.element_at("_p", -1)[order].alias(order),
        *[joined(n).alias(n) for n in ("han_form", "han_expanded", "form", "form_expanded")],
        F.coalesce(F.element_at("_p", -1)["definition"], F.lit("")).alias("definition"),
        "needs_review",
        "merged",
    )


def sub_entries(lines: DataFrame, entries: DataFrame, *, leaf: str = "page") -> DataFrame:
    """Sub-entries of assembled ``lines`` with forms expanded by their entry's reading and glyph, and wrapped forms joined.

    (book, entry_no, sub_seq, han_form, han_expanded, form, form_expanded, definition, needs_review)
    """
    firsts = computed_once(lines.where("role = 'sub_entry' and block_no > 0"), s=split_sub_entry(F.col("segments"))).select("book", "entry_no", "block_no", "s").where("s is not null")
    rest = lines.where("role = 'continuation' and block_no > 0").groupBy("book", "entry_no", "block_no").agg(F.array_sort(F.collect_list(F.struct(leaf, "line_no", trim(F.col("text")).alias("t")))).alias("_more"))
    rest = rest.withColumn("_more", F.transform("_more", lambda s: s["t"]))
    joined = firsts.join(rest, ["book", "entry_no", "block_no"], "left").join(entries.select("book", "entry_no", "glyph", "reading"), ["book", "entry_no"])
    joined = computed_once(joined, _form=expand_reading(F.col("s.form"), F.col("reading")))
    form = F.col("_form")
    own = joined.select(
        "book",
        "entry_no",
        "block_no",
        F.col("s.han_form").alias("han_form"),
        expand_han(F.col("s.han_form"), F.col("glyph")).alias("han_expanded"),
        F.col("s.form").alias("form"),
        form["value"].alias("form_expanded"),
        join_ordered(F.concat(F.array(F.coalesce("s.definition", F.lit(""))), F.coalesce("_more", F.array().cast("array<string>")))).alias("definition"),
        ((F.col("s.italic_segments") > 1) | (form["residual"] > 0)).alias("needs_review"),
    )
    merged = merge_wrapped(own, ["book", "entry_no"])
    return merged.withColumn("sub_seq", F.row_number().over(Window.partitionBy("book", "entry_no").orderBy("block_no"))).drop("block_no")


def residual_forms(lines: DataFrame, entries: DataFrame, limit: int = RESIDUAL) -> DataFrame:
    """(book, entry_no, block_no, page, form): the first ``limit`` forms that keep a mark after expansion, in book order."""
    firsts = computed_once(lines.where("role = 'sub_entry' and block_no > 0"), s=split_sub_entry(F.col("segments"))).where("s is not null")
    joined = firsts.select("book", "entry_no", "block_no", "page", F.col("s.form").alias("form")).join(entries.select("book", "entry_no", "reading"), ["book", "entry_no"])
    kept = joined.where(expand_reading(F.col("form"), F.col("reading"))["residual"] > 0)
    return kept.select("book", "entry_no", "block_no", "page", "form").orderBy("book", "entry_no", "block_no").limit(limit)


def entries_of(lines: DataFrame, *, leaf: str = "page") -> DataFrame:
    """One row for each entry of assembled ``lines``: head fields, inherited glyph and reading, repaired gloss.

    (book, entry_no, page, printed_page, glyph, glyph_kind, inherits, reading, alternate, labels, pos, gloss, restored, trailing)
    Continued heads before any head have nothing to inherit and are left out.
    """
    heads = lines.where("role in ('headword', 'continued_headword')")
    heads = computed_once(heads, h=F.when(F.col("role") == "headword", split_headword(F.col("text"))).otherwise(F.lit(None).cast(HEADWORD_TYPE)), c=F.when(F.col("role") == "continued_headword", split_continued(F.col("text"))))
    # Split once: the carry reads the heads twice.
    heads = Scratch(lines.sparkSession, "heads").write(heads.select("book", "entry_no", *dict.fromkeys([leaf, "page"]), "line_no", "role", "h", "c"), "heads")
    heads = carry_forward(heads, "context", F.when(F.col("h").isNotNull(), F.struct(F.col("h.glyph").alias("glyph"), F.col("h.reading").alias("reading"))), page=leaf)
    glosses = lines.where("role = 'continuation' and block_no = 0 and entry_no > 0").groupBy("book", "entry_no").agg(F.array_sort(F.collect_list(F.struct(leaf, "line_no", trim(F.col("text")).alias("t")))).alias("_g"))
    glosses = glosses.withColumn("_g", F.transform("_g", lambda s: s["t"]))
    own = heads.where("context is not null").join(glosses, ["book", "entry_no"], "left")
    labels = F.coalesce("h.labels", "c.labels", F.array().cast("array<string>"))
    gloss = join_ordered(F.concat(F.array(F.coalesce("c.definition", F.lit(""))), F.coalesce("_g", F.array().cast("array<string>"))))
    own = computed_once(own, _labels=labels, _gloss=gloss)
    fixed = F.when(F.col("h").isNotNull(), repair_gloss(F.col("_labels"), F.col("_gloss"))).otherwise(F.struct(F.col("_labels").alias("labels"), F.col("_gloss").alias("gloss")))
    own = computed_once(own, _fixed=fixed)
    return own.select(
        "book",
        "entry_no",
        "page",
        printed_page(F.col("page")).alias("printed_page"),
        F.col("context.glyph").alias("glyph"),
        glyph_kind(F.col("context.glyph")).alias("glyph_kind"),
        (F.col("role") == "continued_headword").alias("inherits"),
        F.col("context.reading").alias("reading"),
        F.col("h.alternate").alias("alternate"),
        F.col("_fixed.labels").alias("labels"),
        pos_names(F.col("_fixed.labels")).alias("pos"),
        F.col("_fixed.gloss").alias("gloss"),
        (F.col("_fixed.gloss") != F.col("_gloss")).alias("restored"),
        F.col("h.trailing").alias("trailing"),
    )


def _by_page(readings: DataFrame) -> DataFrame:
    """(page, _r): the readings of each page in order."""
    return readings.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("row_no", "was", "now", (trim(F.coalesce("verified_by", F.lit(""))) != "").alias("signed")))).alias("_r"))


def _replaced(rows: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """``rows`` with the signed readings ``_r`` replaced in ``columns``."""
    def replaced(c):
        signed = F.filter("_r", lambda r: r["signed"])
        return F.when(F.col("_r").isNull(), c).otherwise(F.aggregate(signed, c, lambda acc, r: F.replace(acc, r["was"], r["now"])))

    return rows.withColumns({c: replaced(F.col(c)) for c in columns})


SUB_TEXTS = ("form", "form_expanded", "definition")


def read_entries(entries: DataFrame, readings: DataFrame) -> DataFrame:
    """``entries`` with the signed readings of their page replaced in the gloss."""
    return _replaced(entries.join(_by_page(readings), "page", "left"), ("gloss",)).select(*entries.columns)


def read_subs(entries: DataFrame, subs: DataFrame, readings: DataFrame) -> DataFrame:
    """``subs`` with the signed readings of their entry's page replaced in form, expanded form and definition."""
    paged = subs.join(entries.select("book", "entry_no", "page"), ["book", "entry_no"]).join(_by_page(readings), "page", "left")
    return _replaced(paged, SUB_TEXTS).select(*subs.columns)


def found_readings(entries: DataFrame, subs: DataFrame, readings: DataFrame) -> DataFrame:
    """``readings`` with ``found``: whether the wording was found on its page."""
    def seen(c):
        # The text a reading meets has the earlier signed readings in it.
        def at(r):
            earlier = F.filter("_r", lambda x: x["signed"] & (x["row_no"] < r["row_no"]))
            return F.aggregate(earlier, c, lambda acc, x: F.replace(acc, x["was"], x["now"]))

        return F.transform("_r", lambda r: F.struct(r["row_no"].alias("row_no"), at(r).contains(r["was"]).alias("hit")))

    per = _by_page(readings)
    with_s = subs.join(entries.select("book", "entry_no", "page").join(per, "page"), ["book", "entry_no"])
    hits = entries.join(per, "page").select("page", F.explode(seen(F.col("gloss"))).alias("_h"))
    for c in SUB_TEXTS:
        hits = hits.unionByName(with_s.select("page", F.explode(seen(F.col(c))).alias("_h")))
    hits = hits.groupBy("page", F.col("_h.row_no").alias("row_no")).agg(F.bool_or("_h.hit").alias("hit"))
    return readings.join(hits, ["page", "row_no"], "left").withColumn("found", F.coalesce("hit", F.lit(False))).drop("hit")


def apply_readings(entries: DataFrame, subs: DataFrame, readings: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Signed readings (page, row_no, was, now, verified_by) replaced in order in gloss, form, expanded form and definition.

    Returns entries, sub-entries and, for every reading, whether its wording was found on its page.
    """
    return read_entries(entries, readings), read_subs(entries, subs, readings), found_readings(entries, subs, readings)
