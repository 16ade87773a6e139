"""Comparison with a second edition: templates, ordered alignment of runs, pairing, findings.

Only the walk over the two ordered lists of run keys is sequential; it sees folded readings, one
for each run. Pairing inside runs, comparison and sub-entry partners are joins and windows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from glosswork.functions.text import shape_note, trim, unicode_glyph, wiki_plain, witness_fold
from glosswork.operators.ordered import previous_value, running_sums
from glosswork.session import ship_package

# How far the walk looks ahead, how long a telling definition is, the kinds of findings.
LOOKAHEAD, DISTINCTIVE = 12, 12
#: Entries of an edition that one window holds.
STRETCH = 1024
CONTRADICTIONS = ("column_boundary", "glyph_differs")
KINDS = (*CONTRADICTIONS, "glyph_unencodable_there", "shape_note_available", "entry_only_there", "entry_only_here", "flagged_here")


def template_calls(text: str, name: str) -> Iterator[tuple[int, list[str]]]:
    """(offset, fields) of each call of a template. Bars count at depth 1 outside links; an unclosed call gives what it has."""
    opening = "{{" + name + "|"
    at = text.find(opening)
    while at >= 0:
        fields, held, depth, links, i = [], [], 0, 0, at
        while i < len(text):
            pair = text[i : i + 2]
            if pair == "[[":
                links += 1
            elif pair == "]]" and links:
                links -= 1
            elif pair == "{{":
                depth += 1
                if depth == 1:
                    pair = ""
                    i += 2
                    continue
            elif pair == "}}":
                depth -= 1
                if depth == 0:
                    i += 2
                    break
            else:
                if text[i] == "|" and depth == 1 and not links:
                    fields.append("".join(held))
                    held = []
                else:
                    held.append(text[i])
                i += 1
                continue
            held.append(pair)
            i += 2
        if held or depth == 0:
            fields.append("".join(held))
        yield at, [f.strip() for f in fields[1:]]
        at = text.find(opening, max(i, at + len(opening)))


def read_witness(pages: DataFrame, entry_template: str, sub_template: str) -> tuple[DataFrame, DataFrame]:
    """Entries and sub-entries of wiki pages (page_no, title, quality, wikitext), set with the two named templates.

    A sub-entry belongs to the nearest entry above it on its page; those above the first entry are dropped.
    entries: page_no, ordinal, glyph_field, reading, alternate, label, gloss, title, quality. subs: page_no, ordinal, sub_no, han, form, definition.
    """
    ship_package(pages.sparkSession)

    @F.udtf(returnType="at int, is_entry boolean, fields array<string>")
    class Templates:
        def eval(self, wikitext: str):
            for at, fields in template_calls(wikitext or "", entry_template):
                yield at, True, fields
            for at, fields in template_calls(wikitext or "", sub_template):
                yield at, False, fields

    calls = pages.lateralJoin(Templates(F.col("wikitext").outer()))
    w = Window.partitionBy("page_no").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    calls = calls.withColumn("ordinal", F.sum(F.col("is_entry").cast("int")).over(w)).where("ordinal > 0")

    def field(n: int):
        return F.coalesce(F.get("fields", F.lit(n)), F.lit(""))

    names = ("glyph_field", "reading", "alternate", "label", "gloss")
    entries = calls.where("is_entry").select("page_no", "ordinal", *[field(i).alias(n) for i, n in enumerate(names)], "title", "quality")
    number = F.row_number().over(Window.partitionBy("page_no", "ordinal").orderBy("at"))
    subs = calls.where("not is_entry").select("page_no", "ordinal", number.alias("sub_no"), *[field(i).alias(n) for i, n in enumerate(("han", "form", "definition"))])
    return entries, subs


def walk(ours: list[str], theirs: list[str], our_sizes: list[int], their_sizes: list[int]) -> list[tuple[int, int, int, int]]:
    """(run, run, entry, entry): runs that stand for each other, each from the given entry on, by the two ordered lists of
    run keys and the entries in each run.

    Equal keys pair, up to the ends of their runs. Otherwise the nearest entry on either side, at most LOOKAHEAD entries away,
    that restores agreement is taken, theirs first at each distance; without one both sides step by one entry. What is
    left over, the entries of a run before the step that meets it too, is on one side only.
    """
    a = [k for k, n in zip(ours, our_sizes, strict=True) for _ in range(n)]
    b = [k for k, n in zip(theirs, their_sizes, strict=True) for _ in range(n)]
    run_a = [i for i, n in enumerate(our_sizes) for _ in range(n)]
    run_b = [i for i, n in enumerate(their_sizes) for _ in range(n)]
    past_a, past_b = list(accumulate(our_sizes)), list(accumulate(their_sizes))
    out, i, j = [], 0, 0
    while i < len(a) and j < len(b):
        if a[i] == b[j]:
            out.append((run_a[i], run_b[j], i, j))
            i, j = past_a[run_a[i]], past_b[run_b[j]]
            continue
        for d in range(1, LOOKAHEAD + 1):
            if j + d < len(b) and b[j + d] == a[i]:
                j += d
                break
            if i + d < len(a) and a[i + d] == b[j]:
                i += d
                break
        else:
            i, j = i + 1, j + 1
    return out


def _runs(entries: DataFrame, order: str) -> DataFrame:
    """``entries`` with ``_key``, ``run`` and ``_place``, both from 1, in stretches of the order: no window holds a whole edition."""
    keyed = entries.withColumns({"_key": witness_fold(F.col("reading")), "_book": F.lit(0), "_page": F.floor(F.col(order) / STRETCH)})
    at = {"book": "_book", "page": "_page", "order": order}
    keyed = previous_value(keyed, "_before", F.struct("_key"), **at)
    new = F.when(F.col("_before").isNull() | ~F.col("_before._key").eqNullSafe(F.col("_key")), 1).otherwise(0)
    return running_sums(keyed, {"run": new, "_place": F.lit(1)}, **at).drop("_book", "_page", "_before")


def align(ours: DataFrame, theirs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(pairs, only ours, only theirs) of entries (seq, reading, glyph) and (seq, reading, glyph_field).

    pairs holds our_seq and their_seq. In a paired run entries of equal glyph pair first, in order; the others by position.
    ``seq`` is an integer without repeats.
    """
    spark = ours.sparkSession
    a, b = _runs(ours, "seq"), _runs(theirs, "seq").withColumn("glyph", unicode_glyph(F.col("glyph_field")))
    # One short key for each run goes to the driver; the walk looks ahead and cannot be split.
    keys = [x.groupBy("run").agg(F.first("_key").alias("k"), F.count("*").alias("n")).orderBy("run").collect() for x in (a, b)]
    links = walk([r.k for r in keys[0]], [r.k for r in keys[1]], [r.n for r in keys[0]], [r.n for r in keys[1]])
    linked = spark.createDataFrame([(keys[0][x].run, keys[1][y].run, i, j, n) for n, (x, y, i, j) in enumerate(links)], "run_a long, run_b long, from_a long, from_b long, link long")
    a = a.join(linked.select(F.col("run_a").alias("run"), "link", "from_a"), "run").where(F.col("_place") > F.col("from_a")).select("link", F.col("seq").alias("our_seq"), "glyph")
    b = b.join(linked.select(F.col("run_b").alias("run"), "link", "from_b"), "run").where(F.col("_place") > F.col("from_b")).select("link", F.col("seq").alias("their_seq"), "glyph")
    same_a = a.withColumn("_n", F.row_number().over(Window.partitionBy("link", "glyph").orderBy("our_seq")))
    same_b = b.withColumn("_n", F.row_number().over(Window.partitionBy("link", "glyph").orderBy("their_seq")))
    equal = same_a.where("glyph is not null").join(same_b, ["link", "glyph", "_n"]).select("link", "our_seq", "their_seq")
    rest_a = a.join(equal, ["link", "our_seq"], "left_anti").withColumn("_n", F.row_number().over(Window.partitionBy("link").orderBy("our_seq")))
    rest_b = b.join(equal, ["link", "their_seq"], "left_anti").withColumn("_n", F.row_number().over(Window.partitionBy("link").orderBy("their_seq")))
    pairs = equal.unionByName(rest_a.join(rest_b.drop("glyph"), ["link", "_n"]).select("link", "our_seq", "their_seq")).select("our_seq", "their_seq")
    only_a = ours.join(pairs, ours["seq"] == pairs["our_seq"], "left_anti")
    only_b = theirs.join(pairs, theirs["seq"] == pairs["their_seq"], "left_anti")
    return pairs, only_a, only_b


def partners(pairs: DataFrame, our_subs: DataFrame, their_subs: DataFrame) -> DataFrame:
    """(our_seq, sub_seq, sub_no): the same sub-entry in the other edition, by a telling definition, else by form; unique on both sides.

    ``our_subs``: seq, sub_seq, form, definition. ``their_subs``: seq, sub_no, form, definition.
    """
    a = our_subs.join(pairs, our_subs["seq"] == pairs["our_seq"]).select("our_seq", "sub_seq", witness_fold(F.col("definition")).alias("d"), witness_fold(F.col("form")).alias("f"))
    b = their_subs.join(pairs, their_subs["seq"] == pairs["their_seq"]).select("our_seq", "sub_no", witness_fold(F.col("definition")).alias("d"), witness_fold(F.col("form")).alias("f"))

    def unique(rows: DataFrame, key: str) -> DataFrame:
        return rows.withColumn("_n", F.count("*").over(Window.partitionBy("our_seq", key))).where("_n = 1").drop("_n")

    by_d = unique(a, "d").where(F.length("d") >= DISTINCTIVE).join(unique(b, "d").select("our_seq", "d", F.col("sub_no").alias("by_d")), ["our_seq", "d"]).select("our_seq", "sub_seq", "by_d")
    by_f = unique(a, "f").join(unique(b, "f").select("our_seq", "f", F.col("sub_no").alias("by_f")), ["our_seq", "f"]).select("our_seq", "sub_seq", "by_f")
    both = a.select("our_seq", "sub_seq").join(by_d, ["our_seq", "sub_seq"], "left").join(by_f, ["our_seq", "sub_seq"], "left")
    return both.select("our_seq", "sub_seq", F.coalesce("by_d", "by_f").alias("sub_no")).where("sub_no is not null")


def _split(han, form):
    return F.when(F.coalesce(han, F.lit("")) == "", F.concat(F.lit("¦ "), form)).otherwise(F.concat(han, F.lit(" ¦ "), form))


def findings(ours: DataFrame, theirs: DataFrame, our_subs: DataFrame, their_subs: DataFrame, aligned=None) -> DataFrame:
    """(kind, printed_page, reading, ours, theirs, witness_page, quality, contradiction) of all differences.

    ``ours``: seq, reading, glyph, gloss, printed_page, needs_review; ``theirs``: seq, reading, glyph_field, gloss, title, quality;
    subs as for ``partners`` with han_form, needs_review and han.
    """
    pairs, only_a, only_b = aligned or align(ours, theirs)
    there = theirs.select(F.col("seq").alias("their_seq"), "glyph_field", F.col("gloss").alias("t_gloss"), F.col("title").alias("witness_page"), "quality", unicode_glyph(F.col("glyph_field")).alias("t_glyph"), shape_note(F.col("glyph_field")).alias("note"))
    met = pairs.join(ours.withColumnRenamed("seq", "our_seq"), "our_seq").join(there, "their_seq")
    a, b = F.col("glyph"), F.col("t_glyph")

    def found(kind: str, mine, other, when):
        return F.when(when, F.struct(F.lit(kind).alias("kind"), mine.alias("ours"), other.alias("theirs")))

    options = F.array(
        found("flagged_here", F.col("gloss"), wiki_plain(F.col("t_gloss")), F.col("needs_review") & (trim(F.col("t_gloss")) != "")),
        found("glyph_differs", a, b, a.isNotNull() & b.isNotNull() & (a != b)),
        found("glyph_unencodable_there", a, F.coalesce("note", "glyph_field"), a.isNotNull() & b.isNull() & (F.col("glyph_field") != "")),
        found("shape_note_available", F.lit(""), F.coalesce(F.col("note"), b), a.isNull() & (F.col("note").isNotNull() | b.isNotNull())),
    )
    common = ["printed_page", "reading", "witness_page", "quality"]
    heads = met.select(*common, F.explode(F.filter(options, lambda x: x.isNotNull())).alias("x")).select(*common, "x.*")
    matched = partners(pairs, our_subs, their_subs)
    mine = our_subs.select(F.col("seq").alias("our_seq"), "sub_seq", "han_form", "form", F.col("needs_review").alias("s_review"))
    other = their_subs.select(F.col("seq").alias("their_seq"), "sub_no", "han", F.col("form").alias("t_form"))
    subs = matched.join(mine, ["our_seq", "sub_seq"]).join(met.select("our_seq", "their_seq", *common), "our_seq").join(other, ["their_seq", "sub_no"])
    differs = witness_fold(F.col("form")) != witness_fold(F.col("t_form"))
    kind = F.when(differs, "column_boundary").when(F.col("s_review"), "flagged_here")
    subs = subs.select(*common, kind.alias("kind"), _split(F.col("han_form"), F.col("form")).alias("ours"), _split(F.col("han"), F.col("t_form")).alias("theirs")).where("kind is not null")
    here = only_a.select("printed_page", "reading", F.lit("").alias("witness_page"), F.lit(None).cast("int").alias("quality"), F.lit("entry_only_here").alias("kind"), F.coalesce("glyph", F.lit("")).alias("ours"), F.lit("").alias("theirs"))
    away = only_b.select(F.lit(0).alias("printed_page"), "reading", F.col("title").alias("witness_page"), "quality", F.lit("entry_only_there").alias("kind"), F.lit("").alias("ours"), F.col("glyph_field").alias("theirs"))
    out = heads.unionByName(subs).unionByName(here).unionByName(away)
    return out.withColumn("contradiction", F.col("kind").isin(*CONTRADICTIONS))


def check_accounts(matched: int, only_here: int, only_there: int, ours: int, theirs: int) -> None:
    """Every entry of both editions is matched or reported, else stop."""
    if matched + only_here != ours or matched + only_there != theirs:
        raise ValueError(f"{matched} matched, {only_here} only here of {ours}, {only_there} only there of {theirs}")
