"""Data-quality gates: a gate is green only if what is measured equals what is documented.

Each gate is one row (gate, name, measured, allowed, status, note). A missing gate, a report of
another input, or any red gate refuses the load.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glosswork.functions.domain import glyph_kind, letter_of, letter_rank
from glosswork.functions.entry import covered_length, has_stray_label, split_continued, split_headword, split_sub_entry
from glosswork.functions.text import trim, visible_length
from glosswork.operators.lines import is_content
from glosswork.operators.ordered import computed_once, previous_value

# The gates that must be present, by number.
GATES = {1: "unmapped glyphs", 2: "headword coverage", 3: "character conservation", 4: "index reconciliation", 5: "collation order", 7: "printed errata", 8: "scan verified"}
#: Codes that fonts use for nothing visible.
ACCEPTED_CODES = (0x0000, 0x002A)
#: A dossier that people write stays far below this.
WORDING_BYTES = 8 << 20
FNV_OFFSET, FNV_PRIME = 0xCBF29CE484222325, 0x100000001B3


def gate_row(measured: DataFrame, gate: int, allowed: int, note: str = "") -> DataFrame:
    """One gate from a one-row frame with column ``measured``."""
    value = F.col("measured").cast("long")
    return measured.select(
        F.lit(gate).alias("gate"), F.lit(GATES[gate]).alias("name"), value.alias("measured"), F.lit(allowed).cast("long").alias("allowed"), F.when(value == allowed, "green").otherwise("red").alias("status"), F.lit(note).alias("note")
    )


def unmapped_codes(unmapped: DataFrame) -> DataFrame:
    """Gate 1 measure from (font, code)."""
    return unmapped.agg(F.count_if(~F.col("code").isin(*ACCEPTED_CODES)).alias("measured"))


def line_fields(lines: DataFrame) -> DataFrame:
    """Content lines with ``visible`` and ``covered`` characters and, for heads, ``parsed`` and ``stray``."""
    text, role = F.col("text"), F.col("role")
    own = computed_once(lines.where(is_content(role)), h=F.when(role == "headword", split_headword(text)), c=F.when(role == "continued_headword", split_continued(text)), s=F.when(role == "sub_entry", split_sub_entry(F.col("segments"))))
    labels = lambda x: F.array_join(F.coalesce(x, F.array().cast("array<string>")), "")
    h, c, s = F.col("h"), F.col("c"), F.col("s")
    covered = (
        F.when(role == "continuation", visible_length(text))
        .when(role == "headword", F.coalesce(covered_length(h["glyph"], h["image_marker"], h["reading"], h["alternate"], labels(h["labels"]), h["trailing"]), F.lit(0)))
        .when(role == "continued_headword", F.coalesce(covered_length(labels(c["labels"]), c["definition"]), F.lit(0)))
        .otherwise(F.coalesce(covered_length(s["han_form"], s["form"], s["definition"]), F.lit(0)))
    )
    return own.withColumns({"visible": visible_length(text), "covered": covered, "parsed": h.isNotNull(), "stray": F.coalesce(has_stray_label(h["reading"]), F.lit(False))})


def headword_coverage(fields: DataFrame) -> DataFrame:
    """Gate 2: heads that do not split, heads not covered exactly, and stray labels; a line can count more than once."""
    heads = fields.where("role = 'headword'")
    return heads.agg((F.count_if(~F.col("parsed")) + F.count_if(F.col("parsed") & (F.col("visible") != F.col("covered"))) + F.count_if("stray")).alias("measured"))


def conservation(fields: DataFrame) -> DataFrame:
    """Gate 3: visible characters of content lines less those inside fields."""
    return fields.agg((F.coalesce(F.sum("visible"), F.lit(0)) - F.coalesce(F.sum("covered"), F.lit(0))).alias("measured"))


def reconcile_index(entries: DataFrame, index: DataFrame) -> DataFrame:
    """(glyph, ours, theirs, verdict) of glyphs in ``entries`` (glyph, reading) and ``index`` (row_no, glyph, readings).

    The last index row of a glyph counts; its readings are a comma list. Verdicts: same, differing, invented (only ours), missed.
    """
    mine = entries.where("glyph is not null").groupBy("glyph").agg(F.array_sort(F.collect_set("reading")).alias("ours"))
    last = index.groupBy("glyph").agg(F.max_by("readings", "row_no").alias("_t"))
    wanted = last.select("glyph", F.array_sort(F.array_distinct(F.transform(F.split("_t", ","), trim))).alias("theirs"))
    verdict = F.when(F.col("theirs").isNull(), "invented").when(F.col("ours").isNull(), "missed").when(F.col("ours") == F.col("theirs"), "same").otherwise("differing")
    return mine.join(wanted, "glyph", "full_outer").withColumn("verdict", verdict)


def documented(findings: DataFrame, dossier: DataFrame, keys: list[str]) -> DataFrame:
    """(keys..., fault): findings without dossier row (undocumented) and dossier rows without finding (stale)."""
    a = findings.select(*keys).distinct()
    b = dossier.select(*keys).distinct()
    return a.join(b, keys, "left_anti").withColumn("fault", F.lit("undocumented")).unionByName(b.join(a, keys, "left_anti").withColumn("fault", F.lit("stale")))


def index_gate(verdicts: DataFrame, missing_dossier: DataFrame, reading_dossier: DataFrame) -> DataFrame:
    """Gate 4: invented glyphs, and missed or differing ones that dossiers (glyph) do not document, or document without cause."""
    invented = verdicts.where("verdict = 'invented'").select("glyph").withColumn("fault", F.lit("invented"))
    missed = documented(verdicts.where("verdict = 'missed'"), missing_dossier, ["glyph"])
    differing = documented(verdicts.where("verdict = 'differing'"), reading_dossier, ["glyph"])
    return invented.unionByName(missed).unionByName(differing).agg(F.count("*").alias("measured"))


def collation_faults(entries: DataFrame, by: list[str], order: str, *, page: str | None = None) -> DataFrame:
    """Rows whose letter comes before that of the previous recognised reading (inversion), or is none (unknown).

    With ``page``, a column that grows with ``order``, and one column in ``by``, no window holds more than a page.
    """
    ranked = entries.withColumn("_rank", letter_rank(letter_of(F.col("reading"))))
    if page is None:
        known = ranked.where("_rank is not null").withColumn("_before", F.lag("_rank").over(Window.partitionBy(*by).orderBy(order)))
    else:
        known = previous_value(ranked, "_before", F.col("_rank"), book=by[0], page=page, order=order)
    known = known.withColumn("fault", F.when(F.col("_rank") < F.col("_before"), "inversion")).drop("_before")
    unknown = ranked.where("_rank is null and reading <> ''").withColumn("fault", F.lit("unknown"))
    return known.where("fault is not null").unionByName(unknown).drop("_rank")


def errata_verdicts(entries: DataFrame, texts: DataFrame, errata: DataFrame) -> DataFrame:
    """``errata`` (row_no, source, page, kind, reading, anchor, printed, corrected, reason) with ``failed``, ``unexplained`` and ``stale``.

    A ``glyph`` row must match exactly one entry, which must carry the corrected glyph. A ``text`` row fails if the superseded
    wording is anywhere in ``texts`` (text); it can accuse, never acquit. Other rows are not testable. Rows of one source and
    page share their verdict.
    """
    glyphs = errata.where("kind = 'glyph'")
    matches = glyphs.join(entries.select(F.col("reading").alias("_r"), "gloss", "glyph"), (F.col("reading") == F.col("_r")) & F.col("gloss").contains(F.col("anchor")), "left")
    judged = matches.groupBy("row_no").agg(F.count("_r").alias("_n"), F.count_if(F.col("glyph") == F.col("corrected")).alias("_ok"))
    # The corpus is scanned once: each text is tested against the superseded wordings, a human-written list, whose size is checked.
    wordings = errata.where("kind = 'text' and printed <> ''").select("row_no", "printed")
    if (wordings.agg(F.sum(F.octet_length("printed") + 8)).head()[0] or 0) > WORDING_BYTES:
        raise ValueError("the list of superseded wordings is too long to be broadcast")
    hits = texts.join(F.broadcast(wordings), texts["text"].contains(F.col("printed"))).select("row_no").distinct().withColumn("_hit", F.lit(True))
    own = errata.join(judged, "row_no", "left").join(hits, "row_no", "left")
    failed = F.when(F.col("kind") == "glyph", ~((F.col("_n") == 1) & (F.col("_ok") == 1))).when(F.col("kind") == "text", F.coalesce("_hit", F.lit(False))).otherwise(F.lit(False))
    own = own.withColumn("_failed", failed).withColumn("failed", F.bool_or("_failed").over(Window.partitionBy("source", "page")))
    reason = trim(F.coalesce("reason", F.lit(""))) != ""
    return own.withColumns({"unexplained": F.col("failed") & ~reason, "stale": ~F.col("failed") & reason}).drop("_n", "_ok", "_hit", "_failed")


def errata_gate(verdicts: DataFrame) -> DataFrame:
    return verdicts.agg((F.count_if("unexplained") + F.count_if("stale")).alias("measured"))


def scan_gate(found: DataFrame) -> DataFrame:
    """Gate 8: readings whose wording is not found."""
    return found.agg(F.count_if(~F.col("found")).alias("measured"))


def gates_missing(report: DataFrame) -> DataFrame:
    spark = report.sparkSession
    wanted = spark.createDataFrame([(n,) for n in GATES], "gate int")
    return wanted.join(report, "gate", "left_anti")


def authorize(report: DataFrame, fingerprint: dict, reported: dict) -> None:
    """Raise unless every gate is there, the report is of this input, and all gates are green; in that order."""
    missing = sorted(r.gate for r in gates_missing(report).collect())
    if missing:
        raise PermissionError(f"gates missing: {missing}")
    if fingerprint != reported:
        raise PermissionError("the report is of another input")
    red = [(r.gate, r.measured, r.allowed) for r in report.where("status <> 'green'").orderBy("gate").collect()]
    if red:
        raise PermissionError(f"gates not green (gate, measured, allowed): {red}")


def fingerprint(data: bytes) -> dict:
    """Bytes, line feeds and the 64-bit FNV-1a hash."""
    h = FNV_OFFSET
    for b in data:
        h = ((h ^ b) * FNV_PRIME) & 0xFFFFFFFFFFFFFFFF
    return {"bytes": len(data), "lines": data.count(b"\n"), "fnv1a": h}


def span_coverage(rows: DataFrame, key: list[str]) -> DataFrame:
    """(key..., kind, start, end): merged runs of visible characters in no span (uncovered) and of characters in several (overlapping).

    ``rows`` holds text and spans, array<struct<start,end>> in code points. Runs go on across white space only if it is itself faulty.
    """
    chars = rows.select(*key, "spans", F.posexplode(F.split("text", "")).alias("at", "ch"))
    count = F.size(F.filter("spans", lambda s: (s["start"] <= F.col("at")) & (F.col("at") < s["end"])))
    kinds = F.filter(F.array(F.when((count == 0) & F.col("ch").rlike(r"(?U)\S"), "uncovered"), F.when(count > 1, "overlapping")), lambda x: x.isNotNull())
    bad = chars.where("ch <> ''").select(*key, "at", F.explode(kinds).alias("kind"))
    w = Window.partitionBy(*key, "kind").orderBy("at")
    runs = bad.withColumn("_run", F.col("at") - F.row_number().over(w))
    return runs.groupBy(*key, "kind", "_run").agg(F.min("at").alias("start"), (F.max("at") + 1).alias("end")).drop("_run")


def letters_per_page(entries: DataFrame) -> DataFrame:
    """(page, letter, letters): the first letter of each page and how many it holds."""
    own = entries.withColumn("_l", letter_of(F.col("reading")))
    return own.groupBy("page").agg(F.min_by("_l", "seq").alias("letter"), F.countDistinct("_l").alias("letters"))


def roles_report(lines: DataFrame) -> DataFrame:
    """(role, n, percent) of all lines."""
    return lines.groupBy("role").agg(F.count("*").alias("n")).withColumn("percent", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 2))


def head_reports(lines: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(kind, n) of glyph kinds and (labels, n) of label patterns, over the headword lines that split."""
    heads = computed_once(lines.where("role = 'headword'"), h=split_headword(F.col("text"))).where("h is not null")
    kinds = heads.groupBy(glyph_kind(F.col("h.glyph")).alias("kind")).agg(F.count("*").alias("n"))
    return kinds, heads.groupBy(F.array_join("h.labels", " ").alias("labels")).agg(F.count("*").alias("n"))


def require_empty(faults: DataFrame, what: str) -> None:
    """Stop the load if any fault is left."""
    some = faults.limit(5).collect()
    if some:
        raise ValueError(f"{what}: {some}")


def equal_lists(stored: list[str], domain: list[str]) -> None:
    if list(stored) != list(domain):
        raise ValueError(f"stored {stored} is not the domain's {domain}")


def enum_column(c: Column, values: tuple[str, ...]) -> Column:
    """The value, or an error for any value outside the list."""
    return F.when(c.isNull() | c.isin(*values), c).otherwise(F.raise_error(F.concat(F.lit("not in the list: "), c)).cast("string"))


def one_row(spark: SparkSession, measured: int) -> DataFrame:
    return spark.createDataFrame([(measured,)], "measured long")
