"""The read-only catalogue: each service call is one query over the loaded tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glosswork.functions.domain import LETTER_NAMES
from glosswork.operators import search as S
from glosswork.store import Scratch

SUMMARY = ["seq", "slug", "reading", "reading_norm", "glyph", "glyph_kind", "pos", "gloss", "page", "printed_page", "needs_review", "letter"]


def neighbours(rows: DataFrame, order: str = "seq", key: str = "slug") -> DataFrame:
    """(order, previous, next) of each row, for a dense order: an equality join on order - 1 and order + 1, not one global window."""
    near = rows.select(F.col(order).alias("_o"), F.col(key).alias("_k"))
    before = near.select((F.col("_o") + 1).alias(order), F.col("_k").alias("previous"))
    after = near.select((F.col("_o") - 1).alias(order), F.col("_k").alias("next"))
    return rows.select(order).join(before, order, "left").join(after, order, "left")


@dataclass
class Catalog:
    """Tables entry, sub_entry, glyph, page, front_matter, and bridge (row_no, old, new, note)."""

    entry: DataFrame
    sub_entry: DataFrame
    glyph: DataFrame
    page: DataFrame
    front_matter: DataFrame
    bridge: DataFrame

    def summaries(self) -> DataFrame:
        return self.entry.select(*SUMMARY)

    def padded(self) -> DataFrame:
        """Summaries with the constant tier and score of rows that no search ranked."""
        return self.summaries().select("*", F.lit(0).alias("tier"), F.lit(0.0).alias("score"))

    def lookup(self, slug: str) -> DataFrame:
        """The entry with its sub-entries nested in order, its page, and its neighbours in book order (``seq`` is dense)."""
        one = self.entry.where(F.col("slug") == slug)
        nested = F.array_sort(F.collect_list(F.struct("sub_seq", "han_form", "han_expanded", "form", "form_expanded", "definition", "needs_review")))
        subs = self.sub_entry.join(one.select("seq"), "seq", "left_semi").groupBy("seq").agg(nested.alias("subs"))
        near = self.entry.select("seq", "slug")
        before = near.select((F.col("seq") + 1).alias("seq"), F.col("slug").alias("previous"))
        after = near.select((F.col("seq") - 1).alias("seq"), F.col("slug").alias("next"))
        own = one.select(*SUMMARY, "alternate", "shape_note").join(subs, "seq", "left").join(self.page.select("page", "head_first", "head_last"), "page")
        return own.join(before, "seq", "left").join(after, "seq", "left")

    def search(self, raw: str, mode: str = "auto", page: int = 1, size: int = S.PAGE_SIZE) -> dict[str, DataFrame]:
        """results, total, suggestions (only without results) and bridge (always)."""
        results, total = S.search(self.entry, raw, mode, S.Page.of(page, size))
        out = {"results": results.select(*SUMMARY, "tier", "score"), "total": total, "bridge": S.bridge(self.bridge, raw)}
        if total.head().total == 0:
            out["suggestions"] = S.suggest(self.entry, raw)
        return out

    def entry_of_the_day(self, day: int) -> DataFrame:
        n = self.entry.count()
        return self.entry.orderBy("seq").offset(day % n if n else 0).limit(1)

    def by_letter(self, letter: str, page: int = 1, size: int = S.PAGE_SIZE) -> tuple[DataFrame, DataFrame]:
        if letter not in LETTER_NAMES:
            raise ValueError(f"no letter {letter!r}")
        p = S.Page.of(page, size)
        pages = self.page.where(F.col("letter") == letter).select("page")
        own = self.summaries().join(pages, "page", "left_semi")
        return own.orderBy("seq").offset(p.offset).limit(p.size), own.agg(F.count("*").alias("total"))

    def page_view(self, page: int) -> tuple[DataFrame, DataFrame]:
        return self.page.where(F.col("page") == page), self.summaries().where(F.col("page") == page).orderBy("seq")

    def glyph_view(self, glyph: str) -> DataFrame:
        return self.summaries().where(F.col("glyph") == glyph).orderBy("seq")

    def glyph_image(self, glyph: str) -> DataFrame:
        return self.glyph.where(F.col("glyph") == glyph)

    def front_matters(self) -> DataFrame:
        return self.front_matter.orderBy("page")

    def front_matter_page(self, page: int) -> DataFrame:
        return self.front_matter.where(F.col("page") == page)

    def entries_in_order(self) -> DataFrame:
        return self.summaries().orderBy("seq")

    def stats(self) -> DataFrame:
        """Seven counts and the pages that carry entries, in one row: one aggregate for each table."""
        e = self.entry.agg(F.count("*").alias("entries"), F.count_if(F.col("glyph").isNull()).alias("image_entries"), F.count_if("needs_review").alias("review"))
        s = self.sub_entry.agg(F.count("*").alias("sub_entries"), F.count_if("needs_review").alias("sub_review"))
        own = e.crossJoin(s).crossJoin(self.glyph.agg(F.count("*").alias("glyphs"))).crossJoin(self.page.agg(F.count("*").alias("pages")))
        return own.crossJoin(self.entry.agg(F.countDistinct("page").alias("pages_with_entries")))

    def letter_counts(self) -> DataFrame:
        return self.entry.groupBy("letter").agg(F.count("*").alias("entries"))


#: What the store must hold: columns by table, as type strings.
STORE = {
    "entry": {"seq": "int", "slug": "string", "reading": "string", "reading_norm": "string", "glyph": "string", "pos": "array<string>", "gloss": "string", "needs_review": "boolean", "words": "string"},
    "sub_entry": {"seq": "int", "form": "string", "form_expanded": "string", "definition": "string", "needs_review": "boolean"},
    "glyph": {"glyph": "string", "codepoint": "int", "kind": "string"},
    "page": {"page": "int", "printed_page": "int", "letter": "string"},
    "front_matter": {"page": "int", "title": "string", "body": "string"},
}


def inspect_store(tables: dict[str, DataFrame]) -> list[str]:
    """What is wrong with a store: missing tables, missing columns, columns of another type."""
    faults = []
    for name, columns in STORE.items():
        if name not in tables:
            faults.append(f"no table {name}")
            continue
        have = dict(tables[name].dtypes)
        faults += [f"{name}.{c}: {have.get(c, 'missing')}, not {t}" for c, t in columns.items() if have.get(c) != t]
    return faults


def orphans(tables: dict[str, DataFrame]) -> DataFrame:
    """(relation, n) of rows that refer to nothing; Spark has no foreign keys, so a load checks them."""
    entry, sub, glyph, page = (tables[n] for n in ("entry", "sub_entry", "glyph", "page"))
    checks = {"sub_entry to entry": sub.join(entry, "seq", "left_anti"), "entry to glyph": entry.where("glyph is not null").join(glyph, "glyph", "left_anti"), "entry to page": entry.join(page, "page", "left_anti")}
    parts = [df.agg(F.lit(name).alias("relation"), F.count("*").alias("n")) for name, df in checks.items()]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def composite_closure(edges: DataFrame, roots: DataFrame, rounds: int = 64) -> DataFrame:
    """(root, node) of all nodes reachable from ``roots`` (node) over ``edges`` (src, dst), roots included. Cycles are allowed.

    Each round's new pairs are written to the shared folder, so plans stay short and a lost executor costs one round.
    """
    scratch = Scratch(edges.sparkSession, "closure")
    seen = front = scratch.write(roots.select(F.col("node").alias("root"), "node").distinct(), "front0")
    for k in range(1, rounds):
        step = front.join(edges, front["node"] == edges["src"]).select("root", F.col("dst").alias("node")).distinct()
        front = scratch.write(step.join(seen, ["root", "node"], "left_anti"), f"front{k}")
        if front.isEmpty():
            return seen
        seen = seen.unionByName(front)
    raise RuntimeError(f"closure did not settle in {rounds} rounds")
