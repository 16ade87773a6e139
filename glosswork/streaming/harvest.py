"""An idempotent harvest and a stateful assembly of lines that arrive page by page."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_pages(pages: DataFrame) -> DataFrame:
    """One row for each title: the highest revision. Static or streaming (streaming needs update or complete mode)."""
    columns = [c for c in pages.columns if c not in ("title", "revid")]
    newest = F.max_by(F.struct("revid", *columns), "revid").alias("_n")
    return pages.groupBy("title").agg(newest).select("title", "_n.*")


def first_pages(pages: DataFrame, delay: str = "1 day") -> DataFrame:
    """A stream of pages with each title once; state older than ``delay`` of event time is dropped."""
    return pages.withWatermark("timestamp", delay).dropDuplicatesWithinWatermark(["title"])


def provenance(pages: DataFrame) -> DataFrame:
    """(quality, n) of the harvested pages."""
    return pages.groupBy("quality").agg(F.count("*").alias("n"))


QUALITY_LEVEL = r"<pagequality[^>]*\blevel=\"(\d)\""
QUALITY_USER = r"<pagequality[^>]*\buser=\"([^\"]*)\""


def quality(wikitext):
    """(level, user) columns of the quality tag; null without one."""
    level = F.regexp_extract(wikitext, QUALITY_LEVEL, 1)
    user = F.regexp_extract(wikitext, QUALITY_USER, 1)
    return F.when(level != "", level.cast("int")), F.when(level != "", user)


def windowed_counts(events: DataFrame, size: str, delay: str) -> DataFrame:
    """(window start, event_type, n) of event time, with late rows up to ``delay``."""
    return events.withWatermark("ts", delay).groupBy(F.window("ts", size).alias("w"), "event_type").agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), "event_type", "n")


ASSEMBLED = "book string, page int, line_no int, entry_no long, block_no long"
STATE = "entry_no long, subs long"


def assemble_stream(lines: DataFrame) -> DataFrame:
    """Entry and block numbers of classified lines that arrive in page order, one state for each book."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        entry, subs = state.get if state.exists else (0, 0)
        rows = pd.concat(list(batches)).sort_values(["page", "line_no"])
        out = []
        for r in rows.itertuples():
            if r.role in ("headword", "continued_headword"):
                entry, subs = entry + 1, 0
            elif r.role == "sub_entry" and entry:
                subs += 1
            elif r.role not in ("sub_entry", "continuation"):
                continue
            out.append((key[0], r.page, r.line_no, entry, subs if entry else None))
        state.update((entry, subs))
        yield pd.DataFrame(out, columns=["book", "page", "line_no", "entry_no", "block_no"]).astype({"block_no": "Int64"})

    return lines.groupBy("book").applyInPandasWithState(step, ASSEMBLED, STATE, "append", "NoTimeout")
