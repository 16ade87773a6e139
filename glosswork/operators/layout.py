"""From drawn text runs to printed lines, in pieces: runs of one place, then the places of a line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glosswork.functions.text import let
from glosswork.store import Scratch


def column_of(x: Column, width: Column) -> Column:
    return F.when(x < width / 2, "left").otherwise("right")


def _merged(runs: Column) -> Column:
    """array<struct<style,text>> in order, neighbours of one style joined; no style is a style of its own."""

    def by_starts(own: Column, starts: Column) -> Column:
        def segment(start: Column, i: Column) -> Column:
            texts = F.slice(own, start, F.coalesce(F.get(starts, i + 1), F.size(own) + 1) - start)
            return F.struct(F.element_at(own, start)["style"].alias("style"), F.array_join(F.transform(texts, lambda s: s["text"]), "").alias("text"))

        return F.transform(starts, segment)

    def by_runs(own: Column) -> Column:
        fresh = lambda i: (i == 1) | ~F.element_at(own, i)["style"].eqNullSafe(F.get(own, i - 2)["style"])
        return let(F.filter(F.sequence(F.lit(1), F.size(own)), fresh), lambda starts: by_starts(own, starts))

    return let(runs, by_runs)


def group_lines(runs: DataFrame, *, book: str = "book", page: str = "page") -> DataFrame:
    """(book, page, line_no, column, y, segments, text) from runs (book, page, width, run_no, x, y, text, style).

    Left column first, top to bottom, left to right; runs of one column at the very same height are one line,
    and neighbours of one style one segment. Runs at the same place keep their drawing order.
    No task holds a page: runs are gathered by line and place, then by line, whose row must hold it whole.
    """
    # A struct as key: fields without a value are equal, also in the join.
    own = runs.select(F.struct(F.col(book).alias("book"), F.col(page).alias("page"), column_of(F.col("x"), F.col("width")).alias("column"), "y").alias("_line"), "x", "run_no", "style", "text")
    drawn = F.transform(F.sort_array(F.collect_list(F.struct("run_no", "style", "text"))), lambda s: F.struct(s["style"].alias("style"), s["text"].alias("text")))
    pieces = own.groupBy("_line", "x").agg(drawn.alias("_runs")).select("_line", "x", _merged(F.col("_runs")).alias("_runs"))
    pieces = Scratch(runs.sparkSession, "lines").write(pieces, "pieces")
    above = Window.partitionBy("_line.book", "_line.page").orderBy("_line.column", F.desc("_line.y"))
    numbers = pieces.select("_line").distinct().withColumn("line_no", F.row_number().over(above))
    lines = pieces.groupBy("_line").agg(F.sort_array(F.collect_list(F.struct("x", "_runs"))).alias("_runs"))
    lines = lines.select("_line", _merged(F.flatten(F.transform("_runs", lambda s: s["_runs"]))).alias("segments")).join(numbers, "_line")
    out = lines.select(F.col("_line.book").alias(book), F.col("_line.page").alias(page), "line_no", "_line.column", "_line.y", "segments")
    return out.withColumn("text", F.array_join(F.transform("segments", lambda s: s["text"]), ""))
