"""Review dossiers: findings that people sign. A finding that recurs keeps its signature."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from glosswork.functions.text import trim


def signed(rows: DataFrame) -> DataFrame:
    """Rows that somebody has looked at."""
    return rows.where(trim(F.coalesce("verified_by", F.lit(""))) != "")


def upsert(new: DataFrame, old: DataFrame, order: str = "row_no") -> DataFrame:
    """``new`` with the signatures of ``old``: the last signed row of a key counts, others get an empty one.

    Signatures of keys that are gone go with them.
    """
    last = signed(old).groupBy("key").agg(F.max_by("verified_by", order).alias("_by"))
    rows = new.drop("verified_by") if "verified_by" in new.columns else new
    return rows.join(last, "key", "left").withColumn("verified_by", F.coalesce("_by", F.lit(""))).drop("_by")


def kept_signatures(upserted: DataFrame) -> DataFrame:
    return upserted.agg(F.count_if(F.col("verified_by") != "").alias("kept"))


def totals(dossiers: dict[str, DataFrame]) -> DataFrame:
    """(dossier, rows, unsigned) of each."""
    parts = [df.agg(F.lit(name).alias("dossier"), F.count("*").alias("rows"), F.count_if(trim(F.coalesce("verified_by", F.lit(""))) == "").alias("unsigned")) for name, df in sorted(dossiers.items())]
    return reduce(DataFrame.unionByName, parts)


def by_page_range(entries: DataFrame, lines: DataFrame, reach: int = 1) -> DataFrame:
    """Entries (seq, page, text) joined to dossier lines (row_no, page, text) at most ``reach`` pages away whose text they contain.

    The range becomes an equality: each line is repeated for its neighbouring pages.
    """
    near = lines.select("row_no", F.col("text").alias("line_text"), F.explode(F.sequence(F.col("page") - reach, F.col("page") + reach)).alias("page"))
    return entries.join(near, "page").where(F.col("text").contains(F.col("line_text"))).select("seq", "row_no").distinct()


def unowned(lines: DataFrame, owned: DataFrame) -> DataFrame:
    """Dossier lines that no entry owns."""
    return lines.join(owned.select("row_no").distinct(), "row_no", "left_anti")
