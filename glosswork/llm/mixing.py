"""Mixing sources to target weights, with DataFrame functions only.

Tokens are summed per source, a target per source is found by filling weighted
shares up to a cap, and each document is emitted ``floor(rate)`` times plus one
copy drawn by a hash of its id with probability equal to the fraction of
``rate = target / source size``.

Defined results
* null or empty text: size 0, nothing taken, emitted as often as its source's rate says;
* null source: a source of its own, ordered last; null id: hashed as ``null``;
* repeated rows: each is a document of its own with the same draw;
* a source of size 0 has target 0 and rate 0; an empty table gives no rows;
* extra columns are carried by ``emit_mix`` and ignored elsewhere; names used
  inside are prefixed with ``_mix_``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from glosswork.llm.store import Scratch

WORD = r"[^\x20\x09-\x0D]+"
HASH_BITS = 52
#: The table of sources is broadcast up to this size; beyond it, rows and sources meet in a join that splits hot sources.
BROADCAST_BYTES = 8 << 20


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def draw(key: Column, seed: str) -> Column:
    """A number in [0, 1) that depends on the key and the seed alone."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("null")), F.lit(f":{seed}")))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("double") / F.lit(float(2**HASH_BITS))


def _sums_before(rows: DataFrame, order: list[Column], sums: dict[str, Column], scratch: Scratch, name: str) -> DataFrame:
    """``rows`` with, for each name, the sum of its expression over the rows before this one.

    The rows are cut into pages of the order, which are written so that no retry can cut them otherwise. A window never holds
    more than a page; that over the pages' totals has one row for each page, of which there are at most the shuffle partitions.
    """
    paged = scratch.write(rows.repartitionByRange(*order).withColumn("_mix_page", F.spark_partition_id()), name)
    inside = Window.partitionBy("_mix_page").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    pages = Window.orderBy("_mix_page").rowsBetween(Window.unboundedPreceding, -1)
    totals = paged.groupBy("_mix_page").agg(*[F.sum(e).alias(f"_mix_t_{n}") for n, e in sums.items()])
    offsets = totals.select("_mix_page", *[F.coalesce(F.sum(f"_mix_t_{n}").over(pages), F.lit(0)).alias(f"_mix_o_{n}") for n in sums])
    local = paged.withColumns({n: F.coalesce(F.sum(e).over(inside), F.lit(0)) for n, e in sums.items()})
    return local.join(offsets, "_mix_page").select(*rows.columns, *[(F.col(n) + F.col(f"_mix_o_{n}")).alias(n) for n in sums])


def source_targets(sizes: DataFrame, weights: tuple[int, ...], share: float, cap: float, scratch: Scratch) -> DataFrame:
    """(source, source_size, target) from (source, size).

    In order of cap over weight, source k is capped if its cap is at most its
    part of what the sources before it leave; the water level is the largest
    ``rest / rest of weights`` met on that walk. Only one row of totals and the
    level come to the driver.
    """
    per = scratch.write(sizes.groupBy("_mix_source").agg(F.sum("_mix_size").alias("_mix_total")), "sizes")
    per = _sums_before(per, [F.col("_mix_source").asc_nulls_last()], {"_mix_nr": F.lit(1)}, scratch, "names")
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_mix_nr") % len(weights) + 1).cast("int"))
    per = per.withColumns({"_mix_weight": weight, "_mix_cap": F.col("_mix_total") * F.lit(float(cap))})
    per = per.withColumn("_mix_ratio", F.col("_mix_cap") / F.col("_mix_weight"))
    order = [F.col("_mix_ratio").asc(), F.col("_mix_nr").asc()]
    walk = _sums_before(per, order, {"_mix_caps": F.col("_mix_cap"), "_mix_weights": F.col("_mix_weight")}, scratch, "ratios")
    walk = scratch.write(walk, "walk")
    every = walk.agg(F.sum("_mix_total").alias("total"), F.sum("_mix_weight").alias("weight")).head()
    rest = F.lit(float((every.total or 0) * share)) - F.col("_mix_caps")
    level = walk.agg(F.max(rest / (F.lit(float(every.weight or 0)) - F.col("_mix_weights")))).head()[0] or 0.0
    return walk.select("_mix_source", "_mix_total", F.least("_mix_cap", F.lit(max(level, 0.0)) * F.col("_mix_weight")).alias("_mix_target"))


def mix_plan(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, seed: str = "mix") -> DataFrame:
    """One row for each row of ``docs``: its columns plus size, source size, target and copies, as ``_mix_`` columns."""
    sized = docs.withColumns({"_mix_size": word_count(F.col(text_col)), "_mix_key": F.col(source_col)})
    scratch = Scratch(docs.sparkSession, "mixing")
    totals = scratch.write(source_targets(sized.select(F.col("_mix_key").alias("_mix_source"), "_mix_size"), weights, share, cap, scratch), "targets")
    scratch.keep("targets")
    width = totals.agg(F.sum(F.coalesce(F.octet_length("_mix_source"), F.lit(0)) + 48)).head()[0] or 0
    if width <= BROADCAST_BYTES:
        totals = F.broadcast(totals)
    rate = F.when(F.col("_mix_total") > 0, F.col("_mix_target") / F.col("_mix_total")).otherwise(F.lit(0.0))
    joined = sized.join(totals, F.col("_mix_key").eqNullSafe(F.col("_mix_source")))
    copies = F.floor(rate) + (draw(F.col(id_col), seed) < rate - F.floor(rate)).cast("long")
    return joined.withColumn("_mix_copies", copies.cast("long")).drop("_mix_source", "_mix_key")


def emit_mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: each document as many times as its copies say."""
    plan = mix_plan(docs, **options)
    rows = plan.where(F.col("_mix_copies") > 0).withColumn("_mix_copy", F.explode(F.sequence(F.lit(1), F.col("_mix_copies").cast("int"))))
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])
