"""Windows over one long ordered stream without gathering it in one task.

``Window.orderBy`` without ``partitionBy`` moves every row to one task. Here the stream is
cut into pages: running values are taken inside each page, the pages' totals (one row for
each page) are accumulated, and the two are joined. ``book`` separates streams.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def computed_once(rows: DataFrame, **columns: Column) -> DataFrame:
    """``rows`` with columns that later expressions use many times.

    A plain projection would be merged into its users and evaluated for each of them; behind a one-element explode it is evaluated once.
    """
    for name, column in columns.items():
        rows = rows.select("*", F.explode(F.array(column)).alias(name))
    return rows


def running_sums(lines: DataFrame, sums: dict[str, Column], *, book: str = "book", page: str = "page", order: str = "line_no") -> DataFrame:
    """``lines`` with, for each name, the sum of its expression over all lines up to and including this one."""
    inside = Window.partitionBy(book, page).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(book).orderBy(page).rowsBetween(Window.unboundedPreceding, -1)
    totals = lines.groupBy(book, page).agg(*[F.sum(e).alias(f"_t_{n}") for n, e in sums.items()])
    offsets = totals.select(book, page, *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums])
    local = lines.withColumns({f"_l_{n}": F.sum(e).over(inside) for n, e in sums.items()})
    out = local.join(offsets, [book, page]).withColumns({n: (F.col(f"_l_{n}") + F.col(f"_o_{n}")).cast("long") for n in sums})
    return out.drop(*[f"_{k}_{n}" for n in sums for k in "lo"])


def carry_forward(lines: DataFrame, name: str, value: Column, *, book: str = "book", page: str = "page", order: str = "line_no") -> DataFrame:
    """``lines`` with ``name``: the last non-null value at or before each line."""
    inside = Window.partitionBy(book, page).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(book).orderBy(page).rowsBetween(Window.unboundedPreceding, -1)
    local = lines.withColumn("_v", value)
    finals = local.groupBy(book, page).agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col(order))).alias("_f"))
    carried = finals.select(book, page, F.last("_f", ignorenulls=True).over(before).alias("_c"))
    out = local.withColumn("_h", F.last("_v", ignorenulls=True).over(inside)).join(carried, [book, page])
    return out.withColumn(name, F.coalesce("_h", "_c")).drop("_v", "_h", "_c")


def previous_value(lines: DataFrame, name: str, value: Column, *, book: str = "book", page: str = "page", order: str = "line_no") -> DataFrame:
    """``lines`` with ``name``: the last non-null value strictly before each line."""
    inside = Window.partitionBy(book, page).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(book).orderBy(page).rowsBetween(Window.unboundedPreceding, -1)
    local = lines.withColumn("_v", value)
    finals = local.groupBy(book, page).agg(F.max_by("_v", F.when(F.col("_v").isNotNull(), F.col(order))).alias("_f"))
    carried = finals.select(book, page, F.last("_f", ignorenulls=True).over(before).alias("_c"))
    out = local.withColumn("_h", F.last("_v", ignorenulls=True).over(inside)).join(carried, [book, page])
    return out.withColumn(name, F.coalesce("_h", "_c")).drop("_v", "_h", "_c")


def islands(rows: DataFrame, name: str, key: Column, *, by: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``name``: the number of the run of consecutive equal keys, from 1, inside ``by``."""
    w = Window.partitionBy(*by).orderBy(*order)
    changed = (~key.eqNullSafe(F.lag(key).over(w)) | (F.row_number().over(w) == 1)).cast("long")
    return rows.withColumn("_changed", changed).withColumn(name, F.sum("_changed").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_changed")
