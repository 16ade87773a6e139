"""Ingest of synthetic books: time, rows and lines a second for 1, 10 and 100 times the size of the source book.

``python bench_book.py [copies ...]`` prints one JSON line for each size. Nothing is written.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glosswork.plans.ingest import parse_book
from glosswork.session import get_session

#: Lines and pages of the source book.
LINES, PAGES = 89_690, 1_028


def synthetic_book(spark: SparkSession, copies: int) -> DataFrame:
    """Lines in the measured shares: heads 7 %, sub-entries 64 %, continuations 26 %, running heads and page numbers."""
    per = LINES // PAGES
    rows = spark.range(copies * LINES, numPartitions=max(8, copies * 2)).select(
        F.format_string("book%d", F.floor(F.col("id") / LINES)).alias("book"),
        (11 + F.floor((F.col("id") % LINES) / per)).cast("int").alias("page"),
        (F.col("id") % LINES % per).cast("int").alias("line_no"),
        F.pmod(F.xxhash64("id"), F.lit(1000)).alias("r"),
        F.pmod(F.xxhash64(F.lit(1), "id"), F.lit(5000)).alias("k"),
    )
    word = F.concat(F.lit("Tiếng"), F.col("k").cast("string"))
    glyph = F.decode(F.unhex(F.hex(F.lit(0x4E00) + F.col("k"))), "UTF-16BE")
    seg = lambda style, text: F.struct(F.lit(style).alias("style"), text.alias("text"))
    first, last = F.col("line_no") == 0, F.col("line_no") == per - 1
    segments = (
        F.when(first | last, F.array(seg("regular", F.col("page").cast("string"))))
        .when(F.col("r") < 70, F.array(seg("han", glyph), seg("regular", F.concat(F.lit("  "), word, F.lit("  c.")))))
        .when(F.col("r") < 710, F.array(seg("italic", F.concat(F.lit("― "), F.lower(word))), seg("regular", F.concat(F.lit(". Nghĩa là "), word, F.lit(".")))))
        .otherwise(F.array(seg("regular", F.concat(F.lit("tiếp theo "), word, F.lit(" và nữa.")))))
    )
    y = F.when(first, 797.89).when(last, 25.89).otherwise(700.0 - F.col("line_no"))
    out = rows.select("book", "page", "line_no", F.lit("left").alias("column"), y.alias("y"), segments.alias("segments"))
    return out.withColumn("text", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = get_session(f"local[{cpus}]", int(cpus), **{"spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"), "spark.ui.showConsoleProgress": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    readings = spark.createDataFrame([], "page int, row_no int, was string, now string, verified_by string")
    for copies in [int(x) for x in sys.argv[1:]] or [1, 10]:
        began = time.perf_counter()
        parsed = parse_book(synthetic_book(spark, copies), readings)
        entries = parsed.entries.agg(F.count("*"), F.sum(F.length("gloss"))).head()[0]
        subs = parsed.subs.agg(F.count("*"), F.sum(F.length("form_expanded"))).head()[0]
        took = time.perf_counter() - began
        print(json.dumps({"copies": copies, "lines": copies * LINES, "entries": entries, "sub_entries": subs, "sec": round(took, 2), "lines_a_sec": round(copies * LINES / took)}), flush=True)


if __name__ == "__main__":
    main()
