"""The synthetic book over several volumes, whose page numbers repeat: the queries against their SQL."""

from pathlib import Path

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from glosswork.operators import assemble as A
from glosswork.operators import gates

#: Parts around the ends of volumes of 20,000; the fourth opens with an entry that inherits from the third, and the eleventh's number sorts as text before the third's.
STARTS = (0, 19_980, 59_990, 219_980)


@pytest.fixture(scope="module")
def volumes(spark, sf_dir, tmp_path_factory):
    root = tmp_path_factory.mktemp("volumes")
    for f in Path(sf_dir).glob("*.parquet"):
        if f.name != "part.parquet":
            (root / f.name).symlink_to(f)
    key = F.element_at(F.array(*[F.lit(s) for s in STARTS]), (F.col("p_partkey") % 4 + 1).cast("int")) + F.floor(F.col("p_partkey") / 4)
    spark.read.parquet(f"{sf_dir}/part.parquet").withColumn("p_partkey", key.cast("long")).coalesce(1).write.parquet(str(root / "part.parquet"))
    return root


NAMES = "book_assembly book_entries book_gates book_lookup book_pages book_services book_stats book_subs entry_records page_records search_pages shard_files book_roles book_glyphs".split()


@pytest.mark.parametrize("name", NAMES)
def test_volumes_equal_sql(spark, volumes, name):
    con = duckdb.connect()
    for f in volumes.glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}{'/*.parquet' if f.is_dir() else ''}')")
    want = con.execute(entry.oracle_sql()[name])
    columns = [c[0] for c in want.description]
    got = entry.queries()[name](spark, str(volumes)).select(*columns).collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted(want.fetchall(), key=repr)


def test_blocks_go_on_over_pages_and_volumes(spark):
    """Against a plain loop: heads and sub-entries of pages that hold neither, some or several."""
    roles = {1: ["continuation", "headword", "sub_entry"], 2: ["sub_entry", "continuation"], 3: ["running_head"], 4: ["sub_entry", "headword", "sub_entry", "sub_entry", "continued_headword"], 5: ["continuation", "sub_entry"]}
    rows = [("b", 11 + leaf % 2, leaf, n, role) for leaf, own in roles.items() for n, role in enumerate(own)]
    want, heads, blocks = [], 0, 0
    for _, _, leaf, n, role in rows:
        content = role != "running_head"
        if role in ("headword", "continued_headword"):
            heads, blocks = heads + 1, 0
        blocks += role == "sub_entry"
        want.append((leaf, n, heads if content else None, blocks if content and heads else None))
    df = A.assemble(spark.createDataFrame(rows, "book string, page int, leaf int, line_no int, role string"), leaf="leaf")
    assert [tuple(r) for r in df.select("leaf", "line_no", "entry_no", "block_no").orderBy("leaf", "line_no").collect()] == want
    assert A.partition_faults(df, leaf="leaf").count() == 0


def test_collation_by_places(spark):
    rows = [("b", i, r) for i, r in enumerate(["an", "ba", "*", "an", "ca", "", "ba", "da"])]
    entries = spark.createDataFrame(rows, "book string, seq int, reading string").withColumn("place", F.floor(F.col("seq") / 2))
    faults = lambda **k: [(r.seq, r.fault) for r in gates.collation_faults(entries, ["book"], "seq", **k).orderBy("seq").collect()]
    assert faults(page="place") == faults() == [(2, "unknown"), (3, "inversion"), (6, "inversion")]
