"""A small book end to end, the catalogue, streams, and the driver's queries."""

import hashlib

import pytest
from pyspark.sql import functions as F

from glosswork.operators import assemble, dossier, gates
from glosswork.operators.search import SUGGESTIONS
from glosswork.plans import book_queries, ingest  # noqa: F401
from glosswork.plans.catalog import Catalog, composite_closure
from glosswork.plans.queries import ORACLES, QUERIES
from glosswork.streaming import harvest

S = {"I": "italic", "r": "regular", "H": "han"}
LINE = "book string, page int, line_no int, column string, y double, segments array<struct<style:string,text:string>>, text string"


def book(spark):
    pages = [
        (5, [(700.0, [("r", "LỜI NÓI")]), (690.0, [("r", "body")]), (25.89, [("r", "5")])]),
        (11, [(797.89, [("r", "A")]), (700.0, [("r", "CHỮ A")]), (690.0, [("H", "阿"), ("r", "  A  c.")]), (680.0, [("r", "Nương dựa,")]), (670.0, [("I", "― gươm"), ("r", ". Nạm")]), (660.0, [("r", "gươm.")]), (650.0, [("H", "| 意"), ("I", " ― ý")])]),
        (12, [(797.89, [("r", "Áp")]), (700.0, [("I", "dài ―"), ("r", ". Theo ý.")]), (690.0, [("r", "n. Chữ khác.")]), (680.0, [("H", "壓"), ("r", "  Áp  c. n.")]), (670.0, [("r", "găn, giữ.")]), (25.89, [("r", "11")])]),
    ]
    rows = [("b", p, i, "left", y, [(S[k], t) for k, t in segs], "".join(t for _, t in segs)) for p, ls in pages for i, (y, segs) in enumerate(ls)]
    return spark.createDataFrame(rows, LINE)


READINGS = "page int, row_no int, was string, now string, verified_by string"


@pytest.fixture(scope="module")
def parsed(spark):
    readings = spark.createDataFrame([(12, 0, "giữ", "giữ gìn", "me"), (12, 1, "gìn", "GÌN", ""), (11, 2, "nowhere", "x", "me")], READINGS)
    return ingest.parse_book(book(spark), readings)


def test_entries(parsed):
    got = parsed.entries.orderBy("seq").collect()
    assert [(r.seq, r.page, r.printed_page, r.glyph, r.reading, r.labels, r.pos, r.gloss, r.inherits, r.restored) for r in got] == [
        (1, 11, 10, "阿", "A", ["c."], ["chu_nho"], "Nương dựa,", False, False),
        (2, 12, 11, "阿", "A", ["n."], ["chu_nom"], "Chữ khác.", True, False),
        (3, 12, 11, "壓", "Áp", ["c."], ["chu_nho"], "Ngăn, giữ gìn.", False, True),
    ]


def test_sub_entries(parsed):
    got = parsed.subs.orderBy("seq", "sub_seq").collect()
    assert [(r.seq, r.sub_seq, r.han_form, r.han_expanded, r.form, r.form_expanded, r.definition, r.needs_review) for r in got] == [
        (1, 1, None, None, "― gươm.", "A gươm.", "Nạm gươm.", False),
        (1, 2, "| 意", "阿 意", "― ý dài ―.", "A ý dài A.", "Theo ý.", False),
    ]


def test_readings_are_found_on_earlier_replacements(parsed):
    assert [(r.row_no, r.found) for r in parsed.readings.orderBy("row_no").collect()] == [(0, True), (1, True), (2, False)]


def test_gates(spark, parsed):
    unmapped = spark.createDataFrame([("F", 0), ("F", 42), ("F", 7)], "font string, code int")
    got = {r.gate: (r.measured, r.status) for r in ingest.parse_gates(parsed, unmapped, 0, 0).collect()}
    assert got == {1: (1, "red"), 2: (0, "green"), 3: (0, "green"), 8: (1, "red")}
    index = spark.createDataFrame([(0, "阿", "A"), (1, "壓", "Áp")], "row_no int, glyph string, readings string")
    none = spark.createDataFrame([], "glyph string")
    errata = spark.createDataFrame([], "row_no int, source string, page int, kind string, reading string, anchor string, printed string, corrected string, reason string")
    texts = parsed.entries.select(F.col("gloss").alias("text"))
    assert {r.gate: r.status for r in ingest.reconcile_gates(parsed.entries, index, none, none, texts, errata).collect()} == {4: "green", 5: "green", 7: "green"}


@pytest.fixture(scope="module")
def catalog(spark, parsed):
    ambiguous = spark.createDataFrame([(0, 11, "Nạm")], "row_no int, page int, text string")
    typos = spark.createDataFrame([(12, "x Áp y")], "page int, line string")
    notes = spark.createDataFrame([], "row_no int, printed_page int, reading string, theirs string, verified_by string")
    tables = ingest.build_tables(parsed, ambiguous, typos, notes)
    with pytest.raises(ValueError, match="no entry owns"):
        ingest.build_tables(parsed, spark.createDataFrame([(0, 900, "Nạm")], "row_no int, page int, text string"), typos, notes)
    bridge = spark.createDataFrame([(0, "quấc", "quốc", "")], "row_no int, old string, new string, note string")
    return Catalog(*(tables[n].cache() for n in ("entry", "sub_entry", "glyph", "page", "front_matter")), bridge)


def test_catalog(catalog):
    assert [(r.slug, r.needs_review) for r in catalog.entries_in_order().collect()] == [("a", True), ("a-2", False), ("ap", True)]
    one = catalog.lookup("a").head()
    assert (one.previous, one.next, len(one.subs), one.head_first) == (None, "a-2", 2, "A")
    assert catalog.search("A")["results"].head().seq == 1 and "suggestions" not in catalog.search("A")
    assert catalog.search("zzz")["suggestions"].count() <= SUGGESTIONS
    assert [r.seq for r in catalog.by_letter("a")[0].collect()] == [1, 2, 3] and catalog.by_letter("b")[1].head().total == 0
    assert catalog.entry_of_the_day(4).head().seq == 2
    assert [r.seq for r in catalog.page_view(12)[1].collect()] == [2, 3] and [r.seq for r in catalog.glyph_view("阿").collect()] == [1, 2]
    s = catalog.stats().head()
    assert (s.entries, s.sub_entries, s.glyphs, s.pages, s.image_entries, s.review) == (3, 2, 2, 1038, 0, 2)
    f = catalog.front_matters().head()
    assert (f.page, f.title, f.body) == (5, "LỜI NÓI", "LỜI NÓI\nbody")


def test_closure_with_cycles(spark):
    edges = spark.createDataFrame([(1, 2), (2, 3), (3, 1), (4, 5)], "src int, dst int")
    assert sorted(map(tuple, composite_closure(edges, spark.createDataFrame([(1,), (4,), (9,)], "node int")).collect())) == [(1, 1), (1, 2), (1, 3), (4, 4), (4, 5), (9, 9)]


def test_streamed_assembly(spark, tmp_path):
    rows = [("b", 0, i, r) for i, r in enumerate(["continuation", "headword", "sub_entry", "continuation", "page_number", "headword", "sub_entry", "sub_entry"])]
    schema = "book string, page int, line_no int, role string"
    for k in (0, 1):
        spark.createDataFrame(rows[4 * k : 4 * k + 4], schema).coalesce(1).write.mode("append").json(str(tmp_path / "in"))
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).json(str(tmp_path / "in"))
    q = harvest.assemble_stream(stream).writeStream.format("memory").queryName("assembled").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = sorted((r.line_no, r.entry_no, r.block_no) for r in spark.table("assembled").collect())
    assert got == [(0, 0, None), (1, 1, 0), (2, 1, 1), (3, 1, 1), (5, 2, 0), (6, 2, 1), (7, 2, 2)]


def test_harvest(spark):
    pages = spark.createDataFrame([("a", 1, 3), ("a", 2, 4), ("b", 1, 3)], "title string, revid long, quality int")
    assert sorted(map(tuple, harvest.latest_pages(pages).collect())) == [("a", 2, 4), ("b", 1, 3)]
    tag = spark.createDataFrame([('<pagequality level="3" user="X" />',), ("",)], "w string")
    level, user = harvest.quality(F.col("w"))
    assert [tuple(r) for r in tag.select(level, user).collect()] == [(3, "X"), (None, None)]


def test_every_query_has_sql():
    assert set(ORACLES) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, sf_dir, name):
    import os

    import duckdb

    con = duckdb.connect()
    for t in os.listdir(sf_dir):
        path = f"{sf_dir}/{t}"
        con.execute(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if os.path.isdir(path) else ''}')")
    df = QUERIES[name](spark, sf_dir)
    columns = sorted(df.columns)
    cursor = con.execute(ORACLES[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == columns
    at = [names.index(c) for c in columns]
    show = lambda v: float(f"{v:.9g}") if isinstance(v, float) else v
    expected = sorted(repr([show(r[i]) for i in at]) for r in cursor.fetchall())
    assert sorted(repr([show(v) for v in r]) for r in df.select(*columns).collect()) == expected


def test_stores_are_inspected(catalog):
    from glosswork.plans.catalog import inspect_store, orphans

    tables = {n: getattr(catalog, n) for n in ("entry", "sub_entry", "glyph", "page", "front_matter")}
    assert inspect_store(tables) == []
    assert {r.n for r in orphans(tables).collect()} == {0}
    broken = tables | {"page": tables["page"].withColumn("page", F.col("page").cast("string"))}
    del broken["glyph"]
    assert inspect_store(broken) == ["no table glyph", "page.page: string, not int"]


def test_every_line_item_has_a_column(spark, tmp_path):
    items = [(1, 1, 9.5, 100.004, 0.0), (1, 2, 10.0, 200.0, 0.05), (2, 1, 3.0, 1.0, None)]
    spark.createDataFrame(items, "l_orderkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double").write.parquet(f"{tmp_path}/lineitem.parquet")
    got = QUERIES["column_whole"](spark, str(tmp_path)).orderBy("l_orderkey", "l_linenumber")
    assert [tuple(r) for r in got.collect()] == [(1, 1, "left", 100.0), (1, 2, "right", 200.0), (2, 1, "left", 1.0)]


def test_every_wiki_page_has_a_row(spark, tmp_path):
    pages = {1: "a {{x|y}} <b>b</b>", 2: "{{SIC|nad|and}} [[to|from]]", 3: "a > b", 4: "a <b", 5: "plain", 6: "{{x}}"}
    spark.createDataFrame(list(pages.items()), "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    want = {1: "a b", 2: "nad from", 3: "a b", 4: "a", 5: "plain", 6: ""}
    got = {r.page_id: (r.blank, r.plain) for r in QUERIES["wiki_text"](spark, str(tmp_path)).collect()}
    assert got == {k: (v == "", hashlib.md5(v.encode()).hexdigest()) for k, v in want.items()}


def test_runs_of_several_labels_count(spark, tmp_path):
    lines = ["a word of.", "a word of. the.", "a word. the. of. ", "an. of.", "a n. of.", "a c.n. the. cn.", "of.", " of.", "of. the. x", "a word n."]
    spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    assert sorted(r.doc_id for r in QUERIES["label_whole"](spark, str(tmp_path)).collect()) == [0, 1, 2, 4, 5, 7]


def test_every_containment_is_found(spark, tmp_path):
    spark.createDataFrame([(i, f"x item {i % 3} y") for i in range(-2, 90)], "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(7, "item 0"), (31, "item 2"), (3, "none")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = sorted(map(tuple, QUERIES["contains_whole"](spark, str(tmp_path)).collect()))
    assert got == sorted((i, {0: 7, 2: 31}[i % 3]) for i in range(-2, 90) if i % 3 != 1)


def test_page_range(spark):
    entries = spark.createDataFrame([(1, 9, "a b"), (2, 10, "a b"), (3, 11, "a b"), (4, 12, "a b"), (5, 10, "b")], "seq int, page int, text string")
    lines = spark.createDataFrame([(0, 10, "a")], "row_no int, page int, text string")
    assert sorted(map(tuple, dossier.by_page_range(entries, lines).collect())) == [(1, 0), (2, 0), (3, 0)]


def test_head_reports(spark, parsed):
    kinds, labels = gates.head_reports(parsed.lines)
    assert {r.kind: r.n for r in kinds.collect()} == {"bmp": 2} and {r.labels: r.n for r in labels.collect()} == {"c.": 1, "c. n.": 1}


def test_residual_forms(spark):
    segments = lambda form: [("italic", form), ("regular", ". Nghĩa.")]
    forms = ["― a", "b | c", "d", "e | ―", "f |"]
    lines = spark.createDataFrame([("b", 1 + i // 3, 1 + i % 3, 11 + i, "sub_entry", segments(x)) for i, x in enumerate(forms)], "book string, entry_no long, block_no long, page int, role string, segments array<struct<style:string,text:string>>")
    entries = spark.createDataFrame([("b", 1, "A"), ("b", 2, "B")], "book string, entry_no long, reading string")
    every = [(r.entry_no, r.block_no, r.page) for r in assemble.residual_forms(lines, entries).collect()]
    assert every == [(1, 2, 12), (2, 1, 14), (2, 2, 15)]
    assert [(r.entry_no, r.block_no, r.page) for r in assemble.residual_forms(lines, entries, 2).collect()] == every[:2]


def test_alignment_query_looks_ahead(spark, tmp_path):
    suppliers, customers = [1, 2, 9, 3, 4], [1, 7, 7, 2, 3, 4, 4]
    spark.createDataFrame([(i, n, 0.0) for i, n in enumerate(suppliers)], "s_suppkey long, s_nationkey int, s_acctbal double").write.parquet(f"{tmp_path}/supplier.parquet")
    spark.createDataFrame([(i, n, "X") for i, n in enumerate(customers)], "c_custkey long, c_nationkey int, c_mktsegment string").write.parquet(f"{tmp_path}/customer.parquet")
    got = QUERIES["edition_alignment"](spark, str(tmp_path)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted([(0, 0), (1, 3), (3, 4), (4, 5), (2, None), (None, 1), (None, 2), (None, 6)], key=repr)
