"""JSON Lines, spreadsheets, dossiers, staged writes and shards.

Schemas are fixed and versioned: a record of another version stops the read.
"""

from __future__ import annotations

import gzip
import io
import json
import re
import tomllib
import uuid
import zipfile
from pathlib import Path
from xml.etree import ElementTree

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Versions and shapes of the records between steps.
PAGES_VERSION, ENTRIES_VERSION, REPORT_VERSION = 2, 1, 1
PAGES_SCHEMA = "schema_version int, pdf_page int, width double, lines array<struct<column:string,y:double,segments:array<struct<style:string,text:string>>>>, unmapped array<struct<font:string,code:int>>"
ENTRIES_SCHEMA = (
    "schema_version int, seq int, pdf_page int, printed_page int, glyph string, glyph_kind string, inherits_glyph boolean, reading string, alternate string, pos array<string>, gloss string, "
    "sub_entries array<struct<han_form:string,han_expanded:string,form:string,form_expanded:string,definition:string,needs_review:boolean>>"
)
WITNESS_SCHEMA = "volume int, scan_page int, title string, revid long, timestamp string, quality int, quality_user string, wikitext string"
SHARD_ROWS = 100


def _versioned(df: DataFrame, version: int) -> DataFrame:
    wrong = F.raise_error(F.concat(F.lit("record version "), F.coalesce(F.col("schema_version").cast("string"), F.lit("missing")))).cast("int")
    return df.withColumn("schema_version", F.when(F.col("schema_version") == version, F.col("schema_version")).otherwise(wrong))


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return _versioned(spark.read.schema(PAGES_SCHEMA).option("mode", "FAILFAST").json(path), PAGES_VERSION)


def read_entries(spark: SparkSession, path: str) -> DataFrame:
    return _versioned(spark.read.schema(ENTRIES_SCHEMA).option("mode", "FAILFAST").json(path), ENTRIES_VERSION)


def read_witness_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(WITNESS_SCHEMA).option("mode", "FAILFAST").json(path)


def page_lines(pages: DataFrame, book: str = "book") -> tuple[DataFrame, DataFrame]:
    """(lines, unmapped) of page records: lines (book, page, line_no, column, y, segments, text)."""
    lines = pages.select(F.lit(book).alias("book"), F.col("pdf_page").alias("page"), F.posexplode("lines").alias("line_no", "l"))
    lines = lines.select("book", "page", "line_no", "l.column", "l.y", "l.segments", F.array_join(F.transform("l.segments", lambda s: s["text"]), "").alias("text"))
    unmapped = pages.select(F.lit(book).alias("book"), F.col("pdf_page").alias("page"), F.explode("unmapped").alias("u")).select("book", "page", "u.font", "u.code")
    return lines, unmapped


def page_records(lines: DataFrame, unmapped: DataFrame, widths: DataFrame) -> DataFrame:
    """Records of PAGES_SCHEMA from lines (page, line_no, column, y, segments), unmapped (page, font, code) and widths (page, width).

    Pages without lines or codes have empty lists.
    """
    nested = lines.groupBy("page").agg(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "column", "y", "segments"))), lambda s: F.struct(s["column"].alias("column"), s["y"].alias("y"), s["segments"].alias("segments"))).alias("lines"))
    codes = unmapped.groupBy("page").agg(F.array_sort(F.collect_list(F.struct("font", "code"))).alias("unmapped"))
    none = {"lines": "array<struct<column:string,y:double,segments:array<struct<style:string,text:string>>>>", "unmapped": "array<struct<font:string,code:int>>"}
    out = widths.join(nested, "page", "left").join(codes, "page", "left")
    return out.select(F.lit(PAGES_VERSION).alias("schema_version"), F.col("page").alias("pdf_page"), "width", *[F.coalesce(n, F.array().cast(t)).alias(n) for n, t in none.items()])


def extraction_report(pages: DataFrame) -> DataFrame:
    """(pages, empty_pages, lines, unmapped, unmapped_pages) of page records, one row."""
    return pages.agg(F.count("*").alias("pages"), F.count_if(F.size("lines") == 0).alias("empty_pages"), F.sum(F.size("lines")).alias("lines"), F.sum(F.size("unmapped")).alias("unmapped"), F.count_if(F.size("unmapped") > 0).alias("unmapped_pages"))


def size_report(spark: SparkSession, path: str) -> DataFrame:
    """(part, files, bytes, gz_bytes, largest_gz) of the files below ``path``: by its folders and files, ``shard=`` folders as one, and in ``total``."""
    packed = F.udf(lambda data: len(gzip.compress(data, 9)), "long")
    root = _hadoop(spark, path)[0].toUri().getPath().rstrip("/")
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    part = F.regexp_extract(F.col("path"), r"(?s)^.*?" + re.escape(root) + r"/+([^/]*)", 1)
    rows = files.select(F.when(part.startswith("shard="), "shards").otherwise(part).alias("part"), F.col("length").alias("b"), packed("content").alias("g"))
    sums = [F.count("*").alias("files"), F.coalesce(F.sum("b"), F.lit(0)).alias("bytes"), F.coalesce(F.sum("g"), F.lit(0)).alias("gz_bytes"), F.max("g").alias("largest_gz")]
    return rows.groupBy("part").agg(*sums).unionByName(rows.agg(F.lit("total").alias("part"), *sums))


def write_report(gates: DataFrame, path: str, source: str, mark: dict) -> None:
    """The gate report: version, source, fingerprint of the input, and one record a gate, as indented JSON."""
    rows = [r.asDict() for r in gates.orderBy("gate").collect()]
    body = json.dumps({"version": REPORT_VERSION, "source": source, "fingerprint": mark, "gates": rows}, ensure_ascii=False, indent=2)
    p, fs = _hadoop(gates.sparkSession, path)
    stream = fs.create(p, True)
    stream.write(bytearray(body.encode()))
    stream.close()


def read_report(spark: SparkSession, path: str) -> tuple[DataFrame, dict]:
    """(gates, fingerprint) of a report; another version stops the read."""
    report = json.loads(read_bytes(spark, path))
    if report.get("version") != REPORT_VERSION:
        raise ValueError(f"report version {report.get('version')}")
    schema = "gate int, name string, measured long, allowed long, status string, note string"
    return spark.createDataFrame([tuple(g[c.split()[0]] for c in schema.split(", ")) for g in report["gates"]], schema), report["fingerprint"]


def entry_records(entries: DataFrame, subs: DataFrame) -> DataFrame:
    """Records of ENTRIES_SCHEMA in seq order within partitions; sub-entries nested in order."""
    fields = ["han_form", "han_expanded", "form", "form_expanded", "definition", "needs_review"]
    nested = subs.groupBy("seq").agg(F.transform(F.array_sort(F.collect_list(F.struct("sub_seq", *fields))), lambda s: F.struct(*[s[f].alias(f) for f in fields])).alias("sub_entries"))
    empty = F.array().cast("array<struct<han_form:string,han_expanded:string,form:string,form_expanded:string,definition:string,needs_review:boolean>>")
    out = entries.join(nested, "seq", "left").withColumns({"sub_entries": F.coalesce("sub_entries", empty), "schema_version": F.lit(ENTRIES_VERSION)})
    names = [x.split()[0] for x in re.split(r", (?![^<]*>)", ENTRIES_SCHEMA)]
    return out.select(*names)


def write_json(df: DataFrame, path: str, order: list[str]) -> None:
    """Ordered over the files: the parts in name order hold the rows in order."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").json(path)


def _hadoop(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def read_bytes(spark: SparkSession, path: str) -> bytes:
    """One small file through Spark's file systems."""
    return bytes(spark.read.format("binaryFile").load(path).select("content").head()[0])


def read_index_xlsx(spark: SparkSession, path: str, sheet: str) -> DataFrame:
    """(row_no, glyph, readings): the first two string cells of each row of one sheet, without header and blank rows."""
    space = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "r": "http://schemas.openxmlformats.org/officeDocument/2006/relationships"}
    with zipfile.ZipFile(io.BytesIO(read_bytes(spark, path))) as z:
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        wanted = next((s for s in book.iterfind(".//m:sheet", space) if s.get("name") == sheet), None)
        if wanted is None:
            raise ValueError(f"no sheet {sheet!r}")
        links = {r.get("Id"): r.get("Target") for r in ElementTree.fromstring(z.read("xl/_rels/workbook.xml.rels"))}
        target = links[wanted.get(f"{{{space['r']}}}id")].lstrip("/")
        target = target if target.startswith("xl/") else f"xl/{target}"
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(t.text or "" for t in si.iterfind(".//m:t", space)) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iterfind("m:si", space)]
        rows = []
        for n, row in enumerate(ElementTree.fromstring(z.read(target)).iterfind(".//m:row", space)):
            cells: dict[str, str] = {}
            for c in row.iterfind("m:c", space):
                column = re.match("[A-Z]+", c.get("r") or "A")[0]
                value = c.find("m:v", space)
                if c.get("t") == "s" and value is not None:
                    cells[column] = shared[int(value.text)]
                elif c.get("t") == "inlineStr":
                    cells[column] = "".join(t.text or "" for t in c.iterfind(".//m:t", space))
                elif c.get("t") == "str" and value is not None:
                    cells[column] = value.text or ""
            a, b = cells.get("A", "").strip(), cells.get("B", "").strip()
            if n and a and b:
                rows.append((n, a, b))
    from glosswork.functions.text import nfc

    out = spark.createDataFrame(rows, "row_no int, glyph string, readings string")
    return out.withColumns({"glyph": nfc(F.col("glyph")), "readings": nfc(F.col("readings"))})


def read_dossier(spark: SparkSession, path: str, table: str, schema: str) -> DataFrame:
    """Rows of ``[[table]]`` with row_no and the columns of ``schema``. A missing file is an error, a missing table is empty."""
    rows = tomllib.loads(read_bytes(spark, path).decode()).get(table, [])
    names = [x.split()[0] for x in schema.split(", ")]
    return spark.createDataFrame([(i, *[r.get(n) for n in names]) for i, r in enumerate(rows)], f"row_no int, {schema}")


def toml_string(s: str) -> str:
    named = {'"': '\\"', "\\": "\\\\", "\n": "\\n", "\r": "\\r", "\t": "\\t"}
    return '"' + "".join(named.get(c) or (f"\\u{ord(c):04X}" if ord(c) < 0x20 else c) for c in s) + '"'


def write_dossier(df: DataFrame, path: str, table: str, header: str, fields: list[str]) -> int:
    """Rewrite a dossier file; signatures of recurring keys stay. Returns how many stayed."""
    from glosswork.operators.dossier import upsert

    spark = df.sparkSession
    p, fs = _hadoop(spark, path)
    old = read_dossier(spark, path, table, "key string, verified_by string") if fs.exists(p) else spark.createDataFrame([], "row_no int, key string, verified_by string")
    rows = upsert(df, old).orderBy("row_no").collect()
    out = [header.rstrip("\n") + "\n"]
    for r in rows:
        out.append(f"\n[[{table}]]\nkey = {toml_string(r['key'])}\n")
        for f in fields:
            out.append(f"{f} = {toml_string(r[f]) if isinstance(r[f], str) else r[f]}\n")
        out.append(f"verified_by = {toml_string(r['verified_by'])}\n")
    stream = fs.create(p, True)
    stream.write(bytearray("".join(out).encode()))
    stream.close()
    return sum(r["verified_by"] != "" for r in rows)


def replace_tables(tables: dict[str, DataFrame], root: str) -> str:
    """Write all tables beside the current ones, then switch the pointer file, so a failed load changes nothing.

    Readers follow ``current``. Returns the new version's folder.
    """
    spark = next(iter(tables.values())).sparkSession
    version = f"{root}/v-{uuid.uuid4().hex[:12]}"
    for name, df in tables.items():
        df.write.mode("errorifexists").parquet(f"{version}/{name}")
    pointer, fs = _hadoop(spark, f"{root}/current.tmp")
    stream = fs.create(pointer, True)
    stream.write(bytearray(version.encode()))
    stream.close()
    final, _ = _hadoop(spark, f"{root}/current")
    fs.delete(final, False)
    if not fs.rename(pointer, final):
        raise OSError(f"cannot switch {root}/current")
    return version


def open_tables(spark: SparkSession, root: str, names: list[str]) -> dict[str, DataFrame]:
    version = read_bytes(spark, f"{root}/current").decode()
    return {n: spark.read.parquet(f"{version}/{n}") for n in names}


def shard_of(order: Column, rows: int = SHARD_ROWS) -> Column:
    """Shard of the row at place ``order``, from 1."""
    return F.floor((order - 1) / rows).cast("int")


def write_shards(entries: DataFrame, path: str, rows: int = SHARD_ROWS) -> None:
    """One JSON folder for each ``rows`` entries in seq order. ``seq`` counts from 1 without gaps."""
    own = entries.withColumn("shard", shard_of(F.col("seq"), rows))
    own.repartitionByRange("shard").sortWithinPartitions("shard", "seq").write.mode("overwrite").partitionBy("shard").json(path)


def read_shard(spark: SparkSession, path: str, shard: int, schema: str) -> DataFrame:
    """Only the shard's folder is read."""
    return spark.read.schema(schema + ", shard int").json(path).where(F.col("shard") == shard)


def sitemap(letters: DataFrame, pages: DataFrame, entries: DataFrame) -> DataFrame:
    """(place, kind, address) of all letters, pages and entries in order."""
    parts = letters.select(F.lit(0).alias("_k"), F.col("rank").cast("long").alias("_o"), F.concat(F.lit("/chu/"), "name").alias("address"))
    parts = parts.unionByName(pages.select(F.lit(1).alias("_k"), F.col("page").cast("long").alias("_o"), F.concat(F.lit("/trang/"), "address").alias("address")))
    parts = parts.unionByName(entries.select(F.lit(2).alias("_k"), F.col("seq").cast("long").alias("_o"), F.concat(F.lit("/muc/"), "slug").alias("address")))
    kinds = F.element_at(F.array(F.lit("letter"), F.lit("page"), F.lit("entry")), F.col("_k") + 1)
    return parts.select(kinds.alias("kind"), F.row_number().over(Window.partitionBy("_k").orderBy("_o")).alias("place"), "address")


def api_rows(df: DataFrame) -> DataFrame:
    """(json): each row as the JSON of its columns."""
    return df.select(F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("json"))


def local_text(path: str) -> str:
    return Path(path).read_text(encoding="utf-8")
