"""Secret scans through a ledger of content-addressed blobs, with DataFrame functions only.

Every version of every path is known by the SHA-256 of its content. The ledger
holds the (blob, rule, rule version) triples scanned so far and the findings.
A scan takes only blobs with a rule the ledger has not met on them, applies just
those rules, appends to the ledger, and joins the findings back to all paths.

Offsets come from cutting the text at the matches: a match starts after all cuts
and matches before it. Offsets are code points, ends are exclusive.

Defined results
* null content is the empty text, which has no findings;
* repeated rows and copies share one blob and are scanned once;
* several matches at one place are listed in the order of the rules;
* an empty table gives no rows; other columns are carried by ``find_secrets``.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from glosswork.llm.store import Scratch


@dataclass(frozen=True)
class Rule:
    kind: str
    pattern: str
    #: The group whose length counts, and its least length.
    group: int = 0
    least: int = 0
    version: int = 1
    #: A cheap test that every text with a match passes.
    hint: str | None = None


# The patterns of the three base kinds, then those the method adds.
ASSIGN = r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
BASE_RULES = (
    Rule("assign", ASSIGN, 2, 6),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 20, hint="AKIA"),
    Rule("hex", r"[0-9a-f]{24,}", 0, 24),
)
MORE_RULES = (
    Rule("pem", r"-----BEGIN [A-Z0-9 ]*PRIVATE KEY-----", hint="PRIVATE KEY-----"),
    Rule("forge", r"gh[opsur]_[A-Za-z0-9]{36,}", hint="gh"),
    Rule("chat", r"xox[abeoprs]-[A-Za-z0-9-]{10,}", hint="xox"),
    Rule("webtoken", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+", hint="eyJ"),
)
RULES = BASE_RULES + MORE_RULES
#: Shuffle partitions whose findings share a file, once there are more such files than tasks at a time.
PARTITIONS_A_FILE = 16


class BlobLedger:
    """Findings and scanned pairs below ``root``, a folder that all executors share."""

    SCANNED = "blob string, kind string, version int"
    FINDINGS = "blob string, kind string, version int, start long, end long"

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root
        for name, schema in (("scanned", self.SCANNED), ("findings", self.FINDINGS)):
            path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/{name}")
            if not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
                spark.createDataFrame([], schema).write.parquet(f"{root}/{name}")

    def scanned(self) -> DataFrame:
        return self.spark.read.schema(self.SCANNED).parquet(f"{self.root}/scanned")

    def findings(self) -> DataFrame:
        return self.spark.read.schema(self.FINDINGS).parquet(f"{self.root}/findings")


def _hits(blobs: DataFrame, rules: tuple[Rule, ...]) -> DataFrame:
    """(blob, kind, version, start, end) of every match of the rules a blob has still to meet (``_todo``)."""
    parts = []
    for rule in rules:
        text = F.col("_text")
        wanted = F.array_contains("_todo", rule.kind)
        if rule.hint:
            wanted &= text.contains(rule.hint)
        wanted &= text.rlike(rule.pattern)
        found = F.struct(
            F.lit(rule.kind).alias("kind"),
            F.lit(rule.version).alias("version"),
            F.transform(F.split(text, rule.pattern, -1), lambda x: F.length(x).cast("long")).alias("gaps"),
            F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(0)), lambda x: F.length(x).cast("long")).alias("sizes"),
            F.transform(F.regexp_extract_all(text, F.lit(rule.pattern), F.lit(rule.group)), lambda x: F.length(x) >= rule.least).alias("good"),
        )
        parts.append(F.when(wanted, found))
    each = blobs.select("blob", F.explode(F.filter(F.array(*parts), lambda x: x.isNotNull())).alias("_f"))
    rows = each.select("blob", "_f.kind", "_f.version", F.posexplode(F.arrays_zip("_f.sizes", "_f.gaps", "_f.good")).alias("_i", "_m"))
    ordered = Window.partitionBy("blob", "kind").orderBy("_i")
    # The last zipped row is the cut after the last match: its size is null.
    rows = rows.withColumn("_end", F.sum(F.col("_m.gaps") + F.coalesce(F.col("_m.sizes"), F.lit(0))).over(ordered))
    return rows.where(F.col("_m.good")).select("blob", "kind", "version", (F.col("_end") - F.col("_m.sizes")).alias("start"), F.col("_end").alias("end"))


def _few_files(rows: DataFrame) -> DataFrame:
    """The same rows in few files: a partition of the scan has a handful of them, and the ledger keeps its files for good.

    Each file costs an executor several processes where Hadoop has no native library (``chmod``).
    """
    spark = rows.sparkSession
    return rows.repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")) // PARTITIONS_A_FILE))


def scan(versions: DataFrame, ledger: BlobLedger, *, rules: tuple[Rule, ...] = RULES) -> None:
    """Scan what the ledger has not met of (blob, _text), then append to the ledger."""
    table = F.array(*[F.struct(F.lit(r.kind).alias("kind"), F.lit(r.version).alias("version")) for r in rules])
    pairs = versions.select("blob").distinct().select("blob", F.explode(table).alias("_r")).select("blob", "_r.kind", "_r.version")
    todo = pairs.join(ledger.scanned(), ["blob", "kind", "version"], "left_anti").groupBy("blob").agg(F.collect_set("kind").alias("_todo"))
    scratch = Scratch(ledger.spark, "secrets")
    todo = scratch.write(_few_files(todo), "todo")
    blobs = versions.groupBy("blob").agg(F.first("_text").alias("_text")).join(todo, "blob")
    _few_files(_hits(blobs, rules)).write.mode("append").parquet(f"{ledger.root}/findings")
    versions_of = F.create_map(*[x for r in rules for x in (F.lit(r.kind), F.lit(r.version))])
    todo.select("blob", F.explode("_todo").alias("kind")).select("blob", "kind", versions_of[F.col("kind")].alias("version")).write.mode("append").parquet(f"{ledger.root}/scanned")
    scratch.drop("todo")


def span_list(spans: Column) -> Column:
    """``kind:start:end`` of sorted (start, rank, kind, end) structs, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def find_secrets(docs: DataFrame, *, text_col: str = "text", rules: tuple[Rule, ...] = RULES, ledger: BlobLedger | None = None) -> DataFrame:
    """``docs`` with ``_sec_spans``: sorted structs (start, rank, kind, end) of all findings of its content.

    A ledger kept between calls makes later scans incremental.
    """
    spark = docs.sparkSession
    ledger = ledger or BlobLedger(spark, Scratch(spark, "ledger").root)
    text = F.coalesce(F.col(text_col), F.lit(""))
    scan(docs.select(F.sha2(text, 256).alias("blob"), text.alias("_text")), ledger, rules=rules)
    rank = F.create_map(*[x for i, r in enumerate(rules) for x in (F.lit(r.kind), F.lit(i))])
    current = F.create_map(*[x for r in rules for x in (F.lit(r.kind), F.lit(r.version))])
    found = ledger.findings().where(F.col("version") == current[F.col("kind")])
    spans = found.groupBy("blob").agg(F.array_sort(F.collect_set(F.struct("start", rank[F.col("kind")].alias("rank"), "kind", "end"))).alias("_sec_spans"))
    spans = spans.withColumnRenamed("blob", "_sec_blob")
    joined = docs.withColumn("_sec_blob", F.sha2(text, 256)).join(spans, "_sec_blob", "left").drop("_sec_blob")
    empty = F.array().cast("array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    return joined.withColumn("_sec_spans", F.coalesce("_sec_spans", empty))
