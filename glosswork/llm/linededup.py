"""Line dedup over levelled sorted runs, with DataFrame functions only.

Documents come in batches of ascending id. The distinct line hashes of a batch
are joined against the sorted runs of all earlier batches; hashes not found
there become a new run of level 0, and ``fanout`` runs of one level are merged
into one run of the next. A line goes if its hash is in an earlier run, or if a
smaller id of its own batch holds it.

Runs are tables bucketed and sorted by hash: a batch is shuffled once, as distinct
hashes, and then merge-joined with every run where it lies; runs are never
shuffled. They live in a folder that the caller may keep: a later call with the
same ``LineRuns`` folder meets the lines of all batches before.

Only hashes are shuffled to find the lines; each text is shuffled once, to meet
the list of its dropped lines. A line is known by two 64-bit hashes of its key.

Defined results
* empty text is one empty line, which is kept; so is null text, whose kept text stays null;
* a null id counts as larger than every other id, and all its rows as one document;
* rows that repeat an id are one document: none loses lines to another;
* keys shorter than ``min_chars`` code points are always kept;
* an empty table gives no rows; other columns are carried by ``dedup_lines``, but for columns
  whose names start with ``_ld_``, which are an error.
"""

from __future__ import annotations

import uuid
import zlib
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from glosswork.llm.store import Scratch

SPACES = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LAST_ID = 2**63 - 1
HASHES = ["_ld_h1", "_ld_h2"]


def line_key(line: Column) -> Column:
    return F.translate(F.btrim(line, F.lit(SPACES)), UPPER, LOWER)


class LineRuns:
    """The sorted runs of all line hashes seen so far, below ``root``, a folder that all executors share, or else in ``scratch``.

    What a call adds counts for later readers of the folder only after ``commit``, which belongs after the call's
    result is stored: a call that fails before can be repeated.
    """

    SCHEMA = "_ld_h1 long, _ld_h2 long, _ld_owner long, _ld_last long, _ld_seen boolean"

    def __init__(self, scratch: Scratch, fanout: int = 2, root: str | None = None):
        self.spark, self.root, self.fanout = scratch.spark, (root or scratch.path("runs")).rstrip("/"), fanout
        spark = self.spark
        self.files = spark._jvm.org.apache.hadoop.fs.Path(self.root).getFileSystem(spark._jsc.hadoopConfiguration())
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        self.levels: list[list[str]] = []
        self.version = 0
        for found in self.files.listStatus(self._path("")) if self.files.exists(self._path("")) else []:
            name = found.getPath().getName()
            if name.startswith("manifest-") and self.files.exists(self._path(f"{name}/_SUCCESS")):
                self.version = max(self.version, int(name.removeprefix("manifest-")))
        if self.version:
            rows = spark.read.schema("name string, level int, place int, buckets int").json(f"{self.root}/manifest-{self.version}").orderBy("level", "place").collect()
            self.buckets = rows[0].buckets
            self.levels = [[r.name for r in rows if r.level == k and r.name] for k in range(max(r.level for r in rows) + 1)]

    def _path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}" if name else self.root)

    def _name(self, name: str) -> str:
        return f"line_runs_{zlib.crc32(self.root.encode()):08x}_{name.replace('-', '_')}"

    def _table(self, name: str) -> str:
        """The catalogue's name of a run; a run of an earlier session is entered first."""
        table = self._name(name)
        if not self.spark.catalog.tableExists(table):
            keys = ", ".join(HASHES)
            self.spark.sql(f"CREATE TABLE {table} ({self.SCHEMA}) USING parquet CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.buckets} BUCKETS LOCATION '{self.root}/{name}'")
        return table

    def _write(self, run: DataFrame, name: str) -> DataFrame:
        self.spark.sql(f"DROP TABLE IF EXISTS {self._name(name)}")
        own = run.select([c.split(" ")[0] for c in self.SCHEMA.split(", ")])
        own.write.mode("overwrite").format("parquet").option("path", f"{self.root}/{name}").bucketBy(self.buckets, *HASHES).sortBy(*HASHES).saveAsTable(self._name(name))
        return self.read(name)

    def read(self, name: str) -> DataFrame:
        return self.spark.table(self._table(name))

    def seen(self) -> DataFrame | None:
        """All hashes in the runs. Runs are disjoint, since a batch adds only what none of them holds."""
        tables = [self.read(n).where(~F.col("_ld_seen")).select(*HASHES) for level in self.levels for n in level]
        return reduce(DataFrame.unionByName, tables) if tables else None

    def add(self, lines: DataFrame) -> DataFrame:
        """Merge one batch of (_ld_id, hashes) in. Returns (hashes, owner, last, seen): what the runs and the batch say of each hash."""
        status = lines.groupBy(*HASHES).agg(F.min("_ld_id").alias("_ld_owner"), F.max("_ld_id").alias("_ld_last"))
        if self.buckets != int(self.spark.conf.get("spark.sql.shuffle.partitions")):
            status = status.repartition(self.buckets, *HASHES)
        found = []
        for k, name in enumerate(n for level in self.levels for n in level):
            found.append(f"_ld_in{k}")
            status = status.join(self.read(name).where(~F.col("_ld_seen")).select(*HASHES, F.lit(True).alias(found[-1])).hint("merge"), HASHES, "left")
        status = status.withColumn("_ld_seen", F.coalesce(*found, F.lit(False)) if found else F.lit(False))
        name = f"run-{uuid.uuid4().hex[:8]}"
        status = self._write(status, name)
        self._insert(name, 0)
        return status

    def _insert(self, name: str, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        self.levels[level].append(name)
        if len(self.levels[level]) >= self.fanout:
            # A merge join of disjoint sorted runs is their merge.
            runs = [self.read(n).where(~F.col("_ld_seen")).select(*HASHES) for n in self.levels[level]]
            merged = reduce(lambda a, b: a.hint("merge").join(b, HASHES, "full_outer"), runs)
            name = f"run-{uuid.uuid4().hex[:8]}"
            self._write(merged.withColumns({"_ld_owner": F.lit(None).cast("long"), "_ld_last": F.lit(None).cast("long"), "_ld_seen": F.lit(False)}), name)
            self.levels[level] = []
            self._insert(name, level + 1)

    def commit(self) -> None:
        """Make the runs of this object those of the folder; runs that are merged into others go."""
        rows = [(n, k, i, self.buckets) for k, level in enumerate(self.levels) for i, n in enumerate(level)]
        self.version += 1
        self.spark.createDataFrame(rows or [("", 0, 0, self.buckets)], "name string, level int, place int, buckets int").coalesce(1).write.mode("overwrite").json(f"{self.root}/manifest-{self.version}")
        kept = {r[0] for r in rows}
        for found in self.files.listStatus(self._path("")):
            name = found.getPath().getName()
            if name.startswith("run-") and name not in kept:
                self.spark.sql(f"DROP TABLE IF EXISTS {self._name(name)}")
                self.files.delete(found.getPath(), True)


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 10, batches: int = 4, fanout: int = 2, runs: LineRuns | None = None) -> DataFrame:
    """``docs`` with ``_ld_n_lines``, ``_ld_n_dropped`` and ``_ld_kept`` (the lines that stay, joined by \\n).

    ``runs``: those of earlier calls; their lines go here too.
    """
    if taken := [c for c in docs.columns if c.startswith("_ld_")]:
        raise ValueError(f"columns with names of this operator: {taken}")
    scratch = Scratch(docs.sparkSession, "linededup")
    ident = F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID))
    text = F.coalesce(F.col(text_col), F.lit(""))
    base = docs.select(ident.alias("_ld_id"), F.xxhash64(text).alias("_ld_text"), F.posexplode(F.split(text, "\n", -1)).alias("_ld_pos", "_ld_line"))
    keyed = base.withColumn("_ld_key", line_key(F.col("_ld_line"))).where(F.length("_ld_key") >= min_chars)
    lines = keyed.select("_ld_id", "_ld_text", "_ld_pos", F.xxhash64("_ld_key").alias("_ld_h1"), F.xxhash64(F.lit(7), "_ld_key").alias("_ld_h2"))
    lines = scratch.write(lines, "lines")

    # Batch bounds need not be exact: any ascending split of the ids gives the same lines.
    bounds = lines.agg(F.percentile_approx("_ld_id", [k / batches for k in range(1, batches)], 1000)).head()[0] or []
    bounds = sorted(set(bounds))
    runs, verdicts = runs or LineRuns(scratch, fanout), []
    for k, upper in enumerate([*bounds, None]):
        lower = bounds[k - 1] if k else None
        mine = F.lit(True)
        if lower is not None:
            mine &= F.col("_ld_id") > lower
        if upper is not None:
            mine &= F.col("_ld_id") <= upper
        batch = lines.where(mine)
        status = runs.add(batch).where(F.col("_ld_seen") | (F.col("_ld_last") > F.col("_ld_owner")))
        verdicts.append(status.select(*HASHES, "_ld_owner", "_ld_seen", F.lit(k).alias("_ld_batch")))
    batch_of = F.lit(0)
    for upper in bounds:
        batch_of = batch_of + (F.col("_ld_id") > upper).cast("int")
    dropped = lines.withColumn("_ld_batch", batch_of).join(reduce(DataFrame.unionByName, verdicts), [*HASHES, "_ld_batch"])
    dropped = dropped.where(F.col("_ld_seen") | (F.col("_ld_id") > F.col("_ld_owner")))
    dropped = dropped.groupBy("_ld_id", "_ld_text").agg(F.collect_set("_ld_pos").alias("_ld_drops"))

    whole = docs.withColumns({"_ld_id": ident, "_ld_text": F.xxhash64(text), "_ld_lines": F.split(text, "\n", -1), "_ld_null": F.col(text_col).isNull()}).drop(text_col)
    kept = F.array_except(F.sequence(F.lit(0), F.size("_ld_lines") - 1), F.coalesce("_ld_drops", F.array().cast("array<int>")))
    # One struct holds the list of what stays, so that it is made once.
    done = whole.join(dropped, ["_ld_id", "_ld_text"], "left").withColumn("_ld_keep", kept)
    return done.select(
        *[F.col(f"`{c}`") for c in docs.columns if c != text_col],
        F.size("_ld_lines").cast("long").alias("_ld_n_lines"),
        (F.size("_ld_lines") - F.size("_ld_keep")).cast("long").alias("_ld_n_dropped"),
        F.when(F.col("_ld_null"), None).when(F.size("_ld_keep") == F.size("_ld_lines"), F.array_join("_ld_lines", "\n")).otherwise(F.array_join(F.transform("_ld_keep", lambda i: F.get("_ld_lines", i)), "\n")).alias("_ld_kept"),
    )
