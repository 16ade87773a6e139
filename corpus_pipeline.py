"""The corpus pipeline: documents to a mixed training corpus in five stages.

Each stage takes ``(spark, docs, sf_dir)`` and works on all rows its predecessor kept.
Stages are written as Parquet and read again, so a stage is never computed twice and
a lost executor costs no more than the stage at work.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glosswork.llm.decontam import drop_leaks
from glosswork.llm.linededup import dedup_lines
from glosswork.llm.mixing import emit_mix
from glosswork.llm.ngramjoin import ngram_components
from glosswork.llm.store import Scratch
from glosswork.llm.toxicity import drop_toxic, fit

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the trained model does not reject."""
    return drop_toxic(docs.select(*COLUMNS), fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet")))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that a smaller id holds; documents of which only blank lines are left go."""
    out = dedup_lines(docs.select(*COLUMNS))
    cut = F.col("_ld_n_dropped") > 0
    out = out.where(~cut | F.col("_ld_kept").rlike(r"[^\x20\x09-\x0D]"))
    return out.select("doc_id", F.col("_ld_kept").alias("text"), "lang", "source", F.when(cut, F.length("_ld_kept").cast("long")).otherwise(F.col("n_chars")).alias("n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that of the smallest id, of each group linked by five-word shingles at 0.8 or more.

    Rows without id stay, and rows that repeat an id stay or go together.
    """
    others = ngram_components(docs, words=5, num=80, den=100).where("doc_id <> component_id")
    return docs.select(*COLUMNS).join(others.select("doc_id").distinct(), "doc_id", "left_anti").select(*COLUMNS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of a benchmark item."""
    return drop_leaks(docs.select(*COLUMNS), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The corpus mixed to the sources' target weights; repeated documents occur as repeated rows."""
    return emit_mix(docs.select(*COLUMNS))


STAGES = [("toxicity", toxicity), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mixing", mixing)]

#: The first stage is a trained model, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    scratch = Scratch(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = scratch.write(stage(spark, docs, sf_dir), name)
    return docs
