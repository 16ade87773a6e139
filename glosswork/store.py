"""Shared scratch storage for multi-step operators.

Steps that must not be recomputed are written as Parquet below
``spark.checkpoint.dir`` (a folder that driver and executors share) and read
back, which cuts the lineage and survives the loss of any executor.
"""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used only by a local session that names no shared folder, as in tests.
LOCAL_DIR = "/tmp/glosswork-checkpoint"
#: Rows in one file of a table whose size is known.
FILE_ROWS = 250_000


def shared_folder(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Only a local session, whose executors are the driver, may do without."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base and not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    return (base or LOCAL_DIR).rstrip("/")


class Scratch:
    """A private folder below the shared checkpoint folder."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str, most_rows: int | None = None) -> DataFrame:
        """Write ``df`` once and return the reader of what was written. A known bound of its rows keeps the files few."""
        if most_rows is not None:
            df = df.coalesce(max(1, -(-most_rows // FILE_ROWS)))
        df.write.mode("overwrite").parquet(self.path(name))
        return self.read(name, df)

    def read(self, name: str, like: DataFrame) -> DataFrame:
        return self.spark.read.schema(like.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        """Delete tables that no later step reads."""
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def keep(self, *starts: str) -> None:
        """Delete all tables but those whose names start so, once nothing reads the others."""
        root = self.spark._jvm.org.apache.hadoop.fs.Path(self.root)
        files = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        for found in files.listStatus(root) if files.exists(root) else []:
            if not found.getPath().getName().startswith(starts):
                files.delete(found.getPath(), True)
