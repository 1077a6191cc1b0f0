"""Session-level helpers: shared scratch tables and table loading.

Iterative operators cut their lineage by writing a parquet table below the
folder named by ``spark.checkpoint.dir``.  That folder is shared by all
executors, so a lost executor never loses a written table.  Only where the
setting is missing (tests on one machine) a temporary folder is used.
"""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

SCRATCH_KEY = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The session's shared scratch folder; a local one is made only if unset and all runs on this machine.

    On a cluster an executor would write to its own disk, so there the setting is required.
    """
    folder = spark.conf.get(SCRATCH_KEY, None) or spark.sparkContext.getConf().get(SCRATCH_KEY, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"{SCRATCH_KEY} must name a folder that all executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="tessella-")
        spark.conf.set(SCRATCH_KEY, folder)
    return folder.rstrip("/")


#: Folders of all operator calls of this process, for ``release``.
_MADE: list[str] = []


def release(spark: SparkSession) -> None:
    """Removes the tables of all operator calls so far; for when their results are read or stored."""
    for base in _MADE:
        target = spark._jvm.org.apache.hadoop.fs.Path(base)
        target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
    _MADE.clear()


class Scratch:
    """Tables written during one operator call, under one sub-folder.

    ``write`` stores a DataFrame and returns a reader of it.  ``drop`` removes
    a table that no later plan reads; tables that the returned DataFrame still
    reads stay until the folder itself is cleaned.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.base = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex[:12]}"
        _MADE.append(self.base)
        self.count = 0
        self.paths: dict[str, str] = {}

    def write(self, df: DataFrame, name: str) -> DataFrame:
        self.count += 1
        path = f"{self.base}/{self.count:03d}-{name}"
        df.write.mode("overwrite").parquet(path)
        self.paths[name] = path
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, name: str) -> None:
        path = self.paths.pop(name, None)
        if path is None:
            return
        jvm = self.spark._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(target, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The parquet table ``name`` of ``folder``."""
    return spark.read.parquet(f"{folder}/{name}.parquet")


def is_empty(df: DataFrame) -> bool:
    return not df.take(1)


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application."""
    context = spark.sparkContext
    mark = "spark.tessella.shipped"
    if spark.conf.get(mark, None) == context.applicationId:
        return
    root = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="tessella-zip-")) / "tessella.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    context.addPyFile(str(target))
    spark.conf.set(mark, context.applicationId)
