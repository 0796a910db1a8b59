"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; where it is unset, one of our own, in local mode only:
    executors of a cluster would not see it."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            root = current.get()
        elif not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        else:
            root = "file://" + tempfile.mkdtemp(prefix="quern-")
            spark.sparkContext.setCheckpointDir(root)
    return root.rstrip("/")


def new_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for ``name``, removed when the application ends."""
    path = f"{shared_dir(spark)}/quern-{uuid.uuid4().hex[:12]}/{name}"
    jvm = spark.sparkContext._jvm
    parent = jvm.org.apache.hadoop.fs.Path(path).getParent()
    fs = parent.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    fs.mkdirs(parent)
    fs.deleteOnExit(parent)
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` as Parquet and reads it: computed once, short lineage, and
    still whole when executors are lost."""
    path = new_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(df: DataFrame) -> None:
    """Removes the files of a materialized table that nothing reads any more."""
    spark = df.sparkSession
    for file in df.inputFiles()[:1]:
        jvm = spark.sparkContext._jvm
        parent = jvm.org.apache.hadoop.fs.Path(file).getParent().getParent()
        if parent.getName().startswith("quern-"):
            parent.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(parent, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small(df: DataFrame, rows: int, limit: int) -> DataFrame:
    """Asks for a broadcast of ``df`` where its counted rows are at most ``limit``."""
    return F.broadcast(df) if rows <= limit else df
