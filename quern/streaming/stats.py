"""Text statistics of a stream of documents: no state, so any sink and any mode."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quern.config import ManifestConfig
from quern.functions.text import preview
from quern.operators.manifest import text_stats, triage
from quern.store import new_dir


def document_stream(spark: SparkSession, folder: str, schema: str, files: str = "*.parquet", files_per_trigger: int = 100) -> DataFrame:
    """The documents of the files of a folder.  ``files`` may also name a folder in it: one table written in parts."""
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger)
    parts = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder.rstrip("/"), files)
    if parts.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).isDirectory(parts):
        return stream.parquet(f"{folder.rstrip('/')}/{files}")
    return stream.option("pathGlobFilter", files).parquet(folder)


def stats_stream(documents: DataFrame, family: str = "text", config: ManifestConfig = ManifestConfig()) -> DataFrame:
    """Each document with its statistics, flags and preview, as it arrives."""
    from pyspark.sql import functions as F

    shown = documents.withColumn("preview", preview(documents["text"], config.preview_chars)).withColumn("doc_family", F.lit(family))
    return triage(text_stats(shown), config).drop("text")


def run_available(stream: DataFrame, name: str) -> DataFrame:
    """Works through what there is, exactly once, into a table in the shared folder."""
    spark = stream.sparkSession
    out = new_dir(spark, name)
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", new_dir(spark, f"{name}-state")).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.schema(stream.schema).parquet(out)
