"""Reading and writing the tables that stages hand on: Parquet first, text formats for people."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

PREVIEW = "doc_id string, sha256 string, rel_path string, extraction_method string, preview string"


def read_csv(spark: SparkSession, path: str, schema: str, sep: str = ",") -> DataFrame:
    """A (compressed) CSV or TSV file with a header; the schema is given, never guessed."""
    return spark.read.schema(schema).csv(path, header=True, sep=sep, multiLine=True, quote='"', escape='"')


def read_previews(spark: SparkSession, path: str) -> DataFrame:
    """JSON lines of previews: one row a doc_id (equal content has an equal preview), null as empty."""
    rows = spark.read.schema(PREVIEW).json(path).where("doc_id IS NOT NULL")
    return rows.groupBy("doc_id").agg(F.max(F.coalesce("preview", F.lit(""))).alias("preview"))


def with_previews(manifest: DataFrame, previews: DataFrame) -> DataFrame:
    """Each row with its preview; none is empty text.  One preview a doc_id, so rows do not multiply."""
    shown = previews.select(F.col("doc_id").alias("__d"), F.col("preview").alias("__p"))
    return manifest.join(shown, F.col("doc_id") == F.col("__d"), "left").withColumn("preview", F.coalesce("__p", F.lit(""))).drop("__d", "__p")


def missing_previews(manifest: DataFrame, previews: DataFrame) -> int:
    return manifest.join(previews.select("doc_id"), "doc_id", "left_anti").count()


def _flat(df: DataFrame) -> DataFrame:
    """Arrays and structs as JSON text, which CSV can hold."""
    return df.select(*[F.to_json(c).alias(c) if kind.startswith(("array", "struct", "map")) else F.col(c) for c, kind in df.dtypes])


def write_csv(df: DataFrame, path: str, order: list[Column] | None = None, sep: str = ",", compression: str = "gzip") -> None:
    out = df.orderBy(*order) if order else df
    _flat(out).write.mode("overwrite").option("compression", compression).csv(path, header=True, sep=sep, quote='"', escape='"')


def write_manifest(manifest: DataFrame, path: str) -> None:
    write_csv(manifest.drop("preview"), path, [F.col("source_root").asc_nulls_last(), F.col("rel_path").asc_nulls_last()])


def write_previews(manifest: DataFrame, path: str) -> None:
    manifest.select("doc_id", "sha256", "rel_path", "extraction_method", "preview").write.mode("overwrite").option("compression", "gzip").json(path)


def write_by_type(df: DataFrame, path: str, column: str = "human_doc_type") -> None:
    """A folder for each type."""
    df.write.mode("overwrite").partitionBy(column).parquet(path)


def read_by_type(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
