"""Exact duplicates by content hash."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def duplicate_map(manifest: DataFrame, paths: int = 5) -> DataFrame:
    """For each sha256 (null is a group of its own): dup_count, source_roots, doc_families
    (both sorted), the first ``paths`` paths, source_root_count.

    No group is gathered: paths beyond the first few never leave their partition.
    """
    sets = manifest.groupBy("sha256").agg(
        F.count("*").alias("dup_count"), F.sort_array(F.collect_set("source_root")).alias("source_roots"), F.sort_array(F.collect_set("doc_family")).alias("doc_families")
    )
    place = Window.partitionBy("sha256").orderBy("source_root", "rel_path")
    first = manifest.select("sha256", "source_root", "rel_path").withColumn("k", F.row_number().over(place)).where(F.col("k") <= paths)
    first = first.groupBy(F.col("sha256").alias("sha")).agg(F.transform(F.array_sort(F.collect_list(F.struct("k", "rel_path"))), lambda x: x["rel_path"]).alias("dup_paths_sample"))
    out = sets.join(first, F.col("sha256").eqNullSafe(F.col("sha"))).drop("sha")
    return out.withColumn("source_root_count", F.size("source_roots"))


def canonical(manifest: DataFrame, paths: int = 5) -> DataFrame:
    """The best row of each sha256, with the group's figures.

    Best: usable text, then text before pdf before image before others, then more
    characters, then the least path.
    """
    rank = F.coalesce(F.when(F.col("doc_family") == "text", 0).when(F.col("doc_family") == "pdf", 1).when(F.col("doc_family") == "image", 2), F.lit(3))
    usable = F.coalesce(F.col("text_usable_now"), F.lit(False))
    chars = F.coalesce(F.col("n_chars").cast("long"), F.lit(0))
    best = F.min_by(F.struct(*manifest.columns), F.struct((~usable).alias("u"), rank.alias("r"), (-chars).alias("c"), F.col("rel_path").alias("p")))
    rows = manifest.groupBy(F.col("sha256").alias("sha")).agg(best.alias("row")).select("sha", "row.*")
    figures = duplicate_map(manifest, paths).select(F.col("sha256").alias("key"), "dup_count", "dup_paths_sample", "source_root_count", "doc_families")
    return rows.join(figures, F.col("sha").eqNullSafe(F.col("key"))).drop("sha", "key")


def top_duplicated(canon: DataFrame, k: int = 15) -> DataFrame:
    return canon.select("sha256", "dup_count", "rel_path", "doc_family", "n_chars").orderBy(F.desc("dup_count"), "sha256").limit(k)
