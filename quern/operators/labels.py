"""Labels of clusters: sheets for people to fill in, and what they filled in."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.text import number, snippet

BLANK_COLUMNS = ("human_doc_type", "human_doc_type_confidence", "human_notes", "keep_in_corpus", "priority")


def cluster_samples(df: DataFrame, cluster: str = "docform_cluster", prob: str = "docform_cluster_prob", shown: str = "preview", order: tuple[str, ...] = ("doc_id",), k: int = 12, chars: int = 240) -> DataFrame:
    """The k rows of each cluster of the highest probability, then the longest preview,
    with preview_snip and their place.  Only k rows of a cluster leave a partition."""
    place = Window.partitionBy(cluster).orderBy(F.desc("__prob"), F.desc("__len"), *order)
    ranked = df.withColumns({"__prob": number(F.col(prob)), "__len": F.length(F.coalesce(shown, F.lit("")))}).withColumn("place", F.row_number().over(place))
    return ranked.where(F.col("place") <= k).withColumn("preview_snip", snippet(F.col(shown), chars)).drop("__prob", "__len")


def label_sheet(df: DataFrame, samples: DataFrame, cluster: str = "docform_cluster", examples: int = 5) -> DataFrame:
    """A row for each cluster: blank columns, n_docs, and the first examples in one string."""
    counts = df.groupBy(cluster).agg(F.count("*").alias("n_docs"))
    listed = F.slice(F.array_sort(F.collect_list(F.struct("place", "rel_path", "preview_snip"))), 1, examples)
    shown = samples.groupBy(F.col(cluster).alias("c")).agg(listed.alias("x"))
    out = counts.join(shown, F.col(cluster).eqNullSafe(F.col("c")), "left")
    blanks = [F.lit("").alias(c) for c in BLANK_COLUMNS]
    return out.select(*blanks, cluster, "n_docs", F.array_join("x.rel_path", " | ").alias("example_rel_paths"), F.array_join("x.preview_snip", " || ").alias("example_previews"))


def assigned(sheet: DataFrame, types: Mapping[str, str], maybe: tuple[str, ...] = (), cluster: str = "docform_cluster") -> DataFrame:
    """The sheet with human_doc_type from ``types``; typed clusters are kept ("yes"), those of
    the types in ``maybe`` perhaps."""
    named: Column = F.lit(None).cast("string")
    if types:
        named = F.create_map(*[F.lit(x) for kv in types.items() for x in kv])[F.col(cluster)]
    kind = F.coalesce(named, F.col("human_doc_type"), F.lit(""))
    keep = F.when(kind.isin(*maybe), "maybe") if maybe else F.when(F.lit(False), "maybe")
    return sheet.withColumn("human_doc_type", kind).withColumn("keep_in_corpus", keep.when(kind != "", "yes").otherwise(F.col("keep_in_corpus")))


def join_labels(manifest: DataFrame, sheet: DataFrame, cluster: str = "docform_cluster", broadcast_rows: int = 100_000) -> DataFrame:
    """Each row with its cluster's labels.  The sheet has a row for each cluster; it is counted
    before it is broadcast."""
    labels = sheet.select(F.col(cluster).alias("__c"), "human_doc_type", "keep_in_corpus", "priority", "human_notes")
    labels = F.broadcast(labels) if labels.count() <= broadcast_rows else labels
    return manifest.join(labels, F.col(cluster).eqNullSafe(F.col("__c")), "left").drop("__c")


def seeded_sample(df: DataFrame, cluster: str, id_col: str, n: int = 10, seed: int = 42) -> DataFrame:
    """At most n rows of each cluster but noise, chosen by a seeded hash of their ids."""
    place = Window.partitionBy(cluster).orderBy(F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(id_col).cast("string"))), id_col)
    return df.where(F.col(cluster) != -1).withColumn("place", F.row_number().over(place)).where(F.col("place") <= n).drop("place")
