"""The tables that the pipelines hand to people: one folder each, in a stable order.

Parquet keeps arrays and types; what is exported here is text, with arrays as JSON.
Every sink is ordered, so reruns write the same lines.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.sources.tables import write_csv

_FILES = ("source_root", "rel_path")


@dataclass(frozen=True)
class Sink:
    """``order``: column names, a minus before one that descends; nulls come last."""

    order: tuple[str, ...]
    sep: str = ","
    compression: str = "none"


# The tables' names, and which of them are compressed.
SINKS = {
    "duplicates_map": Sink(("-dup_count", "sha256"), compression="gzip"),
    "manifest_dedup": Sink(_FILES, compression="gzip"),
    "near_dup_groups": Sink(("near_dup_group", "doc_id"), compression="gzip"),
    "near_dup_group_stats": Sink(("-group_size", "near_dup_group")),
    "manifest_with_near_dedup": Sink(_FILES, compression="gzip"),
    "corpus_canonical": Sink(_FILES, compression="gzip"),
    "umap_embedding": Sink(("doc_id",)),
    "manifest_with_docform_clusters": Sink(_FILES, compression="gzip"),
    "docform_cluster_feature_means": Sink(("-n_docs", "docform_cluster")),
    "docform_cluster_samples": Sink(("docform_cluster", "place"), sep="\t"),
    "docform_labeling_sheet": Sink(("-n_docs", "docform_cluster")),
    "docform_labeling_sheet_labeled": Sink(("-n_docs", "docform_cluster")),
    "manifest_with_doc_types": Sink(_FILES, compression="gzip"),
    "semantic_all_topics": Sink(("human_doc_type", "-topic_size", "topic_cluster")),
    "semantic_type_stats": Sink(("-n_docs", "human_doc_type")),
}


def coordinates(clustered: DataFrame, coords: str, prefix: str, dims: int, keep: tuple[str, ...]) -> DataFrame:
    """Rows with coordinates, these in columns of their own: ``prefix`` and a number."""
    some = clustered.where(F.col(coords).isNotNull())
    return some.select(*keep, *[F.get(coords, F.lit(i)).alias(f"{prefix}{i}") for i in range(dims)])


def write_tables(tables: dict[str, DataFrame], root: str) -> dict[str, str]:
    """Writes each table, by its name in ``SINKS``, to a folder of ``root``; returns the folders."""
    unknown = set(tables) - set(SINKS)
    if unknown:
        raise KeyError(f"no sink for {sorted(unknown)}")
    paths = {}
    for name, df in tables.items():
        sink = SINKS[name]
        order = [F.col(c[1:]).desc_nulls_last() if c.startswith("-") else F.col(c).asc_nulls_last() for c in sink.order]
        paths[name] = f"{root.rstrip('/')}/{name}"
        write_csv(df, paths[name], order, sink.sep, sink.compression)
    return paths
