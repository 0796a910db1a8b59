"""Defaults of the corpus operators."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class ManifestConfig:
    max_text_bytes: int = 2_000_000  # of a text file that are decoded
    preview_chars: int = 800
    least_chars: int = 50  # that count as having text
    pdf_pages: int = 2
    pdf_chars: int = 200_000  # no further page is read beyond these
    ocr_below_chars: int = 30
    ocr_dpi: int = 200


@dataclass(frozen=True)
class NearDupConfig:
    bits_prefix: int = 16  # leading bits that near duplicates share
    max_distance: int = 3  # bits in which they may differ
    length_ratio: float = 2.5  # of the longer normalised text to the shorter
    pieces: int = 4  # of the other bits, for blocking; more than max_distance

    def __post_init__(self):
        if not self.pieces > self.max_distance >= 0 or not 0 <= self.bits_prefix < 64:
            raise ValueError("pieces must exceed max_distance, and bits_prefix lie below 64")


@dataclass(frozen=True)
class TfidfConfig:
    ngram_min: int = 1
    ngram_max: int = 2
    min_df: int = 2
    max_df: float = 0.85  # of the documents of a type
    max_features: int = 60_000
    sublinear: bool = True


@dataclass(frozen=True)
class CharGramConfig:
    ngram_min: int = 2
    ngram_max: int = 4
    min_df: int = 5
    max_features: int = 50_000
    weight: float = 1.0


@dataclass(frozen=True)
class ClusterConfig:
    """Reduction and clustering.  None: derived from the number of rows of a group."""

    min_cluster_size: int | None = None
    min_samples: int | None = None
    epsilon: float = 0.0
    svd_components: int | None = 1000  # None: no SVD before the neighbour graph
    umap_dim: int = 10
    umap_neighbors: int | None = None
    umap_min_dist: float = 0.1
    seed: int = 42
    fit_rows: int = 3000  # of a group that the fit looks at; further rows go to their nearest neighbours' clusters
    assign_neighbors: int = 5


DOCFORM = ClusterConfig(min_cluster_size=30, svd_components=None, umap_dim=5, umap_neighbors=30, umap_min_dist=0.05)


@dataclass(frozen=True)
class SemanticConfig:
    min_docs: int = 30  # of a type
    min_tokens: int = 30  # of a cleaned text
    top_keywords: int = 15
    min_docs_keywords: int = 5
    tfidf: TfidfConfig = TfidfConfig()
    cluster: ClusterConfig = ClusterConfig()
