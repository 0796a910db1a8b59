"""The corpus pipeline: manifest, forms, exact and near duplicates, labels, topics."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.config import DOCFORM, CharGramConfig, ClusterConfig, NearDupConfig, SemanticConfig
from quern.functions import text as T
from quern.operators import cluster as C
from quern.operators import features, labels, neardup, tfidf
from quern.operators.manifest import COUNTS
from quern.operators.numbering import ranks
from quern.store import materialize


def docform(manifest: DataFrame, chars: CharGramConfig = CharGramConfig(), config: ClusterConfig = DOCFORM, usable_only: bool = True, char_ngrams: bool = True) -> DataFrame:
    """The manifest (with preview) and docform_cluster, docform_cluster_prob, docform_label_raw, form_coords.

    Standardised numbers and character n-grams of the preview make one vector for
    each different doc_id; rows that are not used keep nulls.
    """
    used = manifest
    if usable_only:
        used = manifest.where("text_usable_now") if "text_usable_now" in manifest.columns else manifest.where("doc_family IN ('text', 'pdf') AND has_text")
    kind = dict(manifest.dtypes)["doc_id"]
    one = used.groupBy("doc_id").agg(F.min(F.struct("preview", *COUNTS)).alias("x")).select("doc_id", "x.*", F.lit("all").alias("form"))
    one = materialize(one, "forms")
    numbers = features.standardised(one, ["form", "doc_id", "preview"])
    long = numbers.select("form", "doc_id", "preview", F.array(*[F.struct(F.lit(f"#{c}").alias("term"), F.col(c).alias("weight")) for c in COUNTS]).alias("numbers"))
    vecs = long.select("form", "doc_id", F.col("numbers").alias("vector"))
    if char_ngrams:
        grams, _ = tfidf.char_tfidf(long, "form", "doc_id", F.col("preview"), chars, keep=("numbers",))
        scaled = F.transform("vector", lambda x: F.struct(x["term"].alias("term"), (x["weight"] * chars.weight).alias("weight")))
        vecs = grams.select("form", "doc_id", F.concat("numbers", scaled).alias("vector"))
    found = C.cluster_vectors(vecs, "form", "doc_id", config)
    found = found.select(F.col("id").cast(kind).alias("__i"), T.cluster_name(F.col("label")).alias("docform_cluster"), F.col("prob").alias("docform_cluster_prob"), F.col("label").alias("docform_label_raw"), F.col("coords").alias("form_coords"))
    return manifest.join(found, F.col("doc_id") == F.col("__i"), "left").drop("__i")


def docform_reports(clustered: DataFrame, samples: int = 12, chars: int = 240) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(feature means, samples, label sheet) of the rows that were used."""
    used = clustered.where(F.col("docform_cluster").isNotNull())
    shown = labels.cluster_samples(used, k=samples, chars=chars, order=("rel_path",))
    return features.cluster_means(used, "docform_cluster"), shown, labels.label_sheet(used, shown)


def near_dedup(manifest: DataFrame, config: NearDupConfig = NearDupConfig(), preview_chars: int = 800) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(groups, group stats, manifest with groups, canonical corpus) of a deduplicated manifest
    with preview and human_doc_type.

    Rows are numbered by source_root and rel_path, so that group numbers are fixed.
    """
    order = [F.col("source_root").asc_nulls_first(), F.col("rel_path").asc_nulls_first(), F.col("doc_id")]
    rows = materialize(ranks(manifest, order, "idx"), "numbered")
    text = rows.where(F.col("doc_family").isin("text", "pdf"))
    hashed = neardup.hashed(text, "idx", F.col("human_doc_type"), F.col("preview"), config, most_chars=preview_chars)
    groups = materialize(neardup.grouped(hashed, "idx", config), "groups")
    all_rows = neardup.with_groups(rows, groups, "idx").withColumnRenamed("canonical_doc_id", "canonical_idx")
    names = rows.select(F.col("idx").alias("__i"), F.col("doc_id").alias("canonical_doc_id"))
    all_rows = all_rows.join(names, F.col("canonical_idx") == F.col("__i"), "left").drop("__i")
    corpus = all_rows.where(F.col("idx") == F.col("canonical_idx")).drop("idx", "canonical_idx")
    named = groups.join(rows.select(F.col("idx").alias("__i"), "doc_id", "sha256"), F.col("idx") == F.col("__i")).drop("__i")
    return named, neardup.group_stats(groups, "idx"), all_rows.drop("idx", "canonical_idx"), corpus


def label(manifest: DataFrame, sheet: DataFrame, types: Mapping[str, str], maybe: tuple[str, ...] = ()) -> DataFrame:
    return labels.join_labels(manifest, labels.assigned(sheet, types, maybe))


def cleaned(corpus: DataFrame, phrases: Sequence[str], as_regex: bool, config: SemanticConfig) -> DataFrame:
    """The corpus with clean_text and clean_tok_len, texts of enough tokens, types of enough documents."""
    kind = T.doc_type(F.col("human_doc_type"))
    rows = corpus.where(F.col("human_doc_type").isNotNull()).withColumn("clean_text", T.clean_text(F.col("human_doc_type"), F.col("preview"), phrases, as_regex)).withColumn("human_doc_type", kind)
    rows = rows.withColumn("clean_tok_len", F.size(T.tokens(F.col("clean_text")))).where(F.col("clean_tok_len") >= config.min_tokens)
    rows = materialize(rows, "cleaned")
    enough = rows.groupBy(F.col("human_doc_type").alias("__t")).agg(F.count("*").alias("n")).where(F.col("n") >= config.min_docs)
    return rows.join(enough, F.col("human_doc_type") == F.col("__t"), "left_semi")


def semantic(corpus: DataFrame, stop: Iterable[str] = (), phrases: Sequence[str] = (), as_regex: bool = True, config: SemanticConfig = SemanticConfig()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents with topics, topics, statistics by type) of a corpus with preview and human_doc_type.

    All types at once: only reduction and clustering work on one type in one task.
    Types whose vocabulary is too small are left out.  doc_id tells rows apart.
    """
    rows = materialize(cleaned(corpus, phrases, as_regex, config), "usable")
    vecs, vocab = tfidf.word_tfidf(rows, "human_doc_type", "doc_id", F.col("clean_text"), stop, config.tfidf, keep=())
    vecs, vocab = materialize(vecs, "tfidf"), materialize(vocab, "vocabulary")
    sizes = rows.groupBy("human_doc_type").agg(F.count("*").alias("n"))
    rich = vocab.groupBy(F.col("human_doc_type").alias("__t")).agg(F.count("*").alias("terms")).where("terms > 2")
    usable = rows.join(rich, F.col("human_doc_type") == F.col("__t"), "left_semi")
    every = vecs.join(rich, F.col("human_doc_type") == F.col("__t"), "left_semi")
    found = C.cluster_vectors(every, "human_doc_type", "doc_id", config.cluster)
    topics = materialize(found.select(F.col("group").alias("human_doc_type"), F.col("id").alias("doc_id"), F.col("label").alias("topic_cluster"), F.col("prob").alias("topic_prob"), F.col("coords").alias("umap")), "topics")

    enough = F.greatest(F.lit(max(config.min_docs_keywords, 3)), F.floor(0.01 * F.col("n_docs")))
    words = materialize(tfidf.topic_keywords(vecs, topics, "human_doc_type", "doc_id", "topic_cluster", config.top_keywords, enough), "keywords")
    counted = topics.where("topic_cluster <> -1").groupBy("human_doc_type", "topic_cluster").agg(F.count("*").alias("topic_size"))
    summary = counted.join(words.drop("topic_size"), ["human_doc_type", "topic_cluster"], "left").withColumn("keywords", F.coalesce("keywords", F.lit("")))
    docs = usable.join(topics, ["human_doc_type", "doc_id"]).join(summary, ["human_doc_type", "topic_cluster"], "left")
    docs = docs.withColumn("topic_keywords", F.coalesce("keywords", F.lit(""))).withColumn("topic_size", F.coalesce("topic_size", F.lit(0).cast("long"))).drop("keywords")

    stats = tfidf.type_stats(vecs, vocab, sizes, "human_doc_type").where("vocab_size > 2")
    by_type = topics.groupBy(F.col("human_doc_type").alias("__t")).agg(F.count_distinct(F.when(F.col("topic_cluster") != -1, F.col("topic_cluster"))).alias("n_clusters"), F.count_if(F.col("topic_cluster") == -1).alias("noise_docs"))
    with_words = words.groupBy(F.col("human_doc_type").alias("__w")).agg(F.count("*").alias("clusters_with_keywords"))
    stats = stats.join(by_type, F.col("human_doc_type") == F.col("__t")).join(with_words, F.col("human_doc_type") == F.col("__w"), "left").drop("__t", "__w")
    stats = stats.withColumns(
        {
            "svd_components_used": F.least(F.lit(config.cluster.svd_components or 0), F.col("vocab_size") - 1, F.col("n_docs")),
            "umap_dim": F.lit(config.cluster.umap_dim),
            "clusters_with_keywords": F.coalesce("clusters_with_keywords", F.lit(0).cast("long")),
            "min_docs_keywords_used": enough.cast("long"),
        }
    )
    return docs, summary, stats
