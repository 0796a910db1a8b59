"""Registered queries of the corpus operators over the driver's tables.

The tables have no files, labels of forms, or topics of their own; the stand-ins
are: family and type of a document by its language, clusters by its source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.config import CharGramConfig, ClusterConfig, SemanticConfig
from quern.functions import text as T
from quern.functions.rows import exploded
from quern.functions.wordlists import english_stop_words
from quern.operators import cluster as C
from quern.operators import exact, features, labels, manifest, neardup, review, tfidf
from quern.operators.manifest import COUNTS
from quern.plans import pipelines
from quern.plans.samples import PATHS, PHRASES, SHEET_TYPES
from quern.session import ship
from quern.sources.tables import with_previews
from quern.streaming import stats as streaming

RATIOS = ("avg_line_len", "digit_ratio", "upper_ratio", "non_ascii_ratio")


# Columns are made when a query is: without a session there are none.
def family() -> Column:
    return F.expr("CASE lang WHEN 'en' THEN 'text' WHEN 'de' THEN 'pdf' WHEN 'fr' THEN 'image' ELSE 'binary' END")


def kind() -> Column:
    return F.expr("CASE lang WHEN 'en' THEN 'email_prose' WHEN 'de' THEN 'chat_ichat_prose' ELSE lang END")


def topic() -> Column:
    return F.expr("CASE WHEN source < 'src13' THEN 0 WHEN source < 'src17' THEN 1 ELSE -1 END")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ship(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def manifest_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as rows of a manifest, with preview."""
    docs = documents(spark, sf_dir)
    named = docs.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.sha2("text", 256).alias("sha256"),
        F.col("source").alias("source_root"),
        F.concat("source", F.lit("/"), F.col("doc_id")).alias("rel_path"),
        family().alias("doc_family"),
        kind().alias("human_doc_type"),
        topic().alias("topic"),
        T.preview(F.col("text")).alias("preview"),
        "text",
    )
    return manifest.triage(manifest.text_stats(named)).drop("text")


def text_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(manifest.text_stats(documents(spark, sf_dir)).select("doc_id", *COUNTS), *RATIOS)


def text_stats_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = "doc_id long, text string, lang string, source string, n_chars long"
    stream = streaming.stats_stream(streaming.document_stream(spark, sf_dir, schema, "documents.parquet"))
    return rounded(streaming.run_available(stream.select("doc_id", *COUNTS), "stream"), *RATIOS)


def html_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages are files of the text family."""
    return rounded(manifest.text_stats(table(spark, sf_dir, "pages"), "html").select("page_id", *COUNTS), *RATIOS)


def triage_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    flagged = manifest.triage(manifest.text_stats(documents(spark, sf_dir).withColumn("doc_family", family())))
    return flagged.select("doc_id", "doc_family", "has_text", "text_missing", "text_usable_now", "has_emails", "has_phones", "has_dates", "has_money")


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", T.preview(F.col("text")).alias("preview"))


def family_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = ship(spark).createDataFrame([(p,) for p in PATHS], "rel_path string").withColumn("basename", F.substring_index("rel_path", "/", -1))
    ext = manifest.extension(F.col("basename"))
    return paths.select("rel_path", ext.alias("ext"), manifest.family(ext).alias("doc_family"), manifest.skipped(F.col("rel_path"), F.col("basename")).alias("skipped"))


def extraction_methods(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Embedded text and OCR text by stand-in: what a document's first line and source give."""
    docs = documents(spark, sf_dir).withColumn("doc_family", family()).withColumn("embedded", F.when(F.col("source") < "src15", F.substring("text", 1, 40)).otherwise(""))
    docs = docs.withColumn("ocr", F.when(F.col("source") > "src13", F.substring("text", 41, 40)).otherwise("")).withColumn("pending", manifest.needs_ocr(F.col("embedded")))
    method = manifest.extraction_method(F.col("doc_family"), F.col("pending"), F.col("embedded"), F.col("ocr"))
    return docs.select("doc_id", method.alias("extraction_method"), manifest.merged_text(F.col("embedded"), F.col("ocr")).alias("merged"))


def exact_dup_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact.duplicate_map(manifest_of(spark, sf_dir))
    return found.select("sha256", "dup_count", *[F.array_join(c, "|").alias(c) for c in ("source_roots", "doc_families", "dup_paths_sample")], F.col("source_root_count").cast("long").alias("source_root_count"))


def exact_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.canonical(manifest_of(spark, sf_dir)).select("sha256", "doc_id", "rel_path", "doc_family", "n_chars", "dup_count")


def top_duplicated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.top_duplicated(exact.canonical(manifest_of(spark, sf_dir)))


def normalize_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents(spark, sf_dir).select("doc_id", T.normalize_text(kind(), F.col("text")).alias("norm"))


def _hashed(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("preview", T.preview(F.col("text")))
    return neardup.hashed(docs, "doc_id", kind(), F.col("preview"), most_chars=800)


def simhash64(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _hashed(spark, sf_dir).select("doc_id", "simhash64", "bucket", "norm_len")


def neardup_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.class_pairs(neardup.classes(_hashed(spark, sf_dir), "doc_id")).select("a", "b", F.col("distance").cast("long").alias("distance"))


def _groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.grouped(_hashed(spark, sf_dir), "doc_id")


def neardup_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _groups(spark, sf_dir).select("doc_id", "human_doc_type", "near_dup_group")


def neardup_group_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.group_stats(_groups(spark, sf_dir), "doc_id")


def neardup_canonical(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.canonical_corpus(documents(spark, sf_dir), _groups(spark, sf_dir), "doc_id").select("doc_id", "source", "near_dup_group")


def _form_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A form for each language, 'noise' for the last; the probability is the label's quality."""
    quality = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("__d"), F.col("quality").cast("double").alias("docform_cluster_prob"))
    rows = manifest_of(spark, sf_dir).withColumn("docform_cluster", F.when(F.col("human_doc_type") == "email_prose", "c0001").when(F.col("human_doc_type") == "chat_ichat_prose", "c0000").when(F.col("human_doc_type") == "es", "c0002").otherwise("noise"))
    return rows.drop("human_doc_type").join(quality, F.col("doc_id") == F.col("__d"), "left").drop("__d")


def _sheet(clustered: DataFrame) -> DataFrame:
    return labels.label_sheet(clustered, labels.cluster_samples(clustered, order=("rel_path",)))


def cluster_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return labels.cluster_samples(_form_clusters(spark, sf_dir), order=("rel_path",)).select("docform_cluster", F.col("place").cast("long").alias("place"), "doc_id", "rel_path", "preview_snip")


def label_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sheet(_form_clusters(spark, sf_dir))


def label_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    clustered = _form_clusters(spark, sf_dir)
    sheet = labels.assigned(_sheet(clustered), SHEET_TYPES, ("web_notes",))
    return labels.join_labels(clustered, sheet).select("doc_id", "docform_cluster", "human_doc_type", "keep_in_corpus", "priority")


def seeded_sample(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("topic", topic())
    return labels.seeded_sample(docs, "topic", "doc_id", 10, 42).select("topic", "doc_id")


def docform_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(features.standardised(manifest.text_stats(documents(spark, sf_dir)), ["doc_id"]), *COUNTS)


def docform_feature_means(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(features.cluster_means(manifest.text_stats(documents(spark, sf_dir)), "lang"), *COUNTS)


def char_ngram_df(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = CharGramConfig()
    docs = documents(spark, sf_dir).select("doc_id", F.lit("all").alias("form"), T.preview(F.col("text")).alias("preview"))
    sums = tfidf.char_frequencies(docs, "form", "doc_id", F.col("preview"), config)
    sizes = docs.groupBy("form").agg(F.count("*").alias("n"))
    return tfidf.vocabulary(sums, sizes, "form", config.min_df, 1.0, config.max_features).select("term", "df", "total")


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    cleaned = T.clean_text(kind(), T.preview(F.col("text")), PHRASES)
    return docs.select("doc_id", cleaned.alias("clean")).withColumn("clean_tok_len", F.size(T.tokens(F.col("clean"))).cast("long"))


def _word_tfidf(spark: SparkSession, sf_dir: str, keep: tuple[str, ...] | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    docs = documents(spark, sf_dir)
    rows = docs.select("doc_id", kind().alias("kind"), topic().alias("topic"), T.clean_text(kind(), T.preview(F.col("text")), PHRASES).alias("clean"))
    vecs, vocab = tfidf.word_tfidf(rows, "kind", "doc_id", F.col("clean"), english_stop_words(), keep=keep)
    return rows, vecs, vocab


def tfidf_word(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, vecs, _ = _word_tfidf(spark, sf_dir)
    return exploded(vecs, ["kind", "doc_id"], "vector", "x").select("kind", "doc_id", "x.term", F.round("x.weight", 6).alias("weight"))


def topic_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, vecs, _ = _word_tfidf(spark, sf_dir)
    return tfidf.topic_keywords(vecs, rows.select("kind", "doc_id", "topic"), "kind", "doc_id", "topic", 15, 5)


def type_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, vecs, vocab = _word_tfidf(spark, sf_dir)
    return rounded(tfidf.type_stats(vecs, vocab, rows.groupBy("kind").agg(F.count("*").alias("n")), "kind"), "tfidf_density")


def boilerplate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("lang", topic().alias("topic"), "text")
    return rounded(review.boilerplate(docs, T.distinct_lines(F.col("text")), "lang", "topic", 3, 40), "ratio")


def boilerplate_shingles(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("lang", topic().alias("topic"), "text")
    return rounded(review.boilerplate(docs, T.distinct_shingles(F.col("text"), 8), "lang", "topic", 3, 30, "shingle"), "ratio")


def topic_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("topic", topic()).withColumn("prob", F.col("n_chars").cast("double"))
    return rounded(review.topic_sizes(docs, "lang", "topic", "doc_id", "prob"), "avg_prob")


def doc_family_review(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).withColumn("preview", T.preview(F.col("text")))
    return docs.select("doc_id", T.review_family(T.clean_text(kind(), F.col("preview"), PHRASES), F.col("preview")).alias("family"))


def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return manifest.value_counts(documents(spark, sf_dir), ["lang", "source"], 25)


def preview_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Previews come once a content, however many files share it."""
    rows = manifest_of(spark, sf_dir)
    previews = rows.groupBy(F.col("sha256").alias("doc_id")).agg(F.max("preview").alias("preview"))
    joined = with_previews(rows.drop("preview").withColumn("row", F.col("doc_id")).withColumn("doc_id", F.col("sha256")), previews)
    return joined.select(F.col("row").alias("doc_id"), "preview")


def hdbscan_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings").withColumn("all", F.lit("all"))
    found = C.cluster_embeddings(vectors, "all", "vec_id", "embedding", 15, 5)
    return found.select(F.col("id").alias("vec_id"), F.col("label").alias("cluster"), "prob")


def _every_vector(spark: SparkSession, sf_dir: str) -> DataFrame:
    """kind, doc_id, vector of all documents: empty where no term of the vocabulary is left."""
    _, vecs, _ = _word_tfidf(spark, sf_dir, keep=())
    return vecs


def svd_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = C.svd_vectors(_every_vector(spark, sf_dir), "kind", "doc_id", ClusterConfig().svd_components)
    return found.select(F.col("group").alias("kind"), F.col("id").alias("doc_id"), "coords")


def umap_embed(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = C.cluster_vectors(_every_vector(spark, sf_dir), "kind", "doc_id", ClusterConfig())
    return found.select(F.col("group").alias("kind"), F.col("id").alias("doc_id"), "coords")


def docform_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pipelines.docform(manifest_of(spark, sf_dir))
    return found.select("doc_id", "docform_cluster", "docform_cluster_prob", "docform_label_raw")


def semantic_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-deduplicated documents, and the topics within each type."""
    rows = manifest_of(spark, sf_dir).withColumn("doc_family", F.lit("text"))
    _, _, _, corpus = pipelines.near_dedup(rows)
    docs, _, _ = pipelines.semantic(corpus, english_stop_words(), PHRASES, config=SemanticConfig())
    return docs.select("doc_id", "human_doc_type", "clean_tok_len", "topic_cluster", "topic_prob", "topic_keywords", "topic_size")


ALL = (
    text_stats, text_stats_stream, html_stats, triage_flags, preview, preview_join, family_classify, extraction_methods, exact_dup_map, exact_canonical, top_duplicated, normalize_text,
    simhash64, neardup_pairs, neardup_groups, neardup_group_stats, neardup_canonical, label_join, label_sheet, cluster_samples, seeded_sample, docform_features, docform_feature_means,
    char_ngram_df, clean_text, tfidf_word, topic_keywords, type_stats, boilerplate_lines, boilerplate_shingles, topic_sizes, doc_family_review, value_counts,
    hdbscan_embeddings, svd_embed, umap_embed, docform_pipeline, semantic_pipeline,
)
