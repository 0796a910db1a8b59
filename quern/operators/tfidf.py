"""TF-IDF of words and of characters, by groups of documents, in long form."""

from __future__ import annotations

from collections.abc import Callable, Iterable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.config import CharGramConfig, TfidfConfig
from quern.functions.accents import strip_accents
from quern.functions.rows import exploded
from quern.operators.terms import char_counts, frequencies, list_counts, weighted
from quern.store import materialize

_STRINGS = "array<string>"
MOST_SHARED_TERMS = 1_000_000  # of all groups' vocabularies, which each task holds; larger ones are joined


def words(text: Column, stop: Iterable[str] = ()) -> Column:
    """Words of two or more letters (a-z, _) without accents, that are no stop words."""
    stop = sorted(set(stop))
    runs = F.regexp_extract_all(strip_accents(F.lower(text)), F.lit(r"(?U)\w+"), F.lit(0))
    return F.filter(runs, lambda x: x.rlike("^[a-z_]{2,}$") & (~x.isin(stop) if stop else F.lit(True)))


def _windows(units: Column, n: int, join: Column | None) -> Column:
    cut = lambda i: F.array_join(F.slice(units, i, n), " ") if join is None else F.substring(join, i, F.lit(n))
    size = F.size(units) if join is None else F.length(join)
    return F.when(size >= n, F.transform(F.sequence(F.lit(1), size - (n - 1)), cut)).otherwise(F.array().cast(_STRINGS))


def word_terms(df: DataFrame, group: str, id_col: str, text: Column, stop: Iterable[str] = (), config: TfidfConfig = TfidfConfig(), keep: tuple[str, ...] = ()) -> DataFrame:
    """group, id, terms: the n-grams of the words (n-grams bridge stop words)."""
    cut = df.select(group, id_col, words(F.coalesce(text, F.lit("")), stop).alias("w"), *keep)
    w = F.col("w")
    return cut.select(group, id_col, F.concat(*[w if n == 1 else _windows(w, n, None) for n in range(config.ngram_min, config.ngram_max + 1)]).alias("terms"), *keep)


def char_texts(df: DataFrame, group: str, id_col: str, text: Column, keep: tuple[str, ...] = ()) -> DataFrame:
    """group, id, t: runs of white space count as one space."""
    return df.select(group, id_col, F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)[\s\x1c-\x1f]{2,}", " ").alias("t"), *keep)


def char_terms(df: DataFrame, group: str, id_col: str, text: Column, config: CharGramConfig = CharGramConfig()) -> DataFrame:
    """group, id, terms: the n-grams of the characters; runs of white space count as one space."""
    t = char_texts(df, group, id_col, text)
    return t.select(group, id_col, F.concat(*[_windows(F.array(), n, F.col("t")) for n in range(config.ngram_min, config.ngram_max + 1)]).alias("terms"))


def term_counts(terms: DataFrame, group: str, id_col: str) -> DataFrame:
    return exploded(terms, [group, id_col], "terms", "term").groupBy(group, id_col, "term").agg(F.count("*").alias("tf"))


def term_sums(counts: DataFrame, group: str) -> DataFrame:
    """group, term, df, total of ``term_counts``."""
    return counts.groupBy(group, "term").agg(F.count("*").alias("df"), F.sum("tf").alias("total"))


def _told_apart(df: DataFrame, group: str, id_col: str) -> bool:
    """Whether no id of a group comes twice, so that each row's counts are its document's."""
    return df.groupBy(group, id_col).agg(F.count("*").alias("n")).where("n > 1").isEmpty()


def _sums(texts: DataFrame, group: str, count: Callable) -> DataFrame:
    """The same as ``term_sums``, of rows (group, id, text or terms) that are told apart."""
    found = texts.select(F.col(group).cast("string").alias("group"), texts.columns[2]).mapInArrow(frequencies(count), "group string, term string, df long, total long")
    return found.groupBy(F.col("group").alias(group), "term").agg(F.sum("df").alias("df"), F.sum("total").alias("total"))


def char_frequencies(df: DataFrame, group: str, id_col: str, text: Column, config: CharGramConfig = CharGramConfig()) -> DataFrame:
    """group, term, df, total of the n-grams of the characters."""
    if not _told_apart(df, group, id_col):
        return term_sums(term_counts(char_terms(df, group, id_col, text, config), group, id_col), group)
    return _sums(char_texts(df, group, id_col, text), group, char_counts(config.ngram_min, config.ngram_max))


def vocabulary(sums: DataFrame, sizes: DataFrame, group: str, min_df: int, max_df: float, max_features: int) -> DataFrame:
    """group, term, df, total, n, idf: terms in at least ``min_df`` documents and at most the
    share ``max_df`` of them; of these the most frequent, ties by term.

    ``sums``: group, term, df, total.  ``sizes``: group, n.  No more than ``max_features`` rows of a group leave a partition.
    """
    found = sums.where(F.col("df") >= min_df)
    found = found.join(sizes.withColumnRenamed(group, "__g"), F.col(group).eqNullSafe(F.col("__g"))).drop("__g").where(F.col("df") <= max_df * F.col("n"))
    place = Window.partitionBy(group).orderBy(F.desc("total"), "term")
    found = found.withColumn("place", F.row_number().over(place)).where(F.col("place") <= max_features).drop("place")
    return found.withColumn("idf", F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1)


def vectors(counts: DataFrame, vocab: DataFrame, group: str, id_col: str, sublinear: bool) -> DataFrame:
    """group, id, vector (array of term, weight; length 1): documents that hold a term at least."""
    tf = 1 + F.log("tf") if sublinear else F.col("tf").cast("double")
    own = vocab.select(F.col(group).alias("__g"), F.col("term").alias("__t"), "idf")
    met = counts.join(own, F.col(group).eqNullSafe(F.col("__g")) & (F.col("term") == F.col("__t")))
    weight = tf * F.col("idf")
    weighted = met.select(group, id_col, F.struct("term", weight.alias("weight")).alias("x"), (weight * weight).alias("square"))
    # the norm is summed beside the list: computed from it, it would be computed again for each element
    out = weighted.groupBy(group, id_col).agg(F.sort_array(F.collect_list("x")).alias("v"), F.sum("square").alias("square"))
    norm = F.sqrt("square")
    return out.select(group, id_col, F.transform("v", lambda x: F.struct(x["term"].alias("term"), (x["weight"] / norm).alias("weight"))).alias("vector"))


def _shared_vectors(texts: DataFrame, vocab: DataFrame, group: str, count: Callable, sublinear: bool) -> DataFrame:
    """``texts`` with vector in place of the third column; the vocabulary goes to each task."""
    known = vocab.select(F.col(group).cast("string").alias("group"), "term", "idf").orderBy("group", "term").toArrow()
    groups = known["group"].combine_chunks().dictionary_encode(null_encoding="encode")
    code = groups.indices.to_numpy(zero_copy_only=False)
    models = {name: (known["term"].combine_chunks().take(pa.array(own)), known["idf"].to_numpy()[own]) for i, name in enumerate(groups.dictionary.to_pylist()) for own in [np.flatnonzero(code == i)]}
    shared = texts.sparkSession.sparkContext.broadcast(models)
    rest = [c for c in texts.columns if c not in (group, texts.columns[2])]
    rows = texts.select(F.col(group).cast("string").alias(group), texts.columns[2], *rest)
    schema = ", ".join([f"`{group}` string", "vector array<struct<term:string,weight:double>>", *[f"`{c}` {dict(texts.dtypes)[c]}" for c in rest]])
    return rows.mapInArrow(weighted(count, shared, sublinear), schema).select(group, rest[0], "vector", *rest[1:])


def _tfidf(df: DataFrame, group: str, id_col: str, texts: DataFrame, terms: DataFrame, count: Callable, vocabulary_of: Callable, sublinear: bool, keep: tuple[str, ...] | None) -> tuple[DataFrame, DataFrame]:
    """(vectors, vocabulary).  ``texts`` and ``terms``: the same documents, for batches and for joins.

    ``keep``: every document gets a vector, an empty one where no term is left, and keeps these columns.
    """
    if _told_apart(df, group, id_col):
        texts = materialize(texts, "texts")  # read twice
        vocab = materialize(vocabulary_of(_sums(texts, group, count)), "vocabulary")
        if vocab.count() <= MOST_SHARED_TERMS:
            found = _shared_vectors(texts, vocab, group, count, sublinear)
            return (found if keep is not None else found.where(F.size("vector") > 0)), vocab
    counts = materialize(term_counts(terms, group, id_col), "counts")  # read twice
    vocab = vocabulary_of(term_sums(counts, group))
    found = vectors(counts, vocab, group, id_col, sublinear)
    if keep is None:
        return found, vocab
    own = found.select(F.col(group).alias("__g"), F.col(id_col).alias("__d"), "vector")
    every = df.select(group, id_col, *keep).join(own, F.col(group).eqNullSafe(F.col("__g")) & F.col(id_col).eqNullSafe(F.col("__d")), "left")
    empty = F.array().cast("array<struct<term:string,weight:double>>")
    return every.select(group, id_col, F.coalesce("vector", empty).alias("vector"), *keep), vocab


def word_tfidf(df: DataFrame, group: str, id_col: str, text: Column, stop: Iterable[str] = (), config: TfidfConfig = TfidfConfig(), keep: tuple[str, ...] | None = None) -> tuple[DataFrame, DataFrame]:
    """(vectors, vocabulary).  ``keep``: every document has a vector, an empty one without terms, and these columns."""
    terms = word_terms(df, group, id_col, text, stop, config, keep or ())
    sizes = df.groupBy(group).agg(F.count("*").alias("n"))
    return _tfidf(df, group, id_col, terms, terms, list_counts, lambda sums: vocabulary(sums, sizes, group, config.min_df, config.max_df, config.max_features), config.sublinear, keep)


def char_tfidf(df: DataFrame, group: str, id_col: str, text: Column, config: CharGramConfig = CharGramConfig(), keep: tuple[str, ...] | None = None) -> tuple[DataFrame, DataFrame]:
    """(vectors, vocabulary), ``keep`` as for words."""
    sizes = df.groupBy(group).agg(F.count("*").alias("n"))
    vocabulary_of = lambda sums: vocabulary(sums, sizes, group, config.min_df, 1.0, config.max_features)
    texts, terms = char_texts(df, group, id_col, text, keep or ()), char_terms(df, group, id_col, text, config)
    return _tfidf(df, group, id_col, texts, terms, char_counts(config.ngram_min, config.ngram_max), vocabulary_of, False, keep)


def type_stats(vecs: DataFrame, vocab: DataFrame, sizes: DataFrame, group: str) -> DataFrame:
    """group, n_docs, vocab_size, tfidf_nnz, tfidf_density."""
    v = vocab.groupBy(F.col(group).alias("__v")).agg(F.count("*").alias("vocab_size"))
    z = vecs.groupBy(F.col(group).alias("__z")).agg(F.sum(F.size("vector")).alias("tfidf_nnz"))
    out = sizes.join(v, F.col(group).eqNullSafe(F.col("__v")), "left").join(z, F.col(group).eqNullSafe(F.col("__z")), "left")
    none = F.lit(0).cast("long")
    out = out.select(group, F.col("n").alias("n_docs"), F.coalesce("vocab_size", none).alias("vocab_size"), F.coalesce("tfidf_nnz", none).alias("tfidf_nnz"))
    return out.withColumn("tfidf_density", F.col("tfidf_nnz") / (F.col("n_docs") * F.greatest(F.col("vocab_size"), F.lit(1))))


def topic_keywords(vecs: DataFrame, labels: DataFrame, group: str, id_col: str, cluster: str, top: int = 15, least_docs: Column | int = 1) -> DataFrame:
    """group, cluster, topic_size, keywords: the terms of the highest mean weight over all the
    cluster's documents, ties by term from the end.  Noise (-1) has none.

    ``labels``: group, id, cluster.  ``least_docs`` may use the columns topic_size and n_docs (of the group).
    """
    named = labels.select(F.col(group).alias("__g"), F.col(id_col).alias("__i"), F.col(cluster).alias(cluster))
    n = labels.groupBy(F.col(group).alias("__g")).agg(F.count("*").alias("n_docs"))
    sizes = named.where(F.col(cluster) != -1).groupBy("__g", cluster).agg(F.count("*").alias("topic_size")).join(n, "__g")
    sizes = sizes.where(F.col("topic_size") >= least_docs).select(F.col("__g").alias("__s"), F.col(cluster).alias("__c"), "topic_size")
    met = vecs.join(named, F.col(group).eqNullSafe(F.col("__g")) & (F.col(id_col) == F.col("__i")))
    sums = exploded(met, [group, cluster], "vector", "x").groupBy(group, cluster, "x.term").agg(F.sum("x.weight").alias("total"))
    mean = sums.join(sizes, F.col(group).eqNullSafe(F.col("__s")) & (F.col(cluster) == F.col("__c"))).withColumn("mean", F.round(F.col("total") / F.col("topic_size"), 9)).where("mean > 0")
    place = Window.partitionBy(group, cluster).orderBy(F.desc("mean"), F.desc("term"))
    first = mean.withColumn("place", F.row_number().over(place)).where(F.col("place") <= top)
    listed = F.transform(F.array_sort(F.collect_list(F.struct("place", "term"))), lambda x: x["term"])
    return first.groupBy(group, cluster, "topic_size").agg(F.array_join(listed, ", ").alias("keywords"))
