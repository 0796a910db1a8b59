"""Near duplicates by SimHash.

Texts of one hash and one length are one class.  Classes that share the leading
bits and differ in a few of the others must agree on some of several pieces of
those: they meet by an equi-join on (leading bits, pieces that agree), however
large a bucket of leading bits is, and the result is that of comparing all pairs
within the bucket.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.config import NearDupConfig
from quern.functions.rows import exploded
from quern.functions.simhash import hamming, simhash64
from quern.functions.text import doc_type, normalize_text
from quern.operators.components import components
from quern.operators.numbering import ranks
from quern.store import materialize


def bucket_of(simhash: Column, config: NearDupConfig = NearDupConfig()) -> Column:
    return F.shiftrightunsigned(simhash, 64 - config.bits_prefix) if config.bits_prefix else F.lit(0).cast("long")


def hashed(df: DataFrame, id_col: str, kind: Column, text: Column, config: NearDupConfig = NearDupConfig(), most_chars: int | None = None) -> DataFrame:
    """``id_col`` (which tells rows apart), human_doc_type, norm_len, simhash64, bucket.

    ``most_chars``: a bound on the text's length, for cheaper counting.
    """
    rows = df.select(id_col, doc_type(kind).alias("human_doc_type"), normalize_text(kind, text).alias("norm"))
    rows = rows.withColumn("norm_len", F.length("norm").cast("long"))
    out = simhash64(rows, F.col("norm"), [id_col, "human_doc_type", "norm_len"], most_tokens=most_chars)
    return out.withColumn("bucket", bucket_of(F.col("simhash64"), config))


def _keys(simhash: Column, config: NearDupConfig) -> Column:
    """A key for each choice of pieces that may all agree: as many pieces as may differ are left out."""
    rest = 64 - config.bits_prefix
    edges = [rest * i // config.pieces for i in range(config.pieces + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    lead = ((1 << config.bits_prefix) - 1) << rest
    signed = lambda x: x - 2**64 if x >= 2**63 else x
    chosen = [signed(lead | sum(m)) for m in combinations(masks, config.pieces - config.max_distance)]
    return F.array(*[F.struct(F.lit(i).alias("choice"), simhash.bitwiseAND(F.lit(m)).alias("bits")) for i, m in enumerate(chosen)])


def classes(rows: DataFrame, id_col: str) -> DataFrame:
    """rep, simhash64, norm_len, copies: one row for texts that agree in both; none for empty texts."""
    return rows.where("norm_len > 0").groupBy("simhash64", "norm_len").agg(F.min(id_col).alias("rep"), F.count("*").alias("copies"))


def class_pairs(found: DataFrame, config: NearDupConfig = NearDupConfig()) -> DataFrame:
    """a, b, distance: classes (by rep, a < b) that are near duplicates."""
    keyed = exploded(found, ["rep", "simhash64", "norm_len"], _keys(F.col("simhash64"), config), "key")
    a = keyed.select("key", *[F.col(c).alias(f"a_{c}") for c in ("rep", "simhash64", "norm_len")])
    b = keyed.select("key", *[F.col(c).alias(f"b_{c}") for c in ("rep", "simhash64", "norm_len")])
    met = a.join(b, "key").where("a_rep < b_rep")
    met = met.where(F.greatest("a_norm_len", "b_norm_len") <= config.length_ratio * F.least("a_norm_len", "b_norm_len"))
    distance = hamming(F.col("a_simhash64"), F.col("b_simhash64"))
    return met.where(distance <= config.max_distance).select(F.col("a_rep").alias("a"), F.col("b_rep").alias("b"), distance.alias("distance")).distinct()


def grouped(rows: DataFrame, id_col: str, config: NearDupConfig = NearDupConfig()) -> DataFrame:
    """``rows`` (of ``hashed``; ``id_col`` long) with near_dup_group: g000000 and on, in the
    order of the groups' least ids.  Empty texts are groups of their own."""
    rows = materialize(rows, "hashed")
    found = materialize(classes(rows, id_col), "classes")
    linked = components(class_pairs(found, config))
    heads = found.join(linked, found.rep == linked.node, "left").select(F.col("simhash64").alias("sh"), F.col("norm_len").alias("len"), F.coalesce("component", "rep").alias("head"))
    met = (rows.simhash64 == F.col("sh")) & (rows.norm_len == F.col("len")) & (rows.norm_len > 0)
    rows = materialize(rows.join(heads, met, "left").withColumn("head", F.coalesce("head", id_col)).drop("sh", "len"), "headed")
    numbered = ranks(rows.select(F.col("head").alias("h")).distinct(), [F.col("h")], "number")
    out = rows.join(numbered, F.col("head") == F.col("h"))
    return out.withColumn("near_dup_group", F.format_string("g%06d", "number")).drop("h", "head", "number")


def group_stats(groups: DataFrame, id_col: str) -> DataFrame:
    return groups.groupBy("near_dup_group").agg(F.count("*").alias("group_size"), F.min_by("human_doc_type", id_col).alias("doc_type"))


def canonical_ids(groups: DataFrame, id_col: str) -> DataFrame:
    """near_dup_group, canonical_doc_id: the longest normalised text, then the least id."""
    best = F.min_by(id_col, F.struct((-F.col("norm_len")).alias("n"), F.col(id_col).alias("i")))
    return groups.groupBy("near_dup_group").agg(best.alias("canonical_doc_id"))


def canonical_corpus(manifest: DataFrame, groups: DataFrame, id_col: str) -> DataFrame:
    """Rows of the manifest that stand for their group, with near_dup_group and canonical_doc_id."""
    chosen = canonical_ids(groups, id_col)
    return manifest.join(chosen, F.col(id_col) == F.col("canonical_doc_id"))


def with_groups(manifest: DataFrame, groups: DataFrame, id_col: str) -> DataFrame:
    """All rows of the manifest with near_dup_group and canonical_doc_id (null without text)."""
    own = groups.select(F.col(id_col).alias("__id"), "near_dup_group")
    return manifest.join(own, F.col(id_col) == F.col("__id"), "left").drop("__id").join(canonical_ids(groups, id_col), "near_dup_group", "left")
