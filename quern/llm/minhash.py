"""Operator 1: near-duplicate groups by MinHash.

Signatures of many universal hash minima are cut into bands; documents that
share a band's key are candidates.  Equal sets form one class first, so a group
of exact copies costs one signature.  Within a bucket every member is held
against the bucket's least member (signatures first, then whole sets), and
components are built by alternating large-star and small-star steps.  Buckets
that still hold more than one component are then compared in full, in blocks of
bounded size, so no link between candidates is lost although pairs are never
emitted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.operators.components import components
from quern.llm.shingles import Signer, jaccard_at_least, set_digest, shingle_sets
from quern.store import materialize, small, table


@dataclass(frozen=True)
class MinHashConfig:
    shingle_words: int = 5
    percent: int = 80  # least Jaccard similarity of a link
    bands: int = 28
    rows: int = 5
    seed: int = 7
    block_shingles: int = 1 << 20  # of the sets that are compared at once (8 bytes each)
    block_sets: int = 2048  # that are compared at once
    broadcast_ids: int = 1_000_000  # ids (8 bytes) that may be broadcast; beyond, a shuffled join

    @property
    def least_linked(self) -> int:
        """Shingles of the smallest set that can link with a different one: n of n + 1 must reach the percentage."""
        return -(-self.percent // (100 - self.percent)) if self.percent < 100 else 1 << 62

    @property
    def least_estimate(self) -> float:
        """A link's estimate falls below this about once in 3 million times (5 sigma)."""
        j = self.percent / 100
        return j - 5 * (j * (1 - j) / (self.bands * self.rows)) ** 0.5


_SIGNED = "doc_id long, n_shingles long, d1 long, d2 long, sig binary, bands array<long>"


def _sign(config: MinHashConfig):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        signer = Signer(config.bands, config.rows, config.seed)
        for batch in batches:
            n, digests, minima = [], [], []
            for s in shingle_sets(batch.column(1), config.shingle_words):
                n.append(len(s))
                digests.append(set_digest(s))
                minima.append(signer.minima(s) if len(s) else np.zeros(config.bands * config.rows, np.uint32))
            if not n:
                continue
            grid = np.stack(minima)
            keys = signer.band_keys(grid).view(np.int64)
            full = np.array(n) > 0
            d = np.array(digests, dtype=np.int64)
            bounds = np.concatenate(([0], np.cumsum(np.where(full, config.bands, 0)))).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    pa.array(n, pa.int64()),
                    pa.array(d[:, 0]),
                    pa.array(d[:, 1]),
                    pa.array([x.tobytes() for x in grid.astype(np.uint8)], pa.binary()),
                    pa.ListArray.from_arrays(pa.array(bounds), pa.array(keys[full].ravel())),
                ],
                names=["doc_id", "n_shingles", "d1", "d2", "sig", "bands"],
            )

    return run


def _sets(config: MinHashConfig):
    def run(batches):
        for batch in batches:
            sets = [s.tobytes() for s in shingle_sets(batch.column(1), config.shingle_words)]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), pa.array(sets, pa.large_binary()).cast(pa.binary())], names=["doc", "set"])

    return run


def _similar_signatures(config: MinHashConfig):
    """Keeps pairs whose signatures agree often enough (minima as bytes: 1 of 256 agrees by chance)."""
    least = config.bands * config.rows * config.least_estimate

    def run(batches):
        for batch in batches:
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(-1, config.bands * config.rows) for i in (2, 3))
            keep = (x == y).sum(axis=1) >= least
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(keep)) for i in (0, 1)], names=["a", "b"])

    return run


def _linked_pairs(config: MinHashConfig):
    """Confirms pairs on whole sets."""

    def run(batches):
        for batch in batches:
            a, b = ([np.frombuffer(x, np.uint64) for x in batch.column(i).to_pylist()] for i in (2, 3))
            keep = pa.array([jaccard_at_least(x, y, config.percent) for x, y in zip(a, b, strict=True)], pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(keep) for i in (0, 1)], names=["a", "b"])

    return run


def _overlaps(rows: list[np.ndarray], cols: list[np.ndarray]) -> np.ndarray:
    """Sizes of all intersections, by products of incidence matrices in column blocks."""
    sets = rows + cols
    flat = np.concatenate(sets)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, place, count = np.unique(flat, return_inverse=True, return_counts=True)
    shared = count > 1
    owner, place = owner[shared[place]], (np.cumsum(shared) - 1)[place][shared[place]]
    order = np.argsort(place, kind="stable")
    owner, place = owner[order], place[order]
    out = np.zeros((len(rows), len(cols)), np.float32)
    for i in range(0, int(shared.sum()), 4096):
        a, b = np.searchsorted(place, (i, i + 4096))
        grid = np.zeros((len(sets), 4096), np.float32)
        grid[owner[a:b], place[a:b] - i] = 1
        out += grid[: len(rows)] @ grid[len(rows) :].T
    return out


def _block_links(percent: int):
    """Links between the documents of one or two blocks that lie in different components;
    one for each two components."""

    def run(block: pa.Table) -> pa.Table:
        side, comp = block["side"].to_numpy(), block["comp"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in block["set"].to_pylist()]
        size = np.array([len(s) for s in sets])
        rows = np.flatnonzero(side == 0)
        cols = np.flatnonzero(side == 1) if (side == 1).any() else rows
        both = _overlaps([sets[i] for i in rows], [sets[i] for i in cols])
        union = size[rows][:, None] + size[cols][None, :] - both
        x, y = np.nonzero((comp[rows][:, None] != comp[cols][None, :]) & (100 * both >= percent * union))
        links = np.unique(np.sort(np.stack([comp[rows][x], comp[cols][y]], axis=1), axis=1), axis=0)
        return pa.table({"a": pa.array(links[:, 0], pa.int64()), "b": pa.array(links[:, 1], pa.int64())})

    return run


def _within_buckets(members: DataFrame, comp: DataFrame, sets: DataFrame, config: MinHashConfig) -> DataFrame:
    """Links (a, b: components) that the comparison with bucket leaders has missed.

    Buckets of one component need nothing.  In the others, all members outside
    the bucket's largest component are held against each other and against that
    component, in blocks of bounded bytes and numbers of sets: rows grow with
    members times blocks of the smaller components, not with the pairs.
    """
    blocks = lambda n, bulk: F.ceil(F.greatest(bulk / config.block_shingles, n / config.block_sets))
    at = members.join(comp, members.doc == comp.node, "left").select("key", "doc", "n_shingles", F.coalesce("component", "doc").alias("comp"))
    parts = at.groupBy("key", "comp").agg(F.count("*").alias("n"), F.sum("n_shingles").alias("bulk"))
    open_buckets = (
        parts.groupBy("key")
        .agg(F.count("*").alias("comps"), F.max(F.struct("n", "bulk", "comp")).alias("top"), F.sum("n").alias("n"), F.sum("bulk").alias("bulk"))
        .where("comps > 1")
        .select(
            F.col("key").alias("k"),
            F.col("top.comp").alias("main"),
            blocks(F.col("top.n"), F.col("top.bulk")).alias("main_blocks"),
            blocks(F.col("n") - F.col("top.n"), F.col("bulk") - F.col("top.bulk")).alias("rest_blocks"),
        )
    )
    own = F.pmod(F.xxhash64("doc"), F.when(F.col("comp") == F.col("main"), F.col("main_blocks")).otherwise(F.col("rest_blocks")))
    row = at.join(open_buckets, at.key == F.col("k")).withColumn("own", own)
    task = lambda kind, i, j, side: F.struct(F.lit(kind).alias("kind"), i.cast("long").alias("i"), j.cast("long").alias("j"), F.lit(side).alias("side"))
    # rest against the main component: kind 0, (rest block, main block); among the rest: kind 1, (i, j) with i <= j
    every = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    rest = F.concat(
        F.transform(every(F.col("main_blocks")), lambda j: task(0, F.col("own"), j, 0)),
        F.transform(F.sequence(F.col("own"), F.col("rest_blocks") - 1), lambda j: task(1, F.col("own"), j, 0)),
        F.transform(F.filter(every(F.col("rest_blocks")), lambda i: i < F.col("own")), lambda i: task(1, i, F.col("own"), 1)),
    )
    main = F.transform(every(F.col("rest_blocks")), lambda i: task(0, i, F.col("own"), 1))
    dealt = row.withColumn("t", F.explode(F.when(F.col("comp") == F.col("main"), main).otherwise(rest)))
    dealt = dealt.select("key", "t.kind", "t.i", "t.j", "t.side", "doc", "comp")
    dealt = dealt.join(sets.withColumnRenamed("doc", "d"), F.col("doc") == F.col("d")).drop("d", "doc")
    return dealt.groupBy("key", "kind", "i", "j").applyInArrow(_block_links(config.percent), "a long, b long").distinct()


def near_duplicates(docs: DataFrame, config: MinHashConfig = MinHashConfig(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Groups of near-duplicate documents: doc_id, n_shingles, component_id, kept.

    A document's set holds its distinct shingles of ``shingle_words`` words of
    the lower-cased (A-Z) text; with fewer words, the whole sequence as one.
    Documents are linked when 100 * |intersection| >= percent * |union|.

    * null or empty text, or one without words: n_shingles 0, linked with nothing.
    * equal sets: linked, whatever their number; ties go to the least id.
    * repeated rows: each gets the same result; rows that share an id count as
      one document.  A null id keeps n_shingles, and has null component and kept.
    * very long texts: the whole set counts, 8 bytes a shingle in one task.
    * an empty table gives no rows; further columns are ignored.

    Sets are compared by 64-bit hashes of their shingles.  Missed links: with 28 bands of 5 minima a pair at 0.80 fails to become a
    candidate with probability 1.5e-5, at 0.85 with 1e-7.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    signed = materialize(docs.mapInArrow(_sign(config), _SIGNED), "signed")
    some = signed.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = some.groupBy("d1", "d2").agg(F.min("doc_id").alias("rep"), F.max("doc_id").alias("last"))
    # rows of a class's representative; repeated rows of it are one
    reps = some.join(classes, ["d1", "d2"]).where("doc_id = rep").groupBy(F.col("rep").alias("doc"), "d1", "d2").agg(F.first("bands").alias("bands"), F.first("sig").alias("sig"), F.first("n_shingles").alias("n_shingles"))
    placed = materialize(reps.select("doc", "n_shingles", "sig", "bands"), "representatives")

    # sets too small to link with any but their equals have their class already
    keyed = placed.where(F.col("n_shingles") >= config.least_linked).select("doc", "n_shingles", F.explode("bands").alias("key"))
    buckets = keyed.groupBy("key").agg(F.count("*").alias("n"), F.min("doc").alias("lead"), F.bit_xor(F.xxhash64("doc")).alias("members")).where("n > 1")
    # bands often hold the same documents: one bucket for each set of members is enough
    buckets = buckets.groupBy("n", "lead", "members").agg(F.min("key").alias("k")).select("k", "lead")
    members = materialize(keyed.join(buckets, keyed.key == buckets.k).select("key", "doc", "lead", "n_shingles"), "members")

    sigs = placed.select(F.col("doc").alias("d"), "sig")
    pairs = members.where("doc <> lead").select(F.col("lead").alias("a"), F.col("doc").alias("b")).distinct()
    pairs = pairs.join(sigs.select(F.col("d").alias("b"), F.col("sig").alias("sig_b")), "b").join(sigs.select(F.col("d").alias("a"), F.col("sig").alias("sig_a")), "a")
    pairs = pairs.select("a", "b", "sig_a", "sig_b").mapInArrow(_similar_signatures(config), "a long, b long")

    wanted = materialize(members.select("doc").distinct(), "involved")
    n_wanted = wanted.count()
    texts = docs.join(small(wanted, n_wanted, config.broadcast_ids), docs.doc_id == F.col("doc"), "left_semi")
    sets = materialize(texts.mapInArrow(_sets(config), "doc long, set binary"), "sets")
    whole = pairs.join(sets.select(F.col("doc").alias("b"), F.col("set").alias("set_b")), "b").join(sets.select(F.col("doc").alias("a"), F.col("set").alias("set_a")), "a")
    first = components(whole.select("a", "b", "set_a", "set_b").mapInArrow(_linked_pairs(config), "a long, b long"))
    first = materialize(first, "first")

    more = components(_within_buckets(members, first, sets, config))
    again = more.select(F.col("node").alias("n2"), F.col("component").alias("c2"))
    known = wanted.join(first, wanted.doc == first.node, "left").select("doc", F.coalesce("component", "doc").alias("c1"))
    final = known.join(again, F.col("c1") == F.col("n2"), "left").select("doc", F.coalesce("c2", "c1").alias("component"))

    # many documents have a class of their own and no link; only the others are joined
    grouped = classes.join(final, classes.rep == final.doc, "left").where("component IS NOT NULL OR rep <> last")
    grouped = grouped.select("d1", "d2", F.coalesce("component", "rep").alias("group"))
    out = signed.select("doc_id", "n_shingles", "d1", "d2").join(grouped, ["d1", "d2"], "left")
    component = F.when(F.col("n_shingles") > 0, F.coalesce("group", "doc_id")).otherwise(F.col("doc_id"))
    component = F.when(F.col("doc_id").isNotNull(), component)
    return out.select("doc_id", "n_shingles", component.alias("component_id")).withColumn("kept", F.col("doc_id") == F.col("component_id"))


#: What the contract of query op1 fixes.
OP1 = MinHashConfig(shingle_words=3, percent=85)


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"), OP1)


def deduplicated(docs: DataFrame, config: MinHashConfig = MinHashConfig()) -> DataFrame:
    """The pipeline's stage: of each group the document with the least id stays;
    of repeated rows of it, one.  Rows with a null id stay."""
    kept = near_duplicates(docs, config).where("kept").groupBy(F.col("doc_id").alias("kept_id")).agg(F.count("*").alias("n"))
    kept = materialize(kept, "kept")
    n_kept, repeated = kept.agg(F.count("*"), F.count_if(F.col("n") > 1)).first()
    ids = small(kept.where("n = 1").select("kept_id"), n_kept, config.broadcast_ids)
    out = docs.join(ids, docs.doc_id == ids.kept_id, "left_semi").unionByName(docs.where("doc_id IS NULL"))
    if repeated:
        ids = small(kept.where("n > 1").select("kept_id"), repeated, config.broadcast_ids)
        out = out.unionByName(docs.join(ids, docs.doc_id == ids.kept_id, "left_semi").dropDuplicates(["doc_id"]))
    return out
