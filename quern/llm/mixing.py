"""Operator 4: mixing sources to target weights by pivotal dependent rounding.

A document of a source whose target is x times its size should be taken x times:
floor(x) times for certain and once more with probability x - floor(x).  Two
documents with fractional probabilities meet: words are moved at random from one
to the other, so that neither expectation changes, until one probability is 0 or
1; the other goes on.  Each leaf (a bounded share of one source) leaves at most
one fractional document; these residuals meet again in a tree, level by level.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import kernels as K
from quern.operators.numbering import ranks
from quern.store import materialize, small, table


@dataclass(frozen=True)
class MixConfig:
    weights: tuple[int, ...] = (1, 2, 3)  # of the sources in the order of their code points, repeating
    share: float = 1.0  # of all words is to be taken
    most: int = 3  # a source's target is at most so many times its size
    seed: int = 5
    leaf_rows: int = 10_000
    fan_in: int = 64


def _sizes(batches):
    for batch in batches:
        counts = []
        for _, _, raw, bounds in K.chunks(*K.utf8(batch.column(2))):
            _, _, first = K.words(raw, bounds, K.NON_SPACE)
            counts.append(np.diff(first))
        size = np.concatenate(counts) if counts else np.zeros(0)
        yield pa.RecordBatch.from_arrays([batch.column(0).cast(pa.int64()), batch.column(1), pa.array(size, pa.int64()), batch.column(3), batch.column(4)], names=["doc_id", "source", "size", "h", "n"])


def targets(sources: DataFrame, config: MixConfig) -> DataFrame:
    """``sources`` (source, source_size, rows) with their target.

    Water-filling: what is not capped shares the rest by weight, until no target
    is above its cap.  Each round is one aggregation over the sources, and caps
    at least one more.
    """
    ranked = ranks(sources, [F.col("source").asc_nulls_last()], "rank")
    cycle = F.array(*[F.lit(float(w)) for w in config.weights])
    ranked = materialize(ranked.withColumn("weight", F.get(cycle, F.pmod("rank", F.lit(len(config.weights))))).withColumn("cap", (F.col("source_size") * config.most).cast("double")), "sources")
    total = (ranked.agg(F.sum("source_size")).first()[0] or 0) * config.share
    level, capped = 0.0, -1
    while True:
        over = F.col("weight") * F.lit(level) > F.col("cap")
        n, used, weight = ranked.agg(F.count_if(over), F.sum(F.when(over, F.col("cap")).otherwise(0.0)), F.sum(F.when(~over, F.col("weight")).otherwise(0.0))).first()
        if n == capped or not weight:
            break
        level, capped = (total - used) / weight, n
    return ranked.withColumn("target", F.least(F.col("cap"), F.col("weight") * F.lit(level))).drop("rank", "weight", "cap")


_SIZED = "doc_id long, source string, size long, h long, n long"
_ROW = f"{_SIZED}, leaf long, base int, p double, fractional boolean"


def _duel(seed: int, last: bool):
    """Rounds one leaf: at most one row stays fractional, none if this is the ``last`` level."""

    def run(leaf: pa.Table) -> pa.Table:
        leaf = leaf.sort_by([("doc_id", "ascending"), ("size", "ascending"), ("p", "ascending"), ("leaf", "ascending"), ("h", "ascending"), ("n", "ascending")])
        ids, size, p = leaf["doc_id"].to_pylist(), leaf["size"].to_pylist(), leaf["p"].to_pylist()
        rng = np.random.default_rng([seed, len(ids), *[(x or 0) & 0xFFFFFFFF for x in (ids[0], ids[-1], sum(size))]])
        luck = rng.random(len(p) + 1).tolist()
        held = None  # the row that is still fractional
        for i in range(len(p)):
            if not 0.0 < p[i] < 1.0:
                continue
            if size[i] == 0:  # moves no words
                p[i] = float(luck[i] < p[i])
                continue
            if held is None:
                held = i
                continue
            a, b = held, i
            up = min((1.0 - p[a]) * size[a], p[b] * size[b])  # words that b can give a
            down = min(p[a] * size[a], (1.0 - p[b]) * size[b])
            move = up if luck[i] * (up + down) < down else -down
            full_a = move == (1.0 - p[a]) * size[a] if move > 0 else -move == p[a] * size[a]
            full_b = move == p[b] * size[b] if move > 0 else -move == (1.0 - p[b]) * size[b]
            p[a] = float(move > 0) if full_a else min(max(p[a] + move / size[a], 0.0), 1.0)
            p[b] = float(move < 0) if full_b else min(max(p[b] - move / size[b], 0.0), 1.0)
            held = next((x for x in (a, b) if 0.0 < p[x] < 1.0), None)
        if last and held is not None:
            p[held] = float(luck[-1] < p[held])
        out = leaf.drop_columns(["p", "fractional"])
        return out.append_column("p", pa.array(p)).append_column("fractional", pa.array([0.0 < x < 1.0 for x in p]))

    return run


def mix(docs: DataFrame, config: MixConfig = MixConfig(), id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """One row for each row of ``docs``: doc_id, source, size (words), source_size,
    target (double, its source's), copies (int), taken (words, repeats counted).

    * null or empty text: size 0; it takes no words.  A null source is a source of
      its own, the last.  Null ids and repeated rows are kept, each rounded by itself.
    * very long texts: all words count.  Ties: equal rows are rounded one by one, in an order
      that their equality makes indifferent.
    * all sizes 0: targets 0.  An empty table gives no rows; further columns are ignored.
    * the same rows give the same result, however they are partitioned.

    Within a source the words taken differ from the target by less than the
    largest document.
    """
    none = F.lit(0).cast("long")
    read = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), F.col(text_col).cast("string").alias("text"), none.alias("h"), none.alias("n"))
    return _mixed(read, config).drop("h", "n")


def _mixed(read: DataFrame, config: MixConfig) -> DataFrame:
    """``mix`` of doc_id, source, text, h (orders rows of one id and size), n (the row's number); h and n go along."""
    sized = materialize(read.mapInArrow(_sizes, _SIZED), "sized")
    sources = sized.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("rows"))
    aims = materialize(targets(sources, config), "targets")
    n_sources, largest = aims.agg(F.count("*"), F.max("rows")).first()

    leaves = F.ceil(F.col("rows") / config.leaf_rows)
    x = F.when(F.col("source_size") > 0, F.least(F.col("target") / F.col("source_size"), F.lit(float(config.most)))).otherwise(0.0)
    aim = aims.select(F.col("source").alias("s"), x.alias("x"), leaves.alias("leaves"))
    rows = sized.join(small(aim, n_sources, 100_000), sized.source.eqNullSafe(F.col("s")))
    rows = rows.select("doc_id", "source", "size", "h", "n", F.pmod(F.xxhash64(F.lit(config.seed), "doc_id", "size"), "leaves").alias("leaf"), F.floor("x").cast("int").alias("base"), (F.col("x") - F.floor("x")).alias("p"), F.lit(True).alias("fractional"))
    done, width = [], -(-(largest or 1) // config.leaf_rows)
    while True:
        level = rows.groupBy("source", "leaf").applyInArrow(_duel(config.seed + len(done), width == 1), _ROW)
        level = materialize(level, f"level{len(done)}")
        done.append(level.where("NOT fractional"))
        if width == 1:
            break
        rows = level.where("fractional").withColumn("leaf", F.floor(F.col("leaf") / config.fan_in))
        width = -(-width // config.fan_in)
    out = done[0]
    for level in done[1:]:
        out = out.unionByName(level)
    out = out.select("doc_id", "source", "size", "h", "n", (F.col("base") + F.col("p").cast("int")).alias("copies"))
    named = aims.select(F.col("source").alias("s"), "source_size", "target")
    out = out.join(small(named, n_sources, 100_000), out.source.eqNullSafe(F.col("s"))).drop("s")
    return out.withColumn("taken", F.col("copies") * F.col("size"))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", F.col("taken").cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, config: MixConfig = MixConfig()) -> DataFrame:
    """The pipeline's stage: each row as often as the mix takes it.

    Rows are numbered, so rows that share an id and a source keep their own copies.
    """
    rows = materialize(docs.select(F.monotonically_increasing_id().alias("n"), F.struct(*docs.columns).alias("row")), "numbered")  # columns of docs may have any names
    row, text = F.col("row"), F.col("row")["text"].cast("string")
    read = rows.select(row["doc_id"].alias("doc_id"), row["source"].cast("string").alias("source"), text.alias("text"), F.xxhash64(text).alias("h"), "n")
    copies = materialize(_mixed(read, config).where("copies > 0").select(F.col("n").alias("taken"), "copies"), "copies")
    met = rows.join(small(copies, copies.count(), 1_000_000), F.col("n") == F.col("taken"))
    return met.withColumn("copy", F.explode(F.sequence(F.lit(1), "copies"))).select("row.*")
