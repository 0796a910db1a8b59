"""Operator 10: random order over shards by a two-pass external shuffle (native).

Pass 1 scatters whole records by a seeded hash into buckets that fit in memory;
pass 2 takes each bucket, shuffles it (Spark's ``shuffle`` is a Fisher-Yates
shuffle), lays the buckets end to end and writes them.  The law is ``rows``: shard k takes the
places from k*n/s on, so counts differ by at most one.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quern.store import materialize, new_dir, small, table


@dataclass(frozen=True)
class ShardConfig:
    shards: int = 40
    seed: int = 11
    bucket_bytes: int = 32 << 20  # of records, taken into memory at once by pass 2
    record_bytes: int = 16  # counted for a record besides its text


def _hashed(docs: DataFrame, config: ShardConfig) -> list[Column]:
    """Two 64-bit hashes of a whole row, that equal rows share."""
    whole = [F.to_json(c) if "map<" in kind else F.col(c) for c, kind in docs.dtypes]
    return [F.xxhash64(F.lit(config.seed + i), *whole).alias(f"h{i}") for i in (0, 1)]


def _numbered(docs: DataFrame, size: Column, config: ShardConfig) -> DataFrame:
    """h0, h1, copy, bytes, row: equal rows are numbered from 0, so that each has a place of its own.

    Equal rows are counted, not gathered: their counts are aggregated before they are
    shuffled, and one row stands for all until it is repeated.
    """
    own = docs.select(*_hashed(docs, config), size.alias("bytes"), F.struct(*docs.columns).alias("row"))
    counts = own.groupBy(F.col("h0").alias("r0"), F.col("h1").alias("r1")).agg(F.count("*").alias("n")).where("n > 1")
    counts = materialize(counts, "repeated")
    n = counts.count()
    single = F.lit(0).alias("copy")
    if not n:
        return own.select("h0", "h1", single, "bytes", "row")
    repeated = small(counts, n, 1_000_000)
    met = (own.h0 == repeated.r0) & (own.h1 == repeated.r1)
    alone = own.join(repeated, met, "left_anti").select("h0", "h1", single, "bytes", "row")
    one = own.join(repeated, met, "left_semi").groupBy("h0", "h1").agg(F.count("*").alias("n"), F.first("bytes").alias("bytes"), F.first("row").alias("row"))
    copies = F.explode(F.sequence(F.lit(0), F.col("n").cast("int") - 1)).alias("copy")
    return alone.unionAll(one.select("h0", "h1", copies, "bytes", "row"))


def shards(docs: DataFrame, config: ShardConfig = ShardConfig(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """All columns of ``docs`` and shard (int), slot (long, gapless from 0 in each shard).

    Columns of these names in ``docs`` are replaced.  Each row is placed once,
    repeated rows and null ids or texts included; an empty table gives no rows.
    Rows go to buckets by a hash of the whole row and, among equal rows, of the copy's
    number, so neither a hot id nor a large group of equal texts or rows fills one
    bucket.  The same rows get the same places, however they are partitioned.  A text
    larger than a bucket is whole in one.
    """
    docs = docs.drop("shard", "slot")
    size = F.coalesce(F.octet_length(docs[text_col].cast("string")), F.lit(0)).cast("long") + config.record_bytes
    total, rows = docs.agg(F.sum(size), F.count("*")).first()
    buckets = max(1, -(-(total or 0) // config.bucket_bytes))
    numbered = _numbered(docs, size, config)
    scatter = F.xxhash64(F.lit(config.seed), "h0", "copy")
    record = F.struct(scatter.alias("h"), "h0", "h1", "copy", "row")
    staged = numbered.select(F.pmod(scatter, F.lit(buckets)).alias("bucket"), record.alias("record"))
    filled = materialize(staged.groupBy(F.col("bucket").alias("b")).agg(F.count("*").alias("n")), "filled")

    # rows before each bucket: sums in runs of 1024 buckets, then over the runs
    counts = filled.select("b", "n", F.floor(F.col("b") / 1024).alias("run"))
    runs = counts.groupBy("run").agg(F.sum("n").alias("n"))
    before_run = F.coalesce(F.sum("n").over(Window.orderBy("run").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = runs.select("run", before_run.alias("run_first"))
    before = F.coalesce(F.sum("n").over(Window.partitionBy("run").orderBy("b").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    firsts = counts.withColumn("before", before).join(runs, "run").select("b", (F.col("run_first") + F.col("before")).alias("first"))

    # a task for each bucket, so that its shuffle's seed is the bucket's own
    scattered = staged.select(F.col("bucket").cast("int").alias("bucket"), "record").repartitionById(buckets, "bucket")
    gathered = scattered.groupBy("bucket").agg(F.collect_list("record").alias("records"))
    # one order whatever order the records came in, then the shuffle
    parts = ("h", "h0", "h1", "copy")
    before = lambda x, y, c, rest: F.when(x[c] < y[c], -1).when(x[c] > y[c], 1).otherwise(rest)
    ordered = F.array_sort("records", lambda x, y: reduce(lambda rest, c: before(x, y, c, rest), reversed(parts), F.lit(0)))
    shuffled = gathered.select("bucket", F.shuffle(ordered, seed=F.lit(config.seed)).alias("records"))
    placed = shuffled.join(small(firsts, buckets, 1_000_000), F.col("bucket") == F.col("b")).select("first", F.posexplode("records").alias("at", "record"))
    rank = F.col("first") + F.col("at")
    shard = F.expr(f"(first + at) * {config.shards}L div {max(rows, 1)}L")
    start = F.expr(f"(shard * {max(rows, 1)}L + {config.shards - 1}L) div {config.shards}L")
    return placed.withColumn("shard", shard).select("record.row.*", F.col("shard").cast("int").alias("shard"), (rank - start).alias("slot"))


def write_buckets(docs: DataFrame, path: str, config: ShardConfig = ShardConfig(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Both passes: each task shuffles its bucket and writes it to the folders ``shard=k`` of
    ``path``; what is read back.

    A shard's files, in the order of their names, hold its rows in the order of their
    slots; no shard passes through one task, so shards may be of any size.
    """
    placed = shards(docs, config, id_col, text_col)
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    return docs.sparkSession.read.schema(placed.schema).parquet(path)


def write_shards(placed: DataFrame, path: str) -> None:
    """One folder and one file for each shard, rows in the order of their slots: for shards that a task can sort."""
    placed.repartition("shard").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    config = ShardConfig()
    text = F.coalesce("text", F.lit(""))
    read = write_buckets(table(spark, sf_dir, "documents"), new_dir(spark, "shards"), config)
    return read.select("doc_id", (F.octet_length(text).cast("long") + config.record_bytes).alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
