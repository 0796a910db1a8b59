"""Sharding: every row once, counts level, slots gapless, order random but fixed."""

import zlib
from collections import Counter

from llm_cases import empty, rows, table
from quern.llm.sharding import ShardConfig, op10_sharding, shards, write_buckets, write_shards


def check(got, n, k):
    assert len(got) == n
    slots = {}
    for r in got:
        slots.setdefault(r.shard, []).append(r.slot)
    counts = [len(slots.get(i, ())) for i in range(k)]
    assert max(counts) - min(counts) <= 1 and set(slots) <= set(range(k))
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())


def test_rows_law_and_all_columns(spark):
    data = rows()
    docs = table(spark, data)
    got = shards(docs, ShardConfig(bucket_bytes=4000)).collect()
    check(got, len(data), 40)
    assert Counter((r.doc_id, r.text, r.source) for r in got) == Counter((r[0], r[1], r[3]) for r in data)
    assert got[0].size == -5  # further columns stay


def test_order_is_fixed_whatever_the_partitions(spark):
    data = rows()
    place = lambda df: sorted((r.doc_id or 0, r.text or "", r.shard, r.slot) for r in df.collect())
    config = ShardConfig(bucket_bytes=40_000)
    assert place(shards(table(spark, data).repartition(5), config)) == place(shards(table(spark, data[::-1]).coalesce(1), config))


def test_order_is_mixed(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "repeat('x', 50) AS text")
    got = sorted(shards(docs, ShardConfig(bucket_bytes=20000)).collect(), key=lambda r: (r.shard, r.slot))
    ids = [r.doc_id for r in got]
    near = sum(abs(a - b) < 40 for a, b in zip(ids, ids[1:]))
    assert near < 200  # about 80 by chance
    for k in range(40):  # every shard has rows from everywhere
        own = [r.doc_id for r in got if r.shard == k]
        assert 1000 < sum(own) / len(own) < 3000


def test_a_row_repeated_without_end_is_dealt_out(spark):
    data = rows(n=20) + [(1, "the same row again", "en", "a", 1)] * 3000
    got = shards(table(spark, data), ShardConfig(bucket_bytes=4000)).collect()
    check(got, len(data), 40)
    assert Counter((r.doc_id, r.text) for r in got) == Counter(r[:2] for r in data)


def test_copies_lie_apart_and_stay_where_they_are(spark):
    """Equal rows are scattered like others, and reruns agree however they are partitioned."""
    data = rows(n=20) + [(1, "the same row again", "en", "a", 1)] * 500
    config = ShardConfig(bucket_bytes=4000)
    place = lambda df: sorted((r.doc_id or 0, r.text or "", r.shard, r.slot) for r in df.collect())
    got = place(shards(table(spark, data).repartition(5), config))
    assert got == place(shards(table(spark, data[::-1]).coalesce(2), config))
    own = Counter(r[2] for r in got if r[:2] == (1, "the same row again"))
    whole = Counter(r[2] for r in got)
    assert len(own) == 40 and all(own[k] > whole[k] / 2 for k in own)


def test_written_buckets_read_back(spark, tmp_path):
    """Files of a shard by name hold its slots in order; rows that differ outside id and text stay apart."""
    data = rows() + [(1, "text", "en", str(i), i) for i in range(30)]
    config = ShardConfig(shards=3, bucket_bytes=4000)
    read = write_buckets(table(spark, data), str(tmp_path / "out"), config)
    check(read.collect(), len(data), 3)
    assert Counter((r.doc_id, r.text, r.source) for r in read.collect()) == Counter((r[0], r[1], r[3]) for r in data)
    assert sorted(map(repr, read.collect())) == sorted(map(repr, shards(table(spark, data[::-1]), config).select(read.columns).collect()))
    for k in range(3):
        files = sorted((tmp_path / f"out/shard={k}").glob("part-*.parquet"))
        assert len(files) > 1
        slots = [r.slot for f in files for r in spark.read.parquet(str(f)).coalesce(1).collect()]
        assert slots == list(range(len(slots)))
    assert write_buckets(empty(spark), str(tmp_path / "none"), config).count() == 0


def test_query(spark, sf_dir):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    got = op10_sharding(spark, sf_dir).collect()
    check(got, len(docs), 40)
    for r in got:
        raw = (docs[r.doc_id] or "").encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(raw) + 16, zlib.crc32(raw), "rows", None)


def test_native_plan(spark, sf_dir):
    plan = op10_sharding(spark, sf_dir)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_written_shards_keep_their_order(spark, tmp_path):
    placed = shards(table(spark, rows(), False), ShardConfig(shards=3, bucket_bytes=4000))
    write_shards(placed, str(tmp_path / "out"))
    for k in range(3):
        found = spark.read.parquet(str(tmp_path / f"out/shard={k}")).coalesce(1).collect()
        assert [r.slot for r in found] == list(range(len(found)))


def test_empty_table(spark):
    assert shards(empty(spark)).count() == 0
