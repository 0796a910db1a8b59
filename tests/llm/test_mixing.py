"""Mixing: targets by exact water-filling, and what the rounding promises."""

import re
from fractions import Fraction

import pytest
from llm_cases import empty, rows, table
from quern.llm.mixing import MixConfig, mix, mixed_documents, op4_mixing


def n_words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def brute_targets(sizes, weights=(1, 2, 3), most=3):
    """sizes: source -> words.  One source is capped at a time, the one furthest over."""
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    total, free, target = Fraction(sum(sizes.values())), set(order), {}
    while free:
        level = (total - sum(target.values())) / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > most * sizes[s]]
        if not over:
            return target | {s: level * weight[s] for s in free}
        worst = max(over, key=lambda s: (Fraction(level * weight[s], max(sizes[s], 1)), order.index(s)))
        target[worst] = Fraction(most * sizes[worst])
        free.discard(worst)
    return target


def check(data, got, config=MixConfig()):
    assert len(got) == len(data)
    sizes = {}
    for r in data:
        sizes[r[3]] = sizes.get(r[3], 0) + n_words(r[1])
    want = brute_targets(sizes, config.weights, config.most)
    largest, taken = {}, {}
    for r in got:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(float(want[r.source]), rel=1e-9)
        assert 0 <= r.taken <= 3 * r.size and (r.taken % r.size == 0 if r.size else r.taken == 0)
        largest[r.source] = max(largest.get(r.source, 0), r.size)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s in sizes:
        assert abs(taken[s] - float(want[s])) <= largest[s] + 1e-6, s


def test_targets_and_rounding(spark):
    data = rows(n=300)
    check(data, mix(table(spark, data)).collect())


def test_tree_of_many_leaves(spark):
    data = rows(n=300)
    config = MixConfig(leaf_rows=4, fan_in=3)
    check(data, mix(table(spark, data), config).collect(), config)


def test_small_sources_are_capped_and_the_rest_reshared(spark):
    data = [(i, "w " * k, "en", s, 0) for i, (s, k) in enumerate([("a", 900)] + [("b", 1)] * 20 + [("c", 2)] * 20 + [("d", 300)])]
    check(data, mix(table(spark, data)).collect())


def test_reruns_agree_however_partitioned(spark):
    data = rows(n=200)
    one = sorted((tuple(r) for r in mix(table(spark, data).repartition(7)).collect()), key=repr)
    two = sorted((tuple(r) for r in mix(table(spark, data[::-1]).coalesce(1)).collect()), key=repr)
    assert one == two


def test_expectations_are_kept(spark):
    """Over many seeds a document is taken about as often as its share says."""
    data = [(i, "w " * (1 + i % 4), "en", "ab"[i % 2], 0) for i in range(40)]
    counts = dict.fromkeys(range(40), 0.0)
    n = 25
    for seed in range(n):
        for r in mix(table(spark, data, False).coalesce(1), MixConfig(seed=seed)).collect():
            counts[r.doc_id] += r.taken / r.size / n
            share = r.target / r.source_size
            assert int(share) * r.size <= r.taken <= (int(share) + 1) * r.size
    assert abs(sum(counts[i] for i in range(0, 40, 2)) / 20 - 33.33 / 40) < 0.08


def test_query_on_test_tables(spark, sf_dir):
    data = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    source = {r[0]: r[3] for r in data}

    class Row:
        def __init__(self, r):
            self.__dict__.update(r.asDict(), source=source[r.doc_id])

    check(data, [Row(r) for r in op4_mixing(spark, sf_dir).collect()])


def test_stage_repeats_documents(spark):
    data = rows(n=60)
    docs = table(spark, data)
    copies = {}
    for r in mix(docs).collect():
        copies[r.doc_id, r.source] = copies.get((r.doc_id, r.source), 0) + r.copies
    out = mixed_documents(docs)
    assert out.columns == docs.columns
    seen = {}
    for r in out.collect():
        seen[r.doc_id, r.source] = seen.get((r.doc_id, r.source), 0) + 1
    assert seen == {k: v for k, v in copies.items() if v}


def test_stage_takes_each_row_of_one_id_by_itself(spark):
    """Different texts under a null or repeated id: none is lost, none gets another's copies."""
    data = [(None if i < 30 else 7, f"text {i} " + "w " * (i % 5), "en", "a", i) for i in range(60)]
    for docs in (table(spark, data), table(spark, data[::-1]).repartition(5)):
        seen = {}
        for r in mixed_documents(docs, MixConfig(weights=(1,))).collect():
            seen[r.n_chars] = seen.get(r.n_chars, 0) + 1
        assert seen == {i: 1 for i in range(60)}  # one source: its target is its size
    tripled = table(spark, [(None, f"b{i} x", "en", "b", i) for i in range(9)] + [(i, "w " * 100, "en", "a", 100 + i) for i in range(9)])
    seen = {}
    for r in mixed_documents(tripled, MixConfig(weights=(1, 9))).collect():
        seen[r.text] = seen.get(r.text, 0) + 1
    assert all(seen[f"b{i} x"] == 3 for i in range(9))  # its target is capped at three times its size


def test_empty_table(spark):
    assert mix(empty(spark)).count() == 0
    assert mixed_documents(empty(spark)).count() == 0
