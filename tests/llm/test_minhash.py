"""Near-duplicate groups against all pairs."""

import itertools
import re

import pytest
from llm_cases import empty, rows, table
from quern.operators.components import components
from quern.llm.minhash import OP1, MinHashConfig, deduplicated, near_duplicates, op1_minhash

LOWER = {i: i + 32 for i in range(65, 91)}


def shingles(text, k):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def brute(docs, k, percent):
    sets = {}
    for doc_id, text in docs:
        if doc_id is not None:
            sets.setdefault(doc_id, shingles(text, k))
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in itertools.combinations(sorted(sets), 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize("config", [OP1, MinHashConfig()])
def test_groups_equal_all_pairs(spark, config):
    data = rows()
    want = brute([(r[0], r[1]) for r in data], config.shingle_words, config.percent)
    got = near_duplicates(table(spark, data), config).collect()
    assert len(got) == len(data)
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept is None
        else:
            assert (r.n_shingles, r.component_id) == want[r.doc_id]
            assert r.kept == (r.doc_id == r.component_id)


def test_query_on_test_tables(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    want = brute(docs, 3, 85)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in op1_minhash(spark, sf_dir).collect()}
    assert got == want


def test_links_beside_the_leader_are_found(spark):
    """The bucket's least member links with few others; those are linked among themselves."""
    base = [f"t{i}" for i in range(200)]
    data = [(0, " ".join(base))]
    for i in range(1, 41):
        w = list(base)
        for j in range(i % 8 * 20, i % 8 * 20 + 6):
            w[j] = f"n{i % 8}{j}"
        w[199 - i // 8] = f"e{i}"
        data.append((i, " ".join(w)))
    docs = spark.createDataFrame(data, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, OP1).collect()}
    assert got == brute(data, 3, 85)


def test_small_blocks_lose_no_link(spark):
    """Many sets in one open bucket, compared a few at a time; sets too small to link."""
    base = [f"t{i}" for i in range(60)]
    data = [(i, " ".join([*base[:-3], f"a{i}", f"b{i % 9}", f"c{i % 4}"])) for i in range(60)]
    data += [(100 + i, f"{i % 5} b c d e f g"[: 4 + 2 * (i % 6)]) for i in range(40)]
    docs = spark.createDataFrame(data, "doc_id long, text string")
    for config in (MinHashConfig(shingle_words=3, percent=95, block_sets=7), MinHashConfig(shingle_words=3, percent=85, block_sets=3, block_shingles=200), MinHashConfig(shingle_words=1, percent=80)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in near_duplicates(docs, config).collect()}
        assert got == brute(data, config.shingle_words, config.percent)


def test_empty_table(spark):
    assert near_duplicates(empty(spark), OP1).count() == 0
    assert deduplicated(empty(spark)).count() == 0


def test_stage_keeps_one_of_each_group(spark):
    data = rows()
    docs = table(spark, data)
    out = deduplicated(docs)
    assert out.columns == docs.columns
    want = brute([(r[0], r[1]) for r in data], 5, 80)
    assert sorted(r.doc_id for r in out.collect() if r.doc_id is not None) == sorted(i for i, (_, c) in want.items() if i == c)
    assert sum(r.doc_id is None for r in out.collect()) == 2


def test_components_of_long_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(100, 300)] + [(5, i) for i in range(400, 500)] + [(7, 7), (8, 9), (9, 8), (None, 3)]
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 100 for i in range(100, 301)) and all(got[i] == 5 for i in range(400, 500))
    assert got[8] == got[9] == 8 and 7 not in got and got[5] == 5
