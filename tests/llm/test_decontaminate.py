"""Windows of benchmark items in documents against a search of every place."""

import hashlib
import random
import re

import pytest
from llm_cases import empty, prose, rows, table
from quern.llm.decontaminate import LeakConfig, clean_documents, find_leaks, op6_decontaminate

LOWER = {i: i + 32 for i in range(65, 91)}


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute(docs, items, n=10):
    windows = {}
    for item, text in items:
        w = words(text)
        if item is None or not w:
            continue
        k = min(n, len(w))
        for i in range(len(w) - k + 1):
            windows.setdefault(tuple(w[i : i + k]), set()).add(str(item))
    lengths = sorted({len(w) for w in windows})
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for k in lengths:
            for i in range(len(w) - k + 1):
                if (own := windows.get(tuple(w[i : i + k]))) is not None:
                    found |= own
                    hit |= set(range(i, i + k))
        out.append((doc_id, len(w), len(hit), sorted(found)))
    return out


def fixture():
    rng = random.Random(9)
    items = [(i, prose(rng, rng.choice((1, 4, 10, 15, 40)))) for i in range(60)]
    items += [(100, items[3][1]), (101, None), (102, " .,- "), (None, "never counted " * 6), (103, "a a a a a a a a a a a a a"), (103, "second row of the same item has ten words in it"), (104, "Éa9 éé")]
    data = rows(n=60)
    for i in range(60):
        t = words(items[rng.randrange(60)][1])
        a = rng.randrange(max(1, len(t) - 9))
        data.append((5000 + i, prose(rng, 20) + " -- " + "-".join(t[a : a + rng.choice((9, 10, 11, 30))]).upper() + ". " + prose(rng, 5), "en", "a", 1))
    data += [(6000, "a " * 30, "en", "a", 1), (6001, "x Éa9 éé y", "en", "a", 1)]
    return data, items


@pytest.mark.parametrize("block_bytes", [16 << 20, 3000])
def test_hits_equal_brute_force(spark, block_bytes):
    data, items = fixture()
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    got = find_leaks(table(spark, data), benchmark, LeakConfig(block_bytes=block_bytes)).collect()
    want = brute([r[:2] for r in data], items)
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.n_words, r.n_hit, list(r["items"]))) for r in got)
    for r in got:
        assert r.n_hit == sum(b - a for a, b in zip(r.ranges[0::2], r.ranges[1::2]))


def test_query(spark, sf_dir):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect()]
    want = {(d, n, h, len(i), hashlib.sha256(",".join(i).encode()).hexdigest(), h > 0) for d, n, h, i in brute(docs, items)}
    got = op6_decontaminate(spark, sf_dir)
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert {tuple(r) for r in got.collect()} == want


def test_stage_drops_hit_documents_only(spark):
    data, items = fixture()
    docs = table(spark, data)
    out = clean_documents(docs, spark.createDataFrame(items, "item_id long, text string"))
    bad = {d for d, _, h, _ in brute([r[:2] for r in data], items) if h}
    assert out.columns == docs.columns
    assert sorted(repr(r.doc_id) for r in out.collect()) == sorted(repr(r[0]) for r in data if r[0] not in bad)


@pytest.mark.parametrize("block_bytes", [16 << 20, 60])
def test_stage_judges_each_row_by_itself(spark, block_bytes):
    """Clean rows stay when another row of their id, null or not, is hit."""
    leak, other = "one two three four five six seven eight nine ten", "red green blue black white brown pink grey teal lime"
    data = [(None, f"before {leak} after", "en", "a", 0), (None, "a clean text", "en", "a", 1), (None, None, "en", "a", 2), (5, leak, "en", "a", 3), (5, "clean too", "en", "a", 4), (6, other.upper(), "en", "a", 5), (6, "", "en", "a", 6)]
    items = spark.createDataFrame([(i, t) for i, t in enumerate((leak, other))], "item_id long, text string")
    out = clean_documents(table(spark, data).repartition(2), items, LeakConfig(block_bytes=block_bytes)).collect()
    assert sorted(r.n_chars for r in out) == [1, 2, 4, 6]


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    some = spark.createDataFrame([(1, "one two three")], "item_id long, text string")
    assert find_leaks(empty(spark), some).count() == 0
    got = find_leaks(table(spark, rows(n=10)), none).collect()
    assert got and all(r.n_hit == 0 and r["items"] == [] for r in got)
