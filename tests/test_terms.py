"""Terms counted in batches, products with fitted rows, and bounded samples, against plain Python."""

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F
from quern.config import CharGramConfig, TfidfConfig
from quern.operators import cluster as C
from quern.operators import terms as W
from quern.operators import tfidf

TEXTS = ["ab ab", "", "é\U0001f600é\U0001f600", "aaaa", "b", None, "ab cd é", "xyz" * 9]


def test_counts_equal_plain_python(monkeypatch):
    for table in (W._TABLE, 1):
        monkeypatch.setattr(W, "_TABLE", table)
        row, term, count, names = W.char_counts(2, 4)(pa.array(TEXTS))
        got = [Counter() for _ in TEXTS]
        for r, t, n in zip(row, term, count):
            got[r][names[int(t)].as_py()] += int(n)
        assert got == [Counter(t[i : i + n] for n in (2, 3, 4) for i in range(len(t) - n + 1)) for t in (x or "" for x in TEXTS)]
    lists = [["a", "b", "a"], [], None, ["b"]]
    row, term, count, names = W.list_counts(pa.array(lists, pa.list_(pa.string())))
    assert sorted((int(r), names[int(t)].as_py(), int(n)) for r, t, n in zip(row, term, count)) == [(0, "a", 2), (0, "b", 1), (3, "b", 1)]


def test_batches_and_joins_agree(spark, monkeypatch):
    data = [(g, i, TEXTS[i % len(TEXTS)]) for i in range(24) for g in [("a", "b", None)[i % 3]]]
    docs = spark.createDataFrame(data, "g string, id long, t string").repartition(3)
    config = CharGramConfig(min_df=1, max_features=9)
    key = lambda r: (r.g or "", r.id)

    def both():
        vecs, vocab = tfidf.char_tfidf(docs, "g", "id", F.col("t"), config)
        more, _ = tfidf.word_tfidf(docs, "g", "id", F.col("t"), ["cd"], TfidfConfig(min_df=1, max_df=1.0))
        own = [[(key(r), [x.term for x in r.vector], [round(x.weight, 9) for x in r.vector]) for r in sorted(v.collect(), key=key)] for v in (vecs, more)]
        return own, sorted(repr(r) for r in vocab.select("g", "term", "df", "total", "n").collect())

    got = both()
    assert got[0][0] and got[0][1]
    plan = tfidf.char_frequencies(docs, "g", "id", F.col("t"), config)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # sums by term alone are shuffled
    monkeypatch.setattr(tfidf, "MOST_SHARED_TERMS", -1)
    assert both() == got
    monkeypatch.setattr(tfidf, "_told_apart", lambda *_: False)
    assert both() == got


def test_rows_of_one_id_are_one_document(spark):
    docs = spark.createDataFrame([("a", 1, "abab"), ("a", 1, "ab"), ("a", 2, "ab")], "g string, id long, t string")
    got = {r.term: (r.df, r.total) for r in tfidf.char_frequencies(docs, "g", "id", F.col("t"), CharGramConfig()).collect()}
    assert got["ab"] == (2, 4) and got["abab"] == (1, 1)


def test_products_and_nearest_equal_dense_ones():
    rng = np.random.default_rng(3)
    dense = [np.where(rng.random((n, 50)) < 0.3, rng.random((n, 50)), 0) for n in (30, 11)]
    a, b = (C.Sparse([[{"term": int(t), "weight": float(r[t])} for t in np.flatnonzero(r)] for r in d]) for d in dense)
    for width in (0, 7, 64):
        for at_once in (1, 100, 1 << 22):
            assert np.allclose(C.Fitted(a, width).products(b, at_once), dense[1] @ dense[0].T, atol=1e-5)
    score = rng.integers(0, 5, (20, 60)).astype(float)
    assert (C.nearest(score, 5) == np.argsort(-score, axis=1, kind="stable")[:, :5]).all()


def test_samples_order_few_rows(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 4990, "a").alias("group"), "id")
    sample, large = C._sample(rows, 40)
    want = {("a", r.id) for r in rows.where("group = 'a'").orderBy(F.xxhash64("id"), "id").limit(40).collect()} | {(None, i) for i in range(4990, 5000)}
    assert {(r.group, r.id) for r in sample.collect()} == want and large == ["a"]
