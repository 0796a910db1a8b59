"""Text functions against plain Python, on odd characters; the traps of the cleaning rules."""

import hashlib
import random
import re

import numpy as np
from pyspark.sql import functions as F
from quern.functions import text as T
from quern.functions.accents import plain, strip_accents
from quern.functions.simhash import simhash64
from quern.operators.features import standardised
from quern.operators.hdbscan import hdbscan
from quern.operators.manifest import text_stats
from quern.operators.umap import svd, umap

CHARS = list("aB1 .\t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0  　é²٣Ⅷİßł\U0001f600@+-/:$")


def texts(n=400):
    rng = random.Random(2)
    return ["".join(rng.choices(CHARS, k=rng.randint(0, 60))) for _ in range(n)] + ["", "a\r\nb\x85c d\n", "on 12/05/2019 and 2019-12-05", "$ 5, 10 usd, 3.5 EUR", "\n", "x" * 49]


def test_statistics_equal_plain_python(spark):
    data = list(enumerate(texts())) + [(-1, None)]
    got = text_stats(spark.createDataFrame(data, "i long, text string")).collect()
    for r in got:
        t = dict(data)[r.i] or ""
        lines = t.splitlines()
        assert r.n_chars == len(t) and r.n_lines == len(lines) and r.n_tokens == len(t.split()), repr(t)
        assert r.blank_lines == sum(not x.strip() for x in lines) and r.max_line_len == max(map(len, lines), default=0)
        assert abs(r.avg_line_len - sum(map(len, lines)) / max(1, len(lines))) < 1e-9
        for name, test in (("digit_ratio", str.isdigit), ("upper_ratio", str.isupper), ("non_ascii_ratio", lambda c: ord(c) > 127)):
            assert abs(getattr(r, name) - sum(map(test, t)) / max(1, len(t))) < 1e-9, (name, t)
        assert r.date_like_count == len(re.findall(r"\b\d{1,2}[/-]\d{1,2}[/-]\d{2,4}\b|\b\d{4}-\d{2}-\d{2}\b", t))


def value(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def test_cleaning(spark):
    clean = lambda kind, text, **k: value(spark, T.clean_text(F.lit(kind), F.lit(text), **k))
    assert clean("x", "met Nov 10 2016 ok") == "met __DATE__ __YEAR__ ok"
    assert clean("x", "met 10 Nov 2016 ok") == "met __DATE__ ok"
    assert clean("x", "From: a\nbody at 8:43\nSent from my iPhone") == "body at __TIME__"
    assert clean("email_x", "a=3Db") == "a b" and clean("note", "a=3Db") == "a=3Db"
    assert clean("x", "keep\n____\nUNSUBSCRIBE now", phrases=["^_{2,}$", "unsubscribe"]) == "keep now"
    assert clean("x", "one  Two\nthree", phrases=["two three"], as_regex=False) == "one"
    norm = lambda kind, text: value(spark, T.normalize_text(F.lit(kind), F.lit(text)))
    assert norm("email_x", "From: a\nhello=3Dworld") == "hello world" and norm("other", "From: a\nb") == "From: a b"
    assert norm("chat_ichat_x", "Service: y\n1/2/2019 3:04 PM\nhi") == "hi"
    assert value(spark, T.preview(F.lit("x\r\ny"))) == "x\\r\ny" and value(spark, T.preview(F.lit("x\r\ny"), cr="newline")) == "x\n\ny"
    assert value(spark, T.distinct_shingles(F.lit("a b c d e f g"), 8)) == []
    assert value(spark, T.distinct_shingles(F.lit("A b a B a b"), 3)) == ["a b a", "b a b"]


def test_simhash_equals_plain_python(spark):
    def brute(text):
        sums = [0] * 64
        for t in re.findall("[a-z0-9]+", text.lower()):
            h = int.from_bytes(hashlib.md5(t.encode()).digest()[:8], "big")
            sums = [s + (1 if h >> i & 1 else -1) for i, s in enumerate(sums)]
        out = sum(1 << i for i, s in enumerate(sums) if s > 0)
        return out - 2**64 if out >= 2**63 else out

    data = list(enumerate(texts(80) + ["!!!", "the same the same", "a b c d e f g " * 30]))
    df = spark.createDataFrame(data, "i long, text string")
    for most in (None, 800):
        for r in simhash64(df, F.col("text"), ["i"], most_tokens=most).collect():
            assert r.simhash64 == brute(dict(data)[r.i])


def test_accents(spark):
    for text in ("Éça ñü żółw", "ﬁn é", "Ἀθήνα Ёж"):
        assert value(spark, strip_accents(F.lit(text))) == plain(text)


def test_density_clusters():
    rng = np.random.default_rng(1)
    x = np.concatenate([rng.normal(c, 0.2, (60, 3)) for c in ((0, 0, 0), (5, 0, 0), (0, 5, 5))] + [rng.uniform(-20, 20, (15, 3))])
    labels, probs = hdbscan(x, 15, 5)
    assert len(set(labels) - {-1}) == 3 and ((probs >= 0) & (probs <= 1)).all()
    for i in range(3):
        own = labels[60 * i : 60 * i + 60]
        assert np.bincount(own[own >= 0]).max() > 50
    assert (hdbscan(x[:4], 15)[0] == -1).all()
    assert (labels[180:] == -1).mean() > 0.6


def test_embedding_keeps_neighbours():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(0, 0.1, (50, 20)) + np.eye(20)[i] * 3 for i in range(4)])
    y = umap(x @ x.T, 15, 2)
    own = np.repeat(np.arange(4), 50)
    near = np.argsort(((y[:, None] - y[None]) ** 2).sum(-1), axis=1)[:, 1:6]
    assert (own[near] == own[:, None]).mean() > 0.95 and np.isfinite(y).all()
    u = svd(x @ x.T, 20)
    assert np.allclose(u @ u.T, x @ x.T, atol=1e-6)


def test_collapse_and_family_on_odd_blanks(spark):
    blanks = ["a  b", " a\tb ", "a\xa0 b", "a \xa0b", "x   y\n", " ", "a b c", "\x1c\x1da", "　a \n b　"]
    data = spark.createDataFrame([(t,) for t in texts() + blanks], "t string").select("t", T.collapse(F.col("t")).alias("c"))
    assert all(r.c == " ".join(r.t.split()) for r in data.collect())
    once = spark.range(1).select(T.review_family(F.col("id").cast("string"), F.lit("x")).alias("f"))._jdf.queryExecution().optimizedPlan().toString()
    assert once.count("cast(id") + once.count("toprettystring(id") <= 1  # named once, so cleaned once a document


def test_standardised_counts_texts_once(spark):
    docs = text_stats(spark.createDataFrame(list(enumerate(texts(20))), "i long, text string"))
    plan = standardised(docs, ["i"])._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan.lower()  # the second reading is of the numbers
