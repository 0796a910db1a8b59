"""Tables with the cases that every operator must stand."""

import random
import string

from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"

#: Names that operators use inside; as further columns they must not disturb.
CLASHES = ("size", "kept", "component_id", "component", "slot", "shard", "row", "rid", "key", "bucket", "taken", "doc", "node", "path", "hash", "n_hit", "bad_id", "kept_id", "__i", "__s", "labelled", "good", "record", "first", "at", "s", "d1", "spans")


def words(rng, n, vocabulary=400):
    return [f"w{int(rng.paretovariate(0.7)) % vocabulary}x" if rng.random() < 0.6 else "".join(rng.choices(string.ascii_letters, k=rng.randint(2, 9))) for _ in range(n)]


def prose(rng, n):
    out = []
    for i, w in enumerate(words(rng, n)):
        out.append(w)
        out.append("\n" if i % 11 == 10 else " ")
    return "".join(out).strip()


def rows(seed=3, n=120):
    """Mixed texts: copies, near copies, nulls, blanks, odd characters, one long text, repeated rows."""
    rng = random.Random(seed)
    texts = [prose(rng, rng.choice((3, 8, 30, 80, 200))) for _ in range(n)]
    for i in range(0, n, 5):  # copies with one word changed, and exact ones
        base = texts[i].split(" ")
        base[rng.randrange(len(base))] = "changed"
        texts.append(" ".join(base))
        texts.append(texts[i] if i % 2 else texts[i].upper())
    texts += [None, "", " ", "\n\t\n", "one", "one two", "ONE TWO", "éè \U0001f600 straße İ   x", "a" * 5000, "same words " * 400, prose(rng, 20000)]
    out = [(i * 7 + 1, t, "en", ("a", "b", "c", None)[min(3, rng.randrange(9) // 2)], len(t or "")) for i, t in enumerate(texts)]
    out += [out[4], out[4], (None, texts[2], "en", "b", 1), (None, None, None, None, None)]
    rng.shuffle(out)
    return out


def table(spark, data, extra=True):
    df = spark.createDataFrame(data, SCHEMA)
    if extra:
        df = df.select("*", *[F.lit(-5).alias(c) for c in CLASHES])
    return df


def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def plain(df):
    """Rows as tuples, in an order of their own."""
    return sorted((tuple(r) for r in df.collect()), key=repr)
