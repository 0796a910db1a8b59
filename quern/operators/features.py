"""Numeric features of documents, standardised; means by cluster."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import number
from quern.operators.manifest import COUNTS
from quern.store import materialize

#: Sizes and counts, whose logarithm is taken; not the ratios, nor the mean length of lines.
LOGGED = tuple(c for c in COUNTS if not c.endswith("_ratio") and c != "avg_line_len")


def scaled(column: str) -> Column:
    x = number(F.col(column))
    return F.log1p(F.greatest(x, F.lit(0.0))) if column in LOGGED else x


def standardised(df: DataFrame, keys: list[str], features: tuple[str, ...] = COUNTS) -> DataFrame:
    """``keys`` and the features with mean 0 and population deviation 1 (a constant becomes 0).

    Two numbers a feature come to the driver; the rest is a projection.  What is
    read twice, the numbers, is written before: else all texts are counted twice.
    """
    have = [c for c in features if c in df.columns]
    raw = df.select(*keys, *[(scaled(c) if c in have else F.lit(0.0)).alias(c) for c in features])
    raw = materialize(raw, "features")
    found = raw.agg(*[F.avg(c).alias(f"m_{c}") for c in features], *[F.stddev_pop(c).alias(f"s_{c}") for c in features]).first().asDict()
    return raw.select(*keys, *[((F.col(c) - F.lit(found[f"m_{c}"] or 0.0)) / F.lit(found[f"s_{c}"] or 1.0)).alias(c) for c in features])


def cluster_means(df: DataFrame, cluster: str, features: tuple[str, ...] = COUNTS) -> DataFrame:
    return df.groupBy(cluster).agg(F.count("*").alias("n_docs"), *[F.avg(number(F.col(c))).alias(c) for c in features])
