"""SimHash of token lists, in the JVM.

A bit is set if more than half of the tokens' hashes have it.  Several bits are
counted at once, as lanes of one long: ``h >> k`` masked to one bit in each lane.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def simhash_tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit("[a-z0-9]+"), F.lit(0))


def token_hash(token: Column) -> Column:
    """The first 8 bytes of the MD5, big-endian, as a bit pattern."""
    digest = F.md5(token.cast("binary"))
    half = lambda i: F.conv(F.substring(digest, i, 8), 16, 10).cast("long")
    return F.shiftleft(half(1), 32).bitwiseOR(half(9))


def simhash64(df: DataFrame, text: Column, keys: list[str], name: str = "simhash64", most_tokens: int | None = None) -> DataFrame:
    """``keys`` (which tell rows apart) and the SimHash of ``text``: 0 without tokens.

    The counts are aggregated before they are shuffled: one row of them a text.
    ``most_tokens``: a bound on a text's tokens; below 65,536 four bits share a sum.
    """
    lanes = 4 if most_tokens is not None and most_tokens < 65_536 else 2
    width = 64 // lanes
    mask = sum(1 << (width * i) for i in range(lanes))
    exploded = df.select(*keys, F.explode_outer(simhash_tokens(text)).alias("token"))
    hashed = exploded.select(*keys, token_hash(F.col("token")).alias("h"))
    sums = [F.sum(F.shiftrightunsigned("h", k).bitwiseAND(F.lit(mask))).alias(f"s{k}") for k in range(width)]
    counted = hashed.groupBy(*keys).agg(F.count("h").alias("n"), *sums)
    ones = lambda bit: F.shiftrightunsigned(F.col(f"s{bit % width}"), width * (bit // width)).bitwiseAND(F.lit((1 << width) - 1))
    bits = [F.when(2 * ones(b) > F.col("n"), F.shiftleft(F.lit(1).cast("long"), b)).otherwise(F.lit(0).cast("long")) for b in range(64)]
    return counted.select(*keys, reduce(lambda a, b: a.bitwiseOR(b), bits).alias(name))


def hamming(a: Column, b: Column) -> Column:
    return F.bit_count(a.bitwiseXOR(b))
