"""Rows out of arrays, and values that are computed once."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def exploded(df: DataFrame, keep: list[str | Column], array: str | Column, name: str) -> DataFrame:
    """A row for each element that is not null.

    The outer form, filtered afterwards: for the inner one Spark infers a filter on
    the array's size and pushes it down to the scan, where the array's whole
    expression is computed again, within its own lambdas as often as they run.
    """
    return df.select(*keep, F.explode_outer(array).alias(name)).where(F.col(name).isNotNull())


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body names it, in lambdas too."""
    return F.element_at(F.transform(F.array(value), body), 1)
