"""Gapless ranks over a whole table without gathering it in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.store import materialize


def prefix_sums(df: DataFrame, order: list[Column], value: Column, name: str) -> DataFrame:
    """``df`` with column ``name``: the sum of ``value`` over the rows before, in ``order``.

    ``order`` should be total.  Rows are range-partitioned and written with their
    partition's number; only one sum a partition is put in order by one task.
    """
    ranged = df.withColumn("__v", value.cast("long")).repartitionByRange(*order).withColumn("__part", F.spark_partition_id())
    ranged = materialize(ranged, "ranged")
    parts = ranged.groupBy("__part").agg(F.sum("__v").alias("__sum"))
    before = F.coalesce(F.sum("__sum").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select(F.col("__part").alias("__p"), before.alias("__before"))
    inside = F.coalesce(F.sum("__v").over(Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = ranged.withColumn("__in", inside).join(F.broadcast(parts), F.col("__part") == F.col("__p"))  # one row a partition
    return out.withColumn(name, F.col("__before") + F.col("__in")).drop("__v", "__part", "__p", "__before", "__in")


def ranks(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` with its rank from 0 in ``order``."""
    return prefix_sums(df, order, F.lit(1), name)
