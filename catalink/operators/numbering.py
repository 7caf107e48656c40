"""Row numbers over all rows or per group without gathering rows in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from catalink.sources.tables import staged


def ranked(df: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """``df`` with ``name``: the row's number from 1 within ``by``, in ``order``.

    Rows are range-partitioned, numbered inside each partition, and shifted by
    the counts of the partitions before, so a group of any size is spread.
    ``by`` may be empty: then all rows are numbered. ``order`` must be total.
    """
    keys = [*by, *order]
    spread = staged(df.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id()), "ranged")
    here = F.row_number().over(Window.partitionBy("_part", *by).orderBy(*order))
    counts = spread.groupBy("_part", *by).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    shift = counts.withColumn("_before", F.coalesce(before, F.lit(0))).drop("_n")
    on = [F.col("l._part") == F.col("s._part"), *(F.col(f"l.{c}").eqNullSafe(F.col(f"s.{c}")) for c in by)]
    rows = spread.withColumn("_here", here).alias("l").join(shift.alias("s"), on)
    return rows.select(*(F.col(f"l.{c}") for c in df.columns), (F.col("l._here") + F.col("s._before")).cast("long").alias(name))


def numbered(df: DataFrame, order: list[str], name: str = "id", start: int = 0) -> DataFrame:
    """``df`` with a key from ``start + 1`` on, in ``order``."""
    return ranked(df, [], order, name).withColumn(name, F.col(name) + start)
