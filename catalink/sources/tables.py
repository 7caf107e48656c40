"""Readers of the parquet tables, and the shared folder for cut lineage."""

from __future__ import annotations

import os
import tempfile
import uuid

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, base: str, name: str, *columns: str) -> DataFrame:
    """Table ``name`` under ``base``; only ``columns`` reach the scan if given."""
    df = spark.read.parquet(os.path.join(base, f"{name}.parquet"))
    return df.select(*columns) if columns else df


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir`` of the session.

    Where it is unset a temporary folder is made, which is right only on a
    local master; on a cluster an unset folder is an error.
    """
    context = spark.sparkContext
    found = context.getConf().get("spark.checkpoint.dir", None) or spark.conf.get("catalink.shared.dir", None)
    if not found:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        found = tempfile.mkdtemp(prefix="catalink-")
        spark.conf.set("catalink.shared.dir", found)
    return found


def staged(df: DataFrame, label: str = "stage") -> DataFrame:
    """``df`` written once as parquet into the shared folder and read back.

    This cuts the lineage, survives lost executors, keeps the columnar format
    and gives the optimizer true sizes for the joins that follow.
    """
    scope = df.sparkSession.conf.get("catalink.staging.scope", "all")
    path = f"{shared_dir(df.sparkSession)}/catalink/{scope}/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_bytes(df: DataFrame) -> int:
    """Bytes of the files that a staged ``df`` is read from."""
    total = 0
    for name in df.inputFiles():
        path = df.sparkSession._jvm.org.apache.hadoop.fs.Path(name)
        total += path.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).getFileStatus(path).getLen()
    return total


def broadcast_if_small(df: DataFrame, max_rows: int = 500_000, max_bytes: int = 8 << 20) -> DataFrame:
    """``df`` staged, and marked for broadcast only if it has at most ``max_rows``
    and its compressed files at most ``max_bytes``.

    Beyond that the join is left to the planner, which then shuffles; the
    result is the same. A lookup has different keys, which take two bytes a row or
    more, so the rows of a small file need not be counted.
    """
    kept = staged(df, "lookup")
    size = stored_bytes(kept)
    return F.broadcast(kept) if size <= max_bytes and (size <= 2 * max_rows or kept.count() <= max_rows) else kept


def one_per_key(df: DataFrame, key: str, *order: str) -> DataFrame:
    """One row per ``key``: the last by ``order``, ties by the rows' content.

    Rows with a null key are dropped, as they name no record. Each row is
    ranked inside its key after one shuffle, and moves once.
    """
    rest = [F.col(c).desc_nulls_last() for c in (*order, *(c for c in df.columns if c != key and c not in order))]
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*rest))
    return df.where(F.col(key).isNotNull()).withColumn("_rank", rank).where("_rank = 1").drop("_rank")


@contextmanager
def staging_scope(spark: SparkSession) -> Iterator[None]:
    """What is staged inside is deleted at the end: results must be written by then."""
    before, scope = spark.conf.get("catalink.staging.scope", "all"), uuid.uuid4().hex
    spark.conf.set("catalink.staging.scope", scope)
    try:
        yield
    finally:
        spark.conf.set("catalink.staging.scope", before)
        clear_staged(spark, scope)


def clear_staged(spark: SparkSession, scope: str = "") -> None:
    """Deletes what ``staged`` wrote, or what it wrote in one scope; results that
    still read it break."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/catalink/{scope}".rstrip("/"))
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)
