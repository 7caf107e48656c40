"""Unique slugs."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalink.functions.text import slug_base, slug_needed
from catalink.operators.numbering import ranked
from catalink.sources.tables import staged

MOST = 255


def with_suffix(base: str, n: int) -> str:
    """``base-n``, the base cut so that 255 characters are not exceeded."""
    tail = f"-{n}"
    return base[: MOST - len(tail)] + tail


def _in_turn(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Slugs of rows that come sorted by root and turn; per root the memory holds
    one counter per base and the slugs that stand outside the counters."""
    root, counters, taken = None, {}, set()
    for b in batches:
        out = []
        for r, key, base, given in zip(b["root"], b["key"], b["base"], b["given"]):
            if r != root:
                root, counters, taken = r, {}, set()
            if given is not None:
                taken.add(given)
                continue
            slug, n = base, counters.get(base, 0)
            if n or slug in taken:
                n = max(n, 1)
                while (slug := with_suffix(base, n)) in taken:
                    n += 1
            counters[base] = n + 1
            taken.add(slug)
            out.append((key, slug))
        yield pd.DataFrame(out, columns=["key", "slug"])


def slugs(df: DataFrame, key: str, text: str, slug: str = "slug") -> DataFrame:
    """``key``, ``slug`` of every row: kept if there is one, else made of ``text``.

    All existing slugs are reserved first; rows get theirs in the order of
    ``key``, with -1, -2, ... if the plain one is taken. A slug can only meet
    slugs of its root (itself without trailing numbers); where a root has one
    base and no reserved slug the numbers are ranks, the other roots are worked
    through in order. Keys must be unique.
    """
    rows = df.select(F.col(key).alias("key"), F.when(~slug_needed(F.col(slug)), F.col(slug)).alias("given"), slug_base(F.col(text)).alias("base"))
    root = F.substring(F.regexp_replace(F.coalesce("given", "base"), "(?:-[0-9]+)+$", ""), 1, 200)
    rows = staged(rows.withColumn("root", root), "slugs")
    kept = rows.where("given is not null").select("key", F.col("given").alias("slug"))
    kinds = rows.groupBy("root").agg(F.max(F.when(F.col("given").isNotNull(), 1).otherwise(0)).alias("reserved"), F.min(F.when(F.col("given").isNull(), F.col("base"))).alias("b1"), F.max(F.when(F.col("given").isNull(), F.col("base"))).alias("b2"))
    mixed = kinds.where("b1 is not null and (reserved = 1 or b1 <> b2)").select("root")
    plain = rows.where("given is null").join(mixed, "root", "left_anti")
    n = F.col("_n") - 1
    tail = F.concat(F.lit("-"), n.cast("string"))
    made = ranked(plain.select("key", "base"), ["base"], ["key"], "_n").select("key", F.when(n == 0, F.col("base")).otherwise(F.concat(F.substring(F.col("base"), F.lit(1), MOST - F.length(tail)), tail)).alias("slug"))
    turns = rows.join(mixed, "root").withColumn("turn", F.when(F.col("given").isNotNull(), 0).otherwise(1))
    kind = dict(rows.dtypes)["key"]
    worked = turns.repartition("root").sortWithinPartitions("root", "turn", "key").select("root", "key", "base", "given").mapInPandas(_in_turn, f"key {kind}, slug string")
    return kept.unionByName(made).unionByName(worked).withColumnRenamed("key", key)
