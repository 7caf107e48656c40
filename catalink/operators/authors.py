"""Authors of records and their organisations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalink.functions.text import name_variants, org_suffix
from catalink.operators.nested import flatten_authors


def author_names(text: Column, left: bool) -> Column:
    """Author names from the plain text: parted by "and" (left) or commas (right)."""
    return F.filter(F.split(text, " and " if left else ", "), lambda x: x != "")


def authors(documents: DataFrame, left: bool, key: str = "id", json: str = "authors_json", plain: str = "author") -> DataFrame:
    """``key``, ``author_pos``, ``name``: from the JSON text, or else the plain one."""
    flat = flatten_authors(documents, key, json).where("org_pos = 0").select(key, "author_pos", F.col("label").alias("name"))
    without = documents.join(flat.select(key).distinct(), key, "left_anti")
    split = without.select(key, F.posexplode(author_names(F.col(plain), left)).alias("author_pos", "name"))
    return flat.unionByName(split.withColumn("author_pos", (F.col("author_pos") + 1).cast("int")))


def organisations(documents: DataFrame, key: str = "id", json: str = "authors_json") -> DataFrame:
    """``key``, ``name``: the distinct organisations of each record's authors."""
    return flatten_authors(documents, key, json).where("org_pos > 0 and unit_pos = 0").select(key, F.col("label").alias("name")).distinct()


def author_organisations(documents: DataFrame, key: str = "id", json: str = "authors_json") -> DataFrame:
    """``key``, ``author_pos``, ``name``: the links from authors to organisations."""
    return flatten_authors(documents, key, json).where("org_pos > 0 and unit_pos = 0").select(key, "author_pos", F.col("label").alias("name")).distinct()


def abbreviated(names: DataFrame, column: str) -> DataFrame:
    """``column``, ``variant``: each distinct name, as it is and abbreviated."""
    rows = names.select(column).where(F.trim(column) != "").distinct()
    return rows.select(column, F.explode(F.array_distinct(F.concat(F.array(column), F.coalesce(name_variants(F.col(column)), F.array().cast("array<string>"))))).alias("variant"))


def suffixes(names: DataFrame, column: str) -> DataFrame:
    """``suffix``: the distinct last words of organisation names."""
    return names.select(org_suffix(F.col(column)).alias("suffix")).where("suffix is not null").distinct()
