"""Queries of the general training-data operators: packed fields, nested records."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from catalink.operators.nested import flatten_authors, related_tables
from catalink.operators.packed import LAYOUTS, unpack_fields
from catalink.plans import sql
from catalink.sources.tables import one_per_key, staged, table


def p1_found(spark: SparkSession, base: str) -> DataFrame:
    """Every value of the packed fields of isi_documents."""
    rows = table(spark, base, "isi_documents", "id", "crawled_at", *LAYOUTS)
    rows = staged(one_per_key(rows, "id", "crawled_at").drop("crawled_at"), "packed")
    return unpack_fields(rows, "id", LAYOUTS).withColumnRenamed("id", "isi_id")


def p6_found(spark: SparkSession, base: str) -> DataFrame:
    """Authors, organisations and units of isi_documents.authors_json."""
    rows = one_per_key(table(spark, base, "isi_documents", "id", "crawled_at", "authors_json"), "id", "crawled_at")
    return flatten_authors(rows, "id", "authors_json").withColumnRenamed("id", "isi_id")


def _level(name: str):
    def query(spark: SparkSession, base: str) -> DataFrame:
        rows = one_per_key(table(spark, base, "isi_documents", "id", "crawled_at", "authors_json"), "id", "crawled_at")
        return related_tables(rows, "id", "authors_json")[name].withColumnRenamed("id", "isi_id")

    return query


def queries() -> dict:
    return {"p1_found": p1_found, "p6_found": p6_found, **{f"p6_{name}": _level(name) for name in ("authors", "organisations", "units")}}


def oracle_sql() -> dict[str, str]:
    flat = f"({sql.nested()})"
    return {
        "p1_found": sql.packed(), "p6_found": sql.nested(),
        "p6_authors": f"select isi_id, author_pos, label from {flat} where org_pos = 0",
        "p6_organisations": f"select isi_id, author_pos, org_pos, label from {flat} where org_pos > 0 and unit_pos = 0",
        "p6_units": f"select isi_id, author_pos, org_pos, unit_pos, label from {flat} where unit_pos > 0",
    }
