"""The two input catalogues: readers, the common schema, gaps, JDBC, sinks."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from catalink.functions.text import correct_country, normalize_issn, pages
from catalink.sources.tables import one_per_key, table

#: Common field, column of the left catalogue, of the right one.
COMMON = {
    "original_id": ("id", "id"), "affiliation": ("affiliation", "affiliations"), "author": ("author", "authors"), "doi": ("doi", "doi"), "funding_text": ("funding_text", "funding_text"), "isbn": ("isbn", "isbn"),
    "issn": ("issn", "issn"), "journal": ("journal", "source_title"), "journal_iso": ("journal_iso", "abbreviated_source_title"), "language": ("language", "language_of_original_document"), "pages": ("pages", None),
    "publisher": ("publisher", "publisher"), "title": ("title", "title"), "type": ("type", "document_type"), "volume": ("volume", "volume"), "year": ("year", "year"), "authors_json": ("authors_json", "authors_json"),
    "uri": ("unique_id", "link"), "abstract": ("abstract", "abstract"), "reference": ("cited_references", "references_text"), "number": ("number", "issue"), "keyword": ("keyword", "index_keywords"),
}


def _changed(field: str, x: Column) -> Column:
    if field in ("affiliation", "authors_json"):
        return correct_country(x)
    if field == "issn":
        return normalize_issn(x)
    if field == "title":
        return F.regexp_replace(x, "\\R", " ")
    return x


def common_schema(df: DataFrame, left: bool) -> DataFrame:
    """One catalogue on the common schema, with flags for its origin."""
    columns = []
    for field, names in COMMON.items():
        name = names[0] if left else names[1]
        x = pages(F.col("page_start"), F.col("page_end")) if name is None else F.col(name)
        columns.append(_changed(field, x).alias(field))
    return df.select(*columns, F.lit(not left).alias("is_scopus"), F.lit(left).alias("is_isi"))


def left_catalogue(spark: SparkSession, base: str) -> DataFrame:
    """isi_documents, each id once."""
    return one_per_key(table(spark, base, "isi_documents"), "id", "crawled_at")


def right_catalogue(spark: SparkSession, base: str) -> DataFrame:
    """scopus_documents, each id once."""
    return one_per_key(table(spark, base, "scopus_documents"), "id", "crawled_at")


def unified(spark: SparkSession, base: str) -> DataFrame:
    """Both catalogues as one table on the common schema."""
    return common_schema(left_catalogue(spark, base), True).unionByName(common_schema(right_catalogue(spark, base), False))


def by_key(documents: DataFrame, key: int, left: bool) -> DataFrame:
    """The record of one catalogue with one id; both filters reach the scan."""
    return documents.where((F.col("original_id") == key) & F.col("is_isi" if left else "is_scopus"))


def linked(left: DataFrame) -> DataFrame:
    """Left records that carry a link (neither null nor empty)."""
    return left.where("raw_scopus_id <> ''")


def unlinked(left: DataFrame) -> DataFrame:
    """Left records with an empty link; null is neither linked nor unlinked."""
    return left.where("raw_scopus_id = ''")


def resume_from(df: DataFrame, key: str, start: int) -> DataFrame:
    """Records from id ``start`` on; an error if there are none but later ids."""
    top = df.agg(F.max(key)).first()[0]
    if top is not None and start > top:
        raise ValueError(f"{start} lies beyond the last id {top}")
    return df.where(F.col(key) >= start)


def missing_ids(df: DataFrame, key: str, buckets: int = 1_000_000) -> DataFrame:
    """``missing_id``: whole numbers from 0 up to the largest id that are no id.

    Ids are compared with their predecessor inside ranges of ids, and ranges by
    their ends, so no task orders all ids. A long gap is cut into pieces that
    are spread before they are written out.
    """
    piece = 100_000
    ids = df.select(F.col(key).cast("long").alias("k")).where("k >= 0").distinct()
    cut = F.floor(F.col("k") / buckets)
    before = F.lag("k").over(Window.partitionBy("bucket").orderBy("k"))
    inside = ids.withColumn("bucket", cut).withColumn("low", before).where("low is not null and k > low + 1").select((F.col("low") + 1).alias("a"), (F.col("k") - 1).alias("b"))
    ends = ids.groupBy(cut.alias("bucket")).agg(F.min("k").alias("first"), F.max("k").alias("last"))
    previous = F.coalesce(F.lag("last").over(Window.orderBy("bucket")), F.lit(-1))
    between = ends.withColumn("low", previous).where("first > low + 1").select((F.col("low") + 1).alias("a"), (F.col("first") - 1).alias("b"))
    gaps = inside.unionByName(between)
    pieces = gaps.select("a", "b", F.explode(F.sequence(F.floor(F.col("a") / piece), F.floor(F.col("b") / piece))).alias("p")).repartition("p")
    return pieces.select(F.explode(F.sequence(F.greatest("a", F.col("p") * piece), F.least("b", F.col("p") * piece + (piece - 1)))).alias("missing_id"))


def jdbc(spark: SparkSession, query: str, partition_column: str | None = None, bounds: tuple[int, int] | None = None, partitions: int = 32) -> DataFrame:
    """The result of ``query`` from a database, read in parallel by a key range.

    Address, user and password come from CATALINK_JDBC_URL, _USER, _PASSWORD.
    """
    reader = spark.read.format("jdbc").option("url", os.environ["CATALINK_JDBC_URL"]).option("user", os.environ.get("CATALINK_JDBC_USER", "")).option("password", os.environ.get("CATALINK_JDBC_PASSWORD", ""))
    if partition_column and bounds:
        split = {"dbtable": f"({query}) q", "partitionColumn": partition_column, "lowerBound": bounds[0], "upperBound": bounds[1], "numPartitions": partitions}
        return reader.options(**split).load()
    return reader.option("query", query).load()


def write_table(df: DataFrame, path: str, mode: str = "append") -> None:
    """Writes a table as parquet; the caller chooses to append or overwrite."""
    if mode not in ("append", "overwrite"):
        raise ValueError("mode is append or overwrite")
    df.write.mode(mode).parquet(path)
