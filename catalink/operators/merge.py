"""The merged tables: articles, journals, authors, organisations, links, log."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalink.functions.text import article_type, parse_year
from catalink.operators import authors as people
from catalink.operators.canonical import SENTINEL, journals, nested_set, organisations
from catalink.operators.nested import flatten_authors
from catalink.operators.numbering import numbered
from catalink.sources.tables import staged


def with_sentinel(df: DataFrame, name: str = "name", key: str = "id") -> DataFrame:
    """``df`` with the row "Uncategorized" in front; its key is 1 below the others'."""
    spark = df.sparkSession
    first = spark.range(1).select(*(F.lit(1).cast(t).alias(c) if c == key else F.lit(SENTINEL).alias(c) if c == name else F.lit(None).cast(t).alias(c) for c, t in df.dtypes))
    return first.unionByName(df)


def articles(right: DataFrame, left_new: DataFrame, links: DataFrame) -> DataFrame:
    """Merged articles: all right records, then the new left ones, numbered so.

    ``right`` and ``left_new`` are on the common schema; ``links`` has
    (``left_id``, ``right_id``): the right record is marked as in both, the
    largest left id stays.
    """
    both = right.withColumn("_src", F.lit(0)).unionByName(left_new.withColumn("_src", F.lit(1)))
    rows = numbered(both, ["_src", "original_id"])
    last = links.groupBy("right_id").agg(F.max("left_id").alias("_left"))
    rows = rows.join(last, (F.col("original_id") == F.col("right_id")) & (F.col("_src") == 0), "left")
    flag = lambda c: c.cast("int")
    return rows.select(
        "id", "title", "author", "volume", "number", parse_year(F.col("year")).cast("string").alias("year"), "uri", "abstract", F.lit(1).alias("usable"), "reference",
        F.lit("en").alias("language"), F.lit(1).alias("is_reviewed"), "keyword", "doi", article_type(F.col("type")).alias("document_type"),
        flag(F.col("_src") == 0).alias("is_scopus"), flag((F.col("_src") == 1) | F.col("_left").isNotNull()).alias("is_isi"), F.lit(0).alias("is_vci"), F.lit(1).alias("is_international"), F.lit("").alias("slug"),
        F.when(F.col("_src") == 0, F.col("original_id")).alias("raw_scopus_id"), F.when(F.col("_src") == 1, F.col("original_id")).otherwise(F.col("_left")).alias("raw_isi_id"), "journal", "issn",
    )


def journal_table(merged: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Journals (the sentinel first) and (``article_id``, ``journal_id``)."""
    named = merged.select(F.col("id").alias("position"), F.col("journal").alias("name"), "issn", "is_scopus", "is_isi")
    found = staged(journals(named), "journals")
    created = numbered(found.where("created").select(F.col("leader_name").alias("name"), F.col("leader_issn").alias("issn")).join(named.groupBy("name", "issn").agg(F.min("position").alias("_at")).withColumnRenamed("issn", "_issn").withColumnRenamed("name", "_name"), (F.col("name") == F.col("_name")) & F.col("issn").eqNullSafe(F.col("_issn"))).select("name", "issn", "_at"), ["_at"], "id", 1)
    created = staged(created.select("id", "name", "issn"), "created")
    lead = found.join(created.select(F.col("id").alias("journal_id"), F.col("name").alias("_n"), F.col("issn").alias("_i")), (F.col("leader_name") == F.col("_n")) & F.col("leader_issn").eqNullSafe(F.col("_i"))).select(F.col("name").alias("_name"), F.col("issn").alias("_issn"), "journal_id")
    of = named.join(lead, (F.col("name") == F.col("_name")) & F.col("issn").eqNullSafe(F.col("_issn")), "left").select(F.col("position").alias("article_id"), F.coalesce("journal_id", F.lit(1)).alias("journal_id"), "is_scopus", "is_isi")
    flags = of.groupBy(F.col("journal_id").alias("id")).agg(F.max("is_scopus").alias("is_scopus"), F.max("is_isi").alias("is_isi"))
    full = with_sentinel(created).join(flags, "id", "left").select("id", "name", "issn", *(F.coalesce(c, F.lit(0)).alias(c) for c in ("is_scopus", "is_isi")), F.lit(0).alias("is_vci"), F.lit(1).alias("is_international"))
    return full, of.select("article_id", "journal_id")


def people_tables(documents: DataFrame) -> dict[str, DataFrame]:
    """authors, articles_authors, organizes and authors_organizes.

    ``documents`` has ``id`` (of the article) and ``authors_json``. Authors get a
    row per article; organisations are found or created by name.
    """
    rows = numbered(people.authors(documents.withColumn("author", F.lit(None).cast("string")), True), ["id", "author_pos"], "author_id")
    rows = staged(rows, "authors")
    held = staged(people.author_organisations(documents), "held")
    first = held.groupBy("name").agg(F.min("id").alias("position"))
    ordered = numbered(first, ["position", "name"], "_turn").select("name", F.col("_turn").alias("position"))
    ordered = staged(ordered, "turns")
    found = staged(organisations(ordered), "organisations")
    created = numbered(found.where("created").select(F.col("leader_name").alias("name")).join(ordered, "name"), ["position"], "id", 1).select("id", "name")
    created = staged(created, "created")
    table_ = nested_set(with_sentinel(created)).select("id", "name", "_lft", "_rgt")
    lead = found.join(created.select(F.col("id").alias("organize_id"), F.col("name").alias("leader_name")), "leader_name").select("name", "organize_id")
    links = held.join(rows.select("id", "author_pos", "author_id"), ["id", "author_pos"]).join(lead, "name", "left").select("author_id", F.coalesce("organize_id", F.lit(1)).alias("organize_id")).distinct()
    return {"authors": rows.select(F.col("author_id").alias("id"), "name"), "articles_authors": rows.select("author_id", F.col("id").alias("article_id")), "organizes": table_, "authors_organizes": links}


def link_tables(documents: DataFrame) -> dict[str, DataFrame]:
    """authors, articles_authors, organizes and authors_organizes, organisations by their plain names.

    ``documents`` has ``id`` (of the article) and ``authors_json``.
    """
    flat = staged(flatten_authors(documents, "id", "authors_json").where("unit_pos = 0"), "flat")
    rows = staged(numbered(flat.where("org_pos = 0").select("id", "author_pos", F.col("label").alias("name")), ["id", "author_pos"], "author_id"), "authors")
    held = flat.where("org_pos > 0").select("id", "author_pos", F.col("label").alias("name")).distinct()
    names = staged(numbered(held.select("name").distinct(), ["name"]), "organizes")
    links = held.join(rows.select("id", "author_pos", "author_id"), ["id", "author_pos"]).join(names.withColumnRenamed("id", "organize_id"), "name").select("author_id", "organize_id").distinct()
    return {"authors": rows.select(F.col("author_id").alias("id"), "name"), "articles_authors": rows.select("author_id", F.col("id").alias("article_id")), "organizes": names, "authors_organizes": links}


def merge_log(found: DataFrame, merged: DataFrame) -> DataFrame:
    """Log rows of matches (``left_id``, ``right_id``, ``match_type``, scores):
    the target is the merged id; unknown scores stay null, scores become floats."""
    target = merged.where("raw_scopus_id is not null").select(F.col("raw_scopus_id").alias("right_id"), F.col("id").alias("target"))
    sure = F.col("match_type") == "DUPLICATED"
    return found.join(target, "right_id").select(
        F.col("left_id").alias("isi_id"), F.when(sure, F.col("target")).alias("duplication_of"), F.when(~sure, F.col("target")).alias("possible_duplication_of"), F.col("title_score").cast("float").alias("title_score"), F.col("journal_score").cast("float").alias("journal_score"), sure.alias("is_merged")
    )


def given_links(left: DataFrame, right: DataFrame) -> DataFrame:
    """``left_id``, ``right_id``: the links recorded in the left catalogue that
    name a record of the right one."""
    number = F.trim("raw_scopus_id")
    named = left.where(number.rlike("^[0-9]{1,18}$")).select(F.col("id").alias("left_id"), number.cast("long").alias("right_id"))
    return named.join(right.select(F.col("id").alias("right_id")), "right_id").select("left_id", "right_id")
