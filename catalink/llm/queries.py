"""Queries of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalink.llm import sql
from catalink.llm.canonical_names import match_names
from catalink.llm.components import components, encoded
from catalink.llm.leakage import leaks, matches
from catalink.llm.linking import link, members as linked_members, records
from catalink.llm.mixing import mixed, shares, token_lengths
from catalink.llm.name_variants import organisation_entities, person_entities, person_links, scored_pairs, variant_pairs
from catalink.llm.spans import coverage, links as span_links, members as span_members, shared_pairs
from catalink.llm.survivors import FIELDS, bare_doi, long_rows, source_trust, survivors, wide
from catalink.operators.packed import LAYOUTS, unpack
from catalink.sources.tables import broadcast_if_small, staged, table


def p2_found(spark: SparkSession, base: str) -> DataFrame:
    """The canonical journal of every typed name, 0 where it is not on the list."""
    isi = table(spark, base, "isi_documents", "id", "journal").select(F.lit("isi_documents").alias("table_name"), F.col("id").alias("record_id"), F.col("journal").alias("name"))
    journals = table(spark, base, "journals", "id", "name").select(F.lit("journals").alias("table_name"), F.col("id").alias("record_id"), "name")
    typed = staged(isi.unionByName(journals).where(F.trim("name") != "").distinct(), "typed")
    found = match_names(typed, table(spark, base, "journal_reference", "ref_id", "canonical_name"))
    return typed.join(staged(found, "names"), "name").select("table_name", "record_id", "ref_id")


def _survivors(spark: SparkSession, base: str, first: str) -> DataFrame:
    articles = table(spark, base, "articles", "doi", "raw_isi_id")
    groups = articles.select(bare_doi(F.col("doi")).alias("group_key"), F.col("raw_isi_id").alias("record"))
    records = table(spark, base, "isi_documents", "id", "crawled_at", "title", "author", "doi", "publisher", *(f.name for f in FIELDS))
    trust = F.lit(1.0)
    if first == "votes":
        rated = broadcast_if_small(source_trust(records, "publisher", bare_doi(F.col("doi")).isNotNull()))
        records, trust = records.join(rated, records["publisher"].eqNullSafe(rated["source"]), "left"), F.coalesce("trust", F.lit(0.5))
    rows = long_rows(records, "id", "crawled_at", trust, FIELDS)
    return survivors(groups, rows, records.select(F.col("id").alias("record"), "title", "author"), first)


def p3_found(spark: SparkSession, base: str) -> DataFrame:
    """For each DOI and field the isi record whose value should survive."""
    return _survivors(spark, base, "fullness").select(F.col("group_key").alias("doi"), "field_name", F.col("record").alias("isi_id"))


def p3_votes(spark: SparkSession, base: str) -> DataFrame:
    """The same by votes alone: what trusted and recent records agree on, one row per DOI."""
    return wide(_survivors(spark, base, "votes")).withColumnRenamed("group_key", "doi")


def links(spark: SparkSession, base: str) -> DataFrame:
    """The recorded links as edges of one number space: isi 0, article 1, scopus 2."""
    number = lambda c: F.when(F.trim(c).rlike("^[+-]?[0-9]{1,18}$"), F.trim(c).cast("long"))
    isi = table(spark, base, "isi_documents", "id", "raw_scopus_id")
    logs = table(spark, base, "merge_logs", "isi_id", "duplication_of")
    articles = table(spark, base, "articles", "id", "raw_scopus_id", "raw_isi_id")
    given = isi.select(encoded(0, F.col("id")).alias("src"), encoded(2, number(F.col("raw_scopus_id"))).alias("dst"))
    logged = logs.select(encoded(0, F.col("isi_id")).alias("src"), encoded(1, F.col("duplication_of")).alias("dst"))
    from_scopus = articles.select(encoded(2, F.col("raw_scopus_id")).alias("src"), encoded(1, F.col("id")).alias("dst"))
    from_isi = articles.select(encoded(0, F.col("raw_isi_id")).alias("src"), encoded(1, F.col("id")).alias("dst"))
    return given.unionByName(logged).unionByName(from_scopus).unionByName(from_isi)


def p4_found(spark: SparkSession, base: str) -> DataFrame:
    """The group of every isi record that is linked to another one."""
    isi = components(links(spark, base), "src", "dst").where(F.col("node") < F.lit(1 << 60))
    # the smallest node of a group with isi records is one of them
    others = isi.where("node <> component")
    tops = others.select(F.col("component").alias("node"), "component").distinct()
    return others.unionByName(tops).select(F.col("node").alias("isi_id"), F.col("component").alias("group_id"))


def _persons(spark: SparkSession, base: str) -> DataFrame:
    authors = unpack(table(spark, base, "isi_documents", "id", "author"), "id", "author", LAYOUTS["author"])
    return authors.select(F.col("item_value").alias("name"))


def _organisations(spark: SparkSession, base: str) -> DataFrame:
    isi = table(spark, base, "isi_documents", "affiliation").select(F.col("affiliation").alias("name"))
    return isi.unionByName(table(spark, base, "organizes", "name")).where(F.trim("name") != "")


def p5_found(spark: SparkSession, base: str) -> DataFrame:
    """Pairs of spellings of one person or organisation."""
    found = variant_pairs(person_entities(_persons(spark, base))).select(F.lit("person").alias("kind"), "name_a", "name_b")
    return found.unionByName(variant_pairs(organisation_entities(_organisations(spark, base))).select(F.lit("organisation").alias("kind"), "name_a", "name_b"))


def p5_scored(spark: SparkSession, base: str) -> DataFrame:
    """The pairs of persons with the rarity of what links them, ambiguous ones too."""
    return scored_pairs(person_links(_persons(spark, base)))


def p5_members(spark: SparkSession, base: str) -> DataFrame:
    """Of every spelling the person or organisation it means: one row per spelling."""
    people = person_entities(_persons(spark, base)).select(F.lit("person").alias("kind"), "name", "entity")
    return people.unionByName(organisation_entities(_organisations(spark, base)).select(F.lit("organisation").alias("kind"), "name", "entity"))


def _publications(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    isi = table(spark, base, "isi_documents", "id", "title", "journal", "year", "doi", "author", "volume", "number", "pages")
    scopus = table(spark, base, "scopus_documents", "id", "title", "source_title", "year", "doi", "authors", "volume", "issue", "page_start")
    left = records(isi, key="id", title="title", journal="journal", year="year", doi="doi", authors="author", volume="volume", issue="number", page="pages")
    right = records(scopus, key="id", title="title", journal="source_title", year="year", doi="doi", authors="authors", volume="volume", issue="issue", page="page_start")
    return left, right


def p7_matches(spark: SparkSession, base: str) -> DataFrame:
    """Pairs of records of the same publication with a confidence."""
    return link(*_publications(spark, base)).select(F.col("l").alias("isi_id"), F.col("r").alias("scopus_id"), "confidence")


def p7_members(spark: SparkSession, base: str) -> DataFrame:
    """Of every linked record the publication it belongs to."""
    return linked_members(*_publications(spark, base))


def p7_found(spark: SparkSession, base: str) -> DataFrame:
    """Pairs of records of the same publication."""
    return p7_matches(spark, base).select("isi_id", "scopus_id")


def p8_found(spark: SparkSession, base: str) -> DataFrame:
    """Documents that leak evaluation items."""
    return leaks(table(spark, base, "documents", "doc_id", "text"), table(spark, base, "eval_items", "item_id", "item_text"))


def p8_matches(spark: SparkSession, base: str) -> DataFrame:
    """The same with the kind of match: an exact phrase, or nearly so."""
    return matches(table(spark, base, "documents", "doc_id", "text"), table(spark, base, "eval_items", "item_id", "item_text"))


def p9_mix(spark: SparkSession, base: str) -> DataFrame:
    """The documents of the mix and how often each is used."""
    lengths = token_lengths(table(spark, base, "documents", "doc_id", "source", "text"))
    return mixed(lengths, table(spark, base, "mix_targets", "source", "target_share", "max_repeats"))


def p9_shares(spark: SparkSession, base: str) -> DataFrame:
    """The shares of the sources that the mix actually reaches."""
    return shares(p9_mix(spark, base), table(spark, base, "mix_targets", "source", "target_share", "max_repeats"))


def p10_found(spark: SparkSession, base: str) -> DataFrame:
    """Pairs of documents that share a span of 300 characters."""
    return shared_pairs(table(spark, base, "documents", "doc_id", "text"))


def p10_links(spark: SparkSession, base: str) -> DataFrame:
    """The same between different texts, without the pairs of a passage of many."""
    return span_links(table(spark, base, "documents", "doc_id", "text"))[1]


def p10_members(spark: SparkSession, base: str) -> DataFrame:
    """Of every document its text and the class of texts it shares spans with."""
    return span_members(table(spark, base, "documents", "doc_id", "text"))


def p10_coverage(spark: SparkSession, base: str) -> DataFrame:
    """How much of each document is shared elsewhere."""
    return coverage(table(spark, base, "documents", "doc_id", "text"))


def queries() -> dict:
    return {f.__name__: f for f in (p2_found, p3_found, p3_votes, p4_found, p5_found, p5_scored, p5_members, p7_found, p7_matches, p7_members, p8_found, p8_matches, p9_mix, p9_shares, p10_found, p10_links, p10_members, p10_coverage)}


def oracle_sql() -> dict[str, str]:
    return sql.oracle_sql()
