"""Classification of candidate pairs and what follows for the left records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalink.functions.similarity import people_met, title_sim, token_lcs_sim
from catalink.functions.text import ascii_fold, is_doi, parse_year
from catalink.operators.blocking import candidates
from catalink.sources.tables import staged


@dataclass(frozen=True)
class Rules:
    """Thresholds of the classification and size of the candidate lists."""

    possible: float = 0.7
    same: float = 0.8
    journal: float = 0.85
    journal_enough: float = 0.8
    exact_title_over: int = 20
    top: int = 10
    continuous: bool = False
    use_identifiers: bool = False


def year_compatible(a: Column, b: Column) -> Column:
    """Equal years, or one of them unknown."""
    return a.isNull() | b.isNull() | (a == b)


def journal_score(name_a: Column, name_b: Column, short_a: Column, short_b: Column, rules: Rules = Rules()) -> Column:
    """The name's score if it is enough, else the abbreviation's, else the better."""
    full, short = token_lcs_sim(name_a, name_b), token_lcs_sim(short_a, short_b)
    return F.when(full >= rules.journal_enough, full).when(short >= rules.journal_enough, short).otherwise(F.greatest(full, short))


def classify(title_score: Column, journal: Column, left_title: Column, rules: Rules = Rules()) -> Column:
    """DUPLICATED, POSSIBLY, or null for no match."""
    sure = (title_score == 1.0) & (F.length(left_title) > rules.exact_title_over)
    by_journal = F.when(journal >= rules.journal, "DUPLICATED").otherwise("POSSIBLY")
    return F.when(sure, "DUPLICATED").when(title_score >= rules.same, by_journal).when(title_score >= rules.possible, "POSSIBLY")


def by_identifiers(doi_a: Column, doi_b: Column, issn_a: Column, issn_b: Column) -> Column:
    """Equal DOIs accept a pair (true), different ones reject it (false), as do
    different ISSNs; null where the identifiers do not decide."""
    dois = is_doi(doi_a) & is_doi(doi_b)
    return F.when(dois & (doi_a == doi_b), True).when(dois | (F.upper(issn_a) != F.upper(issn_b)), False)


def _bound(a: Column, b: Column) -> Column:
    """The most that the title score can be, by the lengths."""
    x, y = F.length(ascii_fold(a)), F.length(ascii_fold(b))
    return F.when(a == b, 1.0).otherwise(F.least(x, y) / F.greatest(x, y, F.lit(1)))


def matches(left: DataFrame, right: DataFrame, rules: Rules = Rules(), weighed: DataFrame | None = None) -> DataFrame:
    """All matches among the candidates: ``left_id``, ``right_id``, ``rank``,
    ``title_score``, ``journal_score``, ``match_type``.

    ``left`` and ``right`` are on the common schema. The journals are compared
    only where the titles make a match possible. Null titles match nothing.
    ``weighed``: the index of the right titles, if there is one already.
    """
    columns = ("original_id", "title", "year", "journal", "journal_iso", *(("doi", "issn") if rules.use_identifiers else ()))
    a = left.select(*(F.col(c).alias(f"a_{c}") for c in columns))
    b = right.select(*(F.col(c).alias(f"b_{c}") for c in columns))
    near = candidates(left, right, rules.top, lk="original_id", rk="original_id", weighed=weighed).select("left_id", "right_id", "rank")
    pairs = near.join(a, F.col("left_id") == F.col("a_original_id")).join(b, F.col("right_id") == F.col("b_original_id"))
    pairs = pairs.where(year_compatible(parse_year(F.col("a_year")), parse_year(F.col("b_year"))))
    pairs = pairs.withColumn("verdict", by_identifiers(F.col("a_doi"), F.col("b_doi"), F.col("a_issn"), F.col("b_issn")) if rules.use_identifiers else F.lit(None).cast("boolean"))
    pairs = pairs.where("verdict is null or verdict")
    pairs = pairs.where(F.col("verdict").isNotNull() | (_bound(F.col("a_title"), F.col("b_title")) >= rules.possible))
    titled = pairs.withColumn("title_score", title_sim(F.col("a_title"), F.col("b_title"))).where(F.col("verdict").isNotNull() | (F.col("title_score") >= rules.possible))
    titled = staged(titled, "titled")
    scored = titled.withColumn("journal_score", journal_score(F.col("a_journal"), F.col("b_journal"), F.col("a_journal_iso"), F.col("b_journal_iso"), rules))
    kind = F.when(F.col("verdict"), "DUPLICATED").otherwise(classify(F.col("title_score"), F.col("journal_score"), F.col("a_title"), rules))
    return scored.select("left_id", "right_id", "rank", F.round("title_score", 6).alias("title_score"), F.round("journal_score", 6).alias("journal_score"), kind.alias("match_type")).where("match_type is not null")


def logged(found: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """The matches up to the first DUPLICATED of each left record, in rank order."""
    if rules.continuous:
        return found
    first = F.min(F.when(F.col("match_type") == "DUPLICATED", F.col("rank"))).over(Window.partitionBy("left_id"))
    return found.withColumn("_first", first).where(F.col("_first").isNull() | (F.col("rank") <= F.col("_first"))).drop("_first")


def outcome(left: DataFrame, found: DataFrame) -> DataFrame:
    """``left_id``, ``linked_to`` (null: to be inserted), ``n_logged`` of every left record."""
    by = found.groupBy("left_id").agg(F.min_by("right_id", F.when(F.col("match_type") == "DUPLICATED", F.col("rank"))).alias("linked_to"), F.count("*").alias("n_logged"))
    return left.select(F.col("original_id").alias("left_id")).join(by, "left_id", "left").select("left_id", "linked_to", F.coalesce("n_logged", F.lit(0)).cast("long").alias("n_logged"))


def same_authors(a: Column, b: Column, least: float = 0.8) -> Column:
    """Whether more than ``least`` of the shorter of two author lists are met: names
    of ``b`` that are the same person's as one of ``a``; sizes are those of the whole lists."""
    n = F.least(F.size(a), F.size(b))
    return F.coalesce((n > 0) & (people_met(a, b) / F.greatest(n, F.lit(1)) > least), F.lit(False))


def link_comparison(given: DataFrame, found: DataFrame) -> DataFrame:
    """Two linkings (``left_id``, ``target``) compared: ``status`` only_given,
    only_found or different for every left record on which they disagree; a
    record of several targets has a row for each that differs."""
    a, b = given.withColumnRenamed("target", "given_target"), found.withColumnRenamed("target", "found_target")
    both = a.join(b, "left_id", "full_outer")
    status = F.when(F.col("found_target").isNull(), "only_given").when(F.col("given_target").isNull(), "only_found").when(F.col("given_target") != F.col("found_target"), "different")
    return both.withColumn("status", status).where("status is not null").select("left_id", "given_target", "found_target", "status")
