"""Queries of the linkage engine over the catalogues, and the SQL to check them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from catalink.functions import similarity as sim
from catalink.functions import text as tx
from catalink.operators import authors as people
from catalink.operators import canonical, linkage, merge
from catalink.operators.blocking import candidates
from catalink.operators.slug import slugs
from catalink.plans import sql as q
from catalink.plans import sql_linkage
from catalink.sources import catalogues as cat
from catalink.sources.tables import one_per_key, staged, table

PHRASE = "university of technology"
PHRASE_LIKE = f"%{PHRASE}%"


def isi(spark: SparkSession, base: str, *columns: str) -> DataFrame:
    """isi_documents by id with the columns needed."""
    return one_per_key(table(spark, base, "isi_documents", "id", "crawled_at", *columns), "id", "crawled_at").drop("crawled_at")


def scopus(spark: SparkSession, base: str, *columns: str) -> DataFrame:
    """scopus_documents by id with the columns needed."""
    return one_per_key(table(spark, base, "scopus_documents", "id", "crawled_at", *columns), "id", "crawled_at").drop("crawled_at")


def _score(x: Column) -> Column:
    return F.round(x, 6)


# texts ------------------------------------------------------------------------


def clean_text(spark: SparkSession, base: str) -> DataFrame:
    return isi(spark, base, "title").select("id", tx.clean(F.col("title")).alias("cleaned"))


def alnum_key(spark: SparkSession, base: str) -> DataFrame:
    return isi(spark, base, "title").select("id", tx.alnum_key(F.col("title")).alias("key"))


def char_count(spark: SparkSession, base: str) -> DataFrame:
    return isi(spark, base, "abstract").select("id", tx.count_char(F.col("abstract"), "a").alias("n_a"))


def ascii_fold(spark: SparkSession, base: str) -> DataFrame:
    return isi(spark, base, "title").select("id", tx.ascii_fold(F.col("title")).alias("folded"))


def vietnamese(spark: SparkSession, base: str) -> DataFrame:
    return isi(spark, base, "author").select("id", tx.is_vietnamese(F.col("author")).alias("is_vietnamese"), tx.remove_diacritics(F.col("author")).alias("plain"))


def doi_flag(spark: SparkSession, base: str) -> DataFrame:
    return isi(spark, base, "doi").select("id", tx.is_doi(F.col("doi")).alias("is_doi"))


def pages_range(spark: SparkSession, base: str) -> DataFrame:
    return scopus(spark, base, "page_start", "page_end").select("id", tx.pages(F.col("page_start"), F.col("page_end")).alias("pages"))


def issn_norm(spark: SparkSession, base: str) -> DataFrame:
    return isi(spark, base, "issn").select("id", tx.normalize_issn(F.col("issn")).alias("issn"))


def country_corrected(spark: SparkSession, base: str) -> DataFrame:
    return isi(spark, base, "affiliation").select("id", tx.correct_country(F.col("affiliation")).alias("affiliation"))


def json_escaped(spark: SparkSession, base: str) -> DataFrame:
    return isi(spark, base, "keyword").select("id", tx.json_escape(F.col("keyword")).alias("literal"))


def number_flag(spark: SparkSession, base: str) -> DataFrame:
    return isi(spark, base, "pages").select("id", tx.is_number(F.col("pages")).alias("is_number"))


def year_parse(spark: SparkSession, base: str) -> DataFrame:
    return isi(spark, base, "year").select("id", tx.parse_year(F.col("year")).alias("year"))


def type_class(spark: SparkSession, base: str) -> DataFrame:
    return isi(spark, base, "type").select("id", tx.article_type(F.col("type")).alias("document_type"))


def stopword_tokens(spark: SparkSession, base: str) -> DataFrame:
    return isi(spark, base, "title").select("id", F.array_join(tx.word_tokens(F.col("title")), " ").alias("tokens"))


def name_variants(spark: SparkSession, base: str) -> DataFrame:
    names = table(spark, base, "scopus_documents", "authors").select(F.explode(people.author_names(F.col("authors"), False)).alias("name"))
    left = table(spark, base, "isi_documents", "author").select(F.explode(people.author_names(F.col("author"), True)).alias("name"))
    return people.abbreviated(names.unionByName(left), "name")


def org_suffixes(spark: SparkSession, base: str) -> DataFrame:
    right = table(spark, base, "scopus_documents", "affiliations").select(F.explode(F.split("affiliations", "; ")).alias("affiliation"))
    return people.suffixes(table(spark, base, "isi_documents", "affiliation").unionByName(right), "affiliation")


def slug_bases(spark: SparkSession, base: str) -> DataFrame:
    return table(spark, base, "articles", "id", "title").select("id", tx.slug_base(F.col("title")).alias("slug"))


# sources ----------------------------------------------------------------------


def id_gaps(spark: SparkSession, base: str) -> DataFrame:
    left = cat.missing_ids(table(spark, base, "isi_documents", "id"), "id").select(F.lit("isi").alias("catalogue"), "missing_id")
    return left.unionByName(cat.missing_ids(table(spark, base, "scopus_documents", "id"), "id").select(F.lit("scopus").alias("catalogue"), "missing_id"))


def catalogue_union(spark: SparkSession, base: str) -> DataFrame:
    return cat.unified(spark, base)


def link_state(spark: SparkSession, base: str) -> DataFrame:
    rows = isi(spark, base, "raw_scopus_id")
    return cat.linked(rows).select("id", F.lit("linked").alias("state")).unionByName(cat.unlinked(rows).select("id", F.lit("unlinked").alias("state")))


def given_links(spark: SparkSession, base: str) -> DataFrame:
    return merge.given_links(isi(spark, base, "raw_scopus_id"), scopus(spark, base))


def catalogue_lookup(spark: SparkSession, base: str) -> DataFrame:
    """Of each catalogue the record with its last id, looked up by id and catalogue."""
    both = cat.unified(spark, base)
    last = [table(spark, base, t, "id").agg(F.max("id")).first()[0] for t in ("isi_documents", "scopus_documents")]
    found = [cat.by_key(both, -1 if key is None else key, left) for key, left in zip(last, (True, False))]
    return found[0].unionByName(found[1]).select("original_id", "title", "journal", "is_isi", "is_scopus")


def resumed_ids(spark: SparkSession, base: str) -> DataFrame:
    """The left ids from the middle of their range on."""
    ids = table(spark, base, "isi_documents", "id")
    return cat.resume_from(ids, "id", (ids.agg(F.max("id")).first()[0] or 0) // 2).distinct()


def journals_index(spark: SparkSession, base: str) -> DataFrame:
    """Journals as they are looked up: ISSN in one notation, flags decoded."""
    flags = ("is_isi", "is_scopus", "is_vci")
    return table(spark, base, "journals", "id", "name", "issn", *flags).select(F.col("id").alias("original_id"), "name", tx.normalize_issn(F.col("issn")).alias("issn"), *(F.coalesce(F.col(c) == 1, F.lit(False)).alias(c) for c in flags))


def organisations_index(spark: SparkSession, base: str) -> DataFrame:
    """Organisations as they are looked up."""
    return table(spark, base, "organizes", "id", "name").select(F.col("id").alias("original_id"), "name")


def article_labels(spark: SparkSession, base: str) -> DataFrame:
    """One short line per record: catalogue and id, then the beginning of the title."""
    return cat.unified(spark, base).select("original_id", "is_isi", tx.short_label(F.col("is_scopus"), F.col("is_isi"), F.col("original_id"), F.col("title")).alias("label"))


def articles_journals(spark: SparkSession, base: str) -> DataFrame:
    a = table(spark, base, "articles", "id", "title", "year", "doi", "is_isi", "is_scopus", "uri", "journal_id")
    j = table(spark, base, "journals", "id", "name").select(F.col("id").alias("journal_id"), F.col("name").alias("journal"))
    return a.join(j, "journal_id").select(F.col("id").alias("original_id"), "title", "year", "journal", "doi", (F.col("is_isi") == 1).alias("is_isi"), (F.col("is_scopus") == 1).alias("is_scopus"), "uri", "journal_id")


def max_ids(spark: SparkSession, base: str) -> DataFrame:
    tops = [table(spark, base, t, "id").agg(F.max("id").alias("max_id")).select(F.lit(t).alias("table_name"), "max_id") for t in ("isi_documents", "scopus_documents", "articles", "journals", "organizes")]
    out = tops[0]
    for t in tops[1:]:
        out = out.unionByName(t)
    return out


# similarities, over the pairs that the recorded links name -----------------------


def linked_pairs(spark: SparkSession, base: str) -> DataFrame:
    left = isi(spark, base, "raw_scopus_id", "title", "journal", "affiliation", "author", "abstract")
    right = scopus(spark, base, "title", "source_title", "affiliations", "authors", "abstract").select(F.col("id").alias("right_id"), F.col("title").alias("r_title"), F.col("source_title").alias("r_journal"), F.col("affiliations").alias("r_affiliation"), F.col("authors").alias("r_author"), F.col("abstract").alias("r_abstract"))
    number = F.trim("raw_scopus_id")
    return left.where(number.rlike("^[0-9]{1,18}$")).withColumn("right_id", number.cast("long")).join(right, "right_id").withColumnRenamed("id", "left_id")


def _pairs(spark: SparkSession, base: str, **scores) -> DataFrame:
    return linked_pairs(spark, base).select("left_id", "right_id", *(x.alias(n) for n, x in scores.items()))




def lcs_pairs(spark: SparkSession, base: str) -> DataFrame:
    a, b = F.lower(tx.ascii_fold(F.col("title"))), F.lower(tx.ascii_fold(F.col("r_title")))
    return _pairs(spark, base, lcs=sim.lcs_len(a, b), title_score=_score(sim.title_sim(F.col("title"), F.col("r_title"))))


def lev_pairs(spark: SparkSession, base: str) -> DataFrame:
    a, b = tx.ascii_fold(F.col("title")), tx.ascii_fold(F.col("r_title"))
    return _pairs(spark, base, lev=F.levenshtein(a, b).cast("long"), lev_sim=_score(sim.lev_sim(a, b)), lev_sim_clean=_score(sim.lev_sim_clean(a, b)))


def shingle_pairs(spark: SparkSession, base: str) -> DataFrame:
    a, b = tx.ascii_fold(F.col("title")), tx.ascii_fold(F.col("r_title"))
    return _pairs(spark, base, jaccard=_score(sim.char_shingle_jaccard(a, b)))


def token_pairs(spark: SparkSession, base: str) -> DataFrame:
    a, b = F.col("journal"), F.col("r_journal")
    return _pairs(spark, base, token_lcs=_score(sim.token_lcs_sim(a, b)), relaxed=_score(sim.token_lcs_sim_relaxed(a, b)), token_lev=_score(sim.token_lev_sim(a, b)), token_jaccard=_score(sim.token_jaccard(a, b)), prefix_words=_score(sim.prefix_word_sim(a, b)), close=sim.token_lcs_sim(a, b) >= 0.9)


def org_pairs(spark: SparkSession, base: str) -> DataFrame:
    rows = linked_pairs(spark, base).select("left_id", "right_id", "affiliation", F.explode(F.split("r_affiliation", "; ")).alias("other"))
    return rows.select("left_id", "right_id", "other", _score(sim.org_name_sim(F.col("affiliation"), F.col("other"))).alias("score"), _score(sim.org_name_sim(F.col("affiliation"), F.col("other"), "std")).alias("spread"))


def find_pairs(spark: SparkSession, base: str) -> DataFrame:
    found = sim.find_approx(F.lower("r_title"), F.lower("title"), 0.3)
    return _pairs(spark, base, place=found["place"], similarity=_score(found["similarity"]))


def subsequence_pairs(spark: SparkSession, base: str) -> DataFrame:
    return _pairs(spark, base, common=sim.lcs_text(F.col("title"), F.col("r_title")))


def year_pairs(spark: SparkSession, base: str) -> DataFrame:
    """Whether the years of linked records allow them to be the same."""
    years = [f(spark, base, "year").select(F.col("id").alias(k), tx.parse_year(F.col("year")).alias(f"{k}_year")) for f, k in ((isi, "left_id"), (scopus, "right_id"))]
    rows = given_links(spark, base).join(years[0], "left_id").join(years[1], "right_id")
    return rows.select("left_id", "right_id", linkage.year_compatible(F.col("left_id_year"), F.col("right_id_year")).alias("compatible"))


def journal_pairs(spark: SparkSession, base: str) -> DataFrame:
    """Journal scores of linked records, by name and abbreviation."""
    left = isi(spark, base, "journal", "journal_iso").select(F.col("id").alias("left_id"), "journal", "journal_iso")
    right = scopus(spark, base, "source_title", "abbreviated_source_title").withColumnRenamed("id", "right_id")
    rows = given_links(spark, base).join(left, "left_id").join(right, "right_id")
    return rows.select("left_id", "right_id", _score(linkage.journal_score(F.col("journal"), F.col("source_title"), F.col("journal_iso"), F.col("abbreviated_source_title"))).alias("journal_score"))


def person_pairs(spark: SparkSession, base: str) -> DataFrame:
    """Whether the first authors of linked records bear one person's name."""
    first = lambda c, left: F.get(people.author_names(F.col(c), left), F.lit(0))
    return _pairs(spark, base, same=F.coalesce(sim.same_person_name(first("author", True), first("r_author", False)), F.lit(False)))


def linked_people(spark: SparkSession, base: str) -> DataFrame:
    """Authors and organisations of the left records that were linked, which the merged tables leave out."""
    links = given_links(spark, base).select(F.col("left_id").alias("id")).distinct()
    t = merge.link_tables(isi(spark, base, "authors_json").join(links, "id", "left_semi"))
    named = t["authors_organizes"].join(t["organizes"].select(F.col("id").alias("organize_id"), F.col("name").alias("organisation")), "organize_id")
    of = t["articles_authors"].join(t["authors"].withColumnRenamed("id", "author_id"), "author_id").join(named, "author_id", "left")
    return of.select(F.col("article_id").alias("isi_id"), "name", "organisation")


def author_pairs(spark: SparkSession, base: str) -> DataFrame:
    a, b = people.author_names(F.col("author"), True), people.author_names(F.col("r_author"), False)
    return _pairs(spark, base, n_left=F.size(a).cast("long"), n_right=F.size(b).cast("long"), same=linkage.same_authors(a, b))


# linkage ----------------------------------------------------------------------


def candidate_topk(spark: SparkSession, base: str) -> DataFrame:
    return candidates(isi(spark, base, "title"), scopus(spark, base, "title"))


def _common(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    both = [cat.common_schema(x, left).select("original_id", "title", "year", "journal", "journal_iso", "doi") for x, left in ((cat.left_catalogue(spark, base), True), (cat.right_catalogue(spark, base), False))]
    return staged(both[0], "left"), staged(both[1], "right")


def link_matches(spark: SparkSession, base: str) -> DataFrame:
    return linkage.logged(linkage.matches(*_common(spark, base)))


def link_matches_strict(spark: SparkSession, base: str) -> DataFrame:
    """The same with the identifiers: equal DOIs accept, different DOIs or ISSNs reject."""
    both = [staged(cat.common_schema(x, left), "side") for x, left in ((cat.left_catalogue(spark, base), True), (cat.right_catalogue(spark, base), False))]
    rules = linkage.Rules(use_identifiers=True)
    return linkage.logged(linkage.matches(*both, rules), rules)


def link_outcome(spark: SparkSession, base: str) -> DataFrame:
    left, right = _common(spark, base)
    return linkage.outcome(left, linkage.logged(linkage.matches(left, right)))


def merge_log(spark: SparkSession, base: str) -> DataFrame:
    left, right = _common(spark, base)
    found = staged(linkage.logged(linkage.matches(left, right)), "logged")
    merged = merge.numbered(right.select(F.col("original_id").alias("raw_scopus_id")), ["raw_scopus_id"])
    return merge.merge_log(found, merged)


def best_journal(spark: SparkSession, base: str) -> DataFrame:
    """For each typed journal the nearest of all known ones, the smallest id of equals."""
    typed = table(spark, base, "isi_documents", "journal").where(F.trim("journal") != "").distinct().withColumn("a", tx.ascii_fold(F.col("journal")))
    known = table(spark, base, "journals", "id", "name").where(F.trim("name") != "").withColumn("b", tx.ascii_fold(F.col("name")))
    best = canonical.nearest_names(staged(typed, "typed"), known.select("id", "b"))
    return best.select("journal", F.col("id").alias("journal_id"), "score")


def journal_by_issn(spark: SparkSession, base: str) -> DataFrame:
    known = table(spark, base, "journals", "id", "issn").select("id", tx.normalize_issn(F.col("issn")).alias("issn"))
    return canonical.by_issn(isi(spark, base, "issn").select(F.col("id").alias("record"), tx.normalize_issn(F.col("issn")).alias("issn")), known)


def journal_entities(spark: SparkSession, base: str) -> DataFrame:
    both = cat.unified(spark, base).select("original_id", "is_isi", F.col("journal").alias("name"), "issn")
    return canonical.journals(merge.numbered(both, ["is_isi", "original_id"], "position"))


def organisation_entities(spark: SparkSession, base: str) -> DataFrame:
    rows = table(spark, base, "organizes", "id", "name").select(F.col("id").alias("position"), "name")
    return canonical.organisations(rows)


def nested_bounds(spark: SparkSession, base: str) -> DataFrame:
    return canonical.nested_set(table(spark, base, "organizes", "id", "name")).select("id", "_lft", "_rgt")


def article_slugs(spark: SparkSession, base: str) -> DataFrame:
    return slugs(table(spark, base, "articles", "id", "title", "slug"), "id", "title")


def journal_slugs(spark: SparkSession, base: str) -> DataFrame:
    return slugs(table(spark, base, "journals", "id", "name", "slug"), "id", "name")


def organize_slugs(spark: SparkSession, base: str) -> DataFrame:
    return slugs(table(spark, base, "organizes", "id", "name", "slug"), "id", "name")


# merge with the recorded links --------------------------------------------------


def _merged(spark: SparkSession, base: str) -> tuple[DataFrame, DataFrame]:
    left, right = cat.left_catalogue(spark, base), cat.right_catalogue(spark, base)
    links = merge.given_links(left, right)
    made = merge.articles(cat.common_schema(right, False), cat.common_schema(cat.unlinked(left), True), links)
    return staged(made, "articles"), links


def merged_articles(spark: SparkSession, base: str) -> DataFrame:
    return _merged(spark, base)[0].select("id", "title", "year", "document_type", "is_scopus", "is_isi", "raw_scopus_id", "raw_isi_id")


def import_log(spark: SparkSession, base: str) -> DataFrame:
    made, links = _merged(spark, base)
    found = links.select("left_id", "right_id", F.lit("DUPLICATED").alias("match_type"), F.lit(None).cast("double").alias("title_score"), F.lit(None).cast("double").alias("journal_score"))
    return merge.merge_log(found, made)


def merged_journals(spark: SparkSession, base: str) -> DataFrame:
    return merge.journal_table(_merged(spark, base)[0])[0]


def _article_documents(spark: SparkSession, base: str) -> DataFrame:
    """(``id`` of the article, ``authors_json``) of the record that each article stems from."""
    a = table(spark, base, "articles", "id", "raw_scopus_id", "raw_isi_id")
    sides = [a.join(f(spark, base, "authors_json").withColumnRenamed("id", k), k).select("id", "authors_json") for f, k in ((isi, "raw_isi_id"), (scopus, "raw_scopus_id"))]
    return sides[0].unionByName(sides[1])


def merged_people(spark: SparkSession, base: str) -> DataFrame:
    tables = merge.people_tables(_article_documents(spark, base))
    o = tables["organizes"].select(F.col("id").alias("organize_id"), F.col("name").alias("organisation"))
    return tables["articles_authors"].join(tables["authors"].withColumnRenamed("id", "author_id"), "author_id").join(tables["authors_organizes"], "author_id", "left").join(o, "organize_id", "left").select("article_id", "name", "organisation")


# reports ------------------------------------------------------------------------


def article_organisations(spark: SparkSession, base: str) -> DataFrame:
    """(``article_id``, ``name``): the star of articles, authors and organisations, through the link tables."""
    t = merge.link_tables(_article_documents(spark, base))
    star = table(spark, base, "articles", "id").join(t["articles_authors"], F.col("id") == F.col("article_id")).select("article_id", "author_id")
    named = t["organizes"].select(F.col("id").alias("organize_id"), "name")
    return star.join(t["authors_organizes"], "author_id").join(named, "organize_id").select("article_id", "name").distinct()


def rep_phrase_members(spark: SparkSession, base: str) -> DataFrame:
    hit = article_organisations(spark, base).where(F.col("name").ilike(PHRASE_LIKE))
    return table(spark, base, "articles", "id", "title").join(hit, F.col("id") == F.col("article_id"), "left_semi")


def rep_not_in(spark: SparkSession, base: str) -> DataFrame:
    """Log entries whose target no left record links to; entries without a target are not listed."""
    links = table(spark, base, "isi_documents", "raw_scopus_id").where("raw_scopus_id <> ''").select(F.col("raw_scopus_id").alias("target"))
    logs = table(spark, base, "merge_logs", "id", "duplication_of").where("duplication_of is not null")
    return logs.join(links, F.col("duplication_of").cast("string") == F.col("target"), "left_anti")


def rep_counts(spark: SparkSession, base: str) -> DataFrame:
    a = table(spark, base, "articles", "is_scopus", "is_isi").agg(F.count_if(F.col("is_scopus") == 1).alias("merged_scopus"), F.count_if(F.col("is_isi") == 1).alias("merged_isi"), F.count_if((F.col("is_scopus") == 1) & (F.col("is_isi") == 1)).alias("in_both"))
    crawled = [table(spark, base, t, "id").agg(F.count("*").alias(n)) for t, n in (("scopus_documents", "crawled_scopus"), ("isi_documents", "crawled_isi"))]
    return crawled[0].join(crawled[1]).join(a)


def _listed() -> Column:
    return F.array_join(F.array_sort(F.collect_set("name")), "\n").alias("merged_organizes")


def rep_disagree(spark: SparkSession, base: str) -> DataFrame:
    logs = table(spark, base, "merge_logs", "isi_id", "duplication_of").where("duplication_of is not null").distinct()
    left = isi(spark, base, "affiliation", "raw_scopus_id").select(F.col("id").alias("isi_id"), F.col("affiliation").alias("isi_organizes"), F.trim("raw_scopus_id").try_cast("long").alias("right_id"))
    right = scopus(spark, base, "affiliations").select(F.col("id").alias("right_id"), F.col("affiliations").alias("scopus_organizes"))
    merged = article_organisations(spark, base).withColumnRenamed("article_id", "duplication_of")
    rows = logs.join(left, "isi_id").join(right, "right_id").join(merged, "duplication_of").groupBy("isi_id", "duplication_of", "isi_organizes", "scopus_organizes").agg(_listed())
    hits = [F.col(c).ilike(PHRASE_LIKE) for c in ("isi_organizes", "merged_organizes", "scopus_organizes")]
    return rows.where(~((hits[0] & hits[1] & hits[2]) | (~hits[0] & ~hits[1] & ~hits[2])))


def rep_mismatch(spark: SparkSession, base: str) -> DataFrame:
    a = table(spark, base, "articles", "id", "title", "raw_isi_id")
    left = isi(spark, base, "affiliation").withColumnRenamed("id", "raw_isi_id")
    rows = a.join(left, "raw_isi_id").join(article_organisations(spark, base), F.col("id") == F.col("article_id")).groupBy("id", "title", "affiliation").agg(_listed())
    own, there = F.col("merged_organizes").ilike(PHRASE_LIKE), F.col("affiliation").ilike(PHRASE_LIKE)
    return rows.where((own & ~there) | (~own & there))


def link_compare(spark: SparkSession, base: str) -> DataFrame:
    given = given_links(spark, base).select("left_id", F.col("right_id").alias("target"))
    found = table(spark, base, "merge_logs", "isi_id", "duplication_of").join(table(spark, base, "articles", "id", "raw_scopus_id").where("raw_scopus_id is not null"), F.col("duplication_of") == F.col("id"))
    found = found.select(F.col("isi_id").alias("left_id"), F.col("raw_scopus_id").alias("target")).distinct()
    return linkage.link_comparison(given, found)


QUERIES = (
    clean_text, alnum_key, char_count, ascii_fold, vietnamese, doi_flag, pages_range, issn_norm, country_corrected, json_escaped, number_flag, year_parse, type_class, stopword_tokens, name_variants, org_suffixes, slug_bases,
    id_gaps, catalogue_union, link_state, given_links, catalogue_lookup, resumed_ids, journals_index, organisations_index, article_labels, articles_journals, max_ids,
    lcs_pairs, lev_pairs, shingle_pairs, token_pairs, org_pairs, find_pairs, subsequence_pairs, year_pairs, journal_pairs, person_pairs, author_pairs,
    candidate_topk, link_matches, link_matches_strict, link_outcome, merge_log, best_journal, journal_by_issn, journal_entities, organisation_entities, nested_bounds, article_slugs, journal_slugs, organize_slugs,
    merged_articles, import_log, merged_journals, merged_people, linked_people, rep_phrase_members, rep_not_in, rep_counts, rep_disagree, rep_mismatch, link_compare,
)


def queries() -> dict:
    return {f.__name__: f for f in QUERIES}


def oracle_sql() -> dict[str, str]:
    return {**q.reference(), **sql_linkage.linkage()}
