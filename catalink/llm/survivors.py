"""Best representative of each duplicate group, field by field.

Fields are unpivoted to long rows of narrow features; each normalised value of
a field collects votes, its source's trust times a decay by age; the fullest
genuine value wins, votes decide between equally full ones. Texts never move:
only hashes, sizes and times are shuffled, all by mergeable aggregates.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalink.llm.components import components
from catalink.operators.packed import LAYOUTS, Layout, split_values
from catalink.sources.tables import broadcast_if_small, staged

#: Contents that say there is none.
PLACEHOLDERS = ("", "na", "none", "null", "nil", "unknown", "nonegiven", "notgiven", "notavailable", "noabstractavailable", "noabstract", "nokeywords", "tba", "tbd", "pending", "missing")


@dataclass(frozen=True)
class Field:
    """``layout``: None for prose, else how its values are packed."""

    name: str
    layout: Layout | None = None


FIELDS = (Field("abstract"), Field("keyword", LAYOUTS["keyword"]), Field("funding_text"))


def plain(text: Column) -> Column:
    """Letters and digits of ``text`` in lower case, without markup."""
    bare = F.regexp_replace(F.regexp_replace(F.lower(text), "<[^<>]{1,40}>", ""), "&[a-z]{2,8};", " ")
    return F.regexp_replace(bare, "[^\\p{L}\\p{N}]+", "")


def features(field: Field) -> Column:
    """Content hash and fullness of a field: (0, 0) for none or a placeholder.

    Prose is as full as it has letters and digits; packed values as there are
    different ones, then by their letters and digits.
    """
    text = F.coalesce(F.col(field.name).cast("string"), F.lit(""))
    if field.layout is None:
        content = plain(text)
        size = F.length(content).cast("long")
    else:
        values = F.array_sort(F.array_distinct(F.filter(F.transform(split_values(text, field.layout), plain), lambda x: ~x.isin(*PLACEHOLDERS))))
        content = F.array_join(values, "|")
        size = F.size(values) * F.lit(1_000_000_000).cast("long") + F.length(content)
    genuine = ~content.isin(*PLACEHOLDERS)
    return F.struct(F.when(genuine, F.xxhash64(content)).otherwise(0).alias("content"), F.when(genuine, size).otherwise(0).alias("fullness"))


def long_rows(records: DataFrame, key: str, seen_at: str, trust: Column, fields: tuple[Field, ...]) -> DataFrame:
    """One narrow row per record and field: ``record``, ``field_name``, ``content``, ``fullness``, ``seen_at``, ``trust``."""
    arms = F.array(*(F.struct(F.lit(f.name).alias("field_name"), F.lit(f.layout is None).alias("prose"), features(f).alias("f")) for f in fields))
    rows = records.select(F.col(key).alias("record"), F.col(seen_at).alias("seen_at"), trust.alias("trust"), F.explode(arms).alias("x"))
    rows = rows.select("record", "seen_at", "trust", "x.field_name", "x.prose", "x.f.content", "x.f.fullness")
    best = F.max_by(F.struct("content", "fullness", "trust", "prose", "seen_at"), F.struct("seen_at", "fullness", "content")).alias("x")
    return rows.where("record is not null").groupBy("record", "field_name").agg(best).select("record", "field_name", "x.*")


def _publications(members: DataFrame) -> DataFrame:
    """``record``, ``publication`` of the records in groups; groups that have a
    record in common are one publication."""
    by = members.groupBy("record").agg(F.min(F.xxhash64("group_key")).alias("first"), F.max(F.xxhash64("group_key")).alias("last"))
    by = staged(by, "publications")
    joint = staged(by.where("first <> last").select("record"), "joint")
    edges = members.join(joint, "record", "left_semi").join(by, "record").select(F.col("first").alias("a"), F.xxhash64("group_key").alias("b"))
    found = components(staged(edges.where("a <> b").distinct(), "edges"), "a", "b").select(F.col("node").alias("first"), "component")
    return by.join(found, "first", "left").select("record", F.struct(F.coalesce("component", "first").alias("group"), F.lit(None).cast("string").alias("alone")).alias("publication"))


def _words(text: Column) -> Column:
    """The different words of four letters or more."""
    return F.array_distinct(F.filter(F.split(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), "[^\\p{L}]+", " "), " "), lambda w: F.length(w) >= 4))


def _unlike(a: Column, b: Column) -> Column:
    """Whether two lists of words have less than half of the shorter in common."""
    return 2 * F.size(F.array_intersect(a, b)) < F.least(F.size(a), F.size(b))


def notices(prose: DataFrame, members: DataFrame, about: DataFrame | None, unknown_at: int = 5) -> DataFrame:
    """``field_name``, ``content`` of prose that belongs to no publication.

    Records of one publication have like titles or authors. Of all records
    that hold a text word for word, the two whose titles stand farthest apart
    in the order of the alphabet are compared: if neither titles nor authors
    are alike, the text is a notice, be it in two records or in a third of all.
    Where no titles are known (``about`` is None), a text that ``unknown_at`` or
    more publications hold is one; records of a group are one publication, and
    so is each record outside all groups.
    """
    shared = prose.groupBy("field_name", "content").agg(F.count("*").alias("_n")).where("_n > 1").select("field_name", "content")
    held = prose.join(broadcast_if_small(shared), ["field_name", "content"]).select("field_name", "content", "record")
    if about is None:
        held = held.join(_publications(members), "record", "left")
        held = held.select("field_name", "content", F.coalesce("publication", F.struct(F.lit(None).cast("bigint").alias("group"), F.col("record").cast("string").alias("alone"))).alias("publication"))
        return held.groupBy("field_name", "content").agg(F.count_distinct("publication").alias("_n")).where(F.col("_n") >= unknown_at).select("field_name", "content")
    known = about.where("record is not null").select("record", _words(F.col("title")).alias("t"), _words(F.col("author")).alias("a")).where(F.size("t") > 0)
    placed = held.join(known, "record").withColumn("place", F.array_join("t", " "))
    ends = placed.groupBy("field_name", "content").agg(*(f(F.struct("place", "t", "a")).alias(n) for f, n in ((F.min, "x"), (F.max, "y"))))
    return ends.where(_unlike(F.col("x.t"), F.col("y.t")) & _unlike(F.col("x.a"), F.col("y.a"))).select("field_name", "content")


def survivors(groups: DataFrame, rows: DataFrame, about: DataFrame | None = None, first: str = "fullness", half_life_days: float = 730.0) -> DataFrame:
    """``group_key``, ``field_name``, ``record`` whose value survives.

    ``groups`` has (``group_key``, ``record``); ``rows`` comes from
    ``long_rows``; ``about`` has (``record``, ``title``, ``author``) and tells
    ``notices`` from content. ``first`` is what decides, "fullness" or
    "votes"; the other parts equals. No row comes out where all records of a
    group hold the same content or none. Nulls are no content; among equal
    contents the latest record wins, then the smallest key. Empty tables give
    no rows.
    """
    rows = staged(rows, "features")
    members = groups.where("group_key is not null and record is not null").select("group_key", "record").distinct()
    several = members.groupBy("group_key").agg(F.min("record").alias("_a"), F.max("record").alias("_b")).where("_a < _b").select("group_key")
    none = notices(rows.where("prose and fullness > 0"), members, about).withColumn("_notice", F.lit(True))
    marked = rows.join(broadcast_if_small(none), ["field_name", "content"], "left")
    none = F.col("_notice").isNotNull()
    marked = marked.select("record", "field_name", "seen_at", "trust", *(F.when(none, 0).otherwise(F.col(c)).alias(c) for c in ("content", "fullness")))
    cases = members.join(several, "group_key", "left_semi").join(marked, "record")
    weight = F.col("trust") * F.pow(F.lit(2.0), F.coalesce(F.unix_timestamp("seen_at"), F.lit(0)) / F.lit(86400.0 * half_life_days) - F.lit(20.0))
    latest = F.max_by("record", F.struct("seen_at", -F.col("record")))
    values = cases.groupBy("group_key", "field_name", "content").agg(F.round(F.sum(weight), 6).alias("votes"), F.max("fullness").alias("fullness"), latest.alias("record"), F.max("seen_at").alias("seen_at"))
    second = "votes" if first == "fullness" else "fullness"
    picked = values.groupBy("group_key", "field_name").agg(
        F.max_by("record", F.struct(F.col("fullness") > 0, first, second, "seen_at", "content")).alias("record"),
        F.max("fullness").alias("_full"),
        F.min("content").alias("_c1"),
        F.max("content").alias("_c2"),
    )
    return picked.where("_full > 0 and _c1 <> _c2").select("group_key", "field_name", "record")


def source_trust(records: DataFrame, source: str, sound: Column) -> DataFrame:
    """``source``, ``trust``: the share of a source's records that are ``sound``,
    between 0 and 1 also for sources of few records."""
    share = (F.count_if(sound) + 1) / (F.count("*") + 2)
    return records.groupBy(F.col(source).alias("source")).agg(F.round(share, 6).alias("trust"))


def wide(found: DataFrame) -> DataFrame:
    """One row per group: for each field the record whose value survives."""
    names = [f.name for f in FIELDS]
    return found.groupBy("group_key").pivot("field_name", names).agg(F.first("record"))


def bare_doi(text: Column) -> Column:
    """The DOI in ``text``: lower case, from ``10.`` on; null if there is none."""
    found = F.regexp_extract(F.lower(text), "(10\\.\\d{4,9}/[^\\s\"<>]+)", 1)
    found = F.regexp_replace(found, "[.,;:]+$", "")
    return F.when(found != "", found)
