"""Several values packed in one field: one row per value, positions kept.

Each text is reduced to a skeleton: quoted spans become ``q``, runs of
ordinary characters ``w``, and only delimiters stay. The skeleton is cut at
its delimiters and kept as the set of its distinct pieces, so long lists of the
same layout share one. The skeleton decides what separates: in a
numbered list the numbers and nothing else, so that its semicolons are content;
else every delimiter that the skeleton holds, as one text may mix them. Rules
are resolved once per distinct skeleton, broadcast while few, and applied to the
texts by position. Everything runs in the JVM.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalink.sources.tables import broadcast_if_small

MARK = "\u0001"
EDGE = "^[\\s\\u00a0]+|[\\s\\u00a0]+$"
NUMBERING = "^(?:\\[\\d{1,4}\\]|\\(\\d{1,4}\\)|\\d{1,4}[.)](?=\\s))\\s*"


@dataclass(frozen=True)
class Layout:
    """How values of one field may be packed.

    ``delimiters``: patterns (Java) that end a value outside quotes.
    ``commas``: "never", "always" (a comma and a blank end a value) or "names"
    (they do, unless the piece is one name written family-first).
    ``numbered``: whether "[1] ..." starts a value, and where it does alone.
    """

    delimiters: tuple[str, ...]
    commas: str = "never"
    numbered: bool = False


#: The layouts of the bibliographic fields.
LAYOUTS = {
    "author": Layout((";", "\\n", "\\|", "\\s&\\s", "\\s(?i:and)\\s"), commas="names"),
    "keyword": Layout((";", "；", "\\n", "\\|", "·", "\\s/\\s"), commas="always"),
    "cited_references": Layout((";", "\\n", "\\s\\|\\s"), numbered=True),
}


def _outside(parts: Column, change) -> Column:
    """``change`` applied to the pieces between quotes, the quoted ones kept.

    ``parts`` is the text split at its quotes; with an odd number of quotes
    none of them counts as one.
    """
    balanced = F.size(parts) % 2 == 1
    return F.transform(parts, lambda s, i: F.when(balanced & (i % 2 == 1), s).otherwise(change(s)))


def skeleton(text: Column) -> Column:
    """The delimiter skeleton: the set of distinct pieces of the masked text."""
    parts = F.split(text, '"', -1)
    balanced = F.size(parts) % 2 == 1
    masked = F.transform(
        parts,
        lambda s, i: F.when(balanced & (i % 2 == 1), F.lit("q")).otherwise(
            F.regexp_replace(
                F.regexp_replace(F.regexp_replace(s, "\\[\\d{1,4}\\]", "\u0002"), "(?i)(?<=\\s)and(?=\\s)", "\u0003"),
                "[^\\s;；|·/&,\u0002\u0003]+",
                "w",
            )
        ),
    )
    flat = F.array_join(masked, "")
    flat = F.regexp_replace(F.regexp_replace(flat, "[^\\S\\n]+", " "), "w(?: w)+", "W")
    flat = F.regexp_replace(flat, "(?:, ?[wWq]){3,}", ",+")
    pieces = F.split(flat, "(?<=[;；|·\\n\u0003])")
    return F.array_join(F.array_sort(F.array_distinct(pieces)), "~")


#: How each delimiter shows in a skeleton.
SHOWN = {";": ";", "；": "；", "\\n": "\n", "\\|": "|", "\\s\\|\\s": " |", "·": "·", "\\s/\\s": " / ", "\\s&\\s": " & ", "\\s(?i:and)\\s": "\u0003"}
#: A list number begins a value; a delimiter directly before it, or at the end, belongs to it.
BY_NUMBER = "(?:\\s*[;|])?\\s*(?=\\[\\d{1,4}\\]\\s)|\\s*[;|]\\s*$"


def rules(skeletons: DataFrame, layout: Layout) -> DataFrame:
    """One row per skeleton: ``pattern`` that ends values, ``commas``.

    Only delimiters that the skeleton holds enter the pattern; a skeleton that
    holds none gets an empty one, and its texts stay whole.
    """
    pattern = F.concat_ws("|", *(F.when(F.col("skeleton").contains(SHOWN[d]), F.lit(d)) for d in layout.delimiters))
    if layout.numbered:
        pattern = F.when(F.col("skeleton").contains("\u0002"), F.lit(BY_NUMBER)).otherwise(pattern)
    commas = F.col("skeleton").contains(",") if layout.commas != "never" else F.lit(False)
    return skeletons.select("skeleton", pattern.alias("pattern"), commas.alias("commas"))


def _cut(text: Column, pattern: Column) -> Column:
    """``text`` cut outside quotes wherever ``pattern`` matches."""
    parts = F.split(text, '"', -1)
    marked = _outside(parts, lambda s: F.regexp_replace(s, pattern, F.lit(MARK)))
    return F.split(F.array_join(marked, '"'), MARK, -1)


def _trimmed(x: Column) -> Column:
    return F.regexp_replace(x, EDGE, "")


def value_as_typed(x: Column) -> Column:
    """``x`` without surrounding blanks, list numbering and outer quotes."""
    x = _trimmed(F.regexp_replace(_trimmed(x), NUMBERING, ""))
    whole = F.length(x) >= 2
    whole = whole & x.startswith('"') & x.endswith('"')
    inner = F.substring(x, F.lit(2), F.length(x) - 2)
    # one pair of quotes around all: inside, quotes only stand doubled
    whole = whole & ~F.replace(inner, F.lit('""'), F.lit("")).contains('"')
    return _trimmed(F.when(whole, F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(x))


def split_values(text: Column, layout: Layout) -> Column:
    """The values packed in ``text`` as an array, without looking up rules.

    For use inside other expressions; equal to ``unpack`` value for value, since
    a delimiter that a text does not hold changes nothing.
    """
    commas = F.lit(layout.commas != "never")
    every = _split(text, F.lit("|".join(layout.delimiters)), commas, layout)
    if not layout.numbered:
        return every
    parts = F.split(text, '"', -1)
    numbered = F.exists(_outside(parts, lambda s: F.when(s.rlike("\\[\\d{1,4}\\]"), F.lit(MARK)).otherwise("")), lambda s: s == MARK)
    return F.when(numbered, _split(text, F.lit(BY_NUMBER), commas, layout)).otherwise(every)


def _split(text: Column, pattern: Column, commas: Column, layout: Layout) -> Column:
    items = F.when(pattern == "", F.array(text)).otherwise(_cut(text, pattern))
    whole = _values(items, Layout(layout.delimiters))
    return whole if layout.commas == "never" else F.when(commas, _values(items, layout)).otherwise(whole)


def _values(items: Column, layout: Layout) -> Column:
    if layout.commas != "never":

        def at_commas(x: Column) -> Column:
            pieces = _cut(x, F.lit(",\\s+"))
            if layout.commas == "always":
                return pieces
            one_name = x.rlike('^\\s*[^\\s,"]+,[^,"]*$')
            return F.when(one_name, F.array(x)).otherwise(pieces)

        items = F.flatten(F.transform(items, at_commas))
    return F.filter(F.transform(items, value_as_typed), lambda x: x != "")


def unpack(df: DataFrame, key: str, field: str, layout: Layout, max_rules: int = 200_000) -> DataFrame:
    """One row per value of ``field``: ``key``, ``pos`` (from 1), ``item_value``.

    Null, empty and blank texts give no rows, repeated values each count, an
    odd number of quotes means that none of them is one, a null ``key`` stays
    null. Other columns of ``df`` are ignored. ``max_rules``: up to so many
    distinct skeletons the rules are broadcast, beyond they are joined by a
    shuffle.
    """
    texts = df.select(F.col(key).alias("_key"), F.col(field).alias("_text")).where(F.trim(field) != "")
    texts = texts.withColumn("skeleton", skeleton(F.col("_text")))
    found = broadcast_if_small(rules(texts.select("skeleton").distinct(), layout), max_rules)
    ruled = texts.join(found, "skeleton")
    values = _split(F.col("_text"), F.col("pattern"), F.col("commas"), layout)
    return ruled.select(F.col("_key").alias(key), F.posexplode(values).alias("pos", "item_value")).withColumn("pos", (F.col("pos") + 1).cast("int"))


def unpack_fields(df: DataFrame, key: str, layouts: dict[str, Layout], max_rules: int = 200_000) -> DataFrame:
    """``unpack`` of several fields in one result with ``field_name``."""
    out = None
    for field, layout in layouts.items():
        one = unpack(df, key, field, layout, max_rules).select(key, F.lit(field).alias("field_name"), "pos", "item_value")
        out = one if out is None else out.unionByName(one)
    return out
