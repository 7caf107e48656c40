"""Deeply nested records to related flat tables.

One JSON text of authors, their organisations and the units of these becomes
three levels of flat rows that keep their parents' keys and positions. Texts
are parsed once into variants; nested ``transform`` calls attach the ancestor
positions, ``flatten`` joins the levels, one ``inline`` emits the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The names under which the members may stand.
ORG_MEMBERS = ("organize", "organizes", "organization", "organizations")
UNIT_MEMBERS = ("units",)
LIST_PATHS = ("$", "$.authors", "$.data.authors")
LEVEL = "array<struct<author_pos:int,org_pos:int,unit_pos:int,label:string>>"


def _get(v: Column, path: str, kind: str) -> Column:
    return F.try_variant_get(v, path, kind)


def _listed(v: Column, path: str) -> Column:
    """The member at ``path`` as a list; a single value is a list of one."""
    one = _get(v, path, "variant")
    single = F.when(one.isNotNull() & ~F.is_variant_null(one), F.array(one))
    return F.coalesce(_get(v, path, "array<variant>"), single)


def parsed(text: Column) -> Column:
    """The variant of a text that is one JSON value, else null.

    The text is parsed inside brackets, since the parser ignores what follows
    a complete value.
    """
    wrapped = _get(F.try_parse_json(F.concat(F.lit("["), text, F.lit("]"))), "$", "array<variant>")
    return F.when(F.size(wrapped) == 1, F.element_at(wrapped, 1))


def author_list(text: Column) -> Column:
    """The list of authors in ``text``: bare, inside an object, or as JSON in a string."""
    value = parsed(text)
    inner = F.when(F.schema_of_variant(value) == "STRING", parsed(_get(value, "$", "string"))).otherwise(value)
    known = [_get(inner, path, "array<variant>") for path in LIST_PATHS]
    members = F.map_values(_get(inner, "$", "map<string,variant>"))
    lists = lambda vs: F.filter(F.transform(vs, lambda v: _get(v, "$", "array<variant>")), lambda a: a.isNotNull())
    deeper = F.flatten(F.filter(F.transform(members, lambda v: F.map_values(_get(v, "$", "map<string,variant>"))), lambda a: a.isNotNull()))
    return F.coalesce(*known, F.get(lists(members), F.lit(0)), F.get(lists(deeper), F.lit(0)))


def _name(v: Column) -> Column:
    """The name of an organisation or unit: a string, or an object's ``name``."""
    plain = F.when(F.schema_of_variant(v) == "STRING", _get(v, "$", "string"))
    return F.coalesce(plain, _get(v, "$.name", "string"))


def _author_label(v: Column) -> Column:
    full = _get(v, "$.fullName", "string")
    first, last = (F.trim(F.coalesce(_get(v, p, "string"), F.lit(""))) for p in ("$.first_name", "$.last_name"))
    plain = F.when(F.schema_of_variant(v) == "STRING", _get(v, "$", "string"))
    joined = F.concat_ws(" ", F.when(first != "", first), F.when(last != "", last))
    return F.coalesce(F.when(F.trim(full) != "", full), plain, F.when(joined != "", joined))


def _row(a: Column, o: Column, u: Column, label: Column) -> Column:
    return F.struct(a.cast("int").alias("author_pos"), o.cast("int").alias("org_pos"), u.cast("int").alias("unit_pos"), label.alias("label"))


def levels(authors: Column) -> Column:
    """All rows of one record as an array: its authors, organisations, units."""
    zero = F.lit(0)
    none = F.from_json(F.lit("[]"), LEVEL)

    def of_author(a: Column, i: Column) -> Column:
        orgs = F.coalesce(*(_listed(a, f"$.{m}") for m in ORG_MEMBERS))

        def of_org(o: Column, j: Column) -> Column:
            units = F.coalesce(*(_listed(o, f"$.{m}") for m in UNIT_MEMBERS))
            below = F.transform(units, lambda u, k: _row(i + 1, j + 1, k + 1, _name(u)))
            return F.concat(F.array(_row(i + 1, j + 1, zero, _name(o))), F.coalesce(below, none))

        below = F.flatten(F.transform(orgs, of_org))
        return F.concat(F.array(_row(i + 1, zero, zero, _author_label(a))), F.coalesce(below, none))

    return F.flatten(F.transform(authors, of_author))


def flatten_authors(df: DataFrame, key: str, field: str) -> DataFrame:
    """Rows ``key``, ``author_pos``, ``org_pos``, ``unit_pos``, ``label``.

    Positions count from 1 within the parent and are 0 above the level of the
    row. Null, empty and unreadable texts give no rows; members that hold no
    label (null or wholly missing) keep their position but give no row of
    their own. A null ``key`` stays null; other columns are ignored.
    """
    rows = df.select(F.col(key).alias("_key"), author_list(F.col(field)).alias("_authors")).where(F.size("_authors") > 0)
    flat = rows.select(F.col("_key").alias(key), F.inline(levels(F.col("_authors"))))
    return flat.where(F.col("label").isNotNull())


def related_tables(df: DataFrame, key: str, field: str) -> dict[str, DataFrame]:
    """The three related tables, each with its parents' keys and by one ``inline``
    of its own: authors, organisations, units."""
    rows = df.select(F.col(key).alias("_key"), author_list(F.col(field)).alias("_authors")).where(F.size("_authors") > 0)
    chosen = {"authors": lambda x: x["org_pos"] == 0, "organisations": lambda x: (x["org_pos"] > 0) & (x["unit_pos"] == 0), "units": lambda x: x["unit_pos"] > 0}
    columns = {"authors": ["author_pos"], "organisations": ["author_pos", "org_pos"], "units": ["author_pos", "org_pos", "unit_pos"]}

    def level(name: str) -> DataFrame:
        kept = F.filter(levels(F.col("_authors")), lambda x: chosen[name](x) & x["label"].isNotNull())
        return rows.select(F.col("_key").alias(key), F.inline(kept)).select(key, *columns[name], "label")

    return {name: level(name) for name in chosen}
