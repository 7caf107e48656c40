"""Native column functions on texts, numbers in texts, and names."""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Words that carry no meaning in a title or name.
STOP_WORDS = (
    "a able about across after all almost also am among an and any are as at be because been but by can cannot could dear did do does either else ever every for from get got had has have he her hers "
    "him his how however i if in into is it its just least let like likely may me might most must my neither no nor not of off often on only or other our own rather said say says she should since so some "
    "than that the their them then there these they this tis to too twas us wants was we were what when where which while whom why will with would yet you your"
).split()
#: Accented letters of Vietnamese in lower case, and their plain letters.
VIETNAMESE = "ôơâăêưóồớáấắềéụứíýđòộờàầằếèúừìỳõổởãẫẵễẽũữĩỷỏỗợảẩẳểẻủửỉỹọốỡạậặệẹùựịỵ"
VIETNAMESE_PLAIN = "ooaaeuoooaaaeeuuiydoooaaaeeuuiyoooaaaeeuuiyoooaaaeeuuiyoooaaaeeuuiy"
#: Spellings of one country, and the one kept.
COUNTRY_SPELLINGS = ("Viet nam", "Việt nam", "Viet Nam", "Việt Nam")
COUNTRY = "Vietnam"
SLUG_MISSING = "add-slug-here"


def java_trim(x: Column) -> Column:
    """``x`` without blanks and control characters at either end."""
    return F.regexp_replace(x, "^[\\x00-\\x20]+|[\\x00-\\x20]+$", "")


def clean(x: Column) -> Column:
    """Trimmed, runs of white space as one blank, lower case; null stays null."""
    return F.lower(F.regexp_replace(java_trim(x), "\\s+", " "))


def alnum_key(x: Column) -> Column:
    """Lower case with all but a-z and 0-9 deleted."""
    return F.regexp_replace(F.lower(java_trim(x)), "[^a-z0-9]", "")


def count_char(x: Column, char: str) -> Column:
    """How often ``char`` stands in ``x``."""
    return (F.length(x) - F.length(F.replace(x, F.lit(char), F.lit("")))).cast("long")


def is_vietnamese(x: Column) -> Column:
    """Whether ``x`` holds one of the accented lower-case letters of Vietnamese."""
    return x.rlike(f"[{VIETNAMESE}]")


def remove_diacritics(x: Column) -> Column:
    """The accented lower-case letters of Vietnamese replaced by plain ones."""
    return F.translate(x, VIETNAMESE, VIETNAMESE_PLAIN)


@lru_cache(1)
def _fold_table() -> tuple[str, str]:
    """Letters that decompose to one ASCII letter and marks, and these letters."""
    pairs = []
    for code in range(0x80, 0x2000):
        parts = unicodedata.normalize("NFD", chr(code))
        if len(parts) > 1 and parts[0].isascii() and all(unicodedata.combining(c) for c in parts[1:]):
            pairs.append((chr(code), parts[0]))
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def ascii_fold(x: Column) -> Column:
    """Accents removed, then everything outside ASCII dropped (without padding)."""
    return F.regexp_replace(F.translate(x, *_fold_table()), "[^\\x00-\\x7F]", "")


def json_escape(x: Column) -> Column:
    """``x`` as a JSON string literal; null and empty give two quotes.

    Quotes, backslashes and slashes are escaped, control characters written as
    their short forms or as four hexadecimal digits.
    """
    out = x
    for plain, escaped in (("\\", "\\\\"), ('"', '\\"'), ("/", "\\/"), ("\b", "\\b"), ("\t", "\\t"), ("\n", "\\n"), ("\f", "\\f"), ("\r", "\\r")):
        out = F.replace(out, F.lit(plain), F.lit(escaped))
    for code in [*range(8), 11, *range(14, 32)]:
        out = F.replace(out, F.lit(chr(code)), F.lit(f"\\u{code:04x}"))
    return F.concat(F.lit('"'), F.coalesce(out, F.lit("")), F.lit('"'))


def is_doi(x: Column) -> Column:
    """Whether ``x`` begins like a DOI."""
    return x.startswith("10.")


def pages(first: Column, last: Column) -> Column:
    """``first-last``, null if either is."""
    return F.concat(first, F.lit("-"), last)


def normalize_issn(x: Column) -> Column:
    """Eight characters get their hyphen, nine are kept, others are no ISSN."""
    t = java_trim(F.replace(x, F.lit("x"), F.lit("X")))
    return F.when(F.length(x) < 8, F.lit(None)).when(F.length(t) == 8, F.concat(F.substring(t, 1, 4), F.lit("-"), F.substring(t, 5, 4))).when(F.length(t) == 9, t)


def correct_country(x: Column) -> Column:
    """All spellings of the country as the one kept; null stays null."""
    for spelling in COUNTRY_SPELLINGS:
        x = F.replace(x, F.lit(spelling), F.lit(COUNTRY))
    return x


def parse_year(x: Column) -> Column:
    """The year as an int; null if it is no plain whole number or before 1600."""
    n = F.when(x.rlike("^[+-]?[0-9]{1,9}$"), x.cast("int"))
    return F.when(n >= 1600, n)


def is_number(x: Column) -> Column:
    """Whether ``x`` reads as a floating-point number."""
    return F.coalesce(java_trim(x).rlike("^[+-]?(?:NaN|Infinity|(?:[0-9]+\\.?[0-9]*|\\.[0-9]+)(?:[eE][+-]?[0-9]+)?[fFdD]?)$"), F.lit(False))


def article_type(x: Column) -> Column:
    """conference, journal or other; a missing type is a journal article."""
    t = F.lower(x)
    return F.when(x.isNull(), "journal").when(t.contains("proceeding") | t.contains("conference"), "conference").when(t.contains("article"), "journal").otherwise("other")


def word_tokens(x: Column) -> Column:
    """Words of the folded text in lower case, apostrophes kept, stop words out."""
    return F.filter(F.split(F.lower(ascii_fold(x)), "[^A-Za-z0-9_']+"), lambda w: (w != "") & ~w.isin(*STOP_WORDS))


def search_terms(x: Column) -> Column:
    """Words of the folded text in lower case, stop words included."""
    return F.filter(F.split(F.lower(ascii_fold(x)), "[^a-z0-9_']+"), lambda w: w != "")


def org_suffix(x: Column) -> Column:
    """The last word of an organisation's name (its country, as a rule).

    What follows the last blank, comma, full stop or semicolon before the final
    character; null if there is none.
    """
    t = F.replace(java_trim(F.lower(x)), F.lit("viet nam"), F.lit("vietnam"))
    found = F.regexp_extract(t, "(?s)^.*[ ,.;]([^ ,.;]*.)$", 1)
    return F.when((F.length(x) >= 2) & t.rlike("(?s)[ ,.;].$|[ ,.;][^ ,.;]+.$"), java_trim(found))


def name_variants(full: Column) -> Column:
    """Abbreviated forms of a full name, none if it is abbreviated already."""
    words = F.split(clean(F.replace(full, F.lit("."), F.lit(". "))), " ")
    n = F.size(words)
    last = F.element_at(words, -1)
    front = F.slice(words, F.lit(1), n - 1)
    dots = F.array_join(F.transform(front, lambda w: F.concat(F.substring(w, 1, 1), F.lit("."))), " ")
    first = F.concat(F.substring(words[0], 1, 1), F.lit("."))
    forms = F.array(
        F.concat_ws(" ", last, F.array_join(front, " ")),
        F.concat_ws(" ", dots, last),
        F.concat_ws(" ", last, dots),
        F.concat(last, F.lit(", "), first),
        F.concat(first, F.lit(" "), last),
    )
    none = F.array().cast("array<string>")
    return F.when(full.isNull(), F.lit(None)).when(count_char(full, ".") >= n - 1, none).otherwise(forms)


def slug_base(x: Column) -> Column:
    """ASCII, lower case, words joined by hyphens, at most 255 characters."""
    t = F.regexp_replace(F.lower(ascii_fold(F.coalesce(x, F.lit("")))), "[^a-z0-9]+", "-")
    return F.substring(F.regexp_replace(t, "^-+|-+$", ""), 1, 255)


def slug_needed(slug: Column) -> Column:
    """Whether a row still waits for its slug."""
    return F.coalesce((slug == "") | (slug == SLUG_MISSING), F.lit(True))


def short_label(right: Column, left: Column, key: Column, title: Column) -> Column:
    """Catalogue and id, filled to 18 characters, and 50 characters of the title; null without a title."""
    name = F.concat(F.when(right & left, "Scopus&ISI").when(right, "Scopus").otherwise("ISI"), F.lit("-"), key.cast("string"))
    return F.concat(F.rpad(name, F.greatest(F.length(name), F.lit(18)), F.lit(" ")), F.lit(":  "), F.substring(title, 1, 50))
