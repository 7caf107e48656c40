"""Free-entered names mapped to a canonical list: partition-based pigeonhole join.

Names are rewritten to a plain form. A reference name is cut into k + 1 pieces;
a typed name within k edits holds one of them unchanged, at a position shifted
by at most k, so an equality join on (piece number, length, piece) finds every
candidate, which the built-in ``levenshtein`` verifies. Abbreviated names are
joined on the stems of their words. Everything is Spark SQL; distinct names
are mapped once and joined back, so frequent names cost nothing more.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalink.sources.tables import broadcast_if_small, staged

#: Words that may be left out of a name.
LEFT_OUT = ("a", "an", "and", "et", "for", "in", "of", "on", "the", "und")
#: Editions in brackets after a name.
EDITIONS = "\\((?:online|print|electronic|cd-rom|e-journal|paper)\\)"


@dataclass(frozen=True)
class Match:
    """``edits``: most edits of a whole name; ``word_edits``: of one word;
    ``stem``: letters of a word that an abbreviation keeps at least;
    ``max_names``: reference names up to which the pieces are broadcast."""

    edits: int = 4
    word_edits: int = 2
    stem: int = 4
    max_names: int = 100_000


def _folded(text: Column) -> Column:
    """Lower case without accents and entities."""
    t = F.regexp_replace(F.lower(text), "&amp;", "&")
    return F.translate(t, "àáâãäåāăạảấầẩẫậắằẳẵặèéêëēẹẻẽếềểễệìíîïĩỉịòóôõöøōọỏốồổỗộớờởỡợơùúûüũūụủứừửữựưýỳỹỷỵñçđ", "aaaaaaaaaaaaaaaaaaaaeeeeeeeeeeeeeiiiiiiiooooooooooooooooooouuuuuuuuuuuuuuyyyyyncd")


def name_words(text: Column) -> Column:
    """The words of a name in plain form, those that may be left out removed."""
    plain = F.regexp_replace(F.regexp_replace(_folded(text), EDITIONS, " "), "[^\\p{L}\\p{N}]+", " ")
    return F.filter(F.split(F.trim(plain), " "), lambda w: (w != "") & ~w.isin(*LEFT_OUT))


def _misspelt_filler(w: Column) -> Column:
    """Whether a short word looks like a word that may be left out, one slip away."""
    letters = lambda x: F.array_sort(F.split(x, ""))
    near = [(F.levenshtein(w, F.lit(s)) <= 1) | (letters(w) == letters(F.lit(s))) for s in ("and", "for", "in", "of", "on", "the")]
    found = near[0]
    for x in near[1:]:
        found = found | x
    return (F.length(w) <= 4) & found


def _forms(names: DataFrame) -> DataFrame:
    """Typed names in the forms they may be read: whole, without what follows a
    comma, and each without words that look like misspelt fillers."""
    cut = F.regexp_replace("name", ",[^,]*$", "")
    both = F.array_distinct(F.array(F.col("name"), cut))
    rows = names.select("name", F.posexplode(both).alias("tail", "read"))
    rows = rows.select("name", "tail", name_words(F.col("read")).alias("w"))
    fewer = F.filter("w", lambda w: ~_misspelt_filler(w))
    rows = rows.select("name", F.explode(F.array_distinct(F.array(F.struct("tail", "w"), F.struct((F.col("tail") + 2).alias("tail"), fewer.alias("w"))))).alias("x")).select("name", "x.*")
    return rows.where(F.size("w") > 0).withColumn("plain", F.array_join("w", " "))


def _stem(w: Column, n: int) -> Column:
    """The beginning of a word; journals shrink to one letter."""
    return F.when(w.isin("journal", "j", "jour", "jnl"), "j").otherwise(F.substring(w, 1, n))


def _fits(short: Column, long: Column) -> Column:
    """Whether ``short`` may abbreviate ``long``: its beginning, or a J for a journal."""
    return long.startswith(short) | ((short == "j") & (long == "journal"))


def match_names(typed: DataFrame, reference: DataFrame, rule: Match = Match()) -> DataFrame:
    """``name``, ``ref_id`` of the reference entry each name means, 0 for none.

    ``typed`` has ``name`` (null and blank names are dropped), ``reference``
    ``ref_id`` and ``canonical_name``. Of several entries in reach the nearest
    wins, then the one read without a tail, then the smallest ``ref_id``. A word
    that is spelt like another word of the reference list is not taken for a
    misspelling. An empty reference list leaves all names unmatched.
    """
    k = rule.edits
    names = typed.where(F.trim("name") != "").select("name").distinct()
    forms = staged(_forms(names), "forms")
    entries = reference.where("ref_id is not null and canonical_name is not null").select("ref_id", name_words(F.col("canonical_name")).alias("rw")).where(F.size("rw") > 0)
    entries = broadcast_if_small(entries.withColumn("rplain", F.array_join("rw", " ")), rule.max_names)
    known = broadcast_if_small(entries.select(F.explode("rw").alias("term")).distinct(), 20 * rule.max_names)

    equal = forms.join(entries, F.col("plain") == F.col("rplain")).select("name", "tail", "ref_id", F.lit(0).alias("edits"))
    equal = staged(equal, "equal")
    open_ = forms.join(equal.select("name").distinct(), "name", "left_anti")

    stems = lambda ws: F.array_join(F.transform(ws, lambda w: _stem(w, rule.stem)), " ")
    short = open_.withColumn("stems", stems(F.col("w"))).join(entries.withColumn("stems", stems(F.col("rw"))), "stems")
    short = short.where((F.size("w") == F.size("rw")) & F.forall(F.zip_with("w", "rw", _fits), lambda x: x))
    short = staged(short.select("name", "tail", "ref_id", F.lit(0).alias("edits")), "short")
    open_ = open_.join(short.select("name").distinct(), "name", "left_anti")

    # pieces of the reference names: number, begin, length, text
    n = F.length("rplain")
    piece = F.explode(F.transform(F.sequence(F.lit(0), F.lit(k)), lambda i: F.struct(i.alias("i"), F.floor(n * i / (k + 1)).cast("int").alias("b"), F.floor(n * (i + 1) / (k + 1)).cast("int").alias("e"))))
    pieces = entries.select("ref_id", "rw", "rplain", n.alias("rn"), piece.alias("p")).select("ref_id", "rw", "rplain", "rn", "p.i", "p.b", (F.col("p.e") - F.col("p.b")).alias("len")).withColumn("piece", F.expr("substring(rplain, b + 1, len)"))
    pieces = broadcast_if_small(pieces, (k + 1) * rule.max_names)
    shapes = broadcast_if_small(pieces.select("rn", "i", "b", "len").distinct(), (k + 1) * rule.max_names)
    # substrings of the typed names where an unchanged piece may stand: with i
    # pieces before it, either at most i edits came before or at most k - i after
    m = F.length("plain")
    tasks = int(typed.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lengths = open_.repartition(tasks, "name").withColumn("m", m).withColumn("rn", F.explode(F.sequence(m - k, m + k)))
    sized = lengths.join(shapes, "rn")
    d = F.col("m") - F.col("rn")
    low = F.greatest(F.lit(0), F.col("b") - F.col("i"), F.col("b") + d - (k - F.col("i")))
    high = F.least(F.col("m") - F.col("len"), F.col("b") + F.col("i"), F.col("b") + d + (k - F.col("i")))
    cut = sized.withColumn("low", low).withColumn("high", high).where("low <= high").withColumn("at", F.explode(F.sequence("low", "high")))
    cut = cut.withColumn("piece", F.expr("substring(plain, at + 1, len)"))
    found = cut.join(pieces.select("ref_id", "rw", "rplain", "rn", "i", "piece"), ["rn", "i", "piece"]).select("name", "tail", "w", "plain", "ref_id", "rw", "rplain").distinct()
    near = found.withColumn("edits", F.levenshtein("plain", "rplain", k)).where("edits >= 0")
    # words that differ, in order; no known word may stand for another
    near = near.withColumn("tw", F.array_except("w", "rw")).withColumn("xw", F.array_except("rw", "w"))
    # a word may differ by word_edits, by more if it is long and begins alike
    most = lambda t, x: F.when(F.left(t, F.lit(1)) == F.left(x, F.lit(1)), F.floor(F.length(x) * 0.45)).otherwise(F.least(F.lit(rule.word_edits), F.greatest(F.lit(1), F.floor(F.length(x) / 2))))
    aligned = (F.size("tw") == F.size("xw")) & F.forall(F.zip_with("tw", "xw", lambda t, x: F.levenshtein(t, x) <= most(t, x)), lambda x: x)
    merged = F.size("tw") != F.size("xw")
    near = near.where(aligned | (merged & (F.levenshtein(F.array_join("tw", ""), F.array_join("xw", "")) <= rule.word_edits)))
    wrong = near.select("name", "tail", "ref_id", F.explode("tw").alias("term")).join(known, "term").select("name", "tail", "ref_id").distinct()
    near = near.join(wrong, ["name", "tail", "ref_id"], "left_anti").select("name", "tail", "ref_id", F.col("edits").cast("int").alias("edits"))

    all_ = equal.unionByName(short).unionByName(near)
    best = all_.groupBy("name").agg(F.min_by("ref_id", F.struct("edits", "tail", "ref_id")).alias("ref_id"))
    best = staged(best, "mapped")
    unmatched = names.join(best, "name", "left_anti").select("name", F.lit(0).cast("long").alias("ref_id"))
    return best.select("name", F.col("ref_id").cast("long").alias("ref_id")).unionByName(unmatched)
