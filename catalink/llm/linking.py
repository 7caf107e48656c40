"""Matching entities across two sources without a common key: collective linkage.

Records of both sources are nodes of a candidate graph. Two records are joined
by an edge if they share rare attributes (keys built of identifiers, numbers,
names and pieces of titles); an edge weighs the more the rarer what is shared.
Meta-blocking keeps the edges that weigh at least the mean of one of their
nodes. Pairs that cannot come near a match, by what two records say in few bits,
are dropped where they meet, so neither moved nor written. What is left is
compared attribute by attribute, and the similarity is then propagated: a pair gains if the records that its two ends are best linked
to fit each other, and loses if they do not, until the set of matches is
stable. Pairs that come into reach on the way are compared like all others; no
pair comes out without a score of its own. Records alike in all attributes are
one node.
"""

from __future__ import annotations

from dataclasses import dataclass
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from catalink.llm.canonical_names import _folded, name_words
from catalink.llm.components import components
from catalink.llm.survivors import bare_doi
from catalink.sources.tables import broadcast_if_small, staged

#: Greek letters that titles write as signs or words.
GREEK = {"α": "alpha", "β": "beta", "γ": "gamma", "δ": "delta", "ε": "epsilon", "κ": "kappa", "λ": "lambda", "μ": "mu", "π": "pi", "σ": "sigma", "τ": "tau", "ω": "omega"}
#: Openings of notices on another publication.
NOTICE = "^\\W*(?:(?:erratum|errata|corrigendum|correction|retraction|comment|reply|addendum)\\b[^:]{0,20}(?:\\bto\\b|\\bon\\b|:)\\s*:?|\\p{L}{5,12}\\s+\\p{L}{1,3}\\s*:)"
#: Letters by how many of each a sketch counts: two numbers of 64 bits.
SKETCH = {"etiaorns": 7, "lcdpmuh": 5, "gyfbvwk": 4, "xzqj": 1}
PART = "[\\s.,:;(-]+p[a-z]{2,4}\\s+([ivx]{1,5}|[0-9]{1,2})\\W*$"


@dataclass(frozen=True)
class Linkage:
    """``accept``: least score of a match; ``support``: weight of the
    neighbours' similarity, by which a score moves ``most`` at most.

    Where a shared key would join more than ``hot`` pairs, its records are dealt
    out to blocks of so many; all pairs are looked at."""

    accept: float = 4.0
    support: float = 0.4
    most: float = 3.0
    rounds: int = 40
    hot: int = 1_000_000


def title_text(title: Column) -> Column:
    """Plain title: no markup, accents, bracketed remarks; Greek letters as words."""
    t = F.regexp_replace(title, "<[^<>]{1,20}>", "")
    t = F.regexp_replace(_folded(t), "\\[[^\\]]{1,40}\\]\\s*$", "")
    for sign, word in GREEK.items():
        t = F.replace(t, F.lit(sign), F.lit(word))
    return t


def records(df: DataFrame, **columns: str) -> DataFrame:
    """The attributes that are compared, from the named columns of one source.

    Columns: ``key``, ``title``, ``journal``, ``year``, ``doi``, ``authors``,
    ``volume``, ``issue``, ``page`` (first page or a range). Blanks count as
    null.
    """
    blank = lambda c: F.when(F.trim(F.col(columns[c]).cast("string")) != "", F.trim(F.col(columns[c]).cast("string")))
    text = title_text(blank("title"))
    body = F.regexp_replace(F.regexp_replace(text, PART, ""), NOTICE, "")
    plain = lambda t: F.array_join(F.filter(F.split(F.trim(F.regexp_replace(t, "[^\\p{L}\\p{N}]+", " ")), " "), lambda w: (w != "") & ~w.isin("the", "a", "an", "of", "and", "in", "on", "for")), " ")
    number = lambda c: F.nullif(F.regexp_extract(blank(c), "([0-9]+)", 1), F.lit(""))
    first = F.regexp_replace(_folded(blank("authors")), "\\s(?:and|&)\\s|[;|\\n]", "\u0001")
    parts = F.split(F.split(first, "\u0001")[0], ",")
    # the first name; a part of one word before a comma is a family name
    lead = F.when(F.size(F.split(F.trim(parts[0]), "\\s+")) == 1, F.concat_ws(" ", parts[0], F.get(parts, F.lit(1)))).otherwise(parts[0])
    names = F.filter(F.split(F.trim(F.regexp_replace(lead, "[^\\p{L}]+", " ")), " "), lambda w: F.length(w) >= 4)
    return df.select(
        F.col(columns["key"]).alias("id"),
        plain(body).alias("title"),
        plain(F.substring_index(body, ":", 1)).alias("main"),
        F.coalesce(body.contains(":"), F.lit(False)).alias("sub"),
        F.nullif(F.concat_ws("|", F.when(text.rlike(NOTICE), F.lit("notice")), F.upper(F.nullif(F.regexp_extract(text, PART, 1), F.lit("")))), F.lit("")).alias("marker"),
        F.coalesce(F.transform(name_words(F.regexp_replace(blank("journal"), ",[^,]*$", "")), lambda w: F.when(w == "j", "jour").otherwise(F.substring(w, 1, 4))), F.array().cast("array<string>")).alias("journal"),
        number("year").cast("int").alias("year"),
        bare_doi(blank("doi")).alias("doi"),
        F.coalesce(F.sort_array(names), F.array().cast("array<string>")).alias("names"),
        number("volume").alias("volume"),
        number("issue").alias("issue"),
        number("page").alias("page"),
    ).where("id is not null")


def block_keys(rows: DataFrame, *columns: str) -> DataFrame:
    """(``key``, ``id``): what two records may share, as hashes; with the named columns."""
    flat = F.replace("title", F.lit(" "), F.lit(""))
    longest = F.try_element_at(F.sort_array(F.transform("names", lambda w: F.struct(F.length(w).alias("n"), w.alias("w"))), asc=False), F.lit(1))["w"]
    have = lambda *cs: [c.isNotNull() for c in cs]

    def of(kind: str, conditions: list[Column], *values: Column) -> Column:
        hashed = F.xxhash64(F.lit(kind), *values)
        for c in conditions:
            hashed = F.when(c, hashed)
        return hashed

    doi, page, volume, year = (F.col(c) for c in ("doi", "page", "volume", "year"))
    keys = F.array(
        of("doi", have(doi), doi),
        of("begin", [F.length(flat) >= 20], F.substring(flat, 1, 24)),
        of("middle", [F.length(flat) >= 40], F.substring(flat, 16, 24)),
        of("end", [F.length(flat) >= 20], F.right(flat, F.lit(24))),
        of("place", have(page, volume, year), page, volume, year),
        of("person journal", [*have(year, longest), F.size("journal") > 0], year, longest, F.array_join("journal", " ")),
        of("person volume", have(volume, year, longest), volume, longest, year),
    )
    # any of the names, as an initial may stand for the longest
    people = F.when(page.isNotNull(), F.transform("names", lambda w: F.xxhash64(F.lit("person page"), page, w)))
    keys = F.concat(keys, F.coalesce(people, F.array().cast("array<bigint>")))
    return rows.select(F.explode(F.array_distinct(F.array_compact(keys))).alias("key"), "id", *columns)


def telling(left: DataFrame, right: DataFrame) -> DataFrame:
    """``title``, ``most``: what an equal title proves, for titles of several records.

    A title that stands for one publication has records of one year or one
    first author; the more of both, the more general it is ("Editorial"). 6
    points up to two of both, 2 from eight on. Years and names are counted by
    the bits of a mask, so a title of any number of records is one short sum.
    """
    bit = lambda h: F.when(h.isNotNull(), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(h, F.lit(61)).cast("int")))
    lead = F.when(F.size("names") > 0, F.xxhash64(F.array_max(F.transform("names", lambda w: F.concat(F.lpad(F.length(w).cast("string"), 4, "0"), w)))))
    rows = left.select("title", "year", "names").unionByName(right.select("title", "year", "names")).where("title <> ''")
    masks = rows.groupBy("title").agg(F.count("*").alias("n"), F.bit_or(bit(F.col("year"))).alias("ys"), F.bit_or(bit(lead)).alias("ns")).where("n > 2")
    k = F.least(F.bit_count(F.coalesce("ys", F.lit(0))), F.bit_count(F.coalesce("ns", F.lit(0))))
    return masks.where(k > 2).select("title", F.greatest(F.lit(2.0), 6.0 - 2.0 * F.log2(k / 2)).alias("most"))


def sketch(text: Column) -> list[Column]:
    """The letters of a text in two numbers: of each as many bits as it occurs, up to a limit."""
    words, at = [F.lit(0).cast("long"), F.lit(0).cast("long")], 0
    for letter, most in ((c, n) for letters, n in SKETCH.items() for c in letters):
        if at % 64 + most > 64:
            at = 64
        times = F.least(F.length(text) - F.length(F.replace(text, F.lit(letter), F.lit(""))), F.lit(most))
        ones = F.call_function("shiftleft", F.lit(1).cast("long"), times) - 1
        words[at // 64] = words[at // 64].bitwiseOR(F.call_function("shiftleft", ones, F.lit(at % 64)))
        at += most
    return words


#: What `traits` adds to a record.
TRAITS = ("y", "v", "i", "p", "d", "named", "jn", "j", "marks", "sub", "tn", "t0", "t1", "cn", "c0", "c1", "top")


def traits(rows: DataFrame) -> DataFrame:
    """The records with what `reach` needs of them, in numbers."""
    hashed = lambda c: F.when(F.col(c).isNotNull(), F.hash(c))
    words = F.transform("journal", lambda w: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(F.hash(w), F.lit(64))))
    text, main = (F.coalesce(c, F.lit("")) for c in ("title", "main"))
    (t0, t1), (c0, c1) = sketch(text), sketch(main)
    top = F.coalesce("most", F.lit(6.0)) if "most" in rows.columns else F.lit(6.0)
    made = {
        "y": F.col("year"), "v": hashed("volume"), "i": hashed("issue"), "p": hashed("page"), "d": hashed("doi"), "named": F.size("names") > 0,
        "jn": F.size("journal"), "j": F.aggregate(words, F.lit(0).cast("long"), lambda x, w: x.bitwiseOR(w)), "marks": F.coalesce(hashed("marker"), F.lit(0)),
        "tn": F.length(text), "t0": t0, "t1": t1, "cn": F.length(main), "c0": c0, "c1": c1, "top": top.cast("float"),
    }
    return rows.withColumns(made)


def reach() -> tuple[Column, Column]:
    """Two bounds of the score that `compared` gives a pair (columns of `traits`
    and ``_l``, ``_r``): none is less, the second is nearer and takes longer.

    Unequal hashes are unequal values. A letter that one text has more of takes
    an edit each, and so does a letter of length.
    """
    c = lambda name: (F.col(f"{name}_l"), F.col(f"{name}_r"))

    def same(name: str, yes: float, no: float) -> Column:
        x, y = c(name)
        return F.when(x.isNull() | y.isNull(), 0.0).when(x == y, yes).otherwise(no)

    def alike(*names: str) -> Column:
        n, *bits = names
        (nl, nr), pairs = c(n), [c(b) for b in bits]
        more = lambda i: sum((F.bit_count(p[i].bitwiseAND(F.bitwise_not(p[1 - i]))) for p in pairs[1:]), F.bit_count(pairs[0][i].bitwiseAND(F.bitwise_not(pairs[0][1 - i]))))
        return 1.0 - F.greatest(more(0), more(1), F.abs(nl - nr)) / F.greatest(nl, nr, F.lit(1))

    (yl, yr), (jl, jr), (ml, mr), (nl, nr), (tl, tr), (sl, sr) = (c(x) for x in ("y", "j", "jn", "named", "tn", "sub"))
    year = F.when(yl.isNull() | yr.isNull(), 0.0).when(yl == yr, 1.0).when(F.abs(yl - yr) == 1, 0.0).otherwise(-1.5)
    both = F.bit_count(jl.bitwiseAND(jr)) + ml - F.bit_count(jl)
    journal = F.when((ml == 0) | (mr == 0), 0.0).otherwise((F.least(F.lit(1.0), both / F.greatest(ml, mr)) - 0.5) * 2.0)
    rest = year + F.when(nl & nr, 1.5).otherwise(0.0) + journal + same("d", 4.0, -1.5) + same("p", 2.5, -1.5) + same("v", 1.0, -1.0) + same("i", 0.5, -0.5)
    short = F.least(tl, tr)
    most = F.least(F.col("top_l"), F.when(short < 20, 3.0).otherwise(6.0))
    near = F.when(sl == sr, alike("tn", "t0", "t1")).otherwise(F.greatest(alike("tn", "t0", "t1"), alike("cn", "c0", "c1") - 0.03))
    return rest + F.when(short > 0, most).otherwise(0.0), rest + F.when(short > 0, F.greatest(F.lit(-6.0), F.least((near - 0.78) * 27.0, most))).otherwise(0.0)


def _meet(a: DataFrame, b: DataFrame, on: list[str], least: float) -> DataFrame:
    """(``l``, ``r``, ``key``) of the records that share ``on`` and may score ``least``."""
    named = lambda df, s: df.withColumnsRenamed({"id": s, **{x: f"{x}_{s}" for x in TRAITS}})
    rough, near = reach()
    fits = (F.col("marks_l") == F.col("marks_r")) | (F.col("sub_l") != F.col("sub_r"))
    return named(a, "l").join(named(b, "r"), on).where(fits & (rough >= least) & (near >= least)).select("l", "r", "key")


def candidates(left: DataFrame, right: DataFrame, rule: Linkage = Linkage()) -> DataFrame:
    """Edges (``l``, ``r``) of the candidate graph after meta-blocking.

    Pairs that no support can lift to ``accept`` are no edges. They count for the
    mean of a node all the same, each as often as it shares a key, which makes
    the mean no greater than that of its different edges.
    """
    a, b = (staged(block_keys(traits(x), *TRAITS), "keys") for x in (left, right))
    na, nb = (k.groupBy("key").agg(F.count("*").alias(n)) for k, n in ((a, "na"), (b, "nb")))
    shared = staged(na.join(nb, "key").withColumn("w", F.log2(1.0 + 1e6 / (F.col("na") * F.col("nb")))), "shared")
    least = rule.accept - rule.most - 1e-5
    # each side of a hot key is dealt out, so that two parts make a block
    part = max(1, isqrt(rule.hot))
    hot = broadcast_if_small(shared.where(F.col("na") * F.col("nb") > rule.hot).select("key", F.ceil(F.col("na") / part).alias("ka"), F.ceil(F.col("nb") / part).alias("kb")))
    if hot.isEmpty():
        pairs = _meet(a, b, ["key"], least)
    else:
        own = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
        every = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
        rows = [x.join(hot, "key").withColumn("pa", pa).withColumn("pb", pb).drop("ka", "kb") for x, pa, pb in ((a, own("ka"), every("kb")), (b, every("ka"), own("kb")))]
        pairs = _meet(*(x.join(hot, "key", "left_anti") for x in (a, b)), ["key"], least).unionByName(_meet(*rows, ["key", "pa", "pb"], least))
    edges = staged(staged(pairs, "pairs").join(shared.select("key", "w"), "key").groupBy("l", "r").agg(F.round(F.sum("w"), 6).alias("w")), "edges")
    mean = lambda x, n, s: x.select("key", F.col("id").alias(s)).join(shared.select("key", "w", n), "key").groupBy(s).agg((F.sum(F.col("w") * F.col(n)) / F.sum(n)).alias(f"m{s}"))
    kept = edges.join(mean(a, "nb", "l"), "l").join(mean(b, "na", "r"), "r").where((F.col("w") >= F.col("ml") - 1e-6) | (F.col("w") >= F.col("mr") - 1e-6))
    return kept.select("l", "r")


def _same(a: str, b: str, yes: float, no: float) -> Column:
    return F.when(F.col(a).isNull() | F.col(b).isNull(), 0.0).when(F.col(a) == F.col(b), yes).otherwise(no)


def compared(edges: DataFrame, left: DataFrame, right: DataFrame) -> DataFrame:
    """(``l``, ``r``, ``score``) of the edges: evidence for and against, summed.

    ``left`` has ``most``, what its title can prove. Pairs whose titles carry
    different markers (a notice, a part) are out.
    """
    side = lambda df, s: df.select(*(F.col(c).alias(f"{c}_{s}") for c in df.columns))
    rows = edges.join(side(left, "l"), F.col("l") == F.col("id_l")).join(side(right, "r"), F.col("r") == F.col("id_r"))
    # a subtitle may be missing, and what follows it with it
    cut = F.col("sub_l") != F.col("sub_r")
    lost = cut & (F.when(F.col("sub_l"), F.col("marker_r")).otherwise(F.col("marker_l"))).isNull() & (F.coalesce(F.col("doi_l") == F.col("doi_r"), F.lit(False)) | ((F.col("page_l") == F.col("page_r")) & (F.col("volume_l") == F.col("volume_r"))))
    rows = rows.where(F.col("marker_l").eqNullSafe(F.col("marker_r")) | F.coalesce(lost, F.lit(False)))
    ratio = lambda a, b: 1.0 - F.levenshtein(a, b) / F.greatest(F.length(a), F.length(b), F.lit(1))
    short = F.least(F.length("title_l"), F.length("title_r"))
    # each step a column of its own, so no distance is computed twice
    rows = rows.withColumn("whole", F.when(F.col("title_l") == F.col("title_r"), 1.0).otherwise(ratio("title_l", "title_r")))
    rows = rows.withColumn("alike", F.when(short > 0, F.greatest("whole", F.when(cut, ratio("main_l", "main_r") - 0.03))))
    alike = F.col("alike")
    # general titles prove little, short ones are often general
    most = F.least(F.coalesce("most_l", F.lit(6.0)), F.when(short < 20, 3.0).otherwise(6.0))
    title = F.when(alike.isNull(), 0.0).otherwise(F.greatest(F.lit(-6.0), F.least((alike - 0.78) * 27.0, most)))
    year = F.when(F.col("year_l").isNull() | F.col("year_r").isNull(), 0.0).when(F.col("year_l") == F.col("year_r"), 1.0).when(F.abs(F.col("year_l") - F.col("year_r")) == 1, 0.0).otherwise(-1.5)
    near = F.exists("names_l", lambda x: F.exists("names_r", lambda y: (x == y) | ((F.length(x) >= 5) & (F.levenshtein(x, y) <= 2))))
    names = F.when((F.size("names_l") == 0) | (F.size("names_r") == 0), 0.0).when(near, 1.5).otherwise(-2.0)
    shared = F.size(F.array_intersect("journal_l", "journal_r")) / F.greatest(F.size("journal_l"), F.size("journal_r"), F.lit(1))
    journal = F.when((F.size("journal_l") == 0) | (F.size("journal_r") == 0), 0.0).otherwise((shared - 0.5) * 2.0)
    score = title + year + names + journal + _same("doi_l", "doi_r", 4.0, -1.5) + _same("page_l", "page_r", 2.5, -1.5) + _same("volume_l", "volume_r", 1.0, -1.0) + _same("issue_l", "issue_r", 0.5, -0.5)
    return rows.select("l", "r", F.round(score, 6).alias("score"))


def propagated(edges: DataFrame, left: DataFrame, right: DataFrame, rule: Linkage) -> DataFrame:
    """``l``, ``r``, ``score`` of the links after similarity has flowed along the
    graph until it is stable.

    A pair (l, r) draws on r', the record that l is best linked to, and l', the
    one of r: the weakest of l - r', r' - l' and l' - r moves the pair's score by
    its share of what it has above ``accept``, or lacks, and by ``most`` at most;
    pairs that lie farther from ``accept`` are decided. Pairs that such a path
    joins are compared if they were not yet. A pair that would change sides for
    the third time stays out, so the end is reached; if it is not within
    ``rounds``, that is an error.
    """
    score = F.col("score")
    known = staged(compared(edges, left, right), "scored")
    fresh_state = lambda df: df.where(F.abs(score - rule.accept) <= rule.most).select("l", "r", score.alias("own"), "score", (score >= rule.accept).alias("linked"), F.lit(0).alias("turns"))
    open_ = fresh_state(known)
    for _ in range(rule.rounds):
        sure = known.where(score > rule.accept + rule.most).select("l", "r", "score")
        strong = staged(sure.unionByName(open_.where("linked").select("l", "r", "score")), "strong")
        best_l = staged(strong.groupBy("l").agg(F.max_by(F.struct(F.col("r").alias("r2"), score.alias("s1")), F.struct("score", -F.col("r"))).alias("x")).select("l", "x.*"), "best")
        best_r = staged(strong.groupBy("r").agg(F.max_by(F.struct(F.col("l").alias("l2"), score.alias("s3")), F.struct("score", -F.col("l"))).alias("x")).select("r", "x.*"), "best")
        # pairs whose best records are linked to each other come into reach; most links are each other's best
        paths = strong.select(F.col("l").alias("l2"), F.col("r").alias("r2")).join(best_l.select("l", "r2"), "r2").join(best_r.select("r", "l2"), "l2").where("l <> l2 or r <> r2").select("l", "r")
        # and so do the best records of an undecided pair
        around = lambda: open_.select("l", "r").join(best_l, "l").join(best_r, "r").where("l <> l2 and r <> r2")
        paths = paths.unionByName(around().select(F.col("l2").alias("l"), F.col("r2").alias("r")))
        fresh = broadcast_if_small(paths.distinct().join(known.select("l", "r"), ["l", "r"], "left_anti"))
        more = not fresh.isEmpty()
        if more:
            some = [side.join(broadcast_if_small(fresh.select(F.col(k).alias("id")).distinct()), "id", "left_semi") for side, k in ((left, "l"), (right, "r"))]
            # those that compare as different publications are kept, so as not to be compared again
            scored = staged(fresh.join(compared(fresh, *some), ["l", "r"], "left").select("l", "r", F.coalesce("score", F.lit(-99.0)).alias("score")), "reached")
            known = known.unionByName(scored)
            open_ = open_.unionByName(fresh_state(scored))
        middle = known.select(F.col("l").alias("l2"), F.col("r").alias("r2"), score.alias("s2"))
        near = around().join(middle, ["l2", "r2"])
        near = near.select("l", "r", F.least("s1", "s2", "s3").alias("through"))
        share = F.coalesce(F.greatest(F.lit(-rule.most), F.least(F.lit(rule.most), (F.col("through") - rule.accept) * rule.support)), F.lit(0.0))
        moved = open_.join(near, ["l", "r"], "left").withColumn("score", F.round(F.col("own") + share, 6))
        turned = F.col("linked") != (score >= rule.accept)
        moved = moved.select("l", "r", "own", "score", ((score >= rule.accept) & (F.col("turns") + turned.cast("int") < 3)).alias("linked"), F.col("linked").alias("was"), (F.col("turns") + turned.cast("int")).alias("turns"))
        moved = staged(moved, "moved")
        open_ = moved.drop("was")
        if not more and moved.where("linked <> was").isEmpty():
            return known.where(score > rule.accept + rule.most).unionByName(open_.where("linked").select("l", "r", "score"))
    raise RuntimeError("the matches did not settle")


def _nodes(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Records without those that equal an earlier one in all attributes, and
    (``id``, ``node``) of the ones left out."""
    attributes = [c for c in rows.columns if c != "id"]
    rows = staged(rows.dropDuplicates(["id"]).withColumn("_h", F.xxhash64(*attributes)), "records")
    first = rows.groupBy("_h").agg(F.min("id").alias("node"), F.max("id").alias("_b")).where("node < _b").select("_h", "node")
    # equal hashes are looked at in full
    several = rows.join(broadcast_if_small(first.select("_h")), "_h", "left_semi")
    node = F.min("id").over(Window.partitionBy("_h", *attributes))
    copies = staged(several.withColumn("node", node).where("id <> node").select("id", "node"), "copies")
    return rows.drop("_h").join(broadcast_if_small(copies.select("id")), "id", "left_anti"), copies


def links(left: DataFrame, right: DataFrame, rule: Linkage = Linkage()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Links (``l``, ``r``, ``confidence``) between nodes, and the copies of both sides.

    Both sides come from ``records``. The confidence follows from the score alone.
    """
    (a, copies_a), (b, copies_b) = _nodes(left), _nodes(right)
    a = staged(a.join(broadcast_if_small(telling(a, b)), "title", "left"), "left")
    found = propagated(candidates(a, b, rule), a, b, rule)
    sure = F.round(1.0 / (1.0 + F.exp(-(F.col("score") - rule.accept / 2))), 6)
    return staged(found.select("l", "r", sure.alias("confidence")), "links"), copies_a, copies_b


def link(left: DataFrame, right: DataFrame, rule: Linkage = Linkage()) -> DataFrame:
    """``l``, ``r``, ``confidence`` of the pairs that describe the same thing.

    Every pair has its own score; copies have the links of the record they
    equal. Null attributes neither speak for nor against, repeated records
    count once, an empty side gives no pairs.
    """
    found, copies_a, copies_b = links(left, right, rule)
    for side, copies in (("l", copies_a), ("r", copies_b)):
        also = found.join(broadcast_if_small(copies.withColumnRenamed("node", side)), side)
        found = found.unionByName(also.withColumn(side, F.col("id")).drop("id"))
    return found


def members(left: DataFrame, right: DataFrame, rule: Linkage = Linkage()) -> DataFrame:
    """``side`` ("l" or "r"), ``id``, ``entity`` of every linked record: one row
    per record, however many records an entity has. An entity is named by the
    least record of the left side in it."""
    found, copies_a, copies_b = links(left, right, rule)
    # one number space: left even, right odd
    nodes = staged(components(found.select((F.col("l") * 2).alias("u"), (F.col("r") * 2 + 1).alias("v")), "u", "v"), "entities")
    rows = nodes.select(F.when(F.col("node") % 2 == 0, "l").otherwise("r").alias("side"), F.floor(F.col("node") / 2).alias("id"), "component")
    copies = copies_a.withColumn("side", F.lit("l")).unionByName(copies_b.withColumn("side", F.lit("r"))).withColumnRenamed("id", "copy").withColumnRenamed("node", "id")
    rows = staged(rows.unionByName(rows.join(copies, ["side", "id"]).select("side", F.col("copy").alias("id"), "component")), "records")
    least = rows.where("side = 'l'").groupBy("component").agg(F.min("id").alias("entity"))
    return rows.join(least, "component").select("side", "id", "entity")
