"""Variant spellings of persons and organisations: canonical rewritings.

Every name is rewritten in all the ways the rules allow: nicknames and initials
of given names, left-out middle names, both orders of the parts, legal forms and
subjects of organisations in full, accents and punctuation removed, one slip of
the keys (each letter left out once). Names meet by an equality join on their
rewritings. A rewriting proves the more the rarer it is: its score is one by the
number of entities that share it. One that belongs to a single entity links a
name to it; one that several share (an initial with a common family name) links
to none of them unless another part decides, and is kept with its score.

Strings are reduced to distinct nodes first, so a name typed a million times
counts once, and only nodes that differ are joined. The lists of nicknames,
legal forms and the like are parameters.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalink.llm.canonical_names import _folded
from catalink.llm.components import components
from catalink.sources.tables import broadcast_if_small, staged

#: Given names and their short forms.
NICKNAMES = {
    "abigail": "abby abbie gail", "alexander": "alex sasha alec sandy", "andrew": "andy drew", "anselm": "ansel", "anthony": "tony", "barbara": "barb babs",
    "benjamin": "ben benny", "cedric": "ced rick", "charles": "charlie chuck", "christopher": "chris kit topher", "daniel": "dan danny", "david": "dave davey",
    "deborah": "deb debbie", "dorothea": "dora dorothy thea dot", "edward": "ed eddie ned ted", "elizabeth": "beth liz lizzie betty eliza lisa", "francisca": "paca fran paquita",
    "francisco": "paco pancho", "frederick": "fred fritz freddy", "gabriele": "gabi gabby", "gerald": "gerry jerry", "gregory": "greg", "henrik": "rik henk", "ignacio": "nacho iggy",
    "james": "jim jimmy", "jennifer": "jen jenny", "johannes": "hans", "jose": "pepe", "joseph": "joe joey", "jorge": "coque", "katherine": "kate kathy kat katie kitty",
    "lawrence": "larry laurie", "margaret": "peggy maggie meg greta", "matthew": "matt", "michael": "mike mick", "nicholas": "nick nico", "nikolaus": "klaus niko claus",
    "patricia": "pat patty trish", "penelope": "penny nell", "peter": "pete", "petra": "pet", "richard": "dick rich ricky", "robert": "bob bobby rob bert", "samuel": "sam sammy",
    "stephen": "steve", "susanna": "sue susie suzy", "theodore": "ted theo teddy", "thomas": "tom tommy", "ulrike": "uli ulli", "victoria": "vicky vicki tori", "william": "bill will billy liam willy", "zoltan": "zoli",
}
#: Short forms in the names of organisations, and their full words.
LEGAL_FORMS = {
    "university": "univ universitat universite universidad", "college": "coll", "academy": "acad", "institute": "inst institut institution", "centre": "center ctr cent", "research": "res",
    "national": "natl", "laboratory": "lab labs laboratories", "department": "dept", "education": "educ edu", "forestry": "forest", "fisheries": "fish fishery", "technology": "tech technol technological",
    "medicine": "med medical", "sciences": "sci science", "natural": "", "agriculture": "agric agr agricultural", "engineering": "eng engn engng", "economics": "econ economy", "social": "soc",
    "studies": "stud study", "faculty": "fac", "hospital": "hosp", "school": "sch", "international": "intl int",
}
#: Countries, and other names of them.
COUNTRIES = {
    "vietnam": "", "france": "frankreich", "germany": "deutschland allemagne alemania", "japan": "nippon nihon", "norway": "norge", "thailand": "siam", "brazil": "brasil", "spain": "espana", "sweden": "sverige",
    "denmark": "danmark", "finland": "suomi", "italy": "italia", "poland": "polska", "austria": "osterreich", "hungary": "magyarorszag", "greece": "hellas", "turkey": "turkiye", "china": "", "india": "bharat",
    "netherlands": "nederland holland", "belgium": "belgie belgique", "switzerland": "schweiz suisse", "portugal": "", "mexico": "", "canada": "", "australia": "", "korea": "", "russia": "", "ukraine": "", "ireland": "eire",
    "egypt": "misr", "indonesia": "", "malaysia": "", "philippines": "pilipinas", "singapore": "", "cambodia": "kampuchea", "laos": "", "argentina": "", "chile": "", "peru": "", "colombia": "",
}
#: Words of bodies that sign as an author.
BODIES = ("group", "team", "panel", "survey", "partners", "consortium", "collaboration", "committee", "network", "project", "society", "initiative")
#: Short given names that are one slip apart from another one.
GIVEN_NAMES = ("an", "anh", "binh", "dong", "duc", "dung", "ha", "hai", "hoa", "hoang", "hong", "hung", "huong", "khanh", "lam", "lan", "linh", "loan", "long", "mai", "minh", "nam", "nga", "ngoc", "quang", "tam", "tan", "thang", "thanh", "thu", "thuy", "tuan", "vinh")
#: Families that bear a given name before it counts as a name of its own, not as a slip.
ESTABLISHED = 3
FILLERS = ("the", "of", "and", "for", "a", "in", "de", "la", "und", "et")


@dataclass(frozen=True)
class Lists:
    """The reference lists of the rules. ``many``: nodes of one family and given
    name from which on they meet by their middle names; ``least``: least score of
    a rewriting that is kept."""

    nicknames: dict[str, str] = field(default_factory=lambda: NICKNAMES)
    legal_forms: dict[str, str] = field(default_factory=lambda: LEGAL_FORMS)
    countries: dict[str, str] = field(default_factory=lambda: COUNTRIES)
    bodies: tuple[str, ...] = BODIES
    given_names: tuple[str, ...] = GIVEN_NAMES
    many: int = 50
    least: float = 0.2


def _lookup(table: dict[str, str]) -> dict[str, str]:
    full: dict[str, str] = {}
    for name, shorts in table.items():
        for short in shorts.split():
            full.setdefault(short, name)
    return full


def _mapped(word: Column, table: dict[str, str]) -> Column:
    literal = F.create_map(*(F.lit(x) for kv in sorted(table.items()) for x in kv))
    return F.coalesce(F.element_at(literal, word), word)


def _letters(x: Column) -> Column:
    return F.array_sort(F.split(x, ""))


def one_slip(a: Column, b: Column) -> Column:
    """Whether two words are equal or a single slip apart (two in long words)."""
    d = F.levenshtein(a, b, 2)
    swapped = (d == 2) & (F.length(a) == F.length(b)) & (_letters(a) == _letters(b))
    return d.between(0, 1) | swapped | ((d == 2) & (F.least(F.length(a), F.length(b)) >= 9))


def slips(word: Column) -> Column:
    """The word itself and the word with each letter left out once."""
    n = F.length(word)
    shorter = F.transform(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), lambda i: F.concat(F.substring(word, F.lit(1), i - 1), F.substring(word, i + 1, n)))
    return F.array_distinct(F.concat(F.array(word), shorter))


def rewritings(word: Column) -> Column:
    """What a word has in common with every other that ``one_slip`` accepts: at
    least one of these strings, marked by their kind.

    One slip is undone by leaving a letter out, swapped letters by sorting them,
    two slips by leaving two letters out. In words of more than 18 letters those
    two leave the last letters alike or the first with one slip at most; words of
    16 more have more of both in common.
    """
    n = F.length(word)
    none = F.array().cast("array<string>")
    marked = lambda kind, xs: F.transform(xs, lambda x: F.concat(F.lit(kind), x))
    twice = F.flatten(F.transform(slips(F.when(n <= 18, word)), lambda x: slips(x)))
    ends = lambda k: F.concat(marked(f"{k}<", slips(F.substring(word, 1, k))), F.array(F.concat(F.lit(f"{k}>"), F.right(word, F.lit(k)))))
    parts = (marked("1", slips(word)), F.array(F.concat(F.lit("="), F.array_join(_letters(word), ""))), F.when(n.between(9, 18), marked("2", twice)).otherwise(none))
    return F.array_distinct(F.concat(*parts, F.when(n.between(17, 34), ends(8)).otherwise(none), F.when(n >= 33, ends(16)).otherwise(none)))


def _tokens(text: Column) -> Column:
    return F.filter(F.split(F.trim(F.regexp_replace(text, "[^\\p{L}\\p{N}']+", " ")), " "), lambda w: w != "")


# persons ---------------------------------------------------------------------


def parse_persons(names: DataFrame, lists: Lists = Lists()) -> DataFrame:
    """``name`` with ``family``, ``given`` (plain, nicknames undone), ``middle``
    (all further given names) and ``spelt``, the family name with its accents.

    Which end the family name stands at follows from a comma, from initials at
    the end, or from where both words stand in all other names.
    """
    text = F.col("name")
    mixed = text.rlike("\\p{Ll}")
    block = lambda w: mixed & w.rlike("^\\p{Lu}{1,3}$")
    spread = lambda ws: F.flatten(F.transform(ws, lambda w: F.when(block(w), F.filter(F.split(w, ""), lambda c: c != "")).otherwise(F.array(w))))
    head, tail = F.substring_index(text, ",", 1), F.regexp_replace(text, "^[^,]*,?", "")
    comma = text.contains(",")
    rows = names.select("name", comma.alias("comma"), _tokens(head).alias("h0"), F.when(comma, _tokens(tail)).otherwise(F.array().cast("array<string>")).alias("t0"))
    late = ~F.col("comma") & (F.size("h0") >= 2) & block(F.element_at("h0", -1)) & (F.length(F.element_at("h0", 1)) > 1) & ~block(F.element_at("h0", 1))
    fold = lambda ws: F.transform(spread(ws), lambda w: _folded(w))
    rows = rows.where(F.size("h0") > 0).select("name", "comma", late.alias("late"), fold(F.col("h0")).alias("h"), fold(F.col("t0")).alias("t"), F.transform(spread(F.col("h0")), lambda w: F.lower(w)).alias("accented"))
    words_ = F.concat("h", "t")
    body = F.exists(words_, lambda w: w.isin(*lists.bodies))
    rows = staged(rows.withColumn("body", body), "parsed")
    plain = rows.where("not body and not comma and not late and size(h) >= 2")
    # where words stand, over all names: last and before a comma, or elsewhere
    ends = F.transform("h", lambda w, i: F.struct(w.alias("w"), (F.when(i == F.size("h") - 1, 1).otherwise(0)).alias("fam")))
    stands = plain.select(F.explode(ends).alias("x")).select("x.*").unionByName(
        rows.where("comma and not body").select(F.explode(F.concat(F.transform("h", lambda w: F.struct(w.alias("w"), F.lit(1).alias("fam"))), F.transform("t", lambda w: F.struct(w.alias("w"), F.lit(0).alias("fam"))))).alias("x")).select("x.*")
    )
    role = stands.groupBy("w").agg(F.sum("fam").alias("fam"), F.count("*").alias("all"))
    first, last = (role.select(F.col("w").alias(f"w{s}"), F.col("fam").alias(f"fam{s}"), F.col("all").alias(f"all{s}")) for s in "12")
    placed = rows.withColumn("w1", F.element_at("h", 1)).withColumn("w2", F.element_at("h", -1)).join(first, "w1", "left").join(last, "w2", "left")
    # without the name itself; a word seen nowhere else says nothing
    p1 = F.when(F.col("all1") > 1, F.col("fam1") / (F.col("all1") - 1)).otherwise(0.5)
    p2 = F.when(F.col("all2") > 1, (F.col("fam2") - 1) / (F.col("all2") - 1)).otherwise(0.5)
    turned = F.col("late") | ((F.size("h") >= 2) & ~F.col("comma") & (p1 > p2))
    h, t = F.col("h"), F.col("t")
    last_name = lambda ws, all_: F.when(F.col("body"), F.array_join(all_, " ")).when(F.col("comma"), F.array_join(ws, " ")).when(turned, F.element_at(ws, 1)).otherwise(F.element_at(ws, -1))
    given = F.when(F.col("body"), F.array().cast("array<string>")).when(F.col("comma"), t).when(turned, F.slice(h, F.lit(2), F.size(h))).otherwise(F.slice(h, F.lit(1), F.size(h) - 1))
    out = placed.select("name", "body", last_name(h, F.concat(h, t)).alias("family"), last_name(F.col("accented"), F.col("accented")).alias("spelt"), given.alias("g"))
    nick = lambda w: _mapped(w, _lookup(lists.nicknames))
    return out.select("name", "body", "family", "spelt", F.coalesce(nick(F.get("g", F.lit(0))), F.lit("")).alias("given"), F.array_join(F.slice("g", F.lit(2), F.greatest(F.size("g") - 1, F.lit(0))), " ").alias("middle"))


def _clusters(nodes: DataFrame, links: DataFrame) -> DataFrame:
    """``node``, ``cluster`` of all nodes, linked or not."""
    found = components(links, "a", "b")
    return nodes.join(found, "node", "left").select("node", F.coalesce("component", "node").alias("cluster"))


def _meeting(rewritten: DataFrame) -> DataFrame:
    """``a`` < ``b``: nodes that share a rewriting, of (``node``, ``form``).

    Most rewritings belong to one node and end at the count; those of two name
    their pair there, and only those of more are joined.
    """
    rows = staged(rewritten, "forms")
    met = rows.groupBy("form").agg(F.count("*").alias("n"), F.min("node").alias("a"), F.max("node").alias("b")).where("a < b")
    met = staged(met, "met")
    more = staged(rows.join(met.where("n > 2").select("form"), "form"), "many")
    x, y = more.withColumnRenamed("node", "a"), more.withColumnRenamed("node", "b")
    return met.where("n = 2").select("a", "b").unionByName(x.join(y, "form").where("a < b").select("a", "b")).distinct()


def _near(words: DataFrame, word: str) -> DataFrame:
    """``a``, ``b`` in both orders: different words that ``one_slip`` accepts."""
    rows = words.select(F.col(word).alias("node")).distinct()
    met = _meeting(rows.select("node", F.explode(F.transform(rewritings(F.col("node")), lambda x: F.xxhash64(x))).alias("form")))
    met = staged(met.where(one_slip(F.col("a"), F.col("b"))), "near")
    return met.unionByName(met.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _turned_into(rows: DataFrame, near: DataFrame, column: str) -> DataFrame:
    """The rows, and again with ``column`` put for each word near it."""
    others = rows.join(broadcast_if_small(near).withColumnRenamed("a", column), column).withColumn(column, F.col("b")).drop("b")
    return rows.unionByName(others)


def _same_names(full: DataFrame, families: DataFrame, givens: DataFrame, many: int) -> DataFrame:
    """``a`` < ``b``: nodes whose family and given names are equal or near.

    Where a family and a given name have more than ``many`` nodes, these meet by
    their first middle names, so far as they can agree; one without a middle
    name meets all.
    """
    rows = full.select("node", "family", "given", F.split("middle", " ")[0].alias("first"))
    hot = broadcast_if_small(rows.groupBy("family", "given").agg(F.count("*").alias("n")).where(F.col("n") > many).drop("n").withColumn("hot", F.lit(True)))
    own = staged(rows.join(hot, ["family", "given"], "left"), "own")
    meant = staged(_turned_into(_turned_into(rows, families, "family"), givens, "given").join(hot, ["family", "given"], "left"), "meant")
    sides = [x.withColumnRenamed("node", side) for x, side in ((meant, "a"), (own, "b"))]
    pairs = sides[0].where("hot is null").drop("first", "hot").join(sides[1].where("hot is null").drop("first", "hot"), ["family", "given"]).where("a < b").select("a", "b")
    first, empty, single = F.col("first"), F.col("first") == "", F.length("first") == 1
    spelt = F.when(F.length("first") >= 4, rewritings(first)).otherwise(F.array(F.concat(F.lit("1"), first)))
    initial = F.substring("first", 1, 1)
    marked = lambda kind, x: F.array(F.concat(F.lit(kind), x))
    asks = F.concat(F.array(F.lit("to none")), F.when(empty, F.array(F.lit("to all"))).otherwise(F.concat(spelt, F.when(single, marked("short ", first)).otherwise(marked("long ", initial)))))
    offers = F.concat(F.array(F.lit("to all")), F.when(empty, F.array(F.lit("to none"))).otherwise(F.concat(spelt, F.when(single, marked("long ", first)).otherwise(marked("short ", initial)))))
    parts = [x.where("hot").select("family", "given", F.col(x.columns[2]), F.explode(F.array_distinct(p)).alias("part")) for x, p in zip(sides, (asks, offers))]
    return pairs.unionByName(parts[0].join(parts[1], ["family", "given", "part"]).where("a < b").select("a", "b").distinct())


def _agree(a: Column, b: Column, lists: Lists) -> Column:
    """Whether two lists of middle names may be one person's: name by name equal,
    an initial of the other, or a slip apart; further names may be missing."""
    listed = lambda w: w.isin(*lists.given_names)
    fits = lambda x, y: (x == y) | ((F.length(x) == 1) & y.startswith(x)) | ((F.length(y) == 1) & x.startswith(y)) | ((F.least(F.length(x), F.length(y)) >= 4) & one_slip(x, y) & ~(listed(x) & listed(y)))
    x, y = F.split(a, " "), F.split(b, " ")
    n = F.least(F.size(x), F.size(y))
    return (a == b) | (a == "") | (b == "") | F.forall(F.zip_with(F.slice(x, F.lit(1), n), F.slice(y, F.lit(1), n), fits), lambda ok: ok)


def _initials(middle: Column) -> Column:
    return F.array_join(F.transform(F.split(middle, " "), lambda w: F.substring(w, 1, 1)), "")


def _with(pairs: DataFrame, nodes: DataFrame, *columns: str) -> DataFrame:
    """The pairs with the named columns of both nodes."""
    side = lambda k: nodes.select(F.col("node").alias(k), *(F.col(c).alias(f"{c}_{k}") for c in columns))
    return pairs.join(side("a"), "a").join(side("b"), "b")


def person_entities(names: DataFrame, lists: Lists = Lists()) -> DataFrame:
    """``name``, ``entity`` of every distinct person name.

    Null names and names without a letter are left out; further columns of
    ``names`` are ignored.
    """
    return person_links(names, lists).where("score > 0.5").select("name", "entity")


def person_links(names: DataFrame, lists: Lists = Lists()) -> DataFrame:
    """``name``, ``entity``, ``score`` of every distinct person name.

    ``score`` is 1 for the entity a name belongs to; a name with an initial
    that fits several entities has a row for each of these, too, with one by
    their number, down to ``least``.
    """
    parsed = parse_persons(names.where("name is not null").select("name").distinct(), lists)
    # names with initials are told apart by their accents, too
    accents = F.when((F.length("given") == 1) & ~F.col("body"), F.col("spelt")).otherwise("")
    parsed = staged(parsed.withColumn("accents", accents).withColumn("node", F.xxhash64("family", "given", "middle", "accents")), "persons")
    nodes = staged(parsed.select("node", "family", "given", "middle", "body", "accents").distinct(), "nodes")
    # a name of one word has no given name, and is no initial
    full = staged(nodes.where("length(given) <> 1 or body"), "full")
    popular = full.groupBy("given").agg(F.count_distinct("family").alias("df"))
    families = staged(_near(nodes, "family"), "families")
    givens = _near(full, "given")
    for s in "ab":
        givens = givens.join(popular.select(F.col("given").alias(s), F.col("df").alias(f"df_{s}")), s)
    # two established given names are two names, however alike, unless one is far rarer
    known_names = sorted({*lists.nicknames, *lists.given_names})
    established = lambda s: (F.col(f"df_{s}") >= ESTABLISHED) | F.col(s).isin(*known_names)
    far_rarer = F.least("df_a", "df_b") * 8 <= F.greatest("df_a", "df_b")
    givens = givens.where(far_rarer | ~(established("a") & established("b"))).select("a", "b")
    pairs = _with(_same_names(full, families, givens, lists.many), full, "middle").where(_agree(F.col("middle_a"), F.col("middle_b"), lists))
    links = staged(pairs.select("a", "b", "middle_a", "middle_b"), "links")
    # a name with fewer or shorter middle names belongs to the only one that has more, if there is only one
    shorter = F.length("middle_a") < F.length("middle_b")
    gap = links.where("middle_a <> middle_b").select(F.when(shorter, F.col("a")).otherwise(F.col("b")).alias("node"), F.when(shorter, F.col("middle_b")).otherwise(F.col("middle_a")).alias("m"))
    spelled = F.when(~F.exists(F.split("m", " "), lambda w: F.length(w) == 1), F.col("m"))
    ends = gap.groupBy("node").agg(F.min(_initials(F.col("m"))).alias("i1"), F.max(_initials(F.col("m"))).alias("i2"), F.min(spelled).alias("m1"), F.max(spelled).alias("m2"))
    torn = ends.where(~F.col("i2").startswith(F.col("i1")) | ~F.coalesce(_agree(F.col("m1"), F.col("m2"), lists), F.lit(True))).select("node")
    links = links.join(torn, F.col("a") == torn["node"], "left_anti").join(torn, F.col("b") == torn["node"], "left_anti")
    clusters = staged(_clusters(full.select("node"), staged(links.select("a", "b"), "links")), "clusters")
    # initials: entities that could be meant, by family name, initial and middle
    # initials; summed before the join, so a common name is a few rows
    short = staged(nodes.where("length(given) = 1 and not body").select("node", "family", F.col("given").alias("g"), "middle", _initials(F.col("middle")).alias("mi"), "accents"), "short")
    known = staged(full.where("not body").join(clusters, "node").select("node", "cluster", "family", F.substring("given", 1, 1).alias("g"), _initials(F.col("middle")).alias("m")), "known")
    reach = lambda by, df: df.groupBy(*by).agg(F.min("cluster").alias("low"), F.max("cluster").alias("high"), F.count_distinct("cluster").alias("n"))
    fits = F.col("mi").startswith(F.col("m")) | F.col("m").startswith(F.col("mi"))
    by_name = short.select("node", "family", "g", "mi").join(reach(["family", "g", "m"], known), ["family", "g"]).where(fits)
    spellings = known.join(parsed.select("node", F.col("spelt").alias("accents")).distinct(), "node")
    by_accent = short.select("node", "family", "g", "mi", "accents").join(reach(["family", "g", "m", "accents"], spellings), ["family", "g", "accents"]).where(fits)
    whole = lambda df, k, c: df.where(c).groupBy("node").agg(F.min("low").alias(f"{k}_min"), F.max("high").alias(f"{k}_max"), F.sum("n").alias(f"{k}_n"))
    # the only entity in reach, or the only one with the middle initials, or with the accents
    exact = whole(by_name, "n", F.lit(True)).join(whole(by_name, "m", (F.col("m") == F.col("mi")) & (F.col("m") != "")), "node", "left").join(whole(by_accent, "a", F.lit(True)), "node", "left")
    exact = staged(exact, "initials")
    only_one = [F.when(F.col(f"{k}_min") == F.col(f"{k}_max"), F.col(f"{k}_min")) for k in "nma"]
    sure = exact.select("node", F.coalesce(*only_one).alias("cluster")).where("cluster is not null")
    # the same through a slip in the family name, where none is spelt alike
    left = short.join(exact.select("node"), "node", "left_anti").withColumnRenamed("family", "a")
    near = left.join(broadcast_if_small(families), "a").withColumnRenamed("b", "family").select("node", "family", "g", "mi").join(reach(["family", "g", "m"], known), ["family", "g"]).where(fits)
    near = staged(near.select("node", "family", "g", "m", "low", "high", "n"), "near")
    only_near = near.groupBy("node").agg(F.min("low").alias("cluster"), F.max("high").alias("_high")).where("cluster = _high").select("node", "cluster")
    sure = staged(sure.unionByName(only_near), "sure")
    alone = short.join(sure.select("node"), "node", "left_anti")
    # initials that fit no full name: with and without the middle initial
    alone = alone.withColumn("base", F.xxhash64("family", "g", "middle"))
    bare = alone.where("middle = ''").select("base", "family", "g").distinct()
    more = alone.where("middle <> ''").groupBy("family", "g").agg(F.min("base").alias("m1"), F.max("base").alias("m2")).where("m1 = m2").select("family", "g", "m1")
    only = bare.join(more, ["family", "g"]).select("base", "m1")
    rest = alone.join(only, "base", "left").select("node", F.coalesce("m1", "base").alias("cluster"))
    entity = clusters.unionByName(sure).unionByName(rest).withColumn("score", F.lit(1.0))
    # ambiguous initials, as far as their rewriting is rare enough to say anything: an entity
    # counts once, however many middle names it has; more than enough of one middle name are enough
    could = by_name.select("node", "family", "g", "m", "n").unionByName(near.select("node", "family", "g", "m", "n")).join(sure.select("node"), "node", "left_anti")
    could = staged(could, "could")
    few = could.groupBy("node").agg(F.max("n").alias("n")).where(F.col("n") * lists.least <= 1).select("node")
    could = staged(could.drop("n").join(few, "node").join(known.select("cluster", "family", "g", "m").distinct(), ["family", "g", "m"]).select("node", "cluster").distinct(), "could")
    shared = could.groupBy("node").agg(F.count("*").alias("n")).where(F.col("n") * lists.least <= 1).select("node", (1.0 / F.col("n")).alias("score"))
    could = could.join(shared, "node")
    return parsed.join(entity.unionByName(could), "node").select("name", F.col("cluster").alias("entity"), F.round("score", 6).alias("score"))


# organisations ---------------------------------------------------------------


def parse_organisations(names: DataFrame, lists: Lists = Lists()) -> DataFrame:
    """``name`` with ``place`` (the words that are no legal form, subject or
    country), ``form`` (the others in order of the alphabet) and ``country``."""
    text = F.regexp_replace(_folded(F.col("name")), "\\([^)]*\\)", " ")
    text = F.regexp_replace(text, "\\bviet\\s+nam\\b", "vietnam")
    # "for" that ends a part, or has a full stop, is forestry
    text = F.regexp_replace(text, "\\bfor\\.|\\bfor(?=\\s*(?:,|-|$))", "forestry")
    text = F.regexp_replace(F.regexp_replace(text, "\\bnat\\.?(?=\\s+sci)", "natural"), "\\bnat\\b\\.?", "national")
    # short words that are a filler but for one slip are fillers, too
    astray = lambda w: (F.length(w) <= 3) & F.exists(F.array(*map(F.lit, ("of", "for", "and", "the"))), lambda x: (F.levenshtein(w, x) <= 1) | (_letters(w) == _letters(x)))
    spelt = sorted({*lists.legal_forms, *lists.countries, *_lookup(lists.legal_forms), *_lookup(lists.countries)})
    words_ = F.filter(_tokens(text), lambda w: w.isin(*spelt) | ~(w.isin(*FILLERS) | (F.length(w) == 1) | astray(w)))
    shorts = _lookup(lists.legal_forms) | _lookup(lists.countries)
    terms = sorted({*lists.legal_forms, *lists.countries})
    listed = F.array(*(F.lit(t) for t in spelt))

    def snapped(w: Column) -> Column:
        """A misspelt term put right."""
        near = F.filter(listed, lambda t: ((F.length(t) >= 7) & one_slip(w, t)) | ((F.length(t) >= 4) & (F.levenshtein(w, t, 1) >= 0)) | ((F.length(t) >= 5) & one_slip(w, t)) | ((F.length(w) == F.length(t)) & (_letters(w) == _letters(t))))
        return F.coalesce(F.get(near, F.lit(0)), w)

    full = F.transform(words_, lambda w: _mapped(F.when(w.isin(*spelt), w).otherwise(snapped(w)), shorts))
    rows = staged(names.select("name", F.array_distinct(full).alias("w")), "organisations")
    place = F.array_join(F.array_sort(F.filter("w", lambda w: ~w.isin(*terms))), " ")
    form = F.array_join(F.array_sort(F.filter("w", lambda w: w.isin(*sorted(lists.legal_forms)))), " ")
    country = F.coalesce(F.get(F.filter("w", lambda w: w.isin(*sorted(lists.countries))), F.lit(0)), F.lit(""))
    return rows.select("name", place.alias("place"), form.alias("form"), country.alias("country"))


def organisation_entities(names: DataFrame, lists: Lists = Lists()) -> DataFrame:
    """``name``, ``entity`` of every distinct organisation name; null names are
    left out, further columns of ``names`` are ignored."""
    parsed = staged(parse_organisations(names.where("name is not null").select("name").distinct(), lists), "organisations")
    node = F.xxhash64("place", "form", "country")
    nodes = parsed.select("place", "form", "country").distinct().withColumn("node", node)
    nodes = staged(nodes, "nodes")
    met = _meeting(nodes.select("node", F.explode(F.transform(rewritings(F.col("place")), lambda p: F.xxhash64(p, "form"))).alias("form")))
    pairs = _with(met, nodes, "place", "country").where(one_slip(F.col("place_a"), F.col("place_b")))
    pairs = staged(pairs.where("country_a = country_b or country_a = '' or country_b = ''").select(F.col("a").alias("node_a"), F.col("b").alias("node_b"), "country_a", "country_b"), "pairs")
    # a name without its country belongs to the only country in reach
    gap = pairs.where("(country_a = '') <> (country_b = '')").select(F.when(F.col("country_a") == "", F.col("node_a")).otherwise(F.col("node_b")).alias("node"), F.greatest("country_a", "country_b").alias("c"))
    torn = gap.groupBy("node").agg(F.min("c").alias("c1"), F.max("c").alias("c2")).where("c1 <> c2").select("node")
    links = pairs.join(torn, F.col("node_a") == torn["node"], "left_anti").join(torn, F.col("node_b") == torn["node"], "left_anti")
    clusters = _clusters(nodes.select("node"), staged(links.select(F.col("node_a").alias("a"), F.col("node_b").alias("b")), "links"))
    return parsed.withColumn("node", node).join(clusters, "node").select("name", F.col("cluster").alias("entity"))


def variant_pairs(entities: DataFrame) -> DataFrame:
    """``name_a`` < ``name_b`` by code point, of all pairs within an entity.

    The pairs are the result asked for; an entity has as many as its spellings.
    """
    rows = staged(entities, "entities")
    a, b = (rows.select("entity", F.col("name").alias(f"name_{s}")) for s in "ab")
    return a.join(b, "entity").where("name_a < name_b").select("name_a", "name_b")


def scored_pairs(links: DataFrame) -> DataFrame:
    """``name_a`` < ``name_b`` by code point, ``score``: the pairs within an
    entity, and each ambiguous name with the first spelling of every entity it
    may mean, by the rarity of what they share."""
    rows = staged(links, "links")
    sure = rows.where("score > 0.5")
    least = sure.groupBy("entity").agg(F.min("name").alias("first"))
    open_ = rows.where("score <= 0.5").join(least, "entity").where("name <> first")
    open_ = open_.select(F.least("name", "first").alias("name_a"), F.greatest("name", "first").alias("name_b"), "score")
    return variant_pairs(sure.select("name", "entity")).withColumn("score", F.lit(1.0)).unionByName(open_)
