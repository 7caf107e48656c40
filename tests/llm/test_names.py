import random

import pytest

from catalink.llm.canonical_names import match_names
from catalink.llm.linking import Linkage, link, members, records
from catalink.llm.name_variants import Lists, organisation_entities, parse_persons, person_entities, person_links, scored_pairs, variant_pairs

REFERENCE = ["Advances in Orchard Thermodynamics", "Journal of Saline Pedology", "Journal of Alpine Pedology and Optics", "Archives of Loess Seismology", "Proceedings of Volcanic Pedology"]


def mapped(frame, names, reference=REFERENCE):
    ref = frame([(i, n) for i, n in enumerate(reference, 1)] + [(None, "x"), (99, None)], "ref_id long, canonical_name string")
    return {r["name"]: r["ref_id"] for r in match_names(frame([(n,) for n in names], "name string"), ref).collect()}


CASES = {
    "Advances in Orchard Thermodynamics": 1,
    "  ADVANCES  in orchard_thermodynamics. ": 1,
    "The Advances in Orchard Thermodynamics (Online)": 1,
    "Advances in Orchard Thermodynamics, Nine Rivers Press": 1,
    "Adva. Orch. Thermod.": 1,
    "ADVA ORCH THERMOD": 1,
    "Adva-Orch-Thermod": 1,
    "Advacnes in Orchrad Thermodynamics": 1,
    "Advances Orchard Thermodynamics": 1,
    "Advances oof Orchard Thermodynamics": 1,
    "Journal of Saline Pedology": 2,
    "J Sali Pedo": 2,
    "Journal of Salin Pedology": 2,
    "Journal of Alpine Pedology": 0,
    "Journal of Alpine Pedology &amp; Optics": 3,
    "Proceedings of Volcanic Zoology": 0,
    "Archives of Loess Seismolgy": 4,
    "Something else": 0,
    "...": 0,
    "x" * 50_000: 0,
}


def test_canonical_names(frame):
    got = mapped(frame, [*CASES, *CASES, " ", "", None], [*REFERENCE, "Letters on Zoology"])
    assert got == {n: (0 if n == "Proceedings of Volcanic Zoology" else r) for n, r in CASES.items()}


def test_canonical_names_of_nothing(frame):
    assert mapped(frame, []) == {}
    assert mapped(frame, ["a"], []) == {"a": 0}


def pairs(frame, entities, names):
    got = variant_pairs(entities(frame([(n,) for n in names], "name string"))).collect()
    return sorted((r["name_a"], r["name_b"]) for r in got)


def closed(*groups):
    return sorted((a, b) for g in groups for a in g for b in g if a < b)


def test_persons(frame):
    a = ["Robert Kim Dofamelun", "Dofamelun, Robert Kim", "DOFAMELUN, Bob", "R. K. Dofamelun", "Dofamelun RK", "Robert Dofamelun", "Robert Kim Dofamelum", "Robret Kim Dofamelun", "Robert-Kim Dofamelün"]
    b = ["Minh Cotucaibe", "Cotucaibe Minh"]
    c = ["Binh Cotucaibe"]
    d = ["Edward Flelasta", "Ellen Flelasta", "E. Flelasta"]  # the initial fits two
    e = ["Cedric Plustuvo", "Cyril Plüstuvo", "C. Plüstuvo"]  # the accent decides
    others = [f"{g} Family{x}" for g in ("Minh", "Binh", "Robert", "Edward") for x in "abcdefghijkl"]
    got = pairs(frame, person_entities, [*a, *b, *c, *d, *e, *others, *a])
    assert [p for p in got if "Family" not in p[0] + p[1]] == closed(a, b, e[1:])
    assert not [p for p in got if p[0].split()[0] != p[1].split()[0] and "Family" in p[0]]


def test_rare_given_names_with_a_slip(frame):
    slips = ["Penelope Krudrisivo", "Penellope Krudrisivo"]
    apart = ["Binh Cotucaibe", "Minh Cotucaibe", *(f"{g} {f}" for g in ("Marit", "Margit") for f in ("Fanesele", "Huson", "Lodar"))]
    assert pairs(frame, person_entities, slips + apart) == closed(slips)


def test_person_parts(frame):
    df = parse_persons(frame([("Lee, Ann Bo",), ("Ann Bo Lee",), ("Lee AB",), ("Bob Lee",), (".",)], "name string"))
    got = {r["name"]: (r["family"], r["given"], r["middle"]) for r in df.collect()}
    assert got["Lee, Ann Bo"] == got["Ann Bo Lee"] == ("lee", "ann", "bo")
    assert got["Lee AB"] == ("lee", "a", "b") and got["Bob Lee"] == ("lee", "robert", "") and "." not in got


def test_all_given_names_count(frame):
    apart = ["Smith, John Michael", "Smith, John Mark", "Nguyen, Thi Thu Ha", "Nguyen, Thi Thu Lan", "Nguyen, Thi Thu Mai", "Smith, John"]
    same = ["Lopez, Ana Maria del Carmen Sofia Teresa Ines", "Lopez, Ana M. del C. S. T. I.", "Lopez, Ana Maria del Carmen Sofia Teresa Inés"]
    assert pairs(frame, person_entities, apart + same) == closed(same)


def test_common_rewritings_are_parted(frame):
    people = [f"Nguyen, {g} {m}" for g in ("Thiago", "Theresia", "Thorben", "Tabitha", "Tabita") for m in ("", "Karl", "Kim", "Lena")] + ["Nguyen, Thorbn Karl", "Nguyn, Thiago Kim", "Nguyen, T. Kim"]
    plain = pairs(frame, person_entities, people)
    assert pairs(frame, lambda df: person_entities(df, Lists(many=1)), people) == plain and len(plain) >= 4


def test_scores(frame):
    names = ["Edward Flelasta", "Ellen Flelasta", "E. Flelasta", "Zed Brukano", "Z. Brukano"]
    rows = scored_pairs(person_links(frame([(n,) for n in names], "name string"))).collect()
    assert sorted((r["name_a"], r["name_b"], r["score"]) for r in rows) == [("E. Flelasta", "Edward Flelasta", 0.5), ("E. Flelasta", "Ellen Flelasta", 0.5), ("Z. Brukano", "Zed Brukano", 1.0)]
    lists = Lists(nicknames={"edward": "nedko"})
    assert pairs(frame, lambda df: person_entities(df, lists), ["Nedko Flelasta", "Edward Flelasta"]) == [("Edward Flelasta", "Nedko Flelasta")]


def test_organisations(frame):
    a = ["Kekegahes University of Agriculture, Vietnam", "Kekegahes Univ. of Agric., Viet Nam", "Agriculture University, Kekegahes, Vietnam", "The Kekegahes University of Agriculture Vietnam", "KEKEGAHES UNIV AGR, VIETNAM", "Kekegahs Univeristy of Agriculture, Vietnam", "Univ. of Agriculture, Kekegahes", "Kékegahes University of Agriculture (KUA), Vietnam"]
    b = ["Kekegahes University of Medicine, Vietnam"]
    c = ["Stadiv Coll. of For., Spain", "Stadiv College of Forestry, España"]
    d = ["Zokra Academy of Medicine, Japan", "Zokra Academy of Medicine, Norway", "Zokra Academy of Medicine"]  # two countries in reach
    assert pairs(frame, organisation_entities, [*a, *b, *c, *d, *b]) == closed(a, c)


@pytest.mark.parametrize("entities", [person_entities, organisation_entities])
def test_no_names(frame, entities):
    assert pairs(frame, entities, []) == []
    assert pairs(frame, entities, ["One Name", "z" * 3000]) == []


SIDE = "id long, title string, journal string, year string, doi string, author string, volume string, number string, pages string"
ALL = dict(key="id", title="title", journal="journal", year="year", doi="doi", authors="author", volume="volume", issue="number", page="pages")


def linked(frame, left, right, rule=Linkage()):
    return sorted((r["l"], r["r"]) for r in link(records(frame(left, SIDE), **ALL), records(frame(right, SIDE), **ALL), rule).collect())


@pytest.mark.parametrize("hot", [0, 4, 1_000_000])
def test_linking(frame, hot):
    title = "Residual drainage of clay and gravel in northern terraces: a kriging study"
    base = (title, "Journal of Soils", "2018", "10.1234/abc", "Ann Leedy and Bo Norgat", "12", "3", "100-110")
    right = [
        (1001, *base),
        (1002, "Erratum to: " + title, "Journal of Soils", "2018", None, "Ann Leedy, Bo Norgat", "12", "4", "300-301"),
        (1003, title + ". Part II", "Journal of Soils", "2019", None, "Ann Leedy, Bo Norgat", "13", "3", "100-111"),
        (1004, None, None, None, None, None, None, None, None),
        (1005, "Editorial", "Journal of Soils", "2018", None, "Cy Whitlow", "12", "3", "1-2"),
    ]
    left = [
        (1, title.upper().replace("CLAY", "<i>CLAY</i>"), "J. Soils", "2018", "https://doi.org/10.1234/ABC", "Leedy, A.", "12", "3", "100"),
        (2, "Residual drainge of clay and gravel in northern terraces", "Journal of Soils", None, None, "Ann Leedy", "12", None, "100-110"),
        (3, "Erratum to: " + title, "Journal of Soils", "2018", None, "Ann Leedy", "12", "4", "300"),
        (4, title + ". Part II.", "Journal of Soils", "2019", "10.9999/wrong", "Ann Leedy", "13", "3", "100"),
        (5, None, None, None, "10.1234/abc", None, None, None, None),
        (6, "Editorial", "Journal of Soils", "2018", None, "Dee Marlow", "12", "3", "7-9"),
        (7, "", "", "", "", "", "", "", ""),
        (1, title.upper(), "J. Soils", "2018", "https://doi.org/10.1234/ABC", "Leedy, A.", "12", "3", "100"),
    ]
    assert linked(frame, left, right, Linkage(hot=hot)) == [(1, 1001), (2, 1001), (3, 1002), (4, 1003), (5, 1001)]


def test_linking_of_nothing(frame):
    assert linked(frame, [], [(1, "t", None, None, None, None, None, None, None)]) == []


def test_general_titles(frame):
    people = ["Krumholt", "Baxendale", "Osterwig", "Fennimore", "Zdrojewski", "Quillash", "Tamberlin", "Huxtrave"]
    some = lambda key, k, who: (key, "Preface to the special issue", f"Notes of {who}", str(1980 + k), None, f"A. {who}", str(k), None, str(k * 10 + 1))
    left = [some(i, i, people[i]) for i in range(8)]
    right = [some(i + 1000, i + 20, people[i - 1]) for i in range(8)] + [some(2003, 3, people[3])]
    assert linked(frame, left, right) == [(3, 2003)]


def test_one_publication_of_many_records(frame):
    title = "Residual drainage of clay and gravel in northern terraces"
    bare = lambda key, year: (key, title, None, year, None, None, None, None, None)
    for n in (5, 6, 40):
        for hot in (0, 10**9):
            assert linked(frame, [bare(i, "2018") for i in range(n)], [bare(1000, "2018")], Linkage(hot=hot)) == [(i, 1000) for i in range(n)]
    # not quite alike, so no copies of one node
    left = [(i, title + ("", "s", " x", " y", " z", ".", " w")[i], None, "2018", None, None, str(i), None, None) for i in range(7)]
    assert linked(frame, left, [bare(1000, "2018")]) == linked(frame, left, [bare(1000, "2018")], Linkage(hot=0)) == [(i, 1000) for i in range(7)]


def test_hot_keys_lose_nothing(frame):
    rng = random.Random(5)
    words = ["clay", "gravel", "drainage", "terrace", "kriging", "sorption", "creep", "mangrove", "seagrass", "titration"]
    people = ["Krumholt", "Baxendale", "Osterwig", "Fennimore"]

    def some(key, k):
        r = random.Random(k)
        title = "Long term monitoring of northern " + " ".join(r.choices(words, k=6))
        row = [title, "Journal of " + r.choice(words), str(2000 + r.randrange(9)), f"10.1234/{k}" if r.random() < 0.3 else None, f"A. {r.choice(people)}", str(r.randrange(40)), None, str(r.randrange(300))]
        return (key, *(None if rng.random() < 0.25 and c else x for c, x in enumerate(row)))

    left, right = [some(i, i % 40) for i in range(80)], [some(1000 + i, i) for i in range(60)]
    plain = linked(frame, left, right, Linkage(hot=10**9))
    assert linked(frame, left, right, Linkage(hot=0)) == plain and len(plain) >= 70
    rows = members(records(frame(left, SIDE), **ALL), records(frame(right, SIDE), **ALL)).collect()
    entity = {(r["side"], r["id"]): r["entity"] for r in rows}
    assert all(entity["l", a] == entity["r", b] for a, b in plain) and len(rows) == len({a for a, _ in plain}) + len({b for _, b in plain})


def test_all_that_one_slip_accepts_meets(frame):
    from pyspark.sql import functions as F

    from catalink.llm.name_variants import one_slip, rewritings

    rng = random.Random(3)
    words = ["", "ab", "Krudrisivo", "marit", "cotucaibe", "q" * 18, "bcdefghijklmnopqrs", "international survey", "a panel of the northern terraces", "group of orchard thermodynamics and seismology"]
    letters = "abcdefghijklmnopqrstuvwxyz"

    def slipped(w):
        i = rng.randrange(len(w) + 1)
        return rng.choice([w[:i] + rng.choice(letters) + w[i:], w[:i] + w[i + 1 :], w[:i] + rng.choice(letters) + w[i + 1 :]])

    pool = {(w, slipped(slipped(w))) for w in words for _ in range(60)} | {(w, w[:i] + w[j] + w[i + 1 : j] + w[i] + w[j + 1 :]) for w in words for j in range(len(w)) for i in range(j)}
    rows = frame(sorted(pool), "a string, b string").where(one_slip(F.col("a"), F.col("b")))
    assert rows.count() > 300
    assert rows.where(~F.arrays_overlap(rewritings(F.col("a")), rewritings(F.col("b")))).collect() == []


def test_slips_in_both_names(frame):
    # two slips in a long family name, a slip at the start of the given name, letters swapped across others, names of one word
    for same in (["Robert Dofamelun", "Robert Dovamelum"], ["Ulrika Cotucaibe", "Alrika Cotucabe"], ["Zoran Belnik", "Zoran Bilnek"], ["Dofamelun", "DOFAMELUN"]):
        assert pairs(frame, person_entities, [*same, "Hedwig Palmstrom"]) == closed(sorted(same))


def test_entities_are_counted_once(frame):
    names = [f"{g} {m} Flelasta".replace("  ", " ") for g in ("Edward", "Ellen") for m in ("", "Kim", "K.", "Kim Lee")]
    rows = person_links(frame([(n,) for n in [*names, "E. Flelasta", "E. Flelaste", "E. Flelasto"]], "name string")).collect()
    score = {}
    for r in rows:
        score.setdefault(r["name"], []).append(r["score"])
    # eight spellings of two persons, and slips of them that fit both
    assert all(score[n] == [1.0] for n in names)
    assert all(sorted(score[n]) == [0.5, 0.5, 1.0] for n in ("E. Flelasta", "E. Flelaste", "E. Flelasto"))


def test_many_of_one_name(frame):
    middles = ["", "K", "Karl", "Kral", "Kim", "Lena", "Lema", "Lenna Marie", "L M", "Arl", "Maria", "Aria"]
    people = [f"Nguyen, {g} {m}".strip() for g in ("Thorben", "Thorbn") for m in middles]
    links = lambda many: sorted(map(tuple, person_links(frame([(n,) for n in people], "name string"), Lists(many=many)).collect()))
    assert links(0) == links(10**9)


def scored_and_bound(frame, left, right):
    from pyspark.sql import functions as F

    from catalink.llm.linking import TRAITS, compared, reach, telling, traits

    a, b = (records(frame(x, SIDE), **ALL) for x in (left, right))
    a = a.join(telling(a, b), "title", "left")
    edges = a.select(F.col("id").alias("l")).crossJoin(b.select(F.col("id").alias("r")))
    rough, near = reach()
    sides = [traits(x).select(F.col("id").alias(s), *(F.col(t).alias(f"{t}_{s}") for t in TRAITS)) for x, s in ((a, "l"), (b, "r"))]
    bounds = sides[0].crossJoin(sides[1]).select("l", "r", rough.alias("rough"), near.alias("near"), ((F.col("marks_l") == F.col("marks_r")) | (F.col("sub_l") != F.col("sub_r"))).alias("fits"))
    return compared(edges, a, b).join(bounds, ["l", "r"])


def test_no_score_is_out_of_reach(frame):
    rng = random.Random(11)
    words = ["clay", "gravel", "drainage", "terraces:", "kriging", "sorption", "Erratum to:", "z" * 30, "β", "part ii", "creep", "42"]

    def some(key):
        title = " ".join(rng.choices(words, k=rng.randrange(7)))
        if rng.random() < 0.5:
            title = "Residual drainage of clay: " + title[: rng.randrange(12)]
        row = [title, rng.choice(["J. Soils", "Soils of soil", "Annals of x"]), str(rng.randrange(2000, 2004)), f"10.1/{rng.randrange(3)}", rng.choice(["A. Krumholt", "B. Krumhold", "Cy"]), *(str(rng.randrange(3)) for _ in range(3))]
        return (key, *(None if rng.random() < 0.2 else x for x in row))

    rows = scored_and_bound(frame, [some(i) for i in range(60)], [some(1000 + i) for i in range(60)])
    got = rows.collect()
    assert len(got) > 1000 and all(r["fits"] and r["score"] <= r["near"] + 1e-6 and r["near"] <= r["rough"] + 1e-6 for r in got)


@pytest.mark.parametrize("hot", [1000, 1_000_000])
def test_pairs_of_a_common_ending_are_not_made(frame, hot):
    from catalink.llm.linking import candidates

    rng = random.Random(4)
    opening = ["".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=30)) for _ in range(200)]
    some = lambda key, k, n: (key, f"{opening[k]} hillslopes spectroscopy study", f"Notes of {opening[k][:6]}", str(1800 + k), f"10.1/{n}{k}", f"A. {opening[k][:9]}", str(n + k), None, str(n + k))
    left, right = (records(frame(rows, SIDE), **ALL) for rows in ([some(i, i, 0) for i in range(100)], [some(1000 + i, i + 99, 500) for i in range(100)]))
    edges = candidates(left, right, Linkage(hot=hot)).collect()
    assert (99, 1000) in [(r["l"], r["r"]) for r in edges] and len(edges) < 100
