import math
import random
import re
import unicodedata

import plain
import pytest
from pyspark.sql import functions as F

from catalink.functions.text import STOP_WORDS
from catalink.operators import authors, blocking, canonical, linkage, merge
from catalink.operators.numbering import numbered, ranked
from catalink.operators.slug import slugs, with_suffix
from catalink.sources import catalogues as cat

# candidate join ------------------------------------------------------------------


def brute_top(left, right, k):
    terms = lambda t: [w for w in re.split(r"[^a-z0-9_']+", (t or "").lower()) if w]
    docs = {i: terms(t) for i, t in right if terms(t)}
    n, avg = len(docs), sum(map(len, docs.values())) / max(1, len(docs))
    df = {}
    for ws in docs.values():
        for w in set(ws):
            df[w] = df.get(w, 0) + 1
    out = set()
    for i, t in left:
        scored = []
        for j, ws in docs.items():
            s = sum(math.log(1 + (n - df[w] + 0.5) / (df[w] + 0.5)) * ws.count(w) * 2.2 / (ws.count(w) + 1.2 * (0.25 + 0.75 * len(ws) / avg)) for w in terms(t) if w in ws)
            if s:
                scored.append((-round(s, 6), j))
        out |= {(i, j, r) for r, (_, j) in enumerate(sorted(scored)[:k], 1)}
    return out


@pytest.mark.parametrize("held", [0, 1_000_000])
def test_candidates_are_the_exact_top(frame, held):
    rng = random.Random(4)
    rare = [f"rare{i}" for i in range(40)]
    title = lambda: " ".join(["the", "of"] * rng.randint(0, 2) + rng.sample(rare, rng.randint(0, 3)) + rng.sample(["study", "effect", "soil"], rng.randint(0, 2)))
    left, right = [(i, title()) for i in range(60)] + [(90, None)], [(i, title()) for i in range(100, 250)] + [(300, "")]
    got = blocking.candidates(frame(left, "id long, title string"), frame(right, "id long, title string"), 5, held)
    found = {(r["left_id"], r["right_id"], r["rank"]) for r in got.collect()}
    assert found == brute_top(left, right, 5)


@pytest.mark.parametrize("held", [0, 900, 1_000_000])
def test_candidates_of_few_words_are_not_written(frame, monkeypatch, held):
    """Titles of few words, all of which many share: only the best of each part are written, not all that meet."""
    rng = random.Random(5)
    words = [f"w{i}" for i in range(25)]
    title = lambda: " ".join(["study", "of"] + rng.sample(words, rng.choice([1, 2, 4, 5, 25])) + rng.choices(words, k=rng.choice([0, 1])))
    left, right = [(i, title()) for i in range(80)], [(i, title()) for i in range(1000, 1400)]
    written, write = [], blocking.staged

    def counted(df, label="stage"):
        out = write(df, label)
        written.append(out.count() if {"left_id", "right_id"} <= set(out.columns) else 0)
        return out

    monkeypatch.setattr(blocking, "staged", counted)
    got = blocking.candidates(frame(left, "id long, title string"), frame(right, "id long, title string"), 5, held)
    found = {(r["left_id"], r["right_id"], r["rank"]) for r in got.collect()}
    assert found == brute_top(left, right, 5)
    assert max(written) <= 80 * 5


def test_candidates_of_nothing(frame):
    empty = frame([], "id long, title string")
    assert blocking.candidates(empty, frame([(1, "a")], "id long, title string")).count() == 0
    assert blocking.candidates(frame([(1, "a")], "id long, title string"), empty).count() == 0


# linkage ---------------------------------------------------------------------------


@pytest.mark.parametrize(
    "title_score, journal, title, expected",
    [(1.0, 0.0, "x" * 21, "DUPLICATED"), (1.0, 0.0, "x" * 20, "POSSIBLY"), (0.8, 0.85, "x", "DUPLICATED"), (0.8, 0.84, "x", "POSSIBLY"), (0.7, 1.0, "x", "POSSIBLY"), (0.69, 1.0, "x", None)],
)
def test_classes(frame, title_score, journal, title, expected):
    df = frame([(title_score, journal, title)], "t double, j double, x string")
    assert df.select(linkage.classify(F.col("t"), F.col("j"), F.col("x"))).first()[0] == expected


def test_year_filter_and_outcome(frame):
    df = frame([(None, 2017), (2017, None), (2017, 2018), (2017, 2017)], "a int, b int")
    assert [r[0] for r in df.select(linkage.year_compatible(F.col("a"), F.col("b"))).collect()] == [True, True, False, True]
    found = frame([(1, 10, 1, "POSSIBLY"), (1, 11, 2, "DUPLICATED"), (1, 12, 3, "POSSIBLY"), (2, 10, 1, "POSSIBLY")], "left_id long, right_id long, rank int, match_type string")
    kept = linkage.logged(found)
    assert sorted((r["left_id"], r["right_id"]) for r in kept.collect()) == [(1, 10), (1, 11), (2, 10)]
    left = frame([(1,), (2,), (3,)], "original_id long")
    assert sorted(tuple(r) for r in linkage.outcome(left, kept).select("left_id", "n_logged").collect()) == [(1, 2), (2, 1), (3, 0)]
    assert {r["left_id"]: r["linked_to"] for r in linkage.outcome(left, kept).collect()} == {1: 11, 2: None, 3: None}


SIDE = "original_id long, title string, year string, journal string, journal_iso string, doi string"


def test_matches(frame):
    left = frame([(1, "Effect of salt on the growth of algae", "2018", "Journal of Soils", None, None), (2, None, None, None, None, None), (3, "Another thing altogether", "2018", "J", None, None)], SIDE)
    right = frame([(10, "Effect of salt on the growth of alga", "2018", "J. Soils", None, None), (11, "Effect of salt on the growth of algae", "2017", "Journal of Soils", None, None), (12, "", None, None, None, None)], SIDE)
    got = [tuple(r) for r in linkage.matches(left, right).select("left_id", "right_id", "match_type").collect()]
    assert got == [(1, 10, "DUPLICATED")]
    assert linkage.matches(left.limit(0), right).count() == 0


def test_same_authors_and_comparison(frame):
    df = frame([(["A B", "C D"], ["a b", "c d", "e f"]), (["A B", "C D"], ["a b", "x y"]), ([], ["a"]), (None, ["a"])], "a array<string>, b array<string>")
    assert [r[0] for r in df.select(linkage.same_authors(F.col("a"), F.col("b"))).collect()] == [True, False, False, False]
    a, b = frame([(1, 5), (2, 6), (3, 7)], "left_id long, target long"), frame([(2, 6), (3, 8), (4, 9)], "left_id long, target long")
    assert sorted((r["left_id"], r["status"]) for r in linkage.link_comparison(a, b).collect()) == [(1, "only_given"), (3, "different"), (4, "only_found")]


def test_same_authors_by_name_similarity(frame):
    lists = [
        (["William R. Sun", "Ann Lee"], ["William Rose Sun", "Anna Lee"]),
        (["Ann Maria Lee"], ["Ann Marja Lee"]),
        (["Ann Lee"], ["Bob Lee"]),
        (["Ann Lee", "Bob Fox"], ["Ann Lee", "Anna Lee"]),
        (["Ann Lee", None], ["Anna Lee", None]),
        (["Lý Thị Hòa", "Bob Fox"], ["Ly Thi Hoa", "B Fox", "Carl Ox"]),
        ([], ["Ann Lee"]),
    ]
    got = [r[0] for r in frame(lists, "a array<string>, b array<string>").select(linkage.same_authors(F.col("a"), F.col("b"))).collect()]

    def same(p, q):
        if p is None or q is None:
            return False
        x, y = plain.paired_tokens(plain_tokens(p), plain_tokens(q))
        return p == q or bool(x and y) and plain.lcs_length(x, y) / max(len(x), len(y)) >= 0.6

    def one_by_one(a, b):
        left, met = list(b), 0
        for p in a:
            gone = [q for q in left if same(p, q)]
            met, left = met + len(gone), [q for q in left if not same(p, q)]
        return bool(a and b) and met / min(len(a), len(b)) > 0.8

    assert got == [one_by_one(a, b) for a, b in lists] == [True, True, False, True, False, True, False]


# canonicalisation ------------------------------------------------------------------


def greedy(nodes, score, last_wins):
    made, out = [], {}
    for n in nodes:
        best = None
        for m in made:
            s = score(n, m)
            if s is not None and (best is None or s > best[0] or (last_wins and s == best[0])):
                best = (s, m)
        out[n] = best[1] if best else n
        if not best:
            made.append(n)
    return out


@pytest.mark.parametrize("last_wins", [False, True])
def test_leaders_as_one_by_one(frame, last_wins):
    for seed in range(4):
        rng = random.Random(seed)
        scores = {(i, j): rng.choice([0.9, 0.95, 1.0]) for i in range(25) for j in range(i) if rng.random() < 0.12}
        nodes = frame([(i, i) for i in range(25)], "node long, position long")
        edges = frame([(i, j, 0, s) for (i, j), s in scores.items()], "node long, other long, rank int, score double")
        got = {r["node"]: r["leader"] for r in canonical.leaders(nodes, edges, last_wins).collect()}
        assert got == greedy(range(25), lambda i, j: scores.get((i, j)), last_wins)


def test_leaders_are_no_closure(frame):
    nodes = frame([(1, 1), (2, 2), (3, 3)], "node long, position long")
    edges = frame([(2, 1, 0, 1.0), (3, 2, 0, 1.0)], "node long, other long, rank int, score double")
    assert {r["node"]: r["leader"] for r in canonical.leaders(nodes, edges).collect()} == {1: 1, 2: 1, 3: 3}


def tokens(name):
    return [w for w in re.split(r"[^A-Za-z0-9_']+", name.lower()) if w and w not in STOP_WORDS]


def plain_tokens(name):
    return tokens("".join(c for c in unicodedata.normalize("NFD", name) if c.isascii()))


def test_journals_and_organisations_as_one_by_one(frame):
    rng = random.Random(8)
    words = ["Journal", "J", "Soil", "Soils", "Science", "Sci", "Water", "Wat", "Energy", "Review", "Rev", "Applied"]
    names = list(dict.fromkeys(" ".join(rng.choices(words, k=rng.randint(1, 12))) for _ in range(90)))
    rows = [(i, n, rng.choice([None, None, "1234-5678", "1111-222x", "1111-222X"])) for i, n in enumerate(names)] + [(900, " ", None), (901, None, "1")]
    got = {(r["name"], r["issn"]): (r["leader_name"], r["leader_issn"]) for r in canonical.journals(frame(rows, "position long, name string, issn string")).collect()}

    def score(a, b):
        if a[1] and b[1] and a[1].upper() == b[1].upper():
            return 2.0
        x, y = plain.paired_tokens(tokens(a[0]), tokens(b[0]))
        s = 1.0 if tokens(a[0]) == tokens(b[0]) and x else plain.lcs_length(x, y) / max(len(x), len(y)) if x and y else 0
        return s if s > 0.9 else None

    assert got == greedy([(n, i) for _, n, i in rows[:-2]], score, False)
    parts = ["Hanoi", "Hue", "University", "Univ", "Science", "Sci", "Technology", "Tech"]
    orgs = list(dict.fromkeys(" ".join([*rng.sample(parts, rng.randint(2, 5)), rng.choice(["Vietnam", "Japan"])]) for _ in range(80)))
    got = {r["name"]: r["leader_name"] for r in canonical.organisations(frame(list(enumerate(orgs)), "position long, name string")).collect()}

    def org(a, b):
        s = plain.organisation(a, b, tokens(a), tokens(b))
        return s if s >= 0.95 else None

    assert got == greedy(orgs, org, True)


def test_very_long_names_meet(frame):
    rng = random.Random(9)
    word = lambda: "".join(rng.choices("bcdfghklmnprstvz", k=1) + rng.choices("aeiou", k=1) + rng.choices("bcdfghklmnprstvz", k=rng.randint(3, 6)))
    for n, lost in ((17, 1), (19, 1), (25, 2), (31, 3), (45, 4), (60, 5)):
        whole = [word() for _ in range(n)]
        gone = set(rng.sample(range(n), lost))
        fewer = [w for k, w in enumerate(whole) if k not in gone]
        rows = [(0, " ".join(whole), None), (1, " ".join(fewer), None)]
        made = canonical.journals(frame(rows, "position long, name string, issn string")).where("created").count()
        assert made == 1, n
        swapped = [word() if k in set(rng.sample(range(n - 1), n // 20)) else w for k, w in enumerate(whole)]
        rows = [(0, " ".join([*whole[:4], "extra", "words", *whole[4:]])), (1, " ".join(swapped))]
        score = plain.organisation(rows[1][1], rows[0][1], tokens(rows[1][1]), tokens(rows[0][1]))
        made = canonical.organisations(frame(rows, "position long, name string")).where("created").count()
        assert made == (1 if score >= 0.95 else 2), n


def test_nested_set_and_issn(frame):
    df = frame([(1, "Uncategorized"), (2, "a"), (3, "b")], "id long, name string")
    assert sorted(tuple(r) for r in canonical.nested_set(df).select("id", "_lft", "_rgt").collect())[2] == (3, 5, 6)
    got = canonical.by_issn(frame([(1, "1234-567x"), (2, None)], "record long, issn string"), frame([(7, "1234-567X"), (6, "1234-567X"), (5, None)], "id long, issn string"))
    assert [tuple(r) for r in got.collect()] == [(1, 6)]


def test_nearest_names_as_one_by_one(frame):
    known = ["Advances in Orchard Thermodynamics", "Journal of Soils", "Journal of Soil Science", "Water", "Water Research", ""]
    typed = ["Advanes in Orchard Thermodynamics", "The Journal of Soils", "J. Soils", "Water Reserch", "Journal of Soils", "Xyz", ""]
    got = {r["a"]: (r["id"], r["score"]) for r in canonical.nearest_names(frame([(t,) for t in typed], "a string"), frame(list(enumerate(known)), "id long, b string")).collect()}

    def score(a, b):
        n = max(len(a), len(b))
        return round(1 - plain.edit_distance(a, b) / n, 6) if n else 0.0

    assert got == {t: max(((i, score(t, k)) for i, k in enumerate(known)), key=lambda x: (x[1], -x[0])) for t in typed}
    assert canonical.nearest_names(frame([("a",)], "a string"), frame([], "id long, b string")).count() == 0


def test_bounds_of_names_by_their_letters(frame):
    """What letters allow is never less than the score, and the names left to compare are few."""
    rng = random.Random(6)
    text = lambda n: "".join(rng.choice("abcde é") for _ in range(n))
    known = [text(n) for n in (1, 2, 5, 9, 14, 30, 300)] + [f"International Journal of {text(12)}" for _ in range(300)] + [""]
    typed = known[::7] + [k[:-2] + "x" for k in known[::5]] + [text(n) for n in (1, 3, 20, 280)] + ["", "Int. J."]
    score = lambda a, b: 1 - plain.edit_distance(a, b) / max(len(a), len(b)) if a or b else 0.0
    letters = canonical.Letters(known)
    for t in typed:
        real = [score(t, k) for k in known]
        for bound in (letters.most(t), letters.most_by_twos(t)):
            assert all(m >= v - 1e-6 for m, v in zip(bound, real))
    _, near = canonical._likely(letters, known, typed)
    assert all(max(range(len(known)), key=lambda i: (score(t, known[i]), -i)) in set(own.tolist()) for t, own in zip(typed, near))
    assert sum(len(own) == 1 for own in near) > 60


# numbers and slugs -----------------------------------------------------------------


def test_numbers(frame):
    rng = random.Random(1)
    rows = [(rng.choice(["a", "b", None]), i) for i in range(500)]
    rng.shuffle(rows)
    got = {r["v"]: r["n"] for r in ranked(frame(rows, "g string, v long"), ["g"], ["v"], "n").collect()}
    for g in ("a", "b", None):
        assert [got[v] for v in sorted(v for k, v in rows if k == g)] == list(range(1, sum(k == g for k, _ in rows) + 1))
    assert sorted(r["id"] for r in numbered(frame(rows, "g string, v long"), ["v"], "id", 10).collect()) == list(range(11, 511))
    assert numbered(frame([], "v long"), ["v"]).count() == 0


def one_by_one(rows):
    out = {k: s for k, _, s in rows if s not in (None, "", "add-slug-here")}
    used = set(out.values())
    for k, text, s in sorted(rows):
        if k in out:
            continue
        base = re.sub(r"^-+|-+$", "", re.sub(r"[^a-z0-9]+", "-", (text or "").lower()))[:255]
        slug, n = base, 0
        while slug in used:
            n += 1
            slug = with_suffix(base, n)
        used.add(slug)
        out[k] = slug
    return out


def test_slugs_as_one_by_one(frame):
    rng = random.Random(3)
    rows = [(1, "foo", ""), (2, "foo", None), (3, "foo-1", "add-slug-here"), (4, "x" * 300, ""), (5, "x" * 300, ""), (6, None, ""), (7, "", "")]
    rows += [(i, rng.choice(["bar", "bar 1", "bar 2", "bar-1-1", "Baz!", "baz"]), rng.choice(["", "", "bar-3", None])) for i in range(10, 80)]
    rows = [(k, t, s if s != "bar-3" or k % 7 == 0 else "") for k, t, s in rows]
    seen = False
    fixed = []
    for k, t, s in rows:
        s = "" if s == "bar-3" and seen else s
        seen = seen or s == "bar-3"
        fixed.append((k, t, s))
    got = {r["id"]: r["slug"] for r in slugs(frame(fixed, "id long, t string, slug string"), "id", "t").collect()}
    assert got == one_by_one(fixed)
    assert (got[1], got[2], got[3]) == ("foo", "foo-1", "foo-1-1") and got[5] == "x" * 253 + "-1" and len(set(got.values())) == len(got)
    assert slugs(frame([], "id long, t string, slug string"), "id", "t").count() == 0


# merge, sources, authors -----------------------------------------------------------


def test_merge_log_and_sentinel(frame):
    found = frame([(1, 50, "POSSIBLY", 0.75, None), (2, 50, "DUPLICATED", None, None)], "left_id long, right_id long, match_type string, title_score double, journal_score double")
    merged = frame([(9, 50)], "id long, raw_scopus_id long")
    got = {r["isi_id"]: r.asDict() for r in merge.merge_log(found, merged).collect()}
    assert (got[1]["duplication_of"], got[1]["possible_duplication_of"], got[1]["is_merged"]) == (None, 9, False)
    assert (got[2]["duplication_of"], got[2]["is_merged"], got[2]["title_score"]) == (9, True, None)
    df = merge.with_sentinel(frame([(2, "a")], "id long, name string"))
    assert sorted(tuple(r) for r in df.collect()) == [(1, "Uncategorized"), (2, "a")]


def test_missing_ids_and_resume(frame):
    df = frame([(1,), (2,), (5,), (5,), (None,)], "id long")
    for buckets in (1, 2, 1000):
        assert sorted(r[0] for r in cat.missing_ids(df, "id", buckets).collect()) == [0, 3, 4]
    assert cat.missing_ids(df.limit(0), "id").count() == 0
    assert cat.resume_from(df, "id", 2).count() == 3
    with pytest.raises(ValueError):
        cat.resume_from(df, "id", 6)


def test_links_and_author_lists(frame):
    left = frame([(1, "5"), (2, ""), (3, None), (4, " 6 "), (5, "?")], "id long, raw_scopus_id string")
    assert cat.linked(left).count() == 3 and cat.unlinked(left).count() == 1
    assert sorted(tuple(r) for r in merge.given_links(left, frame([(5,), (6,), (7,)], "id long")).collect()) == [(1, 5), (4, 6)]
    docs = frame([(1, "A B and C D", None), (2, "x", '[{"fullName": "Z"}]')], "id long, author string, authors_json string")
    assert sorted(tuple(r) for r in authors.authors(docs, True).collect()) == [(1, 1, "A B"), (1, 2, "C D"), (2, 1, "Z")]
    docs = frame([(1, "A B, C D", "")], "id long, author string, authors_json string")
    assert authors.authors(docs, False).count() == 2


def test_linkage_does_not_depend_on_partitions(frame, spark):
    rng = random.Random(5)
    title = lambda: " ".join(rng.choices(["soil", "salt", "algae", "growth", "water", "effect", "study"], k=5))
    left = frame([(i, title(), None, "J", None, None) for i in range(40)], SIDE)
    right = frame([(i, title(), None, "J", None, None) for i in range(100, 160)], SIDE)
    a, b = (sorted(tuple(r) for r in linkage.logged(linkage.matches(left.repartition(n), right.repartition(n))).collect()) for n in (1, 7))
    assert a == b and a
