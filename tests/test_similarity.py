import random

import numpy as np
import plain
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catalink.functions import similarity as sim
from catalink.functions.kernels import Ragged, common_lengths, common_places, edit_distances, nearest_places, numbered_words


short = st.text("abcd", max_size=14)


@given(st.lists(st.tuples(st.text("abcdé ", max_size=150), st.text("abcdé ", max_size=150)), max_size=8))
@settings(max_examples=100, deadline=None)
def test_kernels(pairs):
    a, b = ([p[k] for p in pairs] for k in (0, 1))
    x, y = Ragged.of_texts(a), Ragged.of_texts(b)
    assert common_lengths(x, y).tolist() == [plain.lcs_length(p, q) for p, q in pairs]
    assert edit_distances(x, y).tolist() == [plain.edit_distance(p, q) for p, q in pairs]
    assert [[q[j] for j in common_places(p, q)] for p, q in pairs] == [plain.lcs_string(p, q) for p, q in pairs]


def test_kernels_of_long_texts():
    rng = random.Random(2)
    a, b = ("".join(rng.choices("abcdefgh", k=n)) for n in (2500, 3100))
    assert common_lengths(Ragged.of_texts([a, "x", ""]), Ragged.of_texts([b, "axa", "y"])).tolist() == [plain.lcs_length(a, b), 1, 0]
    long = "".join(rng.choices("abcdefgh", k=60_000))
    assert common_lengths(Ragged.of_texts([long]), Ragged.of_texts([long[100:]])).tolist() == [59_900]


@given(st.lists(st.tuples(short, st.text("abcd", min_size=1, max_size=6)), max_size=6), st.sampled_from([0.2, 0.34, 0.5]))
@settings(max_examples=150, deadline=None)
def test_nearest_places(pairs, error):
    t, p = ([x[k] for x in pairs] for k in (0, 1))
    open_ = np.array([0 if y in x else int(error * len(y)) for x, y in pairs], np.int64)
    place, edits = nearest_places(t, p, open_)
    for x, y, k, d in zip(t, p, place, edits):
        expected = plain.approx_find(x, y, error)
        assert y in x or expected == ((k, pytest.approx(1 - d / len(y))) if k >= 0 else (-1, 0.0))


def test_find_cases(frame):
    rows = [("ABCDEF", "BED"), ("x" * 300 + "a" * 90 + "b" + "a" * 9, "a" * 100), (None, "a"), ("abc", ""), ("", "a")]
    got = [tuple(r[0]) for r in frame(rows, "a string, b string").select(sim.find_approx(F.col("a"), F.col("b"), 0.34)).collect()]
    assert got == [(1, pytest.approx(2 / 3)), (300, pytest.approx(0.99)), (-1, 0.0), (0, 1.0), (-1, 0.0)]


WORDS = ["res", "research", "resear", "journal", "jour", "journals", "abcdefghijk1", "abcdefghijk2", "x", "xy", "fundstatistik", "c++", "c+"]
lists = st.lists(st.sampled_from(WORDS), max_size=7)


@given(st.lists(st.tuples(lists, lists), max_size=8))
@settings(max_examples=150, deadline=None)
def test_numbered_words(pairs):
    x, y = numbered_words([p for p, _ in pairs], [q for _, q in pairs])

    def in_order(a, b):
        seen = {}
        return [seen.setdefault(v, len(seen)) for v in [*a, *b]]

    for k, (p, q) in enumerate(pairs):
        assert in_order(x[k], y[k]) == in_order(*plain.paired_tokens(p, q))


def test_batches_of_words(frame):
    rng = random.Random(4)
    rows = [(rng.choices(WORDS, k=rng.randint(0, 7)), rng.choices(WORDS, k=rng.randint(0, 7))) for _ in range(400)] + [(None, ["x"]), (["x"], None)]
    rows += [(x, x) for x, _ in rows[:20]]
    df = frame([(i, *r) for i, r in enumerate(rows)], "i int, a array<string>, b array<string>")
    got = df.select("i", *(f(F.col("a"), F.col("b")).alias(n) for n, f in (("lcs", sim._token_lcs), ("relaxed", sim._token_lcs_relaxed), ("lev", sim._token_lev), ("threes", sim._token_jaccard), ("prefix", sim._prefix_words)))).orderBy("i").collect()
    for r, (a, b) in zip(got, rows):
        prefix = plain.prefix_words(a, b) if a and b else 0.0
        assert tuple(r)[1:] == pytest.approx((plain.token_lcs(a, b), plain.token_lcs_relaxed(a, b), plain.token_lev(a, b), plain.token_jaccard(a, b), prefix))
    names = df.where("a is not null and b is not null").select("i", "a", "b", F.array_join("a", " ").alias("p"), F.array_join("b", " ").alias("q"))
    for r in names.select("*", sim._org("p", "q", "a", "b").alias("same"), sim._org_spread("p", "q", "a", "b").alias("spread")).collect():
        assert (r["same"], r["spread"]) == pytest.approx((plain.organisation(r["p"], r["q"], r["a"], r["b"]), plain.organisation(r["p"], r["q"], r["a"], r["b"], True)))


CASES = [
    ("token_lcs_sim", "Journal of psychosomatic research", "J-Psychosom-Res", 1.0),
    ("token_lcs_sim", "The", "Of", 0.0),
    ("token_lcs_sim", None, "x", 0.0),
    ("token_lcs_sim", "The", "The", 1.0),
    ("token_lcs_sim", "journal jour", "journals", 0.5),
    ("token_lcs_sim_relaxed", "journal jour", "journals", 1.0),
    ("token_lev_sim", "journal jour", "journals", 0.5),
    ("token_jaccard", "a1 b1", "a1 c1", 0.0),
    ("org_name_sim", "Hanoi University of Science, Vietnam", "Hanoi University of Science, China", 0.0),
    ("org_name_sim", "Hanoi, Vietnam", "Hanoi City, Vietnam", 0.0),
    ("org_name_sim", "a1 b1 c1 z1", "a1 b1 c1 d1 e1 f1 g1 z1", 0.0),
    ("org_name_sim", "a1 b1 c1 z1", "a1 b1 c1 d1 e1 f1 z1", 1.0),
    ("lev_sim", "", "", 0.0),
    ("lev_sim", "abc", "abd", 2 / 3),
    ("lev_sim_clean", " ABC ", "abd", 2 / 3),
    ("title_sim", "Été", "ete", 1.0),
    ("title_sim", None, "ete", 0.0),
    ("char_shingle_jaccard", "abcd", "abce", 1 / 3),
    ("char_shingle_jaccard", "ab", "ab", 0.0),
    ("prefix_word_sim", "Digital Libraries 2018", "dig lib", 1.0),
    ("prefix_word_sim", "", "x", 0.0),
]


@pytest.mark.parametrize("name, a, b, expected", CASES)
def test_scores(frame, name, a, b, expected):
    got = frame([(a, b)], "a string, b string").select(getattr(sim, name)(F.col("a"), F.col("b"))).first()[0]
    assert got == pytest.approx(expected)


def test_std_and_person(frame):
    df = frame([("a1 b1 c1 z1", "a1 b1 c1 d1 z1")], "a string, b string")
    assert df.select(sim.org_name_sim(F.col("a"), F.col("b"), "std")).first()[0] == pytest.approx(1.479019945774904)
    assert frame([("Ann Lee", "Anna Lee")], "a string, b string").select(sim.same_person_name(F.col("a"), F.col("b"))).first()[0]


def test_registered_functions(spark):
    assert "lcs_len" in sim.register(spark)
    assert spark.sql("select lcs_len('abcbdab', 'bdcaba') n, approx_find('ABCDEF', 'BED', 0.34D).place p, token_lcs(array('res'), array('research')) t").first() == (4, 1, 1.0)
