import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catalink.llm import mixing
from catalink.llm.components import components, union_find
from catalink.llm.survivors import FIELDS, bare_doi, long_rows, survivors, wide


def slow(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent}


@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
@settings(max_examples=200, deadline=None)
def test_union_find(edges):
    u, v = (np.array([e[k] for e in edges], np.int64) for k in (0, 1))
    nodes, roots = union_find(u, v)
    assert dict(zip(nodes.tolist(), roots.tolist())) == slow(edges)


@pytest.mark.parametrize("most", [3, 40, 1_000_000])
def test_components(frame, most):
    rng = random.Random(most)
    chain = [(i, i + 1) for i in range(100, 160)]
    hub = [(500, i) for i in range(501, 600)] + [(i, 999) for i in range(700, 760)]
    edges = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + chain + hub + hub[:5] + [(2000, 2000)]
    rng.shuffle(edges)
    rows = [(a, b, "x") for a, b in edges] + [(None, 1, "x"), (1, None, None)]
    df = frame(rows, "u long, v long, node string").repartition(5)
    got = [tuple(r) for r in components(df, "u", "v", max_edges=most).collect()]
    assert dict(got) == slow(edges) and len(got) == len(dict(got))


def test_components_of_nothing(frame):
    assert components(frame([], "u long, v long"), "u", "v").count() == 0


ISI = "id long, abstract string, keyword string, funding_text string, crawled_at timestamp"


def picked(frame, groups, rows):
    found = survivors(frame(groups, "group_key string, record long"), long_rows(frame(rows, ISI), "id", "crawled_at", F.lit(1.0), FIELDS))
    return {(r["group_key"], r["field_name"]): r["record"] for r in found.collect()}


def test_survivors(frame):
    notice = "This record carries no summary."
    rows = [
        (1, "Full text of it, all of it.", "a; b; a", "Paid by X", None),
        (2, "Full text of ...", '"a", b', "n/a", None),
        (3, notice, "a", None, None),
        (3, notice, "a", None, None),
        (4, "full TEXT of it; all of it", "b | a", "", None),
        *[(i, notice, None, None, None) for i in range(10, 16)],
        (None, "lost", "lost", "lost", None),
    ]
    got = picked(frame, [("d", 1), ("d", 2), ("d", 1), ("e", 1), ("f", 1), ("f", 4), ("g", 10), ("g", 11), (None, 1), ("h", 3), ("h", 99)], rows)
    assert got == {("d", "abstract"): 1, ("d", "funding_text"): 1, ("f", "funding_text"): 1}
    assert picked(frame, [("x", 2), ("x", 3), ("x", 1)], rows)[("x", "keyword")] in (1, 2)
    assert picked(frame, [], rows) == {} and picked(frame, [("d", 1), ("d", 2)], []) == {}


def test_text_of_one_publication_is_no_notice(frame):
    text, notice = "The genuine and full abstract of one publication.", "No summary was supplied for this record, we are sorry to say so."
    copies = [(i, text, None, None, None) for i in range(1, 8)]
    rows = [*copies, (8, "Short one.", None, None, None), *[(i, notice, None, None, None) for i in range(20, 25)], (25, "True one.", None, None, None)]
    groups = [("d", i) for i in (1, 2, 3, 4, 8)] + [("e", i) for i in (4, 5, 6, 7)] + [("n", 20), ("n", 25)]
    got = picked(frame, groups, rows)
    # seven copies in two groups that share a record are one publication; five apart are a notice
    assert got == {("d", "abstract"): 1, ("n", "abstract"): 25}


def test_survivors_ties_and_wide(frame):
    import datetime as dt

    rows = [(1, "same text", None, None, dt.datetime(2020, 1, 1)), (2, "Same Text!", None, None, dt.datetime(2021, 1, 1)), (3, "other one", None, "f" * 100_000, dt.datetime(2022, 1, 1))]
    # two equal contents outvote a later one of the same size
    assert picked(frame, [("d", i) for i in (1, 2, 3)], [r[:1] + (r[1][:9] if r[0] < 3 else "othrtext",) + r[2:] for r in rows])[("d", "abstract")] == 2
    found = survivors(frame([("d", 1), ("d", 3)], "group_key string, record long"), long_rows(frame(rows, ISI), "id", "crawled_at", F.lit(1.0), FIELDS))
    assert wide(found).collect()[0].asDict() == {"group_key": "d", "abstract": 3, "keyword": None, "funding_text": 3}


def test_notices_by_titles_and_authors(frame):
    from catalink.llm.survivors import notices

    rows = [(i, "abstract", c) for c, ids in ((1, (1, 2, 3, 4, 5, 6)), (2, (7, 8)), (3, (9, 10)), (4, (11,)), (5, (12, 13))) for i in ids]
    title = "Residual drainage of clay and gravel in northern terraces"
    about = [(i, title + " " * i, "Ann Leedy") for i in range(1, 6)] + [(6, "Residual drainge of clay, gravel in northern terraces", "B. Norgat"), (7, "Wear of mica", "Cy Whitlow"), (8, title, "Ann Leedy")]
    about += [(9, "Fatigue of silica coatings", "Dee Marlow and Ann Leedy"), (10, title, "Marlow, D. and Leedy, Ann"), (11, "x", None), (12, None, None), (13, "Something else", None)]
    prose = frame(rows, "record long, field_name string, content long")
    found = notices(prose, None, frame(about, "record long, title string, author string"))
    # six records of one publication are none, two unlike ones are, those of one team are not, unknown titles say nothing
    assert [r["content"] for r in found.collect()] == [2]


def test_votes(frame):
    import datetime as dt

    from catalink.llm.survivors import source_trust

    day = lambda y: dt.datetime(y, 1, 1)
    rows = [(1, "The long and full text that one record has.", None, None, day(2016), "x"), (2, "Short text", None, None, day(2018), "x"), (3, "short text.", None, None, day(2018), "x"), (4, "Latest", None, None, day(2020), "y")]
    records = frame(rows, ISI + ", source string")
    groups = frame([("d", 1), ("d", 2), ("d", 3), ("e", 3), ("e", 4)], "group_key string, record long")
    trust = F.when(F.col("source") == "y", 0.1).otherwise(1.0)
    found = survivors(groups, long_rows(records, "id", "crawled_at", trust, FIELDS), None, "votes")
    # two votes beat a longer and a little older text; little trust outweighs two years
    assert {(r["group_key"], r["abstract"]) for r in wide(found).collect()} == {("d", 2), ("e", 3)}
    rated = source_trust(records, "source", F.col("id") < 3)
    assert {(r["source"], r["trust"]) for r in rated.collect()} == {("x", 0.6), ("y", round(1 / 3, 6))}


def test_bare_doi(frame):
    rows = [("https://doi.org/10.1234/AB.c",), ("DOI 10.1234/ab.C.",), (" doi:10.1234/ab.c ",), ("10.",), ("n/a",), ("",), (None,)]
    assert [r[0] for r in frame(rows, "x string").select(bare_doi(F.col("x"))).collect()] == ["10.1234/ab.c"] * 3 + [None] * 4


# mixing ------------------------------------------------------------------------------


@given(st.lists(st.tuples(st.integers(1, 30), st.integers(1, 4)), min_size=1, max_size=6, unique_by=lambda x: x[0]), st.integers(0, 200))
@settings(max_examples=200, deadline=None)
def test_fit_is_nearest(sizes, budget):
    lengths, counts = [n for n, _ in sizes], [c for _, c in sizes]
    taken = mixing.fit(lengths, counts, budget)
    assert all(0 <= t <= c for t, c in zip(taken, counts))
    sums = {0}
    for n, c in sizes:
        sums = {s + n * k for s in sums for k in range(c + 1)}
    total = sum(n * t for n, t in zip(lengths, taken))
    assert abs(total - budget) == min(abs(s - budget) for s in sums)


def test_fit_of_many():
    lengths, counts = list(range(50, 900)), [40] * 850
    taken = mixing.fit(lengths, counts, 9_000_001)
    assert sum(n * t for n, t in zip(lengths, taken)) == 9_000_001 and all(0 <= t <= 40 for t in taken)


def test_fit_of_few_lengths():
    # an equal part of both lengths cannot be completed; ten of one length meet the budget
    assert mixing.fit([60_000, 50_001], [10, 10], 500_010) == [0, 10]
    rng = random.Random(1)
    for _ in range(30):
        lengths = sorted({rng.randint(20_000, 90_000) for _ in range(4)}, reverse=True)
        counts = [rng.randint(1, 6) for _ in lengths]
        sums = {0}
        for n, c in zip(lengths, counts):
            sums = {s + n * k for s in sums for k in range(c + 1)}
        budget = rng.randint(1, max(sums))
        total = sum(n * t for n, t in zip(lengths, mixing.fit(lengths, counts, budget)))
        assert abs(total - budget) == min(abs(s - budget) for s in sums)


def test_fit_of_lengths_with_a_common_divisor():
    lengths, counts = list(range(1800, 100, -2)), [500] * 850
    taken = mixing.fit(lengths, counts, 90_000_001)
    assert sum(n * t for n, t in zip(lengths, taken)) in (90_000_000, 90_000_002)


def test_fit_in_little_memory(monkeypatch):
    monkeypatch.setattr(mixing, "HELD", 0)
    rng = random.Random(8)
    for _ in range(60):
        lengths = sorted({rng.randint(1, 40) for _ in range(5)}, reverse=True)
        counts = [rng.randint(1, 9) for _ in lengths]
        budget = rng.randint(1, sum(n * c for n, c in zip(lengths, counts)))
        taken, got = mixing.nearest(lengths, counts, budget)
        assert sum(n * t for n, t in zip(lengths, taken)) == got and all(0 <= t <= c for t, c in zip(taken, counts))
    # what is rounded off goes to all lengths alike, not to the longest
    taken = mixing._in_proportion(list(range(1000, 0, -1)), [1] * 1000, 250_250)
    assert 0.4 < sum(taken[:500]) / sum(taken) < 0.6


def test_mix(frame):
    rng = random.Random(2)
    rows = [(i, rng.choice("aaabbc"), rng.randint(1, 60)) for i in range(3000)] + [(9001, None, 5), (9002, "z", 5), (9003, "a", 0), (1, "a", 3)]
    lengths = frame(rows, "doc_id long, source string, n_tokens int")
    targets = frame([("a", 0.3, 1), ("b", 0.3, 2), ("c", 0.3, 3), ("none", 0.1, 5)], "source string, target_share double, max_repeats int")
    mix = mixing.mixed(lengths, targets)
    got = [tuple(r) for r in mix.select("doc_id", "source", "n_tokens", "uses").collect()]
    assert len({g[0] for g in got}) == len(got) and {g[1] for g in got} == {"a", "b", "c"}
    assert all(u <= {"a": 1, "b": 2, "c": 3}[s] for _, s, _, u in got)
    share = {r["source"]: r.asDict() for r in mixing.shares(mix, targets).collect()}
    assert share["none"]["tokens"] == 0 and all(abs(share[s]["actual_share"] - 1 / 3) < 1e-3 for s in "abc")
    again = mixing.mixed(lengths.repartition(9), targets)
    assert sorted(got) == sorted(tuple(r) for r in again.select("doc_id", "source", "n_tokens", "uses").collect())
    assert mixing.mixed(lengths.limit(0), targets).count() == 0 and mixing.mixed(lengths, targets.limit(0)).count() == 0
    assert mixing.mixed(lengths, targets, total=1000).agg(F.sum(F.col("uses") * F.col("n_tokens"))).first()[0] == 900


def test_tokens(frame):
    import os

    if not os.path.exists(mixing.DEFAULT_TOKENIZER):
        pytest.skip("no tokenizer files here")
    df = frame([(1, "a", "Hello world"), (2, None, None), (3, "a", ""), (4, "a", "<|endoftext|>")], "doc_id long, source string, text string")
    got = {r["doc_id"]: r["n_tokens"] for r in mixing.token_lengths(df).collect()}
    assert (got[1], got[2], got[3]) == (2, 0, 0) and got[4] > 1
    for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"):
        got = mixing.token_lengths(df, os.path.join(os.path.dirname(mixing.DEFAULT_TOKENIZER), name)).where("doc_id = 1").first()
        assert 2 <= got["n_tokens"] <= 4
