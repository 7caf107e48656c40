import glob
import os
from collections import Counter
from itertools import combinations

import pytest

from catalink.llm import queries as q

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def rows(spark):
    """The rows of a query, each query run once."""
    held = {}

    def of(name):
        if name not in held:
            held[name] = [r.asDict() for r in q.queries()[name](spark, DATA).collect()]
        return held[name]

    return of


@pytest.fixture(scope="module")
def duck():
    import duckdb

    c = duckdb.connect()
    for f in glob.glob(f"{DATA}/*.parquet"):
        c.sql(f"create view {os.path.basename(f)[:-8]} as select * from '{f}'")
    return c


@pytest.mark.parametrize("name", list(q.oracle_sql()))
def test_query_and_sql(rows, duck, name):
    found = duck.sql(q.oracle_sql()[name])
    columns = sorted(found.columns)
    at = [found.columns.index(x) for x in columns]
    got = Counter(tuple(r[c] for c in columns) for r in rows(name))
    assert all(sorted(r) == columns for r in rows(name)) and got == Counter(tuple(r[i] for i in at) for r in found.fetchall()) and got


def grouped(rows, by, value):
    out = {}
    for r in rows:
        out.setdefault(tuple(r[c] for c in by), set()).add(value(r))
    return out


def test_spellings(rows):
    groups = grouped(rows("p5_members"), ("kind", "entity"), lambda r: r["name"])
    pairs = Counter((kind, *p) for (kind, _), names in groups.items() for p in combinations(sorted(names), 2))
    found = Counter((r["kind"], r["name_a"], r["name_b"]) for r in rows("p5_found"))
    assert found == pairs and max(found.values()) == 1
    sure = {(r["name_a"], r["name_b"]) for r in rows("p5_scored") if r["score"] == 1}
    assert sure == {(a, b) for kind, a, b in found if kind == "person"} and all(0.2 <= r["score"] <= 0.5 or r["score"] == 1 for r in rows("p5_scored"))


def test_publications(rows):
    entity = {(r["side"], r["id"]): r["entity"] for r in rows("p7_members")}
    found = [(r["isi_id"], r["scopus_id"]) for r in rows("p7_found")]
    assert len(found) == len(set(found)) > 50 and len(entity) == len(rows("p7_members"))
    assert all(entity["l", a] == entity["r", b] for a, b in found)
    assert {k for k in entity} == {("l", a) for a, _ in found} | {("r", b) for _, b in found}
    assert sorted(found) == sorted((r["isi_id"], r["scopus_id"]) for r in rows("p7_matches")) and all(0.88 < r["confidence"] <= 1 for r in rows("p7_matches"))


def test_linked_publications(rows, duck):
    # recorded links between records with equal titles are all found
    given = duck.sql("select distinct i.id, s.id from isi_documents i join scopus_documents s on s.id = try_cast(trim(i.raw_scopus_id) as bigint) and lower(s.title) = lower(i.title) and s.year = i.year and lower(s.doi) = lower(i.doi)").fetchall()
    assert given and set(given) <= {(r["isi_id"], r["scopus_id"]) for r in rows("p7_found")}


def test_spans(rows):
    rep = {r["doc_id"]: r["rep"] for r in rows("p10_members")}
    linked = {(r["rep_a"], r["rep_b"]) for r in rows("p10_links")}
    assert all(r["passage"] is None for r in rows("p10_links"))
    expected = {(a, b) for a, b in combinations(sorted(rep), 2) if rep[a] == rep[b] or (min(rep[a], rep[b]), max(rep[a], rep[b])) in linked}
    assert {(r["doc_a"], r["doc_b"]) for r in rows("p10_found")} == expected
    of = {r["doc_id"]: r["class_id"] for r in rows("p10_members")}
    assert all(of[a] == of[b] for a, b in expected) and all(c <= d for d, c in of.items())
    ends = Counter(x for pair in linked for x in pair)
    assert all(r["n_links"] == ends[r["rep"]] for r in rows("p10_members"))


def test_mix(rows, duck):
    targets = {s: (share, most) for s, share, most in duck.sql("select source, target_share, max_repeats from mix_targets").fetchall()}
    source = dict(duck.sql("select doc_id, source from documents").fetchall())
    mix = rows("p9_mix")
    assert len({r["doc_id"] for r in mix}) == len(mix) > 0
    assert all(source[r["doc_id"]] == r["source"] and 1 <= r["uses"] <= targets[r["source"]][1] for r in mix)
    tokens = Counter()
    for r in mix:
        tokens[r["source"]] += r["uses"] * r["n_tokens"]
    whole = sum(share for s, (share, _) in targets.items() if tokens[s])
    for r in rows("p9_shares"):
        assert r["tokens"] == tokens[r["source"]] and r["actual_share"] == pytest.approx(tokens[r["source"]] / sum(tokens.values()), abs=1e-6)
        # to the token, as far as whole documents allow
        assert not tokens[r["source"]] or r["actual_share"] == pytest.approx(r["target_share"] / whole, abs=0.02)
