import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from catalink.operators.packed import LAYOUTS, split_values, unpack, unpack_fields


def values(frame, field, text):
    df = frame([(1, text)], f"id long, {field} string")
    return [r["item_value"] for r in unpack(df, "id", field, LAYOUTS[field]).orderBy("pos").collect()]


@pytest.mark.parametrize(
    "field, text, expected",
    [
        ("author", "A B and C D; E F", ["A B", "C D", "E F"]),
        ("author", "Doe, John Q", ["Doe, John Q"]),
        ("author", "A B, C D and Doe, J.", ["A B", "C D", "Doe, J."]),
        ("author", '"Doe, J.", Ann Lee & X Y', ["Doe, J.", "Ann Lee", "X Y"]),
        ("author", '"Survey Team; Phase II" | A B\nC D', ["Survey Team; Phase II", "A B", "C D"]),
        ("author", "A B;", ["A B"]),
        ("keyword", 'a; ; "x, y"; 2,4-z, b', ["a", "x, y", "2,4-z", "b"]),
        ("keyword", '"so-called ""soft"" clays" / b', ['so-called "soft" clays', "b"]),
        ("keyword", "a/b; a/b", ["a/b", "a/b"]),
        ("keyword", 'a; 5" pipe; b', ["a", '5" pipe', "b"]),
        ("cited_references", '[1] A, 1990, X [2] "On x; y", B, 1991', ["A, 1990, X", '"On x; y", B, 1991']),
        ("cited_references", "1. A, 1990\n2. B, 1991", ["A, 1990", "B, 1991"]),
        ("cited_references", "A, 1 | B, 2", ["A, 1", "B, 2"]),
        ("keyword", " ; ;; ", []),
    ],
)
def test_cases(frame, field, text, expected):
    assert values(frame, field, text) == expected
    got = frame([(text,)], "t string").select(split_values(F.col("t"), LAYOUTS[field])).first()[0]
    assert got == expected


def test_null_empty_long_and_clashing_columns(frame):
    long = "; ".join(f"word{i}" for i in range(30_000))
    rows = [(1, None, "p"), (2, "", "q"), (3, "  ", "r"), (4, long, "s"), (None, "x", "t"), (5, "a; a", None)]
    out = unpack(frame(rows, "id long, keyword string, pos string"), "id", "keyword", LAYOUTS["keyword"])
    assert {(r["id"], r["n"]) for r in out.groupBy("id").agg(F.count("*").alias("n")).collect()} == {(4, 30_000), (None, 1), (5, 2)}
    assert out.where("id = 4").agg(F.max("pos")).first()[0] == 30_000


def test_empty_table_and_many_rules(frame):
    empty = frame([], "id long, author string, keyword string, cited_references string")
    assert unpack_fields(empty, "id", LAYOUTS).count() == 0
    df = frame([(1, "a; b"), (2, "a, b")], "id long, keyword string")
    assert unpack(df, "id", "keyword", LAYOUTS["keyword"], max_rules=0).count() == 4  # joined by a shuffle


pieces = st.lists(st.sampled_from(["a", "b c", '"q; r"', '""', ";", ", ", " | ", "\n", "·", "  ", "1,3-x", '"']), max_size=12)


def brute(text):
    parts = text.split('"')
    mark = lambda s, p: re.sub(p, "\x01", s)

    def cut(s, p):
        parts = s.split('"')
        if len(parts) % 2:
            s = '"'.join(mark(x, p) if i % 2 == 0 else x for i, x in enumerate(parts))
        else:
            s = mark(s, p)
        return s.split("\x01")

    out = []
    for x in cut(text, r";|；|\n|\||·|\s/\s"):
        for y in cut(x, r",\s+"):
            y = y.strip()
            if len(y) >= 2 and y[0] == y[-1] == '"' and '"' not in y[1:-1].replace('""', ""):
                y = y[1:-1].replace('""', '"').strip()
            if y:
                out.append(y)
    del parts
    return out


@given(st.lists(pieces, min_size=1, max_size=30))
@settings(max_examples=15, deadline=None)
def test_against_plain_python(frame, texts):
    texts = ["".join(t) for t in texts]
    df = frame(list(enumerate(texts)), "id long, keyword string")
    got = {}
    for r in unpack(df, "id", "keyword", LAYOUTS["keyword"]).orderBy("id", "pos").collect():
        got.setdefault(r["id"], []).append(r["item_value"])
    assert got == {i: brute(t) for i, t in enumerate(texts) if brute(t)}


def test_numbers_part_a_numbered_list_alone(frame):
    texts = ["[1] Salt; water and ice, X, 2001; [2] Mud, Y, 2002;", "[1] One [2] Two; three\n[3] Four | [4] Five", "One; two\nthree | four"]
    expected = [["Salt; water and ice, X, 2001", "Mud, Y, 2002"], ["One", "Two; three", "Four", "Five"], ["One", "two", "three", "four"]]
    df = frame([(i, t) for i, t in enumerate(texts)], "id int, cited_references string")
    rows = unpack(df, "id", "cited_references", LAYOUTS["cited_references"]).orderBy("id", "pos").collect()
    assert [[r["item_value"] for r in rows if r["id"] == i] for i in range(3)] == expected
    assert [r[0] for r in df.orderBy("id").select(split_values(F.col("cited_references"), LAYOUTS["cited_references"])).collect()] == expected
