import json

from catalink.operators.nested import flatten_authors, related_tables

AUTHORS = [
    {"first_name": " Ann ", "last_name": "Lee", "organizes": ["X", {"name": "Y", "units": [{"name": "u"}, "v"]}]},
    {"fullName": "Bo", "organization": "Z"},
    {"fullName": "Cy", "organize": None, "organizations": [{"name": "W"}]},
    {"first_name": "D", "last_name": ""},
    {},
]
ROWS = {(1, 0, 0, "Ann Lee"), (1, 1, 0, "X"), (1, 2, 0, "Y"), (1, 2, 1, "u"), (1, 2, 2, "v"), (2, 0, 0, "Bo"), (2, 1, 0, "Z"), (3, 0, 0, "Cy"), (3, 1, 0, "W"), (4, 0, 0, "D")}


def flat(frame, text):
    df = flatten_authors(frame([(1, text)], "id long, j string"), "id", "j")
    return {(r["author_pos"], r["org_pos"], r["unit_pos"], r["label"]) for r in df.collect()}


def test_wrappings(frame):
    for x in (AUTHORS, {"authors": AUTHORS}, {"data": {"count": 1, "authors": AUTHORS}}, json.dumps(AUTHORS), {"records": AUTHORS}, {"a": {"b": AUTHORS}}):
        assert flat(frame, json.dumps(x)) == ROWS


def test_unreadable(frame):
    for text in (None, "", "[]", "{}", "12", "null", '[{"fullName": "x"}', '[{"fullName": "x"}] junk', "[{'fullName': 'x'}]", '"text"', '[1], [2]'):
        assert flat(frame, text) <= {(1, 0, 0, "1"), (1, 0, 0, "2")} and flat(frame, text) == set()


def test_empty_table_long_text_and_levels(frame):
    assert flatten_authors(frame([], "id long, j string"), "id", "j").count() == 0
    many = [{"fullName": f"n{i}", "organize": [{"name": "o", "units": ["u"]}]} for i in range(5000)]
    parts = related_tables(frame([(7, json.dumps(many)), (7, json.dumps(many[:1])), (None, json.dumps(many[:1]))], "id long, j string"), "id", "j")
    assert [parts[k].count() for k in ("authors", "organisations", "units")] == [5002] * 3
