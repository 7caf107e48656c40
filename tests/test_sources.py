import pytest
from pyspark.sql import functions as F

from catalink.operators.linkage import Rules, by_identifiers, matches
from catalink.sources import catalogues as cat
from catalink.sources import tables


def test_jdbc(spark, monkeypatch):
    address = "jdbc:derby:memory:catalogue;create=true"
    monkeypatch.setenv("CATALINK_JDBC_URL", address)
    connection = spark._jvm.java.sql.DriverManager.getConnection(address)
    statement = connection.createStatement()
    statement.execute("create table t (id int, name varchar(20))")
    statement.execute("insert into t values (1, 'a'), (2, 'b'), (70, null)")
    assert sorted(tuple(r) for r in cat.jdbc(spark, "select id, name from t where id > 1").collect()) == [(2, "b"), (70, None)]
    parts = cat.jdbc(spark, "select id, name from t", "ID", (1, 100), 4)
    assert parts.rdd.getNumPartitions() == 4 and parts.count() == 3
    connection.close()


def test_one_record(frame):
    df = frame([(1, True, False, "x"), (1, False, True, "y"), (2, True, False, "z")], "original_id long, is_isi boolean, is_scopus boolean, title string")
    assert [r["title"] for r in cat.by_key(df, 1, False).collect()] == ["y"] and cat.by_key(df, 2, False).isEmpty()


def test_tables_are_appended_or_overwritten(spark, frame, tmp_path):
    path = str(tmp_path / "t")
    df = frame([(1,), (2,)], "id long")
    cat.write_table(df, path)
    cat.write_table(df, path)
    assert spark.read.parquet(path).count() == 4
    cat.write_table(df, path, "overwrite")
    assert spark.read.parquet(path).count() == 2
    with pytest.raises(ValueError):
        cat.write_table(df, path, "ignore")


def test_what_is_staged_goes_with_its_scope(spark, frame):
    import os

    before = tables.staged(frame([(1,)], "id long"), "kept")
    with tables.staging_scope(spark):
        inside = tables.staged(frame([(2,)], "id long"), "gone")
        path = inside.inputFiles()[0].removeprefix("file://")
        assert os.path.exists(path) and inside.count() == 1
    assert not os.path.exists(path) and before.count() == 1


def test_broadcast_only_of_what_is_small(frame):
    df = frame([(i, "x" * 50) for i in range(1000)], "id long, text string")
    hinted = lambda x: "ResolvedHint" in x._jdf.queryExecution().logical().toString() or "UnresolvedHint" in x._jdf.queryExecution().logical().toString()
    assert hinted(tables.broadcast_if_small(df)) and not hinted(tables.broadcast_if_small(df, 10)) and not hinted(tables.broadcast_if_small(df, 10**6, 100))


def test_last_row_of_a_key(frame):
    rows = [(1, 5, "b"), (1, 5, "c"), (1, 3, "z"), (2, None, "n"), (2, 1, "m"), (None, 9, "lost"), (3, 1, "s"), (3, 1, "s")]
    got = tables.one_per_key(frame(rows, "id long, at int, text string"), "id", "at")
    assert sorted(tuple(r) for r in got.collect()) == [(1, 5, "c"), (2, 1, "m"), (3, 1, "s")]


def test_identifiers_decide(frame):
    rows = [("10.1/a", "10.1/a", None, None), ("10.1/a", "10.1/b", "x", "x"), ("10.1/a", None, "1", "2"), ("10.1/a", "n/a", "1x", "1X"), (None, None, None, "1"), ("10.1/a", "10.1/a", "1", "2")]
    got = [r[0] for r in frame(rows, "a string, b string, c string, d string").select(by_identifiers(*map(F.col, "abcd"))).collect()]
    assert got == [True, False, False, None, None, True]
    side = "original_id long, title string, year string, journal string, journal_iso string, doi string, issn string"
    left = frame([(1, "Salt in northern ponds and lakes", None, "A", None, "10.1/a", "1"), (2, "Salt in northern ponds and lakes", None, "A", None, None, "1")], side)
    right = frame([(11, "Salt", None, "B", None, "10.1/a", "2"), (12, "Salt in northern ponds and lakes", None, "A", None, "10.1/b", "1"), (13, "Salt in northern ponds and lakes", None, "A", None, None, "3")], side)
    kinds = {(r["left_id"], r["right_id"]): r["match_type"] for r in matches(left, right, Rules(use_identifiers=True)).collect()}
    assert kinds == {(1, 11): "DUPLICATED", (2, 12): "DUPLICATED"}
