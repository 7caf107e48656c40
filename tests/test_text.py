import pytest
from pyspark.sql import functions as F

from catalink.functions import text as tx


def value(spark, column, x, kind="string"):
    return spark.createDataFrame([(x,)], f"x {kind}").select(column(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize(
    "function, given, expected",
    [
        (tx.clean, "  A \t b\n C ", "a b c"),
        (tx.clean, None, None),
        (tx.clean, "", ""),
        (tx.alnum_key, " Ab-1 é", "ab1"),
        (tx.normalize_issn, "1234567x", "1234-567X"),
        (tx.normalize_issn, "1234-567X", "1234-567X"),
        (tx.normalize_issn, "1234567", None),
        (tx.normalize_issn, None, None),
        (tx.parse_year, "2018", 2018),
        (tx.parse_year, "1599", None),
        (tx.parse_year, " 2018", None),
        (tx.parse_year, "abc", None),
        (tx.parse_year, None, None),
        (tx.article_type, None, "journal"),
        (tx.article_type, "Proceedings Paper", "conference"),
        (tx.article_type, "Article", "journal"),
        (tx.article_type, "Review", "other"),
        (tx.ascii_fold, "Tôn Đức Thắng ụ", "Ton uc Thang u"),
        (tx.remove_diacritics, "đụ ơn", "du on"),
        (tx.is_vietnamese, "đ", True),
        (tx.is_vietnamese, "d", False),
        (tx.is_number, "12.5e3", True),
        (tx.is_number, " 1d ", True),
        (tx.is_number, "1-2", False),
        (tx.is_number, None, False),
        (tx.org_suffix, "Hanoi University, Viet Nam", "vietnam"),
        (tx.org_suffix, "abc def.", "def."),
        (tx.org_suffix, "abc", None),
        (tx.org_suffix, "", None),
        (tx.correct_country, "X, Việt Nam", "X, Vietnam"),
        (tx.slug_base, " Été: A  b!", "ete-a-b"),
        (tx.slug_base, None, ""),
        (tx.is_doi, "10.1/x", True),
        (tx.json_escape, None, '""'),
        (tx.json_escape, 'a"b/c\n\x01', '"a\\"b\\/c\\n\\u0001"'),
        (tx.slug_needed, "add-slug-here", True),
        (tx.slug_needed, None, True),
        (tx.slug_needed, "x", False),
    ],
)
def test_one_value(spark, function, given, expected):
    assert value(spark, function, given) == expected


def test_pages(frame):
    df = frame([("1", "9"), ("1", None)], "a string, b string")
    assert [r[0] for r in df.select(tx.pages(F.col("a"), F.col("b"))).collect()] == ["1-9", None]


def test_name_variants(spark):
    got = value(spark, tx.name_variants, "Nguyen Viet Minh Nghia")
    assert got == ["nghia nguyen viet minh", "n. v. m. nghia", "nghia n. v. m.", "nghia, n.", "n. nghia"]
    assert value(spark, tx.name_variants, "N. Nghia") == []
    assert value(spark, tx.name_variants, None) is None


def test_stop_words_and_count(spark):
    assert value(spark, tx.word_tokens, "The study of Author's Work") == ["study", "author's", "work"]
    assert value(spark, tx.word_tokens, "The Of") == []
    assert value(spark, lambda x: tx.count_char(x, "a"), "banana") == 3


def test_long_text(spark):
    assert len(value(spark, tx.ascii_fold, "é" * 200_000)) == 200_000
