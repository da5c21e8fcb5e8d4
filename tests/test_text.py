import pytest

from tagweave.functions import params, text
from tests.helpers import one_column

TITLES = {
    "Foo (Deluxe Edition)": "foo",
    "Foo [2011 Remastered]": "foo",
    "Foo (live) bar (deluxe)": "foo",
    "Foo (deluxe) (live)": "foo",
    "Foo Deluxe Edition": "foo deluxe",
    "Foo Edition.": "foo",
    "Version": "version",
    "(Unclean Hands)": "",
    "Conversion Clean": "conversion",
    "Foo (deluxe) live": "foo (deluxe) live",
    "Foo (deluxe": "foo (deluxe",
    "Foo  Remixes": "foo",
    "foo (REMASTER": "foo (remaster",
    None: "",
}


def test_norm(spark):
    values = ["  A \t B\n", None, "", "x  y\u0085", "a\x1cb\x1fc", "ÀÉ"]
    assert one_column(spark, values, text.norm) == ["a b", "", "", "x y", "a b c", "àé"]


def test_strip_keeps_inner_space(spark):
    values = ["　 a  b \x1e", "", "\t\n"]
    assert one_column(spark, values, text.strip) == ["a  b", "", ""]


def test_norm_title(spark):
    assert one_column(spark, list(TITLES), text.norm_title) == list(TITLES.values())


def test_is_variant(spark):
    values = ["Foo", "Foo (Deluxe)", "  Foo  ", "Foo clean"]
    assert one_column(spark, values, text.is_variant_title) == [0, 1, 0, 1]


@pytest.mark.parametrize(
    "query, expected",
    [
        ("OK Computer Deluxe", "ok computer"),
        ("deluxe", ""),
        ("conversion", "conversion"),
        ("clean,remastered;x", ", ;x"),
        ("éclean clean_ clean", "éclean clean_"),
        ("  ", ""),
    ],
)
def test_norm_query(spark, query, expected):
    assert one_column(spark, [query], text.norm_query) == [expected]


def test_limits(spark):
    values = ["abc", "0", "9999", "7", None, " 12 ", "-3", "99999999999999999999", "5.5", "1_0"]
    assert one_column(spark, values, params.recommend_limit) == [
        50, 1, 5000, 7, 50, 12, 1, 5000, 50, 10,
    ]
    assert one_column(spark, ["abc", "99", "-1", "3"], params.suggest_limit) == [10, 50, 1, 3]


def test_query_length_counts_raw_text(spark):
    assert one_column(spark, ["o", "  ", "ok", "", None], params.query_long_enough) == [
        False, True, True, False, False,
    ]
