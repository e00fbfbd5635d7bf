"""Edge cases of the scalar functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tablewright.functions import aggregate as agg
from tablewright.functions import scalar as s


@pytest.fixture
def value(spark):
    one = spark.range(1)

    def run(expr):
        return one.select(expr.alias("v")).first()["v"]

    return run


L = F.lit


def null():
    return F.lit(None).cast("string")


@pytest.mark.parametrize(
    "expr, want",
    [
        (lambda: s.power(L(2.0), 10), 1024.0),
        (lambda: s.mod(L(-7), 3), -1),
        (lambda: s.if_null(null(), "x"), "x"),
        (lambda: s.as_integer(L(2.5)), 3),
        (lambda: s.as_integer(L(-2.5)), -3),
        (lambda: s.floor(L(1e300)), 1e300),
        (lambda: s.ceiling(L(float("inf"))), float("inf")),
        (lambda: s.floor(L(-2.5)), -3.0),
        (lambda: s.as_integer(L("9007199254740993")), 9007199254740993),
        (lambda: s.as_double(L("1.5")), 1.5),
        (lambda: s.as_numeric(L(3)), 3.0),
        (lambda: s.as_character(L(True)), "true"),
        (lambda: s.as_logical(L("TRUE")), True),
        (lambda: s.as_logical(null()), None),
        (lambda: s.as_logical(L(0)), False),
        (lambda: s.as_date(L("2020-02-29")), dt.date(2020, 2, 29)),
        (lambda: s.as_posixct(L("2020-02-29 01:02:03.5")), dt.datetime(2020, 2, 29, 1, 2, 3, 500000)),
        (lambda: s.nchar(L("ñandú")), 5),
        (lambda: s.trimws(L("\t  a b 　\n")), "a b"),
        (lambda: s.paste(L("a"), null(), L("b"), sep="-"), "a-b"),
        (lambda: s.paste0(L("a"), null()), None),
        (lambda: s.substr(L("abcdef"), 2, 4), "bcd"),
        (lambda: s.substr(L("abcdef"), 3, 2), ""),
        (lambda: s.substr(L("abc"), -5, -3), "abc"),
        (lambda: s.substring(L("abcdef"), 4), "def"),
        (lambda: s.substring(L("abcdef"), -2), "ef"),
        (lambda: s.str_detect(L("abc"), "b"), True),
        (lambda: s.str_extract(L("a12b"), r"\d+"), "12"),
        (lambda: s.str_extract(L("a12b"), r"a(\d)"), "1"),
        (lambda: s.str_extract(L("a12b"), r"(?P<n>\d)b"), "2"),
        (lambda: s.str_extract(L("abc"), r"\d+"), None),
        (lambda: s.str_extract(L("abc"), r"(\d)"), None),
        (lambda: s.str_extract(L("a(b"), r"\(b"), "(b"),
        (lambda: s.str_extract(L("a(b"), r"[(]b"), "(b"),
        (lambda: s.str_replace(L("aXbX"), "X", "$1"), "a$1b$1"),
        (lambda: s.str_replace_all(L("ab"), "(a)(b)", r"\2\1"), "ba"),
        (lambda: s.sub("a", "b", L("aaa")), "bbb"),
        (lambda: s.gsub("a", "b", L("aca")), "bcb"),
        (lambda: s.grepl("^a", L("abc")), True),
        (lambda: s.str_trim(L(" a "), "left"), "a "),
        (lambda: s.str_trim(L(" a\n"), "right"), " a"),
        (lambda: s.str_to_title(L("hELLO wORLD-foo_bar")), "Hello World-Foo_Bar"),
        (lambda: s.str_to_title(L("")), ""),
        (lambda: s.str_c(L("a"), L("b")), "ab"),
        (lambda: s.str_length(L("né")), 2),
        (lambda: s.str_sub(L("abcdef")), "abcdef"),
        (lambda: s.str_sub(L("abcdef"), 2, -2), "bcde"),
        (lambda: s.str_sub(L("abcdef"), -3), "def"),
        (lambda: s.str_sub(L("ab"), 3, -1), ""),
        (lambda: s.str_sub(L("ab"), -5, -1), "ab"),
        (lambda: s.ifelse(F.lit(None).cast("boolean"), 1, 2), 2),
        (lambda: s.coalesce(null(), L("z")), "z"),
        (lambda: s.pmax(L(1), L(5), L(3)), 5),
        (lambda: s.pmax(L(1), F.lit(None).cast("int")), None),
        (lambda: s.pmin(L(4), L(2)), 2),
        (lambda: s.pmin(F.lit(None).cast("int"), L(2)), None),
        (lambda: s.log(L(8.0), 2), 3.0),
        (lambda: s.log(L(100.0), 10), 2.0),
        (lambda: s.log10(L(1000.0)), 3.0),
        (lambda: s.log2(L(8.0)), 3.0),
        (lambda: s.round_(L(-2.5)), -3.0),
        (lambda: s.round_(L(1250.0), -2), 1300.0),
        (lambda: s.floor(L(-1.5)), -2.0),
        (lambda: s.ceiling(L(-1.5)), -1.0),
        (lambda: s.tolower(L("ÀB")), "àb"),
        (lambda: s.toupper(L("àb")), "ÀB"),
    ],
)
def test_value(value, expr, want):
    got = value(expr())
    assert got == pytest.approx(want) if isinstance(want, float) else got == want
    assert (got is None) == (want is None)


def test_now(value):
    assert abs((value(s.sys_date()) - dt.datetime.now(dt.timezone.utc).date()).days) <= 1
    assert value(s.sys_time()) is not None


def test_errors(value):
    with pytest.raises(ValueError):
        s.str_trim(L("a"), "middle")
    with pytest.raises(ValueError):
        s.str_extract(L("a"), "(a)(b)")
    with pytest.raises(Exception):
        value(s.as_logical(L("yes")))
    with pytest.raises(Exception):
        value(s.as_integer(L("1.5")))


def test_aggregates_on_nulls_and_single_rows(spark):
    df = spark.createDataFrame([("a", None, 1.0), ("a", True, None), ("b", None, None)], "k string, b boolean, x double")
    out = {
        r["k"]: r
        for r in df.groupBy("k")
        .agg(
            agg.n().alias("n"),
            agg.all_("b").alias("all"),
            agg.any_("b").alias("any"),
            agg.sd("x").alias("sd"),
            agg.n_distinct("x").alias("d"),
            agg.median("x").alias("m"),
        )
        .collect()
    }
    assert (out["a"]["n"], out["a"]["all"], out["a"]["any"], out["a"]["d"], out["a"]["m"]) == (2, True, True, 1, 1.0)
    assert (out["b"]["all"], out["b"]["any"], out["b"]["sd"], out["b"]["d"], out["b"]["m"]) == (None, None, None, 0, None)
    assert out["a"]["sd"] is None
