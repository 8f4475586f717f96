import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from varve.operators import quality as Q
from varve.operators import tables


def results(df, *checks, **kw):
    return [(r.success, r.detail) for r in Q.run_suite(df, Q.Suite("s", checks, **kw)).orderBy("n").collect()]


@pytest.fixture(scope="module")
def df(spark):
    rows = [(1, "a", 1.0, True), (2, None, math.nan, None), (3, "b", None, False), (4, "zzz", 100.0, True)]
    return spark.createDataFrame(rows, "i int, s string, x double, b boolean")


def test_checks(df):
    assert results(df, Q.columns_match(["i", "s", "x", "b"]), Q.columns_match(["s", "i", "x", "b"]))[0] == (True, "columns match")
    assert results(df, Q.columns_match(["s", "i", "x", "b"]))[0][0] is False
    assert results(df, Q.row_count(), Q.row_count(5, 9)) == [(True, "4 rows"), (False, "4 rows")]
    assert results(df, Q.not_null("i"), Q.not_null("s")) == [(True, "0 nulls"), (False, "1 nulls")]
    assert results(df, Q.in_set("s", ["a", "b", "zzz"]), Q.in_set("s", ["a", "b", "zzz"], null_ok=False)) == [(True, "0 unexpected"), (False, "1 unexpected")]
    assert results(df, Q.accepted_values("b", [True, False])) == [(True, "0 unexpected")]
    assert results(df, Q.between("i", 1, 4), Q.between("i", 2, 3)) == [(True, "0 outside 1 to 4"), (False, "2 outside 2 to 3")]
    assert results(df, Q.greater_than("i", 0), Q.greater_than("i", 1)) == [(True, "0 not above 0"), (False, "1 not above 1")]


def test_not_a_number_counts_as_missing(df):
    assert results(df, Q.between("x", 0, 100)) == [(True, "0 outside 0 to 100")]
    assert results(df, Q.between("x", 0, 50, mostly=0.5), Q.between("x", 0, 50, mostly=0.6)) == [(True, "1/2 outliers"), (False, "1/2 outliers")]


def test_mostly_needs_values(spark):
    empty = spark.createDataFrame([(None,)], "x double")
    assert results(empty, Q.between("x", 0, 1, mostly=0.8)) == [(False, "no values")]


def test_missing_columns(df):
    assert results(df, Q.not_null("nope"), Q.not_null("i")) == [(False, "column nope not found"), (True, "0 nulls")]
    assert results(df, Q.not_null("nope"), Q.not_null("i"), skip_missing=True) == [(True, "0 nulls")]


def test_a_broken_check_fails_alone(spark):
    df = spark.createDataFrame([([1], dt.datetime(2024, 1, 1), "5")], "a array<int>, t timestamp, y string")
    got = results(df, Q.between("a", 0, 1), Q.between("y", 0, 9), Q.in_set("t", ["x"]), Q.in_set("y", [5, 6]))
    assert got[0][0] is False and got[0][1].startswith("error")
    assert got[1:] == [(True, "0 outside 0 to 9"), (False, "1 unexpected"), (True, "0 unexpected")]


def test_suite_reads_data_once(spark, df):
    plan = Q.run_suite(df, Q.Suite("s", (Q.row_count(), Q.not_null("i"), Q.between("x", 0, 1))))
    text = spark._jvm.PythonSQLUtils.explainString(plan._jdf.queryExecution(), "simple")
    assert text.count("Scan ExistingRDD") == 1


def test_one_pass_equals_check_by_check(df):
    checks = (Q.row_count(), Q.not_null("s"), Q.in_set("s", ["a"]), Q.between("x", 0, 1), Q.greater_than("i", 2))
    assert results(df, *checks) == [results(df, c)[0] for c in checks]


@pytest.mark.parametrize("passes,percent,success", [(8, 80, True), (7, 80, False), (9, 100, False), (10, 100, True)])
def test_summary(spark, passes, percent, success):
    rows = [("s", i, "e", None, i <= passes, "", 5) for i in range(1, 11)]
    r = Q.summarize(spark.createDataFrame(rows, Q.RESULT), percent).first()
    assert (r.success, r.total_records, r.validations_checked, r.successful_validations, r.failed_validations, r.success_rate) == (success, 5, 10, passes, 10 - passes, passes * 10.0)
    assert r.error is None


def test_no_data_is_a_failure(df):
    report = Q.summarize(Q.run_suite(df.limit(0), Q.Suite("s", (Q.not_null("i"),)))).first()
    assert (report.success, report.error, report.success_rate) == (False, "No data", 100.0)
    nothing = Q.summarize(Q.run_suite(df, Q.Suite("s", (Q.not_null("nope"),), skip_missing=True))).first()
    assert nothing.success is False


def test_no_rows(df):
    assert Q.no_rows(df.where("i > 9"), "s", "t").first().success is True
    assert Q.no_rows(df, "s", "t").first().detail == "4 rows found"


def test_unexpected(df):
    suite = Q.Suite("s", (Q.not_null("i"), Q.in_set("s", ["a"], null_ok=False), Q.in_set("b", [True]), Q.in_set("nope", ["x"])))
    assert sorted(((r.n, r.value) for r in Q.unexpected_rows(df, suite).collect()), key=str) == sorted([(2, None), (2, "b"), (2, "zzz"), (3, "false")], key=str)
    assert Q.unexpected_rows(df, Q.Suite("s", (Q.not_null("i"),))).collect() == []
    assert [r.value for r in Q.unexpected_values(df, "s", ["a"], shown=1).collect()] == ["b"]
    assert [r.value for r in Q.unexpected_values(df, "s", ["a"], shown=None).collect()] == ["b", "zzz"]


def test_counts(df, spark):
    assert sorted(tuple(r) for r in Q.null_counts(df).collect()) == [("b", 1), ("s", 1), ("x", 2)]  # one null, one not-a-number
    twice = df.unionByName(df).unionByName(df.limit(0))
    assert Q.duplicate_count(twice).first().duplicates == 4
    assert Q.duplicate_count(df.limit(0)).first().duplicates == 0
    words = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("c",)], "w string")
    assert [tuple(r) for r in Q.value_counts(words, "w").collect()] == [("b", 2), ("a", 1), ("c", 1)]
    assert [r.value for r in Q.top_values(words, "w", 2).collect()] == ["b", "a"]
    assert tuple(Q.value_range(df, "i").first()) == (1, 4)


def test_profile(spark):
    rows = [("noaa", 2023, "A", "NORMAL"), ("noaa", 2024, "A", None), ("x", 2024, "B", "NORMAL")]
    got = sorted(tuple(r) for r in Q.profile(spark.createDataFrame(rows, "data_source string, year int, city string, weather_alert_type string")).collect())
    assert got == sorted([
        ("records", "rows", "3"), ("data_source", "noaa", "2"), ("data_source", "x", "1"), ("weather_alert_type", "NORMAL", "2"),
        ("year", "min", "2023"), ("year", "max", "2024"), ("top_city", "A", "2"), ("top_city", "B", "1"),
        ("columns", "count", "4"), ("column", "1", "data_source"), ("column", "2", "year"), ("column", "3", "city"), ("column", "4", "weather_alert_type"),
    ])
    plain = sorted(tuple(r) for r in Q.profile(spark.range(3).toDF("z")).collect())
    assert plain == [("column", "1", "z"), ("columns", "count", "1"), ("records", "rows", "3")]


def test_union_and_page(spark):
    a, b = spark.createDataFrame([(1, "x")], "i int, s string"), spark.createDataFrame([(2.5, 2)], "d double, i int")
    assert sorted(map(tuple, tables.union_all([a, b]).collect())) == [(1, "x", None), (2, None, 2.5)]
    df = spark.range(100).toDF("i")
    assert [r.i for r in tables.page(df, F.col("i").desc(), top=3, skip=5).collect()] == [94, 93, 92]
    assert tables.page(df, "i", top=10, skip=98).count() == 2
    for bad in ({"top": 0}, {"top": 10_001}, {"top": 1, "skip": -1}, {"top": 1, "skip": 100_001}):
        with pytest.raises(ValueError):
            tables.page(df, "i", **bad)
    with pytest.raises(TypeError):
        tables.page(df, "i", skip=5)  # unbounded
    with pytest.raises(ValueError):
        tables.page(df, [], top=1)


def test_not_a_number_is_missing(spark):
    df = spark.createDataFrame([(float("nan"), "a"), (1.0, None)], "x double, s string")
    assert {r.column: r.nulls for r in Q.null_counts(df).collect()} == {"x": 1, "s": 1}
    results = Q.run_suite(df, Q.Suite("s", (Q.not_null("x"), Q.not_null("s")))).collect()
    assert [(r.success, r.detail) for r in results] == [(False, "1 nulls"), (False, "1 nulls")]


def test_bounds_may_be_open(spark):
    suite = Q.Suite("s", (Q.row_count(), Q.row_count(1, 2), Q.between("id", 0, None), Q.between("id", None, 3)))
    assert [r.success for r in Q.run_suite(spark.range(12_000_000), suite).orderBy("n").collect()] == [True, False, True, False]


def test_duplicates_by_hash(spark):
    df = spark.createDataFrame([(1, None, "a"), (None, 1, "a"), (1, None, "a"), (None, None, None), (None, None, None), (1, 1, "b")], "x int, y int, s string")
    assert Q.duplicate_count(df).first()[0] == 2


@pytest.mark.parametrize(
    ("kind", "values"),
    [
        ("array<int>", [[1, None], [1], [None, 1], None, []]),
        ("struct<a:int,b:int>", [(1, None), (None, 1), None, (None, None)]),
        ("array<array<int>>", [[[1], [2]], [[1, 2]], [[], [1, 2]], [None, [1, 2]]]),
        ("array<string>", [["1:a", "n"], ["1:a1:n"], ["1:a", None], ["n", "1:a"]]),
        ("array<struct<a:string,b:array<double>>>", [[("x", [0.5])], [("x", [0.5, None])], [("x0.5", [])], [None]]),
        ("map<string,int>", [{"a": 1, "b": 2}, {"a": 1, "b": None}, {"a": 1}, {}]),
    ],
)
def test_nested_rows_that_differ_are_no_duplicates(spark, kind, values):
    rows = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    assert [r.duplicates for r in Q.duplicate_count(rows).collect()] == [0]
    assert [r.duplicates for r in Q.duplicate_count(rows.union(rows)).collect()] == [len(values)]
