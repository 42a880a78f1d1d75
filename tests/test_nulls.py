import datetime as dt

import pytest

from winnow.operators import nulls
from winnow.plans.stages import NullHandler


@pytest.fixture(scope="module")
def df(spark):
    day = dt.datetime(2024, 1, 1)
    return spark.createDataFrame([
        (1, 1.0, "b", True, day, None), (2, None, "a", True, day + dt.timedelta(days=1), None),
        (None, 4.0, None, None, None, None), (5, float("nan"), "a", False, day + dt.timedelta(days=2), None),
        (2, 9.0, "b", True, None, "x"),
    ], "i int, d double, s string, b boolean, t timestamp_ntz, e string")


def test_nan_counts_as_null(df):
    got = {r["column"]: (r["null_count"], r["null_pct"]) for r in nulls.null_profile(df).collect()}
    assert got == {"i": (1, 20.0), "d": (2, 40.0), "s": (1, 20.0), "b": (1, 20.0), "t": (2, 40.0), "e": (4, 80.0)}


def test_percentages_round_half_to_even(spark):
    df = spark.createDataFrame([(None,)] + [(1,)] * 31, "a int")
    assert nulls.null_profile(df).first()["null_pct"] == 3.12    # 3.125
    assert round(8265 / 183416 * 100, 2) == 4.51


def test_distribution_keeps_empty_buckets(df):
    got = {r["bucket"]: r["columns"] for r in nulls.null_distribution(df).collect()}
    assert got == {"0%": 0, "1-10%": 0, "10-50%": 5, ">50%": 1}


def test_threshold_is_strict(df):
    assert nulls.sparse_columns(df, 0.4) == ["e"]
    assert nulls.sparse_columns(df, 0.8) == []
    assert "e" not in nulls.drop_sparse_columns(df, 0.79).columns


def test_mean_and_median(df):
    got = nulls.impute_mean(df, ["d", "i"]).collect()
    assert got[1]["d"] == got[3]["d"] == pytest.approx(14 / 3)
    assert got[2]["i"] == 2.5                      # a fractional fill makes the column double
    got = nulls.impute_median(df, ["d", "i"])
    assert dict(got.dtypes)["i"] == "int" and got.collect()[2]["i"] == 2
    assert got.collect()[1]["d"] == 4.0


def test_columns_without_nulls_keep_their_type(spark):
    df = spark.createDataFrame([(1,), (2,)], "i bigint")
    assert nulls.impute_mean(df).dtypes == [("i", "bigint")]


def test_mode_prefers_the_smallest(df, spark):
    got = nulls.impute_mode(df, ["s", "b", "e", "i"]).collect()
    assert got[2]["s"] == "a" and got[2]["b"] is True and got[0]["e"] == "x" and got[2]["i"] == 2
    numbers = spark.createDataFrame([(10,), (9,), (None,)], "n bigint")
    assert nulls.impute_mode(numbers, ["n"]).collect()[2]["n"] == 9     # by value, not as text


def test_mode_of_nothing(spark):
    df = spark.createDataFrame([(None, None, None)], "n double, s string, t timestamp_ntz")
    assert tuple(nulls.impute_mode(df, ["n", "s", "t"]).first()) == (0.0, "Unknown", None)


def test_dates(df):
    assert nulls.impute_datetime(df, ["t"], "median").collect()[2]["t"] == dt.datetime(2024, 1, 2)
    assert nulls.impute_datetime(df, ["t"], "latest").collect()[2]["t"] == dt.datetime(2024, 1, 3)


def test_median_moment_is_floored(spark):
    a, b = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 1, 0, 0, 0, 3)
    df = spark.createDataFrame([(a,), (b,), (None,)], "t timestamp_ntz")
    assert nulls.impute_datetime(df, ["t"]).collect()[2]["t"] == a + dt.timedelta(microseconds=1)


@pytest.mark.parametrize("strategy, compat, number, moment", [
    ("mean", False, 14 / 3, 3), ("median", False, 4.0, 2), ("most_frequent", False, 1.0, 3),
    ("most_frequent", True, 4.0, 3), ("mean", True, 14 / 3, 3)])
def test_strategies(df, strategy, compat, number, moment):
    model = NullHandler(threshold=0.5, strategy=strategy, compat=compat).fit(df)
    got = model.transform(df).collect()
    assert "e" not in got[0].asDict()
    assert got[1]["d"] == pytest.approx(number)
    assert got[2]["t"] == dt.datetime(2024, 1, moment)
    assert got[2]["s"] == "a" and got[2]["b"] is True
    assert all(v is not None for r in got for v in r)


def test_constant_for_text(df):
    got = NullHandler(threshold=0.9, strategy="median", categoricalImpute="constant").fit(df).transform(df).collect()
    assert got[2]["s"] == "Unknown" and got[0]["e"] == "Unknown"


def test_empty_table_and_nested_columns(spark):
    empty = spark.createDataFrame([], "a double, s string")
    assert nulls.null_profile(empty).collect()[0]["null_pct"] is None
    assert NullHandler().fit(empty).transform(empty).count() == 0
    nested = spark.createDataFrame([([1, 2], 1.0), (None, None)], "a array<int>, x double")
    got = NullHandler().fit(nested).transform(nested).collect()
    assert got[1]["a"] is None and got[1]["x"] == 1.0


def test_unknown_strategy(df):
    with pytest.raises(ValueError):
        nulls.fit_nulls(df, strategy="guess")


def test_rankings(df):
    top = [r["column"] for r in nulls.top_missing(df, 3).collect()]
    assert top == ["e", "d", "t"]
    assert [r["column"] for r in nulls.top_missing(df, 1, ascending=True).collect()] == ["b"]
    assert nulls.top_missing(df, None).count() == 6


def test_reduction(df):
    clean = df.select("i").filter("i is not null")
    assert tuple(nulls.null_reduction(df, clean).first()) == (11, 0, 100.0)
    assert nulls.null_reduction(clean, clean).first()["reduction_pct"] == 100.0
