import datetime as dt
import time

import numpy as np
import pandas as pd
import pytest

from winnow.operators import charts, frequency, profile


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame([
        (1, 1.0, "a", [1, 2], dt.datetime(2024, 1, 1, 23)), (1, 1.0, "a", [1, 2], dt.datetime(2024, 1, 1, 23)),
        (2, None, None, None, None), (2, None, None, None, None), (3, float("nan"), "b", [1], dt.datetime(2024, 1, 3, 1)),
    ], "i bigint, d double, s string, l array<int>, t timestamp_ntz")


def test_duplicates_include_rows_with_nulls(df, spark):
    assert tuple(profile.duplicate_count(df).first()) == (5, 2)
    assert tuple(profile.duplicate_count(df.filter("false")).first()) == (0, 0)
    # same hash input order, different columns: nulls do not make rows equal
    swapped = spark.createDataFrame([(None, "x"), ("x", None)], "a string, b string")
    assert profile.duplicate_count(swapped).first()["duplicate_rows"] == 0
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (float("nan"),), (None,)], "x double")
    assert profile.duplicate_count(zeros).first()["duplicate_rows"] == 2


def test_hot_copies(spark):
    df = spark.range(9000).selectExpr("IF(id % 3 = 0, 'copy', CAST(id AS STRING)) AS s")
    assert tuple(profile.duplicate_count(df).first()) == (9000, 2999)


def test_duplicates_take_one_shuffle_of_digests(df):
    plan = profile.duplicate_count(df)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and plan.count("Aggregate") == 2


def test_distinct_counts(df, spark):
    got = {r["column"]: r["distinct"] for r in frequency.distinct_counts(df, df.columns).collect()}
    assert got == {"i": 3, "d": 1, "s": 2, "l": 2, "t": 2}
    long = "x" * 500
    texts = spark.createDataFrame([(long + "1",), (long + "2",), (long + "1",), ("y" * 63,), ("y" * 64,)], "s string")
    assert frequency.distinct_counts(texts, ["s"]).first()["distinct"] == 4


def test_frequency_table(df):
    got = {(r["column"], r["value"]): r["count"] for r in frequency.frequency_table(df, ["i", "d", "s"]).collect()}
    assert got == {("i", "1"): 2, ("i", "2"): 2, ("i", "3"): 1, ("d", "1.0"): 2, ("s", "a"): 2, ("s", "b"): 1}
    assert [tuple(r) for r in frequency.value_counts(df, "i", 2).collect()] == [(1, 2), (2, 2)]


def test_quality(df):
    row = profile.quality_scores(df).first()
    assert row["completeness"] == pytest.approx(100 - 9 / 25 * 100)
    assert row["uniqueness"] == 60.0 and row["variability"] == 80.0    # d has one value


def test_describe_equals_the_array_library(spark):
    values = [float(v) for v in np.random.default_rng(1).gamma(2, 3, 501).round(3)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    want = pd.Series(values).describe().round(2)
    row = profile.describe(df).first()
    assert [row[k] for k in ("count", "mean", "std", "min", "p25", "p50", "p75", "max")] == list(want)


def test_correlation(spark):
    rng = np.random.default_rng(2)
    x, y = rng.normal(size=200), rng.normal(size=200)
    rows = [(float(a), float(b) if i % 5 else None, 7) for i, (a, b) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "x double, y double, k int")
    want = pd.DataFrame(rows, columns=["x", "y", "k"]).corr()
    for r in profile.correlation(df).collect():
        w = want.loc[r["x"], r["y"]]
        assert (r["r"] is None) if np.isnan(w) else r["r"] == pytest.approx(w)


def test_correlation_of_many_columns(spark):
    rng = np.random.default_rng(3)
    x = 1e9 + rng.normal(size=(1000, 40)) @ rng.normal(size=(40, 40))
    x[rng.random(x.shape) < 0.1] = np.nan
    x[:, 7] = 1e9
    frame = pd.DataFrame(x, columns=[f"c{i}" for i in range(40)])
    start = time.time()
    got = {(r["x"], r["y"]): r["r"] for r in profile.correlation(spark.createDataFrame(frame)).collect()}
    assert time.time() - start < 10 and len(got) == 1600
    want = frame.corr()
    for (a, b), r in got.items():
        assert r is None if "c7" in (a, b) else r == pytest.approx(want.loc[a, b], abs=1e-6)
    none = profile.correlation(spark.createDataFrame([], "a int, b double")).collect()
    assert len(none) == 4 and all(r["r"] is None for r in none)


def test_days_are_whole_periods(df):
    row = profile.datetime_profile(df).first()
    assert (row["range_days"], row["non_null"], row["null_count"], row["null_pct"]) == (1, 3, 2, 40.0)


def test_samples_and_sizes(df):
    rows = {r["column"]: r for r in profile.column_profile(df, order_by="i").collect()}
    assert rows["d"]["sample"] == "1.0" and rows["l"]["sample"] == "[1,2]"
    assert (rows["i"]["bytes"], rows["s"]["bytes"], rows["l"]["bytes"]) == (40, 3, 20)
    approx = {r["column"]: r["distinct"] for r in profile.column_profile(df, distinct="approx").collect()}
    assert approx["i"] == 3
    facts = {r["metric"]: r["value"] for r in profile.dataset_summary(df, order_by="i").collect()}
    assert facts["total_nulls"] == "9" and facts["null_pct"] == "36.00" and facts["sample:s"] == "a"


def test_statistics_of_an_empty_column(spark):
    df = spark.createDataFrame([(None, None)], "x double, s string")
    assert profile.column_statistics(df, "x").first()["mean"] is None
    assert profile.column_statistics(df, "s").first()["mode"] is None
    assert charts.histogram(df, "x").count() == 0 and charts.density(df, "x").count() == 0
    assert charts.box_stats(df, "x").first()["n"] == 0
    assert charts.ecdf(df, "x").count() == 0 and charts.sorted_series(df, "x").count() == 0
    assert charts.scatter_grid(df, "x", "x").count() == 0


def test_histogram_bins(spark):
    few = spark.createDataFrame([(float(v),) for v in (1, 1, 2, 4)], "x double")
    assert [r["count"] for r in charts.histogram(few, "x").orderBy("bin").collect()] == [2, 1, 1]
    same = spark.createDataFrame([(3.0,)] * 5, "x double")
    assert [(r["lower"], r["count"]) for r in charts.histogram(same, "x").collect()] == [(3.0, 5)]
    many = spark.range(1000).selectExpr("CAST(id AS DOUBLE) AS x")
    rows = charts.histogram(many, "x").orderBy("bin").collect()
    want, edges = np.histogram(np.arange(1000), 30)
    assert [r["count"] for r in rows] == list(want) and rows[0]["median"] == 499.5
    assert charts.histogram(many, "x", charts.BAR_BINS).count() == 20


def test_density_integrates_to_one(spark):
    df = spark.createDataFrame([(float(v),) for v in np.random.default_rng(5).normal(size=2000)], "x double")
    rows = charts.density(df, "x", 200).orderBy("x").collect()
    assert np.trapezoid([r["density"] for r in rows], [r["x"] for r in rows]) == pytest.approx(1, abs=0.02)


def test_monday_is_zero(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1),), (dt.datetime(2024, 1, 7),), (None,)], "t timestamp_ntz")
    assert [tuple(r) for r in charts.time_component_counts(df, "t", "dayofweek").collect()] == [(0, 1), (6, 1)]
    assert [tuple(r) for r in charts.time_component_counts(df, "t", "century").collect()] == [(1, 2)]


def test_scatter_sample_ignores_partitioning(spark):
    df = spark.range(500).selectExpr("id", "CAST(id AS DOUBLE) AS x", "CAST(id % 7 AS DOUBLE) AS y")
    a = charts.scatter_points(df, "x", "y", "id", n=50).collect()
    b = charts.scatter_points(df.repartition(7), "x", "y", "id", n=50).collect()
    assert a == b and len(a) == 50
    assert charts.scatter_points(df, "x", "y", "id", color="y", hover=["x"]).count() == 500
