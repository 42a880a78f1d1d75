import pytest

from winnow.operators import outliers, projection
from winnow.operators.quantiles import Stats
from winnow.plans.stages import OutlierHandler


@pytest.mark.parametrize("q1, q3, lower, upper", [
    (325, 796, -381.5, 1502.5), (1980, 1992, 1962, 2010), (3777, 5502, 1189.5, 8089.5)])
def test_published_bounds(q1, q3, lower, upper):
    s = Stats(10, 10, 0.0, 1e6, 500.0, 9.0, {0.25: float(q1), 0.75: float(q3)})
    b = outliers.bounds_of(s)
    assert (b["lower"], b["upper"], b["method"]) == (lower, upper, "iqr")


def test_published_percentage(spark):
    df = spark.range(175_151).selectExpr("CASE WHEN id < 5782 THEN 1000 ELSE id % 10 END AS x")
    row = outliers.outlier_report(df).first()
    assert (row["outlier_count"], row["outlier_pct"]) == (5782, 3.3)


@pytest.fixture(scope="module")
def df(spark):
    rows = [(i, float(i % 5), 3, None) for i in range(20)] + [(20, 100.0, 3, None), (21, None, 3, None)]
    return spark.createDataFrame(rows, "id int, x double, same int, empty double")


def test_methods(df, spark):
    b = outliers.fit_bounds(df)
    assert b["x"]["method"] == "iqr" and b["same"]["method"] == "no_variation" and "empty" not in b
    assert (b["same"]["lower"], b["same"]["upper"]) == (3, 3)
    spread = spark.range(1003).selectExpr("0.1D + id * 0 AS x").repartition(9)
    constant = outliers.fit_bounds(spread)["x"]
    assert (constant["method"], constant["std"], constant["mean"]) == ("no_variation", 0.0, 0.1)
    spiky = spark.createDataFrame([(0,)] * 99 + [(50,)], "x int")
    s = outliers.fit_bounds(spiky)["x"]
    assert s["method"] == "std" and s["lower"] == pytest.approx(0.5 - 15) and s["upper"] == pytest.approx(15.5)
    one = outliers.fit_bounds(spark.createDataFrame([(4.0,)], "x double"))["x"]
    assert one["method"] == "no_variation" and one["std"] is None


def test_clipping_keeps_nulls_and_types(df, spark):
    b = outliers.fit_bounds(df)
    got = outliers.clip_outliers(df, b)
    assert dict(got.dtypes) == {"id": "int", "x": "double", "same": "int", "empty": "double"}
    rows = got.orderBy("id").collect()
    assert rows[20]["x"] == b["x"]["upper"] and rows[21]["x"] is None
    spiky = spark.createDataFrame([(0,)] * 99 + [(50,)], "x int")
    clipped = outliers.clip_outliers(spiky, outliers.fit_bounds(spiky))
    assert clipped.dtypes == [("x", "double")] and clipped.agg({"x": "max"}).first()[0] == pytest.approx(15.5)


def test_later_values_stay_inside_integer_bounds(spark):
    base = spark.range(101).selectExpr("CAST(id AS SMALLINT) AS x")
    model = OutlierHandler(factor=0.51).fit(base)     # bounds -0.5 and 100.5: nothing lies beyond
    late = spark.createDataFrame([(-30,), (30000,), (7,)], "x int").selectExpr("CAST(x AS SMALLINT) AS x")
    assert [r["x"] for r in model.transform(late).collect()] == [0, 100, 7]
    assert outliers.bounds_of(Stats(1, 1, 5.0, 5.0, 5.0, None, {0.25: 5.0, 0.75: 5.0}))["method"] == "no_variation"


def test_remove_drops_nulls_too(df):
    b = outliers.fit_bounds(df, ["x"])
    assert outliers.remove_outliers(df, b).count() == 20
    assert projection.outside(df, b).count() == 1
    assert projection.outside(df, {}).count() == 0
    assert OutlierHandler(method="remove").fit(df.drop("empty")).transform(df).count() == 20


def test_report(df):
    row = {r["column"]: r for r in outliers.outlier_report(df).collect()}["x"]
    assert (row["outlier_count"], row["outlier_mean"], row["outlier_std"]) == (1, 100.0, None)
    assert (row["normal_count"], row["normal_max"], row["outlier_pct"]) == (20, 4.0, 4.76)
    total = outliers.outlier_summary(df).first()
    assert (total["total_outliers"], total["columns_with_outliers"], total["total_columns_analyzed"]) == (1, 1, 3)


def test_no_numbers(spark):
    df = spark.createDataFrame([("a",)], "s string")
    row = outliers.outlier_summary(df).first()
    assert (row["total_outliers"], row["message"]) == (0, "No numerical columns available")
    assert outliers.iqr_bounds(df).count() == 0
    assert outliers.clip_outliers(df, {}).count() == 1


def test_nan_is_missing(spark):
    df = spark.createDataFrame([(float("nan"),)] + [(float(i),) for i in range(10)], "x double")
    b = outliers.fit_bounds(df)
    assert b["x"]["max"] == 9.0
    assert outliers.outlier_report(df, b).first()["normal_count"] == 10
    assert projection.outside(df, {"x": (0, 9)}).count() == 0
    assert outliers.remove_outliers(df, b).count() == 10


def test_range_change(df):
    b = outliers.fit_bounds(df)
    got = {r["column"]: r["changed"] for r in outliers.range_change(df, outliers.clip_outliers(df, b)).collect()}
    assert got == {"id": False, "x": True, "same": False, "empty": False}
