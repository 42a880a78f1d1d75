"""Charts: infinite values, bounded curves, even samples, densities per category."""

import math

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from winnow.operators import charts


def test_infinite_values_have_no_bin(spark):
    df = spark.createDataFrame([(float(i), float(-i)) for i in range(10)] + [
        (math.inf, 1.0), (-math.inf, 2.0), (math.nan, 3.0), (None, None), (4.0, math.inf)], "x double, y double")
    bins = charts.histogram(df, "x", 3).orderBy("bin").collect()
    assert [r["lower"] for r in bins] == [0, 3, 6] and sum(r["count"] for r in bins) == 11
    assert all(math.isfinite(r["density"]) for r in charts.density(df, "x").collect())
    assert charts.density(df, "x").count() == 64
    grid = charts.scatter_grid(df, "x", "y", 3, 3).collect()
    assert sum(r["count"] for r in grid) == 10 and {r["bx"] for r in grid} == {0, 1, 2}
    assert [tuple(r) for r in charts.infinite_counts(df, ["x", "y"]).collect()] == [("x", 1, 1), ("y", 0, 1)]
    only = spark.createDataFrame([(math.inf,)], "x double")
    assert charts.histogram(only, "x").count() == charts.density(only, "x").count() == 0
    assert charts.scatter_grid(only, "x", "x").count() == 0


def test_curves_stay_within_their_deviation(spark):
    df = spark.range(5000).select(F.pow(F.col("id") % 1700, F.lit(1.5)).alias("v"), F.when(F.col("id") % 3 == 0, 5.0).otherwise(F.col("id")).alias("hot"))
    for c in ("v", "hot"):
        exact = [(r["value"], r["share"]) for r in charts.ecdf(df, c).orderBy("value").collect()]
        for points in (1, 7, 100, 100_000):
            curve = charts.ecdf_curve(df, c, points).orderBy("value").collect()
            assert 0 < len(curve) <= points and curve[-1]["share"] == 1
            worst = 0.0
            for value, share in exact:
                held = [r for r in curve if r["value"] <= value]
                off = share - (held[-1]["share"] if held else 0)
                assert -1e-12 <= off < 1 / points + 1e-12
                assert not held or off <= held[-1]["deviation"] + 1e-12
                worst = max(worst, off if held else 0)
            assert abs(worst - max(r["deviation"] for r in curve)) < 1e-12
    assert charts.ecdf_curve(df.limit(0), "v").count() == 0


def test_even_samples_do_not_depend_on_partitions(spark):
    df = spark.range(3000).select("id", F.col("id").cast("double").alias("x"), F.lit(1.0).alias("y"), F.when(
        F.col("id") % 3 == 0, "hot").when(F.col("id") % 100 == 1, "rare").when(F.col("id") % 2 == 0, "b").alias("c"))
    a = charts.scatter_even(df.repartition(1), "x", "y", "id", "c", 40).collect()
    b = charts.scatter_even(df.repartition(13), "x", "y", "id", "c", 40).collect()
    assert sorted(map(repr, a)) == sorted(map(repr, b))
    sizes = {r["color"]: r["count"] for r in charts.scatter_even(df, "x", "y", "id", "c", 40).groupBy("color").count().collect()}
    assert sizes == {"hot": 40, "b": 40, None: 40, "rare": df.where("c = 'rare'").count()}


def test_density_by_equals_density_of_each_category(spark):
    df = spark.read.parquet(f"{SF_SMALL}/events.parquet").select("event_type", "value").unionByName(
        spark.createDataFrame([("one", 1.0), ("flat", 2.0), ("flat", 2.0), (None, 3.0)], "event_type string, value double"))
    got = charts.density_by(df, "value", "event_type").collect()
    assert {r["event_type"] for r in got} == {"click", "error", "purchase", "signup", "view"}
    for kind in ("click", "view"):
        want = sorted(tuple(r) for r in charts.density(df.where(F.col("event_type") == kind), "value").collect())
        mine = sorted((r["x"], r["density"]) for r in got if r["event_type"] == kind)
        assert len(mine) == len(want)
        assert all(math.isclose(a, b, rel_tol=1e-9) for x, y in zip(mine, want) for a, b in zip(x, y))
