import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from winnow.operators import charts, quantiles
from winnow.operators.quantiles import grouped_quantiles, running_counts, summarize, value_splits

PROBS = (0.0, 0.1, 0.25, 0.5, 0.75, 0.99, 1.0)


def frame(spark, values, parts=5):
    return spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)


def shapes():
    rng = random.Random(7)
    return {
        "uniform": [rng.random() for _ in range(5000)],
        "heavy tail": [rng.paretovariate(0.5) for _ in range(5000)],
        "one value holds a third": [5.0] * 1700 + [rng.gauss(5, 3) for _ in range(3300)],
        "two values": [0.0, 1.0] * 500,
        "few rows": [3.0, 1.0, 2.0],
        "one row": [4.5],
        "constant": [7.0] * 100,
        "negative and huge": [-1e300, -1.0, 0.0, 1e-300, 1e300] * 20,
    }


@pytest.mark.parametrize("name", list(shapes()))
@pytest.mark.parametrize("limit", [None, 40])
def test_quantiles_equal_brute_force(spark, name, limit, monkeypatch):
    if limit:    # small enough to force brackets to be sketched again
        monkeypatch.setattr(quantiles, "MAX_BRACKET_ROWS", limit)
    values = shapes()[name]
    got, _ = summarize(frame(spark, values), {"x": F.col("x")}, PROBS)
    for p in PROBS:
        assert got["x"].quantiles[p] == pytest.approx(np.quantile(values, p), rel=1e-12)


def test_a_sketch_that_misses_is_caught(spark, monkeypatch):
    values = [float(i) for i in range(4000)]
    monkeypatch.setattr(quantiles._Target, "bracket",
                        lambda self, grid, rank, n: (0.0, 1.0) if self.width == quantiles.BRACKET else (self.lo, self.hi))
    got, _ = summarize(frame(spark, values), {"x": F.col("x")}, (0.5,))
    assert got["x"].quantiles[0.5] == 1999.5


@pytest.mark.parametrize("fill", [-50.0, 0.0, 0.5, 0.9, 99.0])
@pytest.mark.parametrize("share", [0.01, 0.4, 0.9])
def test_statistics_of_a_filled_column(spark, fill, share):
    rng = random.Random(11)
    values = [None if rng.random() < share else rng.random() for _ in range(6000)]
    df = frame(spark, values)
    before = summarize(df, {"x": F.col("x")}, (0.5,))[0]["x"]
    after = before.filled(fill)
    full = [fill if v is None else v for v in values]
    assert (after.count, after.nulls, after.min, after.max) == (6000, 0, min(full), max(full))
    assert after.mean == pytest.approx(np.mean(full)) and after.std == pytest.approx(np.std(full, ddof=1))
    quantiles.settle(df.fillna(fill), {"x": F.col("x")}, {"x": after}, (0.25, 0.5, 0.75), margin=0.012)
    for p in (0.25, 0.5, 0.75):
        assert after.quantiles[p] == pytest.approx(np.quantile(full, p), rel=1e-12)


def test_moments_merge_over_partitions(spark):
    values = [1e9 + v for v in shapes()["uniform"]]
    s = summarize(frame(spark, values, 13), {"x": F.col("x")})[0]["x"]
    assert s.count == 5000 and s.nulls == 0
    assert s.mean == pytest.approx(np.mean(values), rel=1e-15)
    assert s.std == pytest.approx(np.std(values, ddof=1), rel=1e-6)
    assert (s.min, s.max) == (min(values), max(values))


def test_empty_and_all_null(spark):
    df = spark.createDataFrame([(None, 1.0), (None, None)], "a double, b double")
    stats, counts = summarize(df, {"a": F.col("a"), "b": F.col("b")}, (0.5,), counts={"a": F.col("a")})
    assert stats["a"].quantiles[0.5] is None and stats["a"].nulls == 2
    assert stats["b"].quantiles[0.5] == 1.0 and stats["b"].std is None
    assert counts == {"": 2, "a": 0}
    empty, _ = summarize(df.filter("false"), {"b": F.col("b")}, (0.5,))
    assert empty["b"].rows == 0 and empty["b"].quantiles[0.5] is None


def test_estimates_are_close_and_need_one_scan(spark):
    values = shapes()["uniform"]
    s = summarize(frame(spark, values), {"x": F.col("x")}, (0.5,), exact=False)[0]["x"]
    assert abs(np.mean(np.array(values) <= s.quantiles[0.5]) - 0.5) < 0.02


@pytest.mark.parametrize("splits", [None, [], [10.0], [float(i) for i in range(0, 100, 3)]])
@pytest.mark.parametrize("few", [True, False])
def test_grouped_quantiles_equal_brute_force(spark, splits, few):
    rng = random.Random(3)
    rows = [("hot" if i % 3 else f"g{i % 40}", float(rng.randint(0, 60))) for i in range(3000)]
    rows += [("single", 1.5), (None, 3.0), ("gone", None)]
    df = spark.createDataFrame(rows, "k string, x double")
    got = {r["k"]: r for r in grouped_quantiles(df, "k", "x", (0.25, 0.5, 0.9), splits, few).collect()}
    groups = {}
    for k, x in rows:
        if k is not None and x is not None:
            groups.setdefault(k, []).append(x)
    assert set(got) == set(groups)
    for k, xs in groups.items():
        assert got[k]["n"] == len(xs)
        for j, p in enumerate((0.25, 0.5, 0.9)):
            assert got[k][f"q{j}"] == pytest.approx(np.quantile(xs, p))


def test_box_stats_do_not_depend_on_the_way_of_joining(spark, monkeypatch):
    rng = random.Random(9)
    rows = [("hot" if i % 3 else f"g{i % 9}", rng.paretovariate(1)) for i in range(2000)]
    df = spark.createDataFrame(rows, "k string, x double")
    few = sorted(charts.box_stats_by(df, "x", "k").collect())
    monkeypatch.setattr(charts, "FEW_GROUPS", 0)
    assert sorted(charts.box_stats_by(df, "x", "k").collect()) == few
    assert sum(r["outliers"] for r in few) > 0


def test_running_counts_over_ranges(spark):
    values = shapes()["one value holds a third"]
    df = frame(spark, values)
    counted = df.groupBy(F.col("x").alias("value")).agg(F.count(F.lit(1)).alias("n"))
    for splits in ([], value_splits(df, F.col("x"), 16)):
        got = {r["value"]: (r["upto"], r["total"]) for r in running_counts(counted, splits).collect()}
        ordered = np.sort(values)
        assert all(upto == np.searchsorted(ordered, v, "right") for v, (upto, _) in got.items())
        assert {t for _, t in got.values()} == {len(values)}


@pytest.mark.parametrize("points", [1, 2, 7, 100, 10_000])
def test_sorted_series_equals_sorting(spark, points):
    values = [1.0] * 50 + [float(i) for i in range(120)]
    got = charts.sorted_series(frame(spark, values), "x", points).orderBy("position").collect()
    ordered, n = sorted(values), len(values)
    k = min(points, n)
    ranks = [j * (n - 1) // (k - 1) if k > 1 else 0 for j in range(k)]
    assert [r["rank"] for r in got] == ranks
    assert [r["value"] for r in got] == [ordered[i] for i in ranks]
