"""Aggregates behind charts. Drawing is left to the caller."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from winnow.functions.columns import FLOATING, col, has_value, present
from winnow.operators.frequency import distinct_estimates
from winnow.operators.quantiles import (
    FEW_GROUPS, SLOTS, group_estimate, grouped_quantiles, running_counts, summarize, value_splits,
)

# Histogram bins, whisker length, chart row limits.
MAX_BINS = 30
BAR_BINS = 20
WHISKER = 1.5
TIME_UNITS = ("year", "month", "day", "hour", "minute", "dayofweek")
PREVIEW_COLUMNS = 6


def _number(df: DataFrame, name: str) -> Column:
    return present(df, name).cast("double")


def finite(df: DataFrame, *names: str) -> DataFrame:
    """The table with infinite values of some columns as nulls: bins and kernels have no place for them.

    ``infinite_counts`` tells how many there were.
    """
    return df.withColumns({c: F.when(F.abs(col(c)) < math.inf, col(c)) for c in names
                           if isinstance(df.schema[c].dataType, FLOATING)})


def infinite_counts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(column, negative, positive)``: infinite values that histograms, densities and grids leave out."""
    cells = [F.struct(F.lit(c).alias("column"), F.count_if(_number(df, c) == -math.inf).alias("negative"),
                      F.count_if(_number(df, c) == math.inf).alias("positive")) for c in names]
    return df.agg(F.array(*cells).alias("x")).select(F.inline("x"))


def _distinct_up_to(df: DataFrame, name: str, seen: int, limit: int) -> int:
    """min(limit, distinct values). ``seen`` values settle most columns without a scan, an
    estimate settles the other wide ones, and only narrow columns are counted."""
    if seen >= limit:
        return limit
    x = _number(df, name)
    if distinct_estimates(df.select(x.alias("x")), ["x"])["x"] > 2 * limit:
        return limit
    return min(limit, df.filter(has_value(df, name)).select(x.alias("x")).distinct().count())


def histogram(df: DataFrame, name: str, bins: int | None = None) -> DataFrame:
    """Equal-width counts ``(bin, lower, upper, count)`` with the column's mean and median.

    Bins default to min(30, distinct values). The last bin includes the maximum. Empty
    bins are kept. Infinite values are left out, of the mean and median too.
    """
    spark, df = df.sparkSession, finite(df, name)
    s = summarize(df, {name: present(df, name)}, (0.5,))[0][name]
    schema = "bin bigint, lower double, upper double, mean double, median double"
    if s.count == 0:
        return spark.createDataFrame([], schema + ", count bigint")
    if bins is None:
        bins = _distinct_up_to(df, name, s.seen, MAX_BINS)
    width = (s.max - s.min) / bins if s.max > s.min else 1.0
    if s.max == s.min:
        bins = 1
    edges = spark.createDataFrame(
        [(i, s.min + i * width, s.min + (i + 1) * width, s.mean, s.quantiles[0.5]) for i in range(bins)],
        schema)
    counted = df.filter(has_value(df, name)).groupBy(
        _bin(_number(df, name), s.min, width, bins).alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    return F.broadcast(edges).join(counted, "bin", "left").fillna(0, ["count"])


def _bin(x: Column, low: float, width: float, bins: int) -> Column:
    at = F.floor((x - F.lit(low)) / F.lit(width))
    return F.least(F.greatest(at, F.lit(0)), F.lit(bins - 1)).cast("bigint")


def box_stats(df: DataFrame, name: str) -> DataFrame:
    """One row: count, extremes, quartiles, and whiskers at the last values inside the fences."""
    s = summarize(df, {name: present(df, name)}, (0.25, 0.5, 0.75))[0][name]
    schema = "n bigint, min double, q1 double, median double, q3 double, max double"
    row = (s.count, s.min, *[s.quantiles[p] for p in (0.25, 0.5, 0.75)], s.max)
    table = df.sparkSession.createDataFrame([row], schema)
    if s.count == 0:
        empty = F.lit(None).cast("double")
        return table.withColumns({
            "whisker_low": empty, "whisker_high": empty, "outliers": F.lit(0).cast("bigint")})
    q1, q3 = s.quantiles[0.25], s.quantiles[0.75]
    low, high = F.lit(q1 - WHISKER * (q3 - q1)), F.lit(q3 + WHISKER * (q3 - q1))
    x = _number(df, name)
    ends = df.agg(
        F.min(F.when(x >= low, x)).alias("whisker_low"), F.max(F.when(x <= high, x)).alias("whisker_high"),
        F.count(F.when((x < low) | (x > high), x)).alias("outliers"))
    return ends.select(*[F.lit(v).cast(t).alias(c) for v, (c, t) in zip(
        row, (part.split() for part in schema.split(",")))], "*")


def box_stats_by(df: DataFrame, name: str, by: str) -> DataFrame:
    """Box statistics per category.

    Quartiles come from counts by value range, so a category with a third of the rows is
    spread over its ranges. Whiskers join the per-category fences back: broadcast to the
    rows when there are few categories, else to counts of distinct values, where a large
    category is at most its distinct values and skewed partitions are split.
    """
    few = group_estimate(df, by) <= FEW_GROUPS
    quartiles = grouped_quantiles(df, by, name, (0.25, 0.5, 0.75), few_groups=few).withColumns({
        "low": F.col("q0") - WHISKER * (F.col("q2") - F.col("q0")),
        "high": F.col("q2") + WHISKER * (F.col("q2") - F.col("q0")),
    })
    rows = df.filter(has_value(df, name)).select(col(by).alias(by), _number(df, name).alias("~x"))
    x, copies = F.col("~x"), F.lit(1)
    if few:
        joined = rows.join(F.broadcast(quartiles), by)
    else:
        copies = F.col("~copies")
        joined = rows.groupBy(by, "~x").agg(F.count(F.lit(1)).alias("~copies")).join(quartiles, by)
    return joined.groupBy(by).agg(
        F.first("n").alias("n"), F.min(x).alias("min"), F.first("q0").alias("q1"),
        F.first("q1").alias("median"), F.first("q2").alias("q3"), F.max(x).alias("max"),
        F.min(F.when(x >= F.col("low"), x)).alias("whisker_low"),
        F.max(F.when(x <= F.col("high"), x)).alias("whisker_high"),
        F.coalesce(F.sum(F.when((x < F.col("low")) | (x > F.col("high")), copies)), F.lit(0)).alias("outliers"),
    )


def _value_table(df: DataFrame, name: str) -> DataFrame:
    x = _number(df, name)
    return df.filter(has_value(df, name)).groupBy(x.alias("value")).agg(F.count(F.lit(1)).alias("n"))


def ecdf(df: DataFrame, name: str) -> DataFrame:
    """``(value, count, share)``: share of rows at or below each distinct value."""
    splits = value_splits(df, _number(df, name))
    return running_counts(_value_table(df, name), splits).select(
        "value", F.col("n").alias("count"), (F.col("upto") / F.col("total")).alias("share"))


def ecdf_curve(df: DataFrame, name: str, points: int = 200) -> DataFrame:
    """``(value, share, deviation)``: at most ``points`` steps of the ECDF, none further off than 1 / points.

    A value is a step where the rows up to it pass a multiple of 1 / points of all. Held until the next step, the
    curve is below the exact one by at most ``deviation``, measured here; values before the first step belong
    to a step of share 0.
    """
    splits = value_splits(df, _number(df, name))
    counted = running_counts(_value_table(df, name), splits)
    below = F.col("upto") - F.col("n")
    passed = F.floor(F.col("upto") * points / F.col("total")) > F.floor(below * points / F.col("total"))
    in_order = Window.orderBy("value")       # at most ``points`` rows
    before_next = F.coalesce(F.lead(below).over(in_order), F.col("upto"))
    return counted.where(passed).select("value", (F.col("upto") / F.col("total")).alias("share"),
                                        ((before_next - F.col("upto")) / F.col("total")).alias("deviation"))


def sorted_series(df: DataFrame, name: str, points: int = 1000) -> DataFrame:
    """``(position, rank, value)``: the sorted column at ``points`` evenly spaced ranks.

    All ranks when the column has no more than ``points`` values. A value covers a run of
    ranks, so the positions it fills follow from its running count without a join.
    """
    splits = value_splits(df, _number(df, name))
    counted = running_counts(_value_table(df, name), splits)
    steps = F.least(F.lit(points).cast("bigint"), F.col("total")) - 1
    last = F.col("total") - 1
    # position j stands for rank floor(j * last / steps)
    below = F.col("upto") - F.col("n")
    # a single position belongs to the smallest value: for the others the run is empty
    first_j = F.when(steps > 0, F.ceil(below * steps / last)).otherwise(F.least(below, F.lit(1)))
    last_j = F.when(steps > 0, F.ceil(F.col("upto") * steps / last) - 1).otherwise(F.lit(0))
    rank = F.when(steps > 0, F.floor(F.col("position") * last / steps)).otherwise(F.lit(0))
    return (
        counted.withColumn("from", first_j.cast("bigint"))
        .withColumn("to", F.least(last_j.cast("bigint"), steps))
        .filter("`from` <= `to`")
        .withColumn("position", F.explode(F.sequence("from", "to")))
        .select("position", rank.cast("bigint").alias("rank"), "value")
    )


def density(df: DataFrame, name: str, points: int = 64, bins: int = 512) -> DataFrame:
    """``(x, density)``: Gaussian kernel density on an even grid.

    Rows are folded into ``bins`` fine bins, each standing at its centre, and the kernel is
    summed over bins rather than rows. Bandwidth is 1.06 * std * n^(-1/5). Infinite values are left out.
    """
    df = finite(df, name)
    s = summarize(df, {name: present(df, name)})[0][name]
    spark = df.sparkSession
    if s.count == 0 or not s.std:
        return spark.createDataFrame([], "x double, density double")
    width = (s.max - s.min) / bins
    band = 1.06 * s.std * s.count ** -0.2
    x = _number(df, name)
    binned = df.filter(has_value(df, name)).groupBy(_bin(x, s.min, width, bins).alias("bin")).agg(
        F.count(F.lit(1)).alias("n"))
    step = (s.max - s.min) / (points - 1)
    grid = F.explode(F.transform(F.sequence(F.lit(0), F.lit(points - 1)),
                                 lambda i: F.lit(s.min) + i * F.lit(step)))
    centre = F.lit(s.min) + (F.col("bin") + 0.5) * F.lit(width)
    gap = (F.col("x") - centre) / F.lit(band)
    scale = 1.0 / (s.count * band * math.sqrt(2 * math.pi))
    return binned.withColumn("x", grid).groupBy("x").agg(
        (F.sum(F.col("n") * F.exp(-0.5 * gap * gap)) * F.lit(scale)).alias("density"))


def density_by(df: DataFrame, name: str, by: str, points: int = 64, bins: int = 512) -> DataFrame:
    """``(by, x, density)``: the density of each category on a grid over its own range, as a violin's body.

    As ``density``, with bins, grid and bandwidth from each category's own statistics; categories without two
    different values have no density. Rows fold to at most ``bins`` counts a category before they are shuffled.
    """
    df = finite(df, name)
    few = group_estimate(df, by) <= FEW_GROUPS
    rows = df.filter(has_value(df, name) & col(by).isNotNull()).select(col(by).alias(by), _number(df, name).alias("~v"))
    own = rows.groupBy(by).agg(F.count("~v").alias("~n"), F.stddev_samp("~v").alias("~std"), F.min("~v").alias("~lo"),
                               F.max("~v").alias("~hi")).where("`~hi` > `~lo` AND `~std` > 0")
    own = own.withColumns({"~w": (F.col("~hi") - F.col("~lo")) / bins,
                           "~band": 1.06 * F.col("~std") * F.pow(F.col("~n"), F.lit(-0.2))})
    joined = rows.join(F.broadcast(own) if few else own, by)
    at = F.floor((F.col("~v") - F.col("~lo")) / F.col("~w"))
    binned = joined.groupBy(by, "~n", "~lo", "~hi", "~w", "~band",
                            F.least(F.greatest(at, F.lit(0)), F.lit(bins - 1)).alias("~bin")).agg(F.count(F.lit(1)).alias("~k"))
    grid = F.explode(F.sequence(F.lit(0), F.lit(points - 1)))
    x = F.col("~lo") + F.col("~i") * (F.col("~hi") - F.col("~lo")) / (points - 1)
    gap = (F.col("x") - (F.col("~lo") + (F.col("~bin") + 0.5) * F.col("~w"))) / F.col("~band")
    scale = F.first(F.col("~n") * F.col("~band") * math.sqrt(2 * math.pi))
    return binned.withColumn("~i", grid).withColumn("x", x).groupBy(by, "x").agg(
        (F.sum(F.col("~k") * F.exp(-0.5 * gap * gap)) / scale).alias("density"))


def scatter_points(df: DataFrame, x: str, y: str, key: str, color: str | None = None,
                   n: int | None = None, hover: Sequence[str] = ()) -> DataFrame:
    """Point pairs, with colour and hover columns; ``n`` draws an even sample.

    The sample is the ``n`` smallest digests of ``key``: the same rows on every run and any
    partitioning, kept as ``n`` rows per task.
    """
    extra = ([col(color).alias("color")] if color else []) + [col(h) for h in hover]
    points = df.filter(has_value(df, x) & has_value(df, y))
    if n is not None:
        text = col(key).cast("string")
        points = points.orderBy(F.md5(text), text).limit(n)
    return points.select(col(key).alias("key"), col(x).alias("x"), col(y).alias("y"), *extra)


def scatter_even(df: DataFrame, x: str, y: str, key: str, color: str, k: int = 500,
                 hover: Sequence[str] = ()) -> DataFrame:
    """Point pairs with as many points of every colour: the ``k`` smallest digests of ``key`` in each.

    The same rows on any partitioning. Each task keeps k rows a colour before the shuffle (Spark limits ranked
    rows there for k up to 1000), and they meet over slots first, so a colour with a third of the rows is
    never sorted as a whole. Rows without a colour are a colour of their own.
    """
    text = col(key).cast("string")
    points = df.filter(has_value(df, x) & has_value(df, y)).select(
        col(key).alias("key"), col(x).alias("x"), col(y).alias("y"), col(color).alias("color"),
        *[col(h) for h in hover], F.md5(text).alias("~h"), text.alias("~t"),
        (F.spark_partition_id() % F.lit(SLOTS)).alias("~slot"))
    for group in (["color", "~slot"], ["color"]):
        rank = F.row_number().over(Window.partitionBy(*group).orderBy("~h", "~t"))
        points = points.withColumn("~rank", rank).where(F.col("~rank") <= k).drop("~rank")
    return points.drop("~h", "~t", "~slot")


def scatter_grid(df: DataFrame, x: str, y: str, nx: int = 50, ny: int = 50) -> DataFrame:
    """``(bx, by, count)``: points counted on an even grid over both ranges; infinite points are left out."""
    df = finite(df, x, y)
    both = df.filter(has_value(df, x) & has_value(df, y))
    vx, vy = _number(df, x), _number(df, y)
    r = both.agg(F.min(vx).alias("x0"), F.max(vx).alias("x1"), F.min(vy).alias("y0"), F.max(vy).alias("y1")).first()
    if r["x0"] is None:
        return df.sparkSession.createDataFrame([], "bx bigint, by bigint, count bigint")
    wx = (r["x1"] - r["x0"]) / nx or 1.0
    wy = (r["y1"] - r["y0"]) / ny or 1.0
    return both.groupBy(
        _bin(vx, r["x0"], wx, nx).alias("bx"), _bin(vy, r["y0"], wy, ny).alias("by"),
    ).agg(F.count(F.lit(1)).alias("count"))


def time_component_counts(df: DataFrame, name: str, unit: str = "month") -> DataFrame:
    """Rows per calendar component, in order; Monday is 0. Unknown units mean month."""
    parts = {"year": F.year, "month": F.month, "day": F.day, "hour": F.hour,
             "minute": F.minute, "dayofweek": F.weekday}
    part = parts.get(unit, F.month)(col(name))
    return (
        df.filter(col(name).isNotNull()).groupBy(part.cast("bigint").alias("component"))
        .agg(F.count(F.lit(1)).alias("count")).orderBy("component")
    )


def preview(df: DataFrame, n: int = 10, order_by: str | None = None, columns: int | None = None) -> DataFrame:
    """The first ``n`` rows, by ``order_by`` when given; optionally the first columns only."""
    rows = df.orderBy(col(order_by)) if order_by is not None else df
    shown = rows.limit(n)
    return shown if columns is None else shown.select(*[col(c) for c in df.columns[:columns]])
