"""Outlier bounds, clipping and reports."""

from __future__ import annotations

import math
from collections.abc import Iterable, Mapping

from pyspark.sql import Column, DataFrame, functions as F, types as T

from winnow.functions.columns import col, double_literal, is_integral, numeric_columns, present, present_sql
from winnow.functions.numbers import half_even, share_pct
from winnow.functions.reshape import Pending, aggregate_rows, pending_rows
from winnow.operators.projection import between_all
from winnow.operators.quantiles import Stats, summarize

# Default factor on the interquartile range, and the deviations allowed on
# each side when that range is zero.
IQR_FACTOR = 1.5
STD_FACTOR = 3.0
QUARTILES = (0.25, 0.75)
CLIP_METHODS = ("iqr", "remove", "winsorize")


def bounds_of(s: Stats, factor: float = IQR_FACTOR) -> dict | None:
    """Limits for one column: by quartiles, else by deviation, else its own extremes."""
    if not s.count:
        return None
    q1, q3 = s.quantiles[0.25], s.quantiles[0.75]
    iqr = q3 - q1
    if iqr > 0:
        method, lower, upper = "iqr", q1 - factor * iqr, q3 + factor * iqr
    elif s.std is not None and s.std > 0:
        method, lower, upper = "std", s.mean - STD_FACTOR * s.std, s.mean + STD_FACTOR * s.std
    else:
        method, lower, upper = "no_variation", s.min, s.max
    return {"lower": lower, "upper": upper, "min": s.min, "max": s.max, "q1": q1, "q3": q3,
            "iqr": iqr, "mean": s.mean, "std": s.std, "method": method}


def fit_bounds(df: DataFrame, cols: Iterable[str] | None = None, factor: float = IQR_FACTOR,
               exact: bool = True) -> dict[str, dict]:
    """Bounds of the numeric columns that hold values, in two scans for all of them."""
    names = numeric_columns(df, cols)
    if not names:
        return {}
    stats, _ = summarize(df, {c: present(df, c) for c in names}, QUARTILES, exact=exact)
    return bounds_from(stats, factor)


def bounds_from(stats: Mapping[str, Stats], factor: float = IQR_FACTOR) -> dict[str, dict]:
    """Bounds from statistics that already hold the quartiles."""
    found = {c: bounds_of(s, factor) for c, s in stats.items()}
    return {c: b for c, b in found.items() if b}


BOUNDS_SCHEMA = (
    "column string, lower double, upper double, min double, max double, q1 double, q3 double, "
    "iqr double, mean double, std double, method string"
)


def bounds_table(spark, bounds: Mapping[str, Mapping]) -> DataFrame:
    order = [part.split()[0] for part in BOUNDS_SCHEMA.split(", ")][1:]
    return spark.createDataFrame([(c, *[b[k] for k in order]) for c, b in bounds.items()], BOUNDS_SCHEMA)


def iqr_bounds(df: DataFrame, cols: Iterable[str] | None = None, factor: float = IQR_FACTOR,
               exact: bool = True) -> DataFrame:
    """One row of bounds and statistics per numeric column."""
    return bounds_table(df.sparkSession, fit_bounds(df, cols, factor, exact))


# ---------------------------------------------------------------- applying bounds

def _clipped(df: DataFrame, name: str, b: Mapping) -> Column:
    """Clamp, keeping nulls.

    An integer column stays one unless the fitted data had values beyond a bound; then it
    becomes double, since bounds are.
    """
    c, lower, upper = present(df, name), b["lower"], b["upper"]
    if is_integral(df.schema[name].dataType):
        if b["min"] < lower or b["max"] > upper:
            c = c.cast("double")
        else:
            dtype = df.schema[name].dataType
            limits = _integer_limits(dtype)
            lo, hi = max(math.ceil(lower), limits[0]), min(math.floor(upper), limits[1])
            low, high = F.lit(lo).cast(dtype), F.lit(hi).cast(dtype)
            return F.when(c < low, low).when(c > high, high).otherwise(c)
    elif isinstance(df.schema[name].dataType, T.DecimalType):
        c = c.cast("double")
    low, high = F.lit(float(lower)), F.lit(float(upper))
    return F.when(c < low, low).when(c > high, high).otherwise(c)


def _integer_limits(dtype) -> tuple[int, int]:
    bits = {"tinyint": 7, "smallint": 15, "int": 31, "bigint": 63}[dtype.simpleString()]
    return -(2 ** bits), 2 ** bits - 1


def clip_outliers(df: DataFrame, bounds: Mapping[str, Mapping]) -> DataFrame:
    """Clamp every bounded column in one projection."""
    return df.select(*[
        _clipped(df, f.name, bounds[f.name]).alias(f.name, metadata=f.metadata)
        if f.name in bounds else col(f.name) for f in df.schema
    ])


# Winsorizing replaces values beyond a bound by the bound, which is what clipping does.
winsorize = clip_outliers


def remove_outliers(df: DataFrame, bounds: Mapping[str, Mapping]) -> DataFrame:
    """Keep rows inside every bound; a null in a bounded column drops the row."""
    return between_all(df, bounds)


# ---------------------------------------------------------------- reports

REPORT_SCHEMA = (
    "outlier_count bigint, outlier_min double, outlier_max double, outlier_mean double, "
    "outlier_std double, normal_count bigint, normal_min double, normal_max double, normal_mean double"
)


def outlier_report(df: DataFrame, bounds: Mapping[str, Mapping] | None = None,
                   factor: float = IQR_FACTOR) -> DataFrame:
    """Per column: statistics of the values beyond and within the bounds, and the bounds.

    All columns in one pass; the bounds are literals in the plan.
    """
    return pending_report(df, fit_bounds(df, None, factor) if bounds is None else bounds).of(df)


def pending_report(df: DataFrame, bounds: Mapping[str, Mapping]) -> Pending:
    names = [c for c in numeric_columns(df) if c in bounds]
    metrics = {}
    for c in names:
        x = present_sql(df, c)
        out = f"({x} < {double_literal(bounds[c]['lower'])} OR {x} > {double_literal(bounds[c]['upper'])})"
        odd, usual = f"CASE WHEN {out} THEN {x} END", f"CASE WHEN NOT {out} THEN {x} END"
        metrics[c] = {
            f"{group}_{name}": f"{f}({values})"
            for group, values in (("outlier", odd), ("normal", usual))
            for name, f in (("count", "count"), ("min", "min"), ("max", "max"), ("mean", "avg"), ("std", "stddev_samp"))
        }
    rows = pending_rows(df.sparkSession, names, metrics, REPORT_SCHEMA)
    fitted = bounds_table(df.sparkSession, bounds).select(
        "column", "lower", "upper", "q1", "q3", "iqr", "method",
        F.col("min").alias("original_min"), F.col("max").alias("original_max"))

    def finish(row: DataFrame) -> DataFrame:
        measured = rows.finish(row).filter("outlier_count + normal_count > 0").withColumn("outlier_pct", half_even(
            share_pct(F.col("outlier_count"), F.col("outlier_count") + F.col("normal_count"))))
        return measured.join(F.broadcast(fitted), "column")    # one row per column

    return Pending(rows.aggs or [F.count(F.lit(1)).alias("outlier_rows")], finish)


def outlier_summary(df: DataFrame, bounds: Mapping[str, Mapping] | None = None,
                    factor: float = IQR_FACTOR, clip_method: str = "iqr") -> DataFrame:
    """Totals over all columns; a table without numbers gets a row that says so."""
    report = outlier_report(df, bounds, factor)
    return report.agg(
        F.coalesce(F.sum("outlier_count"), F.lit(0)).alias("total_outliers"),
        F.count(F.when(F.col("outlier_count") > 0, 1)).alias("columns_with_outliers"),
        F.count(F.lit(1)).alias("total_columns_analyzed"),
    ).select(
        "*", F.lit(float(factor)).alias("outlier_factor"), F.lit(clip_method).alias("clip_method"),
        F.when(F.col("total_columns_analyzed") == 0, "No numerical columns available").alias("message"),
    )


def range_change(before: DataFrame, after: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Per column: extremes before and after, and whether they differ."""
    def extremes(df: DataFrame, suffix: str) -> DataFrame:
        names = [c for c in numeric_columns(before, cols) if c in df.columns]
        return aggregate_rows(df, names, {
            c: {f"min_{suffix}": F.min(present(df, c)), f"max_{suffix}": F.max(present(df, c))}
            for c in names
        }, f"min_{suffix} double, max_{suffix} double")

    return extremes(before, "before").join(F.broadcast(extremes(after, "after")), "column").withColumn(
        "changed", ~(F.col("min_before").eqNullSafe(F.col("min_after"))
                     & F.col("max_before").eqNullSafe(F.col("max_after"))))
