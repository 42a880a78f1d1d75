"""Missing values: profiles, sparse columns and imputation."""

from __future__ import annotations

import datetime as dt
import math
import struct
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from winnow.functions.columns import (
    col, columns_of, is_integral, is_temporal, kind, micros, numeric_columns, present, present_sql,
)
from winnow.functions.numbers import half_even, share_pct
from winnow.functions.reshape import aggregate_rows
from winnow.operators.frequency import mode_values
from winnow.operators.quantiles import Stats, summarize

NULL_SCHEMA = "total_rows bigint, null_count bigint"
# Fills when a column holds no value to count.
EMPTY_MODE_NUMBER = 0
EMPTY_MODE_TEXT = "Unknown"


def null_counts(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column, total_rows, null_count)``, all columns in one pass."""
    names = list(cols) if cols is not None else df.columns
    return aggregate_rows(df, names, {
        c: {"total_rows": "count(1)", "null_count": f"count(1) - count({present_sql(df, c)})"}
        for c in names
    }, NULL_SCHEMA)


def null_profile(df: DataFrame) -> DataFrame:
    """Null count and percentage (2 digits) of every column."""
    return null_counts(df).withColumn(
        "null_pct", half_even(share_pct(F.col("null_count"), F.col("total_rows"))))


def null_summary(df: DataFrame) -> DataFrame:
    """One row: rows, columns, nulls, columns with nulls, share of empty cells."""
    n = F.lit(len(df.columns))
    return null_counts(df).agg(
        F.max("total_rows").alias("total_rows"),
        F.count(F.lit(1)).alias("total_columns"),
        F.sum("null_count").alias("total_nulls"),
        F.count(F.when(F.col("null_count") > 0, 1)).alias("columns_with_nulls"),
    ).withColumn("null_pct", F.coalesce(
        half_even(share_pct(F.col("total_nulls"), F.col("total_rows") * n)), F.lit(0.0)))


# The report's buckets of null percentage.
NULL_BUCKETS = ["0%", "1-10%", "10-50%", ">50%"]


def null_distribution(df: DataFrame) -> DataFrame:
    """How many columns fall in each bucket of null percentage; empty buckets count 0."""
    pct = share_pct(F.col("null_count"), F.col("total_rows"))
    none, low, middle, high = NULL_BUCKETS
    bucket = (
        F.when(pct == 0, none).when((pct > 0) & (pct <= 10), low)
        .when((pct > 10) & (pct <= 50), middle).when(pct > 50, high)
    )
    counted = null_counts(df).select(bucket.alias("bucket")).agg(
        *[F.count(F.when(F.col("bucket") == b, 1)).alias(f"b{i}") for i, b in enumerate(NULL_BUCKETS)])
    cells = [c for i, b in enumerate(NULL_BUCKETS) for c in (F.lit(b), F.col(f"b{i}"))]
    return counted.select(F.stack(F.lit(len(NULL_BUCKETS)), *cells).alias("bucket", "columns"))


def sparse_columns(df: DataFrame, threshold: float) -> list[str]:
    """Columns whose null share is strictly above the threshold."""
    rows = null_counts(df).collect()    # one row per column
    return [r["column"] for r in rows
            if r["total_rows"] and r["null_count"] / r["total_rows"] > threshold]


def drop_sparse_columns(df: DataFrame, threshold: float) -> DataFrame:
    return df.drop(*sparse_columns(df, threshold))


def drop_what_if(df: DataFrame, threshold_pct: float) -> DataFrame:
    """Per column, what a threshold would do, with the table's overall null share."""
    pct = share_pct(F.col("null_count"), F.col("total_rows"))
    everything = Window.partitionBy()    # over one row per column, never over the data
    return null_counts(df).select(
        "column", "null_count", half_even(pct).alias("null_pct"),
        F.when(pct > threshold_pct, "drop").otherwise("keep").alias("action"),
        F.sum("null_count").over(everything).alias("total_nulls"),
        half_even(share_pct(
            F.sum("null_count").over(everything), F.sum("total_rows").over(everything)
        )).alias("overall_null_pct"),
    )


def top_missing(df: DataFrame, n: int | None = 10, ascending: bool = False) -> DataFrame:
    """Columns with nulls ranked by percentage (name on ties); all of them without ``n``."""
    pct = F.col("null_pct")
    ranked = null_profile(df).filter("null_count > 0").orderBy(
        pct.asc() if ascending else pct.desc(), F.asc("column"))
    return ranked if n is None else ranked.limit(n)


def null_reduction(before: DataFrame, after: DataFrame) -> DataFrame:
    """Empty cells before and after, and the reduction in percent (100 when there were none)."""
    def total(df: DataFrame, stage: str) -> DataFrame:
        return null_counts(df).select(F.lit(stage).alias("stage"), "null_count")

    def of(stage: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("stage") == stage, F.col("null_count"))), F.lit(0))

    return total(before, "before").unionByName(total(after, "after")).agg(
        of("before").alias("nulls_before"), of("after").alias("nulls_after"),
    ).withColumn("reduction_pct", F.coalesce(half_even(share_pct(
        F.col("nulls_before") - F.col("nulls_after"), F.col("nulls_before"))), F.lit(100.0)))


# ---------------------------------------------------------------- imputation

def fill(df: DataFrame, fills: Mapping[str, object]) -> DataFrame:
    """Replace nulls by fitted values: one projection.

    Temporal fills are microseconds since the epoch. An integer column that gets a
    fractional fill becomes double; otherwise types stay.
    """
    out = []
    for f in df.schema:
        value = fills.get(f.name)
        if value is None:
            out.append(col(f.name))
            continue
        c, dtype = present(df, f.name), f.dataType
        if is_temporal(dtype):
            filled = F.coalesce(c, F.timestamp_micros(F.lit(int(value))).cast(dtype))
        elif is_integral(dtype) and float(value).is_integer():
            filled = F.coalesce(c, F.lit(int(value)).cast(dtype))
        elif isinstance(dtype, (T.FloatType, T.DoubleType)):
            filled = F.coalesce(c, F.lit(float(value)).cast(dtype))
        elif isinstance(dtype, T.NumericType):
            filled = F.coalesce(c.cast("double"), F.lit(float(value)))
        elif isinstance(dtype, T.StringType):
            filled = F.coalesce(c, F.lit(str(value)))
        else:
            filled = F.coalesce(c, F.lit(value).cast(dtype))
        out.append(filled.alias(f.name, metadata=f.metadata))
    return df.select(*out)


def stored_fill(df: DataFrame, name: str, value: float) -> float:
    """A numeric fill as the column will hold it: single precision rounds."""
    if isinstance(df.schema[name].dataType, T.FloatType):
        return struct.unpack("f", struct.pack("f", value))[0]
    return float(value)


def _fillable(s: Stats) -> bool:
    return s.count > 0 and s.nulls > 0


def mean_fills(df: DataFrame, cols: Iterable[str] | None = None) -> dict[str, float]:
    names = numeric_columns(df, cols)
    stats, _ = summarize(df, {c: present(df, c) for c in names})
    return {c: s.mean for c, s in stats.items() if _fillable(s)}


def median_fills(df: DataFrame, cols: Iterable[str] | None = None) -> dict[str, float]:
    names = numeric_columns(df, cols)
    stats, _ = summarize(df, {c: present(df, c) for c in names}, (0.5,), needed=_fillable)
    return {c: s.quantiles[0.5] for c, s in stats.items() if _fillable(s)}


def mode_fills(df: DataFrame, cols: Iterable[str]) -> dict[str, object]:
    """Commonest value, smallest on ties; 0 or 'Unknown' for a column without values."""
    names = list(cols)
    found = mode_values(df, names)
    for c in names:
        if c not in found:
            k = kind(df.schema[c].dataType)
            if k == "numeric":
                found[c] = EMPTY_MODE_NUMBER
            elif k == "categorical":
                found[c] = EMPTY_MODE_TEXT
    return {c: v if not isinstance(v, dt.datetime) else to_micros(v) for c, v in found.items()}


def datetime_fills(df: DataFrame, cols: Iterable[str] | None = None, how: str = "median") -> dict[str, int]:
    """Median (floored to the microsecond) or latest moment; empty columns get none."""
    temporal = columns_of(df, "datetime")
    names = temporal if cols is None else [c for c in cols if c in temporal]
    probs = (0.5,) if how == "median" else ()
    stats, _ = summarize(df, {c: micros(df, c) for c in names}, probs, needed=_fillable)
    return {c: moment_fill(s, how) for c, s in stats.items() if _fillable(s)}


def moment_fill(stats, how: str) -> int:
    return math.floor(stats.quantiles[0.5]) if how == "median" else int(stats.max)


def to_micros(moment: dt.datetime) -> int:
    if moment.tzinfo is None:
        moment = moment.replace(tzinfo=dt.timezone.utc)
    return (moment - dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)) // dt.timedelta(microseconds=1)


def from_micros(value: int) -> dt.datetime:
    return dt.datetime(1970, 1, 1) + dt.timedelta(microseconds=int(value))


def impute_mean(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    return fill(df, mean_fills(df, cols))


def impute_median(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    return fill(df, median_fills(df, cols))


def impute_mode(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    return fill(df, mode_fills(df, cols))


def impute_constant(df: DataFrame, cols: Iterable[str] | None = None, value: str = "Unknown") -> DataFrame:
    names = columns_of(df, "categorical") if cols is None else cols
    return fill(df, {c: value for c in names})


def impute_datetime(df: DataFrame, cols: Iterable[str] | None = None, how: str = "median") -> DataFrame:
    return fill(df, datetime_fills(df, cols, how))


@dataclass(frozen=True)
class NullFit:
    """What imputation learned from a table."""

    total_rows: int
    null_counts: dict[str, int]
    dropped: list[str]
    fills: dict[str, object]


NUMERIC_STRATEGIES = ("mean", "median", "most_frequent")


@dataclass(frozen=True)
class Measured:
    """Statistics of the numeric and temporal columns and value counts of the rest."""

    rows: int
    stats: dict[str, Stats]
    counts: dict[str, int]


def measure(df: DataFrame, probs: Sequence[float] = (), needed=lambda s: True,
            exact: bool = True) -> Measured:
    """Nulls of every column and the distribution of those that have one, in one scan
    (two with exact quantiles). Fits that look at the same table can share it."""
    numeric, moments = columns_of(df, "numeric"), columns_of(df, "datetime")
    values = {c: present(df, c) for c in numeric} | {c: micros(df, c) for c in moments}
    rest = {c: present(df, c) for c in df.columns if c not in values}
    stats, counts = summarize(df, values, probs, counts=rest, needed=needed, exact=exact)
    return Measured(counts.pop(""), stats, counts)


def numeric_rule_of(strategy: str, compat: bool) -> str:
    """How numbers are filled; ``compat`` knows mean and median only."""
    return "median" if compat and strategy != "mean" else strategy


def needs_median(strategy: str, compat: bool) -> bool:
    """Whether numbers or moments are filled with a median."""
    return "median" in (strategy, numeric_rule_of(strategy, compat))


def fit_nulls(
    df: DataFrame, threshold: float = 0.5, strategy: str = "median",
    categorical: str = "mode", compat: bool = False, measured: Measured | None = None,
    exact: bool = True, modes: Callable[[Sequence[str]], dict[str, object]] | None = None,
) -> NullFit:
    """Columns to drop and fills for the rest.

    One scan counts the nulls of every column and sketches what a median may need; later
    scans touch only columns that have nulls and stay. ``compat`` keeps the older rule
    that anything but ``mean`` fills numbers with the median. ``measured`` (with a median)
    replaces the first scans, and ``modes`` the scan for the modes of the columns it is given.
    ``exact=False`` fills with estimated medians.
    """
    if strategy not in NUMERIC_STRATEGIES:
        raise ValueError(f"unknown strategy {strategy!r}; use one of {NUMERIC_STRATEGIES}")
    numeric = columns_of(df, "numeric")
    moments = columns_of(df, "datetime")
    rest = [c for c in df.columns if c not in numeric and c not in moments]
    numeric_rule = numeric_rule_of(strategy, compat)
    moment_rule = "median" if strategy == "median" else "latest"

    def imputed(s) -> bool:
        return s.rows > 0 and 0 < s.nulls <= threshold * s.rows

    if measured is None:
        probs = (0.5,) if needs_median(strategy, compat) else ()
        measured = measure(df, probs, imputed, exact)
    rows, stats = measured.rows, measured.stats
    nulls = {c: stats[c].nulls if c in stats else rows - measured.counts[c] for c in df.columns}
    dropped = [c for c in df.columns if rows and nulls[c] / rows > threshold]
    todo = [c for c in df.columns if nulls[c] and c not in dropped]

    fills: dict[str, object] = {}
    by_mode = [c for c in todo if c in rest and kind(df.schema[c].dataType) != "other"
               and (categorical == "mode" or strategy == "most_frequent")]
    if numeric_rule == "most_frequent":
        by_mode += [c for c in todo if c in numeric]
    modes_found = mode_fills(df, by_mode) if modes is None else modes(by_mode)
    for c in todo:
        if c in modes_found:
            fills[c] = modes_found[c]
        elif c in numeric and stats[c].count:
            fills[c] = stats[c].mean if numeric_rule == "mean" else stats[c].quantiles[0.5]
        elif c in moments and stats[c].count:
            fills[c] = moment_fill(stats[c], moment_rule)
        elif kind(df.schema[c].dataType) == "categorical":
            fills[c] = EMPTY_MODE_TEXT
    return NullFit(rows, nulls, dropped, fills)


def null_report(df: DataFrame, threshold: float = 0.5, strategy: str = "median",
                measured: Measured | None = None) -> DataFrame:
    """Per column: nulls, percentage, whether it would be dropped, and its fill."""
    fitted = fit_nulls(df, threshold, strategy, measured=measured)
    kinds = {f.name: kind(f.dataType) for f in df.schema}
    rows = []
    for c in df.columns:
        value, number, text = fitted.fills.get(c), None, None
        if value is not None and kinds[c] == "numeric":
            number = float(value)
        elif value is not None and kinds[c] == "datetime":
            text = from_micros(value).strftime("%Y-%m-%d %H:%M:%S.%f")
        elif value is not None:
            text = str(value)
        rows.append((c, fitted.total_rows, fitted.null_counts[c], c in fitted.dropped, number, text))
    return df.sparkSession.createDataFrame(
        rows, "column string, total_rows bigint, null_count bigint, to_drop boolean, "
              "fill_number double, fill_text string",
    ).withColumn("null_pct", half_even(share_pct(F.col("null_count"), F.col("total_rows"))))
