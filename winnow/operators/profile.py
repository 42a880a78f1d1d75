"""Column and table profiles."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import product

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from winnow.functions.columns import (
    FIXED_WIDTH, as_text, col, columns_of, is_numeric, kind, micros, numeric_columns, present,
)
from winnow.functions.numbers import half_even, share_pct
from winnow.functions.reshape import Pending, aggregate_rows
from winnow.operators.frequency import distinct_counts, mode_values
from winnow.operators.nulls import null_counts
from winnow.operators.quantiles import Stats, summarize

SAMPLE_CHARS = 100     # fixed value: samples are cut to this length
QUARTILES = (0.25, 0.5, 0.75)


# ---------------------------------------------------------------- sizes

def size_expressions(df: DataFrame, cols: Sequence[str]) -> dict[str, Column]:
    """Logical bytes of each column: fixed width times rows, or measured length."""
    rows = F.count(F.lit(1))
    out = {}
    for c in cols:
        dtype = df.schema[c].dataType
        width = FIXED_WIDTH.get(dtype.simpleString())
        if isinstance(dtype, T.DecimalType):
            width = 8 if dtype.precision <= 18 else 16
        if width is not None:
            size = rows * F.lit(width)
        elif isinstance(dtype, T.ArrayType) and dtype.elementType.simpleString() in FIXED_WIDTH:
            size = F.sum(F.array_size(col(c))) * F.lit(FIXED_WIDTH[dtype.elementType.simpleString()])
        elif isinstance(dtype, (T.StringType, T.BinaryType)):
            size = F.sum(F.octet_length(col(c)))
        else:
            size = F.sum(F.octet_length(as_text(df, c)))
        out[c] = F.coalesce(size.cast("bigint"), F.lit(0).cast("bigint"))
    return out


def size_profile(df: DataFrame, top: int | None = None) -> DataFrame:
    """``(column, bytes, total_bytes)``; the ``top`` largest (name on ties) when given."""
    sizes = size_expressions(df, df.columns)
    out = aggregate_rows(df, df.columns, {c: {"bytes": sizes[c]} for c in df.columns}, "bytes bigint")
    out = out.withColumn("total_bytes", F.sum("bytes").over(Window.partitionBy()))  # a row per column
    return out if top is None else out.orderBy(F.desc("bytes"), F.asc("column")).limit(top)


# ---------------------------------------------------------------- numbers

STATS_SCHEMA = "column string, count bigint, mean double, std double, min double, p25 double, p50 double, p75 double, max double"


def _stats_rows(stats: dict[str, Stats]) -> list[tuple]:
    return [(c, s.count, s.mean, s.std, s.min, *[s.quantiles.get(p) for p in QUARTILES], s.max)
            for c, s in stats.items()]


def describe(df: DataFrame, cols: Iterable[str] | None = None, digits: int | None = 2,
             exact: bool = True) -> DataFrame:
    """Count, mean, deviation, extremes and quartiles of every numeric column."""
    names = numeric_columns(df, cols)
    stats = {} if not names else summarize(
        df, {c: present(df, c) for c in names}, QUARTILES, exact=exact)[0]
    out = df.sparkSession.createDataFrame(_stats_rows(stats), STATS_SCHEMA)
    if digits is None:
        return out
    return out.select("column", "count", *[
        half_even(F.col(c), digits).alias(c) for c in ("mean", "std", "min", "p25", "p50", "p75", "max")])


def numeric_overview(df: DataFrame, k: int | None = 5) -> DataFrame:
    """Mean, median, deviation, extremes and range of the first ``k`` numeric columns."""
    names = numeric_columns(df)[:k]
    stats = {} if not names else summarize(df, {c: present(df, c) for c in names}, (0.5,))[0]
    return df.sparkSession.createDataFrame(
        [(c, s.mean, s.quantiles[0.5], s.std, s.min, s.max, s.max - s.min)
         for c, s in stats.items() if s.count],
        "column string, mean double, median double, std double, min double, max double, range double")


def column_statistics(df: DataFrame, name: str) -> DataFrame:
    """One row on one column: moments for numbers, the commonest value otherwise."""
    distinct = distinct_counts(df, [name]).first()["distinct"]
    if is_numeric(df.schema[name].dataType):
        s = summarize(df, {name: present(df, name)}, (0.5,))[0][name]
        row = (name, "Numerical", s.nulls, s.rows, distinct, s.mean, s.quantiles[0.5], s.std, s.min,
               s.max, None if s.count == 0 else s.max - s.min, None)
    else:
        counted = null_counts(df, [name]).first()
        found = mode_values(df, [name]).get(name)
        row = (name, "Categorical", counted["null_count"], counted["total_rows"], distinct,
               None, None, None, None, None, None, None if found is None else str(found))
    return df.sparkSession.createDataFrame([row], (
        "column string, type string, null_count bigint, total_rows bigint, distinct bigint, "
        "mean double, median double, std double, min double, max double, range double, mode string"
    )).withColumn("null_pct", half_even(share_pct(F.col("null_count"), F.col("total_rows"))))


PAIR_SUMS = ("n", "x", "y", "xx", "yy", "xy")
PAIR_ENDS = ("lo_x", "lo_y", "hi_x", "hi_y")


def _pair_sums(shift: np.ndarray, scale: np.ndarray):
    """Sums over the rows where both columns of a pair are present, for all pairs of a task."""
    k = len(shift)

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n, one, two, both = (np.zeros((k, k)) for _ in range(4))
        low, high = np.full((k, k), np.inf), np.full((k, k), -np.inf)
        for batch in batches:
            with np.errstate(all="ignore"):
                x = (batch.to_numpy(float) - shift) / scale
                seen = ~np.isnan(x)
                value, weight = np.where(seen, x, 0.0), seen.astype(float)
                n += weight.T @ weight
                one += value.T @ weight             # [a, b]: sum of a where b is present
                two += (value * value).T @ weight
                both += value.T @ value
            for b in range(k):
                here = seen[:, b]
                low[:, b] = np.minimum(low[:, b], np.where(seen, x, np.inf)[here].min(0, initial=np.inf))
                high[:, b] = np.maximum(high[:, b], np.where(seen, x, -np.inf)[here].max(0, initial=-np.inf))
        a, b = np.triu_indices(k)
        yield pd.DataFrame({
            "a": a, "b": b, "n": n[a, b], "x": one[a, b], "y": one[b, a], "xx": two[a, b], "yy": two[b, a],
            "xy": both[a, b], "lo_x": low[a, b], "lo_y": low[b, a], "hi_x": high[a, b], "hi_y": high[b, a]})

    return fold


def correlation(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Pearson matrix in long form ``(x, y, r)`` over the rows where both are present.

    One scan measures means and extremes. Another sums products of all pairs, centred and scaled, as
    matrix products over Arrow batches: a plan that does not grow with the pairs, and a row per pair and task
    to merge. A constant side gives null; it is told by its extremes, as merged variances are not exactly
    zero. An infinite value leaves its column without coefficients that are numbers.
    """
    names = numeric_columns(df, cols)
    spark, schema = df.sparkSession, "x string, y string, r double"
    if not names:
        return spark.createDataFrame([], schema)
    values = df.select(*[present(df, c).cast("double").alias(f"v{i}") for i, c in enumerate(names)])
    row = values.agg(F.count(F.lit(1)).alias("rows"), *[
        f(v).alias(f"{k}{i}") for i, v in enumerate(values.columns)
        for k, f in (("mid", F.avg), ("low", F.min), ("high", F.max))]).first()
    if not row["rows"]:
        return spark.createDataFrame([(a, b, None) for a, b in product(names, names)], schema)
    finite = lambda x, instead: instead if x is None or not np.isfinite(x) else x
    shift = np.array([finite(row[f"mid{i}"], 0.0) for i in range(len(names))])
    reach = [finite(row[f"high{i}"], 1.0) - finite(row[f"low{i}"], 0.0) for i in range(len(names))]
    scale = np.array([r if np.isfinite(r) and r > 0 else 1.0 for r in reach])
    sums = values.mapInPandas(_pair_sums(shift, scale), "a int, b int, " + ", ".join(
        f"{c} double" for c in (*PAIR_SUMS, *PAIR_ENDS))).groupBy("a", "b").agg(
        *[F.sum(c).alias(c) for c in PAIR_SUMS],
        *[(F.min if c.startswith("lo") else F.max)(c).alias(c) for c in PAIR_ENDS])
    varies = F.expr("lo_x < hi_x AND lo_y < hi_y")
    r = F.expr("try_divide(xy - x * y / n, sqrt(xx - x * x / n) * sqrt(yy - y * y / n))")
    r = F.when(varies, F.when(F.col("a") == F.col("b"), F.lit(1.0)).otherwise(r))
    listed = F.array(*[F.lit(c) for c in names])
    pairs = sums.select("a", "b", r.alias("r"))
    pairs = pairs.unionByName(pairs.where("a <> b").select(F.col("b").alias("a"), F.col("a").alias("b"), "r"))
    return pairs.select(F.get(listed, "a").alias("x"), F.get(listed, "b").alias("y"), "r")


# ---------------------------------------------------------------- dates

def datetime_profile(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Earliest, latest, whole 24-hour periods between, and null share of temporal columns."""
    temporal = columns_of(df, "datetime")
    names = temporal if cols is None else [c for c in cols if c in temporal]
    day = 86_400_000_000
    return aggregate_rows(df, names, {
        c: {"earliest": F.min(col(c)), "latest": F.max(col(c)),
            "range_days": F.floor((F.max(micros(df, c)) - F.min(micros(df, c))) / F.lit(day)),
            "non_null": F.count(col(c)), "null_count": F.count(F.lit(1)) - F.count(col(c))}
        for c in names
    }, "earliest timestamp_ntz, latest timestamp_ntz, range_days bigint, non_null bigint, null_count bigint"
    ).filter("non_null > 0").withColumn("null_pct", half_even(share_pct(
        F.col("null_count"), F.col("non_null") + F.col("null_count"))))


# ---------------------------------------------------------------- table level

def dtype_distribution(df: DataFrame) -> DataFrame:
    """``(dtype, role, columns)``: how many columns have each type."""
    spark = df.sparkSession
    facts = spark.createDataFrame(
        [(f.dataType.simpleString(), kind(f.dataType)) for f in df.schema], "dtype string, role string")
    return facts.groupBy("dtype", "role").agg(F.count(F.lit(1)).alias("columns"))


def row_digest(df: DataFrame) -> Column:
    """A 256-bit digest of all values of a row."""
    texts = [_key(df, c).alias(f"k{i}") for i, c in enumerate(df.columns)]
    whole = F.to_json(F.struct(*texts), {"ignoreNullFields": "false"}) if texts else F.lit("")
    return F.unhex(F.sha2(F.encode(whole, "UTF-8"), 256))


def duplicate_count(df: DataFrame) -> DataFrame:
    """``(total_rows, duplicate_rows)``: rows equal to another one, beyond the first.

    Rows are told by a 256-bit digest of all their values, counted in one shuffle of 32 bytes a row.
    Equal rows fold map-side, so one that fills a third of the table is one row per task.
    """
    per_row = df.groupBy(row_digest(df).alias("digest")).agg(F.count(F.lit(1)).alias("n"))
    total = F.coalesce(F.sum("n"), F.lit(0).cast("bigint"))
    return per_row.agg(total.alias("total_rows"), (total - F.count(F.lit(1))).alias("duplicate_rows"))


def _key(df: DataFrame, name: str) -> Column:
    """A value as text, equal exactly when the values are; moments by their number."""
    if isinstance(df.schema[name].dataType, (T.TimestampType, T.TimestampNTZType)):
        return micros(df, name).cast("string")
    return as_text(df, name)


def quality_scores(df: DataFrame) -> DataFrame:
    """Completeness, uniqueness and variability in percent.

    A column varies when its smallest and largest values differ, which needs no distinct
    count; all columns are tested in the scan that counts nulls.
    """
    names = df.columns
    n = F.lit(max(len(names), 1))
    rows = F.count(F.lit(1))
    varies = []
    for c in names:
        x = present(df, c) if kind(df.schema[c].dataType) != "other" else as_text(df, c)
        varies.append(F.when(F.min(x) < F.max(x), 1).otherwise(0))
    nothing = F.lit(0).cast("bigint")
    cells = df.agg(
        rows.alias("rows"),
        F.array(*[rows - F.count(present(df, c)) for c in names]).alias("nulls"),
        F.array(*varies).alias("varies"),
    ).select(
        "rows", _array_sum("nulls").alias("nulls"), _array_sum("varies").alias("varying"),
        nothing.alias("duplicate_rows"),
    )
    copies = duplicate_count(df).select(
        nothing.alias("rows"), nothing.alias("nulls"), nothing.alias("varying"), "duplicate_rows")
    return cells.unionByName(copies).agg(
        *[F.sum(c).alias(c) for c in ("rows", "nulls", "varying", "duplicate_rows")]).select(
        F.coalesce(100 - share_pct(F.col("nulls"), F.col("rows") * n), F.lit(100.0)).alias("completeness"),
        F.coalesce(100 - share_pct(F.col("duplicate_rows"), F.col("rows")), F.lit(100.0)).alias("uniqueness"),
        (share_pct(F.col("varying"), n) if names else F.lit(100.0)).alias("variability"),
    )


def _array_sum(name: str) -> Column:
    return F.aggregate(name, F.lit(0).cast("bigint"), lambda a, b: a + b)


def _samples(df: DataFrame, cols: Sequence[str], order_by: str | None) -> dict[str, Column]:
    """First non-null value of each column as text; the smallest without an order."""
    out = {}
    for c in cols:
        text = as_text(df, c)
        out[c] = F.min(text) if order_by is None else F.min_by(
            text, F.when(text.isNotNull(), col(order_by)))
    return out


def column_profile(df: DataFrame, order_by: str | None = None, distinct: str = "exact") -> DataFrame:
    """Per column: type, nulls, null share, distinct values, bytes and a sample value.

    ``distinct="approx"`` replaces the one shuffle (distinct values of every column) by a
    sketch in the same scan as the rest.
    """
    names = df.columns
    sizes, samples = size_expressions(df, names), _samples(df, names, order_by)
    metrics = {
        c: {"total_rows": F.count(F.lit(1)), "null_count": F.count(F.lit(1)) - F.count(present(df, c)),
            "bytes": sizes[c], "sample": F.substring(samples[c], 1, SAMPLE_CHARS),
            "distinct": F.approx_count_distinct(as_text(df, c)) if distinct == "approx" else F.max(F.lit(None))}
        for c in names
    }
    out = aggregate_rows(df, names, metrics, (
        "total_rows bigint, null_count bigint, bytes bigint, sample string, distinct bigint"))
    if distinct == "exact":
        out = out.drop("distinct").join(F.broadcast(distinct_counts(df, names)), "column")
    types = df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString()) for f in df.schema], "column string, dtype string")
    return out.join(F.broadcast(types), "column").select(
        "column", "dtype", "null_count",
        half_even(share_pct(F.col("null_count"), F.col("total_rows"))).alias("null_pct"),
        "distinct", "bytes", "sample")


def dataset_summary(df: DataFrame, order_by: str | None = None, samples: int = 10) -> DataFrame:
    """``(metric, value)``: shape, size, columns by kind, nulls, and first values, in one scan."""
    names = df.columns
    sizes = size_expressions(df, names)
    first = _samples(df, names[:samples], order_by)
    kinds = [kind(f.dataType) for f in df.schema]
    rows = F.count(F.lit(1))
    null_cells = [rows - F.count(present(df, c)) for c in names]
    one = df.agg(
        rows.alias("rows"), F.array(*null_cells).alias("nulls"),
        F.array(*sizes.values()).alias("sizes"),
        *[s.alias(f"s{i}") for i, s in enumerate(first.values())],
    ).withColumn("total_nulls", _array_sum("nulls"))
    cells = [
        (F.lit("total_rows"), F.col("rows").cast("string")),
        (F.lit("total_columns"), F.lit(str(len(names)))),
        (F.lit("total_bytes"), _array_sum("sizes").cast("string")),
        *[(F.lit(f"{k}_columns"), F.lit(str(kinds.count(k))))
          for k in ("numeric", "categorical", "datetime", "boolean")],
        (F.lit("total_nulls"), F.col("total_nulls").cast("string")),
        (F.lit("columns_with_nulls"), F.size(F.filter("nulls", lambda x: x > 0)).cast("string")),
        (F.lit("null_pct"), F.call_function("format_number", F.coalesce(share_pct(
            F.col("total_nulls"), F.col("rows") * F.lit(len(names))), F.lit(0.0)), F.lit("0.00"))),
        *[(F.lit(f"sample:{c}"), F.coalesce(F.col(f"s{i}"), F.lit("NaN"))) for i, c in enumerate(first)],
    ]
    return one.select(F.stack(F.lit(len(cells)), *[x for pair in cells for x in pair]).alias("metric", "value"))


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("rows")).withColumn("columns", F.lit(len(df.columns)))


def pending_facts(df: DataFrame) -> Pending:
    """One row: rows, columns, nulls and bytes."""
    sizes = size_expressions(df, df.columns)
    rows = F.count(F.lit(1))
    aggs = [rows.alias("rows"), F.array(*[rows - F.count(present(df, c)) for c in df.columns]).alias("nulls"),
            F.array(*sizes.values()).alias("sizes")]
    return Pending(aggs, lambda row: row.select(
        "rows", F.lit(len(df.columns)).alias("columns"), _array_sum("nulls").alias("nulls"),
        _array_sum("sizes").alias("bytes")))


def table_facts(df: DataFrame) -> DataFrame:
    """One row: rows, columns, nulls and bytes, in one scan."""
    return pending_facts(df).of(df)


def compare(before: DataFrame, after: DataFrame, facts_before: DataFrame | None = None,
            facts_after: DataFrame | None = None) -> DataFrame:
    """One row: shape, nulls and size of both tables, and the columns that went.

    ``facts_before`` and ``facts_after`` replace the scans of the tables.
    """
    removed = sorted(set(before.columns) - set(after.columns))

    facts = ("rows", "columns", "nulls", "bytes")
    stages = (facts_before or table_facts(before)).withColumn("stage", F.lit("before")).unionByName(
        (facts_after or table_facts(after)).withColumn("stage", F.lit("after")))
    return stages.agg(*[
        F.max(F.when(F.col("stage") == stage, F.col(c))).alias(f"{c}_{stage}")
        for stage in ("before", "after") for c in facts]).select(
        "*", (F.col("rows_before") - F.col("rows_after")).alias("rows_removed"),
        F.lit(len(removed)).alias("columns_removed"), F.lit(", ".join(removed)).alias("removed_columns"),
        F.coalesce(half_even(share_pct(F.col("bytes_before") - F.col("bytes_after"), F.col("bytes_before"))),
                   F.lit(0.0)).alias("bytes_reduction_pct"),
    )
