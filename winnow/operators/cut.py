"""The first rows of a table in some order, without bringing them through one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from winnow.functions.columns import col

HEAP_ROWS = 100_000     # up to this many rows, each task's own first rows meet in one


def _key(df: DataFrame, order_by: str | None) -> list[Column]:
    """What rows are ordered by: a column, then digests of the row, so that equal values fall apart."""
    whole = [col(c) for c in df.columns]
    digests = [F.xxhash64(*whole), F.xxhash64(F.lit(1), *whole)]
    return digests if order_by is None else [col(order_by), *digests]


def first_rows(df: DataFrame, n: int, order_by: str | None = None, heap_rows: int = HEAP_ROWS) -> DataFrame:
    """The first ``n`` rows by a column, nulls first, ties by a digest of the row.

    Without ``order_by`` the rows with the smallest digests: an even sample, the same on every run and any
    partitioning. Of more than ``heap_rows`` rows only the keys are sorted, by range: the ranges' counts say
    which are kept whole, and the rows of the one range that is cut are ordered alone.
    """
    key = _key(df, order_by)
    names = [f"k{i}" for i in range(len(key))]
    if n <= heap_rows:
        return df.orderBy(*[k.asc_nulls_first() for k in key]).limit(n)
    keys = df.select(*[k.alias(c) for k, c in zip(key, names)])
    ranges = (keys.repartitionByRange(*[F.col(c).asc_nulls_first() for c in names])
              .groupBy(F.spark_partition_id().alias("range")).agg(
                  F.count(F.lit(1)).alias("rows"), F.max(F.struct(*names)).alias("last")))
    kept, low, high = 0, None, None
    for r in sorted(ranges.collect(), key=lambda r: r["range"]):        # a row per range
        if kept + r["rows"] > n:
            high = tuple(r["last"])
            break
        kept, low = kept + r["rows"], tuple(r["last"])
    if high is None:
        return df
    types = [f.dataType for f in keys.schema]

    def point(values: tuple) -> Column:
        return F.struct(*[F.lit(v).cast(t).alias(c) for v, t, c in zip(values, types, names)])

    own = F.struct(*[k.alias(c) for k, c in zip(key, names)])
    above = own <= point(high) if low is None else (own > point(low)) & (own <= point(high))
    cut = df.where(above).orderBy(*[k.asc_nulls_first() for k in key]).limit(n - kept)
    return cut if low is None else df.where(own <= point(low)).unionByName(cut)
