"""Row counts, null counts and extremes of Parquet files from their footers.

Spark's second Parquet reader answers counts, and the extremes of whole numbers, booleans and dates, from the
statistics in the footers; no column is read. Where footers do not settle a fact it comes from a scan of
the columns concerned: fractions, since footers count NaN as a value, extremes of moments, decimals and texts,
which are absent or cut short, and files without statistics.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T
from py4j.protocol import Py4JJavaError

from winnow.functions.columns import FLOATING, col, is_integral, kind, present

READER = {"spark.sql.sources.useV1SourceList": "avro,csv,json,kafka,orc,text",
          "spark.sql.parquet.aggregatePushdown": "true"}


@contextmanager
def pushed_down(spark: SparkSession) -> Iterator[None]:
    """Tables read here answer aggregates from footers where they can."""
    before = {k: spark.conf.get(k, None) for k in READER}
    for k, v in READER.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@dataclass(frozen=True)
class Fact:
    """What is known of a column: rows, values that are present, and extremes where its kind has them."""

    rows: int
    count: int
    min: object = None
    max: object = None


def _ranked(dtype: T.DataType) -> bool:
    return is_integral(dtype) or isinstance(dtype, (T.DateType, T.BooleanType))


def footer_query(spark: SparkSession, path: str, names: Sequence[str]) -> DataFrame:
    """The aggregates that footers may answer; to be run under ``pushed_down``."""
    df = spark.read.parquet(path)
    aggs = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(names):
        if isinstance(df.schema[c].dataType, FLOATING):
            continue
        aggs.append(F.count(col(c)).alias(f"n{i}"))
        if _ranked(df.schema[c].dataType):
            aggs += [F.min(col(c)).alias(f"lo{i}"), F.max(col(c)).alias(f"hi{i}")]
    return df.agg(*aggs)


def file_facts(spark: SparkSession, path: str, cols: Sequence[str] | None = None) -> dict[str, Fact]:
    """Facts of the columns of Parquet files, from footers where those settle them."""
    df = spark.read.parquet(path)
    names = df.columns if cols is None else [c for c in cols if c in df.columns]
    flat = [c for c in names if kind(df.schema[c].dataType) != "other"]     # nested columns have no plain statistics
    try:
        with pushed_down(spark):
            row = footer_query(spark, path, flat).first().asDict()
    except (PySparkException, Py4JJavaError):       # files written without statistics
        row = {}
    if row.get("rows") is None:     # no file has a footer with rows
        row = {}
    known, scans = {}, []
    for c in names:
        i, ranged = flat.index(c) if c in flat else -1, kind(df.schema[c].dataType) in ("numeric", "datetime")
        if f"n{i}" in row and (f"lo{i}" in row or not ranged):
            known[c] = Fact(row["rows"], row[f"n{i}"], row.get(f"lo{i}"), row.get(f"hi{i}"))
        else:
            scans.append(c)
    if scans:
        aggs = [F.count(F.lit(1)).alias("rows")]
        for i, c in enumerate(scans):
            x = present(df, c)
            aggs.append(F.count(x).alias(f"n{i}"))
            if _ranked(df.schema[c].dataType) or kind(df.schema[c].dataType) in ("numeric", "datetime"):
                aggs += [F.min(x).alias(f"lo{i}"), F.max(x).alias(f"hi{i}")]
        found = df.agg(*aggs).first().asDict()
        known |= {c: Fact(found["rows"], found[f"n{i}"], found.get(f"lo{i}"), found.get(f"hi{i}")) for i, c in enumerate(scans)}
    return {c: known[c] for c in names}


def footer_profile(spark: SparkSession, path: str, cols: Sequence[str] | None = None) -> DataFrame:
    """``(column, total_rows, null_count, low, high)``: extremes of numbers as doubles, null for other kinds."""
    def number(value: object) -> float | None:
        return None if value is None or isinstance(value, bool) or not hasattr(value, "__float__") else float(value)

    rows = [(c, f.rows, f.rows - f.count, number(f.min), number(f.max)) for c, f in file_facts(spark, path, cols).items()]
    return spark.createDataFrame(rows, "column string, total_rows bigint, null_count bigint, low double, high double")
