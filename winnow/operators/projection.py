"""Column selection and row filters."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F

from winnow.functions.columns import col, columns_of, has_value

ROLE_KINDS = {
    "numeric": ("numeric",), "categorical": ("categorical",),
    "datetime": ("datetime",), "boolean": ("boolean",),
}


def select_by_role(df: DataFrame, role: str) -> DataFrame:
    """Only the columns of one kind: numeric, categorical, datetime or boolean."""
    return df.select(*[col(c) for c in columns_of(df, *ROLE_KINDS[role])])


def drop_columns(df: DataFrame, cols: Iterable[str]) -> DataFrame:
    """Without the listed columns; names the table lacks are ignored."""
    return df.drop(*[c for c in cols if c in df.columns])


def drop_nulls(df: DataFrame, name: str) -> DataFrame:
    return df.filter(has_value(df, name))


def _limits(bounds: Mapping) -> dict[str, tuple[float, float]]:
    """Accept fitted bounds or plain (lower, upper) pairs."""
    return {
        c: (b["lower"], b["upper"]) if isinstance(b, Mapping) else (b[0], b[1])
        for c, b in bounds.items()
    }


def outside(df: DataFrame, bounds: Mapping) -> DataFrame:
    """Rows beyond the bounds of any listed column."""
    limits = {c: b for c, b in _limits(bounds).items() if c in df.columns}
    if not limits:
        return df.limit(0)
    return df.filter(reduce(lambda a, b: a | b, [
        (col(c) < F.lit(lo)) | ((col(c) > F.lit(hi)) & has_value(df, c)) for c, (lo, hi) in limits.items()]))


def between_all(df: DataFrame, bounds: Mapping) -> DataFrame:
    """Rows inside the bounds of every listed column; a null fails the test."""
    limits = {c: b for c, b in _limits(bounds).items() if c in df.columns}
    for c, (lo, hi) in limits.items():
        df = df.filter((col(c) >= F.lit(lo)) & (col(c) <= F.lit(hi)))
    return df
