"""Column kinds, read from the schema alone."""

from __future__ import annotations

import math
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F, types as T

INTEGRAL = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
FLOATING = (T.FloatType, T.DoubleType)
TEMPORAL = (T.TimestampType, T.TimestampNTZType, T.DateType)

# Bytes one value takes; strings and nested types are measured instead.
FIXED_WIDTH = {
    "boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4,
    "double": 8, "date": 4, "timestamp": 8, "timestamp_ntz": 8,
}


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def text_literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def double_literal(x: float) -> str:
    return f"{float(x)!r}D" if math.isfinite(x) else f"double('{x}')"


def col(name: str) -> Column:
    """Reference a column by its exact name, dots and all."""
    return F.col(quoted(name))


def is_numeric(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def is_integral(dtype: T.DataType) -> bool:
    return isinstance(dtype, INTEGRAL)


def is_temporal(dtype: T.DataType) -> bool:
    return isinstance(dtype, TEMPORAL)


def kind(dtype: T.DataType) -> str:
    """numeric, categorical (text), datetime, boolean or other (nested, binary)."""
    if is_numeric(dtype):
        return "numeric"
    if isinstance(dtype, T.StringType):
        return "categorical"
    if is_temporal(dtype):
        return "datetime"
    if isinstance(dtype, T.BooleanType):
        return "boolean"
    return "other"


def columns_of(df: DataFrame, *kinds: str) -> list[str]:
    return [f.name for f in df.schema if kind(f.dataType) in kinds]


def numeric_columns(df: DataFrame, cols: Iterable[str] | None = None) -> list[str]:
    """The numeric columns, or those of ``cols`` that exist and are numeric."""
    numeric = columns_of(df, "numeric")
    if cols is None:
        return numeric
    wanted = list(cols)
    return [c for c in wanted if c in numeric]


def present_sql(df: DataFrame, name: str) -> str:
    """The column with NaN read as null: one notion of a missing value."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, FLOATING):
        return f"nullif({quoted(name)}, {dtype.simpleString()}('NaN'))"
    return quoted(name)


def present(df: DataFrame, name: str) -> Column:
    return F.expr(present_sql(df, name))


def has_value(df: DataFrame, name: str) -> Column:
    """True for values, false or null for nulls and NaN; a form that file readers can use.

    NaN sorts above infinity, so one comparison leaves out both NaN and null.
    """
    if isinstance(df.schema[name].dataType, FLOATING):
        return col(name) <= F.lit(math.inf)
    return col(name).isNotNull()


def as_text(df: DataFrame, name: str) -> Column:
    """A text form that is equal exactly when the values are."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, FLOATING):
        return (present(df, name) + F.lit(0.0)).cast("string")  # -0.0 and 0.0 are one value
    if isinstance(dtype, (T.ArrayType, T.MapType, T.StructType)):
        return F.to_json(col(name))
    if isinstance(dtype, T.BinaryType):
        return F.base64(col(name))
    return col(name).cast("string")


def micros(df: DataFrame, name: str) -> Column:
    """A temporal column as microseconds since the epoch, read in UTC as the session is."""
    return F.unix_micros(col(name).cast("timestamp"))
