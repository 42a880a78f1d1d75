"""Column roles and type enforcement."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from winnow.functions import dates
from winnow.functions.columns import FLOATING, col, columns_of, is_temporal, kind, present
from winnow.functions.numbers import text_number
from winnow.functions.reshape import Pending, aggregate_rows, pending_rows
from winnow.operators.frequency import SLOTS, settle_cardinality, within_cardinality
from winnow.operators.profile import size_expressions

# Date sample size, share of it that must parse (strictly above), and the
# number of distinct values a categorical column may have.
DATE_SAMPLE = 100
DATE_SHARE = 0.8
MAX_CATEGORIES = 1000
NAMED_SHARE = 0.5       # the share where the name suggests a date

# Upper limits of the unsigned and signed integer types. Spark has no
# unsigned types, so each unsigned one maps to the next wider signed type.
UNSIGNED = [(255, "smallint"), (65535, "int"), (4294967295, "bigint"),
            (18446744073709551615, "decimal(20,0)")]
SIGNED = [(-128, 127, "tinyint"), (-32768, 32767, "smallint"),
          (-2147483648, 2147483647, "int"),
          (-9223372036854775808, 9223372036854775807, "bigint")]
FLOAT_LIMIT = 3.4e38


# ---------------------------------------------------------------- roles

def date_named_columns(df: DataFrame) -> DataFrame:
    """Every column, whether its name suggests a date, and how many values it holds."""
    return aggregate_rows(df, df.columns, {
        c: {"date_named": F.max(F.lit(dates.is_date_name(c))), "non_null": F.count(present(df, c))}
        for c in df.columns
    }, "date_named boolean, non_null bigint").withColumn(
        "date_named", F.coalesce("date_named", F.lit(False)))


def date_parse_ratio(
    df: DataFrame, cols: Sequence[str] | None = None, n: int | None = DATE_SAMPLE,
    order_by: str | None = None,
) -> DataFrame:
    """``(column, sampled, parsed, ratio)`` over the first ``n`` non-null values of each column.

    "First" is by ``order_by``: one scan, of which each task keeps ``n`` values a column. Without it any ``n`` values serve, and a few splits are read. ``n=None`` measures
    whole columns in one pass.
    """
    names = columns_of(df, "categorical") if cols is None else list(cols)
    schema = "sampled bigint, parsed bigint"
    if not names:
        return df.sparkSession.createDataFrame([], f"column string, {schema}, ratio double")
    if n is None:
        counted = aggregate_rows(df, names, {
            c: {"sampled": F.count(col(c)), "parsed": F.count(dates.parse_any(col(c)))} for c in names
        }, schema)
    else:
        sampled = _any_values(df, names, n) if order_by is None else _first_values(df, names, n, order_by)
        found = sampled.groupBy("column").agg(
            F.count(F.lit(1)).alias("sampled"),
            F.count(dates.parse_any(F.col("value"))).alias("parsed"))
        listed = df.sparkSession.createDataFrame([(c,) for c in names], "column string")
        counted = F.broadcast(listed).join(found, "column", "left").select(
            "column", *[F.coalesce(m, F.lit(0)).alias(m) for m in ("sampled", "parsed")])
    return counted.withColumn("ratio", F.try_divide(F.col("parsed"), F.col("sampled")))


def _short(c: str) -> Column:
    """No date is longer than 64 characters; longer text stands as empty."""
    return F.when(F.length(col(c)) <= 64, col(c)).when(col(c).isNotNull(), F.lit(""))


def _first_values(df: DataFrame, names: Sequence[str], n: int, order_by: str) -> DataFrame:
    """The first ``n`` values of all columns in one scan: each task keeps ``n`` a column (Spark limits ranked rows
    before the shuffle), and they meet over slots first."""
    cells = [F.struct(F.lit(c).alias("column"), col(order_by).alias("place"), _short(c).alias("value")) for c in names]
    values = df.select(F.explode(F.array(*cells)).alias("x"), (F.spark_partition_id() % SLOTS).alias("slot")).select(
        "x.*", "slot").where("value IS NOT NULL")
    for group in (["column", "slot"], ["column"]):
        rank = F.row_number().over(Window.partitionBy(*group).orderBy(F.col("place").asc_nulls_first(), "value"))
        values = values.withColumn("rank", rank).where(F.col("rank") <= n)
    return values.select("column", "value")


def _any_values(df: DataFrame, names: Sequence[str], n: int) -> DataFrame:
    """At most ``n`` values of each column, fetched as a limit does: splits are read until
    there are enough."""
    short = {c: _short(c) for c in names}
    taken = {c: [] for c in names}
    rows = df.select(*[short[c].alias(f"v{i}") for i, c in enumerate(names)]).limit(n).collect()
    for row in rows:
        for c, value in zip(names, row):
            if value is not None:
                taken[c].append(value)
    for c in names:    # columns with nulls among the first rows
        if len(taken[c]) < n and len(rows) == n:
            more = df.filter(col(c).isNotNull()).select(short[c]).limit(n).collect()
            taken[c] = [r[0] for r in more]
    return df.sparkSession.createDataFrame(
        [(c, v) for c, values in taken.items() for v in values], "column string, value string")


@dataclass(frozen=True)
class Roles:
    numerical: list[str] = field(default_factory=list)
    categorical: list[str] = field(default_factory=list)
    dates: list[str] = field(default_factory=list)

    def of(self, name: str) -> str:
        for role, names in (("date", self.dates), ("numerical", self.numerical),
                            ("categorical", self.categorical)):
            if name in names:
                return role
        return "other"


def find_roles(
    df: DataFrame, numerical: Iterable[str] | None = None, categorical: Iterable[str] | None = None,
    date_cols: Iterable[str] | None = None, order_by: str | None = None, sample: int | None = None,
) -> Roles:
    """Numeric by type, categorical for text and booleans, dates by type, name or content.

    Lists given by the caller win. Name keywords apply to text only, so a number called
    ``lifetime`` stays a number. A keyword lowers the share of values that must parse, so text
    called ``sentiment`` stays text; only without any value does the name decide alone. Content is
    judged over whole columns, all in one scan, unless ``sample`` asks for that many values.
    """
    if date_cols is None:
        by_type = columns_of(df, "datetime")
        text = columns_of(df, "categorical")
        unsure = [c for c in text if c not in set(numerical or ())]
        parsed = []
        if unsure:
            parsed = [r["column"] for r in date_parse_ratio(df, unsure, sample, order_by).collect()
                      if _is_date(r["column"], r["ratio"])]
        found = [c for c in df.columns if c in by_type or c in parsed]
    else:
        found = [c for c in date_cols if c in df.columns]
    numbers = columns_of(df, "numeric") if numerical is None else list(numerical)
    groups = columns_of(df, "categorical", "boolean") if categorical is None else list(categorical)
    numbers = [c for c in numbers if c in df.columns and c not in found]
    taken = set(found) | (set(numbers) if numerical is not None else set())
    return Roles(numbers, [c for c in groups if c in df.columns and c not in taken], found)


def _is_date(name: str, ratio: float | None) -> bool:
    """Whether a text column of this name, of which this share parses, holds dates."""
    named = dates.is_date_name(name)
    return named if ratio is None else ratio > (NAMED_SHARE if named else DATE_SHARE)


def classify_columns(df: DataFrame, numerical=None, categorical=None, dates=None,
                     order_by: str | None = None) -> DataFrame:
    """``(column, dtype, role)`` with role numerical, categorical, date or other."""
    roles = find_roles(df, numerical, categorical, dates, order_by)
    return df.sparkSession.createDataFrame(
        [(f.name, f.dataType.simpleString(), roles.of(f.name)) for f in df.schema],
        "column string, dtype string, role string")


# ---------------------------------------------------------------- dates

def _first_value(c: Column, order_by: str | None) -> Column:
    """First non-null value in ``order_by`` order; the smallest without an order."""
    if order_by is None:
        return F.min(c)
    return F.min_by(c, F.when(c.isNotNull(), col(order_by)))


def infer_date_format(df: DataFrame, cols: Sequence[str], order_by: str | None = None) -> DataFrame:
    """``(column, sample, format)``: the format the first value of each column starts with."""
    return aggregate_rows(df, list(cols), {
        c: {"sample": _first_value(col(c).cast("string"), order_by)} for c in cols
    }, "sample string").withColumn("format", dates.inferred_format(F.col("sample")))


def parse_dates(
    df: DataFrame, cols: Sequence[str], formats: Mapping[str, str] | None = None,
    exact: bool = False, order_by: str | None = None,
) -> DataFrame:
    """Text columns to timestamps by the given format, else by the inferred and then the other known ones.

    ``exact`` holds a column to its one format, and so does a format that the caller gives.
    """
    known = dict(formats or {})
    unknown = [c for c in cols if c not in known and kind(df.schema[c].dataType) == "categorical"]
    if unknown:
        known |= {r["column"]: r["format"] for r in infer_date_format(df, unknown, order_by).collect()}
    return df.withColumns({c: date_value(df, c, known.get(c), exact, c in (formats or {})) for c in cols})


def date_value(df: DataFrame, name: str, fmt: str | None, exact: bool, given: bool = False) -> Column:
    dtype = df.schema[name].dataType
    if is_temporal(dtype):
        return col(name) if not isinstance(dtype, T.DateType) else col(name).cast("timestamp_ntz")
    text = col(name).cast("string")
    one = dates.parse(text, fmt, exact)
    return one if exact or given else F.coalesce(one, dates.parse_any(text))


# ---------------------------------------------------------------- numbers

def number_value(df: DataFrame, name: str) -> Column:
    """The column as a number: numeric types as they are, text by a checked cast."""
    k = kind(df.schema[name].dataType)
    if k == "numeric":
        return present(df, name)
    if k == "boolean":
        return col(name).cast("int")
    return text_number(col(name).cast("string"))


def coerce_numeric(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """To numbers; what is not one becomes null."""
    return df.withColumns({c: number_value(df, c) for c in cols})


def whole_type(low: float | None, high: float | None, whole: bool) -> str | None:
    """The smallest integer type for whole values in [low, high]; None to stay floating."""
    if low is None or not whole:
        return None
    if low >= 0:
        return next((t for limit, t in UNSIGNED if high <= limit), None)
    return next((t for lo, hi, t in SIGNED if lo <= low and high <= hi), None)


def _floating(df: DataFrame, cols: Iterable[str] | None) -> list[str]:
    names = df.columns if cols is None else cols
    return [c for c in names if isinstance(df.schema[c].dataType, FLOATING)]


def range_aggregates(x: Column, key: str) -> list[Column]:
    return [F.min(x).alias(f"lo_{key}"), F.max(x).alias(f"hi_{key}"),
            F.coalesce(F.bool_and(F.try_mod(x, F.lit(1.0)) == 0), F.lit(False)).alias(f"whole_{key}")]


def narrow_integers(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Floating columns with only whole values to the smallest integer type that holds them."""
    names = _floating(df, cols)
    if not names:
        return df
    row = df.agg(*[a for i, c in enumerate(names) for a in range_aggregates(present(df, c), str(i))]).first()
    targets = {c: whole_type(row[f"lo_{i}"], row[f"hi_{i}"], row[f"whole_{i}"]) for i, c in enumerate(names)}
    return df.withColumns({c: present(df, c).cast(t) for c, t in targets.items() if t})


def narrow_floats(df: DataFrame, cols: Iterable[str] | None = None) -> DataFrame:
    """Doubles whose largest value allows it to single precision (loses digits)."""
    names = [c for c in _floating(df, cols) if isinstance(df.schema[c].dataType, T.DoubleType)]
    if not names:
        return df
    row = df.agg(*[F.max(present(df, c)).alias(f"hi_{i}") for i, c in enumerate(names)]).first()
    return df.withColumns({
        c: col(c).cast("float") for i, c in enumerate(names)
        if row[f"hi_{i}"] is not None and abs(row[f"hi_{i}"]) <= FLOAT_LIMIT})


# ---------------------------------------------------------------- categories

def tagged(name: str, value: Column, categorical: bool) -> Column:
    return value.alias(name, metadata={"role": "categorical" if categorical else "text"})


def tag_categoricals(df: DataFrame, cols: Sequence[str] | None = None,
                     max_cardinality: int = MAX_CATEGORIES) -> DataFrame:
    """Mark columns with few distinct values as categorical in their metadata."""
    names = columns_of(df, "categorical", "boolean") if cols is None else list(cols)
    few = within_cardinality(df, names, max_cardinality)
    return df.select(*[tagged(c, col(c), few[c]) if c in few else col(c) for c in df.columns])


def categorical_roles(df: DataFrame) -> dict[str, str]:
    return {f.name: f.metadata["role"] for f in df.schema if "role" in f.metadata}


# ---------------------------------------------------------------- all together

@dataclass(frozen=True)
class TypeFit:
    """What type enforcement learned: plain values only."""

    roles: Roles
    formats: dict[str, str | None]
    integers: dict[str, str]
    singles: list[str]
    few: dict[str, bool]
    exact_dates: bool = False
    given: list[str] = field(default_factory=list)      # date columns whose format the caller gave


def fit_types(
    df: DataFrame, numerical=None, categorical=None, date_cols=None,
    formats: Mapping[str, str] | None = None, exact_dates: bool = False,
    single_floats: bool = False, max_cardinality: int = MAX_CATEGORIES, order_by: str | None = None,
) -> TypeFit:
    """Roles from one scan of the text columns, then formats, ranges and cardinalities in another."""
    roles = find_roles(df, numerical, categorical, date_cols, order_by)
    known = {c: f for c, f in (formats or {}).items() if c in roles.dates}
    given = list(known)
    unknown = [c for c in roles.dates if c not in known
               and kind(df.schema[c].dataType) == "categorical"]
    ranged = [c for c in roles.numerical
              if kind(df.schema[c].dataType) == "categorical" or c in _floating(df, None)]
    groups = [c for c in roles.categorical if kind(df.schema[c].dataType) in ("categorical", "boolean")]
    aggs = [dates.inferred_format(_first_value(col(c), order_by)).alias(f"fmt_{i}")
            for i, c in enumerate(unknown)]
    aggs += [a for i, c in enumerate(ranged) for a in range_aggregates(number_value(df, c), str(i))]
    aggs += [F.approx_count_distinct(col(c), 0.02).alias(f"few_{i}") for i, c in enumerate(groups)]
    row = df.agg(*aggs).first() if aggs else {}
    known |= {c: row[f"fmt_{i}"] for i, c in enumerate(unknown)}
    integers = {c: whole_type(row[f"lo_{i}"], row[f"hi_{i}"], row[f"whole_{i}"])
                for i, c in enumerate(ranged)}
    singles = [c for i, c in enumerate(ranged) if single_floats and not integers[c]
               and row[f"hi_{i}"] is not None and abs(row[f"hi_{i}"]) <= FLOAT_LIMIT]
    few = settle_cardinality(df, {c: row[f"few_{i}"] for i, c in enumerate(groups)}, max_cardinality)
    return TypeFit(roles, known, {c: t for c, t in integers.items() if t}, singles, few, exact_dates, given)


def typed_expressions(df: DataFrame, fit: TypeFit) -> dict[str, Column]:
    """Dates parsed, numbers coerced and narrowed; the rest unchanged."""
    out = {}
    for c in df.columns:
        out[c] = col(c)
        if c in fit.roles.dates:
            out[c] = date_value(df, c, fit.formats.get(c), fit.exact_dates, c in fit.given)
        elif c in fit.roles.numerical:
            out[c] = number_value(df, c)
            if c in fit.integers or c in fit.singles:
                out[c] = out[c].cast(fit.integers.get(c, "float"))
    return out


def apply_types(df: DataFrame, fit: TypeFit) -> DataFrame:
    """Enforce the fitted types and mark categories: one projection."""
    return df.select(*[
        tagged(c, e, fit.few[c]) if c in fit.few else e.alias(c)
        for c, e in typed_expressions(df, fit).items()
    ])


# ---------------------------------------------------------------- reports

def schema_report(df: DataFrame, fit: TypeFit | None = None, order_by: str | None = None) -> DataFrame:
    """Per column: original and new type, role, logical bytes before, after and saved, and
    ``values_lost``, the values that typing turns into nulls."""
    both, pending = pending_schema(df, fit or fit_types(df, order_by=order_by))
    return pending.of(both)


def pending_schema(df: DataFrame, fit: TypeFit) -> tuple[DataFrame, Pending]:
    """The table with its typed columns beside it under other names, and the report of both."""
    typed = apply_types(df, fit)
    after = {c: f"{i}~after" for i, c in enumerate(df.columns)}
    both = df.select(*[col(c) for c in df.columns], *[
        e.alias(after[c]) for c, e in typed_expressions(df, fit).items()])
    before_size = size_expressions(both, df.columns)
    after_size = size_expressions(both, list(after.values()))
    dtypes = dict(typed.dtypes)
    rows = pending_rows(df.sparkSession, df.columns, {
        c: {"bytes_before": before_size[c], "bytes_after": after_size[after[c]],
            "values_lost": F.count(present(both, c)) - F.count(present(both, after[c]))} for c in df.columns
    }, "bytes_before bigint, bytes_after bigint, values_lost bigint")

    def finish(row: DataFrame) -> DataFrame:
        return rows.finish(row).select(
            "column",
            _by_name({f.name: f.dataType.simpleString() for f in df.schema}).alias("original_type"),
            _by_name(dtypes).alias("new_type"),
            _by_name({c: fit.roles.of(c) for c in df.columns}).alias("role"),
            "bytes_before", "bytes_after",
            (F.col("bytes_before") - F.col("bytes_after")).alias("bytes_saved"), "values_lost")

    return both, Pending(rows.aggs, finish)


def _by_name(values: Mapping[str, str]) -> Column:
    """Look a column's fact up by its name: a map of one entry per column."""
    pairs = [p for c, v in values.items() for p in (F.lit(c), F.lit(v))]
    return F.try_element_at(F.create_map(*pairs), F.col("column"))


def type_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """``(column, old_type, new_type)`` for the columns whose type differs."""
    old, new = dict(before.dtypes), dict(after.dtypes)
    rows = [(c, old[c], new[c]) for c in before.columns if c in new and old[c] != new[c]]
    return before.sparkSession.createDataFrame(
        rows, "column string, old_type string, new_type string")
