"""Tables, the dirty view, and pieces of checking SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

# The given tables hold no nulls. This view of events does, and the same text runs in both
# engines.
DIRTY_COLUMNS = {
    "event_id": "event_id",
    "ts": "CASE WHEN event_id % 17 = 0 THEN NULL ELSE ts END",
    "user_id": "CASE WHEN event_id % 10 < 8 THEN NULL ELSE user_id END",
    "event_type": "CASE WHEN event_id % 11 = 0 THEN NULL ELSE event_type END",
    "value": "CASE WHEN event_id % 20 = 0 THEN NULL WHEN event_id % 97 = 0 THEN value * 10 ELSE value END",
    "amount_text": "CASE WHEN event_id % 13 = 0 THEN 'n/a' "
                   "ELSE CAST(CAST(floor(value * 100) AS BIGINT) AS STRING) END",
    "ts_text": "CASE WHEN event_id % 2 = 0 THEN CAST(ts AS STRING) ELSE NULL END",
    "whole_float": "CAST(event_id % 7 AS DOUBLE)",
    "constant": "7",
}
DIRTY_SELECT = "SELECT " + ", ".join(f"{e} AS {c}" for c, e in DIRTY_COLUMNS.items()) + " FROM events"
DIRTY = f"WITH dirty AS ({DIRTY_SELECT})"
DIRTY_NUMERIC = ["event_id", "user_id", "value", "whole_float", "constant"]
DIRTY_TYPES = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint", "event_type": "string",
               "value": "double", "amount_text": "string", "ts_text": "string", "whole_float": "double",
               "constant": "int"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*[f"{e} AS {c}" for c, e in DIRTY_COLUMNS.items()])


def rounded(df: DataFrame, digits: int = 4) -> DataFrame:
    """Floating results to a few digits, since sums in another order differ in the last bits."""
    return df.select(*[
        F.round(F.col(f"`{f.name}`"), digits).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f"`{f.name}`")
        for f in df.schema])


def r(expr: str, digits: int = 4) -> str:
    return f"round(CAST({expr} AS DOUBLE), {digits})"


def pct(part: str, whole: str) -> str:
    """A percentage with two digits, half to even."""
    return f"(round_even((CAST({part} AS DOUBLE) / nullif(CAST({whole} AS DOUBLE), 0)) * 100 * 100, 0) / 100)"


def half_even(expr: str) -> str:
    return f"(round_even(CAST({expr} AS DOUBLE) * 100, 0) / 100)"


def per_column(cols: list[str], make) -> str:
    """One SELECT per column, as one table."""
    return " UNION ALL ".join(make(c) for c in cols)


def quantile(c: str, p: float) -> str:
    return f"quantile_cont(CAST({c} AS DOUBLE), {p})"


def median_time(c: str) -> str:
    return f"make_timestamp(CAST(floor(quantile_cont(CAST(epoch_us({c}) AS DOUBLE), 0.5)) AS BIGINT))"


def mode_of(c: str, source: str) -> str:
    """Commonest value, smallest on ties."""
    return (f"(SELECT {c} FROM {source} WHERE {c} IS NOT NULL GROUP BY {c} "
            f"ORDER BY count(*) DESC, {c} LIMIT 1)")


def bounds_row(c: str, source: str, factor: float = 1.5) -> str:
    """Bounds and statistics of one column as one row."""
    x = f"CAST({c} AS DOUBLE)"
    return f"""
      SELECT '{c}' AS "column", *,
        CASE WHEN iqr > 0 THEN q1 - {factor}::DOUBLE * iqr WHEN std > 0 THEN mean - 3 * std ELSE mn END AS lower,
        CASE WHEN iqr > 0 THEN q3 + {factor}::DOUBLE * iqr WHEN std > 0 THEN mean + 3 * std ELSE mx END AS upper,
        CASE WHEN iqr > 0 THEN 'iqr' WHEN std > 0 THEN 'std' ELSE 'no_variation' END AS method
      FROM (SELECT *, q3 - q1 AS iqr FROM (
        SELECT min({x}) AS mn, max({x}) AS mx, {quantile(c, 0.25)} AS q1, {quantile(c, 0.75)} AS q3,
               avg({x}) AS mean, stddev_samp({x}) AS std, count({c}) AS n FROM {source})) WHERE n > 0"""


def bounds_sql(cols: list[str], source: str, factor: float = 1.5) -> str:
    return per_column(cols, lambda c: bounds_row(c, source, factor))


def long_rows(name: str, sql: str, numbers: list[str], texts: list[str], key: str | None = '"column"') -> str:
    """A report query as (report, column, metric, number, text) rows."""
    def one(metric: str, number: str, text: str) -> str:
        column = key or "CAST(NULL AS VARCHAR)"
        return (f"SELECT '{name}' AS report, {column} AS \"column\", '{metric}' AS metric, "
                f"{number} AS number, {text} AS text FROM ({sql})")

    return " UNION ALL ".join(
        [one(m, f"CAST({m} AS DOUBLE)", "CAST(NULL AS VARCHAR)") for m in numbers]
        + [one(m, "CAST(NULL AS DOUBLE)", f"CAST({m} AS VARCHAR)") for m in texts])
