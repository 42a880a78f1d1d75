"""Profiles."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.common import (
    DIRTY, DIRTY_COLUMNS, DIRTY_NUMERIC, DIRTY_TYPES, dirty, half_even, mode_of, pct, per_column,
    quantile, r, rounded, table,
)
from registry.nulls import COUNTS
from registry.types import SCHEMA_REPORT, _size
from winnow.operators import frequency, nulls, profile, types
from winnow.operators.duplicates import DuplicateIndex
from winnow.session import scratch_path

COLS = list(DIRTY_COLUMNS)
LINEITEM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_orderkey"]


def frequency_table(spark, sf):
    return frequency.frequency_table(dirty(spark, sf), ["event_type", "whole_float", "user_id", "ts_text"])


def value_counts(spark, sf):
    return frequency.value_counts(dirty(spark, sf), "event_type", 20)


def describe(spark, sf):
    return profile.describe(table(spark, sf, "lineitem"), LINEITEM)


def column_profile(spark, sf):
    return profile.column_profile(dirty(spark, sf), order_by="event_id")


def column_statistics_numeric(spark, sf):
    return rounded(profile.column_statistics(dirty(spark, sf), "value"))


def column_statistics_categorical(spark, sf):
    return profile.column_statistics(dirty(spark, sf), "event_type")


def size_profile(spark, sf):
    return profile.size_profile(dirty(spark, sf), 15)


def dtype_distribution(spark, sf):
    df = dirty(spark, sf)
    return profile.dtype_distribution(types.apply_types(df, types.fit_types(df, order_by="event_id")))


def duplicate_count(spark, sf):
    return profile.duplicate_count(dirty(spark, sf).select("event_type", "user_id", "whole_float"))


def quality_scores(spark, sf):
    return rounded(profile.quality_scores(dirty(spark, sf).drop("event_id", "ts", "ts_text", "amount_text")))


def duplicate_count_whole(spark, sf):
    return profile.duplicate_count(dirty(spark, sf))


def quality_scores_whole(spark, sf):
    return rounded(profile.quality_scores(dirty(spark, sf)))


def incremental_duplicates(spark, sf):
    """Texts arriving language by language: how many of each chunk were there before, by the digest index."""
    docs = table(spark, sf, "documents")
    index = DuplicateIndex(spark, scratch_path(spark, "digests"), 16)
    for row in docs.select("lang").distinct().orderBy("lang").collect():        # a row per language
        index.add(docs.where(F.col("lang").eqNullSafe(F.lit(row["lang"]))).select("text"), str(row["lang"]))
    return index.chunks()


def datetime_profile(spark, sf):
    return profile.datetime_profile(dirty(spark, sf))


def correlation(spark, sf):
    return rounded(profile.correlation(dirty(spark, sf), DIRTY_NUMERIC))


def dataset_summary(spark, sf):
    return profile.dataset_summary(dirty(spark, sf), order_by="event_id")


def numeric_overview(spark, sf):
    return rounded(profile.numeric_overview(table(spark, sf, "lineitem"), 5))


def compare(spark, sf):
    df = dirty(spark, sf)
    return profile.compare(df, nulls.fill(nulls.drop_sparse_columns(df, 0.7), {"event_type": "Unknown"}))


QUERIES = {f.__name__: f for f in (
    frequency_table, value_counts, describe, column_profile, column_statistics_numeric,
    column_statistics_categorical, size_profile, dtype_distribution, duplicate_count, duplicate_count_whole,
    quality_scores, quality_scores_whole, incremental_duplicates, datetime_profile, correlation, dataset_summary, numeric_overview, compare)}

# ---------------------------------------------------------------- checking SQL


def _describe(c: str) -> str:
    x = f"CAST({c} AS DOUBLE)"
    parts = {"mean": f"avg({x})", "std": f"stddev_samp({x})", "min": f"min({x})",
             "p25": quantile(c, 0.25), "p50": quantile(c, 0.5), "p75": quantile(c, 0.75), "max": f"max({x})"}
    return (f"SELECT '{c}' AS \"column\", count({c}) AS \"count\", "
            + ", ".join(f"{half_even(e)} AS {n}" for n, e in parts.items()) + " FROM lineitem")


def _sample(c: str) -> str:
    return f"substring(min_by(CAST({c} AS VARCHAR), event_id) FILTER ({c} IS NOT NULL), 1, 100)"


def _corr(x: str, y: str) -> str:
    if x == y:
        value = f"CASE WHEN var_samp({x}) > 0 THEN 1.0::DOUBLE END"
    else:
        value = (f"covar_samp({x}, {y}) / nullif(stddev_samp({x}) FILTER ({y} IS NOT NULL) "
                 f"* stddev_samp({y}) FILTER ({x} IS NOT NULL), 0)")
    return f"SELECT '{x}' AS x, '{y}' AS y, {r(value)} AS r FROM dirty"


def facts_sql(source: str, types_of: dict[str, str]) -> str:
    """Rows, columns, nulls and logical bytes of a table, as one row."""
    return (f"SELECT count(*) AS n, {len(types_of)} AS k, "
            + " + ".join(f"(count(*) - count({c}))" for c in types_of) + " AS nulls, CAST("
            + " + ".join(f"({_size(c, t)})" for c, t in types_of.items()) + f" AS BIGINT) AS bytes FROM {source}")


def compare_sql(before: str, before_types: dict, after: str, after_types: dict) -> str:
    removed = sorted(set(before_types) - set(after_types))
    return f"""SELECT b.n AS rows_before, b.k AS columns_before, b.nulls AS nulls_before, b.bytes AS bytes_before,
        a.n AS rows_after, a.k AS columns_after, a.nulls AS nulls_after, a.bytes AS bytes_after,
        b.n - a.n AS rows_removed, {len(removed)} AS columns_removed, '{", ".join(removed)}' AS removed_columns,
        {pct("b.bytes - a.bytes", "b.bytes")} AS bytes_reduction_pct
        FROM ({facts_sql(before, before_types)}) b, ({facts_sql(after, after_types)}) a"""


FEW = ["user_id", "event_type", "value", "whole_float", "constant"]
KEPT = {c: t for c, t in DIRTY_TYPES.items() if c != "user_id"}
KINDS = {"bigint": "numeric", "double": "numeric", "int": "numeric", "smallint": "numeric",
         "string": "categorical", "timestamp_ntz": "datetime"}
_SUMMARY_COUNTS = {k: sum(KINDS[t] == k for t in DIRTY_TYPES.values()) for k in ("numeric", "categorical", "datetime")}

SQL = {
    "frequency_table": f"{DIRTY} " + per_column(
        ["event_type", "whole_float", "user_id", "ts_text"],
        lambda c: f"SELECT '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, count(*) AS \"count\" "
                  f"FROM dirty WHERE {c} IS NOT NULL GROUP BY {c}"),
    "value_counts": f"{DIRTY} SELECT event_type AS value, count(*) AS \"count\" FROM dirty "
                    "WHERE event_type IS NOT NULL GROUP BY event_type ORDER BY 2 DESC, 1 LIMIT 20",
    "describe": per_column(LINEITEM, _describe),
    "column_profile": f"{DIRTY} " + per_column(COLS, lambda c: (
        f"SELECT '{c}' AS \"column\", '{DIRTY_TYPES[c]}' AS dtype, count(*) - count({c}) AS null_count, "
        f"{pct(f'count(*) - count({c})', 'count(*)')} AS null_pct, count(DISTINCT {c}) AS \"distinct\", "
        f"CAST({_size(c, DIRTY_TYPES[c])} AS BIGINT) AS bytes, {_sample(c)} AS sample FROM dirty")),
    "column_statistics_numeric": f"""{DIRTY} SELECT 'value' AS "column", 'Numerical' AS type,
        count(*) - count(value) AS null_count, count(*) AS total_rows, count(DISTINCT value) AS "distinct",
        {r('avg(value)')} AS mean, {r(quantile('value', 0.5))} AS median, {r('stddev_samp(value)')} AS std,
        {r('min(value)')} AS min, {r('max(value)')} AS max, {r('max(value) - min(value)')} AS range,
        CAST(NULL AS VARCHAR) AS mode, {pct('count(*) - count(value)', 'count(*)')} AS null_pct FROM dirty""",
    "column_statistics_categorical": f"""{DIRTY} SELECT 'event_type' AS "column", 'Categorical' AS type,
        count(*) - count(event_type) AS null_count, count(*) AS total_rows,
        count(DISTINCT event_type) AS "distinct", CAST(NULL AS DOUBLE) AS mean, CAST(NULL AS DOUBLE) AS median,
        CAST(NULL AS DOUBLE) AS std, CAST(NULL AS DOUBLE) AS min, CAST(NULL AS DOUBLE) AS max,
        CAST(NULL AS DOUBLE) AS range, {mode_of('event_type', 'dirty')} AS mode,
        {pct('count(*) - count(event_type)', 'count(*)')} AS null_pct FROM dirty""",
    "size_profile": f"""{DIRTY} SELECT "column", bytes, CAST(sum(bytes) OVER () AS BIGINT) AS total_bytes FROM ({
        per_column(COLS, lambda c: f"SELECT '{c}' AS \"column\", CAST({_size(c, DIRTY_TYPES[c])} AS BIGINT) AS bytes FROM dirty")})""",
    "dtype_distribution": f"""{DIRTY} SELECT new_type AS dtype, CASE WHEN new_type = 'string' THEN 'categorical'
        WHEN new_type LIKE 'timestamp%' THEN 'datetime' ELSE 'numeric' END AS role, count(*) AS columns
        FROM ({SCHEMA_REPORT}) GROUP BY 1, 2""",
    "duplicate_count": f"""{DIRTY} SELECT (SELECT count(*) FROM dirty) AS total_rows, (SELECT count(*) FROM dirty)
        - (SELECT count(*) FROM (SELECT DISTINCT event_type, user_id, whole_float FROM dirty)) AS duplicate_rows""",
    "quality_scores": f"""{DIRTY}, t AS (SELECT {", ".join(FEW)} FROM dirty)
        SELECT {r(f"100 - (SELECT {' + '.join(f'(count(*) - count({c}))' for c in FEW)} FROM t) * 100.0::DOUBLE / ({len(FEW)} * (SELECT count(*) FROM t))")} AS completeness,
        {r("(SELECT count(*) FROM (SELECT DISTINCT * FROM t)) * 100.0::DOUBLE / (SELECT count(*) FROM t)")} AS uniqueness,
        {r(f"(SELECT {' + '.join(f'CAST(count(DISTINCT {c}) > 1 AS INTEGER)' for c in FEW)} FROM t) * 100.0::DOUBLE / {len(FEW)}")} AS variability""",
    "quality_scores_whole": f"""{DIRTY}, t AS (SELECT {", ".join(COLS)} FROM dirty)
        SELECT {r(f"100 - (SELECT {' + '.join(f'(count(*) - count({c}))' for c in COLS)} FROM t) * 100.0::DOUBLE / ({len(COLS)} * (SELECT count(*) FROM t))")} AS completeness,
        {r("(SELECT count(*) FROM (SELECT DISTINCT * FROM t)) * 100.0::DOUBLE / (SELECT count(*) FROM t)")} AS uniqueness,
        {r(f"(SELECT {' + '.join(f'CAST(count(DISTINCT {c}) > 1 AS INTEGER)' for c in COLS)} FROM t) * 100.0::DOUBLE / {len(COLS)}")} AS variability""",
    "duplicate_count_whole": f"{DIRTY} SELECT count(*) AS total_rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM dirty)) AS duplicate_rows FROM dirty",
    "incremental_duplicates": """WITH n AS (SELECT text, lang, row_number() OVER (PARTITION BY text ORDER BY lang NULLS FIRST) AS k FROM documents)
        SELECT coalesce(lang, 'None') AS chunk, count(*) AS rows, count(*) FILTER (WHERE k > 1) AS duplicates FROM n GROUP BY lang""",
    "datetime_profile": f"""{DIRTY} SELECT 'ts' AS "column", min(ts) AS earliest, max(ts) AS latest,
        (epoch_us(max(ts)) - epoch_us(min(ts))) // 86400000000 AS range_days, count(ts) AS non_null,
        count(*) - count(ts) AS null_count, {pct('count(*) - count(ts)', 'count(*)')} AS null_pct FROM dirty""",
    "correlation": f"{DIRTY} " + " UNION ALL ".join(_corr(x, y) for x in DIRTY_NUMERIC for y in DIRTY_NUMERIC),
    "dataset_summary": f"""{DIRTY}, f AS ({facts_sql('dirty', DIRTY_TYPES)})
        SELECT 'total_rows' AS metric, CAST(n AS VARCHAR) AS value FROM f
        UNION ALL SELECT 'total_columns', CAST(k AS VARCHAR) FROM f
        UNION ALL SELECT 'total_bytes', CAST(bytes AS VARCHAR) FROM f
        UNION ALL SELECT 'total_nulls', CAST(nulls AS VARCHAR) FROM f
        UNION ALL SELECT 'null_pct', format('{{:.2f}}', CAST(nulls AS DOUBLE) / (n * k) * 100) FROM f
        UNION ALL SELECT 'columns_with_nulls', CAST(count(*) AS VARCHAR) FROM ({COUNTS}) WHERE null_count > 0
        UNION ALL SELECT * FROM (VALUES ('boolean_columns', '0'), {", ".join(f"('{k}_columns', '{n}')" for k, n in _SUMMARY_COUNTS.items())})
        UNION ALL """ + per_column(COLS, lambda c: f"SELECT 'sample:{c}', min_by(CAST({c} AS VARCHAR), event_id) FILTER ({c} IS NOT NULL) FROM dirty"),
    "numeric_overview": per_column(
        ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"],
        lambda c: f"SELECT '{c}' AS \"column\", {r(f'avg({c})')} AS mean, {r(quantile(c, 0.5))} AS median, "
                  f"{r(f'stddev_samp({c})')} AS std, {r(f'min({c})')} AS min, {r(f'max({c})')} AS max, "
                  f"{r(f'max({c}) - min({c})')} AS range FROM lineitem"),
    "compare": f"{DIRTY}, filled AS (SELECT * REPLACE (coalesce(event_type, 'Unknown') AS event_type) FROM dirty) "
               + compare_sql("dirty", DIRTY_TYPES, "filled", KEPT),
}
