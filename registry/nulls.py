"""Missing values."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.common import (
    DIRTY, DIRTY_COLUMNS, DIRTY_NUMERIC, DIRTY_TYPES, dirty, median_time, mode_of, pct, per_column,
    quantile, r, rounded, table,
)
from winnow.operators import increments, nulls
from winnow.plans.stages import NullHandler
from winnow.session import scratch_path

COLS = list(DIRTY_COLUMNS)


def null_profile(spark, sf):
    return nulls.null_profile(dirty(spark, sf))


def null_distribution(spark, sf):
    return nulls.null_distribution(dirty(spark, sf))


def drop_sparse_columns(spark, sf):
    return nulls.drop_sparse_columns(dirty(spark, sf), 0.7)


def impute_mean(spark, sf):
    return rounded(nulls.impute_mean(dirty(spark, sf).select("event_id", "value", "user_id")))


def impute_median(spark, sf):
    return rounded(nulls.impute_median(dirty(spark, sf).select("event_id", "value", "whole_float")))


def impute_mode(spark, sf):
    df = dirty(spark, sf).select("event_id", "event_type", "user_id")
    return nulls.impute_mode(df, ["event_type", "user_id"])


def impute_mode_texts(spark, sf):
    """Whole texts, each gap filled with the commonest text of the table."""
    docs = table(spark, sf, "documents").selectExpr(
        "doc_id", "CASE WHEN doc_id % 7 = 0 THEN NULL ELSE text END AS text", "CASE WHEN doc_id % 5 = 0 THEN NULL ELSE source END AS source")
    return nulls.impute_mode(docs, ["text", "source"])


def incremental_fit(spark, sf):
    """Days of events kept as mergeable state, merged, and compared with the rows where they are estimates."""
    df, path = dirty(spark, sf), scratch_path(spark, "states")
    increments.add_chunks(df, path, F.substring(F.col("ts").cast("string"), 1, 10))
    state = increments.merged(spark, path)
    medians = {c: state.columns[c].stats.grid[increments.GRID // 2] for c in DIRTY_NUMERIC}
    ranks = df.agg(*[f for c, m in medians.items() for f in (
        F.count_if(F.col(c) < m).alias(f"below_{c}"), F.count_if(F.col(c) <= m).alias(f"upto_{c}"))]).first()

    def within(c: str) -> bool:
        n = state.columns[c].stats.count
        slack = increments.RANK_ERROR * n + 1
        return ranks[f"below_{c}"] - slack <= n / 2 <= ranks[f"upto_{c}"] + slack

    checked = spark.createDataFrame([(c, within(c)) for c in DIRTY_NUMERIC], "column string, median_within boolean")
    return rounded(increments.state_table(spark, state).drop("distinct_estimate").join(F.broadcast(checked), "column"))


def impute_constant(spark, sf):
    return nulls.impute_constant(dirty(spark, sf).select("event_id", "event_type", "ts_text"))


def impute_datetime_median(spark, sf):
    return nulls.impute_datetime(dirty(spark, sf).select("event_id", "ts"), ["ts"], "median")


def impute_datetime_latest(spark, sf):
    return nulls.impute_datetime(dirty(spark, sf).select("event_id", "ts"), ["ts"], "latest")


def null_handler(spark, sf):
    df = dirty(spark, sf)
    return rounded(NullHandler(threshold=0.7, strategy="most_frequent").fit(df).transform(df))


def null_report(spark, sf):
    return rounded(nulls.null_report(dirty(spark, sf), 0.7))


def drop_what_if(spark, sf):
    return nulls.drop_what_if(dirty(spark, sf), 30)


def top_missing(spark, sf):
    return nulls.top_missing(dirty(spark, sf), 3)


def null_reduction(spark, sf):
    df = dirty(spark, sf)
    return nulls.null_reduction(df, NullHandler(threshold=0.7).fit(df).transform(df))


QUERIES = {f.__name__: f for f in (
    null_profile, null_distribution, drop_sparse_columns, impute_mean, impute_median, impute_mode,
    impute_mode_texts, incremental_fit, impute_constant, impute_datetime_median, impute_datetime_latest, null_handler, null_report,
    drop_what_if, top_missing, null_reduction)}

# ---------------------------------------------------------------- checking SQL

COUNTS = per_column(COLS, lambda c: (
    f"SELECT '{c}' AS \"column\", count(*) AS total_rows, count(*) - count({c}) AS null_count FROM dirty"))
PROFILE = f'SELECT "column", total_rows, null_count, {pct("null_count", "total_rows")} AS null_pct FROM ({COUNTS})'


def _fill_number(c: str) -> str:
    return quantile(c, 0.5) if c in DIRTY_NUMERIC else "CAST(NULL AS DOUBLE)"


def _fill_text(c: str) -> str:
    if c == "ts":
        return f"strftime({median_time(c)}, '%Y-%m-%d %H:%M:%S.%f')"
    return mode_of(c, "dirty") if DIRTY_TYPES[c] == "string" else "CAST(NULL AS VARCHAR)"


def null_report_sql(threshold: float) -> str:
    """Nulls, drop decision and median-strategy fill per column of the view ``dirty``."""
    facts = per_column(COLS, lambda c: (
        f"SELECT '{c}' AS \"column\", count(*) AS total_rows, count(*) - count({c}) AS null_count, "
        f"{_fill_number(c)} AS number, {_fill_text(c)} AS text FROM dirty"))
    filled = f"null_count > 0 AND null_count <= {threshold}::DOUBLE * total_rows"
    return f"""SELECT "column", total_rows, null_count, null_count > {threshold}::DOUBLE * total_rows AS to_drop,
        CASE WHEN {filled} THEN number END AS fill_number, CASE WHEN {filled} THEN text END AS fill_text,
        {pct("null_count", "total_rows")} AS null_pct FROM ({facts})"""


SQL = {
    "null_profile": f"{DIRTY} {PROFILE}",
    "null_distribution": f"""{DIRTY}, p AS (SELECT null_count / total_rows AS s FROM ({COUNTS}))
        SELECT b AS bucket, (SELECT count(*) FROM p WHERE CASE b WHEN '0%' THEN s = 0
            WHEN '1-10%' THEN s > 0 AND s <= 0.1 WHEN '10-50%' THEN s > 0.1 AND s <= 0.5 ELSE s > 0.5 END) AS columns
        FROM (VALUES ('0%'), ('1-10%'), ('10-50%'), ('>50%')) v(b)""",
    "drop_sparse_columns": f"{DIRTY} SELECT event_id, ts, event_type, value, amount_text, ts_text, whole_float, "
                           "constant FROM dirty",
    "impute_mean": f"""{DIRTY}, f AS (SELECT avg(value) AS v, avg(user_id) AS u FROM dirty)
        SELECT event_id, {r('coalesce(value, v)')} AS value, {r('coalesce(CAST(user_id AS DOUBLE), u)')} AS user_id FROM dirty, f""",
    "impute_median": f"""{DIRTY}, f AS (SELECT {quantile('value', 0.5)} AS v FROM dirty)
        SELECT event_id, {r('coalesce(value, v)')} AS value, whole_float FROM dirty, f""",
    "impute_mode": f"""{DIRTY} SELECT event_id, coalesce(event_type, {mode_of('event_type', 'dirty')}) AS event_type,
        coalesce(user_id, {mode_of('user_id', 'dirty')}) AS user_id FROM dirty""",
    "impute_mode_texts": f"""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 7 = 0 THEN NULL ELSE text END AS text,
        CASE WHEN doc_id % 5 = 0 THEN NULL ELSE source END AS source FROM documents)
        SELECT doc_id, coalesce(text, {mode_of('text', 'd')}) AS text, coalesce(source, {mode_of('source', 'd')}) AS source FROM d""",
    "incremental_fit": f"{DIRTY} " + per_column(DIRTY_NUMERIC, lambda c: f"""
        SELECT '{c}' AS "column", count(*) AS rows, count(*) - count({c}) AS nulls, {r(f'avg({c})')} AS mean,
               {r(f'stddev_samp({c})')} AS std, {r(f'min({c})')} AS min, {r(f'max({c})')} AS max, true AS median_within FROM dirty"""),
    "impute_constant": f"{DIRTY} SELECT event_id, coalesce(event_type, 'Unknown') AS event_type, "
                       "coalesce(ts_text, 'Unknown') AS ts_text FROM dirty",
    "impute_datetime_median": f"{DIRTY}, f AS (SELECT {median_time('ts')} AS m FROM dirty) "
                              "SELECT event_id, coalesce(ts, m) AS ts FROM dirty, f",
    "impute_datetime_latest": f"{DIRTY}, f AS (SELECT max(ts) AS m FROM dirty) "
                              "SELECT event_id, coalesce(ts, m) AS ts FROM dirty, f",
    "null_handler": f"""{DIRTY} SELECT event_id, coalesce(ts, (SELECT max(ts) FROM dirty)) AS ts,
        coalesce(event_type, {mode_of('event_type', 'dirty')}) AS event_type,
        {r(f"coalesce(value, {mode_of('value', 'dirty')})")} AS value, amount_text,
        coalesce(ts_text, {mode_of('ts_text', 'dirty')}) AS ts_text, whole_float, constant FROM dirty""",
    "null_report": f"{DIRTY} SELECT * REPLACE ({r('fill_number')} AS fill_number, {r('null_pct')} AS null_pct) "
                   f"FROM ({null_report_sql(0.7)})",
    "drop_what_if": f"""{DIRTY} SELECT "column", null_count, null_pct,
        CASE WHEN null_pct > 30 THEN 'drop' ELSE 'keep' END AS action,
        CAST(sum(null_count) OVER () AS BIGINT) AS total_nulls,
        {pct("sum(null_count) OVER ()", "sum(total_rows) OVER ()")} AS overall_null_pct FROM ({PROFILE})""",
    "top_missing": f'{DIRTY} SELECT * FROM ({PROFILE}) WHERE null_count > 0 ORDER BY null_pct DESC, "column" LIMIT 3',
    "null_reduction": f"""{DIRTY} SELECT CAST(sum(null_count) AS BIGINT) AS nulls_before, CAST(0 AS BIGINT) AS nulls_after,
        100.0::DOUBLE AS reduction_pct FROM ({COUNTS})""",
}
