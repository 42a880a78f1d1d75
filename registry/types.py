"""Projections, filters and type enforcement."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.common import DIRTY, DIRTY_COLUMNS, DIRTY_TYPES, bounds_sql, dirty, per_column, r, rounded, table
from winnow.operators import outliers, projection, types

PRICES = ["l_quantity", "l_extendedprice"]


def select_numeric(spark, sf):
    return projection.select_by_role(table(spark, sf, "lineitem"), "numeric")


def drop_columns(spark, sf):
    return projection.drop_columns(table(spark, sf, "orders"), ["o_orderdate", "o_orderpriority", "absent"])


def drop_nulls(spark, sf):
    return projection.drop_nulls(dirty(spark, sf).select("event_id", "value"), "value")


def outlier_rows(spark, sf):
    df = table(spark, sf, "events").select("event_id", "value")
    return projection.outside(df, outliers.fit_bounds(df, ["value"]))


def between_all(spark, sf):
    df = table(spark, sf, "documents").select("doc_id", "n_chars")
    return projection.between_all(df, outliers.fit_bounds(df, ["doc_id", "n_chars"]))


def classify_columns(spark, sf):
    return types.classify_columns(dirty(spark, sf), order_by="event_id")


def date_named_columns(spark, sf):
    return types.date_named_columns(table(spark, sf, "orders"))


def date_parse_ratio(spark, sf):
    return rounded(types.date_parse_ratio(dirty(spark, sf), order_by="event_id"))


def infer_date_format(spark, sf):
    return types.infer_date_format(dirty(spark, sf), ["ts_text", "event_type"], order_by="event_id")


def parse_dates(spark, sf):
    df = dirty(spark, sf).select(
        "event_id", "ts_text", F.col("ts_text").alias("ts_exact"),
        F.expr("substring(ts_text, 1, 10)").alias("day_text"))
    df = types.parse_dates(df, ["ts_text", "day_text"], order_by="event_id")
    return types.parse_dates(df, ["ts_exact"], exact=True, order_by="event_id")


def parse_dates_mixed(spark, sf):
    """Plain days, days with a T and a time, days in American order, and junk in one column."""
    form = "CASE event_id % 4 WHEN 0 THEN 'yyyy-MM-dd' WHEN 1 THEN \"yyyy-MM-dd'T'HH:mm:ss\" WHEN 2 THEN 'MM/dd/yyyy' END"
    df = dirty(spark, sf).select("event_id", F.expr(f"coalesce(date_format(ts, {form}), '-')").alias("mixed"))
    return types.parse_dates(df, ["mixed"])


def classify_late_dates(spark, sf):
    """Text that turns to dates after the first hundred rows, and text that stops being dates there."""
    df = dirty(spark, sf).select(
        "event_id", F.expr("IF(event_id < 100, 'pending', CAST(ts AS STRING))").alias("late"),
        F.expr("IF(event_id < 100, CAST(ts AS STRING), 'code')").alias("early"))
    return types.classify_columns(df, order_by="event_id")


def coerce_numeric(spark, sf):
    return types.coerce_numeric(dirty(spark, sf).select("event_id", "amount_text"), ["amount_text"])


def narrow_integers(spark, sf):
    df = dirty(spark, sf).select(
        "event_id", "whole_float", "value", F.expr("whole_float * 100 - 200").alias("signed"),
        F.expr("CAST(user_id AS DOUBLE)").alias("user_id"))
    return types.narrow_integers(df)


def narrow_floats(spark, sf):
    return types.narrow_floats(dirty(spark, sf).select("event_id", "value"))


def tag_categoricals(spark, sf):
    tagged = types.tag_categoricals(dirty(spark, sf))
    return spark.createDataFrame(list(types.categorical_roles(tagged).items()), "column string, role string")


def schema_report(spark, sf):
    return types.schema_report(dirty(spark, sf), order_by="event_id")


def type_changes(spark, sf):
    df = dirty(spark, sf)
    return types.type_changes(df, types.apply_types(df, types.fit_types(df, order_by="event_id")))


QUERIES = {f.__name__: f for f in (
    select_numeric, drop_columns, drop_nulls, outlier_rows, between_all, classify_columns,
    date_named_columns, date_parse_ratio, infer_date_format, parse_dates, parse_dates_mixed,
    classify_late_dates, coerce_numeric,
    narrow_integers, narrow_floats, tag_categoricals, schema_report, type_changes)}

# ---------------------------------------------------------------- checking SQL

TEXTS = ["event_type", "amount_text", "ts_text"]


def _sampled(c: str) -> str:
    return (f"SELECT '{c}' AS \"column\", count(*) AS sampled, "
            f"count(CASE WHEN regexp_matches(v, '^\\s*\\d{{4}}\\D') THEN TRY_CAST(v AS TIMESTAMP) END) AS parsed "
            f"FROM (SELECT {c} AS v FROM dirty WHERE {c} IS NOT NULL ORDER BY event_id LIMIT 100)")


SAMPLED = per_column(TEXTS, _sampled)

# Role by type; a text column is a date when more than 80 % of its sample parses.
ROLES = f"""
  SELECT c."column", c.dtype, CASE
      WHEN c.dtype LIKE 'timestamp%' OR s.parsed > 0.8 * s.sampled THEN 'date'
      WHEN c.dtype IN ('bigint', 'double', 'int') THEN 'numerical' ELSE 'categorical' END AS role
  FROM (VALUES {", ".join(f"('{c}', '{t}')" for c, t in DIRTY_TYPES.items())}) c("column", dtype)
  LEFT JOIN ({SAMPLED}) s ON s."column" = c."column"
"""

WIDTHS = {"bigint": 8, "timestamp_ntz": 8, "double": 8, "int": 4, "smallint": 2}


def _size(c: str, dtype: str) -> str:
    return f"sum(strlen({c}))" if dtype == "string" else f"count(*) * {WIDTHS[dtype]}"


# What typing does to the view: whole floats within 0..255 narrow, parsed text becomes a date.
TYPED = dict(DIRTY_TYPES, ts_text="timestamp_ntz", whole_float="smallint")
_CASTS = {"timestamp_ntz": "TIMESTAMP", "smallint": "SMALLINT"}
SCHEMA_REPORT = f"""
  SELECT s."column", s.original_type, s.new_type, r.role, s.bytes_before, s.bytes_after,
         s.bytes_before - s.bytes_after AS bytes_saved, s.values_lost
  FROM ({per_column(list(DIRTY_COLUMNS), lambda c: f'''
    SELECT '{c}' AS "column", '{DIRTY_TYPES[c]}' AS original_type, '{TYPED[c]}' AS new_type,
           CAST({_size(c, DIRTY_TYPES[c])} AS BIGINT) AS bytes_before,
           CAST({_size(c, TYPED[c])} AS BIGINT) AS bytes_after,
           count({c}) - count(TRY_CAST({c} AS {_CASTS.get(TYPED[c], "VARCHAR")})) AS values_lost FROM dirty''')}) s
  JOIN ({ROLES}) r ON r."column" = s."column"
"""

SQL = {
    "select_numeric": "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, "
                      "l_discount, l_tax FROM lineitem",
    "drop_columns": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "drop_nulls": f"{DIRTY} SELECT event_id, value FROM dirty WHERE value IS NOT NULL",
    "outlier_rows": f"WITH b AS ({bounds_sql(['value'], 'events')}) "
                    "SELECT event_id, value FROM events, b WHERE value < lower OR value > upper",
    "between_all": f"WITH b AS ({bounds_sql(['n_chars'], 'documents')}), c AS ({bounds_sql(['doc_id'], 'documents')}) "
                   "SELECT doc_id, n_chars FROM documents, b, c WHERE n_chars BETWEEN b.lower AND b.upper "
                   "AND doc_id BETWEEN c.lower AND c.upper",
    "classify_columns": f"{DIRTY} {ROLES}",
    "date_named_columns": per_column(
        ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"],
        lambda c: f"SELECT '{c}' AS \"column\", regexp_matches('{c}', 'date|time|created|updated') AS date_named, "
                  f"count({c}) AS non_null FROM orders"),
    "date_parse_ratio": f"{DIRTY} SELECT \"column\", sampled, parsed, {r('parsed / sampled')} AS ratio FROM ({SAMPLED})",
    "infer_date_format": f"""{DIRTY} SELECT "column", sample, CASE
        WHEN regexp_matches(sample, '^\\d{{4}}-\\d{{2}}-\\d{{2}} \\d{{2}}:\\d{{2}}:\\d{{2}}') THEN 'yyyy-MM-dd HH:mm:ss' END AS format
        FROM (SELECT 'ts_text' AS "column", min_by(ts_text, event_id) FILTER (ts_text IS NOT NULL) AS sample FROM dirty
        UNION ALL SELECT 'event_type', min_by(event_type, event_id) FILTER (event_type IS NOT NULL) FROM dirty)""",
    "parse_dates": f"""{DIRTY} SELECT event_id, CAST(ts_text AS TIMESTAMP) AS ts_text,
        CASE WHEN length(ts_text) = 19 THEN CAST(ts_text AS TIMESTAMP) END AS ts_exact,
        CAST(substring(ts_text, 1, 10) AS TIMESTAMP) AS day_text FROM dirty""",
    "parse_dates_mixed": f"""{DIRTY} SELECT event_id, CASE event_id % 4 WHEN 0 THEN date_trunc('day', ts)
        WHEN 1 THEN date_trunc('second', ts) WHEN 2 THEN date_trunc('day', ts) END AS mixed FROM dirty""",
    "classify_late_dates": f"""{DIRTY}, t AS (SELECT CASE WHEN event_id < 100 THEN 'pending' ELSE CAST(ts AS VARCHAR) END AS late,
        CASE WHEN event_id < 100 THEN CAST(ts AS VARCHAR) ELSE 'code' END AS early FROM dirty)
        SELECT 'event_id' AS "column", 'bigint' AS dtype, 'numerical' AS role
        UNION ALL SELECT 'late', 'string', CASE WHEN avg(CAST(TRY_CAST(late AS TIMESTAMP) IS NOT NULL AS INTEGER)) > 0.8
            THEN 'date' ELSE 'categorical' END FROM t WHERE late IS NOT NULL
        UNION ALL SELECT 'early', 'string', CASE WHEN avg(CAST(TRY_CAST(early AS TIMESTAMP) IS NOT NULL AS INTEGER)) > 0.8
            THEN 'date' ELSE 'categorical' END FROM t WHERE early IS NOT NULL""",
    "coerce_numeric": f"{DIRTY} SELECT event_id, TRY_CAST(amount_text AS DOUBLE) AS amount_text FROM dirty",
    "narrow_integers": f"{DIRTY} SELECT event_id, CAST(whole_float AS SMALLINT) AS whole_float, value, "
                       "CAST(whole_float * 100 - 200 AS SMALLINT) AS signed, "
                       "CAST(user_id AS INTEGER) AS user_id FROM dirty",
    "narrow_floats": f"{DIRTY} SELECT event_id, CAST(value AS FLOAT) AS value FROM dirty",
    "tag_categoricals": f"{DIRTY} " + per_column(TEXTS, lambda c: (
        f"SELECT '{c}' AS \"column\", CASE WHEN count(DISTINCT {c}) <= 1000 THEN 'categorical' ELSE 'text' END AS role FROM dirty")),
    "schema_report": f"{DIRTY} {SCHEMA_REPORT}",
    "type_changes": f"{DIRTY} SELECT \"column\", original_type AS old_type, new_type FROM ({SCHEMA_REPORT}) "
                    "WHERE original_type <> new_type",
}
