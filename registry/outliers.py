"""Outliers."""

from __future__ import annotations

from registry.common import (
    DIRTY, DIRTY_NUMERIC, bounds_sql, dirty, pct, per_column, r, rounded, table,
)
from winnow.operators import outliers
from winnow.plans.stages import OutlierHandler

LINEITEM = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
EVENT_FACTOR = 1.5


def iqr_bounds(spark, sf):
    return rounded(outliers.iqr_bounds(table(spark, sf, "lineitem"), LINEITEM))


def std_bounds(spark, sf):
    return rounded(outliers.iqr_bounds(table(spark, sf, "labels"), ["quality", "toxic"]))


def constant_bounds(spark, sf):
    return rounded(outliers.iqr_bounds(dirty(spark, sf), ["constant", "whole_float"]))


def _events(spark, sf):
    return dirty(spark, sf).select("event_id", "value", "whole_float", "constant")


def remove_outliers(spark, sf):
    df = _events(spark, sf)
    return outliers.remove_outliers(df, outliers.fit_bounds(df))


def clip_outliers(spark, sf):
    df = _events(spark, sf)
    return rounded(outliers.clip_outliers(df, outliers.fit_bounds(df)))


def winsorize(spark, sf):
    df = table(spark, sf, "labels")
    return rounded(outliers.winsorize(df, outliers.fit_bounds(df, ["quality", "toxic"])))


BOTH_ENDS = "CASE WHEN event_id % 89 = 0 THEN -50 * value WHEN event_id % 97 = 0 THEN 50 * value ELSE value END AS value"


def winsorize_both_ends(spark, sf):
    """Values far beyond both bounds."""
    df = table(spark, sf, "events").selectExpr("event_id", BOTH_ENDS)
    return rounded(outliers.winsorize(df, outliers.fit_bounds(df, ["value"])))


def outlier_handler(spark, sf):
    df = table(spark, sf, "documents").select("doc_id", "n_chars")
    return rounded(OutlierHandler(factor=1.5, method="iqr").fit(df).transform(df))


def outlier_report(spark, sf):
    return rounded(outliers.outlier_report(dirty(spark, sf)))


def outlier_summary(spark, sf):
    return outliers.outlier_summary(dirty(spark, sf))


def range_change(spark, sf):
    df = dirty(spark, sf)
    return rounded(outliers.range_change(df, outliers.clip_outliers(df, outliers.fit_bounds(df))))


QUERIES = {f.__name__: f for f in (
    iqr_bounds, std_bounds, constant_bounds, remove_outliers, clip_outliers, winsorize, winsorize_both_ends,
    outlier_handler, outlier_report, outlier_summary, range_change)}

# ---------------------------------------------------------------- checking SQL


def bounds_out(cols: list[str], source: str) -> str:
    return ('SELECT "column", ' + ", ".join(
        f"{r(c)} AS {n}" for c, n in (("lower", "lower"), ("upper", "upper"), ("mn", "min"), ("mx", "max"),
                                      ("q1", "q1"), ("q3", "q3"), ("iqr", "iqr"), ("mean", "mean"), ("std", "std"))
    ) + f", method FROM ({bounds_sql(cols, source)})")


def outlier_report_sql(cols: list[str], source: str, factor: float) -> str:
    def one(c: str) -> str:
        x = f"CAST({c} AS DOUBLE)"
        odd = f"CASE WHEN {x} < lower OR {x} > upper THEN {x} END"
        usual = f"CASE WHEN {x} >= lower AND {x} <= upper THEN {x} END"
        return f"""SELECT '{c}' AS "column", count({odd}) AS outlier_count, min({odd}) AS outlier_min,
            max({odd}) AS outlier_max, avg({odd}) AS outlier_mean, stddev_samp({odd}) AS outlier_std,
            count({usual}) AS normal_count, min({usual}) AS normal_min, max({usual}) AS normal_max,
            avg({usual}) AS normal_mean FROM {source}, (SELECT * FROM b WHERE "column" = '{c}') bb"""

    return f"""WITH b AS ({bounds_sql(cols, source, factor)})
        SELECT s.*, {pct("outlier_count", "outlier_count + normal_count")} AS outlier_pct,
            lower, upper, q1, q3, iqr, method, mn AS original_min, mx AS original_max
        FROM ({per_column(cols, one)}) s JOIN b ON b."column" = s."column" """


REPORT_DOUBLES = ["outlier_min", "outlier_max", "outlier_mean", "outlier_std", "normal_min", "normal_max",
                  "normal_mean", "outlier_pct", "lower", "upper", "q1", "q3", "iqr", "original_min",
                  "original_max"]


def clamp(c: str, alias: str) -> str:
    return f"CASE WHEN {c} < {alias}.lower THEN {alias}.lower WHEN {c} > {alias}.upper THEN {alias}.upper ELSE {c} END"


SUMMARY = outlier_report_sql(DIRTY_NUMERIC, "dirty", EVENT_FACTOR)
SQL = {
    "iqr_bounds": bounds_out(LINEITEM, "lineitem"),
    "std_bounds": bounds_out(["quality", "toxic"], "labels"),
    "constant_bounds": f"{DIRTY} {bounds_out(['constant', 'whole_float'], 'dirty')}",
    "remove_outliers": f"""{DIRTY}, v AS ({bounds_sql(['value'], 'dirty')}), w AS ({bounds_sql(['whole_float'], 'dirty')})
        SELECT event_id, value, whole_float, constant FROM dirty, v, w
        WHERE value BETWEEN v.lower AND v.upper AND whole_float BETWEEN w.lower AND w.upper""",
    "clip_outliers": f"""{DIRTY}, v AS ({bounds_sql(['value'], 'dirty')})
        SELECT event_id, {r(clamp('value', 'v'))} AS value, whole_float, constant FROM dirty, v""",
    "winsorize": f"""WITH q AS ({bounds_sql(['quality'], 'labels')}), t AS ({bounds_sql(['toxic'], 'labels')})
        SELECT doc_id, CAST({clamp('quality', 'q')} AS INTEGER) AS quality, CAST({clamp('toxic', 't')} AS INTEGER) AS toxic
        FROM labels, q, t""",    # no flag lies beyond its bounds, so the columns stay integers
    "winsorize_both_ends": f"""WITH e AS (SELECT event_id, {BOTH_ENDS} FROM events), b AS ({bounds_sql(['value'], 'e')})
        SELECT event_id, {r(clamp('value', 'b'))} AS value FROM e, b""",
    "outlier_handler": f"""WITH b AS ({bounds_sql(['n_chars'], 'documents')})
        SELECT doc_id, {r(clamp('n_chars', 'b'))} AS n_chars FROM documents, b""",
    "outlier_report": f"{DIRTY} SELECT * REPLACE ({', '.join(f'{r(c)} AS {c}' for c in REPORT_DOUBLES)}) "
                      f"FROM ({SUMMARY})",
    "outlier_summary": f"""{DIRTY} SELECT CAST(sum(outlier_count) AS BIGINT) AS total_outliers,
        count(CASE WHEN outlier_count > 0 THEN 1 END) AS columns_with_outliers, count(*) AS total_columns_analyzed,
        1.5::DOUBLE AS outlier_factor, 'iqr' AS clip_method, CAST(NULL AS VARCHAR) AS message FROM ({SUMMARY})""",
    "range_change": f"""{DIRTY}, b AS ({bounds_sql(DIRTY_NUMERIC, 'dirty')})
        SELECT "column", {r('mn')} AS min_before, {r('mx')} AS max_before, {r('greatest(mn, lower)')} AS min_after,
        {r('least(mx, upper)')} AS max_after, mn < lower OR mx > upper AS changed FROM b""",
}
