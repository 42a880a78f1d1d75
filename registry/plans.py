"""Whole cleaning runs, presets and their reports."""

from __future__ import annotations

from registry.common import DIRTY, DIRTY_NUMERIC, DIRTY_TYPES, bounds_sql, dirty, long_rows, median_time, mode_of, pct, quantile, r, rounded
from registry.nulls import null_report_sql
from registry.outliers import REPORT_DOUBLES, clamp, outlier_report_sql
from registry.profile import compare_sql
from registry.types import SCHEMA_REPORT
from winnow.plans import cleaning, reports
from winnow.plans.batch import batch_job
from winnow.plans.config import Config, preset
from winnow.session import scratch_path
from winnow.sources.sinks import MOMENT

CFG = Config(order_by="event_id")


def _raw(spark, sf):
    return dirty(spark, sf)


def full_clean(spark, sf):
    return rounded(cleaning.clean(_raw(spark, sf), CFG)[0])


def step_clean(spark, sf):
    return rounded(cleaning.run_steps(_raw(spark, sf), CFG.with_(drop_threshold=0.5)).cleaned)


def _preset(name):
    def query(spark, sf):
        return rounded(cleaning.clean(_raw(spark, sf), preset(name).with_(order_by="event_id"))[0])
    return query


def run_full_report(spark, sf):
    return rounded(reports.report_table(cleaning.run_full(_raw(spark, sf), CFG).reports), 3)


def run_summary(spark, sf):
    return reports.run_summary(cleaning.run_full(_raw(spark, sf), CFG).reports, CFG)


def quality_cards(spark, sf):
    return reports.quality_cards(reports.report_table(cleaning.run_full(_raw(spark, sf), CFG).reports))


def batch(spark, sf):
    """Raw rows to a file, one batch job over it, and the cleaned file read back."""
    source, output = scratch_path(spark, "batch-in") + ".parquet", scratch_path(spark, "batch-out")
    _raw(spark, sf).write.parquet(source)
    batch_job(spark, source, output, CFG)
    return rounded(spark.read.options(header=True, timestampNTZFormat=MOMENT).schema(
        "event_id bigint, ts timestamp_ntz, event_type string, value double, amount_text string, "
        "ts_text timestamp_ntz, whole_float smallint, constant int").csv(f"{output}/data"))


QUERIES = {f.__name__: f for f in (full_clean, step_clean, run_full_report, run_summary, quality_cards)}
QUERIES |= {f"preset_{n}": _preset(n) for n in ("balanced", "aggressive", "conservative")}
QUERIES["batch_job"] = batch

# ---------------------------------------------------------------- checking SQL

TYPED = ("typed AS (SELECT event_id, ts, user_id, event_type, value, amount_text, CAST(ts_text AS TIMESTAMP) AS ts_text, "
         "CAST(whole_float AS SMALLINT) AS whole_float, constant FROM dirty)")


def clean_ctes(factor: float, strategy: str, keep_ts_text: bool = True) -> str:
    """CTEs from ``dirty`` to ``cleaned``. ``user_id`` is 80 % null and always goes."""
    number = {"median": quantile("value", 0.5), "mean": "avg(value)", "most_frequent": mode_of("value", "typed")}[strategy]
    moment = (lambda c: median_time(c)) if strategy == "median" else (lambda c: f"max({c})")
    text = "coalesce(ts_text, f.tt) AS ts_text, " if keep_ts_text else ""
    return f"""{DIRTY}, {TYPED},
      f AS (SELECT {number} AS v, {moment('ts')} AS t, {moment('ts_text')} AS tt FROM typed),
      imputed AS (SELECT event_id, coalesce(ts, f.t) AS ts, coalesce(event_type, {mode_of('event_type', 'typed')}) AS event_type,
        coalesce(value, f.v) AS value, amount_text, {text}whole_float, constant FROM typed, f),
      vb AS ({bounds_sql(['value'], 'imputed', factor)}),
      cleaned AS (SELECT imputed.* REPLACE ({clamp('value', 'vb')} AS value) FROM imputed, vb)"""


def clean_sql(*args, **kwargs) -> str:
    return f"{clean_ctes(*args, **kwargs)} SELECT * REPLACE ({r('value')} AS value) FROM cleaned"


CLEANED_TYPES = {c: t for c, t in dict(DIRTY_TYPES, ts_text="timestamp_ntz", whole_float="smallint").items() if c != "user_id"}
FINAL = f"""SELECT 'final' AS stage, *, {pct("nulls_before - nulls_after", "nulls_before")} AS null_reduction_pct,
    'type_enforcer, null_handler, outlier_handler' AS steps, 1.5::DOUBLE AS outlier_factor,
    0.7::DOUBLE AS drop_threshold, 'median' AS impute_strategy
    FROM ({compare_sql("dirty", DIRTY_TYPES, "cleaned", CLEANED_TYPES)})"""
NULLS = f"SELECT 'raw' AS stage, CAST(to_drop AS INTEGER) AS to_drop, * EXCLUDE (to_drop) FROM ({null_report_sql(0.7)})"
OUTLIERS = f"SELECT 'raw' AS stage, * FROM ({outlier_report_sql(DIRTY_NUMERIC, 'dirty', 1.5)})"
SCHEMA = f"SELECT 'raw' AS stage, * FROM ({SCHEMA_REPORT})"
FACTS = [f"{m}_{s}" for s in ("before", "after") for m in ("rows", "columns", "nulls", "bytes")]
LONG = " UNION ALL ".join([
    long_rows("final", FINAL, FACTS + ["rows_removed", "columns_removed", "bytes_reduction_pct", "null_reduction_pct",
                                       "outlier_factor", "drop_threshold"],
              ["stage", "removed_columns", "steps", "impute_strategy"], None),
    long_rows("schema", SCHEMA, ["bytes_before", "bytes_after", "bytes_saved", "values_lost"],
              ["stage", "original_type", "new_type", "role"]),
    long_rows("missing_values", NULLS, ["total_rows", "null_count", "to_drop", "fill_number", "null_pct"],
              ["stage", "fill_text"]),
    long_rows("outliers", OUTLIERS, ["outlier_count", "normal_count", *REPORT_DOUBLES], ["stage", "method"]),
])
BASE = clean_ctes(1.5, "median")

SQL = {
    "full_clean": clean_sql(1.5, "median"),
    "step_clean": clean_sql(1.5, "median"),
    "batch_job": clean_sql(1.5, "median"),
    "preset_balanced": clean_sql(1.5, "median"),
    "preset_aggressive": clean_sql(2.0, "most_frequent", keep_ts_text=False),
    "preset_conservative": clean_sql(1.2, "mean"),
    "run_full_report": f'{BASE} SELECT report, "column", metric, {r("number", 3)} AS number, text FROM ({LONG})',
    "run_summary": f"""{BASE} SELECT rows_before, columns_before, rows_after, columns_after, removed_columns, steps,
        outlier_factor, drop_threshold, impute_strategy,
        'final, schema, missing_values, outliers' AS reports_generated FROM ({FINAL})""",
    "quality_cards": f"""{BASE}, l AS ({LONG}) SELECT report, count(DISTINCT "column") AS columns,
        CAST(sum(number) FILTER (metric = 'null_count') AS BIGINT) AS total_nulls,
        {pct("sum(number) FILTER (metric = 'null_count')", "sum(number) FILTER (metric = 'total_rows')")} AS null_pct,
        CAST(sum(number) FILTER (metric = 'to_drop') AS BIGINT) AS columns_to_drop,
        CAST(sum(number) FILTER (metric = 'outlier_count') AS BIGINT) AS total_outliers,
        CAST(sum(CASE WHEN number > 0 THEN 1 ELSE 0 END) FILTER (metric = 'outlier_count') AS BIGINT) AS columns_with_outliers
        FROM l GROUP BY report""",
}
