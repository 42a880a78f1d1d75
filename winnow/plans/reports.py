"""All reports of a run in one long table, and roll-ups of it."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame, functions as F, types as T

from winnow.functions.columns import col, is_numeric
from winnow.functions.numbers import half_even, share_pct
from winnow.plans.config import Config

REPORT_SCHEMA = "report string, column string, metric string, number double, text string"


def long_form(name: str, report: DataFrame) -> DataFrame:
    """``(report, column, metric, number, text)``: numbers as numbers, the rest as text."""
    key = col("column") if "column" in report.columns else F.lit(None).cast("string")
    cells, metrics = [], [f for f in report.schema if f.name != "column"]
    for f in metrics:
        if is_numeric(f.dataType):
            number, text = col(f.name).cast("double"), F.lit(None).cast("string")
        else:
            number, text = F.lit(None).cast("double"), col(f.name).cast("string")
            if isinstance(f.dataType, T.BooleanType):
                number, text = col(f.name).cast("int").cast("double"), F.lit(None).cast("string")
        cells += [F.lit(f.name), number, text]
    return report.select(
        F.lit(name).alias("report"), key.alias("column"),
        F.stack(F.lit(len(metrics)), *cells).alias("metric", "number", "text"))


def report_table(reports: Mapping[str, DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [long_form(n, r) for n, r in reports.items()])


def quality_cards(table: DataFrame) -> DataFrame:
    """One row per report: columns covered, nulls, drops and outliers where it has them."""
    def total(metric: str):
        return F.sum(F.when(F.col("metric") == metric, F.col("number")))

    return table.groupBy("report").agg(
        F.count_distinct("column").alias("columns"),
        total("null_count").cast("bigint").alias("total_nulls"),
        half_even(share_pct(total("null_count"), total("total_rows"))).alias("null_pct"),
        total("to_drop").cast("bigint").alias("columns_to_drop"),
        total("outlier_count").cast("bigint").alias("total_outliers"),
        F.sum(F.when(F.col("metric") == "outlier_count", (F.col("number") > 0).cast("int")))
        .alias("columns_with_outliers"),
    )


def run_summary(reports: Mapping[str, DataFrame], cfg: Config) -> DataFrame:
    """One row: shapes, removed columns, steps and settings of a run, and its reports."""
    return reports["final"].select(
        "rows_before", "columns_before", "rows_after", "columns_after", "removed_columns", "steps",
        "outlier_factor", "drop_threshold", "impute_strategy",
        F.lit(", ".join(reports)).alias("reports_generated"))
