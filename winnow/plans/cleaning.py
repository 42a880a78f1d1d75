"""The whole cleaning run: types, then nulls, then outliers."""

from __future__ import annotations

import json
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame, functions as F

from winnow.functions.columns import col, numeric_columns, present
from winnow.functions.numbers import half_even, share_pct
from winnow.functions.reshape import observed
from winnow.operators import nulls, outliers, profile, quantiles, types
from winnow.plans.config import Config
from winnow.plans.stages import (
    NullHandler, NullHandlerModel, OutlierHandler, OutlierHandlerModel, TypeEnforcer,
)

# A grid shifted by fills is off by up to two steps more than the sketch it comes from.
FILLED_MARGIN = quantiles.BRACKET + 2 / quantiles.GRID
STEPS = ("type_enforcer", "null_handler", "outlier_handler")


def type_stage(cfg: Config) -> TypeEnforcer:
    lists = {k: list(v) for k, v in (("numerical", cfg.numerical), ("categorical", cfg.categorical),
                                     ("dates", cfg.dates)) if v is not None}
    return TypeEnforcer(
        **lists, formats=json.dumps(dict(cfg.date_formats)), exactDates=cfg.exact_dates,
        singleFloats=cfg.single_floats, maxCategories=cfg.max_categories, orderBy=cfg.order_by)


def null_stage(cfg: Config) -> NullHandler:
    return NullHandler(threshold=cfg.drop_threshold, strategy=cfg.impute_strategy,
                       categoricalImpute=cfg.categorical_impute, compat=cfg.compat, exact=cfg.exact)


def outlier_stage(cfg: Config) -> OutlierHandler:
    return OutlierHandler(factor=cfg.outlier_factor, method=cfg.clip_method, exact=cfg.exact)


def cleaning_pipeline(cfg: Config | None = None) -> Pipeline:
    """Three estimators; each fits on the output of the one before."""
    cfg = cfg or Config()
    return Pipeline(stages=[type_stage(cfg), null_stage(cfg), outlier_stage(cfg)])


@dataclass
class Run:
    """A cleaned table, the model that cleans it, and reports as DataFrames."""

    cleaned: DataFrame
    model: PipelineModel
    config: Config
    reports: dict[str, DataFrame] = field(default_factory=dict)


def quality_reports(df: DataFrame, cfg: Config, stage: str, fit: types.TypeFit | None = None) -> dict[str, DataFrame]:
    """Schema, missing-value and outlier reports of one table, labelled with its stage.

    One measurement of the table serves both the fills and the bounds. The missing-value
    report states median fills whatever the strategy of the run. ``fit`` is the type fit
    of this very table where there is one already.
    """
    label = F.lit(stage).alias("stage")
    fit = fit or types.fit_types(
        df, cfg.numerical, cfg.categorical, cfg.dates, dict(cfg.date_formats),
        cfg.exact_dates, cfg.single_floats, cfg.max_categories, cfg.order_by)
    measured = nulls.measure(df, (0.25, 0.5, 0.75), exact=cfg.exact)
    numeric = {c: s for c, s in measured.stats.items() if c in numeric_columns(df)}
    bounds = outliers.bounds_from(numeric, cfg.outlier_factor)
    return {
        "schema": types.schema_report(df, fit).select(label, "*"),
        "missing_values": nulls.null_report(df, cfg.drop_threshold, measured=measured).select(label, "*"),
        "outliers": outliers.outlier_report(df, bounds).select(label, "*"),
    }


def final_report(before: DataFrame, after: DataFrame, cfg: Config, facts_before: DataFrame | None = None,
                 facts_after: DataFrame | None = None) -> DataFrame:
    """One row: shapes, columns removed, sizes, nulls, steps and settings."""
    return profile.compare(before, after, facts_before, facts_after).select(
        F.lit("final").alias("stage"), "*",
        F.coalesce(half_even(share_pct(F.col("nulls_before") - F.col("nulls_after"), F.col("nulls_before"))),
                   F.lit(100.0)).alias("null_reduction_pct"),
        F.lit(", ".join(STEPS)).alias("steps"),
        F.lit(cfg.outlier_factor).alias("outlier_factor"),
        F.lit(cfg.drop_threshold).alias("drop_threshold"),
        F.lit(cfg.impute_strategy).alias("impute_strategy"),
    )


def fit_cleaning(df: DataFrame, cfg: Config | None = None) -> PipelineModel:
    """What ``cleaning_pipeline(cfg).fit(df)`` gives, with fewer scans.

    Filling nulls with constants changes a distribution in a known way, so the measurement
    made for the fills also brackets the quartiles of the filled table. What is left for
    the outlier step is the scan that settles them, or nothing when estimates will do.
    """
    cfg = cfg or Config()
    type_model = type_stage(cfg).fit(df)
    typed = type_model.transform(df)

    median = nulls.needs_median(cfg.impute_strategy, cfg.compat)

    def imputed(s) -> bool:
        return median and 0 < s.nulls <= cfg.drop_threshold * s.rows

    measured = nulls.measure(typed, (0.5,), imputed, cfg.exact)
    fit = nulls.fit_nulls(typed, cfg.drop_threshold, cfg.impute_strategy, cfg.categorical_impute,
                          cfg.compat, measured)
    null_model = NullHandlerModel(asdict(fit))
    filled = null_model.transform(typed)
    stats = {c: measured.stats[c].filled(nulls.stored_fill(typed, c, fit.fills[c])) if c in fit.fills
             else measured.stats[c] for c in numeric_columns(filled)}
    quantiles.settle(filled, {c: present(filled, c) for c in stats}, stats, outliers.QUARTILES,
                     lambda s: cfg.exact, margin=FILLED_MARGIN)
    bounds = outliers.bounds_from(stats, cfg.outlier_factor)
    return PipelineModel([type_model, null_model,
                          OutlierHandlerModel({"bounds": bounds, "method": cfg.clip_method})])


def clean(df: DataFrame, cfg: Config | None = None) -> tuple[DataFrame, PipelineModel]:
    model = fit_cleaning(df, cfg)
    return model.transform(df), model


def run_full(df: DataFrame, cfg: Config | None = None) -> Run:
    """Clean the table and report on it as it came in. A failure raises."""
    cfg = cfg or Config()
    cleaned, model = clean(df, cfg)
    fit = model.stages[0].fit_result
    reports = {"final": final_report(df, cleaned, cfg), **quality_reports(df, cfg, "raw", fit)}
    return Run(cleaned, model, cfg, reports)


def run_observed(df: DataFrame, write: Callable[[DataFrame], None], cfg: Config | None = None) -> Run:
    """What ``run_full`` gives, with the cleaned table handed to ``write`` and no scan after that.

    Sizes, nulls, lost values and outliers are observed while the cleaned rows pass on their way to the sink, before
    and after cleaning; ``write`` must run the table once, in one action.
    """
    cfg = cfg or Config()
    model = fit_cleaning(df, cfg)
    fit = model.stages[0].fit_result
    measured = nulls.measure(df, (0.25, 0.5, 0.75), exact=cfg.exact)
    bounds = outliers.bounds_from({c: s for c, s in measured.stats.items() if c in numeric_columns(df)}, cfg.outlier_factor)
    missing = nulls.null_report(df, cfg.drop_threshold, measured=measured)

    both, schema = types.pending_schema(df, fit)
    passing, raw_reports = observed(both, [schema, outliers.pending_report(df, bounds), profile.pending_facts(df)])
    plain = model.transform(passing.select(*[col(c) for c in df.columns]))
    cleaned, clean_reports = observed(plain, [profile.pending_facts(plain)])
    write(cleaned)
    schema_rows, outlier_rows, before = raw_reports()
    after, = clean_reports()
    label = F.lit("raw").alias("stage")
    return Run(model.transform(df), model, cfg, {
        "final": final_report(df, plain, cfg, before, after), "schema": schema_rows.select(label, "*"),
        "missing_values": missing.select(label, "*"), "outliers": outlier_rows.select(label, "*")})


def run_steps(df: DataFrame, cfg: Config | None = None) -> Run:
    """The same three steps one at a time, with reports on the cleaned table."""
    cfg = cfg or Config()
    stages, current = [], df
    for stage in (type_stage(cfg), null_stage(cfg), outlier_stage(cfg)):
        fitted = stage.fit(current)
        stages.append(fitted)
        current = fitted.transform(current)
    reports = {"final": final_report(df, current, cfg), **quality_reports(current, cfg, "cleaned")}
    return Run(current, PipelineModel(stages), cfg, reports)
