"""The three cleaning steps as ``pyspark.ml`` stages.

Fitting runs aggregations; a fitted model is a few plain values in JSON and transforms by
one projection or filter, on batch tables and on streams.
"""

from __future__ import annotations

import json
from dataclasses import asdict

from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame

from winnow.operators import nulls, outliers, types


def _param(name: str, doc: str, converter) -> Param:
    return Param(Params._dummy(), name, doc, typeConverter=converter)


def _optional(converter):
    return lambda value: None if value is None else converter(value)


NAMES = _optional(TypeConverters.toListString)


class _Stage(Estimator, DefaultParamsReadable, DefaultParamsWritable):
    """Settings by keyword, with defaults, kept as params."""

    def _settle(self, defaults: dict, given: dict):
        self._setDefault(**defaults)
        self._set(**{k: v for k, v in given.items() if v is not None})

    def _value(self, param: Param):
        return self.getOrDefault(param)


class _Fitted(Model, DefaultParamsReadable, DefaultParamsWritable):
    """A model whose whole state is one JSON text."""

    state = _param("state", "fitted values as JSON", TypeConverters.toString)

    def __init__(self, state: dict | None = None):
        super().__init__()
        if state is not None:
            self._set(state=json.dumps(state))

    @property
    def values(self) -> dict:
        return json.loads(self.getOrDefault(self.state))


class TypeEnforcer(_Stage):
    """Finds column roles, date formats and integer ranges."""

    numerical = _param("numerical", "numeric columns, or None to find them", NAMES)
    categorical = _param("categorical", "categorical columns, or None", NAMES)
    dates = _param("dates", "date columns, or None", NAMES)
    formats = _param("formats", "date formats by column, as JSON", TypeConverters.toString)
    exactDates = _param("exactDates", "refuse fractions of a second", TypeConverters.toBoolean)
    singleFloats = _param("singleFloats", "narrow doubles to floats", TypeConverters.toBoolean)
    maxCategories = _param("maxCategories", "distinct values of a category", TypeConverters.toInt)
    orderBy = _param("orderBy", "column that says which row is first", _optional(TypeConverters.toString))

    @keyword_only
    def __init__(self, *, numerical=None, categorical=None, dates=None, formats=None,
                 exactDates=None, singleFloats=None, maxCategories=None, orderBy=None):
        super().__init__()
        self._settle(dict(numerical=None, categorical=None, dates=None, formats="{}", exactDates=False,
                          singleFloats=False, maxCategories=types.MAX_CATEGORIES, orderBy=None),
                     self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "TypeEnforcerModel":
        fit = types.fit_types(
            dataset, self._value(self.numerical), self._value(self.categorical), self._value(self.dates),
            json.loads(self._value(self.formats)), self._value(self.exactDates),
            self._value(self.singleFloats), self._value(self.maxCategories), self._value(self.orderBy))
        return TypeEnforcerModel(asdict(fit))


class TypeEnforcerModel(_Fitted):
    @property
    def fit_result(self) -> types.TypeFit:
        state = self.values
        return types.TypeFit(**{**state, "roles": types.Roles(**state["roles"])})

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return types.apply_types(dataset, self.fit_result)


class NullHandler(_Stage):
    """Finds sparse columns and fill values."""

    threshold = _param("threshold", "null share above which a column goes", TypeConverters.toFloat)
    strategy = _param("strategy", "mean, median or most_frequent", TypeConverters.toString)
    categoricalImpute = _param("categoricalImpute", "mode or constant", TypeConverters.toString)
    compat = _param("compat", "numbers take the median unless the strategy is mean", TypeConverters.toBoolean)
    exact = _param("exact", "exact medians; False keeps sketch estimates", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, threshold=None, strategy=None, categoricalImpute=None, compat=None, exact=None):
        super().__init__()
        self._settle(dict(threshold=0.5, strategy="median", categoricalImpute="mode", compat=False, exact=True),
                     self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "NullHandlerModel":
        fit = nulls.fit_nulls(dataset, self._value(self.threshold), self._value(self.strategy),
                              self._value(self.categoricalImpute), self._value(self.compat),
                              exact=self._value(self.exact))
        return NullHandlerModel(asdict(fit))


class NullHandlerModel(_Fitted):
    @property
    def fit_result(self) -> nulls.NullFit:
        return nulls.NullFit(**self.values)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        fit = self.fit_result
        return nulls.fill(dataset.drop(*fit.dropped), fit.fills)


class OutlierHandler(_Stage):
    """Finds outlier bounds of the numeric columns."""

    factor = _param("factor", "multiple of the interquartile range", TypeConverters.toFloat)
    method = _param("method", "iqr, remove or winsorize", TypeConverters.toString)
    exact = _param("exact", "exact quartiles; False keeps sketch estimates", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, factor=None, method=None, exact=None):
        super().__init__()
        self._settle(dict(factor=outliers.IQR_FACTOR, method="iqr", exact=True), self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> "OutlierHandlerModel":
        bounds = outliers.fit_bounds(dataset, None, self._value(self.factor), self._value(self.exact))
        return OutlierHandlerModel({"bounds": bounds, "method": self._value(self.method)})


class OutlierHandlerModel(_Fitted):
    @property
    def bounds(self) -> dict[str, dict]:
        return self.values["bounds"]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        if self.values["method"] == "remove":
            return outliers.remove_outliers(dataset, self.bounds)
        return outliers.clip_outliers(dataset, self.bounds)
