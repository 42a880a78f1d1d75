"""Wide one-row aggregates to one row per column."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from winnow.functions.columns import text_literal


@dataclass(frozen=True)
class Pending:
    """A report that waits for one row of aggregates: from a scan of its own, or observed in passing."""

    aggs: list[Column]
    finish: Callable[[DataFrame], DataFrame]

    def of(self, df: DataFrame) -> DataFrame:
        return self.finish(df.agg(*self.aggs))


def observed(df: DataFrame, pending: Sequence[Pending]) -> tuple[DataFrame, Callable[[], list[DataFrame]]]:
    """The table with the aggregates of some reports on it, and what makes the reports once it was written.

    The first action on the table takes the aggregates in passing; the reports then hold rows, not plans. A table that
    no task read (it has no rows) is aggregated on its own.
    """
    aggs = [a for p in pending for a in p.aggs]
    schema = df.agg(*aggs).schema
    seen = Observation()

    def reports() -> list[DataFrame]:
        values = seen.get
        if set(values) != set(schema.names):
            return [p.of(df) for p in pending]
        row = df.sparkSession.createDataFrame([tuple(values[c] for c in schema.names)], schema)
        return [p.finish(row) for p in pending]

    return df.observe(seen, *aggs), reports


def pending_rows(
    spark: SparkSession, names: Sequence[str], metrics: Mapping[str, Mapping[str, Column | str]],
    schema: str, label: str = "column",
) -> Pending:
    """``metrics[name][metric]`` for all names as aggregates of one row; one output row per name.

    Metrics are columns or SQL expressions. ``schema`` lists the metric columns with their types, as in a DDL string; each metric
    is cast to it so the rows line up.
    """
    fields = [part.split() for part in schema.split(",")]
    aggs, cells = [], []
    for i, name in enumerate(names):
        cells.append(text_literal(name))
        for metric, dtype in fields:
            value = metrics[name][metric]
            value = F.expr(value) if isinstance(value, str) else value
            aggs.append(value.alias(f"{metric}_{i}"))
            cells.append(f"cast({metric}_{i} as {dtype})")
    shown = ", ".join([label, *[metric for metric, _ in fields]])

    def finish(row: DataFrame) -> DataFrame:
        if not names:
            return spark.createDataFrame([], f"{label} string, {schema}")
        return row.selectExpr(f"stack({len(names)}, {', '.join(cells)}) AS ({shown})")

    return Pending(aggs, finish)


def aggregate_rows(
    df: DataFrame, names: Sequence[str], metrics: Mapping[str, Mapping[str, Column | str]],
    schema: str, label: str = "column",
) -> DataFrame:
    """The rows of ``pending_rows``, computed in one pass over the table."""
    pending = pending_rows(df.sparkSession, names, metrics, schema, label)
    return pending.of(df) if names else pending.finish(df)
