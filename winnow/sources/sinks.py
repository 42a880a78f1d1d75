"""Cleaned rows and reports to files."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from winnow.functions.columns import col, kind

MOMENT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """One part file per partition, each with a header. Nested columns go as JSON."""
    flat = df.select(*[
        F.to_json(col(f.name)).alias(f.name) if kind(f.dataType) == "other" else col(f.name)
        for f in df.schema
    ])
    flat.write.mode(mode).options(
        header=True, quote='"', escape='"', timestampFormat=MOMENT, timestampNTZFormat=MOMENT,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)


def write_report(table: DataFrame, path: str, mode: str = "overwrite") -> None:
    """The long report table as JSON lines."""
    table.write.mode(mode).option("ignoreNullFields", False).json(path)
