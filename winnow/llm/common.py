"""Pieces shared by the corpus operators: words, scratch tables, size-checked joins."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from winnow.session import scratch_path

SPACE = "[\\x20\\x09-\\x0D]"
WORD = "[^\\x20\\x09-\\x0D]+"
SPACE_CHARS = " \t\n\x0b\x0c\r"

# A side is broadcast only when this many rows, of a bounded width, were counted in it.
BROADCAST_ROWS = 500_000

ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def text_of(column: str) -> Column:
    """The text, a null counted as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """Evaluate ``value`` once and hand it to ``use``, also where ``use`` names it inside lambdas."""
    return F.element_at(F.transform(F.array(value), use), 1)


def words_of(text: Column) -> Column:
    """Words of a text in order; no words give an empty array."""
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+"))


class Scratch:
    """Intermediate tables in the folder all executors share.

    A written table cuts the lineage and survives lost executors. Tables that a lazy result still
    reads stay; the others are dropped as soon as nothing needs them.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark, self.root = spark, scratch_path(spark, label)

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def write(self, df: DataFrame, name: str) -> DataFrame:
        df.write.parquet(self.path(name))
        return self.spark.read.schema(df.schema).parquet(self.path(name))

    def drop(self, *names: str) -> None:
        for name in names:
            path = self.spark._jvm.org.apache.hadoop.fs.Path(self.path(name))
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def batches_of(spark: SparkSession, size: int) -> Iterator[None]:
    """What is written here hands rows to Python in batches of about ``size`` bytes, or of one larger row."""
    before = spark.conf.get(ARROW_BYTES, None)
    spark.conf.set(ARROW_BYTES, size)
    try:
        yield
    finally:
        spark.conf.unset(ARROW_BYTES) if before is None else spark.conf.set(ARROW_BYTES, before)


def small(df: DataFrame, rows: int | None = None, limit: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if the counted rows are few; otherwise leave the join to shuffles."""
    return F.broadcast(df) if (df.count() if rows is None else rows) <= limit else df


def same(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    """Equality of columns, null equal to null."""
    condition = F.lit(True)
    for a, b in pairs:
        condition = condition & left[a].eqNullSafe(right[b])
    return condition
