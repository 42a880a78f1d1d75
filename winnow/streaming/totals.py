"""Running totals of a stream, kept as keyed state that survives a restart.

Rows fold to one partial count per key and Arrow batch before they are shuffled, so a key that holds a third of
the rows, or the whole stream under one key, is a few rows a chunk. The state store holds two numbers a key; a
query started again from its checkpoint goes on from them, and a replayed chunk counts once.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

STORE = "spark.sql.streaming.stateStore.providerClass"
# Fixed value: the state store that keeps typed values.
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

PARTIAL = "key string, rows bigint, bytes bigint"
TOTALS = T.StructType([
    T.StructField("key", T.StringType()), T.StructField("chunk", T.LongType()), T.StructField("rows", T.LongType()),
    T.StructField("bytes", T.LongType()), T.StructField("total_rows", T.LongType()),
    T.StructField("total_bytes", T.LongType())])


class _Totals(StatefulProcessor):
    """Adds the partial counts of a chunk to a key's totals."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("totals", "chunks bigint, rows bigint, bytes bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new_rows = new_bytes = 0
        for part in rows:
            new_rows += int(part["rows"].sum())
            new_bytes += int(part["bytes"].sum())
        chunks, total, size = self.state.get() if self.state.exists() else (0, 0, 0)
        now = (int(chunks) + 1, int(total) + new_rows, int(size) + new_bytes)
        self.state.update(now)
        yield pd.DataFrame([(key[0], now[0] - 1, new_rows, new_bytes, now[1], now[2])], columns=TOTALS.names)

    def close(self) -> None:
        pass


def _folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per key of an Arrow batch."""
    for batch in batches:
        parts = pa.Table.from_batches([batch]).group_by("key").aggregate([("bytes", "count"), ("bytes", "sum")])
        parts = parts.select(["key", "bytes_count", "bytes_sum"]).rename_columns(["key", "rows", "bytes"])
        yield from parts.to_batches()


def running_totals(stream: DataFrame, key: Column | None = None, size: Column | None = None) -> DataFrame:
    """``(key, chunk, rows, bytes, total_rows, total_bytes)``: a row per key and chunk that has rows of it.

    Without ``key`` the whole stream counts under ``all``; a null key counts under ``missing``. ``size`` is added
    up as bytes, 0 without it. ``chunk`` numbers the chunks of a key from 0.
    """
    label = F.lit("all") if key is None else F.coalesce(key.cast("string"), F.lit("missing"))
    amount = F.lit(0) if size is None else F.coalesce(size, F.lit(0))
    parts = stream.select(label.alias("key"), amount.cast("bigint").alias("bytes")).mapInArrow(_folded, PARTIAL)
    return parts.groupBy("key").transformWithStateInPandas(
        statefulProcessor=_Totals(), outputStructType=TOTALS, outputMode="Append", timeMode="None")


def record_totals(totals: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append the totals of each chunk to a table until the files present at the start are done."""
    spark = totals.sparkSession
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKS)            # a query keeps the settings it was started with
    try:
        return (totals.writeStream.format("parquet").outputMode("append").option("path", path)
                .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    finally:
        if before is None:
            spark.conf.unset(STORE)
        else:
            spark.conf.set(STORE, before)


def progress(spark: SparkSession, path: str) -> DataFrame:
    """The recorded chunks: rows of each and the running totals."""
    return spark.read.schema(TOTALS).parquet(path)


def latest(spark: SparkSession, path: str) -> DataFrame:
    """Where each key stands: chunks seen and totals."""
    return progress(spark, path).groupBy("key").agg(
        F.count(F.lit(1)).alias("chunks"), F.sum("rows").alias("rows"),
        F.max("total_rows").alias("total_rows"), F.max("total_bytes").alias("total_bytes"))
