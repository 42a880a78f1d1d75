"""Cleaning arriving files with a model fitted on a batch."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def apply_stream(stream: DataFrame, model: PipelineModel) -> DataFrame:
    """Projections and filters only: no state, no watermark, any output mode."""
    return model.transform(stream)


def read_stream(spark: SparkSession, path: str, schema, files_per_trigger: int | None = None,
                bytes_per_trigger: int | None = None) -> DataFrame:
    """Arriving Parquet files; a chunk is what one trigger takes, bounded by files or by bytes."""
    reader = spark.readStream.schema(schema)
    if files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    if bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", bytes_per_trigger)
    return reader.parquet(path)


def write_stream(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Append to Parquet until the files present at the start are done; exactly once."""
    return (
        stream.writeStream.format("parquet").outputMode("append")
        .option("path", path).option("checkpointLocation", checkpoint)
        .trigger(availableNow=True).start()
    )
