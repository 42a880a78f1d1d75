"""Streams over the given tables, written as files that arrive."""

from __future__ import annotations

from pyspark.sql import functions as F

from registry.common import DIRTY, dirty, rounded
from registry.plans import CFG, clean_sql
from winnow.plans import cleaning
from winnow.session import scratch_path
from winnow.streaming import clean, totals

ROWS_PER_FILE = 100_000
BYTES_PER_TRIGGER = 1 << 30


def _arriving(spark, sf):
    """The raw rows in the files their partitions give, read as a stream."""
    path = scratch_path(spark, "arriving")
    raw = dirty(spark, sf)
    raw.write.option("maxRecordsPerFile", ROWS_PER_FILE).parquet(path)
    return clean.read_stream(spark, path, raw.schema, bytes_per_trigger=BYTES_PER_TRIGGER)


def stream_clean(spark, sf):
    model = cleaning.cleaning_pipeline(CFG).fit(dirty(spark, sf))
    out = scratch_path(spark, "cleaned")
    query = clean.write_stream(clean.apply_stream(_arriving(spark, sf), model), out, scratch_path(spark, "offsets"))
    query.awaitTermination()
    return rounded(spark.read.parquet(out))


def stream_progress(spark, sf):
    """Rows and bytes of text of each event type, added up chunk by chunk."""
    out = scratch_path(spark, "progress")
    counted = totals.running_totals(_arriving(spark, sf), F.col("event_type"), F.octet_length("ts_text"))
    totals.record_totals(counted, out, scratch_path(spark, "offsets")).awaitTermination()
    return totals.latest(spark, out).drop("chunks")


QUERIES = {f.__name__: f for f in (stream_clean, stream_progress)}
SQL = {
    "stream_clean": clean_sql(1.5, "median"),
    "stream_progress": f"""{DIRTY} SELECT coalesce(event_type, 'missing') AS key, count(*) AS rows, count(*) AS total_rows,
        CAST(coalesce(sum(strlen(ts_text)), 0) AS BIGINT) AS total_bytes FROM dirty GROUP BY 1""",
}
