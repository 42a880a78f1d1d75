"""Duplicate rows across chunks that are appended over time.

The digests of all rows seen so far are a table on disk, bucketed by digest. A new chunk shuffles its own digests
to those buckets and meets the table there, so the old part is read but never shuffled; what is new is appended
bucket by bucket. A chunk's digests carry its name: a chunk that comes again is compared with the others only,
and counts once.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession, functions as F

from winnow.operators.profile import row_digest

BUCKETS = 64        # of a new index; more suit larger tables
CHUNKS = "chunk string, rows bigint, duplicates bigint"


class DuplicateIndex:
    """Digests of the rows of all chunks, under a path all executors share.

    ``path`` and ``buckets`` say where it is; another session opens it by giving the same.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = BUCKETS):
        self.spark, self.path, self.buckets = spark, path.rstrip("/"), buckets
        self.table = "winnow_digests_" + hashlib.md5(f"{self.path}/{buckets}".encode()).hexdigest()
        location = f"{self.path}/digests-{buckets}".replace("'", "\\'")
        spark.sql(f"CREATE TABLE IF NOT EXISTS {self.table} (digest BINARY, chunk STRING) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{location}'")

    def _seen(self, chunk: str) -> DataFrame:
        return self.spark.table(self.table).where(F.col("chunk") != chunk).select("digest")

    def fresh(self, df: DataFrame, chunk: str) -> DataFrame:
        """``(digest, n)``: rows of a chunk, folded by digest, that no other chunk has."""
        own = df.groupBy(row_digest(df).alias("digest")).agg(F.count(F.lit(1)).alias("n"))
        return own.repartition(self.buckets, "digest").join(self._seen(chunk).hint("merge"), "digest", "left_anti")

    def add(self, df: DataFrame, chunk: str) -> None:
        """Take a chunk in: count its duplicates, and append the digests that are new."""
        self.spark.catalog.refreshTable(self.table)
        staged = f"{self.path}/chunks/{hashlib.md5(chunk.encode()).hexdigest()}"
        new = self.fresh(df, chunk)
        known = self.spark.table(self.table).where(F.col("chunk") == chunk).limit(1).count() > 0
        if not known:
            (new.select("digest", F.lit(chunk).alias("chunk")).write.mode("append").format("parquet")
             .bucketBy(self.buckets, "digest").sortBy("digest").option("path", f"{self.path}/digests-{self.buckets}")
             .saveAsTable(self.table))
        rows, kept = df.count(), self.spark.table(self.table).where(F.col("chunk") == chunk).count()
        (self.spark.createDataFrame([(chunk, rows, rows - kept)], CHUNKS).coalesce(1)
         .write.mode("overwrite").parquet(staged))

    def chunks(self) -> DataFrame:
        """``(chunk, rows, duplicates)``: rows of each chunk, and how many equal an earlier row."""
        return self.spark.read.schema(CHUNKS).parquet(f"{self.path}/chunks/*")

    def totals(self) -> DataFrame:
        """``(total_rows, duplicate_rows)`` of all chunks, as a full count gives them."""
        return self.chunks().agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
                                 F.coalesce(F.sum("duplicates"), F.lit(0)).alias("duplicate_rows"))
