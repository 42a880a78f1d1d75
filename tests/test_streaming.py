"""Streams: bounded chunks, and totals that go on after a restart."""

from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from winnow.streaming import totals
from winnow.streaming.clean import read_stream


def counted(spark, base, schema, key=None):
    stream = read_stream(spark, f"{base}/in", schema, bytes_per_trigger=1)     # a file a trigger
    query = totals.record_totals(totals.running_totals(stream, key), f"{base}/out", f"{base}/offsets")
    query.awaitTermination()
    return query


def test_totals_go_on_after_a_restart(spark, tmp_path):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").withColumn(
        "kind", F.when(F.col("event_type") != "click", F.col("event_type")))
    events.where("event_id % 3 = 0").repartition(2).write.parquet(f"{tmp_path}/in")
    provider = spark.conf.get(totals.STORE)
    counted(spark, tmp_path, events.schema, F.col("kind"))
    assert spark.conf.get(totals.STORE) == provider
    events.where("event_id % 3 > 0").repartition(2).write.mode("append").parquet(f"{tmp_path}/in")
    counted(spark, tmp_path, events.schema, F.col("kind"))
    counted(spark, tmp_path, events.schema, F.col("kind"))      # nothing new arrives
    want = {r["k"]: r["count"] for r in events.groupBy(F.coalesce("kind", F.lit("missing")).alias("k")).count().collect()}
    got = totals.latest(spark, f"{tmp_path}/out").collect()
    assert {r["key"]: r["total_rows"] for r in got} == want and "missing" in want
    assert all(r["rows"] == r["total_rows"] and r["chunks"] == 4 for r in got)
    for key in want:
        rows = totals.progress(spark, f"{tmp_path}/out").where(F.col("key") == key).orderBy("chunk").collect()
        assert [r["chunk"] for r in rows] == [0, 1, 2, 3]
        assert [r["total_rows"] for r in rows] == [sum(x["rows"] for x in rows[:i + 1]) for i in range(4)]


def test_the_whole_stream_is_one_key_without_one(spark, tmp_path):
    spark.range(100).repartition(3).write.parquet(f"{tmp_path}/in")
    counted(spark, tmp_path, spark.read.parquet(f"{tmp_path}/in").schema)
    row = totals.latest(spark, f"{tmp_path}/out").first()
    assert (row["key"], row["total_rows"], row["total_bytes"]) == ("all", 100, 0)
