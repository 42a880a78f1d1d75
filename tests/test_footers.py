"""Facts from file footers against scans of the columns."""

import datetime as dt
import math

from pyspark.sql import functions as F

from registry.common import dirty
from tests.conftest import SF_SMALL
from winnow.operators import nulls
from winnow.sources import footers


def test_the_plan_reads_footers_only(spark):
    with footers.pushed_down(spark):
        query = footers.footer_query(spark, f"{SF_SMALL}/lineitem.parquet", ["l_orderkey", "l_returnflag"])
        plan = query._jdf.queryExecution().executedPlan().toString()
        assert "PushedAggregation: [COUNT(*)" in plan and "MAX(l_orderkey)" in plan
        assert query.first()["rows"] == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert "parquet" in spark.conf.get("spark.sql.sources.useV1SourceList")


def test_facts_equal_scans(spark, tmp_path):
    df = dirty(spark, SF_SMALL).withColumns({
        "d": F.when(F.col("event_id") % 4 > 0, F.col("ts").cast("date")), "flag": F.col("event_id") % 2 == 0,
        "wild": F.when(F.col("event_id") % 9 == 0, math.nan).when(F.col("event_id") % 7 > 0, F.col("value")),
        "list": F.array("value"), "none": F.lit(None).cast("int"), "money": F.col("value").cast("decimal(12,2)")})
    df.repartition(3).write.parquet(f"{tmp_path}/t")
    facts = footers.file_facts(spark, f"{tmp_path}/t")
    want = {r["column"]: r["null_count"] for r in nulls.null_profile(df).collect()}
    assert {c: f.rows - f.count for c, f in facts.items()} == want
    assert all(f.rows == 1000 for f in facts.values())
    for c in ("event_id", "user_id", "d", "ts", "wild", "money"):
        x = F.col(c) if c != "wild" else F.when(~F.isnan(c), F.col(c))
        row = df.agg(F.min(x).alias("a"), F.max(x).alias("b")).first()
        assert (facts[c].min, facts[c].max) == (row["a"], row["b"]), c
    assert (facts["none"].count, facts["none"].min) == (0, None)
    assert isinstance(facts["d"].min, dt.date)
    profile = {r["column"]: r for r in footers.footer_profile(spark, f"{tmp_path}/t", ["event_id", "flag"]).collect()}
    assert (profile["event_id"]["low"], profile["event_id"]["high"], profile["flag"]["low"]) == (0.0, 999.0, None)


def test_files_without_statistics_and_without_rows(spark, tmp_path):
    df = spark.range(50).select(F.col("id"), F.col("id").cast("string").alias("t"))
    df.write.option("parquet.column.statistics.enabled", "false").parquet(f"{tmp_path}/plain")
    facts = footers.file_facts(spark, f"{tmp_path}/plain")
    assert (facts["id"].min, facts["id"].max, facts["t"].count) == (0, 49, 50)
    df.limit(0).write.parquet(f"{tmp_path}/empty")
    assert footers.file_facts(spark, f"{tmp_path}/empty")["id"] == footers.Fact(0, 0)
