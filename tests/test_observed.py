"""Reports observed while rows are written equal reports computed by scans of their own."""

import pytest
from pyspark.sql import functions as F

from registry.common import dirty
from tests.conftest import SF_SMALL
from winnow.plans import batch, cleaning
from winnow.plans.config import Config
from winnow.sources import sinks


def rows(df):
    return sorted(map(repr, df.select(*[
        F.round(F.col(f"`{f.name}`"), 6).alias(f.name) if f.dataType.simpleString() == "double" else F.col(f"`{f.name}`")
        for f in df.schema]).collect()))


def scans(df):
    return [line for line in df._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in line]


@pytest.mark.parametrize("method", ["iqr", "remove"])
def test_observed_reports_equal_scanned_ones(spark, tmp_path, method):
    cfg = Config(drop_threshold=0.7, clip_method=method)
    df = dirty(spark, SF_SMALL)
    want = cleaning.run_full(df, cfg)
    got = cleaning.run_observed(df, lambda cleaned: cleaned.write.parquet(f"{tmp_path}/out"), cfg)
    assert list(got.reports) == list(want.reports)
    for name in want.reports:
        assert scans(got.reports[name]) == [], name
        assert got.reports[name].columns == want.reports[name].columns
        assert rows(got.reports[name]) == rows(want.reports[name]), name
    assert rows(spark.read.parquet(f"{tmp_path}/out")) == rows(want.cleaned) == rows(got.cleaned)


def test_a_batch_job_scans_nothing_after_the_write(spark, tmp_path):
    sinks.write_csv(dirty(spark, SF_SMALL), f"{tmp_path}/in.csv")
    run = batch.batch_job(spark, f"{tmp_path}/in.csv", f"{tmp_path}/out")
    assert all(scans(r) == [] for r in run.reports.values())
    written = spark.read.option("header", True).csv(f"{tmp_path}/out/data").count()
    assert run.reports["final"].first()["rows_after"] == written


def test_a_table_without_rows(spark, tmp_path):
    df = spark.createDataFrame([], "a double, b string")
    got = cleaning.run_observed(df, lambda cleaned: cleaned.write.parquet(f"{tmp_path}/out"))
    want = cleaning.run_full(df)
    for name in want.reports:
        assert rows(got.reports[name]) == rows(want.reports[name]), name
