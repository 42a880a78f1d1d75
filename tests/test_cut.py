"""The first rows by ranges against sorting the whole table."""

import pytest
from pyspark.sql import functions as F

from winnow.operators.cut import first_rows


@pytest.fixture(scope="module")
def rows(spark):
    # a third of the rows share a value, some have none, some are equal in every column
    return spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 11 != 1, F.col("id") % 500).cast("int").alias("v"),
        F.when(F.col("id") % 50 == 0, "same").otherwise(F.col("id").cast("string")).alias("t"),
        (F.col("id") / 3).alias("d")).withColumn("d", F.when(F.col("t") != "same", F.col("d"))).repartition(9).cache()


@pytest.mark.parametrize("n", [0, 1, 700, 1500, 2999, 3000, 9000])
@pytest.mark.parametrize("order_by", ["v", "t", "d", None])
def test_ranges_keep_the_rows_a_full_sort_keeps(rows, n, order_by):
    got = first_rows(rows, n, order_by, heap_rows=-1).collect()
    want = first_rows(rows.repartition(4), n, order_by).collect()
    assert sorted(map(repr, got)) == sorted(map(repr, want)) and len(got) == min(n, 3000)
    if order_by is not None and n:
        values = sorted((r[order_by] is not None, r[order_by]) if r[order_by] is not None else (False, 0) for r in rows.collect())
        assert sorted((r[order_by] is not None, r[order_by]) if r[order_by] is not None else (False, 0) for r in got) == values[:n]


def test_an_empty_table(spark):
    df = spark.createDataFrame([], "a int")
    assert first_rows(df, 5, "a", heap_rows=-1).count() == 0 == first_rows(df, 5).count()
