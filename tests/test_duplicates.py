"""An index of row digests that grows by chunks, against counting everything anew."""

from pyspark.sql import functions as F

from winnow.operators.duplicates import DuplicateIndex
from winnow.operators.profile import duplicate_count


def exchanges(df):
    plan = df._jdf.queryExecution().executedPlan().toString()
    return [line for line in plan.splitlines() if "Exchange" in line], plan


def test_chunks_add_up_to_a_full_count(spark, tmp_path):
    rows = spark.range(4000).select((F.col("id") % 1500).alias("a"), F.when(F.col("id") % 3 == 0, "hot").alias("b"),
                                    (F.col("id") % 4).cast("string").alias("part")).cache()
    index = DuplicateIndex(spark, f"{tmp_path}/index", 4)
    for part in "0123":
        index.add(rows.where(F.col("part") == part).drop("part"), part)
    whole = duplicate_count(rows.drop("part")).first()
    assert tuple(index.totals().first()) == tuple(whole)
    assert index.chunks().count() == 4
    before = sorted(map(tuple, index.chunks().collect()))
    index.add(rows.where("part = '2'").drop("part"), "2")       # a chunk that comes again counts once
    assert sorted(map(tuple, index.chunks().collect())) == before
    again = DuplicateIndex(spark, f"{tmp_path}/index", 4)       # opened anew
    again.add(rows.where("part = '1'").drop("part"), "more")
    assert tuple(again.totals().first()) == (5000, whole["duplicate_rows"] + 1000)
    assert again.chunks().where("chunk = 'more' AND rows = duplicates").count() == 1


def test_only_the_new_chunk_is_shuffled(spark, tmp_path):
    index = DuplicateIndex(spark, f"{tmp_path}/index", 8)
    index.add(spark.range(1000).toDF("a"), "old")
    new = index.fresh(spark.range(500, 1500).toDF("a"), "new")
    assert new.count() == 500
    _, plan = exchanges(new)
    scan = [i for i, line in enumerate(plan.splitlines()) if "Bucketed: true" in line or "SelectedBucketsCount" in line]
    assert scan, plan
    above = plan.splitlines()[scan[0] - 3:scan[0]]
    assert not any("Exchange" in line for line in above), plan


def test_empty_chunks(spark, tmp_path):
    index = DuplicateIndex(spark, f"{tmp_path}/index", 2)
    index.add(spark.createDataFrame([], "a int, b string"), "none")
    index.add(spark.createDataFrame([(None, None), (None, None), (1, "x")], "a int, b string"), "some")
    assert tuple(index.totals().first()) == (3, 1)
