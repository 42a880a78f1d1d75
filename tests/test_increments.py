"""Chunk states merged on demand against fits of the whole table."""

import math

import pytest
from pyspark.sql import functions as F

from registry.common import dirty
from tests.conftest import SF_SMALL
from winnow.operators import increments, nulls, outliers
from winnow.streaming.clean import read_stream


@pytest.fixture(scope="module")
def rows(spark):
    return dirty(spark, SF_SMALL).withColumn("flag", F.col("event_id") % 3 == 0).withColumn(
        "mostly_null", F.when(F.col("event_id") % 50 == 0, "x")).cache()


@pytest.fixture(scope="module")
def state_path(spark, rows, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('state')}/s"
    increments.add_chunks(rows, path, F.substring(F.col("ts").cast("string"), 1, 10))
    return path


def test_counts_and_moments_equal_a_full_fit(spark, rows, state_path):
    state = increments.merged(spark, state_path)
    assert state.rows == 1000 and state.chunks > 3
    measured = nulls.measure(rows, (0.5,))
    for c, s in measured.stats.items():
        got = state.columns[c].stats
        assert (got.rows, got.count, got.min, got.max) == (s.rows, s.count, s.min, s.max)
        assert math.isclose(got.mean, s.mean, rel_tol=1e-12)
        assert math.isclose(got.std, s.std, rel_tol=1e-9, abs_tol=1e-9)
    assert {c: state.columns[c].stats.count for c in measured.counts} == measured.counts


def test_quantiles_stay_inside_the_stated_error(spark, rows, state_path):
    state = increments.merged(spark, state_path)
    for c in ("value", "user_id", "event_id"):
        values = sorted(r[0] for r in rows.select(F.col(c).cast("double")).collect() if r[0] is not None)
        for i, q in enumerate(state.columns[c].stats.grid):
            below, upto = sum(v < q for v in values), sum(v <= q for v in values)
            share = i / increments.GRID * len(values)
            slack = increments.RANK_ERROR * len(values) + 1
            assert below - slack <= share <= upto + slack


def test_handlers_refit_without_the_rows(spark, rows, state_path):
    state = increments.merged(spark, state_path)
    got, want = increments.refit_nulls(spark, state, categorical="constant"), nulls.fit_nulls(rows, categorical="constant")
    assert (got.total_rows, got.null_counts, got.dropped) == (want.total_rows, want.null_counts, want.dropped)
    assert set(got.fills) == set(want.fills)
    assert {c: v for c, v in got.fills.items() if isinstance(v, str)} == {c: v for c, v in want.fills.items() if isinstance(v, str)}
    for c in ("event_type", "flag", "mostly_null"):
        assert state.columns[c].mode() == str(nulls.mode_fills(rows, [c])[c]).replace("False", "false")
    with pytest.raises(ValueError):         # no value of ts_text is proven the commonest
        increments.refit_nulls(spark, state)
    bounds, full = increments.refit_bounds(state), outliers.fit_bounds(rows)
    assert {c: b["method"] for c, b in bounds.items()} == {c: b["method"] for c, b in full.items()}
    assert {c: (b["min"], b["max"]) for c, b in bounds.items()} == {c: (b["min"], b["max"]) for c, b in full.items()}
    filled = nulls.fill(rows, {"value": 5.0})
    after, exact = increments.refit_bounds(state, fills={"value": 5.0})["value"], outliers.fit_bounds(filled, ["value"])["value"]
    assert math.isclose(after["mean"], exact["mean"]) and after["max"] == exact["max"]


def test_a_chunk_that_comes_again_counts_once(spark, rows, tmp_path):
    path = f"{tmp_path}/s"
    for chunk, part in (("a", "event_id < 300"), ("b", "event_id >= 300"), ("a", "event_id < 300")):
        increments.add_chunk(rows.where(part), path, chunk)
    state = increments.merged(spark, path)
    assert (state.rows, state.chunks) == (1000, 2)
    assert increments.merged(spark, path, ["a"]).rows == rows.where("event_id < 300").count()
    assert increments.state_table(spark, state).where("column = 'value'").first()["rows"] == 1000


def test_states_of_a_stream(spark, rows, tmp_path):
    rows.repartition(3).write.parquet(f"{tmp_path}/in")
    for _ in range(2):      # the second run finds nothing new
        stream = read_stream(spark, f"{tmp_path}/in", rows.schema, files_per_trigger=1)
        increments.record_chunks(stream, f"{tmp_path}/s", f"{tmp_path}/offsets").awaitTermination()
    state = increments.merged(spark, f"{tmp_path}/s")
    assert (state.rows, state.chunks) == (1000, 3)


def test_modes_are_given_only_where_proven(spark, tmp_path):
    df = spark.range(20_000).select(
        F.when(F.col("id") % 3 == 0, "common").otherwise(F.concat(F.lit("r"), "id")).alias("hot"),
        F.col("id").cast("string").alias("all_differ"), F.lit(None).cast("string").alias("empty"),
        F.when(F.col("id") % 2 == 0, "b").otherwise("a").alias("tied"), F.repeat(F.lit("long"), 40).alias("long"))
    increments.add_chunk(df, f"{tmp_path}/s", "0")
    columns = increments.merged(spark, f"{tmp_path}/s").columns
    assert {c: s.mode() for c, s in columns.items()} == {
        "hot": "common", "all_differ": None, "empty": None, "tied": "a", "long": None}


def test_empty_tables_and_odd_names(spark, tmp_path):
    df = spark.createDataFrame([], "`a'b` string, `x y` double, t timestamp")
    increments.add_chunk(df, f"{tmp_path}/s", "0")
    increments.add_chunk(spark.createDataFrame([("k", 1.0, None)], df.schema), f"{tmp_path}/s", "1")
    state = increments.merged(spark, f"{tmp_path}/s")
    assert state.rows == 1 and state.columns["a'b"].mode() == "k" and state.columns["x y"].stats.mean == 1.0
    assert state.columns["t"].stats.count == 0
