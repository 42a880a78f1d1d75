import datetime as dt

import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from registry.common import dirty
from tests.conftest import SF_SMALL
from winnow.plans import batch, cleaning, reports
from winnow.plans.config import PRESETS, Config, environment, preset
from winnow.plans.stages import NullHandler
from winnow.session import scratch_path
from winnow.sources import readers, sample, sinks


def test_settings():
    assert environment("prod").drop_threshold == 0.8 and environment("DEV").drop_threshold == 0.5
    assert environment("TEST").preview_rows == 3 and Config().drop_threshold == 0.7
    with pytest.raises(ValueError):
        environment("prodution")
    assert [(c.outlier_factor, c.drop_threshold, c.impute_strategy, c.preview_rows) for c in PRESETS.values()] == [
        (1.5, 0.5, "median", 10), (2.0, 0.3, "most_frequent", 5), (1.2, 0.7, "mean", 20)]
    for bad in ({"impute_strategy": "x"}, {"drop_threshold": 50}, {"clip_method": "x"}):
        with pytest.raises(ValueError):
            Config(**bad)


def test_cleaned_table_keeps_its_promises(spark):
    df = dirty(spark, SF_SMALL)
    cleaned, model = cleaning.clean(df, preset("balanced"))
    assert cleaned.count() == df.count() and "user_id" not in cleaned.columns
    assert cleaned.filter(" or ".join(f"{c} is null" for c in cleaned.columns)).count() == 0
    b = model.stages[2].bounds["value"]
    assert cleaned.filter((F.col("value") < b["lower"]) | (F.col("value") > b["upper"])).count() == 0
    assert dict(cleaned.dtypes)["whole_float"] == "smallint" and dict(cleaned.dtypes)["ts_text"] == "timestamp_ntz"
    assert cleaned.schema["event_type"].metadata == {"role": "categorical"}


def test_a_saved_model_cleans_alike(spark):
    df = dirty(spark, SF_SMALL)
    cleaned, model = cleaning.clean(df, Config())
    path = scratch_path(spark, "model")
    model.write().overwrite().save(path)
    again = PipelineModel.load(path).transform(df)
    assert again.schema == cleaned.schema and again.exceptAll(cleaned).count() == 0
    NullHandler(threshold=0.3, strategy="mean").write().overwrite().save(path + "-stage")
    assert NullHandler.load(path + "-stage").getOrDefault("threshold") == 0.3


def test_transform_runs_no_job_and_shuffles_nothing(spark):
    df = dirty(spark, SF_SMALL)
    plan = cleaning.clean(df, Config())[0]._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Join" not in plan


def test_compat_fills_the_exact_median_in_the_shared_fit(spark):
    df = spark.createDataFrame([(i, v) for i, v in enumerate([1.0, 2.0, 30.0, 41.0, None])], "id int, v double")
    for strategy in ("median", "most_frequent"):
        cfg = Config(impute_strategy=strategy, compat=True)
        one, other = cleaning.fit_cleaning(df, cfg), cleaning.cleaning_pipeline(cfg).fit(df)
        assert one.transform(df).collect() == other.transform(df).collect()
        assert one.transform(df).where("id = 4").first()["v"] == 16.0


@pytest.mark.parametrize("strategy", ["median", "mean", "most_frequent"])
def test_the_shared_fit_equals_the_stages(spark, strategy):
    cfg = Config(impute_strategy=strategy, drop_threshold=0.85, order_by="event_id")    # user_id is filled
    df = dirty(spark, SF_SMALL).withColumn("empty", F.expr("CASE WHEN event_id < 900 THEN 5.0D END"))
    one, other = cleaning.fit_cleaning(df, cfg), cleaning.cleaning_pipeline(cfg).fit(df)
    assert one.stages[0].values == other.stages[0].values and one.stages[1].values == other.stages[1].values
    a, b = one.stages[2].bounds, other.stages[2].bounds
    assert set(a) == set(b) and {"user_id", "empty"} <= set(a)
    for c in a:
        assert a[c].pop("method") == b[c].pop("method")
        assert a[c] == pytest.approx(b[c], rel=1e-12)


def test_estimates_are_close(spark):
    df = dirty(spark, SF_SMALL)
    exact, close = (cleaning.clean(df, Config(exact=e))[1] for e in (True, False))
    a, b = (m.stages[2].bounds["value"] for m in (exact, close))
    assert b["q3"] == pytest.approx(a["q3"], rel=0.05) and b["mean"] == pytest.approx(a["mean"], rel=0.01)
    a, b = (m.stages[1].fit_result.fills["value"] for m in (exact, close))
    assert b == pytest.approx(a, rel=0.05)


def test_steps_report_on_the_cleaned_table(spark):
    run = cleaning.run_steps(dirty(spark, SF_SMALL), Config())
    assert {r["stage"] for r in run.reports["outliers"].collect()} == {"cleaned"}
    assert run.reports["missing_values"].agg(F.sum("null_count")).first()[0] == 0


def test_errors_are_raised(spark):
    with pytest.raises(Exception):
        cleaning.run_full(spark.createDataFrame([(1,)], "a int").select(F.raise_error(F.lit("x")).alias("a")))


def test_batch_job_on_csv(spark):
    base = scratch_path(spark, "job")
    sinks.write_csv(dirty(spark, SF_SMALL), base + ".csv")
    batch.batch_job(spark, base + ".csv", base + "-out", environment("production"))
    assert spark.read.option("header", True).csv(base + "-out/data").count() == 1000
    table = spark.read.json(base + "-out/report")
    assert {r["report"] for r in table.select("report").distinct().collect()} == {
        "final", "schema", "missing_values", "outliers"}
    cards = {r["report"]: r for r in reports.quality_cards(table).collect()}
    assert cards["missing_values"]["columns_to_drop"] == 0      # 80 % is not above 80 %


# ---------------------------------------------------------------- sources

def text_file(spark, name, *lines, encoding="utf-8"):
    """One small file through Spark's own file system."""
    path = scratch_path(spark, "text") + name
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = fs_path.getFileSystem(spark._jsc.hadoopConfiguration()).create(fs_path)
    out.write(bytearray("\n".join(lines).encode(encoding)))
    out.close()
    return path


def test_csv_types_and_tokens(spark):
    path = text_file(spark, ".csv", "n,x,b,s,t,e", "1,0.5,True,a,2024-01-01,", "NA,nan,false,n/a,2024-01-02,",
                     '3, 2 ,TRUE,"q ""x"", y",null,')
    df = readers.read_csv(spark, path)
    assert dict(df.dtypes) == {"n": "bigint", "x": "double", "b": "boolean", "s": "string", "t": "string", "e": "string"}
    assert [tuple(r) for r in df.collect()] == [
        (1, 0.5, True, "a", "2024-01-01", None), (None, None, False, None, "2024-01-02", None),
        (3, 2.0, True, 'q "x", y', None, None)]


def test_latin1_fallback(spark):
    path = text_file(spark, ".csv", "name", "Zoë", encoding="latin-1")
    assert readers.read_csv(spark, path).first()["name"] == "Zoë"
    assert readers.read_csv(spark, text_file(spark, ".csv", "name", "Zoë")).first()["name"] == "Zoë"
    assert readers.read_csv(spark, path, schema="name string").first()["name"] == "Zoë"
    genuine = text_file(spark, ".csv", "name", "Zo\ufffd é")      # valid UTF-8 stays as it is
    assert readers.read_csv(spark, genuine).first()["name"] == "Zo\ufffd é"
    header = text_file(spark, ".csv", "naïve", "1", encoding="latin-1")
    assert readers.read_csv(spark, header).columns == ["naïve"]


def test_json_array_and_lines(spark):
    array = text_file(spark, ".json", '[{"a": 1, "b": "x"},', ' {"a": 2, "b": null}]')
    lines = text_file(spark, ".json", '{"a": 1, "b": "x"}', '{"a": 2, "b": null}')
    assert readers.load(spark, array).collect() == readers.load(spark, lines).collect()


def test_unsupported(spark):
    with pytest.raises(ValueError):
        readers.load(spark, "x.xlsx")


def folder(tmp_path, extension, *texts):
    at = tmp_path / f"many{extension}"
    at.mkdir()
    for i, text in enumerate(texts):
        (at / f"part {i}{extension}").write_bytes(text if isinstance(text, bytes) else text.encode())
    return str(at)


def test_csv_keeps_rows_and_fields(spark, tmp_path):
    df = spark.createDataFrame([(1, 'a "b"\nc,d'), (2, "x\r\ny"), (3, None)], "i bigint, t string")
    sinks.write_csv(df, f"{tmp_path}/t.csv")
    assert sorted(map(tuple, readers.read_csv(spark, f"{tmp_path}/t.csv").collect())) == sorted(map(tuple, df.collect()))
    many = readers.read_csv(spark, folder(tmp_path, ".csv", "a,b\n1,2\n", "b,a\n2,1\n", b"a,b\n3,Zo\xeb\n", "a,b\n4,Zo\u00eb\n5\n"))
    assert sorted(map(tuple, many.select("a", "b").collect()), key=str) == [
        (1, "2"), (1, "2"), (3, "Zo\u00eb"), (4, "Zo\u00eb"), (5, None)]
    for row in ("3,4,5", "3,,5"):
        ragged = tmp_path / f"{len(row)}.csv"
        ragged.write_text(f"a,b\n1,2\n{row}\n")
        with pytest.raises(ValueError, match="more fields"):
            readers.read_csv(spark, str(ragged))


def test_json_files_are_told_apart(spark, tmp_path):
    path = folder(tmp_path, ".json", '{"a": 1}\n{"a": 2}\n', '[\n {"a": 3},\n {"a": 4}\n]', '{\n "a": 5,\n "b": "x"\n}')
    got = readers.read_json(spark, path)
    assert sorted(map(tuple, got.select("a", "b").collect())) == [(1, None), (2, None), (3, None), (4, None), (5, "x")]
    bad = tmp_path / "bad.json"
    bad.write_text('{"a": 1}\n{"a": \n')
    with pytest.raises(Exception, match="(?i)malformed|failfast"):
        readers.read_json(spark, str(bad)).collect()


def test_only_csv_is_read_in_pieces(spark):
    with pytest.raises(ValueError):
        readers.read_capped(spark, "x.json")


def test_cap(spark):
    path = text_file(spark, ".csv", "i", *[str(i) for i in range(100)])
    assert readers.read_capped(spark, path, 10, 3).count() == 30
    assert readers.read_capped(spark, path, 10).count() == 100


def test_moments_survive_csv(spark):
    moment = dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    path = scratch_path(spark, "moments") + ".csv"
    sinks.write_csv(spark.createDataFrame([(moment, [1, 2])], "t timestamp_ntz, l array<int>"), path)
    df = readers.read_csv(spark, path)
    assert tuple(df.first()) == ("2024-01-01 00:00:07.179575", "[1,2]")


def test_sample_table(spark):
    df = sample.sample_table(spark, 1000).cache()
    assert df.count() == 1000 and len(df.columns) == 10
    assert df.exceptAll(sample.sample_table(spark, 1000).repartition(3)).count() == 0
    row = df.agg(F.avg("age"), F.avg("score"), F.avg("visits"), F.count("age"), F.max("salary")).first()
    assert abs(row[0] - 35) < 2 and abs(row[1] - 50) < 4 and abs(row[2] - 5) < 0.4
    assert 920 < row[3] < 980 and row[4] > 150_000
    assert df.filter("salary > 120000").count() <= 20
