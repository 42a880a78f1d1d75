import datetime as dt

import pytest
from pyspark.sql import functions as F

from winnow.functions.dates import DATE_FORMATS, inferred_format, is_date_name, parse, parse_any
from winnow.operators import types

EXAMPLES = [
    ("2024-03-05 06:07:08", dt.datetime(2024, 3, 5, 6, 7, 8)),
    ("2024-03-05 06:07", dt.datetime(2024, 3, 5, 6, 7)),
    ("2024-03-05", dt.datetime(2024, 3, 5)),
    ("03/05/2024 06:07:08", dt.datetime(2024, 3, 5, 6, 7, 8)),
    ("03/05/2024 06:07", dt.datetime(2024, 3, 5, 6, 7)),
    ("03/05/2024", dt.datetime(2024, 3, 5)),
    ("05-03-2024", dt.datetime(2024, 3, 5)),
    ("05.03.2024", dt.datetime(2024, 3, 5)),
    ("2024/03/05", dt.datetime(2024, 3, 5)),
]


def test_nine_formats_one_column_each(spark):
    cols = [f"c{i}" for i in range(len(EXAMPLES))]
    df = spark.createDataFrame([tuple(t for t, _ in EXAMPLES), ("junk",) * 9, (None,) * 9], cols)
    df = df.withColumn("i", F.monotonically_increasing_id())
    found = {r["column"]: r["format"] for r in types.infer_date_format(df, cols, order_by="i").collect()}
    assert [found[c] for c in cols] == [f for _, f in DATE_FORMATS]
    parsed = types.parse_dates(df, cols, order_by="i").orderBy("i").collect()
    assert [parsed[0][c] for c in cols] == [d for _, d in EXAMPLES]
    assert all(parsed[i][c] is None for i in (1, 2) for c in cols)


def test_fractions_unless_exact(spark):
    df = spark.createDataFrame([("2024-01-01 00:00:07.179575",), ("2024-01-01 00:00:07",)], "t string")
    loose = [r["t"] for r in types.parse_dates(df, ["t"]).collect()]
    assert loose == [dt.datetime(2024, 1, 1, 0, 0, 7, 179575), dt.datetime(2024, 1, 1, 0, 0, 7)]
    strict = [r["t"] for r in types.parse_dates(df, ["t"], exact=True).collect()]
    assert strict == [None, dt.datetime(2024, 1, 1, 0, 0, 7)]


def test_a_given_format_wins(spark):
    df = spark.createDataFrame([("05/03/2024",)], "t string")
    assert types.parse_dates(df, ["t"], {"t": "dd/MM/yyyy"}).first()["t"] == dt.datetime(2024, 3, 5)


def test_numbers_are_not_years(spark):
    df = spark.createDataFrame([("2050",), ("1234",), ("2024-01-01T05:00:00",)], "t string")
    got = df.select(parse_any(F.col("t")).alias("a"), parse(F.col("t"), None).alias("b"),
                    inferred_format(F.col("t")).alias("f")).collect()
    assert [r["a"] is None for r in got[:2]] == [True, True]
    assert got[2]["b"] == dt.datetime(2024, 1, 1, 5)


def test_keywords(spark):
    assert is_date_name("Start_Time") and is_date_name("updated_by") and not is_date_name("day")
    df = spark.createDataFrame([(1.5, "x", "2024-01-01", True, "a", "good", "2024-01-05T10:00:00", None)],
                               "lifetime double, updated_by string, when_ string, updated boolean, name string, "
                               "sentiment string, created_at string, end_time string")
    roles = {r["column"]: r["role"] for r in types.classify_columns(df).collect()}
    assert roles == {"lifetime": "numerical", "updated_by": "categorical", "when_": "date",
                     "updated": "categorical", "name": "categorical", "sentiment": "categorical",
                     "created_at": "date", "end_time": "date"}


def test_a_keyword_lowers_the_share(spark):
    rows = [("2024-01-01", "2024-01-01")] * 6 + [("x", "x")] * 4
    df = spark.createDataFrame(rows, "start_date string, other string")
    roles = {r["column"]: r["role"] for r in types.classify_columns(df).collect()}
    assert roles == {"start_date": "date", "other": "categorical"}


def test_mixed_dates_keep_their_values(spark):
    df = spark.createDataFrame([("-",), ("03/25/2024",), ("2024-01-05",), ("2024-01-05T10:00:00",), ("2024-01-05 10:00",)] * 4,
                               "t string")
    fit = types.fit_types(df, date_cols=["t"])
    got = [r["t"] for r in types.apply_types(df, fit).collect()[:5]]
    assert got == [None, dt.datetime(2024, 3, 25), dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 5, 10),
                   dt.datetime(2024, 1, 5, 10)]
    assert types.schema_report(df, fit).first()["values_lost"] == 4
    assert types.parse_dates(df, ["t"], {"t": "yyyy-MM-dd"}).where("t is not null").count() == 4


def test_the_share_must_be_above_80_percent(spark):
    rows = [("2024-01-01", "2024-01-01")] * 80 + [("x", "2024-01-01")] + [("x", "x")] * 19
    df = spark.createDataFrame(rows, "a string, b string")
    roles = {r["column"]: r["role"] for r in types.classify_columns(df).collect()}
    assert roles == {"a": "categorical", "b": "date"}


def test_sample_takes_the_first_values(spark):
    df = spark.createDataFrame([(i, "2024-01-01" if i < 100 else "x") for i in range(500)], "i int, t string")
    row = types.date_parse_ratio(df, ["t"], order_by="i").first()
    assert (row["sampled"], row["parsed"], row["ratio"]) == (100, 100, 1.0)
    assert types.date_parse_ratio(df, ["t"], n=None).first()["ratio"] == 0.2


def test_sample_without_an_order(spark):
    rows = [(None if i < 150 else "2024-01-01", "y" * 500 if i % 2 else "2024-01-01") for i in range(400)]
    df = spark.createDataFrame(rows, "a string, b string").coalesce(1)
    got = {r["column"]: tuple(r)[1:] for r in types.date_parse_ratio(df, ["a", "b"], 100).collect()}
    assert got == {"a": (100, 100, 1.0), "b": (100, 50, 0.5)}
    tiny = spark.createDataFrame([(None, "x")], "a string, b string")
    assert {tuple(r)[1:3] for r in types.date_parse_ratio(tiny).collect()} == {(0, 0), (1, 0)}


def test_lists_given_by_the_caller_win(spark):
    df = spark.createDataFrame([("12", "2024-01-01", 3)], "a string, b string, c int")
    roles = types.find_roles(df, numerical=["a"], categorical=["b"], date_cols=[])
    assert (roles.numerical, roles.categorical, roles.dates) == (["a"], ["b"], [])


def test_coerce_numeric(spark):
    text = ["1", " 2.5 ", "-3e2", "x", "", "12d", "7F", "inf", "nan", None]
    df = spark.createDataFrame([(t,) for t in text], "t string")
    assert [r["t"] for r in types.coerce_numeric(df, ["t"]).collect()] == [
        1.0, 2.5, -300.0, None, None, None, None, float("inf"), None, None]


@pytest.mark.parametrize("low, high, name", [
    (0, 255, "smallint"), (0, 256, "int"), (0, 65536, "bigint"), (0, 4294967296, "decimal(20,0)"),
    (0, 1e30, None), (-1, 127, "tinyint"), (-129, 0, "smallint"), (-1, 32768, "int"),
    (-1, 2147483648, "bigint"), (-1e30, 0, None), (None, None, None)])
def test_smallest_integer_type(low, high, name):
    assert types.whole_type(low, high, True) == name
    assert types.whole_type(low, high, False) is None


def test_narrowing_keeps_nulls_and_fractions(spark):
    df = spark.createDataFrame([(1.0, 0.5, float("nan"), None), (None, 2.0, 3.0, None)],
                               "a double, b double, c double, d double")
    out = types.narrow_integers(df)
    assert dict(out.dtypes) == {"a": "smallint", "b": "double", "c": "smallint", "d": "double"}
    assert [tuple(r) for r in out.collect()] == [(1, 0.5, None, None), (None, 2.0, 3, None)]
    assert dict(types.narrow_floats(df).dtypes)["b"] == "float"


def test_categories_at_the_limit(spark):
    df = spark.range(3000).select((F.col("id") % 1000).cast("string").alias("at"),
                                  (F.col("id") % 1001).cast("string").alias("over"),
                                  F.col("id").cast("string").alias("far"))
    assert types.categorical_roles(types.tag_categoricals(df)) == {
        "at": "categorical", "over": "text", "far": "text"}
    assert types.tag_categoricals(df).exceptAll(df).count() == 0
