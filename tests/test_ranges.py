"""Files whose records cross lines and splits, read by many tasks, against readers that take a file whole."""

import json
import random

import pytest
from pyspark.sql import functions as F

from winnow.sources import ranges, readers

SMALL_SPLITS = {"spark.sql.files.maxPartitionBytes": "700", "spark.sql.files.openCostInBytes": "1"}


@pytest.fixture
def small_splits(spark):
    before = {k: spark.conf.get(k) for k in SMALL_SPLITS}
    for k, v in SMALL_SPLITS.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def whole(spark, path, encoding="UTF-8"):
    df = spark.read.options(header=True, multiLine=True, quote='"', escape='"', encoding=encoding,
                            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(str(path))
    return sorted(map(tuple, df.collect()), key=repr)


def fields(rng):
    texts = ['"a\nb"', '"x,y"', '"say ""no"""', '""', "", "plain", 'in"ch', '5" pipe', '"é\n\n,日"', '"tail" off', ' "space"',
             '"' + "long\n" * 150 + '"', '"""\n"""', '","', '"\n"']
    return [rng.choice(texts) for _ in range(2)]


@pytest.mark.parametrize("end", ["\n", "\r\n"])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_csv_records_equal_a_whole_read(spark, tmp_path, small_splits, seed, end):
    rng = random.Random(seed)
    lines = ["id,a,b"] + [",".join([str(i), *fields(rng)]) for i in range(120)]
    path = tmp_path / "t.csv"
    path.write_bytes((end.join(lines) + rng.choice(["", end])).encode())
    got = readers.read_csv(spark, str(path), encoding="UTF-8", multi_line=True, schema="id string, a string, b string")
    assert ranges._units(spark, str(path), ranges.CSV).rdd.getNumPartitions() > 10
    assert got.select("id", "a", "b").count() == 120
    missing = [None, *readers.NA_TOKENS]
    want = [tuple(None if v in missing else v for v in row) for row in whole(spark, path)]
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want, key=repr)


def test_csv_infers_types_and_encodings_of_broken_files(spark, tmp_path, small_splits):
    folder = tmp_path / "many.csv"
    folder.mkdir()
    body = "".join(f'{i},"line\n{i}, Zoë ""x"""\n' for i in range(200))
    (folder / "a.csv").write_bytes(("n,t\n" + body).encode())
    (folder / "b.csv").write_bytes(("n,t\n" + body).encode("latin-1"))
    (folder / "c.csv").write_bytes(b"\xef\xbb\xbf" + ("n,t\n" + body + '7,"left open\nto the end').encode())
    (folder / "d.csv").write_bytes(b"n,t\n1,plain\n")
    df = readers.read_csv(spark, str(folder))
    assert df.dtypes == [("n", "bigint"), ("t", "string")]
    assert df.count() == 602
    assert df.where(F.col("t") == 'line\n9, Zoë "x"').count() == 3
    assert df.where(F.col("t") == "left open\nto the end").count() == 1


def test_csv_header_with_a_line_break_and_ragged_rows(spark, tmp_path):
    path = tmp_path / "h.csv"
    path.write_text('"a\nb",c\n1,"x\ny"\n2\n')
    df = readers.read_csv(spark, str(path))
    assert df.columns == ["a\nb", "c"]
    assert sorted(map(tuple, df.collect())) == [(1, "x\ny"), (2, None)]
    path.write_text('a,c\n1,"x\ny",z\n')
    with pytest.raises(ValueError):
        readers.read_csv(spark, str(path))


def objects(rng, n):
    strings = ["a", "]}", "{[", 'q"q', "back\\", "日本€", "line\nbreak", ",", "\\\\\"}", ""]
    return [{"id": i, "s": rng.choice(strings), "l": [rng.choice(strings) for _ in range(rng.randint(0, 3))],
             "o": {"x": rng.choice(strings), "y": {"z": i}}} for i in range(n)]


def plain(rows):
    return sorted(((r["id"], r["s"], tuple(r["l"]), r["o"]["x"], r["o"]["y"]["z"]) for r in rows))


@pytest.mark.parametrize("indent", [None, 2])
@pytest.mark.parametrize("seed", [1, 2])
def test_json_arrays_are_read_by_all_splits(spark, tmp_path, small_splits, seed, indent):
    made = objects(random.Random(seed), 150)
    path = tmp_path / "t.json"
    path.write_text(json.dumps(made, indent=indent, ensure_ascii=seed == 1), encoding="utf-8")
    assert ranges._units(spark, str(path), ranges.JSON_ARRAY).rdd.getNumPartitions() > 10
    assert plain(readers.read_json(spark, str(path)).collect()) == plain(made)


def test_json_objects_arrays_and_nothing(spark, tmp_path):
    folder = tmp_path / "f.json"
    folder.mkdir()
    (folder / "a.json").write_text('{\n "a": 1,\n "s": "}{"\n}\n')
    (folder / "b.json").write_text('﻿ [ {"a": 2, "s": "x"} ,\r\n\t{"a": 3, "s": "]"}\n]\n', encoding="utf-8")
    (folder / "c.json").write_text("[]\n")
    (folder / "d.json").write_text('{"a": 4, "s": null}\n{"a": 5, "s": "y"}\n')
    got = readers.read_json(spark, str(folder)).select("a", "s").collect()
    assert sorted(map(tuple, got)) == [(1, "}{"), (2, "x"), (3, "]"), (4, None), (5, "y")]


@pytest.mark.parametrize("text", ['[{"a": 1} {"a": 2}]', '[{"a": 1}, {"a": 2}', '[{"a": 1}, 5]', '[[{"a": 1}]]', '[{"a": "open}]'])
def test_json_that_is_no_array_of_objects_raises(spark, tmp_path, text):
    path = tmp_path / "bad.json"
    path.write_text(text)
    with pytest.raises(ValueError):
        readers.read_json(spark, str(path))


def test_files_dealt_anew_between_the_scans_are_read_again(spark, tmp_path, monkeypatch):
    path = tmp_path / "t.csv"
    path.write_text("a\n" + '"x\ny"\n' * 50)
    true, calls = ranges._entries, []

    def once_wrong(splits):
        calls.append(1)
        found = true(splits)
        return found.withColumn("length", F.col("length") + 1) if len(calls) == 1 else found

    monkeypatch.setattr(ranges, "_entries", once_wrong)
    assert ranges.csv_records(spark, str(path), "UTF-8").count() == 50 and len(calls) == 2
    monkeypatch.setattr(ranges, "ATTEMPTS", 0)
    with pytest.raises(RuntimeError):
        ranges.csv_records(spark, str(path), "UTF-8")
