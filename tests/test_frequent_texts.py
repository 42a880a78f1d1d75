"""Modes and top values of texts, against counting whole texts."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tests.conftest import SF_SMALL
from winnow.operators import frequency, nulls


def brute(values):
    counts = Counter(v for v in values if v is not None)
    return min(((-n, v) for v, n in counts.items()), default=None)


def columns(seed):
    rng = random.Random(seed)
    long = "z" * 70
    return {
        "hot": [rng.choice(["top" * 40, "b", None]) if rng.random() < .4 else f"r{i}" for i in range(4000)],
        "all_differ": [f"{long}{i % 4000:05d}" for i in range(4000)],
        "pairs": [f"{'y' * 66}{i // 2}" if i % 3 else f"x{i}" for i in range(4000)],
        "few": [rng.choice(["é", "a", "", "b"]) for _ in range(4000)],
        "tied": [["bb", "aa"][i % 2] for i in range(4000)],
        "empty": [None] * 4000,
        "many_tied_long": [f"{chr(97 + i % 26)}{long}{i % 2000}" for i in range(4000)],
    }


@pytest.fixture(scope="module", params=[1, 2])
def made(spark, request):
    data = columns(request.param)
    schema = ", ".join(f"{c} string" for c in data)
    return data, spark.createDataFrame(list(zip(*data.values())), schema).repartition(7).cache()


def test_modes_equal_counting_whole_texts(made):
    data, df = made
    found = frequency.text_modes(df, list(data))
    want = {c: brute(v) for c, v in data.items()}
    assert found == {c: (w[1], -w[0]) for c, w in want.items() if w}


def test_clear_leaders_are_settled_by_the_sketch(made):
    data, df = made
    lead = frequency.leading_digests(df, list(data))
    assert {"hot", "few", "tied", "empty"} <= set(lead) and "all_differ" not in lead
    assert lead["empty"] == (0, []) and len(lead["tied"][1]) == 2


@pytest.mark.parametrize("k", [1, 3, 50])
def test_top_values_equal_counting_whole_texts(made, k):
    data, df = made
    for c in data:
        counts = Counter(v for v in data[c] if v is not None)
        want = sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k]
        assert [tuple(r) for r in frequency.value_counts(df, c, k).collect()] == want


def test_no_shuffle_holds_whole_texts(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    plan = frequency._folded_texts(docs, ["text"])._jdf.queryExecution().executedPlan().toString()
    partial = plan[plan.index("Exchange"):]
    keys = partial[partial.index("keys=["):].split("]")[0]
    assert "text" not in keys and "prefix" in keys
    texts = [r[0] for r in docs.select("text").collect()]
    best = brute(texts)
    assert frequency.text_modes(docs, ["text"]) == {"text": (best[1], -best[0])}


def test_modes_of_an_empty_table_and_mixed_kinds(spark):
    df = spark.createDataFrame([], "a string, b int")
    assert frequency.mode_values(df, ["a", "b"]) == {}
    assert nulls.mode_fills(df, ["a", "b"]) == {"a": "Unknown", "b": 0}
    some = spark.createDataFrame([("x", 2, True), ("x", 1, None), (None, 1, False)], "a string, b int, c boolean")
    assert frequency.mode_values(some, ["a", "b", "c"]) == {"a": "x", "b": 1, "c": False}
