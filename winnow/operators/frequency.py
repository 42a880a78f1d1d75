"""Value counts: one long table for many columns, and what is read off it."""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F, types as T

from winnow.functions.columns import as_text, col, has_value, is_integral, is_numeric, is_temporal, kind, present

# Strings longer than this are counted by a 256-bit digest, so that a distinct count does
# not shuffle whole documents. A shorter value can never equal a 64-character digest.
DIGEST_OVER = 63


def _slots(df: DataFrame, name: str) -> list[Column]:
    """The value in the slot of its type: whole, real, moment, text. One is non-null."""
    dtype = df.schema[name].dataType
    whole = real = moment = text = F.lit(None)
    if is_integral(dtype):
        whole = col(name)
    elif is_numeric(dtype):
        real = present(df, name) + F.lit(0.0)    # -0.0 and 0.0 are one value
    elif is_temporal(dtype):
        moment = col(name)
    else:
        text = as_text(df, name)
    return [
        whole.cast("bigint"), real.cast("double"), moment.cast("timestamp_ntz"), text.cast("string"),
    ]


VALUE_SLOTS = ["whole", "real", "moment", "text"]


def typed_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, whole, real, moment, text, n)``: counts of non-null values of all columns.

    One shuffle for all columns. The map-side count folds a value that fills a third of
    the table into one row per task.
    """
    cells: list[Column] = []
    for name in cols:
        cells += [F.lit(name), *_slots(df, name)]
    return (
        df.select(F.stack(F.lit(len(cols)), *cells).alias("column", *VALUE_SLOTS))
        .filter("whole is not null or real is not null "
                "or moment is not null or text is not null")
        .groupBy("column", *VALUE_SLOTS).agg(F.count(F.lit(1)).alias("n"))
    )


def frequency_table(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, value, count)`` with values as text; nulls are left out."""
    cells: list[Column] = []
    for name in cols:
        cells += [F.lit(name), as_text(df, name)]
    return (
        df.select(F.stack(F.lit(len(cols)), *cells).alias("column", "value"))
        .filter("value is not null")
        .groupBy("column", "value").agg(F.count(F.lit(1)).alias("count"))
    )


def distinct_counts(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, distinct)`` over non-null values, exact; every column has a row."""
    spark = df.sparkSession
    if not cols:
        return spark.createDataFrame([], "column string, distinct bigint")
    cells: list[Column] = []
    for name in cols:
        value = as_text(df, name)
        if kind(df.schema[name].dataType) in ("categorical", "other"):
            value = F.when(F.length(value) > DIGEST_OVER, F.sha2(value, 256)).otherwise(value)
        cells += [F.lit(name), value]
    return (
        df.select(F.stack(F.lit(len(cols)), *cells).alias("column", "value"))
        .filter("value is not null")
        .distinct()
        .groupBy("column").agg(F.count(F.lit(1)).alias("distinct"))
        .join(F.broadcast(_names(spark, cols)), "column", "right")
        .select("column", F.coalesce("distinct", F.lit(0)).alias("distinct"))
    )


def _names(spark, cols: Sequence[str]) -> DataFrame:
    return spark.createDataFrame([(c,) for c in cols], "column string")


# Frequent texts. A sketch that tracks n items has a table of at least 4/3 n, in powers of two; its counts are off by
# at most 3.5 shares of that table.
TRACKED = 3000
SKETCH_ERROR = 3.5 / 2 ** math.ceil(math.log2(TRACKED * 4 / 3))
CANDIDATES = 32         # items read from a sketch
SLOTS = 64              # groups for the first merge of sketches
PREFIX = 16             # characters that stand for the order of a long text
FETCHED = 100_000       # digests whose texts are looked up through a broadcast


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def _digest(value: Column) -> Column:
    return F.unhex(F.md5(value.cast("binary")))


def leading_digests(df: DataFrame, names: Sequence[str]) -> dict[str, tuple[int, list[bytes]]]:
    """Count and digests of the commonest texts of each column, where a sketch settles which they are.

    One scan sketches 64-bit hashes, a second counts the few that may be commonest, by 128-bit digest. Every other
    text is proven rarer: by the sketch's upper limit, or its error where it is not tracked. Columns
    without a clear leader are absent; a column without values has no digests.
    """
    hashed = [F.when(t.isNotNull(), F.xxhash64(t)).alias(f"v{i}") for i, t in enumerate(map(col, names))]
    slot = (F.spark_partition_id() % F.lit(SLOTS)).alias("slot")
    n = range(len(names))
    row = (df.select(slot, *hashed).groupBy("slot").agg(
        *[F.expr(f"approx_top_k_accumulate(v{i}, {TRACKED}) s{i}") for i in n],
        *[F.expr(f"count(v{i}) n{i}") for i in n], *[F.expr(f"hll_sketch_agg(v{i}, 12) d{i}") for i in n])
        .groupBy(F.lit("all"))      # a group, since sketches of no rows at all cannot be merged
        .agg(*[F.expr(f"approx_top_k_combine(s{i}, {TRACKED}) s{i}") for i in n],
             *[F.sum(f"n{i}").alias(f"n{i}") for i in n], *[F.expr(f"hll_union_agg(d{i}) d{i}") for i in n])
        .selectExpr(*[f"approx_top_k_estimate(s{i}, {CANDIDATES + 1}) s{i}" for i in n], *[f"n{i}" for i in n],
                    *[f"hll_sketch_estimate(d{i}) d{i}" for i in n])).first()
    if row is None:
        return {c: (0, []) for c in names}
    rows = df.count() if any(row[f"n{i}"] for i in n) else 0
    open_, out = {}, {}
    for i, c in enumerate(names):
        if not row[f"n{i}"]:
            out[c] = (0, [])
            continue
        error = 0.0 if row[f"d{i}"] <= TRACKED // 2 else SKETCH_ERROR * rows        # nulls count as an item
        found = [(x["item"], x["count"]) for x in row[f"s{i}"] if x["item"] is not None]
        if not found:
            continue
        floor = found[0][1] - error
        may_lead = [item for item, most in found if most >= floor]
        if len(may_lead) >= CANDIDATES:
            continue
        open_[i] = (may_lead, max(2 * error, *[0] + [most for item, most in found if item not in may_lead]))
    if not open_:
        return out
    cells = [F.struct(F.lit(i).alias("i"), hashed[i].alias("h"), F.when(hashed[i].isin(open_[i][0]), _digest(col(names[i]))).alias("d"))
             for i in open_]
    counted = (df.select(F.explode(F.array(*cells)).alias("x")).select("x.i", "x.d").where("d IS NOT NULL")
               .groupBy("i", "d").agg(F.count(F.lit(1)).alias("n")).collect())      # at most CANDIDATES a column
    for i, (_, others) in open_.items():
        mine = [(r["n"], bytes(r["d"])) for r in counted if r["i"] == i]
        most = max((k for k, _ in mine), default=0)
        if most > others:
            out[names[i]] = (most, [d for k, d in mine if k == most])
    return out


def _folded_texts(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(column, short, digest, prefix, n)``: counts of texts; a long one is told by its digest."""
    def cell(c: str) -> Column:
        long = F.length(col(c)) > DIGEST_OVER
        return F.struct(F.lit(c).alias("column"), F.when(~long, col(c)).alias("short"),
                        F.when(long, _digest(col(c))).alias("digest"), F.left(col(c), F.lit(PREFIX)).alias("prefix"))

    return (df.select(F.explode(F.array(*map(cell, names))).alias("x")).select("x.*").where("prefix IS NOT NULL")
            .groupBy("column", "short", "digest", "prefix").agg(F.count(F.lit(1)).alias("n")))


def _texts_of(df: DataFrame, wanted: DataFrame, names: Sequence[str]) -> DataFrame:
    """``(column, value, n)`` for rows of ``_folded_texts``: long texts are looked up by their digests."""
    long = wanted.where("digest IS NOT NULL").select("column", "digest", "n")
    cells = [F.struct(F.lit(c).alias("column"), F.when(F.length(col(c)) > DIGEST_OVER, _digest(col(c))).alias("digest"),
                      col(c).alias("value")) for c in names]
    texts = df.select(F.explode(F.array(*cells)).alias("x")).select("x.*").where("digest IS NOT NULL")
    few = long.count()
    found = []
    if few:
        found = [texts.join(F.broadcast(long) if few <= FETCHED else long, ["column", "digest"])
                 .groupBy("column", "digest").agg(F.min("value").alias("value"), F.max("n").alias("n"))
                 .select("column", "value", "n")]
    short = wanted.where("digest IS NULL").select("column", F.col("short").alias("value"), "n")
    return reduce(DataFrame.unionByName, found, short)


def text_modes(df: DataFrame, names: Sequence[str]) -> dict[str, tuple[str, int]]:
    """The commonest text of each column and its count, smallest on ties; no shuffle holds whole texts.

    Sketches settle columns with a clear leader. The others count digests, with a prefix that keeps the order
    of texts; only those that may win are looked up.
    """
    if not names:
        return {}
    lead = leading_digests(df, names)
    out: dict[str, tuple[str, int]] = {}
    clear = [c for c in names if c in lead and lead[c][1]]
    if clear:
        row = df.agg(*[F.min(F.when(_digest(col(c)).isin(lead[c][1]), col(c))).alias(f"v{i}")
                       for i, c in enumerate(clear)]).first()
        out = {c: (row[f"v{i}"], lead[c][0]) for i, c in enumerate(clear)}
    rest = [c for c in names if c not in lead]
    if rest:
        counted = _folded_texts(df, rest)
        best = {r["column"]: r["best"] for r in counted.groupBy("column").agg(
            F.min(F.struct((-F.col("n")).alias("less"), "prefix")).alias("best")).collect()}
        first = reduce(lambda a, b: a | b, [
            (F.col("column") == c) & (F.col("n") == -b["less"]) & (F.col("prefix") == b["prefix"]) for c, b in best.items()],
            F.lit(False))
        for r in _texts_of(df, counted.where(first), rest).groupBy("column").agg(
                F.min("value").alias("value"), F.max("n").alias("n")).collect():
            out[r["column"]] = (r["value"], r["n"])
    return out


MODES = "column string, whole bigint, real double, moment timestamp_ntz, text string, n bigint"


def modes(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(column, whole, real, moment, text, n)``: the commonest value, smallest on ties."""
    best = F.min(F.struct((-F.col("n")).alias("rank"), *VALUE_SLOTS)).alias("best")
    texts = [c for c in cols if is_text(df, c)]
    others = [c for c in cols if c not in texts]
    found = df.sparkSession.createDataFrame(
        [(c, None, None, None, v, n) for c, (v, n) in text_modes(df, texts).items()], MODES)
    if not others:
        return found
    return typed_counts(df, others).groupBy("column").agg(best).select(
        "column", *[f"best.{s}" for s in VALUE_SLOTS], (-F.col("best.rank")).alias("n")).unionByName(found)


def mode_values(df: DataFrame, cols: Sequence[str]) -> dict[str, object]:
    """The commonest value of each column; a column without values is absent."""
    if not cols:
        return {}
    out: dict[str, object] = {}
    for row in modes(df, cols).collect():    # one row per column
        value = next(row[s] for s in VALUE_SLOTS if row[s] is not None)
        if isinstance(df.schema[row["column"]].dataType, T.BooleanType):
            value = value == "true"
        out[row["column"]] = value
    return out


def value_counts(df: DataFrame, name: str, k: int | None = None) -> DataFrame:
    """Values by falling count (value order on ties), the top ``k`` when given.

    With ``k``, texts are counted by digest, and only those that may be among the top are looked up.
    """
    if k is not None and is_text(df, name):
        counted = _folded_texts(df, [name])
        last = counted.orderBy(F.desc("n"), F.asc("prefix")).limit(k).agg(
            F.max(F.struct((-F.col("n")).alias("less"), "prefix")).alias("last")).first()["last"]
        if last is None:
            return df.select(col(name).alias("value"), F.lit(0).cast("bigint").alias("count")).limit(0)
        # ties at the end of the list: every text whose prefix does not come after the last one's
        may = (F.col("n") > -last["less"]) | ((F.col("n") == -last["less"]) & (F.col("prefix") <= last["prefix"]))
        found = _texts_of(df, counted.where(may), [name]).select("value", F.col("n").alias("count"))
        return found.orderBy(F.desc("count"), F.asc("value")).limit(k)
    counted = (
        df.filter(has_value(df, name))
        .groupBy(col(name).alias("value")).agg(F.count(F.lit(1)).alias("count"))
    )
    if k is None:
        return counted
    return counted.orderBy(F.desc("count"), F.asc("value")).limit(k)


def within_cardinality(df: DataFrame, cols: Sequence[str], cap: int) -> dict[str, bool]:
    """Which columns have at most ``cap`` distinct values.

    A sketch settles the columns far from the cap, so that only columns with few values
    are counted exactly, and those fold to almost nothing before the shuffle.
    """
    if not cols:
        return {}
    return settle_cardinality(df, distinct_estimates(df, cols), cap)


def distinct_estimates(df: DataFrame, cols: Sequence[str]) -> dict[str, int]:
    """About how many distinct values each column has (1.6 % error); sketches meet over slots first."""
    if not cols:
        return {}
    slot = (F.spark_partition_id() % F.lit(SLOTS)).alias("slot")
    values = [F.xxhash64(as_text(df, c)).alias(f"v{i}") for i, c in enumerate(cols)]
    known = [as_text(df, c).isNotNull().alias(f"k{i}") for i, c in enumerate(cols)]
    n = range(len(cols))
    row = (df.select(slot, *values, *known).groupBy("slot")
           .agg(*[F.expr(f"hll_sketch_agg(v{i}, 12) FILTER (WHERE k{i}) s{i}") for i in n])
           .agg(*[F.expr(f"hll_sketch_estimate(hll_union_agg(s{i})) d{i}") for i in n])).first()
    return {c: row[f"d{i}"] or 0 for i, c in enumerate(cols)}


def settle_cardinality(df: DataFrame, estimates: dict[str, int], cap: int) -> dict[str, bool]:
    """Decide from estimates with a 2 % error where they suffice, else by an exact count."""
    out = {c: n <= cap for c, n in estimates.items()}
    close = [c for c, n in estimates.items() if cap / 2 < n <= cap * 2]
    if close:
        for row in distinct_counts(df, close).collect():
            out[row["column"]] = row["distinct"] <= cap
    return out
