"""What a fit needs of each arriving chunk, kept as mergeable state, so that a refit reads no old rows.

A chunk leaves one small row a column: counts, extremes and moments (exact), a KLL sketch for quantiles, a
distinct sketch, and for text a frequent-items sketch. Rows of any set of chunks merge into the statistics of
their union. Counts and moments of the union are those of a full fit; quantiles are off by at most
``RANK_ERROR`` of the rows; a mode is given only where the frequent-items sketch proves it.

A chunk writes its own folder and overwrites it when it comes again, so a replayed chunk counts once. Chunks fold
over slots before they meet in one task, whatever their number.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming import StreamingQuery

from winnow.functions.columns import as_text, col, is_temporal, kind, micros, present
from winnow.operators import nulls, outliers
from winnow.operators.frequency import DIGEST_OVER
from winnow.operators.quantiles import GRID, SKETCH_K, SLOTS, Stats, _merge_moments

RANK_ERROR = 0.006      # of a quantile: the KLL sketch's error and the spacing of the grid read from it
TRACKED = 3000          # items of a frequent-items sketch
# A sketch that tracks n items has a table of at least 4/3 n, in powers of two; its counts are off by at most
# 3.5 shares of that table.
COUNT_ERROR = 3.5 / (1 << (TRACKED * 4 // 3 - 1).bit_length())
LEADERS = 8             # items read from a merged sketch

FREQUENT = "struct<sketch: binary, maxItemsTracked: int, itemDataType: string, itemDataTypeDDL: string>"
STATE = (f"column string, type string, rows bigint, n bigint, mean double, var double, lo double, hi double, "
         f"quantiles binary, distinct binary, frequent {FREQUENT}")


def _sketched(df: DataFrame, name: str) -> bool:
    return kind(df.schema[name].dataType) in ("numeric", "datetime")


def chunk_states(df: DataFrame, chunk: Column | None = None) -> DataFrame:
    """``(chunk, column, ...)``: the state of each column of each chunk, in one scan.

    ``chunk`` says which chunk a row belongs to; without it the table is one chunk, named by an empty text.
    """
    label = F.lit("") if chunk is None else chunk.cast("string")
    columns, inner, outer, cells = [], ["count(1) rows"], ["sum(rows) rows"], []
    for i, f in enumerate(df.schema):
        is_number = _sketched(df, f.name)
        if is_number:
            value = micros(df, f.name) if is_temporal(f.dataType) else present(df, f.name)
            columns.append(value.cast("double").alias(f"v{i}"))
            inner += [f"avg(v{i}) m{i}", f"var_pop(v{i}) s{i}", f"min(v{i}) lo{i}", f"max(v{i}) hi{i}",
                      f"kll_sketch_agg_double(v{i}, {SKETCH_K}) k{i}", f"hll_sketch_agg(xxhash64(v{i}), 12) FILTER (WHERE v{i} IS NOT NULL) d{i}"]
            outer += [f"collect_list(struct(n{i} n, m{i} mean, s{i} var)) p{i}", f"min(lo{i}) lo{i}", f"max(hi{i}) hi{i}",
                      f"kll_merge_agg_double(CASE WHEN n{i} > 0 THEN k{i} END) k{i}"]
        else:
            text = as_text(df, f.name)
            columns.append(F.when(F.length(text) > DIGEST_OVER, F.sha2(text, 256)).otherwise(text).alias(f"v{i}"))
            inner += [f"hll_sketch_agg(v{i}, 12) FILTER (WHERE v{i} IS NOT NULL) d{i}",
                      f"approx_top_k_accumulate(v{i}, {TRACKED}) t{i}"]
            outer.append(f"approx_top_k_combine(t{i}, {TRACKED}) t{i}")
        inner.append(f"count(v{i}) n{i}")
        outer += [f"sum(n{i}) n{i}", f"hll_union_agg(d{i}) FILTER (WHERE n{i} > 0) d{i}"]
        merged = f"p{i}" if is_number else "CAST(NULL AS array<struct<n: bigint, mean: double, var: double>>)"
        numbers = (f"lo{i}", f"hi{i}", f"CASE WHEN n{i} > 0 THEN k{i} END") if is_number else (
            "CAST(NULL AS double)", "CAST(NULL AS double)", "CAST(NULL AS binary)")
        frequent = f"CAST(NULL AS {FREQUENT})" if is_number else (
            f"CAST(named_struct('sketch', t{i}.sketch, 'maxItemsTracked', t{i}.maxItemsTracked, 'itemDataType', "
            f"CAST(NULL AS string), 'itemDataTypeDDL', t{i}.itemDataTypeDDL) AS {FREQUENT})")
        name = f.name.replace("\\", "\\\\").replace("'", "\\'")
        cells.append(f"named_struct('column', '{name}', 'type', '{f.dataType.simpleString()}', 'rows', rows, 'n', n{i}, "
                     f"'parts', {merged}, 'lo', {numbers[0]}, 'hi', {numbers[1]}, 'quantiles', {numbers[2]}, "
                     f"'distinct', d{i}, 'frequent', {frequent})")
    slot = (F.spark_partition_id() % F.lit(SLOTS)).alias("__slot")
    folded = (df.select(label.alias("__chunk"), slot, *columns).groupBy("__chunk", "__slot")
              .agg(*[F.expr(e) for e in inner]).groupBy("__chunk").agg(*[F.expr(e) for e in outer]))
    rows = folded.selectExpr("coalesce(__chunk, 'missing') AS chunk", f"inline(array({', '.join(cells)}))")
    return rows.select("chunk", "column", "type", "rows", "n", *_moments("parts"), "lo", "hi", "quantiles", "distinct",
                       "frequent")


def _moments(parts: str) -> list[Column]:
    """Mean and population variance of the union of parts (n, mean, var), added up in a fixed order."""
    start = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("m2"))

    def add(a: Column, p: Column) -> Column:
        n, gap = a["n"] + p["n"], p["mean"] - a["mean"]
        return F.struct(n.alias("n"), (a["mean"] + gap * p["n"] / n).alias("mean"),
                        (a["m2"] + p["var"] * p["n"] + gap * gap * a["n"] * p["n"] / n).alias("m2"))

    known = F.array_sort(F.filter(parts, lambda p: p["n"] > 0))
    total = F.aggregate(known, start, add)
    return [F.when(total["n"] > 0, total["mean"]).alias("mean"),
            F.when(total["n"] > 0, total["m2"] / total["n"]).alias("var")]


def add_chunk(df: DataFrame, path: str, chunk: str) -> None:
    """Write the state of one chunk; the same chunk again replaces it."""
    chunk_states(df).drop("chunk").write.mode("overwrite").parquet(f"{path}/chunk={chunk}")


def add_chunks(df: DataFrame, path: str, chunk: Column) -> None:
    """Write the states of all chunks of a table, in one scan; chunks that were there are replaced."""
    (chunk_states(df, chunk).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("chunk").parquet(path))


def record_chunks(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Keep the state of every chunk of a stream; a replayed chunk overwrites its own."""
    return (stream.writeStream.foreachBatch(lambda batch, number: add_chunk(batch, path, str(number)))
            .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())


@dataclass(frozen=True)
class ColumnState:
    """The union of some chunks' states of one column."""

    type: str
    stats: Stats
    distinct: int
    leaders: list[tuple[str, int]]      # frequent texts with upper limits of their counts, falling

    def mode(self) -> str | None:
        """The commonest text, smallest on ties, if the sketch proves it: counts are exact while the table of the
        sketch was never full; otherwise the leader must be ahead of all others by more than the error."""
        if not self.leaders:
            return None
        most, error = self.leaders[0][1], COUNT_ERROR * self.stats.rows
        if self.distinct <= TRACKED // 2:
            tied = sorted(v for v, n in self.leaders if n == most)
            proven = len(tied) < LEADERS
        else:
            tied = [self.leaders[0][0]]
            proven = most - error > max([2 * error, *[n for _, n in self.leaders[1:2]]])
        return tied[0] if proven and all(len(v) <= DIGEST_OVER for v in tied) else None


@dataclass(frozen=True)
class TableState:
    """Merged states of a table's columns."""

    rows: int
    chunks: int
    columns: Mapping[str, ColumnState]


def merged(spark: SparkSession, path: str, chunks: Iterable[str] | None = None) -> TableState:
    """The state of all recorded chunks, or of some; reads the small state rows only."""
    states = spark.read.schema(f"{STATE}, chunk string").parquet(path)
    if chunks is not None:
        states = states.where(F.col("chunk").isin(*chunks))
    fold = ["sum(rows) rows", "sum(n) n", "min(lo) lo", "max(hi) hi",
            "kll_merge_agg_double(quantiles) quantiles", "hll_union_agg(distinct, true) distinct"]
    slots = states.groupBy("column", "type", (F.xxhash64("chunk") % SLOTS).alias("slot")).agg(
        *[F.expr(e) for e in fold], F.count(F.lit(1)).alias("chunks"),
        F.collect_list(F.struct("n", "mean", "var")).alias("parts"))
    slots = slots.select("*", *_moments("parts")).drop("parts")
    even = f"cast(split('{','.join(str(i / GRID) for i in range(GRID + 1))}', ',') as array<double>)"
    rows = slots.groupBy("column", "type").agg(
        *[F.expr(e) for e in fold], F.sum("chunks").alias("chunks"),
        F.collect_list(F.struct("n", "mean", "var")).alias("parts"),
    ).selectExpr("column", "type", "rows", "n", "lo", "hi", "chunks", "parts",
                 f"CASE WHEN lo IS NOT NULL THEN kll_sketch_get_quantile_double(quantiles, {even}) END grid",
                 "hll_sketch_estimate(distinct) distinct").collect()        # one row a column
    combine = F.expr(f"approx_top_k_combine(frequent, {TRACKED})").alias("frequent")
    texts = states.where("frequent.sketch IS NOT NULL").groupBy("column", (F.xxhash64("chunk") % SLOTS).alias("slot")).agg(
        combine).groupBy("column").agg(combine).selectExpr("column", f"approx_top_k_estimate(frequent, {LEADERS + 1}) leaders")
    leaders = {r["column"]: [(x["item"], x["count"]) for x in r["leaders"] if x["item"] is not None][:LEADERS]
               for r in texts.collect()}        # nulls count as an item
    found = {}
    for r in rows:
        mean, std = _merge_moments(r["parts"]) if r["lo"] is not None else (None, None)
        if r["n"] and r["lo"] is not None and r["lo"] == r["hi"]:
            mean, std = r["lo"], 0.0 if r["n"] > 1 else None
        stats = Stats(r["rows"], r["n"], r["lo"], r["hi"], mean, std, grid=r["grid"] or ())
        found[r["column"]] = ColumnState(r["type"], stats, r["distinct"] or 0,
                                         leaders.get(r["column"], []))
    return TableState(max((c.stats.rows for c in found.values()), default=0), max((r["chunks"] for r in rows), default=0), found)


def _with_quantiles(stats: Stats, probs: Iterable[float]) -> Stats:
    for p in probs:
        if not stats.count:
            stats.quantiles[p] = None
        elif stats.min == stats.max:
            stats.quantiles[p] = stats.min
        else:
            stats.quantiles[p] = stats.grid[round(p * GRID)]
    return stats


def refit_nulls(spark: SparkSession, state: TableState, threshold: float = 0.5, strategy: str = "median",
                categorical: str = "mode", compat: bool = False) -> nulls.NullFit:
    """Dropped columns and fills of the union of the chunks, without a scan of their rows.

    Raises where a text column needs a mode that the sketches do not prove.
    """
    schema = T.StructType([T.StructField(c, T._parse_datatype_string(s.type)) for c, s in state.columns.items()])
    empty = spark.createDataFrame([], schema)
    stats = {c: _with_quantiles(s.stats, (0.5,)) for c, s in state.columns.items() if _sketched(empty, c)}
    counts = {c: s.stats.count for c, s in state.columns.items() if c not in stats}

    def modes(names: Iterable[str]) -> dict[str, object]:
        out: dict[str, object] = {}
        for c in names:
            s, value = state.columns[c], state.columns[c].mode()
            if kind(schema[c].dataType) == "numeric":
                raise ValueError(f"{c}: chunk states hold no mode of a number; fit the table itself")
            if s.stats.count and value is None:
                raise ValueError(f"{c}: the chunk states do not prove its mode; fit the table itself")
            if value is None:
                value = nulls.EMPTY_MODE_TEXT
            out[c] = value == "true" if isinstance(schema[c].dataType, T.BooleanType) else value
        return out

    return nulls.fit_nulls(empty, threshold, strategy, categorical, compat, exact=False, modes=modes,
                           measured=nulls.Measured(state.rows, stats, counts))


def refit_bounds(state: TableState, factor: float = outliers.IQR_FACTOR,
                 fills: Mapping[str, object] | None = None) -> dict[str, dict]:
    """Outlier bounds of the numeric columns; ``fills`` are counted as values where nulls were filled."""
    stats = {}
    for c, s in state.columns.items():
        if s.stats.min is not None and kind(T._parse_datatype_string(s.type)) == "numeric":
            filled = s.stats.filled(float(fills[c])) if fills and fills.get(c) is not None else s.stats
            stats[c] = _with_quantiles(filled, outliers.QUARTILES)
    return outliers.bounds_from(stats, factor)


def state_table(spark: SparkSession, state: TableState) -> DataFrame:
    """``(column, rows, nulls, mean, std, min, max, distinct_estimate)``: the merged state as rows."""
    rows = [(c, s.stats.rows, s.stats.nulls, s.stats.mean, s.stats.std, s.stats.min, s.stats.max, s.distinct)
            for c, s in state.columns.items()]
    return spark.createDataFrame(rows, "column string, rows bigint, nulls bigint, mean double, std double, "
                                       "min double, max double, distinct_estimate bigint")
