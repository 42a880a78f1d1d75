"""Exact order statistics without sorting or collecting a column.

A mergeable KLL sketch brackets the wanted rank within a fraction of a percent; one more
pass counts what lies below the bracket and the values inside it, which settles the rank
exactly. Sketches merge in two steps over a fixed number of slots, so no task ever reads
one sketch per input split, and a value that fills a third of the table collapses in the
map-side count.
"""

from __future__ import annotations

import math
from bisect import bisect_left
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window, functions as F

from winnow.functions.columns import col, double_literal, has_value
from winnow.operators.frequency import distinct_estimates

SLOTS = 64            # groups for the first merge of partial results
SKETCH_K = 2000       # KLL size: rank error about 0.2 %, 50 kB a column
GRID = 256            # ranks read from a sketch, evenly spaced
BRACKET = 0.004       # margin around a wanted rank, as a share of the rows sketched
MAX_BRACKET_ROWS = 4_000_000   # larger brackets are sketched again before values are counted
SPLITS = 2048         # value ranges for prefix sums over a whole column
FEW_GROUPS = 100_000  # groups whose ranges (a few rows each) are broadcast


@dataclass
class Stats:
    """What one scan says about one numeric expression."""

    rows: int
    count: int
    min: float | None
    max: float | None
    mean: float | None
    std: float | None
    quantiles: dict[float, float | None] = field(default_factory=dict)
    grid: Sequence[float] = field(default=(), repr=False)    # values at even ranks of the sketch

    @property
    def nulls(self) -> int:
        return self.rows - self.count

    @property
    def seen(self) -> int:
        """Distinct values met in the sketch: a lower limit of the column's own."""
        return len(set(self.grid))

    def filled(self, value: float) -> "Stats":
        """These statistics once every null holds ``value``; the grid becomes an estimate."""
        if not self.nulls:
            return self
        if not self.count:
            return Stats(self.rows, self.rows, value, value, value, 0.0 if self.rows > 1 else None,
                         grid=[value] * (GRID + 1))
        variance = (self.std or 0.0) ** 2 * (self.count - 1) / self.count
        mean, std = _merge_moments([
            {"n": self.count, "mean": self.mean, "var": variance}, {"n": self.nulls, "mean": value, "var": 0.0}])
        below = bisect_left(self.grid, value) / GRID * self.count
        grid = []
        for i in range(GRID + 1):
            rank = i / GRID * self.rows
            if below < rank < below + self.nulls:
                grid.append(value)
            else:
                at = rank if rank <= below else rank - self.nulls
                grid.append(self.grid[min(GRID, round(at / self.count * GRID))])
        low, high = min(self.min, value), max(self.max, value)
        return Stats(self.rows, self.rows, low, high, mean, std, grid=sorted([low, *grid[1:-1], high]))


@dataclass
class _Target:
    """A rank still to be found: its column, bracket and the rows sketched for it."""

    name: str
    prob: float
    low_rank: int
    high_rank: int
    lo: float
    hi: float
    sketched: int
    width: float = BRACKET

    def expected_rows(self) -> float:
        return 2 * (self.width + 1 / GRID) * self.sketched + 4

    def widen(self, stats: Stats) -> None:
        self.width = min(0.5, self.width * 4)
        self.lo, self.hi, self.sketched = stats.min, stats.max, stats.count

    def bracket(self, grid: Sequence[float], rank: float, n: int) -> tuple[float, float]:
        """The grid values on both sides of a rank among ``n`` sketched rows."""
        margin = self.width + 2 / n
        low = math.floor((rank / n - margin) * GRID)
        high = math.ceil((rank / n + margin) * GRID)
        return grid[max(0, low)], grid[min(GRID, high)]


def _even_ranks(parts: int) -> str:
    """0, 1/parts, ... 1 as a constant array, without an expression per rank."""
    return f"cast(split('{','.join(str(i / parts) for i in range(parts + 1))}', ',') as array<double>)"


def _grid(sketch: str, n: str, parts: int = GRID) -> str:
    """Values at evenly spaced ranks of a sketch; null when it is empty."""
    return f"CASE WHEN {n} > 0 THEN kll_sketch_get_quantile_double({sketch}, {_even_ranks(parts)}) END"


def _merge_sketches(sketch: str, n: str) -> str:
    return f"kll_merge_agg_double(CASE WHEN {n} > 0 THEN {sketch} END)"


def _by_slot(df: DataFrame, columns: Sequence[Column], inner: Sequence[str], outer: Sequence[str]) -> DataFrame:
    """Aggregate in two steps: by slot, then over the slots. Expressions are computed once."""
    slot = (F.spark_partition_id() % F.lit(SLOTS)).alias("slot")
    return (
        df.select(slot, *columns).groupBy("slot").agg(*[F.expr(e) for e in inner])
        .agg(*[F.expr(e) for e in outer])
    )


def _merge_moments(parts: Sequence) -> tuple[float | None, float | None]:
    """Mean and sample deviation from per-slot counts, means and population variances."""
    n, mean, m2 = 0, 0.0, 0.0
    for part in sorted((p for p in parts if p["n"]), key=lambda p: (p["n"], p["mean"])):
        gap, total = part["mean"] - mean, n + part["n"]
        m2 += part["var"] * part["n"] + gap * gap * n * part["n"] / total
        mean += gap * part["n"] / total
        n = total
    if n == 0:
        return None, None
    return mean, (math.sqrt(m2 / (n - 1)) if n > 1 else None)


def summarize(
    df: DataFrame,
    values: Mapping[str, Column],
    probs: Sequence[float] = (),
    counts: Mapping[str, Column] | None = None,
    exact: bool = True,
    needed: Callable[[Stats], bool] = lambda stats: True,
) -> tuple[dict[str, Stats], dict[str, int]]:
    """Count, extremes, mean, deviation and quantiles of several expressions.

    One scan, plus one more when exact quantiles are asked for. ``counts`` adds non-null
    counts of other expressions to the first scan; they are returned with the row count
    under ``""``. ``exact=False`` keeps the sketch's estimate (rank error about 0.2 %) and
    saves the second scan. ``needed`` says, from the first scan, which columns are worth
    exact quantiles; the others keep the estimate.
    """
    counts = dict(counts or {})
    names = list(values)
    doubles = [values[name].cast("double").alias(f"v{i}") for i, name in enumerate(names)]
    flags = [c.isNotNull().alias(f"c{j}") for j, c in enumerate(counts.values())]
    inner, outer, plain = ["count(1) rows"], ["sum(rows) rows"], ["rows"]
    for j in range(len(flags)):
        inner.append(f"count_if(c{j}) c{j}")
        outer.append(f"sum(c{j}) c{j}")
        plain.append(f"c{j}")
    for i in range(len(names)):
        inner += [f"count(v{i}) n{i}", f"avg(v{i}) m{i}", f"var_pop(v{i}) v{i}"]
        outer += [f"sum(n{i}) n{i}", f"collect_list(struct(n{i} AS n, m{i} AS mean, v{i} AS var)) p{i}"]
        plain += [f"n{i}", f"p{i}"]
        if probs:    # a sketch keeps the exact extremes
            inner.append(f"kll_sketch_agg_double(v{i}, {SKETCH_K}) k{i}")
            outer.append(f"{_merge_sketches(f'k{i}', f'n{i}')} k{i}")
            plain.append(f"{_grid(f'k{i}', f'n{i}')} q{i}")
        else:
            inner += [f"min(v{i}) lo{i}", f"max(v{i}) hi{i}"]
            outer += [f"min(lo{i}) lo{i}", f"max(hi{i}) hi{i}"]
            plain += [f"lo{i}", f"hi{i}"]
    row = _by_slot(df, [*doubles, *flags], inner, outer).selectExpr(*plain).first()

    rows = row["rows"] or 0
    out: dict[str, Stats] = {}
    for i, name in enumerate(names):
        mean, std = _merge_moments(row[f"p{i}"])
        n = row[f"n{i}"] or 0
        grid = (row[f"q{i}"] or ()) if probs else ()
        lo, hi = (row[f"lo{i}"], row[f"hi{i}"]) if not probs else (grid[0], grid[-1]) if n else (None, None)
        if n and lo == hi:    # merged partial means leave a trace of variance on constants
            mean, std = lo, (0.0 if n > 1 else None)
        out[name] = Stats(rows, n, lo, hi, mean, std, grid=grid)
    settle(df, values, out, probs, lambda s: exact and needed(s))
    return out, {"": rows} | {c: row[f"c{j}"] or 0 for j, c in enumerate(counts)}


def settle(
    df: DataFrame, values: Mapping[str, Column], stats: Mapping[str, Stats], probs: Sequence[float],
    needed: Callable[[Stats], bool] = lambda stats: True, margin: float = BRACKET,
) -> None:
    """Set the quantiles of ``stats`` from their grids: exactly where ``needed``, in one
    scan for all columns, else as estimated. ``margin`` allows for the grid's rank error."""
    targets: list[_Target] = []
    for name, s in stats.items():
        for p in probs:
            if s.count == 0:
                s.quantiles[p] = None
            elif s.min == s.max:
                s.quantiles[p] = s.min
            elif not needed(s):
                s.quantiles[p] = s.grid[round(p * GRID)]
            else:
                rank = p * (s.count - 1)
                t = _Target(name, p, math.floor(rank), math.ceil(rank), s.min, s.max, s.count, margin)
                t.lo, t.hi = t.bracket(s.grid, rank, s.count)
                targets.append(t)
    _resolve(df, {t.name: values[t.name].cast("double") for t in targets}, targets, stats)


def _resolve(df, doubles, targets: list[_Target], out: dict[str, Stats]) -> None:
    while targets:
        wide = [t for t in targets if t.expected_rows() > MAX_BRACKET_ROWS and t.lo < t.hi]
        if wide:
            _narrow(df, doubles, wide, out)
            continue
        found = _select(df, doubles, targets)
        left = []
        for t, (low, high) in zip(targets, found):
            if low is None or high is None:   # the sketch missed: start over, four times wider
                t.widen(out[t.name])
                left.append(t)
                continue
            share = t.prob * (out[t.name].count - 1) - t.low_rank
            out[t.name].quantiles[t.prob] = low + (high - low) * share
        targets = left


def _narrow(df, doubles, targets: list[_Target], out: dict[str, Stats]) -> None:
    """Sketch the rows inside each bracket and shrink it around the wanted ranks."""
    columns, inner, outer, picks = [], [], [], []
    for i, t in enumerate(targets):
        columns.append(doubles[t.name].alias(f"v{i}"))
        lo, hi = double_literal(t.lo), double_literal(t.hi)
        inside = f"CASE WHEN v{i} >= {lo} AND v{i} <= {hi} THEN v{i} END"
        inner += [f"count_if(v{i} < {lo}) b{i}", f"count({inside}) n{i}",
                  f"kll_sketch_agg_double({inside}, {SKETCH_K}) k{i}"]
        outer += [f"sum(b{i}) b{i}", f"sum(n{i}) n{i}", f"{_merge_sketches(f'k{i}', f'n{i}')} k{i}"]
        picks += [f"b{i}", f"n{i}", f"{_grid(f'k{i}', f'n{i}')} q{i}"]
    row = _by_slot(df, columns, inner, outer).selectExpr(*picks).first()
    for i, t in enumerate(targets):
        below, inside = row[f"b{i}"], row[f"n{i}"]
        if not (below <= t.low_rank and t.high_rank < below + inside):
            t.widen(out[t.name])
            continue
        t.width = BRACKET
        narrowed = t.bracket(row[f"q{i}"], t.low_rank - below, inside)
        # no narrower by rank means that a few values with many copies are all that is left
        t.sketched = 0 if narrowed == (t.lo, t.hi) else inside
        t.lo, t.hi = narrowed


def _zones(brackets: Sequence[tuple[float, float]]) -> list[tuple[float, float]]:
    """Brackets in order, with overlapping ones joined."""
    joined: list[tuple[float, float]] = []
    for lo, hi in sorted(brackets):
        if joined and lo <= joined[-1][1]:
            joined[-1] = (joined[-1][0], max(hi, joined[-1][1]))
        else:
            joined.append((lo, hi))
    return joined


def _select(df, doubles, targets: list[_Target]) -> list[tuple[float | None, float | None]]:
    """The values at each target's two ranks; None where the bracket does not hold them.

    Each column is cut into zones: brackets, and the gaps below and between them. Gaps are
    counted whole and brackets value by value, so running counts give exact ranks.
    """
    names = list(dict.fromkeys(t.name for t in targets))
    cells, ranks = [], []
    for i, name in enumerate(names):
        mine = [t for t in targets if t.name == name]
        zone, value = "CASE", "CASE"
        for z, (lo, hi) in enumerate(_zones([(t.lo, t.hi) for t in mine])):
            below, upto = f"WHEN v{i} < {double_literal(lo)}", f"WHEN v{i} <= {double_literal(hi)}"
            zone += f" {below} THEN {2 * z} {upto} THEN {2 * z + 1}"
            value += f" {below} THEN NULL {upto} THEN v{i}"
        cells += [str(i), f"{zone} END", f"{value} END"]
        ranks.append(sorted({r for t in mine for r in (t.low_rank, t.high_rank)}))
    in_order = Window.partitionBy("item").orderBy("zone", "value")
    wanted = "array(" + ",".join(f"array({','.join(f'{r}L' for r in rs)})" for rs in ranks) + ")"
    hits = (
        df.select(*[doubles[name].alias(f"v{i}") for i, name in enumerate(names)])
        .selectExpr(f"stack({len(names)}, {', '.join(cells)}) AS (item, zone, value)")
        .filter("zone is not null")
        .groupBy("item", "zone", "value").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
        .filter(f"exists(get({wanted}, item), r -> r < upto and r >= upto - n)")
        .collect()    # at most two rows per target
    )

    def value_at(name: str, rank: int) -> float | None:
        return next((h["value"] for h in hits
                     if names[h["item"]] == name and h["upto"] - h["n"] <= rank < h["upto"]), None)

    return [(value_at(t.name, t.low_rank), value_at(t.name, t.high_rank)) for t in targets]


def value_splits(df: DataFrame, value: Column, parts: int = SPLITS) -> list[float]:
    """At most ``parts`` increasing values that cut the rows into even shares."""
    row = _by_slot(
        df, [value.cast("double").alias("v")],
        ["count(v) n", f"kll_sketch_agg_double(v, {SKETCH_K}) k"],
        ["sum(n) n", f"{_merge_sketches('k', 'n')} k"],
    ).selectExpr(f"{_grid('k', 'n', parts)} q").first()
    return sorted(set(row["q"] or []))


def with_range(df: DataFrame, name: str, splits: Sequence[float], out: str = "range") -> DataFrame:
    """Number the value range each row falls in; equal values share a range."""
    edges = [-math.inf, *[s for s in splits if math.isfinite(s)], math.inf]
    if len(edges) < 3:
        return df.withColumn(out, F.lit(0.0))
    return Bucketizer(splits=edges, inputCol=name, outputCol=out, handleInvalid="keep").transform(df)


def running_counts(counted: DataFrame, splits: Sequence[float]) -> DataFrame:
    """Cumulative ``n`` over distinct ``value`` rows, in value order, as ``upto``.

    The running sum is taken inside each value range and lifted by the totals of the
    ranges before it, so the whole domain is never sorted in one task.
    """
    ranged = with_range(counted, "value", splits)
    # one row per range, a bounded number: safe to put in order in one task and to broadcast
    starts = (
        ranged.groupBy("range").agg(F.sum("n").alias("in_range"))
        .withColumn("before", F.coalesce(
            F.sum("in_range").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)),
            F.lit(0)))
        .withColumn("total", F.sum("in_range").over(
            Window.orderBy("range").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))
        .drop("in_range")
    )
    inside = F.sum("n").over(
        Window.partitionBy("range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    )
    return (
        ranged.withColumn("inside", inside)
        .join(F.broadcast(starts), "range")
        .select("value", "n", (F.col("before") + F.col("inside")).alias("upto"), "total")
    )


def group_estimate(df: DataFrame, by: str) -> int:
    """About how many groups there are (2 % error), to choose how to join on them."""
    return distinct_estimates(df, [by])[by]


def grouped_quantiles(
    df: DataFrame, by: str, name: str, probs: Sequence[float], splits: Sequence[float] | None = None,
    few_groups: bool | None = None,
) -> DataFrame:
    """Exact interpolated quantiles per group: columns ``by``, ``n``, ``q0``, ``q1``, ...

    Rows are first counted by group and value range; that says in which range each wanted
    rank lies. Only those ranges are then counted value by value, so a group holding a
    third of the table is spread over its ranges and never sits in one task.

    With few groups the wanted ranges are broadcast and rows outside them go before any
    shuffle. With many, rows are folded to counts of distinct values first, so that the
    shuffled join on (group, range) sees no copies.
    """
    rows = df.filter(has_value(df, name) & col(by).isNotNull()).select(
        col(by).alias("group"), col(name).cast("double").alias("value"))
    if splits is None:
        splits = value_splits(rows, F.col("value"))
    if few_groups is None:
        few_groups = group_estimate(df, by) <= FEW_GROUPS
    ranged = with_range(rows, "value", splits)

    in_order = Window.partitionBy("group").orderBy("range")
    cells = (
        ranged.groupBy("group", "range").agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
        .withColumn("total", F.sum("n").over(Window.partitionBy("group")))
    )
    wanted = []
    for j, p in enumerate(probs):
        at = F.lit(float(p)) * (F.col("total") - 1)
        for rank in (F.floor(at), F.ceil(at)):
            wanted.append(F.struct(
                F.lit(j).alias("j"), at.alias("at"), rank.cast("bigint").alias("rank")))
    targets = (
        cells.select("group", "range", "total", "upto", "n", F.explode(F.array(*wanted)).alias("w"))
        .filter("w.rank < upto and w.rank >= upto - n")
        .select("group", "range", "total", "w.j", "w.at", "w.rank",
                (F.col("w.rank") - F.col("upto") + F.col("n")).alias("local"))
        .distinct()
    )
    places = targets.select("group", "range").distinct()
    keys, n = ["group", "range", "value"], F.count(F.lit(1)).alias("n")
    if few_groups:
        counted = ranged.join(F.broadcast(places), ["group", "range"], "left_semi").groupBy(*keys).agg(n)
    else:
        counted = ranged.groupBy(*keys).agg(n).join(places, ["group", "range"], "left_semi")
    valued = counted.withColumn("upto", F.sum("n").over(
        Window.partitionBy("group", "range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)))
    # one row per distinct value in the wanted ranges, matched on (group, range)
    hits = (
        valued.join(F.broadcast(targets) if few_groups else targets, ["group", "range"])
        .filter("local < upto and local >= upto - n")
    )
    aggs = []
    for j, _ in enumerate(probs):
        mine = F.col("j") == j
        low = F.max(F.when(mine & (F.col("rank") == F.floor("at")), F.col("value")))
        high = F.max(F.when(mine & (F.col("rank") == F.ceil("at")), F.col("value")))
        at = F.max(F.when(mine, F.col("at")))
        aggs.append((low + (high - low) * (at - F.floor(at))).alias(f"q{j}"))
    return hits.groupBy(F.col("group").alias(by)).agg(F.max("total").alias("n"), *aggs)
