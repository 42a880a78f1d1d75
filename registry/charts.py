"""Chart data."""

from __future__ import annotations

from registry.common import DIRTY, dirty, quantile, r, rounded, table
from winnow.operators import charts

POINTS, BINS = 64, 512


def histogram(spark, sf):
    return rounded(charts.histogram(dirty(spark, sf), "value"))


def box_stats(spark, sf):
    return rounded(charts.box_stats(dirty(spark, sf), "value"))


def box_stats_by(spark, sf):
    return rounded(charts.box_stats_by(dirty(spark, sf), "value", "event_type"))


def ecdf(spark, sf):
    return rounded(charts.ecdf(table(spark, sf, "lineitem"), "l_extendedprice"), 8)


def density(spark, sf):
    return rounded(charts.density(dirty(spark, sf), "value", POINTS, BINS), 8)


def scatter_points(spark, sf):
    return charts.scatter_points(dirty(spark, sf), "value", "whole_float", "event_id", "event_type", 500)


def scatter_even(spark, sf):
    return charts.scatter_even(dirty(spark, sf), "value", "whole_float", "event_id", "event_type", 50)


def ecdf_curve(spark, sf):
    return rounded(charts.ecdf_curve(table(spark, sf, "lineitem"), "l_extendedprice", 150), 8)


def density_by(spark, sf):
    return rounded(charts.density_by(dirty(spark, sf), "value", "event_type", POINTS, BINS), 8)


WILD = ("CASE WHEN event_id % 101 = 0 THEN CAST('infinity' AS DOUBLE) WHEN event_id % 103 = 0 THEN CAST('-infinity' AS DOUBLE) "
        "ELSE value END AS value")


def histogram_finite(spark, sf):
    """Infinite values among the finite ones."""
    return rounded(charts.histogram(table(spark, sf, "events").selectExpr(WILD), "value", 25))


def infinite_counts(spark, sf):
    return charts.infinite_counts(table(spark, sf, "events").selectExpr(WILD), ["value"])


def scatter_grid(spark, sf):
    return charts.scatter_grid(table(spark, sf, "lineitem"), "l_quantity", "l_extendedprice", 20, 20)


def sorted_series(spark, sf):
    return charts.sorted_series(table(spark, sf, "orders"), "o_totalprice", 100)


def _component(unit):
    def query(spark, sf):
        return charts.time_component_counts(dirty(spark, sf), "ts", unit)
    return query


def preview(spark, sf):
    return charts.preview(table(spark, sf, "orders"), 10, "o_orderkey", charts.PREVIEW_COLUMNS)


QUERIES = {f.__name__: f for f in (
    histogram, box_stats, box_stats_by, ecdf, density, scatter_points, scatter_even, scatter_grid,
    sorted_series, ecdf_curve, density_by, histogram_finite, infinite_counts, preview)}
QUERIES |= {f"time_component_{u}": _component(u) for u in charts.TIME_UNITS}

# ---------------------------------------------------------------- checking SQL

SPAN = "SELECT min(value) AS lo, max(value) AS hi, avg(value) AS mean, stddev_samp(value) AS std, count(value) AS n"


def _box(source: str, by: str | None) -> str:
    key, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"""{DIRTY}, q AS (SELECT {key}count(value) AS n, min(value) AS mn, {quantile('value', .25)} AS q1,
        {quantile('value', .5)} AS md, {quantile('value', .75)} AS q3, max(value) AS mx FROM {source} {group})
        SELECT {f"q.{by}, " if by else ""}any_value(n) AS n, {r('any_value(mn)')} AS min, {r('any_value(q1)')} AS q1,
        {r('any_value(md)')} AS median, {r('any_value(q3)')} AS q3, {r('any_value(mx)')} AS max,
        {r('min(CASE WHEN value >= q1 - 1.5::DOUBLE * (q3 - q1) THEN value END)')} AS whisker_low,
        {r('max(CASE WHEN value <= q3 + 1.5::DOUBLE * (q3 - q1) THEN value END)')} AS whisker_high,
        count(CASE WHEN value < q1 - 1.5::DOUBLE * (q3 - q1) OR value > q3 + 1.5::DOUBLE * (q3 - q1) THEN 1 END) AS outliers
        FROM {source} d {f"JOIN q ON q.{by} = d.{by}" if by else ", q"} WHERE value IS NOT NULL {f"GROUP BY q.{by}" if by else ""}"""


COMPONENT = {u: u for u in ("year", "month", "day", "hour", "minute")} | {"dayofweek": "isodow"}
SQL = {
    "histogram": f"""{DIRTY}, s AS ({SPAN}, {quantile('value', .5)} AS median, least(30, count(DISTINCT value)) AS bins FROM dirty),
        w AS (SELECT *, (hi - lo) / bins AS w FROM s),
        c AS (SELECT least(greatest(CAST(floor((value - lo) / w) AS BIGINT), 0), bins - 1) AS bin, count(*) AS k
              FROM dirty, w WHERE value IS NOT NULL GROUP BY 1)
        SELECT i AS bin, {r('lo + i * w')} AS lower, {r('lo + (i + 1) * w')} AS upper, {r('mean')} AS mean,
               {r('median')} AS median, coalesce(k, 0) AS "count"
        FROM w, range(0, 30) t(i) LEFT JOIN c ON c.bin = i WHERE i < bins""",
    "box_stats": _box('dirty', None),
    "box_stats_by": _box('dirty', 'event_type'),
    "ecdf": f"""SELECT {r('l_extendedprice', 8)} AS value, count(*) AS "count",
        {r('sum(count(*)) OVER (ORDER BY l_extendedprice) / sum(count(*)) OVER ()', 8)} AS share
        FROM lineitem GROUP BY l_extendedprice""",
    "density": f"""{DIRTY}, s AS ({SPAN} FROM dirty),
        p AS (SELECT *, (hi - lo) / {BINS} AS w, 1.06::DOUBLE * std * pow(n, -0.2::DOUBLE) AS band FROM s),
        c AS (SELECT least(greatest(floor((value - lo) / w), 0), {BINS - 1}) AS bin, count(*) AS k
              FROM dirty, p WHERE value IS NOT NULL GROUP BY 1),
        g AS (SELECT i, lo + i * ((hi - lo) / {POINTS - 1}) AS x, lo, w, band, n FROM p, range(0, {POINTS}) t(i))
        SELECT {r('any_value(x)', 8)} AS x,
          {r("sum(k * exp(-0.5::DOUBLE * pow((x - (lo + (bin + 0.5::DOUBLE) * w)) / band, 2))) / any_value(n * band * sqrt(2 * pi()))", 8)} AS density
        FROM g, c GROUP BY i""",
    "scatter_points": f"""{DIRTY} SELECT event_id AS key, value AS x, whole_float AS y, event_type AS color FROM dirty
        WHERE value IS NOT NULL ORDER BY md5(CAST(event_id AS VARCHAR)), CAST(event_id AS VARCHAR) LIMIT 500""",
    "scatter_even": f"""{DIRTY} SELECT key, x, y, color FROM (SELECT event_id AS key, value AS x, whole_float AS y,
        event_type AS color, row_number() OVER (PARTITION BY event_type ORDER BY md5(CAST(event_id AS VARCHAR)),
        CAST(event_id AS VARCHAR)) AS k FROM dirty WHERE value IS NOT NULL) WHERE k <= 50""",
    "ecdf_curve": f"""WITH v AS (SELECT l_extendedprice AS value, count(*) AS n, CAST(sum(count(*)) OVER (ORDER BY l_extendedprice) AS BIGINT) AS upto,
          CAST(sum(count(*)) OVER () AS BIGINT) AS total FROM lineitem GROUP BY 1),
        k AS (SELECT *, upto - n AS below FROM v WHERE (upto * 150) // total > ((upto - n) * 150) // total)
        SELECT {r('value', 8)} AS value, {r('upto / total', 8)} AS share,
          {r('(coalesce(lead(below) OVER (ORDER BY value), upto) - upto) / total', 8)} AS deviation FROM k""",
    "density_by": f"""{DIRTY}, s AS (SELECT event_type, {SPAN[7:]} FROM dirty WHERE event_type IS NOT NULL GROUP BY event_type),
        p AS (SELECT *, (hi - lo) / {BINS} AS w, 1.06::DOUBLE * std * pow(n, -0.2::DOUBLE) AS band FROM s WHERE hi > lo),
        c AS (SELECT event_type, least(greatest(floor((value - lo) / w), 0), {BINS - 1}) AS bin, count(*) AS k
              FROM dirty JOIN p USING (event_type) WHERE value IS NOT NULL GROUP BY 1, 2),
        g AS (SELECT event_type, i, lo + i * (hi - lo) / {POINTS - 1} AS x, lo, w, band, n FROM p, range(0, {POINTS}) t(i))
        SELECT event_type, {r('any_value(x)', 8)} AS x,
          {r("sum(k * exp(-0.5::DOUBLE * pow((x - (lo + (bin + 0.5::DOUBLE) * w)) / band, 2))) / any_value(n * band * sqrt(2 * pi()))", 8)} AS density
        FROM g JOIN c USING (event_type) GROUP BY event_type, i""",
    "histogram_finite": f"""WITH e AS (SELECT value FROM (SELECT {WILD} FROM events) WHERE abs(value) < CAST('infinity' AS DOUBLE)),
        s AS ({SPAN}, {quantile('value', .5)} AS median FROM e), w AS (SELECT *, (hi - lo) / 25 AS w FROM s),
        c AS (SELECT least(greatest(CAST(floor((value - lo) / w) AS BIGINT), 0), 24) AS bin, count(*) AS k FROM e, w GROUP BY 1)
        SELECT i AS bin, {r('lo + i * w')} AS lower, {r('lo + (i + 1) * w')} AS upper, {r('mean')} AS mean,
               {r('median')} AS median, coalesce(k, 0) AS "count" FROM w, range(0, 25) t(i) LEFT JOIN c ON c.bin = i""",
    "infinite_counts": f"""SELECT 'value' AS "column", count(*) FILTER (WHERE value = CAST('-infinity' AS DOUBLE)) AS negative,
        count(*) FILTER (WHERE value = CAST('infinity' AS DOUBLE)) AS positive FROM (SELECT {WILD} FROM events)""",
    "scatter_grid": """WITH s AS (SELECT min(l_quantity) AS x0, (max(l_quantity) - min(l_quantity)) / 20 AS wx,
          min(l_extendedprice) AS y0, (max(l_extendedprice) - min(l_extendedprice)) / 20 AS wy FROM lineitem)
        SELECT CAST(least(greatest(floor((l_quantity - x0) / wx), 0), 19) AS BIGINT) AS bx,
          CAST(least(greatest(floor((l_extendedprice - y0) / wy), 0), 19) AS BIGINT) AS by, count(*) AS "count"
        FROM lineitem, s GROUP BY 1, 2""",
    "sorted_series": """WITH o AS (SELECT o_totalprice AS value, row_number() OVER (ORDER BY o_totalprice) - 1 AS rn,
          count(*) OVER () AS n FROM orders)
        SELECT j AS "position", rn AS rank, value FROM o JOIN range(0, 100) t(j) ON rn = (j * (n - 1)) // 99""",
    "preview": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority "
               "FROM orders ORDER BY o_orderkey LIMIT 10",
}
SQL |= {
    f"time_component_{u}": f"{DIRTY} SELECT CAST(date_part('{p}', ts) AS BIGINT){' - 1' if u == 'dayofweek' else ''} "
                           "AS component, count(*) AS \"count\" FROM dirty WHERE ts IS NOT NULL GROUP BY 1"
    for u, p in COMPONENT.items()}
