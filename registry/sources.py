"""Sources and sinks: written from the given tables and read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from registry.common import DIRTY, dirty, long_rows, per_column, r, rounded, table
from registry.nulls import null_report_sql
from winnow.operators import nulls
from winnow.plans.reports import report_table
from winnow.session import scratch_path
from winnow.sources import footers, readers, sample, sinks


CONVERSATIONS_PER_ARRAY = 500


def scan_csv(spark, sf):
    path = scratch_path(spark, "csv") + ".csv"
    sinks.write_csv(dirty(spark, sf), path)
    return readers.read_csv(spark, path)


def scan_csv_documents(spark, sf):
    """Whole texts, with their line breaks and quotes, written and read back."""
    path = scratch_path(spark, "texts") + ".csv"
    sinks.write_csv(table(spark, sf, "documents").select("doc_id", "text", "n_chars"), path)
    return readers.read_csv(spark, path)


def scan_csv_multiline(spark, sf):
    """Raw pages, whose quotes and line breaks lie inside quoted fields, read by all splits."""
    path = scratch_path(spark, "pages") + ".csv"
    sinks.write_csv(table(spark, sf, "pages"), path)
    return readers.read_csv(spark, path, encoding="UTF-8", multi_line=True)


def scan_json_array(spark, sf):
    """Conversations as files that each hold one array of objects, on one line or on many."""
    path = scratch_path(spark, "arrays") + ".json"
    turns = table(spark, sf, "conversations")
    group, gap = F.floor(F.col("conv_id") / CONVERSATIONS_PER_ARRAY), F.when(F.col("part") % 2 == 0, ",").otherwise(",\n  ")
    arrays = turns.select(group.alias("part"), F.to_json(F.struct(*turns.columns)).alias("row")).groupBy("part").agg(
        F.collect_list("row").alias("rows"))
    (arrays.select("part", F.concat(F.lit("["), F.array_join("rows", "\u0000"), F.lit("]")).alias("joined"))
     .select("part", F.replace(F.col("joined"), F.lit("\u0000"), gap).alias("value"))
     .write.partitionBy("part").text(path))
    return readers.read_json(spark, path, schema=turns.schema)


def scan_json(spark, sf):
    path = scratch_path(spark, "json") + ".json"
    table(spark, sf, "customer").write.json(path)
    return readers.read_json(spark, path)


def footer_profile(spark, sf):
    """Rows, nulls and extremes of a table's files, from their footers where those settle them."""
    return rounded(footers.footer_profile(spark, f"{sf}/orders.parquet"))


def scan_dispatch(spark, sf):
    """The same table by each extension: rows and a total of each."""
    df, base = table(spark, sf, "supplier"), scratch_path(spark, "dispatch")
    sinks.write_csv(df, f"{base}.csv")
    df.write.json(f"{base}.json")
    df.write.parquet(f"{base}.parquet")
    read = [readers.load(spark, f"{base}.{e}").agg(
        F.lit(e).alias("format"), F.count(F.lit(1)).alias("rows"),
        F.round(F.sum("s_acctbal"), 2).alias("total"), F.max("s_name").alias("last"))
        for e in ("csv", "json", "parquet")]
    return reduce(DataFrame.unionByName, read)


def scan_capped(spark, sf):
    path = scratch_path(spark, "capped") + ".csv"
    sinks.write_csv(table(spark, sf, "orders").drop("o_orderdate"), path)
    return readers.read_capped(spark, path, 100, 7, order_by="o_orderkey")


def sample_table(spark, sf):
    """One sample row per customer, drawn from the customer's number."""
    customers = table(spark, sf, "customer")
    ids = customers.select((F.col("c_custkey") + 1).alias("id"))
    return rounded(sample.sample_rows(ids, customers.count()), 3)


def sink_csv(spark, sf):
    df, path = table(spark, sf, "lineitem"), scratch_path(spark, "sink")
    sinks.write_csv(df, path)
    return spark.read.options(header=True, timestampNTZFormat=sinks.MOMENT).schema(df.schema).csv(path)


def sink_report(spark, sf):
    path = scratch_path(spark, "report")
    sinks.write_report(report_table({"missing_values": nulls.null_report(dirty(spark, sf), 0.7)}), path)
    return rounded(spark.read.json(path, schema="report string, column string, metric string, number double, text string"))


QUERIES = {f.__name__: f for f in (
    scan_csv, scan_csv_documents, scan_csv_multiline, scan_json, scan_json_array, footer_profile, scan_dispatch, scan_capped, sample_table, sink_csv, sink_report)}

# ---------------------------------------------------------------- checking SQL


def _u(tag: str) -> str:
    return (f"((CAST('0x' || substring(md5('42:{tag}:' || id), 1, 12) AS BIGINT) + 0.5::DOUBLE) "
            f"/ {16 ** 12}::DOUBLE)")


def _n(tag: str, mean: float, std: float) -> str:
    return (f"({mean}::DOUBLE + {std}::DOUBLE * sqrt(-2 * ln({_u(tag + '/u')})) * cos(2 * pi() * {_u(tag + '/v')}))")


def _masked(name: str, expr: str) -> str:
    return f"CASE WHEN {_u('null/' + name)} >= 0.05::DOUBLE THEN {expr} END AS {name}"


def _poisson() -> str:
    """k is the number of cumulative probabilities at or below u."""
    steps = ("list_transform(range(0, 30), lambda k: list_sum(list_transform(range(0, k + 1), "
             "lambda j: exp(-5) * pow(5, j) / gamma(j + 1))))")
    return f"len(list_filter({steps}, lambda p: p <= {_u('visits')}))"


PLANTED = "(floor(id * 20 / n) <> floor((id - 1) * 20 / n))"
NULL_REPORT = f"SELECT CAST(to_drop AS INTEGER) AS to_drop, * EXCLUDE (to_drop) FROM ({null_report_sql(0.7)})"
NUMBERS = ("o_orderkey", "o_custkey", "o_totalprice")
MISSING = "({})".format(", ".join(f"'{t}'" for t in readers.NA_TOKENS))
SQL = {
    "scan_csv_multiline": f"SELECT page_id, CASE WHEN url NOT IN {MISSING} THEN url END AS url, "
                          f"CASE WHEN html NOT IN {MISSING} THEN html END AS html FROM pages",
    "footer_profile": per_column(["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"], lambda c: f"""
        SELECT '{c}' AS "column", count(*) AS total_rows, count(*) - count({c}) AS null_count,
        {r(f'min({c})') if c in NUMBERS else 'CAST(NULL AS DOUBLE)'} AS low, {r(f'max({c})') if c in NUMBERS else 'CAST(NULL AS DOUBLE)'} AS high FROM orders"""),
    "scan_json_array": "SELECT * FROM conversations",
    "scan_csv": f"""{DIRTY} SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value,
        TRY_CAST(amount_text AS BIGINT) AS amount_text, ts_text, whole_float, CAST(constant AS BIGINT) AS constant FROM dirty""",
    "scan_csv_documents": "SELECT doc_id, CASE WHEN text NOT IN ({}) THEN text END AS text, n_chars FROM documents".format(
        ", ".join(f"'{t}'" for t in readers.NA_TOKENS)),
    "scan_json": "SELECT * FROM customer",
    "scan_dispatch": "SELECT format, count(*) AS rows, round(sum(s_acctbal), 2) AS total, max(s_name) AS \"last\" "
                     "FROM supplier, (VALUES ('csv'), ('json'), ('parquet')) f(format) GROUP BY format",
    "scan_capped": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders "
                   "ORDER BY o_orderkey LIMIT 700",
    "sample_table": f"""WITH i AS (SELECT c_custkey + 1 AS id, count(*) OVER () AS n FROM customer) SELECT
        {_masked('customer_id', 'id')}, {_masked('age', f"CAST(trunc({_n('age', 35, 10)}) AS INTEGER)")},
        {r(f"CASE WHEN {_u('null/salary')} >= 0.05::DOUBLE THEN {_n('salary', 50000, 15000)} * CASE WHEN {PLANTED} THEN 5 ELSE 1 END END", 3)} AS salary,
        {r(f"CASE WHEN {_u('null/purchase_amount')} >= 0.05::DOUBLE THEN -100 * ln({_u('purchase')}) * CASE WHEN {PLANTED} THEN 10 ELSE 1 END END", 3)} AS purchase_amount,
        {_masked('city', f"(['New York', 'London', 'Tokyo', 'Paris', NULL])[CAST(floor({_u('city')} * 5) AS INTEGER) + 1]")},
        {_masked('membership_date', "CAST(DATE '2020-01-01' + CAST(id - 1 AS INTEGER) AS TIMESTAMP)")},
        {_masked('is_premium', f"([true, false, NULL])[CAST(floor({_u('premium')} * 3) AS INTEGER) + 1]")},
        {_masked('rating', f"(['A', 'B', 'C', NULL])[CAST(floor({_u('rating')} * 4) AS INTEGER) + 1]")},
        {r(f"CASE WHEN {_u('null/score')} >= 0.05::DOUBLE THEN {_u('score')} * 100 END", 3)} AS score,
        {_masked('visits', f"CAST({_poisson()} AS INTEGER)")} FROM i""",
    "sink_csv": "SELECT * FROM lineitem",
    "sink_report": f"{DIRTY} SELECT report, \"column\", metric, {r('number')} AS number, text FROM ("
                   + long_rows("missing_values", NULL_REPORT, ["total_rows", "null_count", "to_drop", "fill_number", "null_pct"],
                               ["fill_text"]) + ")",
}
