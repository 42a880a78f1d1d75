"""Every operator as a query over the given tables, with the SQL that checks it."""

from registry import charts, nulls, outliers, plans, profile, sources, streaming, types

MODULES = (sources, types, nulls, outliers, profile, charts, plans, streaming)


def all_queries() -> dict:
    return {name: q for m in MODULES for name, q in m.QUERIES.items()}


def all_sql() -> dict[str, str]:
    return {name: sql for m in MODULES for name, sql in m.SQL.items()}
