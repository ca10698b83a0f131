"""The queries of the core by name, each with the SQL that must give the same rows where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    """Registers a function (spark, sf_dir) -> DataFrame under its name."""

    if sql:
        sql = _longs(sql)

    def add(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _longs(sql: str) -> str:
    """count_if(x) as count(*) FILTER (WHERE x), whose type is a plain long."""
    while (at := sql.find("count_if(")) >= 0:
        depth, end = 1, at + 9
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        sql = f"{sql[:at]}count(*) FILTER (WHERE {sql[at + 9 : end - 1]}){sql[end:]}"
    return sql


def quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def sql_replace(expression: str, steps) -> str:
    """Nested regexp_replace of (pattern, replacement with $ groups)."""
    for pattern, replacement in steps:
        pattern = pattern.replace("(?md)", "(?m)").replace("(?imd)", "(?im)")
        expression = f"regexp_replace({expression}, {quoted(pattern)}, {quoted(replacement.replace('$', chr(92)))}, 'g')"
    return expression


def sql_literal(expression: str, pairs) -> str:
    for a, b in pairs:
        expression = f"replace({expression}, {quoted(a)}, {quoted(b)})"
    return expression
