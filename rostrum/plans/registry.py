"""Registry of named queries with their reference SQL.

A query is a function of `Views`; its SQL may use the mapping views by name, which are
added as common table expressions. Dates, times and booleans are written as text and
numbers so that every engine and client shows the same values.
"""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rostrum.plans.views import SQL_VIEWS, Views

QUERIES: dict[str, Callable[[Views], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, name: str | None = None):
    """Register a query under its function name."""
    def register(fn: Callable[[Views], DataFrame]):
        key = name or fn.__name__
        if key in QUERIES:
            raise ValueError(f"query {key} exists")
        QUERIES[key] = fn
        if sql is not None:
            # A rounded tiny negative number is -0.0 in one engine and 0.0 in the other.
            SQL[key] = sql.replace(", 6) AS", ", 6) + 0.0 AS")
        return fn

    return register


def present(df: DataFrame) -> DataFrame:
    """Plain column types: text, 64-bit integers, doubles rounded to six places."""
    def plain(field: T.StructField):
        c, kind = F.col(f"`{field.name}`"), field.dataType
        if isinstance(kind, T.DateType):
            c = c.cast("string")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(kind, (T.BooleanType, T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
            c = c.cast("long")
        elif isinstance(kind, (T.FloatType, T.DoubleType)):
            c = F.round(c.cast("double"), 6)
        return c.alias(field.name)

    return df.select(*[plain(f) for f in df.schema])


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    """Every query as (session, data folder) -> DataFrame."""
    def bind(fn):
        return lambda spark, folder: present(fn(Views(spark, folder)))

    return {key: bind(fn) for key, fn in QUERIES.items()}


def _needed(sql: str, seen: tuple[str, ...] = ()) -> list[str]:
    out: list[str] = []
    for view, body in SQL_VIEWS.items():
        if view not in seen and re.search(rf"\b{view}\b", sql):
            for inner in _needed(body, (*seen, view)):
                if inner not in out:
                    out.append(inner)
            if view not in out:
                out.append(view)
    return out


def oracle_sql() -> dict[str, str]:
    """Reference SQL of every query that has one, complete with its views."""
    out = {}
    for key, sql in SQL.items():
        views = ", ".join(f"{v} AS ({SQL_VIEWS[v]})" for v in _needed(sql))
        body = sql.strip()
        if views:
            body = f"WITH {views}, {body[5:]}" if body.upper().startswith("WITH ") else f"WITH {views} {body}"
        out[key] = body
    return out
