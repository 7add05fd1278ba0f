"""Queries by name, and the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None, given: str = "") -> Callable[[Query], Query]:
    """Register a query; given holds the common table expressions that its SQL starts from."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            head = given.strip()
            body = sql.strip()
            if head and body.upper().startswith("WITH RECURSIVE"):
                body, head = body[len("WITH RECURSIVE") :], head.replace("WITH", "WITH RECURSIVE", 1)
                SQL[name] = f"{head}, {body}"
            elif head and body.startswith(","):
                SQL[name] = f"{head}{body}"
            elif head and body.upper().startswith("WITH"):
                SQL[name] = f"{head}, {body[4:]}"
            else:
                SQL[name] = f"{head} {body}"
        return fn

    return add
