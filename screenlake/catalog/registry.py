"""Registry of queries and their SQL."""

from __future__ import annotations

import re
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from screenlake.adapters import ADAPTERS, sql_of

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query. In `sql`, `@name` stands for the adapter of that name."""

    def add(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = with_adapters(sql)
        return fn

    return add


def with_adapters(sql: str) -> str:
    used = sorted({n for n in re.findall(r"@(\w+)", sql) if n in ADAPTERS})
    ctes = ", ".join(f"dom_{n} AS ({sql_of(n)})" for n in used)
    body = re.sub(r"@(\w+)", r"dom_\1", sql).strip()
    if not ctes:
        return body
    if body.startswith("WITH RECURSIVE"):
        return f"WITH RECURSIVE {ctes}, {body[len('WITH RECURSIVE'):]}"
    if body.startswith("WITH"):
        return f"WITH {ctes}, {body[len('WITH'):]}"
    return f"WITH {ctes} {body}"
