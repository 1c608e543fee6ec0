"""Registry of runnable queries with their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = function
        if sql is not None:
            ORACLES[name] = _plain_doubles(sql)
        return function

    return register


def _plain_doubles(sql: str) -> str:
    """Write every ``round(x, 6)`` of an SQL text as a double without negative zero."""
    out, at = [], 0
    while (begin := sql.find("round(", at)) >= 0:
        depth, end = 1, begin + len("round(")
        while depth:
            depth += {"(": 1, ")": -1}.get(sql[end], 0)
            end += 1
        inner = sql[begin + len("round("):end - 1]
        out.append(sql[at:begin])
        if inner.endswith(", 6"):
            out.append(f"(round(CAST({_plain_doubles(inner[:-3])} AS DOUBLE), 6) + 0.0)")
        else:
            out.append(sql[begin:end])
        at = end
    return "".join(out) + sql[at:]


def rounded(*names: str) -> list[Column]:
    """Columns rounded to six decimals, the precision at which results are compared."""
    return [F.round(F.col(n).cast("double"), 6).alias(n) for n in names]
