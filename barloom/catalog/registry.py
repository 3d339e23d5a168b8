"""Registration of queries, and the views that oracle statements are built on."""

from __future__ import annotations

from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
IDS: dict[str, str] = {}


def query(ids: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a function under its own name."""

    def add(fn: Query) -> Query:
        if fn.__name__ in QUERIES:
            raise ValueError(f"query {fn.__name__} exists")
        QUERIES[fn.__name__], IDS[fn.__name__] = fn, ids
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return add


def rounded(frame: DataFrame, digits: int = 6, **special: int) -> DataFrame:
    """Round floating columns for comparison between engines; -0.0 becomes 0.0."""
    def one(f: T.StructField):
        if not isinstance(f.dataType, T.DoubleType):
            return F.col(f"`{f.name}`")
        return (F.round(F.col(f"`{f.name}`"), special.get(f.name, digits)) + F.lit(0.0)).alias(f.name)

    return frame.select([one(f) for f in frame.schema.fields])


def rnd(expression: str, name: str | None = None, digits: int = 6) -> str:
    """The same rounding in SQL."""
    return f"ROUND(CAST({expression} AS DOUBLE), {digits}) + 0.0 AS {name or expression}"


VIEWS: dict[str, tuple[tuple[str, ...], str]] = {}  # name -> (views it reads, statement)


def view(name: str, needs: tuple[str, ...], sql: str) -> None:
    VIEWS[name] = (needs, sql)


def over(*names: str, body: str, recursive: str = "") -> str:
    """A statement with the named views (and what they read) as leading expressions."""
    order: list[str] = []

    def visit(n: str) -> None:
        needs, _ = VIEWS[n]
        for m in needs:
            visit(m)
        if n not in order:
            order.append(n)

    for n in names:
        visit(n)
    parts = [f"{n} AS MATERIALIZED ({VIEWS[n][1]})" if "RECURSIVE" not in VIEWS[n][1] else f"{n} AS ({VIEWS[n][1].replace('RECURSIVE', '')})" for n in order]
    return "WITH RECURSIVE " + ",\n".join(parts) + "\n" + body
