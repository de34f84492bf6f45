"""One entry per query: its columns and types, the Spark plan, and the SQL twin where there is one."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from checks.base_sql import sql

# column kinds: text (also dates), whole number, exact or gappy number, rounded number, truth value
_SPARK: dict[str, Callable[[Column], Column]] = {
    "s": lambda c: c.cast("string"),
    "i": lambda c: c.cast("long"),
    # + 0.0 turns a negative zero into zero
    "n": lambda c: c.cast("double") + F.lit(0.0),
    "r": lambda c: F.round(c.cast("double"), 6) + F.lit(0.0),
    "b": lambda c: c.cast("boolean"),
}
_SQL = {
    "s": "{0}::VARCHAR",
    "i": "{0}::BIGINT",
    "n": "{0}::DOUBLE + 0.0::DOUBLE",
    "r": "round({0}::DOUBLE, 6) + 0.0::DOUBLE",
    "b": "{0}::BOOLEAN",
}


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None


QUERIES: dict[str, Query] = {}


def columns(spec: str) -> list[tuple[str, str]]:
    return [tuple(part.rsplit(":", 1)) for part in spec.split()]


def add(name: str, spec: str, plan: Callable[[SparkSession, str], DataFrame], text: str | None = None, **blocks: str):
    """Register a query.  `spec` lists `column:kind`; both sides are brought to it."""
    cols = columns(spec)

    def run(spark: SparkSession, folder: str) -> DataFrame:
        return plan(spark, folder).select(*[_SPARK[k](F.col(c)).alias(c) for c, k in cols])

    twin = None
    if text is not None:
        shown = ", ".join(f"{_SQL[k].format(c)} AS {c}" for c, k in cols)
        twin = sql(f"SELECT {shown} FROM ({text.strip()})", **blocks)
    if name in QUERIES:
        raise ValueError(name)
    QUERIES[name] = Query(run, twin)
