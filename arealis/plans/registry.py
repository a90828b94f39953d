"""Registry of runnable queries and the SQL that each must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with its SQL twin when it has one."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def rounded(df: DataFrame, digits: int | dict[str, int] = 6, default: int = 6) -> DataFrame:
    """Round every double so that sums taken in another order compare equal; adding zero clears a negative zero."""

    def one(name: str, kind: str) -> Column:
        if kind != "double":
            return F.col(f"`{name}`")
        k = digits.get(name, default) if isinstance(digits, dict) else digits
        return (F.round(F.col(f"`{name}`"), k) + F.lit(0.0)).alias(name)

    return df.select(*[one(n, t) for n, t in df.dtypes])


def load_all() -> None:
    """Import the modules that register queries."""
    from arealis.plans import area_queries, bordered_queries, cell_queries, model_queries, recode_queries, survey_queries, zone_queries  # noqa: F401
