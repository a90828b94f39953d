"""Registry of this subpackage's queries and of the SQL that they must agree with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query, with its SQL twin when it has one."""

    def add(fn: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def load_all() -> None:
    """Import the modules that register queries."""
    import corpus_pipeline
    from arealis.llm import queries  # noqa: F401

    QUERIES["pipeline"] = corpus_pipeline.run
    if corpus_pipeline.ORACLE_SQL:
        ORACLES["pipeline"] = corpus_pipeline.ORACLE_SQL
