"""Registered queries and, where SQL can say the same, their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(column: Column | str) -> Column:
    """Six digits: engines differ in the last bits of sums and logarithms."""
    return F.round(F.col(column) if isinstance(column, str) else column, 6)


def big(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("long")


def round_columns(df: DataFrame, names) -> DataFrame:
    return df.withColumns({n: r6(n) for n in names})
