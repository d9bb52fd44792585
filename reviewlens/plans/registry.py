"""Name -> query and name -> SQL, filled by the modules of this package."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a query; ``sql`` is its counterpart on the same tables."""

    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round the floating-point columns so both engines agree on the last bits."""
    def as_reported(name: str, kind: str) -> Column:
        if kind in ("double", "float"):
            return F.round(F.col(name).cast("double"), digits).alias(name)
        return F.col(name)

    return df.select(*[as_reported(n, k) for n, k in df.dtypes])


def r(expression: str, name: str, digits: int = 6) -> str:
    """The same rounding in SQL."""
    return f"round(CAST({expression} AS DOUBLE), {digits}) AS {name}"


def with_ctes(ctes: list[tuple[str, str]], body: str) -> str:
    listed = ",\n".join(f"{name} AS ({text})" for name, text in ctes)
    return f"WITH {listed}\n{body}"
