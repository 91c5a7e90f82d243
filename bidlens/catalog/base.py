"""Registry of runnable queries and the SQL each one is checked against."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}
DIGITS = 6
NUDGE = "1.3e-8"  # moves exact decimal ties off the rounding edge


def query(name: str, oracle: str | None = None, views: Sequence[str] = ()):
    """Register a query, with the SQL over the given tables that yields the same rows."""
    from bidlens.catalog.tables import with_views

    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = with_views(oracle, views)
        return fn
    return register


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every floating column for comparison across engines."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.round(c + F.lit(float(NUDGE)), digits)
        out.append(c.alias(f.name))
    return df.select(*out)


def r(expr: str, name: str, digits: int = DIGITS) -> str:
    """The same rounding in SQL."""
    return f"round(({expr}) + {NUDGE}, {digits}) as {name}"


def rs(names: Sequence[str], digits: int = DIGITS) -> str:
    return ", ".join(r(n, n, digits) for n in names)
