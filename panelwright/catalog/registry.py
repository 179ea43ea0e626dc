"""Named queries and the independent SQL that checks each of them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DoubleType

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Case:
    key: str
    query: Query
    sql: str | None


CASES: dict[str, Case] = {}


def case(key: str, sql: str | None = None):
    """Register a query under its inventory key; without SQL it is rows-only."""

    def register(query: Query) -> Query:
        if key in CASES:
            raise ValueError(f"duplicate query {key}")
        CASES[key] = Case(key, query, sql)
        return query

    return register


def r6(df: DataFrame) -> DataFrame:
    """Round every double to 6 places: engines sum in different orders. The
    nudge keeps exact decimal halves from rounding differently."""
    fixes = {
        f.name: F.round(F.col(f.name) + F.lit(1e-9), 6) + F.lit(0.0) for f in df.schema.fields if isinstance(f.dataType, DoubleType)
    }
    return df.withColumns(fixes) if fixes else df
