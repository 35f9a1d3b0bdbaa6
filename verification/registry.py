"""Name -> (query, oracle SQL). Each report module adds its entries here."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketlens.sources.market import Market, from_star_schema

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, fn: Callable[[Market], DataFrame], oracle: str | None = None) -> None:
    """Register a query over the marketplace roles derived from the given tables."""
    QUERIES[name] = lambda spark, base: fn(from_star_schema(spark, base))
    if oracle is not None:
        ORACLES[name] = oracle
