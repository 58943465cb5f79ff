"""Registered queries: a Spark builder, and where plain SQL can express it, the equivalent SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]

BUILDERS: dict[str, Builder] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(build: Builder) -> Builder:
        BUILDERS[build.__name__] = build
        if sql is not None:
            ORACLES[build.__name__] = sql
        return build

    return add
