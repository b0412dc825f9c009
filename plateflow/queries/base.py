"""Registering a query together with the SQL that says the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from plateflow.fixtures import Tables, with_ctes
from plateflow.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None, *ctes: str):
    """Register a function of `Tables` under its name; `sql` follows the named derivations."""
    def register(build: Callable[[Tables], DataFrame]):
        name = build.__name__.rstrip("_")

        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship_package(spark)
            return build(Tables(spark, folder))

        QUERIES[name] = run
        if sql is not None:
            head = with_ctes(*ctes) if ctes else ""
            text = sql.strip()
            if head and text.upper().startswith("WITH "):
                head, text = head.rstrip() + ",\n", text[5:]
            ORACLES[name] = head + text
        return build

    return register
