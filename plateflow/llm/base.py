"""What the operators of this folder share: registering queries, reading batches, shipping bounded files."""

from __future__ import annotations

import ctypes
import os
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from plateflow.session import ship_package

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

#: Rows that are turned into Python objects at once; a batch of very long texts stays in Arrow until its turn.
ROWS_AT_ONCE = 128
#: The largest file that is sent to all executors.
SHIPPED_BYTES = 64 << 20


def query(sql: str | None = None):
    """Register a function of (session, folder) under its name, with the SQL that says the same."""
    def register(build: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            ship_package(spark)
            return build(spark, folder)

        QUERIES[build.__name__] = run
        if sql is not None:
            ORACLES[build.__name__] = sql
        return run

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def release_memory() -> None:
    """Return what earlier tasks of this Python worker have freed: workers outlive their tasks, and keep it otherwise."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim:
        trim(0)


def slices(batches: Iterable[pa.RecordBatch], rows: int = ROWS_AT_ONCE) -> Iterator[list[list]]:
    """The columns of consecutive slices of the batches, as lists of Python values."""
    release_memory()
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield [column.to_pylist() for column in batch.slice(start, rows).columns]


def shipped(spark: SparkSession, path: str):
    """A vocabulary file as a broadcast; its size is bounded by SHIPPED_BYTES."""
    size = os.path.getsize(path)
    if size > SHIPPED_BYTES:
        raise ValueError(f"{path} has {size} bytes, more than the {SHIPPED_BYTES} that are sent to executors")
    with open(path, "rb") as file:
        return spark.sparkContext.broadcast(file.read())


def batch_of(schema: pa.Schema, *columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(values, field.type) for values, field in zip(columns, schema)], schema=schema)
