"""Comparing a Spark result with the SQL that says the same."""

from __future__ import annotations

import glob
import os

import duckdb


def open_tables(folder: str):
    con = duckdb.connect()
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _text(value) -> str:
    if value is None or value != value:
        return "NULL"
    if isinstance(value, float):
        return f"{value:.6f}"
    return str(value)


def _rows(names: list[str], rows) -> tuple[list[str], list[tuple[str, ...]]]:
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], sorted(tuple(_text(row[i]) for i in order) for row in rows)


def differences(spark_df, con, sql: str) -> str | None:
    """What differs between the two results; None if nothing does."""
    names, ours = _rows(spark_df.columns, spark_df.collect())
    result = con.execute(sql)
    other_names, theirs = _rows([column[0] for column in result.description], result.fetchall())
    if names != other_names:
        return f"columns {names} / {other_names}"
    if len(ours) != len(theirs):
        return f"rows {len(ours)} / {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} of {len(ours)} rows differ, as {names} {wrong[0]}" if wrong else None
