"""Reading keys of a JSON text column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def has_key(document: Column, key: str) -> Column:
    """Is `key` present, whatever its value (JSON null and false count as present)?"""
    return F.coalesce(F.array_contains(F.json_object_keys(document), key), F.lit(False))


def json_text(document: Column, key: str) -> Column:
    """Value of `key` as text; NULL when absent or JSON null."""
    return F.get_json_object(document, f"$.{key}")


def json_flag(document: Column, key: str) -> Column:
    """Is `key` the JSON value true?"""
    return F.coalesce(json_text(document, key) == "true", F.lit(False))
