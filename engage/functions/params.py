"""Lookups in key/value arrays and group extraction from text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def param(key: str, slot: str = "string_value", array: str = "event_params") -> Column:
    """Value of the first entry with ``key``; null when the key is absent or the slot is empty.

    A position lookup on the array of keys, not a lambda filter: it stays inside whole-stage codegen, and the array
    of keys is a common subexpression of all lookups of a projection.
    """
    position = F.array_position(F.col(f"{array}.key"), F.lit(key)).cast("int")
    return F.get(F.col(array), position - F.lit(1))["value"][slot]


def field_at(names: Column, values: Column, name: str) -> Column:
    """Value under header ``name`` in a positional row; null when the header or the cell is missing."""
    return F.get(values, F.array_position(names, F.lit(name)).cast("int") - F.lit(1))


def first_group(text: Column, pattern: str) -> Column:
    """First capture group, null when the pattern does not match (the group must need at least one character)."""
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit(""))
