"""Lenient whole-number conversions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def or_zero(number: Column) -> Column:
    return F.coalesce(number, F.lit(0).cast("bigint"))


def text_count(text: Column) -> Column:
    """Whole number written as text; anything else is 0."""
    return or_zero(text.try_cast("bigint"))


def metric(text: Column) -> Column:
    """Report cell to a whole number: fractions are cut off, missing is 0."""
    return or_zero(text.try_cast("decimal(38,6)").cast("bigint"))


def half_up_bigint(number: Column) -> Column:
    """Double to bigint, halves away from zero (a plain cast would cut the fraction off)."""
    return F.round(number, 0).cast("bigint")
