"""Instant conversions; all of them are UTC."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Epoch milliseconds of 0001-01-01T00:00:00Z and 9999-12-31T23:59:59.999Z.
MIN_MS = -62135596800000
MAX_MS = 253402300799999


def iso_ts(text: Column) -> Column:
    """ISO-8601 text (``Z`` or offset allowed) to an instant; null when it is not one."""
    # The engine's own cast also takes a bare year, month or time of day, which are not full timestamps.
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), F.try_to_timestamp(text))


def seconds_ts(seconds: Column) -> Column:
    """Epoch seconds; 0 and null both mean missing."""
    return F.timestamp_seconds(F.nullif(seconds, F.lit(0)))


def millis_ts(millis: Column, zero_is_missing: bool = False) -> Column:
    """Epoch milliseconds; null when outside the calendar range."""
    value = F.nullif(millis, F.lit(0)) if zero_is_missing else millis
    return F.when(value.between(MIN_MS, MAX_MS), F.timestamp_millis(value))


def iso_text(instant: Column) -> Column:
    return F.date_format(instant, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")


def as_instant(as_of: dt.datetime | dt.date | str | Column | None) -> Column:
    """The run's reference time as a column; ``None`` is now."""
    if as_of is None:
        return F.current_timestamp()
    return (as_of if isinstance(as_of, Column) else F.lit(as_of)).cast("timestamp")


def zone_free(df: DataFrame) -> DataFrame:
    """Every instant column as wall-clock UTC without zone."""
    casts = {f.name: F.col(f.name).cast("timestamp_ntz") for f in df.schema.fields if f.dataType == T.TimestampType()}
    return df.withColumns(casts) if casts else df
