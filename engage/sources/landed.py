"""Readers and writers for landed files."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_ndjson(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Newline-delimited JSON under a declared schema; a malformed line fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


class TooManyBadRecords(RuntimeError):
    """More of the landed lines cannot be read than the load allows."""


BAD = "__bad"


def read_ndjson_marked(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All lines of newline-delimited JSON in one pass: the columns of the schema, the text of a line that does not fit it in
    ``__bad`` (null for the others), and the ``__file`` and ``__block`` (start of the task's part of the file) it was read from."""
    reader = spark.read.schema(f"{schema}, {BAD} string").option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", BAD)
    return reader.json(path).select("*", F.col("_metadata.file_path").alias("__file"), F.col("_metadata.file_block_start").alias("__block"))


def split_bad(marked: DataFrame, most: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """Good rows, and the bad lines as ``file, block, line``; an error if more than the share ``most`` of all lines is bad.

    Give the marked lines staged: they are counted first, and both parts are read from them.
    """
    lines, bad = marked.agg(F.count("*"), F.count(BAD)).first()
    if bad > most * lines:
        raise TooManyBadRecords(f"{bad} of {lines} landed lines cannot be read")
    good = marked.where(F.col(BAD).isNull()).drop(BAD, "__file", "__block")
    return good, marked.where(F.col(BAD).isNotNull()).select(F.col("__file").alias("file"), F.col("__block").alias("block"), F.col(BAD).alias("line"))


def write_ndjson(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def read_event_shards(
    spark: SparkSession, root: str, start: dt.date | None = None, end: dt.date | None = None
) -> DataFrame:
    """Date-sharded events under ``root`` as ``dt=<date>`` directories; a range reads only its own shards."""
    events = spark.read.parquet(root)
    if start is not None:
        events = events.where(F.col("dt") >= F.lit(start))
    if end is not None:
        events = events.where(F.col("dt") <= F.lit(end))
    return events


def read_named_shards(spark: SparkSession, pattern: str) -> DataFrame:
    """Flat ``events_<yyyymmdd>`` shards matched by a path pattern."""
    return spark.read.parquet(pattern)
