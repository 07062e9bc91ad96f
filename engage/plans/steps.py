"""Shared parts of the jobs: staging, merging into a table, and isolation of optional steps."""

from __future__ import annotations

import contextlib
import logging
from contextvars import ContextVar
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from engage.operators.merge import merge, merge_update_only
from engage.session import scratch_dir
from engage.sources import files
from engage.sources.bucketed import BucketedTable
from engage.sources.landed import read_ndjson_marked, split_bad
from engage.sources.tables import SnapshotTable, evolve

Table = SnapshotTable | BucketedTable

log = logging.getLogger("engage")


# Of the running job: jobs in other threads of the driver have their own.
_staged: ContextVar[list[tuple[SparkSession, str]] | None] = ContextVar("staged", default=None)


@contextlib.contextmanager
def staging() -> Iterator[None]:
    """Delete the staged copies that were made inside, when it ends. Nested blocks belong to the outermost one."""
    if _staged.get() is not None:
        yield
        return
    made: list[tuple[SparkSession, str]] = []
    outer = _staged.set(made)
    try:
        yield
    finally:
        _staged.reset(outer)
        for spark, path in made:
            files.delete(spark, path)


def stage(rows: DataFrame, name: str) -> DataFrame:
    """Write the rows to the shared scratch folder and read them back.

    The rows are used several times (count, duplicate check, join); the written copy also gives the planner exact
    sizes and survives the loss of executors. Inside ``staging`` it lasts until the block ends.
    """
    spark = rows.sparkSession
    path = scratch_dir(spark, name)
    made = _staged.get()
    if made is not None:
        made.append((spark, path))
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def staged_source(rows: DataFrame, name: str) -> tuple[DataFrame, int]:
    staged = stage(rows, name)
    return staged, staged.count()


def landed_rows(spark: SparkSession, path: str, schema: str, dead_letters: str, most: float) -> DataFrame:
    """Good rows of a landed folder; its bad lines are appended to the Parquet folder ``dead_letters``. See ``split_bad``."""
    good, bad = split_bad(stage(read_ndjson_marked(spark, path, schema), "landed"), most)
    bad.withColumn("path", F.lit(path)).write.mode("append").parquet(dead_letters)
    return good


def upserted(target: DataFrame, staged: DataFrame, rows: int, key: str) -> DataFrame:
    """``target`` after an upsert of a staged source, whose exact size tells the planner whether to shuffle the target."""
    return merge(target, staged, key, small_source=True) if rows else target


def updated(target: DataFrame, staged: DataFrame, key: str) -> DataFrame:
    """``target`` after an update-only merge of a staged source with unique keys; columns it lacks are added."""
    fields = [(f.name, f.dataType.simpleString()) for f in staged.schema.fields]
    return merge_update_only(evolve(target, fields), staged, key, source_unique=True)


def upsert(table: Table, source: DataFrame, key: str) -> int:
    """Stage and upsert; returns the number of source rows. An empty source leaves the table as it is.

    A table in buckets of the key has only the buckets of the source's keys rewritten.
    """
    with staging():
        staged, rows = staged_source(source, "upsert")
        if rows and isinstance(table, BucketedTable) and table.key == key:
            table.merge(staged)
        elif rows:
            table.mutate(lambda target: upserted(target, staged, rows, key))
        return rows


def update(table: Table, source: DataFrame, key: str) -> int:
    """Stage and apply an update-only merge; returns the number of source rows."""
    with staging():
        staged, rows = staged_source(source, "update")
        if rows and isinstance(table, BucketedTable):
            table.merge_update_only(staged, key, source_unique=True)
        elif rows:
            table.mutate(lambda target: updated(target, staged, key))
        return rows


def optional(step: Callable[[], int], name: str, errors: dict[str, str]) -> int:
    """Rows handled by a step that must not stop the job; on failure 0, with the reason kept in ``errors``."""
    try:
        return step()
    except Exception as error:  # the job goes on, whatever the step raised
        log.warning("step %s failed: %s", name, error)
        errors[name] = str(error)
        return 0


def required(rows: DataFrame, column: str) -> DataFrame:
    """Fail when a required column is null."""
    value = F.when(F.col(column).isNull(), F.raise_error(F.lit(f"{column} is required"))).otherwise(F.col(column))
    return rows.withColumn(column, value)
