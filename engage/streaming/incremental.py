"""The incremental load as a stream: new landed files are merged once, then the query stops."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from engage.operators.merge import merge, newest_per_key
from engage.plans.steps import stage, staging
from engage.sources.tables import SnapshotTable


def landed_stream(spark: SparkSession, path: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """Newline-delimited JSON files as a stream; each file is read once per checkpoint."""
    reader = spark.readStream.schema(schema).option("mode", "FAILFAST")
    if files_per_batch is not None:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def merge_stream(
    rows: DataFrame,
    table: SnapshotTable,
    key: str,
    newest: Callable[[], list[Column]],
    checkpoint: str,
) -> StreamingQuery:
    """Upsert everything that has landed and stop (``availableNow``).

    The checkpoint takes the place of the watermark query. Each snapshot notes the batch it was written by, and a batch that
    is replayed after a failure is skipped if the table has it already (rows with a null key would be added again). Within a
    batch the first row per key in the ``newest`` order wins.
    """
    source = hashlib.sha256(checkpoint.encode()).hexdigest()[:16]

    def apply(batch: DataFrame, number: int) -> None:
        note = f"{source}:{number}"
        if table.note() == note:
            return
        with staging():
            staged = stage(newest_per_key(batch, key, newest()), "batch")
            table.mutate(lambda target: merge(target, staged, key, source_unique=True, small_source=True), note)

    writer = rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    return writer.foreachBatch(apply).start()
