"""Mutable tables for a catalog without row-level DML, and plain append or overwrite sinks.

A snapshot table is a view over the newest of a series of immutable parquet tables. Each mutation writes the next
table and then repoints the view, so readers never see a half-written state and a lost executor costs only its tasks.
Where the catalog has row-level operations, use ``merge_row_level`` and skip snapshots.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from engage.operators.merge import as_list, columns_to_insert, columns_to_update


class SnapshotTable:
    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.name = name

    def versions(self) -> list[str]:
        """Names of the stored snapshots (with the table's own qualifier), oldest first."""
        scope, _, own = self.name.rpartition(".")
        place = f" IN {scope}" if scope else ""
        found = self.spark.sql(f"SHOW TABLES{place} LIKE '{own}__v*'").select("tableName").collect()
        # The pattern's other matches belong to tables whose own names go on like a snapshot's.
        mine = [r.tableName for r in found if re.fullmatch(rf"{re.escape(own.lower())}__v\d+_[0-9a-f]{{8}}", r.tableName.lower())]
        return sorted((f"{scope}.{name}" if scope else name for name in mine), key=self._number)

    @staticmethod
    def _number(snapshot: str) -> int:
        return int(snapshot.rsplit("__v", 1)[1].split("_")[0])

    def exists(self) -> bool:
        return self.spark.catalog.tableExists(self.name)

    def create(self, schema: str) -> bool:
        """Create the empty table unless it is there; true when this call made it."""
        if self.exists():
            return False
        self.replace(self.spark.createDataFrame([], schema))
        return True

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def count(self) -> int:
        return self.read().count()

    def current(self) -> str | None:
        """The snapshot the view shows; the view's comment names it."""
        state = self.state()
        return state and state.split(" ")[0]

    def state(self) -> str | None:
        """The view's comment: the snapshot it shows and, after an append to it, a mark. It changes with every change of the rows."""
        return self.spark.catalog.getTable(self.name).description if self.exists() else None

    def _show(self, snapshot: str, mark: str = "") -> None:
        self.spark.sql(f"CREATE OR REPLACE VIEW {self.name} COMMENT '{snapshot}{mark}' AS SELECT * FROM {snapshot}")

    def replace(self, rows: DataFrame, note: str | None = None, base: str | None = None) -> str:
        """Write the next snapshot, point the view at it, and drop all but it and the one shown before.

        An attempt that dies before the view moves leaves only an unused snapshot, which the next one drops; the random
        suffix keeps its files out of the way. ``base`` is the ``state`` the rows were made from (by default that of now): where
        another writer has moved the view or appended since, this one fails and changes nothing. The check and the move of the view
        are two steps of the catalog: writers that meet in that moment are not told apart; ``BucketedTable`` commits in one.
        ``note`` is kept with the snapshot.
        """
        shown, known = self.current() if base is None else base.split(" ")[0], self.versions()
        state = self.state() if base is None else base
        number = self._number(known[-1]) + 1 if known else 0
        snapshot = f"{self.name}__v{number}_{uuid.uuid4().hex[:8]}"
        rows.write.format("parquet").saveAsTable(snapshot)
        if note is not None:
            self.spark.sql(f"ALTER TABLE {snapshot} SET TBLPROPERTIES ('note' = '{note}')")
        if self.current() != shown or self.state() != state:
            self.spark.sql(f"DROP TABLE IF EXISTS {snapshot}")
            raise RuntimeError(f"{self.name} was changed by another writer; run again")
        self._show(snapshot)
        for old in known:
            if old != shown:
                self.spark.sql(f"DROP TABLE IF EXISTS {old}")
        return snapshot

    def append(self, rows: DataFrame) -> None:
        """Add rows to the current snapshot without rewriting it; columns are matched by name, absent ones are null."""
        known = self.read()
        filled = evolve(rows, [(f.name, f.dataType.simpleString()) for f in known.schema.fields])
        current = self.current()
        filled.select(*known.columns).write.insertInto(current)
        if self.current() != current:
            raise RuntimeError(f"{self.name} was changed by another writer; run again")
        self._show(current, f" {uuid.uuid4().hex[:8]}")
        self.spark.catalog.refreshTable(self.name)

    def mutate(self, change: Callable[[DataFrame], DataFrame], note: str | None = None) -> str:
        base = self.state()
        return self.replace(change(self.read()), note, base)

    def note(self) -> str | None:
        """What the shown snapshot was written with."""
        shown = self.current()
        if shown is None:
            return None
        found = self.spark.sql(f"SHOW TBLPROPERTIES {shown}").where("key = 'note'").select("value").first()
        return found and found[0]

    def reload(self, rows: DataFrame) -> str:
        """All rows anew, columns matched by name and absent ones null; the old rows are shown until these are written."""
        base, known = self.state(), self.read()
        filled = evolve(rows, [(f.name, f.dataType.simpleString()) for f in known.schema.fields])
        return self.replace(filled.select(*[F.col(f.name).cast(f.dataType) for f in known.schema.fields]), base=base)

    def flush(self) -> str:
        """Delete every row, keep the columns."""
        return self.mutate(lambda rows: rows.limit(0))

    def drop(self) -> None:
        self.spark.sql(f"DROP VIEW IF EXISTS {self.name}")
        for snapshot in self.versions():
            self.spark.sql(f"DROP TABLE IF EXISTS {snapshot}")


def append(rows: DataFrame, table: str) -> None:
    """Append without de-duplication; columns are matched by name."""
    if rows.sparkSession.catalog.tableExists(table):
        rows.select(*rows.sparkSession.table(table).columns).write.insertInto(table)
    else:
        rows.write.format("parquet").saveAsTable(table)


def overwrite(rows: DataFrame, table: str) -> None:
    rows.write.mode("overwrite").format("parquet").saveAsTable(table)


def replace_days(rows: DataFrame, path: str, day: str = "date") -> None:
    """Overwrite only the days present in ``rows``: a re-run replaces its days instead of doubling them.

    Rebalancing gathers each day in few files and splits a day that is much larger than the others.
    """
    writer = rows.hint("rebalance", F.col(day)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy(day).parquet(path)


def replace_table_days(rows: DataFrame, table: str, day: str = "date") -> None:
    """The same for a catalog table partitioned by day, which is made by the first load."""
    spark = rows.sparkSession
    rows = rows.hint("rebalance", F.col(day))
    if not spark.catalog.tableExists(table):
        rows.write.format("parquet").partitionBy(day).saveAsTable(table)
        return
    ordered = rows.select(*spark.table(table).columns)
    ordered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").insertInto(table)


def evolve(df: DataFrame, fields: list[tuple[str, str]]) -> DataFrame:
    """Add the columns of ``fields`` that ``df`` lacks, as nulls; existing columns stay as they are."""
    present = set(df.columns)
    missing = {name: F.lit(None).cast(kind) for name, kind in fields if name not in present}
    return df.withColumns(missing) if missing else df


def merge_row_level(
    source: DataFrame, table: str, on: str | list[str], update: list[str] | None = None, insert: list[str] | None = None
) -> None:
    """The upsert or update-only merge as one statement on a catalog table with row-level operations.

    An empty ``insert`` list gives the update-only form.
    """
    keys = as_list(on)
    changes = columns_to_update(source.columns, keys, update)
    additions = columns_to_insert(source.columns, insert)
    condition = F.lit(True)
    for key in keys:
        condition &= F.col(f"{table}.{key}") == F.col(f"source.{key}")
    writer = source.alias("source").mergeInto(table, condition)
    writer = writer.whenMatched().update({name: F.col(f"source.{name}") for name in changes})
    if additions:
        writer = writer.whenNotMatched().insert({name: F.col(f"source.{name}") for name in additions})
    writer.merge()
