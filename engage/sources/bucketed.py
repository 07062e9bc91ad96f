"""Tables in buckets of a key, of which a mutation rewrites only those it touches.

The rows of a table lie in Parquet folders, one or more for each bucket; a commit record (a small JSON file, numbered) lists the folders that
make up a version. A mutation writes new folders for its buckets and then the next record. Folders are never changed, so readers
keep the version they started with, a failed attempt leaves only unused folders, and lost executors cost only their tasks.

Writers do not lock. Each names the version it started from; its record is refused if a bucket it has read, or its columns, have
changed since, and otherwise put on top of what others have committed meanwhile.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from engage.operators.diff import row_changes
from engage.operators.merge import columns_to_insert, merge, merge_update_only
from engage.sources import files
from engage.sources.tables import evolve

BUCKETS = 64
NO_KEY = -1  # rows without a key match nothing; no merge reads or rewrites them
BUCKET = "__bucket"


class Conflict(RuntimeError):
    """Another writer has changed what this mutation was made from; run it again."""


@dataclass(frozen=True)
class Version:
    """What a commit record holds: columns (DDL), and the folders of each bucket, relative to the table."""

    number: int
    schema: str
    key: str
    buckets: int
    folders: dict[int, list[str]] = field(default_factory=dict)
    note: str | None = None

    def text(self) -> str:
        return json.dumps({**self.__dict__, "folders": {str(b): f for b, f in self.folders.items()}})

    @staticmethod
    def parse(text: str) -> Version:
        record = json.loads(text)
        return Version(**{**record, "folders": {int(b): f for b, f in record["folders"].items()}})


class BucketedTable:
    """A table in the folder ``path``, in ``buckets`` buckets of ``key`` (both fixed by the first commit)."""

    def __init__(self, spark: SparkSession, path: str, key: str = "user_id", buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.buckets = spark, path.rstrip("/"), key, buckets

    # --- versions -----------------------------------------------------------------------------------------------
    def _records(self) -> list[int]:
        return [int(n[:-5]) for n in files.names(self.spark, f"{self.path}/_commits") if n.endswith(".json")]

    def _record(self, number: int) -> str:
        return f"{self.path}/_commits/{number:020d}.json"

    def versions(self) -> list[int]:
        return self._records()

    def version(self, number: int) -> Version:
        return Version.parse(files.read_text(self.spark, self._record(number)))

    def head(self) -> Version:
        """The newest version."""
        known = self._records()
        if not known:
            raise ValueError(f"no table in {self.path}")
        return self.version(known[-1])

    def exists(self) -> bool:
        return bool(self._records())

    def create(self, schema: str) -> bool:
        """Create the empty table unless it is there; true when this call made it."""
        first = Version(0, ddl_of(_empty(self.spark, schema)), self.key, self.buckets)
        return not self.exists() and files.write_new(self.spark, self._record(0), first.text())

    def note(self) -> str | None:
        return self.head().note if self.exists() else None

    # --- reading ------------------------------------------------------------------------------------------------
    def read(self, version: Version | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """The rows of a version (the newest), of all buckets or some. Columns added later are null in older folders."""
        version = version or self.head()
        wanted = version.folders if buckets is None else set(buckets)
        paths = [f"{self.path}/{f}" for b, found in sorted(version.folders.items()) if b in wanted for f in found]
        if not paths:
            return _empty(self.spark, version.schema)
        return self.spark.read.schema(version.schema).parquet(*paths)

    def count(self) -> int:
        return self.read().count()

    def bucket(self, key: Column, version: Version | None = None) -> Column:
        buckets = version.buckets if version else self.buckets
        return F.when(key.isNull(), NO_KEY).otherwise(F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int"))

    def touched(self, version: Version, keys: DataFrame) -> set[int]:
        """The buckets of the keys in the first column; no more values than there are buckets."""
        kind = next(f.dataType for f in self.read(version, []).schema.fields if f.name == version.key)
        key = F.col(keys.columns[0]).cast(kind)
        return {r[0] for r in keys.select(self.bucket(key, version).alias(BUCKET)).distinct().collect()}

    # --- committing ---------------------------------------------------------------------------------------------
    def write(self, version: Version, rows: DataFrame) -> dict[int, str]:
        """Write rows into new folders, which no version lists yet: ``bucket -> folder``.

        Rebalancing gathers each bucket in few files and splits one that is much larger than the others.
        """
        folder = f"data/{uuid.uuid4().hex}"
        keyed = rows.withColumn(BUCKET, self.bucket(F.col(version.key), version))
        keyed.hint("rebalance", F.col(BUCKET)).write.partitionBy(BUCKET).parquet(f"{self.path}/{folder}")
        made = [n for n in files.names(self.spark, f"{self.path}/{folder}") if n.startswith(f"{BUCKET}=")]
        return {int(n.split("=")[1]): f"{folder}/{n}" for n in made}

    def commit(
        self, base: Version, new: dict[int, str], replaced: Iterable[int] = (), reads: Iterable[int] | None = (),
        schema: str | None = None, note: str | None = None,
    ) -> Version:
        """Make the new folders part of the table: instead of the ``replaced`` buckets' folders, beside those of others.

        ``reads`` are the buckets that the rows were made from (null: all of them, the replaced ones always count). If another writer
        has changed one of these since ``base``, or the columns where this mutation changes them, nothing is committed.
        """
        replaced = set(replaced)
        watched = None if reads is None else replaced | set(reads)
        while True:
            head = self.head()
            seen = set(head.folders) | set(base.folders) if watched is None else watched
            changed = sorted(b for b in seen if head.folders.get(b) != base.folders.get(b))
            if changed or (schema is not None and head.schema != base.schema):
                raise Conflict(f"{self.path}: version {head.number} changed buckets {changed} of version {base.number}; run again")
            folders = {b: list(f) for b, f in head.folders.items() if b not in replaced}
            for b, folder in new.items():
                folders.setdefault(b, []).append(folder)
            made = replace(head, number=head.number + 1, folders=folders, schema=schema or head.schema, note=note)
            if files.write_new(self.spark, self._record(made.number), made.text()):
                return made

    def append(self, rows: DataFrame, base: Version | None = None, note: str | None = None) -> Version:
        """Add rows; columns are matched by name, absent ones are null. With ``base``, only if nothing has changed since."""
        start = base or self.head()
        return self.commit(start, self.write(start, self._shaped(rows, start)), reads=() if base is None else None, note=note)

    def replace(self, rows: DataFrame, base: Version, note: str | None = None) -> Version:
        """All rows anew, made from ``base``; its columns become the table's. Refused if anything has changed since."""
        every = set(base.folders)
        return self.commit(base, self.write(base, rows), every, None, ddl_of(rows), note)

    def reload(self, rows: DataFrame) -> Version:
        base = self.head()
        return self.replace(self._shaped(rows, base), base)

    def mutate(self, change: Callable[[DataFrame], DataFrame], note: str | None = None) -> Version:
        """Change any rows: reads and rewrites the whole table."""
        base = self.head()
        return self.replace(change(self.read(base)), base, note)

    def mutate_buckets(
        self, change: Callable[[DataFrame], DataFrame], buckets: Iterable[int], base: Version, note: str | None = None
    ) -> Version:
        """Change rows of some buckets only. ``change`` sees all rows of these and gives all their rows, under the same keys."""
        buckets = set(buckets)
        rows = change(self.read(base, buckets))
        schema = ddl_of(rows)
        return self.commit(base, self.write(base, rows), buckets, buckets, None if schema == base.schema else schema, note)

    def flush(self) -> Version:
        base = self.head()
        return self.commit(base, {}, set(base.folders), None)

    def merge(
        self, source: DataFrame, update: list[str] | None = None, insert: list[str] | None = None, note: str | None = None,
        action: bool = False,
    ) -> Version:
        """Upsert by the key, with the rules of ``merge``: the buckets of the source's keys are read and rewritten, no others.

        The source is read more than once: stage it. Its rows without a key match nothing and are added.
        """
        base = self.head()
        keyed = source.dropna(subset=[base.key])
        buckets = self.touched(base, keyed.select(base.key))
        target = self.read(base, buckets)
        merged = merge(target, keyed, base.key, update, insert)
        additions = columns_to_insert(source.columns, insert)
        lost = source.where(F.col(base.key).isNull())
        rows = merged.unionByName(self._shaped(lost.select(*[F.col(c) for c in additions]), base))
        return self.commit(base, self.write(base, rows), buckets, note=note)

    def merge_update_only(
        self, source: DataFrame, on: str | None = None, update: list[str] | None = None, source_unique: bool = False, note: str | None = None
    ) -> Version:
        """Update matched rows. By another column than the key (an address), a scan of the two columns finds the buckets first."""
        base = self.head()
        on = on or base.key
        wanted = source.select(on).dropna().distinct()
        if on == base.key:
            buckets = self.touched(base, wanted)
        else:
            buckets = self.touched(base, self.read(base).select(base.key, on).join(wanted, on, "left_semi").select(base.key))
        fields = [(f.name, f.dataType.simpleString()) for f in source.schema.fields]
        return self.mutate_buckets(
            lambda rows: merge_update_only(evolve(rows, fields), source, on, update, source_unique), buckets, base, note
        )

    def changes(self, older: Version, newer: Version) -> DataFrame:
        """Inserted, updated and deleted rows between two versions, see ``row_changes``. Buckets that both share are not read."""
        differ = [b for b in {*older.folders, *newer.folders} if older.folders.get(b) != newer.folders.get(b)]
        fields = [(f.name, f.dataType.simpleString()) for f in self.read(newer, []).schema.fields]
        before = evolve(self.read(older, differ), fields).select(*[name for name, _ in fields])
        return row_changes(before, self.read(newer, differ), newer.key)

    def vacuum(self, keep: int = 2) -> int:
        """Delete the records before the newest ``keep`` ones and all folders that none of these lists; returns how many went.

        Run it when no writer is at work: folders of a mutation that has not committed yet are listed by no version either.
        """
        known = self._records()
        kept, gone = known[-keep:], known[:-keep]
        listed = {f.rsplit("/", 1)[0] for n in kept for found in self.version(n).folders.values() for f in found}
        unused = [n for n in files.names(self.spark, f"{self.path}/data") if f"data/{n}" not in listed]
        for path in [*[self._record(n) for n in gone], *[f"{self.path}/data/{n}" for n in unused]]:
            files.delete(self.spark, path)
        return len(gone) + len(unused)

    def drop(self) -> None:
        files.delete(self.spark, self.path)

    def _shaped(self, rows: DataFrame, version: Version) -> DataFrame:
        known = self.read(version, []).schema.fields
        filled = evolve(rows, [(f.name, f.dataType.simpleString()) for f in known])
        return filled.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in known])


def _empty(spark: SparkSession, schema: str) -> DataFrame:
    """No rows, known to the planner as none: rows made of Python values would start Python workers to read nothing."""
    fields = StructType.fromDDL(schema).fields
    return spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in fields]).limit(0)


def ddl_of(rows: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
