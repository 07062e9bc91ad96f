"""Difference of two versions of a table as a feed of inserted, updated and deleted rows, and its application."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

CHANGE, BEFORE, AFTER = "_change", "before", "after"


def _row_hash(columns: list[str]) -> list[Column]:
    """Two hashes of the whole row, 96 bits; null and absent differ from any value by the struct's own null marks."""
    marks = F.concat_ws("", *[F.col(c).isNull().cast("string") for c in columns])
    return [F.xxhash64(*columns, marks).alias("__h"), F.hash(marks, *reversed(columns)).alias("__g")]


def row_changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """``key, _change, before, after`` for each row that differs between two versions with the same columns.

    ``_change`` is ``insert``, ``update`` or ``delete``; ``before`` and ``after`` are the whole rows, null where there is none. Rows
    are compared as multisets: equal rows cancel out, whatever their number. What is left of one key is paired in the order of
    its rows, so that repeated keys give updates as far as they go; rows without a key are never updates.

    Only keys and hashes of all rows move, and they are summed before the shuffle; whole rows move only where something
    has changed. No group is gathered in one place but the changed rows of one key.
    """
    columns = after.columns
    before = before.select(*columns)
    sides = [rows.select(F.col(key).alias("__key"), *_row_hash(columns), F.lit(n).alias("__n")) for rows, n in ((before, -1), (after, 1))]
    counts = sides[0].union(sides[1]).groupBy("__key", "__h", "__g").agg(F.sum("__n").alias("__n")).where("__n <> 0")

    def changed(rows: DataFrame, sign: int, name: str) -> DataFrame:
        wanted = counts.where(F.col("__n") * sign > 0).select("__key", "__h", "__g", F.abs("__n").alias("__many"))
        held = rows.select(F.col(key).alias("__k"), *[h.alias(f"{n}2") for h, n in zip(_row_hash(columns), ("__h", "__g"))], F.struct(*columns).alias(name))
        same = F.col("__k").eqNullSafe(F.col("__key")) & (F.col("__h") == F.col("__h2")) & (F.col("__g") == F.col("__g2"))
        copy = F.row_number().over(W.partitionBy("__h", "__g", "__key").orderBy(F.lit(0)))
        found = held.join(wanted, same).withColumn("__copy", copy).where("__copy <= __many")
        # Rows without a key are dealt by their hash: they pair with nothing, and must not gather in one task.
        lone = F.when(F.col("__key").isNull(), F.struct(F.lit(sign).alias("side"), F.col("__h").alias("h"), F.col("__copy").alias("n")))
        place = F.row_number().over(W.partitionBy("__key", lone).orderBy("__h", "__g", "__copy"))
        return found.select(F.col("__key").alias(f"{name}_key"), place.alias(f"{name}_place"), lone.alias(f"{name}_lone"), name)

    old, new = changed(before, -1, BEFORE), changed(after, 1, AFTER)
    same = (F.col(f"{BEFORE}_key") == F.col(f"{AFTER}_key")) & (F.col(f"{BEFORE}_place") == F.col(f"{AFTER}_place"))
    joined = old.join(new, same, "full_outer")
    kind = F.when(F.col(BEFORE).isNull(), "insert").when(F.col(AFTER).isNull(), "delete").otherwise("update")
    return joined.select(F.coalesce(f"{BEFORE}_key", f"{AFTER}_key").alias(key), kind.alias(CHANGE), BEFORE, AFTER)


def apply_changes(rows: DataFrame, changes: DataFrame) -> DataFrame:
    """The newer version: ``rows`` without the rows that were updated or deleted, with the new ones. Repeated rows are counted."""
    gone = changes.where(F.col(BEFORE).isNotNull()).select(f"{BEFORE}.*")
    come = changes.where(F.col(AFTER).isNotNull()).select(f"{AFTER}.*")
    return rows.select(*come.columns).exceptAll(gone.select(*come.columns)).unionByName(come)


def change_counts(changes: DataFrame) -> DataFrame:
    """One row: inserted, updated and deleted rows, and their sum."""
    count = {name: F.count_if(F.col(CHANGE) == kind) for name, kind in (("inserted", "insert"), ("updated", "update"), ("deleted", "delete"))}
    return changes.agg(*[c.alias(n) for n, c in count.items()], F.count("*").alias("affected"))
