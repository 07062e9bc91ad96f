"""MERGE and UPDATE as pure ``DataFrame -> DataFrame`` functions.

Rules: a matched row takes the source value even when that is null; a null key never matches; columns outside the
update list keep the target's value; two source rows matching one target row are an error.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from engage.operators.spread import null_salt

ACTION = "_action"


def as_list(names: str | list[str]) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def columns_to_update(available: list[str], keys: list[str], update: list[str] | None) -> list[str]:
    return [c for c in available if c not in keys] if update is None else list(update)


def columns_to_insert(available: list[str], insert: list[str] | None) -> list[str]:
    return list(available) if insert is None else list(insert)


def _known(target: DataFrame, source: DataFrame, *lists: list[str]) -> None:
    """Every named column must be in both tables; a merge never drops one silently."""
    for names in lists:
        for what, columns in (("target", target.columns), ("source", source.columns)):
            missing = [name for name in names if name not in columns]
            if missing:
                raise ValueError(f"MERGE: no column {', '.join(missing)} in the {what}; add it first (evolve)")


def _prefixed(source: DataFrame, keys: list[str], unique: bool) -> DataFrame:
    """Source columns renamed for the join, with a presence flag, a null-key salt and a repeated-key flag.

    Repeated keys are counted over the partitioning that the join needs anyway, so the source moves once.
    """
    rows = source.withColumn("__salt", null_salt(keys))
    several = F.lit(False) if unique else F.count("*").over(W.partitionBy(*keys, "__salt")) > 1
    return rows.withColumn("__repeated", several).select(
        *[F.col(c).alias(f"__s_{c}") for c in source.columns],
        F.lit(True).alias("__s"),
        F.col("__salt").alias("__s_salt"),
        "__repeated",
    )


def _same_key(keys: list[str]) -> Column:
    condition = F.col("__t_salt") == F.col("__s_salt")
    for key in keys:
        condition &= F.col(key) == F.col(f"__s_{key}")
    return condition


def _one_source_row(joined: DataFrame) -> DataFrame:
    """Fail where several source rows match a target row. A filter, so that no choice of columns can prune the check."""
    error = F.raise_error(F.lit("MERGE: several source rows match one target row")).cast("boolean")
    wrong = F.coalesce(F.col("__repeated"), F.lit(False)) & F.col("__t").isNotNull() & F.col("__s").isNotNull()
    return joined.where(F.when(wrong, error).otherwise(True))


def merge_update_only(
    target: DataFrame,
    source: DataFrame,
    on: str | list[str],
    update: list[str] | None = None,
    source_unique: bool = False,
    action: bool = False,
) -> DataFrame:
    """Update matched target rows, ignore unmatched source rows; the row count never changes.

    One left join: a small source is broadcast; else both sides are shuffled once, and with ``source_unique`` the adaptive
    planner splits the target's rows of a hot key (an address that many users share).
    """
    keys = as_list(on)
    changes = columns_to_update(source.columns, keys, update)
    _known(target, source, keys, changes)
    left = target.withColumns({"__t": F.lit(True), "__t_salt": null_salt(keys)})
    joined = left.join(_prefixed(source.dropna(subset=keys), keys, source_unique), _same_key(keys), "left")
    if not source_unique:
        joined = _one_source_row(joined)
    matched = F.col("__s").isNotNull()
    out = [
        (F.when(matched, F.col(f"__s_{name}")).otherwise(F.col(name)) if name in changes else F.col(name)).alias(name)
        for name in target.columns
    ]
    if action:
        out.append(F.when(matched, "update").otherwise("keep").alias(ACTION))
    return joined.select(*out)


def merge(
    target: DataFrame,
    source: DataFrame,
    on: str | list[str],
    update: list[str] | None = None,
    insert: list[str] | None = None,
    source_unique: bool = False,
    small_source: bool = False,
    action: bool = False,
) -> DataFrame:
    """Upsert ``source`` into ``target``; ``action=True`` adds what happened to each row.

    The default is one full outer join, for targets with one row per key: both sides are shuffled once. ``small_source``
    suits an increment, and targets in which many rows share a key: the target is left-joined and unmatched source
    rows are appended. Below the broadcast threshold the target is then not shuffled at all.
    """
    keys = as_list(on)
    changes = columns_to_update(source.columns, keys, update)
    additions = columns_to_insert(source.columns, insert)
    _known(target, source, keys, changes, additions)
    if small_source:
        updated = merge_update_only(target, source, keys, changes, source_unique, action)
        # Combined on the map side, so that a hot key is one row per task before the join.
        known = target.select(*keys).distinct().join(source.select(*keys), keys, "left_semi").distinct()
        fresh = source.join(known, keys, "left_anti")
        out = [
            (F.col(f.name) if f.name in additions else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in target.schema.fields
        ]
        return updated.unionByName(fresh.select(*out, *([F.lit("insert").alias(ACTION)] if action else [])))

    left = target.withColumns({"__t": F.lit(True), "__t_salt": null_salt(keys)})
    joined = left.join(_prefixed(source, keys, source_unique), _same_key(keys), "full_outer")
    if not source_unique:
        joined = _one_source_row(joined)
    in_target, in_source = F.col("__t").isNotNull(), F.col("__s").isNotNull()
    out = []
    for name in target.columns:
        kept = F.col(name)
        added = F.col(f"__s_{name}") if name in additions else F.lit(None)
        changed = F.col(f"__s_{name}") if name in changes else kept
        value = F.when(in_target & in_source, changed).when(in_source, added).otherwise(kept)
        out.append(value.alias(name))
    if action:
        out.append(F.when(in_target & in_source, "update").when(in_source, "insert").otherwise("keep").alias(ACTION))
    return joined.select(*out)


def newest_per_key(source: DataFrame, on: str | list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``; rows with a null key are all kept, since they match nothing."""
    keys = as_list(on)
    window = W.partitionBy(*keys).orderBy(*order)
    chosen = source.dropna(subset=keys).withColumn("__rn", F.row_number().over(window)).where(F.col("__rn") == 1)
    incomplete = F.lit(False)
    for key in keys:
        incomplete |= F.col(key).isNull()
    return chosen.drop("__rn").unionByName(source.where(incomplete))


def merge_counts(merged: DataFrame) -> DataFrame:
    """One row: inserted, updated and kept rows, and the affected total, of a merge run with ``action=True``."""
    inserted, updated = F.count_if(F.col(ACTION) == "insert"), F.count_if(F.col(ACTION) == "update")
    return merged.agg(
        inserted.alias("inserted"),
        updated.alias("updated"),
        F.count_if(F.col(ACTION) == "keep").alias("kept"),
        (inserted + updated).alias("affected"),
    )
