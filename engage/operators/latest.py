"""High-watermark incremental loads and the latest record per key."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from engage.functions.times import as_instant, millis_ts

# Audit actions that count as a login.
LOGIN_ACTIONS = ["LoginSucceed", "LoginFlowDone"]
LOGIN_WINDOW_DAYS = 7


def watermark(table: DataFrame, column: str = "created_time") -> DataFrame:
    """One row: ``wm_seconds``, the newest instant of the table with its sub-second part dropped.

    Null for an empty table, which the loads below take as a full load.
    """
    return table.agg(F.unix_seconds(F.max(column).cast("timestamp")).alias("wm_seconds"))


def modified_since(source: DataFrame, mark: DataFrame, modified_ms: str = "modified_ms") -> DataFrame:
    """Source rows modified at or after the watermark (all rows when there is none).

    The watermark stays a scalar subquery, so the plan is lazy and needs no driver round trip.
    """
    bound = F.coalesce(mark.select(F.col("wm_seconds") * 1000).scalar(), F.lit(-(2**63)))
    return source.where(F.col(modified_ms) >= bound)


def newer_than(
    source: DataFrame, created: str, mark: Column | None, newest: int | None = None, tie: str | None = None
) -> DataFrame:
    """Rows created after the mark or without a time; optionally only the ``newest`` of them."""
    rows = source
    if mark is not None:
        rows = rows.where(F.col(created).isNull() | mark.isNull() | (F.col(created) > mark))
    if newest is None:
        return rows
    order = [F.col(created).desc_nulls_first()] + ([F.col(tie)] if tie else [])
    return rows.orderBy(*order).limit(newest)


def recent_logins(
    audits: DataFrame,
    as_of: dt.datetime | str | None = None,
    days: int = LOGIN_WINDOW_DAYS,
    actions: list[str] | None = None,
) -> DataFrame:
    """Audit records of the login actions in the last ``days`` days."""
    since_ms = F.unix_millis(as_instant(as_of)) - days * 86_400_000
    return audits.where(F.col("action").isin(actions or LOGIN_ACTIONS) & (F.col("occurred").cast("bigint") >= since_ms))


def last_login(audits: DataFrame, tie: str | None = None) -> DataFrame:
    """Latest login per user: time, country and address.

    Records without user or time are dropped. Equal times keep the smallest ``tie`` value. The buffers combine on the
    map side, so a user with very many events costs one row per task in the shuffle.
    """
    occurred = F.col("occurred").cast("bigint")
    latest = F.struct(
        occurred.alias("ms"),
        F.coalesce("geo", F.lit("")).alias("country"),
        F.coalesce("remoteAddress", F.lit("")).alias("ip"),
    )
    order = F.struct(-occurred, F.col(tie)) if tie else -occurred
    return (
        audits.where((F.col("userId") != "") & (occurred != 0))
        .groupBy(F.col("userId").alias("user_id"))
        .agg(F.min_by(latest, order).alias("latest"))
        .select(
            "user_id",
            millis_ts(F.col("latest.ms")).alias("last_login_time"),
            F.col("latest.country").alias("last_login_country"),
            F.col("latest.ip").alias("last_login_ip"),
        )
    )
