"""Activity segmentation of users."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from engage.functions.times import as_instant

# Upper bound in days since the last login -> label; a null bound takes the rest.
STATUS_NEVER = "❌ Never Logged In"
STATUS_TODAY = "🔥 Active Today"
STATUS_BY_DAYS = [
    (3, "✅ Active (1-3 days)"),
    (7, "👍 Active (4-7 days)"),
    (14, "⚠️ At Risk (7-14 days)"),
    (30, "😴 Dormant (14-30 days)"),
    (60, "💤 Inactive (30-60 days)"),
    (None, "☠️ Very Inactive (60+ days)"),
]
SIMPLE_NEVER = "Never Logged In"
SIMPLE_BY_DAYS = [(7, "Active"), (30, "Dormant"), (None, "Inactive")]


def _banded(days: Column, start: Column, bands: list[tuple[int | None, str]]) -> Column:
    for bound, label in bands:
        start = start.otherwise(label) if bound is None else start.when(days <= bound, label)
    return start


def activity_status(users: DataFrame, as_of: dt.date | dt.datetime | str | None = None) -> DataFrame:
    """Add the seven activity columns, computed from ``created_time`` and ``last_login_time``.

    Day counts compare UTC calendar dates. A login after ``as_of`` has a negative count and falls in the first band.
    """
    today = F.to_date(as_instant(as_of))
    created, login = F.col("created_time"), F.col("last_login_time")
    days = F.date_diff(today, F.to_date(login))
    seconds = F.timestamp_diff("SECOND", created, login)
    return users.withColumns(
        {
            "days_since_signup": F.date_diff(today, F.to_date(created)).cast("bigint"),
            "days_since_last_login": days.cast("bigint"),
            "signup_to_first_login_seconds": seconds,
            "signup_to_first_login_minutes": F.round(seconds / F.lit(60.0), 1),
            "is_same_day_activation": F.coalesce(F.to_date(created) == F.to_date(login), F.lit(False)),
            "user_activity_status": _banded(
                days, F.when(login.isNull(), STATUS_NEVER).when(days == 0, STATUS_TODAY), STATUS_BY_DAYS
            ),
            "simple_status": _banded(days, F.when(login.isNull(), SIMPLE_NEVER), SIMPLE_BY_DAYS),
        }
    )
