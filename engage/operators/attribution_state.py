"""Attribution as a state that takes in events slice by slice: new shards are read once, older ones never again.

The state of a user is one row of partial aggregates and one narrow row for each session. The former combine by user: first and last
touch by event order, sums, extremes and day sets; the latter only must be distinct, and never pass through the wide aggregation.
Combining is associative and commutative, so slices may come in any order and be combined in any
grouping; the finished state equals ``attribution_full`` over all events. Sessions are exact and are spread over tasks; the
days of a user are bounded by the calendar. A slice must be taken in once, since its events are counted.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from engage.functions.counts import half_up_bigint
from engage.functions.params import first_group
from engage.operators import attribution as A

KEY, SESSION = "user_id", "session_id"


def _at_last() -> dict[str, Column]:
    return {**A._last_click_columns(), **{name: F.col(name) for name in A.LATEST_FULL}}


def _packed(columns: dict[str, Column]) -> Column:
    return F.struct("event_timestamp", "event_id", F.struct(*[c.alias(n) for n, c in columns.items()]).alias("row"))


def _order(touch: str) -> Column:
    """The place of a touch among others; null for a row without touches (a count of sessions), which the extremes then pass over."""
    return F.when(F.col(touch).isNotNull(), F.struct(f"{touch}.event_timestamp", f"{touch}.event_id"))


def _merged() -> dict[str, Column]:
    """How the aggregates of a user combine."""
    return {
        "first": F.min_by("first", _order("first")),
        "last": F.max_by("last", _order("last")),
        "events": F.sum("events"),
        "engagement_ms": F.sum("engagement_ms"),
        "days": F.array_sort(F.array_distinct(F.flatten(F.collect_list("days")))),
        **{name: F.max(name) for name in A.PRODUCT},
    }


def users_of(state: DataFrame) -> DataFrame:
    """The aggregate rows of a state: those with a touch, so that the planner drops the session rows' part of an unwritten state."""
    return state.where(F.col("first").isNotNull())


def sessions_of(state: DataFrame) -> DataFrame:
    return state.where(F.col(SESSION).isNotNull()).select(KEY, SESSION)


def _state(users: DataFrame, sessions: DataFrame) -> DataFrame:
    aggregates = users.select(KEY, F.lit(None).cast("bigint").alias(SESSION), *_merged().keys())
    return aggregates.unionByName(sessions.distinct(), allowMissingColumns=True)


# Days are gathered as bits of a word, one word for each 64 days from the epoch. A set of days as an aggregate (``collect_set``) would
# have every event pass through an object aggregation, which sorts all its wide rows again once a task has more than a few users.
WORD = 64


def _days(word: Column, bits: Column) -> Column:
    """The days of a word, ascending."""
    there = F.filter(
        F.sequence(F.lit(0), F.lit(WORD - 1)),
        lambda i: F.call_function("shiftrightunsigned", bits, i).bitwiseAND(F.lit(1)) == 1,
    )
    return F.transform(there, lambda i: F.date_from_unix_date(word * WORD + i))


def slice_state(events: DataFrame) -> DataFrame:
    """The state of flat events (``flatten_events``): ``user_id, session_id`` and partial aggregates.

    A user has an aggregate row for each word of days with events, which combine to one; without sessions these are all. Rows
    without a session add to the aggregates only.
    """
    day = F.unix_date(F.to_date(F.timestamp_micros("event_timestamp")))
    order = F.struct("event_timestamp", "event_id")
    bit = F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(day, F.lit(WORD)))
    words = events.groupBy(KEY, F.floor(day / WORD).cast("int").alias("word")).agg(
        F.min_by(_packed(A._first_touch_columns()), order).alias("first"),
        F.max_by(_packed(_at_last()), order).alias("last"),
        F.count("*").alias("events"),
        F.sum(F.coalesce("engagement_time_msec", F.lit(0))).alias("engagement_ms"),
        F.bit_or(bit).alias("bits"),
        *[F.max(name).alias(name) for name in A.PRODUCT],
    )
    return _state(words.withColumn("days", _days(F.col("word"), F.col("bits"))), sessions_of(events))


def combine(*states: DataFrame) -> DataFrame:
    """One state of several, given in any order."""
    rows = reduce(DataFrame.unionByName, states)
    return _state(users_of(rows).groupBy(KEY).agg(*[c.alias(n) for n, c in _merged().items()]), sessions_of(rows))


def finish(state: DataFrame) -> DataFrame:
    """The columns of ``attribution_full`` of a combined state, one row per user."""
    counts = sessions_of(state).groupBy(KEY).agg(F.count("*").alias("total_sessions"))
    counted = users_of(state).drop(SESSION).unionByName(counts, allowMissingColumns=True)
    columns = [c.alias(n) for n, c in _merged().items()]
    users = counted.groupBy(KEY).agg(*columns, F.coalesce(F.sum("total_sessions"), F.lit(0)).alias("total_sessions"))
    seconds = half_up_bigint(F.col("engagement_ms") / 1000)
    return (
        users.withColumns(
            {
                "activation_date": F.timestamp_micros("first.event_timestamp"),
                "last_activity_timestamp": F.timestamp_micros("last.event_timestamp"),
                "is_activated": F.lit(True),
                "total_events": F.col("events"),
                "total_engagement_time_sec": seconds,
                "avg_session_duration_sec": F.try_divide(seconds, F.col("total_sessions")),
                "days_active": F.size("days").cast("bigint"),
                "product_os_version": first_group(F.col("product_apps_json"), A.OS_VERSION_PATTERN),
                "product_platform": first_group(F.col("product_apps_json"), A.PLATFORM_PATTERN),
            }
        )
        .select(
            KEY,
            "first.row.*",
            *[f"last.row.{name}" for name in A._last_click_columns()],
            "activation_date",
            "last_activity_timestamp",
            "is_activated",
            "total_sessions",
            "total_events",
            "total_engagement_time_sec",
            "avg_session_duration_sec",
            "days_active",
            *A.PRODUCT,
            "product_os_version",
            "product_platform",
            *[f"last.row.{name}" for name in A.LATEST_FULL],
        )
    )
