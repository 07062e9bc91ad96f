"""Daily metric reports: unpacking of landed reports and the same aggregation over raw events."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from engage.functions.counts import metric
from engage.functions.params import field_at
from engage.functions.times import as_instant

REPORT_DAYS = 365
# Report header -> output column.
DAILY_METRICS = {
    "views": "views",
    "likes": "likes",
    "comments": "comments",
    "estimatedMinutesWatched": "estimated_minutes_watched",
    "averageViewDuration": "average_view_duration_seconds",
}
BREAKDOWNS = {"playbackLocationType": "playback_location_type", "insightTrafficSourceType": "traffic_source_type"}


def report_range(as_of: dt.date | dt.datetime | str | None = None) -> tuple[Column, Column]:
    """First and last day: the year that ends yesterday."""
    end = F.date_sub(F.to_date(as_instant(as_of)), 1)
    return F.date_sub(end, REPORT_DAYS), end


def unpack_report(reports: DataFrame, metrics: dict[str, str] | None = None, breakdown: str | None = None) -> DataFrame:
    """Positional report rows to typed columns, by header name.

    Missing metrics are 0 and fractions are cut off; a missing breakdown value is the text ``None``.
    """
    cells = reports.select(F.col("columnHeaders.name").alias("names"), F.explode("rows").alias("row"))

    def cell(name: str) -> Column:
        return field_at(F.col("names"), F.col("row"), name)

    out = [cell("day").cast("date").alias("date"), cell("video").alias("video_id")]
    if breakdown is not None:
        out.append(F.coalesce(cell(breakdown), F.lit("None")).alias(BREAKDOWNS[breakdown]))
    chosen = metrics or ({"views": "views"} if breakdown else DAILY_METRICS)
    return cells.select(*out, *[metric(cell(header)).alias(name) for header, name in chosen.items()])


def daily_report(
    events: DataFrame,
    day: Column,
    dimensions: dict[str, Column],
    metrics: dict[str, Column],
    start: Column,
    end: Column,
) -> DataFrame:
    """Metrics per day and dimensions over a closed date range, sorted by them."""
    return (
        events.where(day.between(start, end))
        .groupBy(day.alias("date"), *[column.alias(name) for name, column in dimensions.items()])
        .agg(*[column.alias(name) for name, column in metrics.items()])
        .orderBy("date", *dimensions)
    )


def daily_breakdowns(
    events: DataFrame,
    day: Column,
    dimensions: dict[str, Column],
    breakdowns: dict[str, Column],
    metrics: dict[str, Column],
    start: Column,
    end: Column,
) -> DataFrame:
    """The same report once for each breakdown (columns ``breakdown`` and ``value``): one scan, one sort at the end."""
    each = F.explode(
        F.array(*[F.struct(F.lit(name).alias("breakdown"), column.alias("value")) for name, column in breakdowns.items()])
    )
    rows = events.where(day.between(start, end)).withColumn("__b", each)
    return (
        rows.groupBy(day.alias("date"), *[c.alias(n) for n, c in dimensions.items()], "__b.breakdown", "__b.value")
        .agg(*[column.alias(name) for name, column in metrics.items()])
        .orderBy("breakdown", "date", *dimensions, "value")
    )
