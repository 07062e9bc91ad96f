"""Registered queries: daily reports over events and unpacking of landed reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from engage.operators.reports import DAILY_METRICS, daily_breakdowns, daily_report, report_range, unpack_report
from engage.queries.inputs import AS_OF, table


def watched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as video activity: the video is the ``k`` property, the watched time comes from ``value``."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return table(spark, sf_dir, "events").select(
        F.to_date("ts").alias("day"),
        F.concat(F.lit("v"), k.cast("string")).alias("video"),
        "event_type",
        F.round(F.col("value") * 1000).cast("bigint").alias("watch_ms"),
        F.when(k % 5 != 0, F.col("event_type")).alias("location"),
        F.when(k % 7 != 0, F.concat(F.lit("t"), (k % 4).cast("string"))).alias("traffic"),
    )


def _count(kind: str) -> Column:
    return F.count_if(F.col("event_type") == kind)


def _metrics() -> dict[str, Column]:
    return {
        "views": _count("view"),
        "likes": _count("click"),
        "comments": _count("signup"),
        "estimated_minutes_watched": F.floor(F.sum("watch_ms") / 60000),
        "average_view_duration_seconds": F.floor(F.sum("watch_ms") / (F.count("*") * 1000)),
    }


def _text_dates(df: DataFrame) -> DataFrame:
    return df.withColumn("date", F.date_format("date", "yyyy-MM-dd"))


def daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = report_range(AS_OF)
    return daily_report(watched(spark, sf_dir), F.col("day"), {"video_id": F.col("video")}, _metrics(), start, end)


def daily_by_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Views per day and video by playback location, and by traffic source."""
    start, end = report_range(AS_OF)
    breakdowns = {name: F.coalesce(name, F.lit("None")) for name in ("location", "traffic")}
    views = {"views": _count("view")}
    report = daily_breakdowns(
        watched(spark, sf_dir), F.col("day"), {"video_id": F.col("video")}, breakdowns, views, start, end
    )
    return _text_dates(report)


def landed_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One report response per event: headers out of order, a row lacking metrics, fractions, missing dimensions."""
    e = F.col("event_id")
    k = F.get_json_object("props", "$.k").cast("bigint")
    headers = ["views", "day", "video", "playbackLocationType", "likes", "averageViewDuration"]
    names = F.array(*[F.struct(F.lit(h).alias("name")) for h in headers])
    day = F.date_format("ts", "yyyy-MM-dd")
    video = F.concat(F.lit("v"), e.cast("string"))
    place = F.when(k % 5 != 0, F.col("event_type"))
    full = F.array(k.cast("string"), day, video, place, (k % 7).cast("string"), F.col("value").cast("string"))
    short = F.array((k + 1).cast("string"), day, video)
    return table(spark, sf_dir, "events").select(
        names.alias("columnHeaders"), F.when(e % 10 == 0, F.array(full, short)).otherwise(F.array(full)).alias("rows")
    )


def report_unpack(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = unpack_report(landed_reports(spark, sf_dir), metrics=DAILY_METRICS, breakdown="playbackLocationType")
    return _text_dates(rows)


WATCHED_SQL = """
w AS (
  SELECT strftime(ts, '%Y-%m-%d') AS date, 'v' || k AS video_id, event_type,
    CAST(round(value * 1000) AS BIGINT) AS watch_ms, CASE WHEN k % 5 <> 0 THEN event_type ELSE 'None' END AS location,
    CASE WHEN k % 7 <> 0 THEN 't' || (k % 4) ELSE 'None' END AS traffic
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
  WHERE CAST(ts AS DATE) BETWEEN DATE '2023-02-14' AND DATE '2024-02-14'
)"""

QUERIES = {
    "daily_report": (
        lambda spark, sf: _text_dates(daily(spark, sf)),
        f"""
WITH {WATCHED_SQL}
SELECT date, video_id, count(*) FILTER (event_type = 'view') AS views,
  count(*) FILTER (event_type = 'click') AS likes, count(*) FILTER (event_type = 'signup') AS comments,
  CAST(sum(watch_ms) // 60000 AS BIGINT) AS estimated_minutes_watched,
  CAST(sum(watch_ms) // (count(*) * 1000) AS BIGINT) AS average_view_duration_seconds
FROM w GROUP BY 1, 2""",
    ),
    "daily_report_by_dim": (
        daily_by_dimension,
        f"""
WITH {WATCHED_SQL}
SELECT date, video_id, location AS value, count(*) FILTER (event_type = 'view') AS views, 'location' AS breakdown
FROM w GROUP BY 1, 2, 3
UNION ALL
SELECT date, video_id, traffic, count(*) FILTER (event_type = 'view'), 'traffic' FROM w GROUP BY 1, 2, 3""",
    ),
    "report_unpack": (
        report_unpack,
        """
WITH r AS (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k, strftime(ts, '%Y-%m-%d') AS date FROM events)
SELECT date, 'v' || event_id AS video_id,
  CASE WHEN k % 5 <> 0 THEN event_type ELSE 'None' END AS playback_location_type,
  k AS views, k % 7 AS likes, CAST(0 AS BIGINT) AS comments, CAST(0 AS BIGINT) AS estimated_minutes_watched,
  CAST(trunc(value) AS BIGINT) AS average_view_duration_seconds
FROM r
UNION ALL
SELECT date, 'v' || event_id, 'None', k + 1, 0, 0, 0, 0 FROM r WHERE event_id % 10 = 0""",
    ),
}
