"""Registered queries: event flattening, attribution, engagement and the channel summary."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from engage.functions.params import param
from engage.functions.times import zone_free
from engage.operators import attribution as A
from engage.operators import attribution_state as AS
from engage.plans.jobs import run_attribution_increment
from engage.queries.inputs import AS_OF, GA_SQL, NAMES, USERS_SQL, ga_events, users
from engage.session import scratch_dir
from engage.sources.bucketed import BucketedTable, ddl_of
from engage.sources.landed import read_event_shards


def flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.flatten_events(ga_events(spark, sf_dir), NAMES)


def flat_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return A.flatten_events_clean(ga_events(spark, sf_dir), NAMES)


def param_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ga_events(spark, sf_dir).select(
        "event_id",
        param(NAMES.user_key).alias("user_key"),
        param("page_title").alias("page_title"),
        param("ga_session_id", "int_value").alias("session_id"),
        param("ga_session_id").alias("session_text"),
        param("no_such_key").alias("absent"),
    )


def incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Attribution from three slices of the events by day, combined out of order, the first one in two steps."""
    events = flat(spark, sf_dir)
    day = F.floor(F.col("event_timestamp") / F.lit(86_400_000_000))
    slices = [AS.slice_state(events.where(F.pmod(day, F.lit(3)) == n)) for n in range(3)]
    return AS.finish(AS.combine(slices[2], AS.combine(slices[1], slices[0])))


def _sharded(spark: SparkSession, sf_dir: str) -> str:
    """The events as landed shards, one folder for each date."""
    path = scratch_dir(spark, "shards")
    ga_events(spark, sf_dir, shard="dt").write.partitionBy("dt").parquet(path)
    return path


def event_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events of a range of shards; the others are not opened."""
    events = read_event_shards(spark, _sharded(spark, sf_dir), dt.date(2024, 1, 5), dt.date(2024, 1, 20))
    return A.flatten_events(events, NAMES).select("event_id", "user_id", "event_timestamp", "session_id", "product_apps")


def attribution_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The users table after the attribution job has met the shards in two runs, the second of which reads the later ones only."""
    path = _sharded(spark, sf_dir)
    people = users(spark, sf_dir).select(F.col("user_id").cast("string").alias("user_id"), "display_name")
    table, state = (BucketedTable(spark, scratch_dir(spark, name), buckets=16) for name in ("users", "state"))
    table.create(ddl_of(people))
    table.append(people)
    run_attribution_increment(table, state, read_event_shards(spark, path, end=dt.date(2024, 1, 12)), names=NAMES)
    run_attribution_increment(table, state, read_event_shards(spark, path), names=NAMES)
    return zone_free(table.read().select("user_id", "display_name", *JOB_COLUMNS))


JOB_COLUMNS = (
    "first_touch_source first_touch_timestamp last_click_source last_click_timestamp activation_date total_sessions total_events "
    "total_engagement_time_sec avg_session_duration_sec days_active product_user_id product_os_version browser ga4_city"
).split()


def channel_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup = A.attribution_clean(flat_clean(spark, sf_dir)).select(
        F.col("user_id").cast("bigint").alias("user_id"), "first_touch_channel_group", "total_sessions", "days_active"
    )
    return A.channel_summary(users(spark, sf_dir).join(rollup, "user_id", "left"), AS_OF)


FIRST_SQL = """
  SELECT user_id, coalesce(session_source, source) AS first_touch_source,
    coalesce(session_medium, medium) AS first_touch_medium,
    coalesce(session_campaign, campaign) AS first_touch_campaign, channel_group AS first_touch_channel_group,
    page_location AS first_touch_landing_page, page_referrer AS first_touch_referrer,
    make_timestamp(coalesce(user_first_touch_timestamp, event_timestamp)) AS first_touch_timestamp
  FROM ga QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp, event_id) = 1"""

LAST_SQL = """
  SELECT user_id, coalesce(session_source, source) AS last_click_source,
    coalesce(session_medium, medium) AS last_click_medium,
    coalesce(session_campaign, campaign) AS last_click_campaign, channel_group AS last_click_channel_group,
    make_timestamp(event_timestamp) AS last_click_timestamp
  FROM ga QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC, event_id DESC) = 1"""

LATEST_SQL = """
  SELECT user_id, device_category, operating_system, os_version, browser, browser_version, ga4_city, ga4_region,
    ga4_country, ga4_continent, ga4_metro
  FROM ga QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp DESC, event_id DESC) = 1"""

ENGAGEMENT_SQL = """
  SELECT user_id, make_timestamp(min(event_timestamp)) AS activation_date,
    make_timestamp(max(event_timestamp)) AS last_activity_timestamp, TRUE AS is_activated,
    count(DISTINCT session_id) AS total_sessions, count(*) AS total_events,
    CAST(round(sum(coalesce(engagement_time_msec, 0)) / 1000) AS BIGINT) AS total_engagement_time_sec,
    count(DISTINCT CAST(make_timestamp(event_timestamp) AS DATE)) AS days_active,
    max(product_user_id) AS product_user_id, max(product_apps) AS product_apps,
    max(product_apps_json) AS product_apps_json
  FROM ga GROUP BY user_id"""

OS_VERSION_SQL = """nullif(regexp_extract({0}, '"name":"OS_SERVER","version":"([^"]+)"', 1), '')"""
PLATFORM_SQL = """nullif(regexp_extract({0}, '"platform":"([^"]+)"', 1), '')"""

PRODUCT_SQL = f"""
  SELECT user_id, {OS_VERSION_SQL.format("j")} AS product_os_version, {PLATFORM_SQL.format("j")} AS product_platform
  FROM (SELECT user_id, max(product_apps_json) AS j FROM ga WHERE product_apps_json IS NOT NULL GROUP BY user_id)"""

CLEAN_SQL = f"""
  SELECT ft.*, em.* EXCLUDE (user_id, product_apps_json), session_count AS ga_session_count, product_os_version,
    product_platform, ga4_city, ga4_region, ga4_country, ga4_continent
  FROM (
    SELECT user_id, source AS traffic_source_simple, medium AS traffic_medium_simple,
      campaign AS traffic_campaign_simple, coalesce(session_source, source) AS first_touch_source,
      coalesce(session_medium, medium) AS first_touch_medium,
      coalesce(session_campaign, campaign) AS first_touch_campaign, channel_group AS first_touch_channel_group,
      page_location AS first_touch_landing_page, page_title AS first_page_title, page_path AS first_page_path,
      page_referrer AS first_touch_referrer,
      make_timestamp(coalesce(user_first_touch_timestamp, event_timestamp)) AS first_touch_timestamp,
      CAST(session_id AS VARCHAR) AS first_ga_session_id
    FROM ga QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_timestamp, event_id) = 1
  ) ft
  LEFT JOIN ({ENGAGEMENT_SQL}) em ON ft.user_id = em.user_id
  LEFT JOIN (
    SELECT user_id, max(session_number) AS session_count,
      max({OS_VERSION_SQL.format("product_apps_json")}) AS product_os_version,
      max({PLATFORM_SQL.format("product_apps_json")}) AS product_platform
    FROM ga GROUP BY user_id
  ) pd ON ft.user_id = pd.user_id
  LEFT JOIN ({LATEST_SQL}) lv ON ft.user_id = lv.user_id"""

FULL_SQL = f"""
WITH {GA_SQL}
SELECT ft.*, lc.* EXCLUDE (user_id), em.* EXCLUDE (user_id),
  total_engagement_time_sec / nullif(total_sessions, 0) AS avg_session_duration_sec,
  product_os_version, product_platform, lv.* EXCLUDE (user_id)
FROM ({FIRST_SQL}) ft
LEFT JOIN ({LAST_SQL}) lc ON ft.user_id = lc.user_id
LEFT JOIN ({ENGAGEMENT_SQL}) em ON ft.user_id = em.user_id
LEFT JOIN ({PRODUCT_SQL}) pd ON ft.user_id = pd.user_id
LEFT JOIN ({LATEST_SQL}) lv ON ft.user_id = lv.user_id"""

FLAT_COLUMNS_SQL = """user_id, event_id, event_timestamp, user_first_touch_timestamp, session_source, session_medium,
  session_campaign, channel_group, product_user_id, product_apps, product_apps_json, page_location, page_referrer,
  session_id, engagement_time_msec"""

QUERIES = {
    "param_lookup": (
        param_lookup,
        """
SELECT event_id, CASE WHEN k % 17 <> 0 THEN CAST(user_id AS VARCHAR) END AS user_key,
  'Title ' || (k % 30) AS page_title,
  CASE WHEN k % 19 <> 0 THEN user_id * 1000 + ((epoch_us(ts) - 1704067200000000) // 3600000000) // 6 END AS session_id,
  CAST(NULL AS VARCHAR) AS session_text, CAST(NULL AS VARCHAR) AS absent
FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)""",
    ),
    "ga_flatten": (
        flat,
        f"""
WITH {GA_SQL}
SELECT {FLAT_COLUMNS_SQL}, source, medium, campaign, device_category, operating_system, os_version, browser,
  browser_version, ga4_city, ga4_region, ga4_country, ga4_continent, ga4_metro
FROM ga""",
    ),
    "ga_flatten_clean": (
        flat_clean,
        f"""
WITH {GA_SQL}
SELECT {FLAT_COLUMNS_SQL}, page_title, page_path, session_number, source AS traffic_source, medium AS traffic_medium,
  campaign AS traffic_campaign, ga4_city, ga4_region, ga4_country, ga4_continent
FROM ga""",
    ),
    "first_touch": (lambda spark, sf: zone_free(A.first_touch(flat(spark, sf))), f"WITH {GA_SQL} {FIRST_SQL}"),
    "last_click": (lambda spark, sf: zone_free(A.last_click(flat(spark, sf))), f"WITH {GA_SQL} {LAST_SQL}"),
    "latest_value": (lambda spark, sf: A.latest_values(flat(spark, sf)), f"WITH {GA_SQL} {LATEST_SQL}"),
    "engagement": (lambda spark, sf: zone_free(A.engagement(flat(spark, sf))), f"WITH {GA_SQL} {ENGAGEMENT_SQL}"),
    "product_details": (lambda spark, sf: A.product_details(flat(spark, sf)), f"WITH {GA_SQL} {PRODUCT_SQL}"),
    "attribution_full": (lambda spark, sf: zone_free(A.attribution_full(flat(spark, sf))), FULL_SQL),
    "event_shards": (
        event_shards,
        f"""
WITH {GA_SQL}
SELECT event_id, user_id, event_timestamp, session_id, product_apps FROM ga
WHERE CAST(make_timestamp(event_timestamp) AS DATE) BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'""",
    ),
    "attribution_job": (
        attribution_job,
        f"""
WITH {USERS_SQL}, a AS ({FULL_SQL})
SELECT CAST(u.user_id AS VARCHAR) AS user_id, u.display_name, {", ".join(JOB_COLUMNS)}
FROM u LEFT JOIN a ON CAST(u.user_id AS VARCHAR) = a.user_id""",
    ),
    "attribution_incremental": (lambda spark, sf: zone_free(incremental(spark, sf)), FULL_SQL),
    "attribution_clean": (
        lambda spark, sf: zone_free(A.attribution_clean(flat_clean(spark, sf))),
        f"WITH {GA_SQL} {CLEAN_SQL}",
    ),
    "channel_summary": (
        channel_summary,
        f"""
WITH {GA_SQL}, {USERS_SQL}, c AS ({CLEAN_SQL})
SELECT first_touch_channel_group, count(*) AS users,
  round(avg(DATE '2024-02-15' - CAST(created_time AS DATE)), 1) AS avg_account_age_days,
  round(avg(total_sessions), 1) AS avg_sessions, round(avg(days_active), 1) AS avg_days_active
FROM u LEFT JOIN c ON CAST(u.user_id AS VARCHAR) = c.user_id
WHERE first_touch_channel_group IS NOT NULL
GROUP BY 1""",
    ),
}
