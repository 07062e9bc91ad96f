"""Inputs of the registered queries, derived from the given tables.

Every input has two forms: a DataFrame in the shape the operators expect (nested records, key/value arrays, JSON
bodies), and SQL text that yields the same values as plain columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from engage.operators.attribution import EventNames

AS_OF = "2024-02-15 00:00:00"
NAMES = EventNames(event=("view", "click", "purchase", "signup"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _text(prefix: str, number: Column) -> Column:
    return F.concat(F.lit(prefix), number.cast("string"))


def _pick(number: Column, *values: str) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), F.pmod(number, F.lit(len(values))).cast("int"))


def _unless(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


# --- events ---------------------------------------------------------------------------------------------------------
def ga_events(spark: SparkSession, sf_dir: str, shard: str | None = None) -> DataFrame:
    """Analytics events: nested traffic, session, device and geo records and a key/value parameter array.

    ``shard`` names a column for the date, by which each task's rows are then ordered, as a write into shards needs them: here
    they are narrow, while the write would sort the nested records.
    """
    number = F.get_json_object("props", "$.k").cast("bigint")
    raw = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "event_type", "value", "ts", number.alias("k")
    )
    if shard is not None:
        raw = raw.withColumn(shard, F.to_date(F.timestamp_micros(micros("ts")))).sortWithinPartitions(shard)
    k, hours = F.col("k"), F.floor((micros("ts") - 1704067200000000) / F.lit(3_600_000_000))

    def text_param(key: Column | str, value: Column) -> Column:
        name = F.lit(key) if isinstance(key, str) else key
        slots = F.struct(value.alias("string_value"), F.lit(None).cast("bigint").alias("int_value"))
        return F.struct(name.alias("key"), slots.alias("value"))

    def int_param(key: str, value: Column) -> Column:
        slots = F.struct(F.lit(None).cast("string").alias("string_value"), value.cast("bigint").alias("int_value"))
        return F.struct(F.lit(key).alias("key"), slots.alias("value"))

    app = F.when(k % 4 == 1, "OTHER").otherwise("OS_SERVER")
    apps_json = F.concat(
        F.lit('[{"name":"'), app, F.lit('","version":"1.'), k.cast("string"),
        F.lit('","platform":"'), _pick(k, "WINDOWS", "MACOS", "LINUX"), F.lit('"}]'),
    )
    params = F.array(
        text_param("page_location", _text("https://site.example/", k % 30)),
        text_param(F.when(k % 17 == 0, "other").otherwise("app_user_key"), F.col("user_id").cast("string")),
        text_param("product_user_id", _text("p", F.col("user_id") % 40)),
        text_param("product_apps", _unless(k % 5 == 2, _text("apps", k % 5))),
        text_param("product_apps_json", _unless(k % 4 == 0, apps_json)),
        text_param("page_referrer", _unless(k % 5 == 1, _text("https://ref.example/", k % 8))),
        text_param("page_title", _text("Title ", k % 30)),
        text_param("path", _text("/p/", k % 30)),
        int_param("ga_session_id", _unless(k % 19 == 0, F.col("user_id") * 1000 + F.floor(hours / 6))),
        int_param("ga_session_number", F.floor(hours / 24) + 1),
        int_param("engagement_time_msec", _unless(k % 6 == 1, F.round(F.col("value") * 1000))),
        text_param("page_title", F.lit("second entry of the key")),
    )
    return raw.select(
        "event_id",
        F.col("event_type").alias("event_name"),
        micros("ts").alias("event_timestamp"),
        _unless(k % 4 == 0, micros("ts") - k * 1_000_000).alias("user_first_touch_timestamp"),
        params.alias("event_params"),
        F.struct(
            _unless(k % 5 == 0, F.col("event_type")).alias("source"),
            _unless(k % 6 == 0, _text("m", k % 3)).alias("medium"),
            _text("c", k % 10).alias("name"),
        ).alias("traffic_source"),
        F.struct(
            F.struct(
                _unless(k % 3 == 0, _text("s", k % 7)).alias("source"),
                _unless(k % 4 == 1, _text("sm", k % 5)).alias("medium"),
                _unless(k % 7 == 0, _text("sc", k % 9)).alias("campaign_name"),
                _unless(k % 11 == 0, _pick(k, "Direct", "Organic", "Paid", "Referral")).alias("default_channel_group"),
            ).alias("cross_channel_campaign")
        ).alias("session_traffic_source_last_click"),
        F.struct(
            _pick(k, "desktop", "mobile", "tablet").alias("category"),
            _pick(k, "Windows", "Macintosh", "Linux", "Android").alias("operating_system"),
            _text("v", k % 13).alias("operating_system_version"),
            F.struct(
                _unless(k % 9 == 0, _pick(k, "Chrome", "Safari", "Firefox")).alias("browser"),
                F.concat((k % 20).cast("string"), F.lit(".0")).alias("browser_version"),
            ).alias("web_info"),
        ).alias("device"),
        F.struct(
            _unless(k % 8 == 0, _text("City", k % 25)).alias("city"),
            _text("Region", k % 12).alias("region"),
            _text("Country", k % 6).alias("country"),
            _pick(k, "Europe", "Asia", "Americas").alias("continent"),
            _unless(k % 2 == 0, _text("Metro", k % 15)).alias("metro"),
        ).alias("geo"),
        *([] if shard is None else [shard]),
    )


GA_SQL = """
ga AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id, event_id, epoch_us(ts) AS event_timestamp,
    CASE WHEN k % 4 <> 0 THEN epoch_us(ts) - k * 1000000 END AS user_first_touch_timestamp,
    CASE WHEN k % 3 <> 0 THEN 's' || (k % 7) END AS session_source,
    CASE WHEN k % 4 <> 1 THEN 'sm' || (k % 5) END AS session_medium,
    CASE WHEN k % 7 <> 0 THEN 'sc' || (k % 9) END AS session_campaign,
    CASE WHEN k % 11 <> 0 THEN ['Direct', 'Organic', 'Paid', 'Referral'][k % 4 + 1] END AS channel_group,
    'p' || (user_id % 40) AS product_user_id,
    CASE WHEN k % 5 <> 2 THEN 'apps' || (k % 5) END AS product_apps,
    CASE WHEN k % 4 <> 0 THEN '[{"name":"' || (CASE WHEN k % 4 = 1 THEN 'OTHER' ELSE 'OS_SERVER' END)
      || '","version":"1.' || k || '","platform":"' || ['WINDOWS', 'MACOS', 'LINUX'][k % 3 + 1] || '"}]' END
      AS product_apps_json,
    'https://site.example/' || (k % 30) AS page_location,
    CASE WHEN k % 5 <> 1 THEN 'https://ref.example/' || (k % 8) END AS page_referrer,
    CASE WHEN k % 19 <> 0 THEN user_id * 1000 + h // 6 END AS session_id,
    CASE WHEN k % 6 <> 1 THEN CAST(round(value * 1000) AS BIGINT) END AS engagement_time_msec,
    'Title ' || (k % 30) AS page_title, '/p/' || (k % 30) AS page_path, h // 24 + 1 AS session_number,
    CASE WHEN k % 5 <> 0 THEN event_type END AS source,
    CASE WHEN k % 6 <> 0 THEN 'm' || (k % 3) END AS medium,
    'c' || (k % 10) AS campaign,
    ['desktop', 'mobile', 'tablet'][k % 3 + 1] AS device_category,
    ['Windows', 'Macintosh', 'Linux', 'Android'][k % 4 + 1] AS operating_system,
    'v' || (k % 13) AS os_version,
    CASE WHEN k % 9 <> 0 THEN ['Chrome', 'Safari', 'Firefox'][k % 3 + 1] END AS browser,
    (k % 20) || '.0' AS browser_version,
    CASE WHEN k % 8 <> 0 THEN 'City' || (k % 25) END AS ga4_city,
    'Region' || (k % 12) AS ga4_region, 'Country' || (k % 6) AS ga4_country,
    ['Europe', 'Asia', 'Americas'][k % 3 + 1] AS ga4_continent,
    CASE WHEN k % 2 <> 0 THEN 'Metro' || (k % 15) END AS ga4_metro
  FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
               (epoch_us(ts) - 1704067200000000) // 3600000000 AS h FROM events)
  WHERE event_type IN ('view', 'click', 'purchase', 'signup') AND k % 17 <> 0
)"""


# --- users ----------------------------------------------------------------------------------------------------------
def users(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users with sign-up and last-login times, login address and, for some of them, a city."""
    uid = F.col("user_id")
    signup = (
        table(spark, sf_dir, "orders")
        .groupBy(F.col("o_custkey").alias("user_id"))
        .agg((F.min("o_orderdate") + F.expr("INTERVAL 10592 DAYS")).alias("first_order"))
    )
    login = (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(F.max("ts").alias("newest"))
        .withColumn("login", F.col("newest") + F.expr("make_dt_interval(CAST(user_id % 90 - 70 AS INT))"))
        .select("user_id", "login")
    )
    has_login = F.col("login").isNotNull()
    created = F.when(
        has_login & (uid % 7 == 0), F.col("login") - F.expr("make_dt_interval(0, 0, CAST(user_id % 600 AS INT))")
    ).otherwise(F.col("first_order"))
    located = has_login & (uid % 3 == 0)
    address = F.concat(F.lit("10.0."), (uid % 16).cast("string"), F.lit("."), (uid % 50).cast("string"))
    return (
        table(spark, sf_dir, "customer")
        .select(F.col("c_custkey").alias("user_id"), F.col("c_name").alias("display_name"))
        .join(signup, "user_id", "left")
        .join(login, "user_id", "left")
        .select(
            "user_id",
            "display_name",
            created.alias("created_time"),
            F.col("login").alias("last_login_time"),
            F.when(has_login, address).alias("last_login_ip"),
            F.when(has_login, _text("X", uid % 4)).alias("last_login_country"),
            F.when(located, _text("City", uid % 25)).alias("last_login_city"),
            F.when(located, _text("Region", uid % 12)).alias("last_login_region"),
            F.when(located, _text("Country", uid % 6)).alias("last_login_country_name"),
        )
    )


USERS_SQL = """
u AS (
  SELECT c_custkey AS user_id, c_name AS display_name,
    CASE WHEN login IS NOT NULL AND c_custkey % 7 = 0 THEN login - to_minutes(c_custkey % 600)
         ELSE first_order END AS created_time,
    login AS last_login_time,
    CASE WHEN login IS NOT NULL THEN '10.0.' || (c_custkey % 16) || '.' || (c_custkey % 50) END AS last_login_ip,
    CASE WHEN login IS NOT NULL THEN 'X' || (c_custkey % 4) END AS last_login_country,
    CASE WHEN login IS NOT NULL AND c_custkey % 3 = 0 THEN 'City' || (c_custkey % 25) END AS last_login_city,
    CASE WHEN login IS NOT NULL AND c_custkey % 3 = 0 THEN 'Region' || (c_custkey % 12) END AS last_login_region,
    CASE WHEN login IS NOT NULL AND c_custkey % 3 = 0 THEN 'Country' || (c_custkey % 6) END AS last_login_country_name
  FROM customer
  LEFT JOIN (SELECT o_custkey, min(o_orderdate) + to_days(10592) AS first_order FROM orders GROUP BY 1)
    ON c_custkey = o_custkey
  LEFT JOIN (
    SELECT user_id AS eu, max(ts) + to_days(CAST(user_id % 90 - 70 AS INTEGER)) AS login FROM events GROUP BY user_id
  ) ON c_custkey = eu
)"""


# --- audit records --------------------------------------------------------------------------------------------------
def audits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Audit records in the landed shape (times as text milliseconds, some fields missing)."""
    eid = F.col("event_id")
    millis = F.unix_millis(F.col("ts").cast("timestamp")).cast("string")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(eid % 23 == 0, "").otherwise(F.col("user_id").cast("string")).alias("userId"),
        F.col("event_type").alias("action"),
        F.when(eid % 29 == 0, "0").otherwise(millis).alias("occurred"),
        _unless(eid % 5 == 0, _text("G", eid % 9)).alias("geo"),
        _unless(eid % 7 == 0, _text("10.1.0.", eid % 200)).alias("remoteAddress"),
    )


AUDITS_SQL = """
a AS (
  SELECT event_id, CASE WHEN event_id % 23 = 0 THEN '' ELSE CAST(user_id AS VARCHAR) END AS "userId",
    event_type AS action, CASE WHEN event_id % 29 = 0 THEN 0 ELSE epoch_us(ts) // 1000 END AS occurred,
    CASE WHEN event_id % 5 <> 0 THEN 'G' || (event_id % 9) END AS geo,
    CASE WHEN event_id % 7 <> 0 THEN '10.1.0.' || (event_id % 200) END AS "remoteAddress"
  FROM events
)"""


# --- provider responses ---------------------------------------------------------------------------------------------
def geo_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One JSON body per login address and provider; some fail, lack a field or cannot be read."""
    n = F.col("n")
    uid = F.col("user_id")
    addresses = (
        users(spark, sf_dir)
        .where(F.col("last_login_ip").isNotNull())
        .select(F.col("last_login_ip").alias("ip"), ((uid % 16) * 50 + uid % 50).alias("n"))
        .distinct()
    )

    def body(*pairs: tuple[str, Column]) -> Column:
        return F.to_json(F.struct(*[value.alias(name) for name, value in pairs]))

    city = _unless(n % 9 == 0, F.concat(F.lit("c"), n.cast("string")))
    status_body = F.when(
        n % 3 == 0,
        body(
            ("status", F.lit("success")),
            ("city", F.concat(F.lit("A"), city)),
            ("regionName", _text("RA", n % 10)),
            ("country", _text("CA", n % 6)),
            ("countryCode", _text("A", n % 6)),
        ),
    ).otherwise(body(("status", F.lit("fail")), ("message", F.lit("private range"))))
    named_body = F.when(
        n % 2 == 0,
        body(
            ("cityName", F.concat(F.lit("B"), n.cast("string"))),
            ("regionName", _text("RB", n % 10)),
            ("countryName", _text("CB", n % 6)),
            ("countryCode", _text("B", n % 6)),
        ),
    ).otherwise(body(("message", F.lit("limit"))))
    flag_body = body(
        ("success", n % 5 < 3),
        ("city", F.concat(F.lit("C"), city)),
        ("region", _text("RC", n % 10)),
        ("country", _text("CC", n % 6)),
        ("country_code", _text("C", n % 6)),
    )
    error_body = (
        F.when(n % 11 == 0, "<html>")
        .when(n % 7 == 0, body(("error", F.lit(True)), ("reason", F.lit("RateLimited"))))
        .otherwise(
            body(
                ("city", F.concat(F.lit("D"), city)),
                ("region", _text("RD", n % 10)),
                ("country_name", _text("CD", n % 6)),
                ("country_code", _text("D", n % 6)),
            )
        )
    )
    bodies = {
        "ip-api.com": status_body,
        "freeipapi.com": named_body,
        "ipwho.is": flag_body,
        "ipapi.co": error_body,
    }
    pairs = [F.struct(F.lit(name).alias("provider"), text.alias("body")) for name, text in bodies.items()]
    return addresses.select("ip", F.explode(F.array(*pairs)).alias("r")).select("ip", "r.*")


LOCATIONS_SQL = (
    USERS_SQL
    + """,
ips AS (
  SELECT DISTINCT last_login_ip AS ip, (user_id % 16) * 50 + user_id % 50 AS n FROM u WHERE last_login_ip IS NOT NULL
),
loc AS (
  SELECT ip, CASE WHEN n % 9 = 0 THEN '' ELSE 'Ac' || n END AS city, 'RA' || (n % 10) AS region,
    'CA' || (n % 6) AS country_name, 'A' || (n % 6) AS country_code, 'ip-api.com' AS source, 1 AS bulk, 1 AS sync
  FROM ips WHERE n % 3 = 0
  UNION ALL
  SELECT ip, 'B' || n, 'RB' || (n % 10), 'CB' || (n % 6), 'B' || (n % 6), 'freeipapi.com', 2, 3
  FROM ips WHERE n % 2 = 0
  UNION ALL
  SELECT ip, CASE WHEN n % 9 = 0 THEN '' ELSE 'Cc' || n END, 'RC' || (n % 10), 'CC' || (n % 6), 'C' || (n % 6),
    'ipwho.is', 3, 2
  FROM ips WHERE n % 5 < 3
  UNION ALL
  SELECT ip, CASE WHEN n % 9 = 0 THEN '' ELSE 'Dc' || n END, 'RD' || (n % 10), 'CD' || (n % 6), 'D' || (n % 6),
    'ipapi.co', 4, NULL
  FROM ips WHERE n % 11 <> 0 AND n % 7 <> 0
)"""
)


# --- posts and their metadata ---------------------------------------------------------------------------------------
def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts in the landed shape: URN, all-digit and other ids, both record versions, every kind of media."""
    d = F.col("doc_id")
    number = d.cast("string")
    created = F.lit(1704067200000) + d * 3600000
    v2 = d % 6 == 5
    post_id = (
        F.when(d % 4 == 0, number)
        .when(d % 4 == 1, F.concat(F.lit("urn:li:share:"), number))
        .when(d % 4 == 2, F.concat(F.lit("urn:li:ugcPost:"), number))
        .otherwise(F.concat(F.lit("x"), number))
    )
    media_id = F.concat(_pick(d, "urn:li:video:", "urn:li:image:", "urn:li:document:"), number)
    content = (
        F.when(d % 5 == 0, F.struct(F.struct(media_id.alias("id")).alias("media"), _null(), _null("multiImage")))
        .when(d % 5 == 1, F.struct(_no_media(), F.lit('{"title":"t"}').alias("article"), _null("multiImage")))
        .when(d % 5 == 2, F.struct(_no_media(), _null(), F.lit('{"images":[]}').alias("multiImage")))
        .when(d % 5 == 3, F.struct(_no_media(), _null(), _null("multiImage")))
    )
    text_path = F.struct(F.struct(F.struct(F.col("text").alias("text")).alias("shareCommentary")))
    nested_type = "struct<`com.linkedin.ugc.ShareContent`:struct<shareCommentary:struct<text:string>>>"
    return table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(d % 10 == 9, "").otherwise(post_id).alias("id"),
        post_id.alias("urn"),
        F.concat(F.lit("urn:li:organization:"), F.col("source")).alias("author"),
        _unless(v2, F.col("text")).alias("commentary"),
        F.when(v2, F.lit(0)).otherwise(_unless(d % 13 == 0, created)).alias("createdAt"),
        _unless(d % 8 == 0, created + 1000).alias("publishedAt"),
        F.when(d % 9 == 0, F.lit(0)).otherwise(created + 2000).alias("lastModifiedAt"),
        F.when(v2, F.struct((created + 500).alias("time"))).alias("created"),
        _pick(d, "PUBLIC", "CONNECTIONS").alias("visibility"),
        F.lit("PUBLISHED").alias("lifecycleState"),
        F.when(d % 7 == 0, F.create_map(F.lit("parent"), F.concat(F.lit("urn:li:share:"), (d + 1).cast("string"))))
        .when(d % 7 == 1, F.create_map().cast("map<string,string>"))
        .alias("reshareContext"),
        F.when(v2, text_path.cast(nested_type)).alias("specificContent"),
        content.alias("content"),
    )


def _null(name: str = "article") -> Column:
    return F.lit(None).cast("string").alias(name)


def _no_media() -> Column:
    return F.lit(None).cast("struct<id:string>").alias("media")


POSTS_SQL = """
raw AS (
  SELECT doc_id, text, source, 1704067200000 + doc_id * 3600000 AS ms,
    CASE doc_id % 4 WHEN 0 THEN CAST(doc_id AS VARCHAR) WHEN 1 THEN 'urn:li:share:' || doc_id
      WHEN 2 THEN 'urn:li:ugcPost:' || doc_id ELSE 'x' || doc_id END AS key
  FROM documents
),
post AS (
  SELECT raw.*, CASE WHEN doc_id % 10 = 9 THEN '' ELSE key END AS id,
    CASE WHEN doc_id % 6 = 5 THEN ms + 500 WHEN doc_id % 13 <> 0 THEN ms END AS created,
    CASE WHEN doc_id % 6 = 5 THEN 0 WHEN doc_id % 13 <> 0 THEN ms END AS created_strict
  FROM raw
)"""


def post_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata of the labelled documents under one or two URNs each; a reaction key is missing now and then."""
    d = F.col("doc_id")
    number = d.cast("string")
    kinds = (
        F.when(d % 3 == 0, F.array(F.lit("urn:li:ugcPost:")))
        .when(d % 3 == 1, F.array(F.lit("urn:li:share:")))
        .otherwise(F.array(F.lit("urn:li:ugcPost:"), F.lit("urn:li:share:")))
    )
    bonus = F.when(F.col("kind") == "urn:li:share:", F.lit(100)).otherwise(F.lit(0))

    def entry(key: str, count: Column) -> Column:
        return F.struct(F.lit(key).alias("key"), F.struct(count.cast("bigint").alias("count")).alias("value"))

    entries = F.array(
        entry("LIKE", d % 10 + bonus),
        entry("PRAISE", F.col("quality") * 3),
        entry("APPRECIATION", F.col("toxic") * 2),
        entry("INTEREST", d % 4),
    )
    full = F.array_append(F.array_append(entries, entry("EMPATHY", d % 6)), entry("ENTERTAINMENT", d % 3))
    return (
        table(spark, sf_dir, "labels")
        .withColumn("kind", F.explode(kinds))
        .select(
            F.concat("kind", number).alias("urn"),
            F.when(F.col("toxic") == 1, "CLOSED").otherwise("OPEN").alias("commentsState"),
            F.struct((d % 12 + bonus).alias("count"), _unless(d % 5 == 0, d % 7).alias("topLevelCount")).alias(
                "commentSummary"
            ),
            F.map_from_entries(F.when(d % 2 == 0, full).otherwise(entries)).alias("reactionSummaries"),
        )
    )


METADATA_SQL = """
meta AS (
  SELECT doc_id, kind || doc_id AS urn, CASE WHEN kind = 'urn:li:ugcPost:' THEN 1 ELSE 2 END AS rank,
    CASE WHEN toxic = 1 THEN 'CLOSED' ELSE 'OPEN' END AS comments_state, doc_id % 12 + bonus AS comment_count,
    CASE WHEN doc_id % 5 = 0 THEN 0 ELSE doc_id % 7 END AS top_level_comment_count,
    doc_id % 10 + bonus AS reaction_like, CAST(quality * 3 AS BIGINT) AS reaction_celebrate,
    CAST(toxic * 2 AS BIGINT) AS reaction_support,
    CASE WHEN doc_id % 2 = 0 THEN doc_id % 6 ELSE 0 END AS reaction_love, doc_id % 4 AS reaction_insightful,
    CASE WHEN doc_id % 2 = 0 THEN doc_id % 3 ELSE 0 END AS reaction_funny
  FROM (
    SELECT *, CASE WHEN kind = 'urn:li:share:' THEN 100 ELSE 0 END AS bonus
    FROM (SELECT *, unnest(CASE doc_id % 3 WHEN 0 THEN ['urn:li:ugcPost:'] WHEN 1 THEN ['urn:li:share:']
                           ELSE ['urn:li:ugcPost:', 'urn:li:share:'] END) AS kind FROM labels)
  )
)"""
