"""Registered queries: user sync, MERGE, logins, location enrichment and activity."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from engage import schemas as S
from engage.functions.times import iso_text, zone_free
from engage.operators import enrich as E
from engage.operators.activity import activity_status
from engage.operators.diff import apply_changes
from engage.operators.flatten import flatten_users
from engage.operators.latest import last_login, modified_since, recent_logins, watermark
from engage.operators.merge import merge, merge_counts, merge_update_only
from engage.plans.steps import stage
from engage.queries.inputs import (
    AS_OF,
    AUDITS_SQL,
    LOCATIONS_SQL,
    USERS_SQL,
    audits,
    geo_responses,
    table,
    users,
)
from engage.session import scratch_dir
from engage.sources.bucketed import BucketedTable, ddl_of
from engage.sources.landed import read_ndjson, read_ndjson_marked, split_bad, write_ndjson
from engage.sources.pages import islands, scan_offset_pages, scan_pages
from engage.sources.tables import append, evolve, overwrite, replace_table_days

LOGIN_ACTIONS = ["view", "click"]


# --- scans ----------------------------------------------------------------------------------------------------------
def scan_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders landed as pages of 500 with the overall total, read back under the page rule."""
    orders = table(spark, sf_dir, "orders")
    page = F.floor(F.col("o_orderkey") / 500).cast("int")
    pages = (
        orders.groupBy(page.alias("page"))
        .agg(F.collect_list(F.struct("o_orderkey", "o_custkey", "o_totalprice")).alias("orders"))
        .withColumn("total", orders.agg(F.count("*").alias("n")).scalar())
    )
    kept = scan_pages(pages, "orders", 500, total="total")
    return kept.select(F.col("page").cast("bigint").alias("page"), F.explode("orders").alias("o")).select("page", "o.*")


def user_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """User records in the landed shape, from customers and their nation."""
    c = F.col("c_custkey")
    number = c.cast("string")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    text = F.lit(None).cast("string")
    flag = F.lit(None).cast("boolean")
    return (
        table(spark, sf_dir, "customer")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select(
            number.alias("userId"),
            F.when(c % 4 != 0, F.array(F.concat(F.lit("login"), number), F.col("c_mktsegment"))).alias("loginIds"),
            F.col("c_name").alias("name"),
            F.col("n_name").alias("givenName"),
            text.alias("middleName"),
            F.when(c % 3 != 0, F.col("c_mktsegment")).alias("familyName"),
            F.concat(F.lit("u"), number, F.lit("@mail.example")).alias("email"),
            (c % 2 == 0).alias("verifiedEmail"),
            F.when(c % 5 == 0, F.concat(F.lit("+1"), number)).alias("phone"),
            F.when(c % 5 == 0, c % 10 == 0).alias("verifiedPhone"),
            F.when(c % 6 != 0, F.array(F.lit("member"))).alias("roleNames"),
            F.when(c % 7 != 0, F.concat(F.lit('[{"tenantId":"'), F.col("n_name"), F.lit('"}]'))).alias("userTenants"),
            F.when(F.col("c_acctbal") < 0, "disabled").otherwise("enabled").alias("status"),
            F.array().cast("array<string>").alias("externalIds"),
            text.alias("picture"),
            (c % 100 == 0).alias("test"),
            flag.alias("TOTP"),
            F.lit(False).alias("SAML"),
            F.when(c % 8 == 0, F.lit('{"google":true}')).alias("OAuth"),
            F.lit(False).alias("webauthn"),
            (c % 9 == 0).alias("password"),
            F.lit(None).cast("array<string>").alias("ssoAppIds"),
            F.lit(True).alias("editable"),
            F.lit(False).alias("SCIM"),
            flag.alias("push"),
            F.lit(None).cast("array<string>").alias("permissions"),
            F.when(c % 11 != 0, F.concat(F.lit('{"segment":"'), F.col("c_mktsegment"), F.lit('"}'))).alias(
                "customAttributes"
            ),
            F.when(c % 13 != 0, c * 86400 + 1500000000).otherwise(F.lit(0)).alias("createdTime"),
        )
    )


def user_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flatten_users(user_records(spark, sf_dir))
    lists = {f.name: F.array_join(f.name, "|") for f in rows.schema.fields if "array" in f.dataType.simpleString()}
    return zone_free(rows.withColumns(lists))


def ndjson_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers written as newline-delimited JSON and loaded under a declared schema."""
    path = scratch_dir(spark, "ndjson")
    write_ndjson(table(spark, sf_dir, "customer"), path)
    schema = "c_custkey bigint, c_name string, c_nationkey bigint, c_acctbal double, c_mktsegment string"
    return read_ndjson(spark, path, schema)


def quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers landed with every 50th line cut off and some of the wrong type: keys of the good rows, and of the bad lines."""
    path = scratch_dir(spark, "landed")
    key = F.col("c_custkey")
    whole = F.to_json(F.struct("c_custkey", "c_name", F.when(key % 70 == 3, "much").otherwise(F.col("c_nationkey").cast("string")).alias("c_nationkey")))
    line = F.when(key % 50 == 0, F.substring(whole, F.lit(1), F.length(whole) - 4)).otherwise(F.regexp_replace(whole, '"([0-9]+)"', "$1"))
    table(spark, sf_dir, "customer").select(line.alias("value")).write.text(path)
    marked = stage(read_ndjson_marked(spark, path, "c_custkey bigint, c_name string, c_nationkey bigint"), "landed")
    good, bad = split_bad(marked, most=0.05)
    number = F.regexp_extract("line", '"c_custkey":([0-9]+)', 1).cast("bigint")
    lines = bad.select(number.alias("c_custkey"), F.lit(None).cast("string").alias("c_name"), F.lit(True).alias("bad"))
    return good.select("c_custkey", "c_name", F.lit(False).alias("bad")).unionByName(lines)


# --- incremental load -----------------------------------------------------------------------------------------------
def known_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("ts").alias("created_time"))


def watermark_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    mark = watermark(known_users(spark, sf_dir))
    return mark.select("wm_seconds", (F.col("wm_seconds") * 1000).alias("wm_ms"))


def incremental_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    source = table(spark, sf_dir, "events").select(
        "event_id", "user_id", F.unix_millis(F.col("ts").cast("timestamp")).alias("modified_ms")
    )
    return modified_since(source, watermark(known_users(spark, sf_dir)))


# --- pages ----------------------------------------------------------------------------------------------------------
def page_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of order keys of two scans; in the second, page 3 is short."""
    key = F.col("o_orderkey")
    kept = table(spark, sf_dir, "orders").where(~((F.floor(key / 500) == 3) & (key % 2 == 1) & (key % 10 > 3)))
    pages = kept.groupBy(F.floor(key / 500).cast("int").alias("page"), (key % 2).alias("run"))
    return pages.agg(F.collect_list("o_orderkey").alias("orders"))


def scan_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = scan_pages(page_runs(spark, sf_dir), "orders", 60, run="run")
    return kept.select("run", "page", F.explode("orders").alias("o_orderkey"))


def scan_offsets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same pages addressed by offset; page 4 of the first scan does not advance."""
    stuck = (F.col("run") == 0) & (F.col("page") == 4)
    start = F.col("page").cast("bigint") * 50
    pages = page_runs(spark, sf_dir).select(
        "run", start.alias("start"), F.struct(start.alias("start"), F.when(stuck, 0).otherwise(50).cast("bigint").alias("count")).alias("paging"), "orders"
    )
    kept = scan_offset_pages(pages, "orders", run="run")
    return kept.select("run", "start", F.explode("orders").alias("o_orderkey"))


def gap_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of three interleaved scans: every so many pages are missing, one scan lacks page 0, some pages have landed twice."""
    key = F.col("o_orderkey")
    page, run = F.floor(key / 500).cast("int"), key % 3
    kept = table(spark, sf_dir, "orders").where(~(((run == 1) & (page % 5 == 3)) | ((run == 2) & (page % 4 == 0))))
    pages = kept.groupBy(page.alias("page"), run.alias("run")).agg(F.collect_list("o_orderkey").alias("orders"))
    return pages


def page_islands(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = gap_pages(spark, sf_dir)
    return islands(pages.unionByName(pages.where("page % 7 = 1")), run="run")


def scan_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = scan_pages(gap_pages(spark, sf_dir), "orders", 60, run="run", gaps=False)
    return kept.select("run", "page", F.explode("orders").alias("o_orderkey"))


GAPS_SQL = """
g AS (
  SELECT o_orderkey // 500 AS page, o_orderkey % 3 AS run, o_orderkey FROM orders
  WHERE NOT ((o_orderkey % 3 = 1 AND (o_orderkey // 500) % 5 = 3) OR (o_orderkey % 3 = 2 AND (o_orderkey // 500) % 4 = 0))
)"""

PAGE_RUNS_SQL = """
p AS (
  SELECT CAST(o_orderkey // 500 AS INTEGER) AS page, o_orderkey % 2 AS run, o_orderkey FROM orders
  WHERE NOT (o_orderkey // 500 = 3 AND o_orderkey % 2 = 1 AND o_orderkey % 10 > 3)
)"""


# --- MERGE ----------------------------------------------------------------------------------------------------------
def merge_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Users seen in events, under ids that overlap the customers in part; some have no id."""
    u = F.col("user_id")
    return (
        table(spark, sf_dir, "events")
        .groupBy("user_id")
        .agg(F.max("value").alias("balance"), F.max("event_type").alias("segment"), F.count("*").alias("event_count"))
        .select(
            F.when(u % 50 != 49, u * 20).alias("user_id"),
            F.concat(F.lit("user "), u.cast("string")).alias("display_name"),
            "balance",
            "segment",
            "event_count",
        )
    )


def merge_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as synced users; balances below zero come as null, some rows have no id."""
    c = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        F.when(c % 100 != 99, c).alias("user_id"),
        F.col("c_name").alias("display_name"),
        F.when(F.col("c_acctbal") >= 0, F.col("c_acctbal")).alias("balance"),
        F.col("c_mktsegment").alias("segment"),
    )


def upserted(spark: SparkSession, sf_dir: str, small_source: bool = False) -> DataFrame:
    return merge(
        merge_target(spark, sf_dir), merge_source(spark, sf_dir), "user_id", small_source=small_source, action=True
    )


def merge_composite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line counts per order and ship mode onto stored ones, by both columns; a third of the keys is new."""
    key = [F.col("l_orderkey").alias("orderkey"), F.when(F.col("l_linenumber") != 3, F.col("l_returnflag")).alias("flag")]
    lines = table(spark, sf_dir, "lineitem").groupBy(*key).agg(F.count("*").alias("lines"), F.max("l_linenumber").alias("top"))
    stored = lines.where("orderkey % 3 <> 0").select("orderkey", "flag", F.lit(0).cast("bigint").alias("lines"), F.lit("old").alias("note"), "top")
    return merge(stored, lines.select("orderkey", "flag", "lines"), ["orderkey", "flag"])


def merge_subset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Different column lists for update and insert."""
    return merge(merge_target(spark, sf_dir), merge_source(spark, sf_dir), "user_id", update=["segment"], insert=["user_id", "balance"])


def merged_buckets(spark: SparkSession, sf_dir: str) -> BucketedTable:
    """The upsert on a table in buckets: version 1 is the target, 2 the merged rows, 3 lacks every other of the ids they share."""
    target = merge_target(spark, sf_dir)
    table = BucketedTable(spark, scratch_dir(spark, "users"), buckets=16)
    table.create(ddl_of(target))
    table.append(target)
    table.merge(stage(merge_source(spark, sf_dir), "increment"))
    table.mutate(lambda rows: rows.where("user_id IS NULL OR user_id % 40 <> 0"))
    return table


def merge_buckets(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = merged_buckets(spark, sf_dir)
    return table.read(table.version(2))


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What changed from the target to the last version, with the values before and after."""
    table = merged_buckets(spark, sf_dir)
    feed = table.changes(table.version(1), table.head())
    names = ("display_name", "balance", "segment", "event_count")
    sides = [F.col(f"{side}.{c}").alias(f"{c}_{side}") for side in ("before", "after") for c in names]
    return feed.select("user_id", F.col("_change").alias("change"), *sides)


def applied_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The older version with the feed applied, which is the newer one."""
    table = merged_buckets(spark, sf_dir)
    older, newer = table.version(1), table.head()
    return apply_changes(table.read(older), table.changes(older, newer))


MERGE_SQL = """
t AS (
  SELECT CASE WHEN user_id % 50 <> 49 THEN user_id * 20 END AS user_id, 'user ' || user_id AS display_name,
    max(value) AS balance, max(event_type) AS segment, count(*) AS event_count
  FROM events GROUP BY events.user_id
),
s AS (
  SELECT CASE WHEN c_custkey % 100 <> 99 THEN c_custkey END AS user_id, c_name AS display_name,
    CASE WHEN c_acctbal >= 0 THEN c_acctbal END AS balance, c_mktsegment AS segment
  FROM customer
),
m AS (
  SELECT t.user_id, CASE WHEN s.user_id IS NOT NULL THEN s.display_name ELSE t.display_name END AS display_name,
    CASE WHEN s.user_id IS NOT NULL THEN s.balance ELSE t.balance END AS balance,
    CASE WHEN s.user_id IS NOT NULL THEN s.segment ELSE t.segment END AS segment, t.event_count,
    CASE WHEN s.user_id IS NOT NULL THEN 'update' ELSE 'keep' END AS _action
  FROM t LEFT JOIN s ON t.user_id = s.user_id
  UNION ALL
  SELECT s.user_id, s.display_name, s.balance, s.segment, NULL, 'insert'
  FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.user_id = s.user_id)
)"""


def merge_login(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logins from the audit log onto users, update-only; audit users without a users row are ignored."""
    logins = last_login(recent_logins(audits(spark, sf_dir), AS_OF, 30, LOGIN_ACTIONS), tie="event_id").withColumn(
        "user_id", F.col("user_id").cast("bigint") * 20
    )
    target = users(spark, sf_dir).withColumn("last_login_time", F.col("last_login_time").cast("timestamp"))
    return zone_free(merge_update_only(target, logins, "user_id", source_unique=True))


LOGIN_SQL = """
recent AS (
  SELECT * FROM a WHERE action IN ('view', 'click')
    AND occurred >= epoch_ms(TIMESTAMP '2024-02-15 00:00:00') - CAST(30 AS BIGINT) * 86400000
),
login AS (
  SELECT "userId" AS user_id, make_timestamp(occurred * 1000) AS last_login_time,
    coalesce(geo, '') AS last_login_country, coalesce("remoteAddress", '') AS last_login_ip
  FROM recent WHERE "userId" <> '' AND occurred <> 0
  QUALIFY row_number() OVER (PARTITION BY "userId" ORDER BY occurred DESC, event_id) = 1
)"""


# --- location enrichment --------------------------------------------------------------------------------------------
def located_users(spark: SparkSession, sf_dir: str) -> DataFrame:
    best = E.first_location(E.normalize_locations(geo_responses(spark, sf_dir)))
    return E.locate_users(users(spark, sf_dir), best)


def geo_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The chosen location per address under both provider orders."""
    found = E.normalize_locations(geo_responses(spark, sf_dir))
    bulk = E.first_location(found, E.BULK_ORDER).withColumn("run", F.lit("bulk"))
    sync = E.first_location(found, E.SYNC_ORDER).withColumn("run", F.lit("sync"))
    return bulk.unionByName(sync)


LOCATED_SQL = """
best AS (SELECT * FROM loc QUALIFY row_number() OVER (PARTITION BY ip ORDER BY bulk) = 1),
located AS (
  SELECT user_id, display_name, created_time, last_login_time, last_login_ip,
    CASE WHEN ip IS NOT NULL THEN country_code ELSE last_login_country END AS last_login_country,
    CASE WHEN ip IS NOT NULL THEN city ELSE last_login_city END AS last_login_city,
    CASE WHEN ip IS NOT NULL THEN region ELSE last_login_region END AS last_login_region,
    CASE WHEN ip IS NOT NULL THEN country_name ELSE last_login_country_name END AS last_login_country_name
  FROM u LEFT JOIN best ON last_login_ip = ip
)"""


def with_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return activity_status(users(spark, sf_dir), AS_OF)


def table_sinks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written by overwrite (which replaces an earlier load) and by append, read back."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    name = f"sinks_{uuid.uuid4().hex}"
    overwrite(rows.limit(1), name)
    overwrite(rows, name)
    append(rows.where("c_custkey % 2 = 0").select("c_acctbal", "c_name", "c_custkey"), name)
    return spark.table(name)


def report_reload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders per day, loaded twice, the second time with right numbers: days are replaced, not doubled."""
    name = f"reload_{uuid.uuid4().hex}"
    rows = table(spark, sf_dir, "orders").groupBy(F.trunc("o_orderdate", "month").alias("month"), "o_orderdate").agg(F.count("*").alias("orders"))
    rows = rows.select(F.col("o_orderdate").alias("date"), "orders", "month")
    replace_table_days(rows.withColumn("orders", F.lit(0).cast("bigint")), name, "month")
    replace_table_days(rows, name, "month")
    return spark.table(name).select("date", "orders")


QUERIES = {
    "quarantine": (
        quarantine,
        """
SELECT c_custkey, CASE WHEN NOT bad THEN c_name END AS c_name, bad
FROM (SELECT *, c_custkey % 50 = 0 OR c_custkey % 70 = 3 AS bad FROM customer)""",
    ),
    "page_islands": (
        page_islands,
        f"""
WITH {GAPS_SQL}
SELECT run, min(page) AS first_page, max(page) AS last_page
FROM (SELECT *, page - row_number() OVER (PARTITION BY run ORDER BY page) AS island FROM (SELECT DISTINCT run, page FROM g))
GROUP BY run, island""",
    ),
    "scan_pages_gaps": (
        scan_gaps,
        f"""
WITH {GAPS_SQL}, sizes AS (SELECT run, page, count(*) AS n FROM g GROUP BY run, page
), stops AS (
  SELECT run, coalesce(min(page) FILTER (WHERE n < 60), 1000000000000) AS short FROM sizes GROUP BY run
), holes AS (
  SELECT run, min(page) AS last FROM sizes s WHERE NOT EXISTS (SELECT 1 FROM sizes t WHERE t.run = s.run AND t.page = s.page + 1) GROUP BY run
)
SELECT g.run, CAST(g.page AS INTEGER) AS page, o_orderkey
FROM g JOIN stops ON g.run = stops.run JOIN holes ON g.run = holes.run
WHERE g.page <= short AND g.page <= last AND EXISTS (SELECT 1 FROM sizes z WHERE z.run = g.run AND z.page = 0)""",
    ),
    "merge_buckets": (merge_buckets, f"WITH {MERGE_SQL} SELECT * EXCLUDE (_action) FROM m"),
    "change_feed": (
        change_feed,
        f"""
WITH {MERGE_SQL}, n AS (SELECT * FROM m WHERE user_id IS NULL OR user_id % 40 <> 0)
SELECT n.user_id, CASE WHEN _action = 'insert' THEN 'insert' ELSE 'update' END AS change,
  t.display_name AS display_name_before, t.balance AS balance_before, t.segment AS segment_before,
  t.event_count AS event_count_before, n.display_name AS display_name_after, n.balance AS balance_after,
  n.segment AS segment_after, n.event_count AS event_count_after
FROM n LEFT JOIN t ON n.user_id = t.user_id
WHERE _action = 'insert' OR (_action = 'update' AND (n.display_name IS DISTINCT FROM t.display_name
  OR n.balance IS DISTINCT FROM t.balance OR n.segment IS DISTINCT FROM t.segment))
UNION ALL
SELECT user_id, 'delete', display_name, balance, segment, event_count, NULL, NULL, NULL, NULL FROM t WHERE user_id % 40 = 0""",
    ),
    "change_feed_applied": (
        applied_changes,
        f"WITH {MERGE_SQL} SELECT * EXCLUDE (_action) FROM m WHERE user_id IS NULL OR user_id % 40 <> 0",
    ),
    "scan_pages": (
        scan_query,
        "SELECT o_orderkey // 500 AS page, o_orderkey, o_custkey, o_totalprice FROM orders",
    ),
    "scan_pages_runs": (
        scan_runs,
        f"""
WITH {PAGE_RUNS_SQL},
stops AS (
  SELECT run, min(page) AS stop FROM (SELECT run, page FROM p GROUP BY 1, 2 HAVING count(*) < 60) GROUP BY run
)
SELECT p.run, p.page, o_orderkey FROM p LEFT JOIN stops USING (run) WHERE stop IS NULL OR page <= stop""",
    ),
    "scan_offset_pages": (
        scan_offsets,
        f"""
WITH {PAGE_RUNS_SQL}
SELECT run, CAST(page AS BIGINT) * 50 AS start, o_orderkey FROM p WHERE run <> 0 OR page <= 4""",
    ),
    "addresses_smallest": (
        lambda spark, sf: E.addresses_to_enrich(users(spark, sf), limit=25),
        f"""
WITH {USERS_SQL}
SELECT DISTINCT last_login_ip FROM u WHERE last_login_ip IS NOT NULL AND last_login_city IS NULL
ORDER BY 1 LIMIT 25""",
    ),
    "instant_text": (
        lambda spark, sf: table(spark, sf, "events").select("event_id", iso_text(F.col("ts").cast("timestamp")).alias("at")),
        "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS at FROM events",
    ),
    "table_sinks": (
        table_sinks,
        "SELECT c_custkey, c_name, c_acctbal FROM customer UNION ALL SELECT c_custkey, c_name, c_acctbal FROM customer WHERE c_custkey % 2 = 0",
    ),
    "report_reload": (
        report_reload,
        "SELECT o_orderdate AS date, count(*) AS orders FROM orders GROUP BY 1",
    ),
    "user_flatten": (
        user_flatten,
        """
SELECT CAST(c_custkey AS VARCHAR) AS user_id,
  CASE WHEN c_custkey % 4 <> 0 THEN 'login' || c_custkey || '|' || c_mktsegment ELSE '' END AS login_ids,
  c_name AS display_name, n_name AS given_name, CAST(NULL AS VARCHAR) AS middle_name,
  CASE WHEN c_custkey % 3 <> 0 THEN c_mktsegment END AS family_name, 'u' || c_custkey || '@mail.example' AS email,
  c_custkey % 2 = 0 AS verified_email, CASE WHEN c_custkey % 5 = 0 THEN '+1' || c_custkey END AS phone,
  CASE WHEN c_custkey % 5 = 0 THEN c_custkey % 10 = 0 END AS verified_phone,
  CASE WHEN c_custkey % 6 <> 0 THEN 'member' ELSE '' END AS role_names,
  CASE WHEN c_custkey % 7 <> 0 THEN '[{"tenantId":"' || n_name || '"}]' ELSE '[]' END AS user_tenants,
  CASE WHEN c_acctbal < 0 THEN 'disabled' ELSE 'enabled' END AS status, '' AS external_ids,
  CAST(NULL AS VARCHAR) AS picture, c_custkey % 100 = 0 AS test, CAST(NULL AS BOOLEAN) AS totp, FALSE AS saml,
  CASE WHEN c_custkey % 8 = 0 THEN '{"google":true}' ELSE '{}' END AS oauth, FALSE AS webauthn,
  c_custkey % 9 = 0 AS password, '' AS sso_app_ids, TRUE AS editable, FALSE AS scim, CAST(NULL AS BOOLEAN) AS push,
  '' AS permissions, CASE WHEN c_custkey % 11 <> 0 THEN '{"segment":"' || c_mktsegment || '"}' ELSE '{}' END
    AS custom_attributes,
  CASE WHEN c_custkey % 13 <> 0 THEN make_timestamp((c_custkey * 86400 + 1500000000) * 1000000) END AS created_time
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",
    ),
    "ndjson_roundtrip": (
        ndjson_roundtrip,
        "SELECT c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer",
    ),
    "schema_evolve": (
        lambda spark, sf: evolve(
            table(spark, sf, "customer"), [("c_name", "string"), *S.USER_CLEAN_ATTRIBUTION]
        ),
        """
SELECT *, CAST(NULL AS VARCHAR) AS traffic_source_simple, CAST(NULL AS VARCHAR) AS traffic_medium_simple,
  CAST(NULL AS VARCHAR) AS traffic_campaign_simple, CAST(NULL AS VARCHAR) AS first_page_title,
  CAST(NULL AS VARCHAR) AS first_page_path, CAST(NULL AS BIGINT) AS ga_session_count,
  CAST(NULL AS VARCHAR) AS first_ga_session_id
FROM customer""",
    ),
    "watermark": (
        watermark_query,
        """
SELECT epoch_us(max(c)) // 1000000 AS wm_seconds, epoch_us(max(c)) // 1000000 * 1000 AS wm_ms
FROM (SELECT min(ts) AS c FROM events GROUP BY user_id)""",
    ),
    "incremental_load": (
        incremental_load,
        """
WITH w AS (SELECT epoch_us(max(c)) // 1000000 * 1000 AS wm FROM (SELECT min(ts) AS c FROM events GROUP BY user_id))
SELECT event_id, user_id, epoch_us(ts) // 1000 AS modified_ms FROM events, w WHERE epoch_us(ts) // 1000 >= wm""",
    ),
    "merge_upsert": (
        lambda spark, sf: upserted(spark, sf).drop("_action"),
        f"WITH {MERGE_SQL} SELECT * EXCLUDE (_action) FROM m",
    ),
    "merge_upsert_small_source": (
        lambda spark, sf: upserted(spark, sf, small_source=True).drop("_action"),
        f"WITH {MERGE_SQL} SELECT * EXCLUDE (_action) FROM m",
    ),
    "merge_composite_key": (
        merge_composite,
        """
WITH l AS (
  SELECT l_orderkey AS orderkey, CASE WHEN l_linenumber <> 3 THEN l_returnflag END AS flag, count(*) AS lines,
    max(l_linenumber) AS top
  FROM lineitem GROUP BY 1, 2
)
SELECT orderkey, flag, CASE WHEN flag IS NULL THEN 0 ELSE lines END AS lines, 'old' AS note, top FROM l WHERE orderkey % 3 <> 0
UNION ALL
SELECT orderkey, flag, lines, NULL, NULL FROM l WHERE orderkey % 3 = 0 OR flag IS NULL""",
    ),
    "merge_insert_subset": (
        merge_subset,
        f"""
WITH {MERGE_SQL}
SELECT t.user_id, t.display_name, t.balance, CASE WHEN s.user_id IS NOT NULL THEN s.segment ELSE t.segment END AS segment,
  t.event_count
FROM t LEFT JOIN s ON t.user_id = s.user_id
UNION ALL
SELECT s.user_id, NULL, s.balance, NULL, NULL FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.user_id = s.user_id)""",
    ),
    "merge_counts": (
        lambda spark, sf: merge_counts(upserted(spark, sf)),
        f"""
WITH {MERGE_SQL}
SELECT count(*) FILTER (_action = 'insert') AS inserted, count(*) FILTER (_action = 'update') AS updated,
  count(*) FILTER (_action = 'keep') AS kept, count(*) FILTER (_action <> 'keep') AS affected
FROM m""",
    ),
    "merge_update_only": (
        merge_login,
        f"""
WITH {USERS_SQL}, {AUDITS_SQL}, {LOGIN_SQL}
SELECT u.user_id, display_name, created_time,
  CASE WHEN l.user_id IS NOT NULL THEN l.last_login_time ELSE u.last_login_time END AS last_login_time,
  CASE WHEN l.user_id IS NOT NULL THEN l.last_login_ip ELSE u.last_login_ip END AS last_login_ip,
  CASE WHEN l.user_id IS NOT NULL THEN l.last_login_country ELSE u.last_login_country END AS last_login_country,
  last_login_city, last_login_region, last_login_country_name
FROM u LEFT JOIN login l ON u.user_id = CAST(l.user_id AS BIGINT) * 20""",
    ),
    "audit_recent_logins": (
        lambda spark, sf: recent_logins(audits(spark, sf), AS_OF, 30, LOGIN_ACTIONS).withColumn(
            "occurred", F.col("occurred").cast("bigint")
        ),
        f"WITH {AUDITS_SQL}, {LOGIN_SQL} SELECT * FROM recent",
    ),
    "last_login": (
        lambda spark, sf: zone_free(
            last_login(recent_logins(audits(spark, sf), AS_OF, 30, LOGIN_ACTIONS), tie="event_id")
        ),
        f"WITH {AUDITS_SQL}, {LOGIN_SQL} SELECT * FROM login",
    ),
    "ips_to_enrich": (
        lambda spark, sf: E.addresses_to_enrich(users(spark, sf)),
        f"""
WITH {USERS_SQL}
SELECT DISTINCT last_login_ip FROM u WHERE last_login_ip IS NOT NULL AND last_login_city IS NULL""",
    ),
    "geo_normalize": (
        lambda spark, sf: E.normalize_locations(geo_responses(spark, sf)),
        f"WITH {LOCATIONS_SQL} SELECT ip, city, region, country_name, country_code, source FROM loc",
    ),
    "geo_fallback": (
        geo_fallback,
        f"""
WITH {LOCATIONS_SQL}
SELECT ip, city, region, country_name, country_code, source, 'bulk' AS run FROM loc
QUALIFY row_number() OVER (PARTITION BY ip ORDER BY bulk) = 1
UNION ALL
SELECT ip, city, region, country_name, country_code, source, 'sync' AS run FROM loc WHERE sync IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY ip ORDER BY sync) = 1""",
    ),
    "merge_by_ip": (located_users, f"WITH {LOCATIONS_SQL}, {LOCATED_SQL} SELECT * FROM located"),
    "geo_coverage": (
        lambda spark, sf: E.coverage(located_users(spark, sf)),
        f"""
WITH {LOCATIONS_SQL}, {LOCATED_SQL}
SELECT count(*) AS total_users, count(last_login_city) AS users_with_city,
  count(DISTINCT last_login_city) AS unique_cities, count(DISTINCT last_login_country_name) AS unique_countries
FROM located""",
    ),
    "activity_status": (
        with_status,
        f"""
WITH {USERS_SQL},
d AS (
  SELECT *, DATE '2024-02-15' - CAST(created_time AS DATE) AS signup_days,
    DATE '2024-02-15' - CAST(last_login_time AS DATE) AS login_days,
    date_sub('second', created_time, last_login_time) AS secs
  FROM u
)
SELECT * EXCLUDE (signup_days, login_days, secs), CAST(signup_days AS BIGINT) AS days_since_signup,
  CAST(login_days AS BIGINT) AS days_since_last_login, secs AS signup_to_first_login_seconds,
  round(secs / 60.0, 1) AS signup_to_first_login_minutes,
  coalesce(CAST(created_time AS DATE) = CAST(last_login_time AS DATE), FALSE) AS is_same_day_activation,
  CASE WHEN last_login_time IS NULL THEN '❌ Never Logged In' WHEN login_days = 0 THEN '🔥 Active Today'
    WHEN login_days <= 3 THEN '✅ Active (1-3 days)' WHEN login_days <= 7 THEN '👍 Active (4-7 days)'
    WHEN login_days <= 14 THEN '⚠️ At Risk (7-14 days)' WHEN login_days <= 30 THEN '😴 Dormant (14-30 days)'
    WHEN login_days <= 60 THEN '💤 Inactive (30-60 days)' ELSE '☠️ Very Inactive (60+ days)' END
    AS user_activity_status,
  CASE WHEN last_login_time IS NULL THEN 'Never Logged In' WHEN login_days <= 7 THEN 'Active'
    WHEN login_days <= 30 THEN 'Dormant' ELSE 'Inactive' END AS simple_status
FROM d""",
    ),
}
