"""Registered queries: social posts, videos, their metadata, and the merges of each platform."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from engage import schemas as S
from engage.functions.posts import media_type, reaction_columns
from engage.functions.times import millis_ts, zone_free
from engage.operators import enrich as E
from engage.operators.flatten import (
    flatten_posts,
    flatten_short_videos,
    flatten_tweets,
    flatten_videos,
    metadata_columns,
)
from engage.operators.latest import newer_than
from engage.operators.merge import merge, merge_counts
from engage.queries.inputs import AS_OF, METADATA_SQL, POSTS_SQL, micros, post_metadata, posts, table
from engage.sources.pages import source_fallback


def _text(number: Column) -> Column:
    return number.cast("string")


# --- tweets ---------------------------------------------------------------------------------------------------------
def tweet_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tweets in the landed shape; some times are missing or unreadable, some metrics are missing."""
    d = F.col("doc_id")
    hour = F.lpad(_text(d % 24), 2, "0")
    stamp = F.concat(F.lit("2024-01-"), F.lpad(_text(d % 28 + 1), 2, "0"), F.lit("T"), hour, F.lit(":30:00.250Z"))
    metrics = F.struct(
        (d % 17).alias("retweet_count"),
        F.when(d % 5 != 0, d % 19).alias("reply_count"),
        F.col("n_chars").alias("like_count"),
        (d % 3).alias("quote_count"),
    )
    return table(spark, sf_dir, "documents").select(
        _text(d).alias("id"),
        F.when(d % 15 != 0, F.col("text")).alias("text"),
        F.when(d % 12 == 0, "soon").when(d % 12 != 1, stamp).alias("created_at"),
        F.when(d % 11 != 0, metrics).alias("public_metrics"),
    )


TWEETS_SQL = """
tweet AS (
  SELECT CAST(doc_id AS VARCHAR) AS tweet_id, CASE WHEN doc_id % 15 <> 0 THEN text ELSE '' END AS text,
    TIMESTAMP '2024-01-01 00:30:00.25' + to_days(CAST(doc_id % 28 AS INTEGER)) + to_hours(doc_id % 24) AS created_at,
    CASE WHEN doc_id % 11 <> 0 THEN doc_id % 17 ELSE 0 END AS retweet_count,
    CASE WHEN doc_id % 11 <> 0 AND doc_id % 5 <> 0 THEN doc_id % 19 ELSE 0 END AS reply_count,
    CASE WHEN doc_id % 11 <> 0 THEN n_chars ELSE 0 END AS like_count,
    CASE WHEN doc_id % 11 <> 0 THEN doc_id % 3 ELSE 0 END AS quote_count
  FROM documents WHERE doc_id % 12 > 1
)"""


# --- videos ---------------------------------------------------------------------------------------------------------
def video_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Video details from conversation turns: counts as text, some of them missing or no number."""
    c, turn = F.col("conv_id"), F.col("turn")
    number = c * 10 + turn
    stamp = F.date_format(F.timestamp_seconds(number * 60 + 1704067200), "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return table(spark, sf_dir, "conversations").select(
        F.concat(F.lit("v"), _text(number)).alias("id"),
        F.struct(
            F.col("role").alias("title"),
            F.col("text").alias("description"),
            F.when(number % 9 != 0, stamp).alias("publishedAt"),
        ).alias("snippet"),
        F.struct(
            _text(F.length("text").cast("bigint") * 10).alias("viewCount"),
            F.when(turn % 2 == 0, _text(c % 50)).alias("likeCount"),
            F.when(c % 4 == 0, "off").otherwise(_text(turn)).alias("commentCount"),
        ).alias("statistics"),
    )


VIDEOS_SQL = """
video AS (
  SELECT 'v' || n AS video_id, role AS title, text AS description,
    make_timestamp((n * 60 + 1704067200) * 1000000) AS published_at, length(text) * 10 AS view_count,
    CASE WHEN turn % 2 = 0 THEN conv_id % 50 ELSE 0 END AS like_count,
    CASE WHEN conv_id % 4 = 0 THEN 0 ELSE turn END AS comment_count
  FROM (SELECT *, conv_id * 10 + turn AS n FROM conversations) WHERE n % 9 <> 0
)"""


def topk_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details of the ten newest search hits; the search also lists items without id or without details."""
    details = video_records(spark, sf_dir)
    c = F.col("conv_id")
    number = c * 10 + F.col("turn")
    search = table(spark, sf_dir, "conversations").select(
        F.struct(
            F.when(number % 5 == 0, "").when(number % 5 != 1, F.concat(F.lit("v"), _text(number))).alias("videoId")
        ).alias("id"),
        F.timestamp_seconds(number * 60 + 1704067200).alias("published"),
    )
    return zone_free(flatten_videos(E.newest_details(search, details, F.col("published"), newest=10)))


# --- short videos ---------------------------------------------------------------------------------------------------
def short_video_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    eid, k = F.col("event_id"), F.get_json_object("props", "$.k").cast("bigint")
    stats = F.struct(
        (k * 100).alias("playCount"),
        F.when(k % 3 != 0, k).alias("diggCount"),
        (k % 10).alias("commentCount"),
        (k % 7).alias("shareCount"),
    )
    return table(spark, sf_dir, "events").select(
        _text(eid).alias("id"),
        F.col("event_type").alias("desc"),
        F.when(eid % 6 != 0, F.floor(micros("ts") / 1000000)).alias("createTime"),
        F.when(eid % 8 != 0, stats).alias("stats"),
    )


# --- posts ----------------------------------------------------------------------------------------------------------


def social_posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both post shapes, with metadata by URN candidate."""
    rows = E.attach_metadata(posts(spark, sf_dir), post_metadata(spark, sf_dir))
    merged = flatten_posts(rows, v2_fallback=True, as_of=AS_OF)
    strict = flatten_posts(rows, v2_fallback=False, as_of=AS_OF)
    return zone_free(
        merged.withColumn("variant", F.lit("merged")).unionByName(strict.withColumn("variant", F.lit("strict")))
    )


CANDIDATE_SQL = """
best AS (
  SELECT post.doc_id AS post_doc, meta.*
  FROM post JOIN meta ON meta.doc_id = post.doc_id AND (
    meta.urn = coalesce(nullif(post.id, ''), post.key) OR (post.doc_id % 4 = 0 AND meta.doc_id = post.doc_id))
  QUALIFY row_number() OVER (PARTITION BY post.doc_id ORDER BY meta.rank) = 1
)"""

COUNTS_SQL = """comments_state, coalesce(comment_count, 0) AS comment_count,
  coalesce(top_level_comment_count, 0) AS top_level_comment_count, coalesce(reaction_like, 0) AS reaction_like,
  coalesce(reaction_celebrate, 0) AS reaction_celebrate, coalesce(reaction_support, 0) AS reaction_support,
  coalesce(reaction_love, 0) AS reaction_love, coalesce(reaction_insightful, 0) AS reaction_insightful,
  coalesce(reaction_funny, 0) AS reaction_funny,
  coalesce(reaction_like + reaction_celebrate + reaction_support + reaction_love + reaction_insightful + reaction_funny,
    0) AS total_reactions"""

MEDIA_SQL = """CASE WHEN post.doc_id % 5 = 0 THEN ['video', 'image', 'media'][post.doc_id % 3 + 1]
    WHEN post.doc_id % 5 = 1 THEN 'article' WHEN post.doc_id % 5 = 2 THEN 'multiImage' ELSE 'none' END"""


def _post_sql(variant: str) -> str:
    text = "text" if variant == "merged" else "CASE WHEN post.doc_id % 6 = 5 THEN '' ELSE text END"
    created = "created" if variant == "merged" else "created_strict"
    modified = "WHEN post.doc_id % 9 = 0 THEN NULL" if variant == "merged" else "WHEN post.doc_id % 9 = 0 THEN 0"
    keep = "WHERE created IS NOT NULL" if variant == "merged" else ""
    return f"""
SELECT key AS post_id, CASE WHEN contains(key, 'ugcPost') THEN 'ugcPost' ELSE 'share' END AS post_type, {text} AS text,
  'urn:li:organization:' || source AS author_urn, make_timestamp({created} * 1000) AS created_at,
  CASE WHEN post.doc_id % 8 <> 0 THEN make_timestamp((ms + 1000) * 1000) END AS published_at,
  make_timestamp((CASE {modified} ELSE ms + 2000 END) * 1000) AS last_modified_at,
  ['PUBLIC', 'CONNECTIONS'][post.doc_id % 2 + 1] AS visibility, 'PUBLISHED' AS lifecycle_state,
  post.doc_id % 7 = 0 AS is_reshare,
  CASE WHEN post.doc_id % 7 = 0 THEN 'urn:li:share:' || (post.doc_id + 1) END AS reshare_parent_urn,
  {MEDIA_SQL} <> 'none' AS has_media, {MEDIA_SQL} AS media_type, {COUNTS_SQL},
  TIMESTAMP '{AS_OF}' AS fetched_at, '{variant}' AS variant
FROM post LEFT JOIN best ON post_doc = post.doc_id {keep}"""


def urn_candidate_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = E.attach_metadata(posts(spark, sf_dir), post_metadata(spark, sf_dir))
    return rows.select(
        "doc_id", F.col("metadata.urn").alias("urn"), F.col("metadata.commentSummary.count").alias("comment_count")
    )


def requested_urns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.requested_urns(posts(spark, sf_dir))


def metadata_budget(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata for the 90 newest posts that have some, by the post's own id."""
    rows = E.attach_metadata_budgeted(posts(spark, sf_dir), post_metadata(spark, sf_dir), budget=90)
    total = reaction_columns(F.col("metadata.reactionSummaries"))["total_reactions"]
    return rows.select("doc_id", F.col("metadata.urn").alias("urn"), total.alias("total_reactions"))


def post_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A posts table in which some posts have reactions, some none and some unknown."""
    rows = flatten_posts(
        posts(spark, sf_dir).withColumn("metadata", F.lit(None).cast(S.record(S.POST_METADATA))),
        v2_fallback=True,
        as_of="2024-02-01 00:00:00",
    )
    length = F.length("text").cast("bigint")
    return rows.withColumn("total_reactions", F.when(length % 3 == 0, 0).when(length % 3 == 1, length))


def metadata_backfill(spark: SparkSession, sf_dir: str, max_calls: int | None = 90) -> DataFrame:
    rows = E.backfill_metadata(post_table(spark, sf_dir), post_metadata(spark, sf_dir), max_calls, as_of=AS_OF)
    return zone_free(rows.select("post_id", "created_at", *metadata_columns("metadata"), "fetched_at"))


def reactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = reaction_columns(F.col("reactionSummaries"))
    return post_metadata(spark, sf_dir).select("urn", *[column.alias(name) for name, column in columns.items()])


def media_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return posts(spark, sf_dir).select("doc_id", media_type().alias("media_type"))


def incremental_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Posts newer than the newest one in the table (here: one post per conversation), newest first."""
    stored = table(spark, sf_dir, "conversations").select(
        millis_ts(F.lit(1704067200000) + F.col("conv_id") * 3600000).alias("created_at")
    )
    mark = stored.agg(F.max("created_at").alias("mark")).scalar()
    landed = posts(spark, sf_dir).select("doc_id", "urn", millis_ts(F.col("createdAt"), True).alias("created_at"))
    return zone_free(newer_than(landed, "created_at", mark))


def fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One run with a filled primary source, one with an empty primary source and the narrower fallback."""
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("string").alias("id"), (F.col("doc_id") * 1000).alias("created"), "lang", "text"
    )
    narrow = docs.select("id", "created", "text")
    newest = F.col("created")
    filled = source_fallback(docs, narrow, newest, count=None).withColumn("run", F.lit("primary"))
    empty = source_fallback(docs.where(F.col("lang") == "none"), narrow, newest, count=None)
    return filled.unionByName(empty.withColumn("run", F.lit("fallback")))


# --- merges ---------------------------------------------------------------------------------------------------------
def merge_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Row counts of the tweet, video and post merges into tables that hold part of the rows already."""
    labelled = table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("tweet_id"))
    tweets = flatten_tweets(tweet_records(spark, sf_dir))
    videos = flatten_videos(video_records(spark, sf_dir))
    merged_posts = flatten_posts(E.attach_metadata(posts(spark, sf_dir), post_metadata(spark, sf_dir)), as_of=AS_OF)
    stored = {
        "tweets": _empty_but(tweets, labelled),
        "videos": _empty_but(videos, videos.where(F.col("title") == "user").select("video_id")),
        "posts": _empty_but(merged_posts, post_metadata(spark, sf_dir).select(F.col("urn").alias("post_id"))),
    }
    sources = {"tweets": (tweets, "tweet_id"), "videos": (videos, "video_id"), "posts": (merged_posts, "post_id")}
    counts = []
    for platform, (source, key) in sources.items():
        merged = merge(stored[platform], source, key, update=source.columns[1:], action=True)
        counts.append(merge_counts(merged).withColumn("platform", F.lit(platform)))
    return reduce(DataFrame.unionByName, counts)


def _empty_but(like: DataFrame, keys: DataFrame) -> DataFrame:
    """A table with the columns of ``like`` in which only the key is filled."""
    name = keys.columns[0]
    return keys.select(
        *[F.col(name) if f.name == name else F.lit(None).cast(f.dataType).alias(f.name) for f in like.schema.fields]
    )


def _merge_count_sql(platform: str, stored: str, source: str) -> str:
    return f"""
SELECT '{platform}' AS platform, count(*) FILTER (t IS NULL) AS inserted,
  count(*) FILTER (t IS NOT NULL AND s IS NOT NULL) AS updated, count(*) FILTER (s IS NULL) AS kept,
  count(*) FILTER (s IS NOT NULL) AS affected
FROM (SELECT {stored}) a(t) FULL JOIN (SELECT {source}) b(s) ON t = s"""


def _backfill_sql(limit: str) -> str:
    return f"""
WITH {POSTS_SQL}, {METADATA_SQL},
stored AS (
  SELECT key AS post_id, make_timestamp(created * 1000) AS created_at,
    CASE length(text) % 3 WHEN 0 THEN 0 WHEN 1 THEN length(text) END AS total
  FROM post WHERE created IS NOT NULL
),
missing AS (
  SELECT post_id FROM stored WHERE total = 0 OR total IS NULL
  {limit}
),
fill AS (SELECT * FROM meta WHERE urn IN (SELECT post_id FROM missing))
SELECT post_id, created_at, comments_state, coalesce(comment_count, 0) AS comment_count,
  coalesce(top_level_comment_count, 0) AS top_level_comment_count, coalesce(reaction_like, 0) AS reaction_like,
  coalesce(reaction_celebrate, 0) AS reaction_celebrate, coalesce(reaction_support, 0) AS reaction_support,
  coalesce(reaction_love, 0) AS reaction_love, coalesce(reaction_insightful, 0) AS reaction_insightful,
  coalesce(reaction_funny, 0) AS reaction_funny,
  CASE WHEN urn IS NULL THEN total ELSE reaction_like + reaction_celebrate + reaction_support + reaction_love
    + reaction_insightful + reaction_funny END AS total_reactions,
  CASE WHEN urn IS NULL THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '{AS_OF}' END AS fetched_at
FROM stored LEFT JOIN fill ON urn = post_id"""


QUERIES = {
    "social_tweets": (
        lambda spark, sf: zone_free(flatten_tweets(tweet_records(spark, sf))),
        f"WITH {TWEETS_SQL} SELECT * FROM tweet",
    ),
    "social_videos": (
        lambda spark, sf: zone_free(flatten_videos(video_records(spark, sf))),
        f"WITH {VIDEOS_SQL} SELECT * FROM video",
    ),
    "topk_lookup": (
        topk_lookup,
        f"""
WITH {VIDEOS_SQL}
SELECT * FROM video WHERE video_id IN (
  SELECT 'v' || (conv_id * 10 + turn) FROM conversations WHERE (conv_id * 10 + turn) % 5 > 1
  ORDER BY conv_id * 10 + turn DESC LIMIT 10)""",
    ),
    "social_tiktok": (
        lambda spark, sf: zone_free(flatten_short_videos(short_video_records(spark, sf))),
        """
SELECT CAST(event_id AS VARCHAR) AS video_id, event_type AS description,
  make_timestamp(epoch_us(ts) // 1000000 * 1000000) AS created_at,
  CASE WHEN event_id % 8 <> 0 THEN k * 100 ELSE 0 END AS play_count,
  CASE WHEN event_id % 8 <> 0 AND k % 3 <> 0 THEN k ELSE 0 END AS like_count,
  CASE WHEN event_id % 8 <> 0 THEN k % 10 ELSE 0 END AS comment_count,
  CASE WHEN event_id % 8 <> 0 THEN k % 7 ELSE 0 END AS share_count
FROM (SELECT *, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) WHERE event_id % 6 <> 0""",
    ),
    "social_posts": (
        social_posts,
        f"WITH {POSTS_SQL}, {METADATA_SQL}, {CANDIDATE_SQL} {_post_sql('merged')} UNION ALL {_post_sql('strict')}",
    ),
    "urn_candidates": (
        requested_urns,
        f"""
WITH {POSTS_SQL}
SELECT DISTINCT urn, replace(urn, ':', '%3A') AS encoded
FROM (
  SELECT unnest(CASE WHEN doc_id % 4 = 0 THEN ['urn:li:ugcPost:' || key, 'urn:li:share:' || key] ELSE [key] END) AS urn
  FROM post
)""",
    ),
    "urn_candidate_join": (
        urn_candidate_join,
        f"""
WITH {POSTS_SQL}, {METADATA_SQL}, {CANDIDATE_SQL}
SELECT post.doc_id, urn, comment_count FROM post LEFT JOIN best ON post_doc = post.doc_id""",
    ),
    "metadata_budget": (
        metadata_budget,
        f"""
WITH {POSTS_SQL}, {METADATA_SQL},
hit AS (SELECT post.doc_id AS post_doc, post.id, post.created_strict, meta.* FROM post JOIN meta ON meta.urn = post.id),
served AS (SELECT * FROM hit ORDER BY created_strict DESC NULLS LAST, id LIMIT 90)
SELECT post.doc_id, urn,
  coalesce(reaction_like + reaction_celebrate + reaction_support + reaction_love + reaction_insightful
    + reaction_funny, 0) AS total_reactions
FROM post LEFT JOIN served ON post_doc = post.doc_id""",
    ),
    "metadata_backfill": (metadata_backfill, _backfill_sql("ORDER BY created_at DESC NULLS LAST, post_id LIMIT 90")),
    "metadata_backfill_all": (lambda spark, sf: metadata_backfill(spark, sf, None), _backfill_sql("")),
    "reactions": (
        reactions,
        f"""
WITH {METADATA_SQL}
SELECT urn, reaction_like, reaction_celebrate, reaction_support, reaction_love, reaction_insightful, reaction_funny,
  reaction_like + reaction_celebrate + reaction_support + reaction_love + reaction_insightful + reaction_funny
    AS total_reactions
FROM meta""",
    ),
    "media_type": (media_types, f"WITH {POSTS_SQL} SELECT doc_id, {MEDIA_SQL} AS media_type FROM post"),
    "incremental_append": (
        incremental_append,
        f"""
WITH {POSTS_SQL}
SELECT doc_id, key AS urn, make_timestamp(nullif(created_strict, 0) * 1000) AS created_at
FROM post, (SELECT max(1704067200000 + conv_id * 3600000) AS mark FROM conversations)
WHERE nullif(created_strict, 0) IS NULL OR created_strict > mark""",
    ),
    "source_fallback": (
        fallback,
        """
SELECT CAST(doc_id AS VARCHAR) AS id, doc_id * 1000 AS created, lang, text, 'primary' AS run FROM documents
UNION ALL
SELECT CAST(doc_id AS VARCHAR), doc_id * 1000, NULL, text, 'fallback' FROM documents""",
    ),
    "social_merge_all": (
        merge_all,
        f"""
WITH {TWEETS_SQL}, {VIDEOS_SQL}, {POSTS_SQL}, {METADATA_SQL}
{_merge_count_sql("tweets", "CAST(doc_id AS VARCHAR) FROM labels", "tweet_id FROM tweet")}
UNION ALL
{_merge_count_sql("videos", "video_id FROM video WHERE title = 'user'", "video_id FROM video")}
UNION ALL
{_merge_count_sql("posts", "urn FROM meta", "key FROM post WHERE created IS NOT NULL")}""",
    ),
}
