"""Nested source records to flat table rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from engage.functions.counts import or_zero, text_count
from engage.functions.posts import media_type, post_key, reaction_columns
from engage.functions.times import as_instant, iso_ts, millis_ts, seconds_ts

# Users column -> field of the user record.
USER_FIELDS = {
    "user_id": "userId",
    "login_ids": "loginIds",
    "display_name": "name",
    "given_name": "givenName",
    "middle_name": "middleName",
    "family_name": "familyName",
    "email": "email",
    "verified_email": "verifiedEmail",
    "phone": "phone",
    "verified_phone": "verifiedPhone",
    "role_names": "roleNames",
    "user_tenants": "userTenants",
    "status": "status",
    "external_ids": "externalIds",
    "picture": "picture",
    "test": "test",
    "totp": "TOTP",
    "saml": "SAML",
    "oauth": "OAuth",
    "webauthn": "webauthn",
    "password": "password",
    "sso_app_ids": "ssoAppIds",
    "editable": "editable",
    "scim": "SCIM",
    "push": "push",
    "permissions": "permissions",
    "custom_attributes": "customAttributes",
}
USER_LISTS = ["login_ids", "role_names", "external_ids", "sso_app_ids", "permissions"]
# JSON text used where a free-form field is missing.
USER_JSON_DEFAULTS = {"user_tenants": "[]", "oauth": "{}", "custom_attributes": "{}"}


def flatten_users(records: DataFrame) -> DataFrame:
    """The 28 identity columns. Missing lists become empty, missing objects become empty JSON text.

    A typed read cannot tell an explicit null from an absent field, so both take the default. Free-form fields that are nested
    records are written as JSON text; those that are text already are taken as they are.
    """
    kinds = dict(records.dtypes)
    out: list[Column] = []
    for name, field in USER_FIELDS.items():
        value = F.col(field)
        if name in USER_LISTS:
            value = F.coalesce(value, F.array().cast("array<string>"))
        elif name in USER_JSON_DEFAULTS:
            text = value if kinds[field] == "string" else F.to_json(value, {"ignoreNullFields": "false"})
            value = F.coalesce(text, F.lit(USER_JSON_DEFAULTS[name]))
        out.append(value.alias(name))
    return records.select(*out, seconds_ts(F.col("createdTime")).alias("created_time"))


def flatten_tweets(records: DataFrame) -> DataFrame:
    """Rows without a readable time are dropped; missing metrics are 0."""
    metrics = ["retweet_count", "reply_count", "like_count", "quote_count"]
    return records.select(
        F.col("id").alias("tweet_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        iso_ts(F.col("created_at")).alias("created_at"),
        *[or_zero(F.col(f"public_metrics.{name}")).alias(name) for name in metrics],
    ).where(F.col("created_at").isNotNull())


def flatten_videos(records: DataFrame) -> DataFrame:
    """Counts arrive as text; rows without a readable time are dropped."""
    counts = {"view_count": "viewCount", "like_count": "likeCount", "comment_count": "commentCount"}
    return records.select(
        F.col("id").alias("video_id"),
        F.col("snippet.title").alias("title"),
        F.col("snippet.description").alias("description"),
        iso_ts(F.col("snippet.publishedAt")).alias("published_at"),
        *[text_count(F.col(f"statistics.{field}")).alias(name) for name, field in counts.items()],
    ).where(F.col("published_at").isNotNull())


def flatten_short_videos(records: DataFrame) -> DataFrame:
    """Short videos; rows without a time are dropped."""
    counts = {
        "play_count": "playCount",
        "like_count": "diggCount",
        "comment_count": "commentCount",
        "share_count": "shareCount",
    }
    return records.select(
        F.col("id").alias("video_id"),
        F.col("desc").alias("description"),
        F.timestamp_seconds("createTime").alias("created_at"),
        *[or_zero(F.col(f"stats.{field}")).alias(name) for name, field in counts.items()],
    ).where(F.col("created_at").isNotNull())


def metadata_columns(metadata: str) -> dict[str, Column]:
    """The ten metadata columns of a post, from a struct column holding its metadata record (null when unknown)."""
    return {
        "comments_state": F.col(f"{metadata}.commentsState"),
        "comment_count": or_zero(F.col(f"{metadata}.commentSummary.count")),
        "top_level_comment_count": or_zero(F.col(f"{metadata}.commentSummary.topLevelCount")),
        **reaction_columns(F.col(f"{metadata}.reactionSummaries")),
    }


def flatten_posts(
    records: DataFrame,
    metadata: str = "metadata",
    v2_fallback: bool = True,
    as_of: dt.datetime | str | None = None,
) -> DataFrame:
    """The 24 post columns.

    ``v2_fallback`` also reads the older record shape (nested text, ``created.time``), takes 0 for a missing time and
    drops rows without creation time; without it the post is taken as it is.
    """
    key = post_key(F.col("id"), F.col("urn"))
    text, created = F.col("commentary"), F.col("createdAt")
    if v2_fallback:
        nested = F.col("specificContent").getField("com.linkedin.ugc.ShareContent")
        text = F.coalesce(text, nested["shareCommentary"]["text"])
        created = F.coalesce(F.nullif(created, F.lit(0)), F.col("created.time"))
    reshare = F.coalesce(F.size("reshareContext") > 0, F.lit(False))
    kind = media_type()
    out = {
        "post_id": key,
        "post_type": F.when(key.contains("ugcPost"), "ugcPost").otherwise("share"),
        "text": F.coalesce(text, F.lit("")),
        "author_urn": F.col("author"),
        "created_at": millis_ts(created, zero_is_missing=v2_fallback),
        "published_at": millis_ts(F.col("publishedAt"), zero_is_missing=v2_fallback),
        "last_modified_at": millis_ts(F.col("lastModifiedAt"), zero_is_missing=v2_fallback),
        "visibility": F.col("visibility"),
        "lifecycle_state": F.col("lifecycleState"),
        "is_reshare": reshare,
        "reshare_parent_urn": F.when(reshare, F.try_element_at("reshareContext", F.lit("parent"))),
        "has_media": kind != "none",
        "media_type": kind,
        **metadata_columns(metadata),
        "fetched_at": as_instant(as_of),
    }
    rows = records.select(*[column.alias(name) for name, column in out.items()])
    return rows.where(F.col("created_at").isNotNull()) if v2_fallback else rows
