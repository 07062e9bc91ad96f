"""Declared record shapes: landed inputs and target tables."""

from __future__ import annotations

Fields = list[tuple[str, str]]


def ddl(fields: Fields) -> str:
    """Schema text accepted by readers, ``from_json`` and ``createDataFrame``."""
    return ", ".join(f"`{name}` {kind}" for name, kind in fields)


def record(fields: Fields) -> str:
    """The same fields as a struct type."""
    return f"struct<{', '.join(f'`{name}`: {kind}' for name, kind in fields)}>"


def names(fields: Fields) -> list[str]:
    return [name for name, _ in fields]


# --- landed inputs -------------------------------------------------------------------------------------------------
# Free-form objects (tenants, OAuth, custom attributes) are read as text: the JSON reader keeps their raw form.
USER_RECORD = (
    "struct<userId:string,loginIds:array<string>,name:string,givenName:string,middleName:string,familyName:string,"
    "email:string,verifiedEmail:boolean,phone:string,verifiedPhone:boolean,roleNames:array<string>,"
    "userTenants:string,status:string,externalIds:array<string>,picture:string,test:boolean,TOTP:boolean,"
    "SAML:boolean,OAuth:string,webauthn:boolean,password:boolean,ssoAppIds:array<string>,editable:boolean,"
    "SCIM:boolean,push:boolean,permissions:array<string>,customAttributes:string,createdTime:bigint>"
)
USER_PAGE = f"page int, total bigint, users array<{USER_RECORD}>"

AUDIT_RECORD = "struct<userId:string,action:string,occurred:string,geo:string,remoteAddress:string>"
AUDIT_PAGE = f"page int, audits array<{AUDIT_RECORD}>"

EVENT = (
    "event_id bigint, event_name string, event_timestamp bigint, user_first_touch_timestamp bigint,"
    "event_params array<struct<key:string,value:struct<string_value:string,int_value:bigint>>>,"
    "traffic_source struct<source:string,medium:string,name:string>,"
    "session_traffic_source_last_click struct<cross_channel_campaign:struct<source:string,medium:string,"
    "campaign_name:string,default_channel_group:string>>,"
    "device struct<category:string,operating_system:string,operating_system_version:string,"
    "web_info:struct<browser:string,browser_version:string>>,"
    "geo struct<city:string,region:string,country:string,continent:string,metro:string>"
)

TWEET_PAGE = (
    "data array<struct<id:string,text:string,created_at:string,public_metrics:struct<retweet_count:bigint,"
    "reply_count:bigint,like_count:bigint,quote_count:bigint>>>"
)
VIDEO_SEARCH_PAGE = "items array<struct<id:struct<videoId:string>,snippet:struct<publishedAt:string>>>"
VIDEO: Fields = [
    ("id", "string"),
    ("snippet", "struct<title:string,description:string,publishedAt:string>"),
    ("statistics", "struct<viewCount:string,likeCount:string,commentCount:string>"),
]
VIDEO_PAGE = f"items array<{record(VIDEO)}>"
POST: Fields = [
    ("id", "string"),
    ("urn", "string"),
    ("author", "string"),
    ("commentary", "string"),
    ("createdAt", "bigint"),
    ("publishedAt", "bigint"),
    ("lastModifiedAt", "bigint"),
    ("created", "struct<time:bigint>"),
    ("visibility", "string"),
    ("lifecycleState", "string"),
    ("reshareContext", "map<string,string>"),
    ("specificContent", "struct<`com.linkedin.ugc.ShareContent`:struct<shareCommentary:struct<text:string>>>"),
    ("content", "struct<media:struct<id:string>,article:string,multiImage:string>"),
]
POST_PAGE = f"start bigint, paging struct<start:bigint,count:bigint>, elements array<{record(POST)}>"
POST_METADATA: Fields = [
    ("urn", "string"),
    ("commentsState", "string"),
    ("commentSummary", "struct<count:bigint,topLevelCount:bigint>"),
    ("reactionSummaries", "map<string,struct<count:bigint>>"),
]
SHORT_VIDEO = (
    "id string, `desc` string, createTime bigint,"
    "stats struct<playCount:bigint,diggCount:bigint,commentCount:bigint,shareCount:bigint>"
)
GEO_RESPONSE = "ip string, provider string, body string"
REPORT = "columnHeaders array<struct<name:string>>, rows array<array<string>>"

# --- target tables -------------------------------------------------------------------------------------------------
USERS: Fields = [
    ("user_id", "string"),
    ("login_ids", "array<string>"),
    ("display_name", "string"),
    ("given_name", "string"),
    ("middle_name", "string"),
    ("family_name", "string"),
    ("email", "string"),
    ("verified_email", "boolean"),
    ("phone", "string"),
    ("verified_phone", "boolean"),
    ("role_names", "array<string>"),
    ("user_tenants", "string"),
    ("status", "string"),
    ("external_ids", "array<string>"),
    ("picture", "string"),
    ("test", "boolean"),
    ("totp", "boolean"),
    ("saml", "boolean"),
    ("oauth", "string"),
    ("webauthn", "boolean"),
    ("password", "boolean"),
    ("sso_app_ids", "array<string>"),
    ("editable", "boolean"),
    ("scim", "boolean"),
    ("push", "boolean"),
    ("permissions", "array<string>"),
    ("custom_attributes", "string"),
    ("created_time", "timestamp"),
]
USER_LOGIN: Fields = [
    ("last_login_time", "timestamp"),
    ("last_login_country", "string"),
    ("last_login_ip", "string"),
]
USER_GEO: Fields = [
    ("last_login_city", "string"),
    ("last_login_region", "string"),
    ("last_login_country_name", "string"),
]
USER_ACTIVITY: Fields = [
    ("days_since_signup", "bigint"),
    ("days_since_last_login", "bigint"),
    ("signup_to_first_login_seconds", "bigint"),
    ("signup_to_first_login_minutes", "double"),
    ("is_same_day_activation", "boolean"),
    ("user_activity_status", "string"),
    ("simple_status", "string"),
]
# Columns the compact attribution adds to an existing users table.
USER_CLEAN_ATTRIBUTION: Fields = [
    ("traffic_source_simple", "string"),
    ("traffic_medium_simple", "string"),
    ("traffic_campaign_simple", "string"),
    ("first_page_title", "string"),
    ("first_page_path", "string"),
    ("ga_session_count", "bigint"),
    ("first_ga_session_id", "string"),
]
TWEETS: Fields = [
    ("tweet_id", "string"),
    ("text", "string"),
    ("created_at", "timestamp"),
    ("retweet_count", "bigint"),
    ("reply_count", "bigint"),
    ("like_count", "bigint"),
    ("quote_count", "bigint"),
]
VIDEOS: Fields = [
    ("video_id", "string"),
    ("title", "string"),
    ("description", "string"),
    ("published_at", "timestamp"),
    ("view_count", "bigint"),
    ("like_count", "bigint"),
    ("comment_count", "bigint"),
]
POSTS: Fields = [
    ("post_id", "string not null comment 'post URN'"),
    ("post_type", "string comment 'ugcPost or share'"),
    ("text", "string comment 'post text'"),
    ("author_urn", "string"),
    ("created_at", "timestamp"),
    ("published_at", "timestamp"),
    ("last_modified_at", "timestamp"),
    ("visibility", "string"),
    ("lifecycle_state", "string"),
    ("is_reshare", "boolean"),
    ("reshare_parent_urn", "string"),
    ("has_media", "boolean"),
    ("media_type", "string comment 'image, video, media, article, multiImage or none'"),
    ("comments_state", "string comment 'OPEN or CLOSED'"),
    ("comment_count", "bigint"),
    ("top_level_comment_count", "bigint"),
    ("reaction_like", "bigint"),
    ("reaction_celebrate", "bigint"),
    ("reaction_support", "bigint"),
    ("reaction_love", "bigint"),
    ("reaction_insightful", "bigint"),
    ("reaction_funny", "bigint"),
    ("total_reactions", "bigint"),
    ("fetched_at", "timestamp comment 'load time'"),
]
SHORT_VIDEOS: Fields = [
    ("video_id", "string"),
    ("description", "string"),
    ("created_at", "timestamp"),
    ("play_count", "bigint"),
    ("like_count", "bigint"),
    ("comment_count", "bigint"),
    ("share_count", "bigint"),
]
VIDEO_DAILY: Fields = [
    ("date", "date"),
    ("video_id", "string"),
    ("views", "bigint"),
    ("likes", "bigint"),
    ("comments", "bigint"),
    ("estimated_minutes_watched", "bigint"),
    ("average_view_duration_seconds", "bigint"),
]
VIDEO_PLAYBACK_DAILY: Fields = [
    ("date", "date"),
    ("video_id", "string"),
    ("playback_location_type", "string"),
    ("views", "bigint"),
]
VIDEO_TRAFFIC_DAILY: Fields = [
    ("date", "date"),
    ("video_id", "string"),
    ("traffic_source_type", "string"),
    ("views", "bigint"),
]
