"""The batch jobs: daily user sync, attribution, social ingest, posts, metadata back-fill and daily reports."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from engage import schemas as S
from engage.functions.times import millis_ts
from engage.operators import attribution as A
from engage.operators import attribution_state as AS
from engage.operators import enrich as E
from engage.operators.activity import activity_status
from engage.operators.flatten import flatten_posts, flatten_short_videos, flatten_tweets, flatten_users, flatten_videos
from engage.operators.latest import last_login, modified_since, newer_than, recent_logins, watermark
from engage.operators.ranges import locate_by_ranges, with_bounds
from engage.operators.reports import unpack_report
from engage.plans.steps import Table, optional, required, stage, staged_source, staging, update, updated, upsert, upserted
from engage.sources.bucketed import BucketedTable, ddl_of
from engage.sources.pages import audit_records, post_records, records, source_fallback, user_records
from engage.sources.tables import SnapshotTable, append, evolve, replace_table_days

AsOf = dt.datetime | str | None


# --- users ----------------------------------------------------------------------------------------------------------
def modified_users(users: DataFrame, pages: DataFrame, modified_ms: str | None = None) -> DataFrame:
    """Flat rows of the landed user pages.

    With ``modified_ms`` (a field of the records) only users modified since the table's newest ``created_time`` are
    taken; otherwise the landing is trusted to hold the increment.
    """
    found = user_records(pages)
    if modified_ms is not None:
        found = modified_since(found, watermark(users), modified_ms)
    return flatten_users(found)


def new_locations(
    users: DataFrame,
    responses: DataFrame,
    order: list[str],
    limit: int | None = None,
    force: bool = False,
    ranges: DataFrame | None = None,
) -> DataFrame:
    """Best location per address that users still lack; a ``limit`` counts addresses that have one.

    ``ranges`` (``network``, or ``first`` and ``last``, and the location columns) locates addresses that no provider located.
    """
    wanted = E.addresses_to_enrich(users, force=force)
    relevant = responses.join(wanted, responses["ip"] == wanted["last_login_ip"], "left_semi")
    found = E.normalize_locations(relevant)
    if ranges is not None:
        found, order = found.unionByName(locate_by_ranges(wanted, with_bounds(ranges))), [*order, "ranges"]
    best = E.first_location(found, order)
    return best if limit is None else best.orderBy("ip").limit(limit)


def logins_of(audit_pages: DataFrame, as_of: AsOf = None) -> DataFrame:
    """Last login per user; of equal times the one read first."""
    return last_login(recent_logins(audit_records(audit_pages), as_of), tie="place")


def with_activity(users: DataFrame, as_of: AsOf = None) -> DataFrame:
    return activity_status(evolve(users.drop(*S.names(S.USER_ACTIVITY)), S.USER_LOGIN), as_of)


def sync_users(users: Table, pages: DataFrame, modified_ms: str | None = None) -> int:
    users.create(S.ddl(S.USERS))
    return upsert(users, modified_users(users.read(), pages, modified_ms), "user_id")


def update_logins(users: Table, pages: DataFrame, as_of: AsOf = None) -> int:
    return update(users, logins_of(pages, as_of), "user_id")


def update_locations(
    users: Table,
    responses: DataFrame,
    order: list[str] = E.BULK_ORDER,
    limit: int | None = None,
    force: bool = False,
    ranges: DataFrame | None = None,
) -> int:
    """Locations of the addresses that lack one (``force``: of all addresses), copied to every user of the address."""
    with staging():
        base = users.head() if isinstance(users, BucketedTable) else users.state()
        known = evolve(users.read(), [*S.USER_LOGIN, *S.USER_GEO])
        best, located = staged_source(new_locations(known, responses, order, limit, force, ranges), "locations")
        if not located:
            return 0
        if isinstance(users, BucketedTable):
            # A scan of keys and addresses tells which buckets hold users of the addresses.
            held = known.select(base.key, "last_login_ip").join(best.select(F.col("ip").alias("last_login_ip")), "last_login_ip", "left_semi")
            fields = [*S.USER_LOGIN, *S.USER_GEO]
            users.mutate_buckets(lambda rows: E.locate_users(evolve(rows, fields), best), users.touched(base, held.select(base.key)), base)
        else:
            users.replace(E.locate_users(known, best), base=base)
        return located


def update_activity(users: SnapshotTable, as_of: AsOf = None) -> int:
    users.mutate(lambda rows: with_activity(rows, as_of))
    return users.count()


def run_daily(
    users: SnapshotTable,
    user_pages: DataFrame,
    audit_pages: DataFrame,
    responses: DataFrame,
    as_of: AsOf = None,
    modified_ms: str | None = None,
) -> dict:
    """Daily sync: users, last logins, locations and activity. Only the user sync is fatal; attribution is its own job
    and always counts 0 here.

    What each step brings is staged on its own, so a failing source costs only its step. The steps themselves are
    functions of the users rows and end in a single rewrite of the table.
    """
    with staging():
        return _run_daily(users, user_pages, audit_pages, responses, as_of, modified_ms)


def _run_daily(
    users: SnapshotTable,
    user_pages: DataFrame,
    audit_pages: DataFrame,
    responses: DataFrame,
    as_of: AsOf,
    modified_ms: str | None,
) -> dict:
    errors: dict[str, str] = {}
    users.create(S.ddl(S.USERS))
    base = users.state()
    source, synced = staged_source(modified_users(users.read(), user_pages, modified_ms), "users")
    rows = upserted(users.read(), source, synced, "user_id")

    def logins() -> int:
        nonlocal rows
        latest, found = staged_source(logins_of(audit_pages, as_of), "logins")
        rows = updated(rows, latest, "user_id") if found else rows
        return found

    def locations() -> int:
        nonlocal rows
        known = evolve(rows, [*S.USER_LOGIN, *S.USER_GEO])
        best, found = staged_source(new_locations(known, responses, E.SYNC_ORDER), "locations")
        rows = E.locate_users(known, best) if found else known
        return found

    # Names of the results.
    result = {
        "success": True,
        "users_synced": synced,
        "locations_updated": optional(logins, "logins", errors),
        "ips_enriched": optional(locations, "locations", errors),
        "attribution_enriched": 0,
    }
    users.replace(with_activity(rows, as_of), base=base)
    return {**result, "activity_status_updated": users.count(), "errors": errors}


def run_daily_buckets(
    users: BucketedTable,
    user_pages: DataFrame,
    audit_pages: DataFrame,
    responses: DataFrame,
    as_of: AsOf = None,
    modified_ms: str | None = None,
) -> dict:
    """The daily sync of a table in buckets of the user: it costs what has changed.

    Users, logins and locations are one commit each, which rewrites the buckets of the users they concern; only the user sync is fatal.
    Activity labels change with the date for every user, so they are not stored: ``with_activity(users.read(), as_of)`` gives them.
    """
    errors: dict[str, str] = {}
    synced = sync_users(users, user_pages, modified_ms)
    return {
        "success": True,
        "users_synced": synced,
        "locations_updated": optional(lambda: update_logins(users, audit_pages, as_of), "logins", errors),
        "ips_enriched": optional(lambda: update_locations(users, responses, E.SYNC_ORDER), "locations", errors),
        "attribution_enriched": 0,
        "activity_status_updated": 0,
        "errors": errors,
    }


# --- attribution ----------------------------------------------------------------------------------------------------
def run_attribution(users: Table, events: DataFrame, names: A.EventNames = A.EventNames()) -> int:
    rollup = A.attribution_full(A.flatten_events(events, names))
    return update(users, A.with_product_names(rollup, names), "user_id")


def run_attribution_increment(
    users: Table, state: BucketedTable, events: DataFrame, shard: str = "dt", names: A.EventNames = A.EventNames()
) -> int:
    """Attribution of the users in event shards that the state has not taken in yet; returns how many they are.

    The state's note names its newest shard, and only later shards are read: a shard must be complete when it is taken in. The users table
    is updated from the new state before that is committed, so a job that dies between the two does the same again.
    """
    state.create(ddl_of(AS.slice_state(A.flatten_events(events, names))))
    base = state.head()
    fresh = events if base.note is None else events.where(F.col(shard).cast("string") > base.note)
    newest = fresh.agg(F.max(F.col(shard).cast("string"))).first()[0]
    if newest is None:
        return 0
    with staging():
        part = stage(AS.slice_state(A.flatten_events(fresh, names)), "slice")
        concerned = part.where(F.col(AS.SESSION).isNull()).select(AS.KEY)
        buckets = state.touched(base, concerned)
        written = state.write(base, AS.combine(state.read(base, buckets), part))
        folders = [f"{state.path}/{folder}" for folder in written.values()]
        enriched = 0
        if folders:
            rows = users.spark.read.schema(base.schema).parquet(*folders)
            rollup = A.with_product_names(AS.finish(rows).join(concerned.distinct(), AS.KEY, "left_semi"), names)
            enriched = update(users, rollup, "user_id")
        state.commit(base, written, buckets, None, note=newest)
        return enriched


@dataclass
class CleanAttribution:
    users: int
    sample: DataFrame | None = None
    summary: DataFrame | None = None


def run_attribution_clean(
    users: SnapshotTable,
    events: DataFrame,
    names: A.EventNames = A.EventNames(),
    dry_run: bool = False,
    limit: int | None = None,
    as_of: AsOf = None,
) -> CleanAttribution:
    """Compact attribution and its channel summary; a dry run only returns a sample."""
    rollup = A.with_product_names(A.attribution_clean(A.flatten_events_clean(events, names)), names)
    if dry_run:
        return CleanAttribution(0, sample=A.preview(rollup, limit))
    enriched = update(users, rollup if limit is None else rollup.limit(limit), "user_id")
    return CleanAttribution(enriched, summary=A.channel_summary(users.read(), as_of) if enriched else None)


# --- social ---------------------------------------------------------------------------------------------------------
@dataclass
class SocialTables:
    tweets: SnapshotTable
    videos: SnapshotTable
    posts: SnapshotTable
    short_videos: str


@dataclass
class SocialLanding:
    """Landed responses; any of them may be missing."""

    tweets: DataFrame | None = None
    video_search: DataFrame | None = None
    video_details: DataFrame | None = None
    posts: DataFrame | None = None
    posts_v2: DataFrame | None = None
    metadata: DataFrame | None = None
    short_videos: DataFrame | None = None


def without_metadata(posts: DataFrame) -> DataFrame:
    return posts.withColumn("metadata", F.lit(None).cast(S.record(S.POST_METADATA)))


def run_social(tables: SocialTables, landing: SocialLanding, as_of: AsOf = None) -> dict:
    """Ingest each platform on its own: a failing platform counts 0 and the others go on.

    Everything landed is taken. Posts come from the older source where the newer one is absent or empty, and are stored without
    reactions where no metadata has landed.
    """
    with staging():
        return _run_social(tables, landing, as_of)


def _run_social(tables: SocialTables, landing: SocialLanding, as_of: AsOf) -> dict:
    errors: dict[str, str] = {}

    def tweets() -> int:
        tables.tweets.create(S.ddl(S.TWEETS))
        return upsert(tables.tweets, flatten_tweets(records(landing.tweets, "data")), "tweet_id")

    def videos() -> int:
        tables.videos.create(S.ddl(S.VIDEOS))
        search, details = records(landing.video_search, "items"), landing.video_details
        if details is None:
            raise ValueError("video search has landed without video details")
        hits = search.where(F.col("id.videoId") != "").select(F.col("id.videoId").alias("id"))
        found = records(details, "items").join(hits, "id", "left_semi")
        return upsert(tables.videos, flatten_videos(found), "video_id")

    def posts() -> int:
        tables.posts.create(S.ddl(S.POSTS))
        older = None if landing.posts_v2 is None else records(landing.posts_v2, "elements")
        found = older if landing.posts is None else post_records(landing.posts)
        if landing.posts is not None and older is not None:
            found = source_fallback(found, older, F.col("created.time"))
        known = without_metadata(found) if landing.metadata is None else E.attach_metadata(found, landing.metadata)
        return upsert(tables.posts, flatten_posts(known, as_of=as_of), "post_id")

    def short_videos() -> int:
        rows = stage(flatten_short_videos(landing.short_videos), "short-videos")
        append(rows, tables.short_videos)
        return rows.count()

    steps = {
        "tweets": (landing.tweets, tweets),
        "videos": (landing.video_search, videos),
        "posts": (landing.posts if landing.posts is not None else landing.posts_v2, posts),
        "short_videos": (landing.short_videos, short_videos),
    }
    result = {name: optional(step, name, errors) if given is not None else 0 for name, (given, step) in steps.items()}
    return {**result, "total": sum(result.values()), "errors": errors}


def run_posts(
    posts: SnapshotTable,
    pages: DataFrame,
    metadata: DataFrame | None,
    mode: str = "incremental",
    max_posts: int | None = None,
    max_metadata_calls: int | None = None,
    as_of: AsOf = None,
) -> dict:
    """Append new posts (``incremental``) or reload all of them (``full``: the old rows stay until the new ones are written)."""
    if mode not in ("incremental", "full"):
        raise ValueError(f"unknown mode {mode}")
    posts.create(S.ddl(S.POSTS))
    mark = None
    if mode == "incremental":
        newest = posts.read().agg(F.max("created_at").alias("mark")).first()["mark"]
        mark = None if newest is None else F.lit(newest)
    found = post_records(pages).withColumn("__created", millis_ts(F.col("createdAt")))
    found = newer_than(found, "__created", mark, newest=max_posts, tie="id").drop("__created")
    if metadata is None:
        found = without_metadata(found)
    else:
        found = E.attach_metadata_budgeted(found, metadata, max_metadata_calls)
    with staging():
        rows = stage(required(flatten_posts(found, v2_fallback=False, as_of=as_of), "post_id"), "posts")
        processed = rows.count()
        if mode == "full":
            posts.reload(rows)
        elif processed:
            posts.append(rows)
    return {"mode": mode, "posts_processed": processed, "total_rows": posts.count()}


def run_backfill(posts: SnapshotTable, metadata: DataFrame, max_calls: int | None = None, as_of: AsOf = None) -> int:
    """Back-fill metadata in one statement; returns the number of updated posts."""
    with staging():
        source = stage(E.backfill_rows(posts.read(), metadata, max_calls, as_of), "backfill")
        updated = source.count()
        if updated:
            posts.mutate(lambda rows: E.apply_backfill(rows, source))
        return updated


# --- reports --------------------------------------------------------------------------------------------------------
def run_reports(
    daily: DataFrame,
    playback: DataFrame | None,
    traffic: DataFrame | None,
    tables: dict[str, str],
    only_append: bool = False,
) -> dict:
    """Load the landed reports into their tables; the two breakdowns are optional and may fail.

    The days of a report replace those of the table, so that a second run changes nothing; ``only_append`` adds them instead.
    """
    errors: dict[str, str] = {}

    def load(report: DataFrame, name: str, breakdown: str | None = None) -> int:
        rows = stage(unpack_report(report, breakdown=breakdown), "report")
        count = rows.count()
        if count and only_append:
            append(rows, tables[name])
        elif count:
            replace_table_days(rows, tables[name])
        return count

    with staging():
        result = {"daily": load(daily, "daily")}
        for name, report, breakdown in (
            ("playback", playback, "playbackLocationType"),
            ("traffic", traffic, "insightTrafficSourceType"),
        ):
            given = report is not None
            result[name] = optional(lambda: load(report, name, breakdown), name, errors) if given else 0
    return {**result, "errors": errors}
