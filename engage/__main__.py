"""Command line for the jobs: ``spark-submit`` or ``python -m engage <job> ...``.

Tables are names in the session's catalog (a persistent metastore, as set in the Spark defaults); landed inputs are
folders of newline-delimited JSON pages.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

from engage import schemas as S
from engage.operators import enrich as E
from engage.operators.attribution import EventNames
from engage.plans import jobs
from engage.plans.steps import landed_rows, staging
from engage.session import build_session
from engage.sources.bucketed import BUCKETS, BucketedTable
from engage.sources.landed import read_event_shards, read_ndjson
from engage.sources.pages import AUDIT_PAGE_SIZE, USER_PAGE_SIZE, scan_offset_pages, scan_pages
from engage.sources.tables import SnapshotTable, evolve


def _landed(spark: SparkSession, args: argparse.Namespace, path: str | None, schema: str) -> DataFrame | None:
    if path is None or args.dead_letters is None:
        return None if path is None else read_ndjson(spark, path, schema)
    return landed_rows(spark, path, schema, args.dead_letters, args.most_bad)


def _users(spark: SparkSession, args: argparse.Namespace) -> jobs.Table:
    return BucketedTable(spark, args.users_path, "user_id", args.buckets) if args.users_path else SnapshotTable(spark, args.users)


def sync(spark: SparkSession, args: argparse.Namespace) -> None:
    users = _users(spark, args)
    pages = _landed(spark, args, args.user_pages, S.USER_PAGE)
    audits = _landed(spark, args, args.audit_pages, S.AUDIT_PAGE)
    responses = _landed(spark, args, args.responses, S.GEO_RESPONSE)
    if args.page_rules:
        pages = scan_pages(pages, "users", USER_PAGE_SIZE, total="total", gaps=False)
        audits = scan_pages(audits, "audits", AUDIT_PAGE_SIZE, last_page=args.last_audit_page, gaps=False)
    run = jobs.run_daily_buckets if args.users_path else jobs.run_daily
    print(run(users, pages, audits, responses, args.as_of, args.modified_ms))


def locations(spark: SparkSession, args: argparse.Namespace) -> None:
    users = _users(spark, args)
    responses = _landed(spark, args, args.responses, S.GEO_RESPONSE)
    ranges = spark.table(args.ranges) if args.ranges else None
    print("addresses located:", jobs.update_locations(users, responses, force=args.force, ranges=ranges))
    E.coverage(users.read()).show()


def attribution(spark: SparkSession, args: argparse.Namespace) -> None:
    users = _users(spark, args)
    if args.add_schema:
        users.mutate(lambda rows: evolve(rows, S.USER_CLEAN_ATTRIBUTION))
        return
    names = EventNames(args.event_name, args.user_key, args.product_prefix)
    events = read_event_shards(spark, args.events, args.start, args.end)
    if args.state:
        state = BucketedTable(spark, args.state, "user_id", args.buckets)
        print("users enriched:", jobs.run_attribution_increment(users, state, events, names=names))
        return
    if not args.clean:
        print("users enriched:", jobs.run_attribution(users, events, names))
        return
    done = jobs.run_attribution_clean(users, events, names, args.dry_run, args.limit, args.as_of)
    if done.sample is not None:
        done.sample.show(vertical=True, truncate=False)
        return
    print("users enriched:", done.users)
    if done.summary is not None:
        done.summary.show(truncate=False)


def social(spark: SparkSession, args: argparse.Namespace) -> None:
    tables = jobs.SocialTables(
        SnapshotTable(spark, args.tweets_table),
        SnapshotTable(spark, args.videos_table),
        SnapshotTable(spark, args.posts_table),
        args.short_videos_table,
    )
    landing = jobs.SocialLanding(
        tweets=_landed(spark, args, args.tweets, S.TWEET_PAGE),
        video_search=_landed(spark, args, args.video_search, S.VIDEO_SEARCH_PAGE),
        video_details=_landed(spark, args, args.video_details, S.VIDEO_PAGE),
        posts=_landed(spark, args, args.posts, S.POST_PAGE),
        posts_v2=_landed(spark, args, args.posts_v2, S.POST_PAGE),
        metadata=_landed(spark, args, args.metadata, S.ddl(S.POST_METADATA)),
        short_videos=_landed(spark, args, args.short_videos, S.SHORT_VIDEO),
    )
    print(jobs.run_social(tables, landing, args.as_of))


def posts(spark: SparkSession, args: argparse.Namespace) -> None:
    table = SnapshotTable(spark, args.table)
    metadata = None if args.no_metadata else _landed(spark, args, args.metadata, S.ddl(S.POST_METADATA))
    if args.update_metadata:
        print("posts updated:", jobs.run_backfill(table, metadata, args.update_limit, args.as_of))
        return
    pages = _landed(spark, args, args.pages, S.POST_PAGE)
    if args.page_rules:
        pages = scan_offset_pages(pages)
    print(jobs.run_posts(table, pages, metadata, args.mode, args.max_posts, args.max_metadata_calls, args.as_of))


def reports(spark: SparkSession, args: argparse.Namespace) -> None:
    tables = {"daily": args.daily_table, "playback": args.playback_table, "traffic": args.traffic_table}
    landed = [_landed(spark, args, path, S.REPORT) for path in (args.daily, args.playback, args.traffic)]
    print(jobs.run_reports(*landed, tables))


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="engage", description=__doc__.splitlines()[0])
    top.add_argument("--as-of", help="reference time of the run (default: now)")
    top.add_argument("--dead-letters", help="folder for landed lines that cannot be read; without it the first one stops the job")
    top.add_argument("--most-bad", type=float, default=0.01, help="share of such lines above which the job stops all the same")
    commands = top.add_subparsers(required=True)

    def command(run, help_text: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(run.__name__, help=help_text)
        sub.set_defaults(run=run)
        return sub

    def users_of(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--users", default="users")
        sub.add_argument("--users-path", help="folder of a users table in buckets, of which a run rewrites only what changed")
        sub.add_argument("--buckets", type=int, default=BUCKETS, help="buckets of a table that this run makes")

    sub = command(sync, "daily user sync")
    users_of(sub)
    for name in ("--user-pages", "--audit-pages", "--responses"):
        sub.add_argument(name, required=True)
    sub.add_argument("--page-rules", action="store_true", help="take pages only up to where the scan ends: a short or missing page, or the total")
    sub.add_argument("--last-audit-page", type=int)
    sub.add_argument("--modified-ms", help="field of the user records: take only users modified since the newest in the table")

    sub = command(locations, "bulk location enrichment and its coverage")
    users_of(sub)
    sub.add_argument("--responses", required=True)
    sub.add_argument("--force", action="store_true", help="locate all addresses again")
    sub.add_argument("--ranges", help="table of networks with their location, for addresses that no provider located")

    sub = command(attribution, "marketing attribution and engagement")
    users_of(sub)
    sub.add_argument("--state", help="folder of the attribution state: only shards it has not taken in are read")
    sub.add_argument("--events", help="folder of dt=<date> event shards")
    sub.add_argument("--start", help="first shard date")
    sub.add_argument("--end", help="last shard date")
    sub.add_argument("--event-name", default=EventNames().event)
    sub.add_argument("--user-key", default=EventNames().user_key)
    sub.add_argument("--product-prefix", default=EventNames().product_prefix, help="prefix of the product's parameters")
    sub.add_argument("--clean", action="store_true", help="compact variant with channel summary")
    sub.add_argument("--add-schema", action="store_true", help="only add the compact variant's columns")
    sub.add_argument("--dry-run", action="store_true", help="show a sample, change nothing")
    sub.add_argument("--limit", type=int)

    sub = command(social, "social ingest of all platforms")
    for name in ("tweets", "video-search", "video-details", "posts", "posts-v2", "metadata", "short-videos"):
        sub.add_argument(f"--{name}")
    for name in ("tweets", "videos", "posts", "short-videos"):
        sub.add_argument(f"--{name}-table", default=name.replace("-", "_"))

    sub = command(posts, "incremental or full load of posts, or back-fill of their metadata")
    sub.add_argument("--table", default="posts")
    sub.add_argument("--pages")
    sub.add_argument("--page-rules", action="store_true", help="take pages only up to where the scan ends")
    sub.add_argument("--metadata")
    sub.add_argument("--mode", choices=["incremental", "full"], default="incremental")
    sub.add_argument("--max-posts", type=int)
    sub.add_argument("--no-metadata", action="store_true")
    sub.add_argument("--max-metadata-calls", type=int)
    sub.add_argument("--update-metadata", action="store_true")
    sub.add_argument("--update-limit", type=int)

    sub = command(reports, "daily video reports")
    sub.add_argument("--daily", required=True)
    sub.add_argument("--playback")
    sub.add_argument("--traffic")
    sub.add_argument("--daily-table", default="video_daily")
    sub.add_argument("--playback-table", default="video_playback_daily")
    sub.add_argument("--traffic-table", default="video_traffic_daily")
    return top


def main(argv: list[str] | None = None) -> None:
    top = parser()
    args = top.parse_args(argv)
    if args.run is attribution and not (args.events or args.add_schema):
        top.error("attribution needs --events (or --add-schema)")
    if args.run is posts and not (args.pages or args.update_metadata):
        top.error("posts needs --pages (or --update-metadata)")
    if args.run is posts and not (args.metadata or args.no_metadata):
        top.error("posts needs --metadata (or --no-metadata)")
    with staging():
        args.run(build_session("engage"), args)


if __name__ == "__main__":
    main()
