from __future__ import annotations

import datetime as dt
import json

import pytest
from conftest import rows
from pyspark.sql import functions as F

from engage import schemas as S
from engage.operators.reports import unpack_report
from engage.plans import jobs
from engage.plans.steps import required
from engage.queries.inputs import NAMES, ga_events, post_metadata, posts
from engage.sources.bucketed import BucketedTable
from engage.sources.landed import read_ndjson
from engage.sources.tables import SnapshotTable, append, merge_row_level, overwrite, replace_days
from engage.streaming.incremental import landed_stream, merge_stream

NOW = "2024-02-15 12:00:00"


@pytest.fixture()
def new_table(spark):
    made = []

    def make(name):
        table = SnapshotTable(spark, name)
        table.drop()
        made.append(table)
        return table

    yield make
    for table in made:
        table.drop()


def landed(spark, tmp_path, name, schema, *records):
    folder = tmp_path / name
    folder.mkdir(exist_ok=True)
    (folder / f"part-{len(list(folder.iterdir()))}.json").write_text("".join(json.dumps(r) + "\n" for r in records))
    return read_ndjson(spark, str(folder), schema)


def user(uid, **more):
    return {"userId": uid, "createdTime": 1700000000, **more}


def test_snapshot_table(spark, new_table):
    table = new_table("snap")
    assert table.create("id int, v string") is True
    assert table.create("id int, v string") is False
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    table.mutate(lambda old: old.unionByName(df))
    table.append(df.select(F.lit("b").alias("v"), F.lit(2).alias("id")))
    before = table.read()
    table.mutate(lambda old: old.withColumn("v", F.upper("v")))
    assert rows(before) == [(1, "a"), (2, "b")]  # a reader of the previous snapshot is not disturbed
    assert rows(table.read()) == [(1, "A"), (2, "B")]
    assert len(table.versions()) == 2
    table.flush()
    assert table.read().columns == ["id", "v"] and table.count() == 0
    table.append(df)
    assert table.count() == 1


def test_failed_mutation_leaves_the_table(spark, new_table):
    table = new_table("snap_fail")
    table.replace(spark.createDataFrame([(1, "a")], "id int, v string"))
    with pytest.raises(Exception, match="boom"):
        table.mutate(lambda old: old.withColumn("v", F.raise_error(F.lit("boom"))))
    assert rows(table.read()) == [(1, "a")]
    table.mutate(lambda old: old.withColumn("v", F.lit("z")))
    assert rows(table.read()) == [(1, "z")]


def test_an_unused_snapshot_does_no_harm(spark, new_table):
    table = new_table("snap_orphan")
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    first = table.replace(df)
    df.limit(0).write.saveAsTable("snap_orphan__v1_deadbeef")  # an attempt that died before the view moved
    assert table.current() == first
    table.append(df)
    assert table.count() == 2
    second = table.mutate(lambda old: old)
    assert table.versions() == [first, second] and table.count() == 2


def test_plain_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    spark.sql("DROP TABLE IF EXISTS plain")
    append(df, "plain")
    append(df.select("v", "id"), "plain")
    assert rows(spark.table("plain")) == [(1, "a"), (1, "a")]
    overwrite(df, "plain")
    assert spark.table("plain").count() == 1
    path = str(tmp_path / "days")
    days = [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    replace_days(spark.createDataFrame([(days[0], 1), (days[1], 1)], "date date, n int"), path)
    replace_days(spark.createDataFrame([(days[1], 2)], "date date, n int"), path)
    assert rows(spark.read.parquet(path).select("date", "n")) == [(days[0], 1), (days[1], 2)]


def test_row_level_merge_needs_a_row_level_catalog(spark):
    spark.sql("DROP TABLE IF EXISTS plain_target")
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    overwrite(df, "plain_target")
    with pytest.raises(Exception, match="(?i)merge"):
        merge_row_level(df, "plain_target", "id")


def test_daily_sync(spark, new_table, tmp_path):
    users = new_table("users_daily")
    pages = landed(
        spark, tmp_path, "users", S.USER_PAGE,
        {"page": 0, "total": 2, "users": [user("a", name="A", loginIds=["x"]), user("b", OAuth={"g": True})]},
    )
    at = int(dt.datetime(2024, 2, 14, tzinfo=dt.timezone.utc).timestamp() * 1000)
    audits = landed(
        spark, tmp_path, "audits", S.AUDIT_PAGE,
        {"page": 0, "audits": [
            {"userId": "a", "action": "LoginSucceed", "occurred": str(at), "geo": "DE", "remoteAddress": "1.1.1.1"},
            {"userId": "stranger", "action": "LoginSucceed", "occurred": str(at)},
        ]},
    )
    body = '{"status":"success","city":"Berlin","country":"Germany","countryCode":"D"}'
    responses = spark.createDataFrame([("1.1.1.1", "ip-api.com", body), ("9.9.9.9", "ip-api.com", body)], S.GEO_RESPONSE)
    result = jobs.run_daily(users, pages, audits, responses, NOW)
    assert result == {
        "success": True, "users_synced": 2, "locations_updated": 2, "ips_enriched": 1, "attribution_enriched": 0,
        "activity_status_updated": 2, "errors": {},
    }
    got = {r.user_id: r for r in users.read().collect()}
    assert set(got) == {"a", "b"}
    a, b = got["a"], got["b"]
    assert (a.last_login_city, a.last_login_country, a.last_login_region) == ("Berlin", "D", "")
    assert (a.simple_status, b.simple_status) == ("Active", "Never Logged In")
    assert a.login_ids == ["x"] and json.loads(b.oauth) == {"g": True}

    again = landed(
        spark, tmp_path, "users2", S.USER_PAGE,
        {"page": 0, "total": 2, "users": [user("a", name="renamed"), user("c")]},
    )
    broken = responses.withColumn("body", F.raise_error(F.lit("provider down")).cast("string"))
    result = jobs.run_daily(users, again, audits.where("false"), broken, NOW)
    assert (result["users_synced"], result["locations_updated"]) == (2, 0)
    assert result["activity_status_updated"] == 3
    got = {r.user_id: r for r in users.read().collect()}
    assert got["a"].display_name == "renamed" and got["a"].last_login_city == "Berlin"  # enrichment survives the sync


def test_daily_sync_equals_its_steps(spark, new_table, tmp_path):
    people = [user(f"u{i}", name=f"n{i}") for i in range(9)]
    pages = landed(spark, tmp_path, "eu", S.USER_PAGE, {"page": 0, "total": 9, "users": people})
    at = int(dt.datetime(2024, 2, 14, tzinfo=dt.timezone.utc).timestamp() * 1000)
    logins = [
        {"userId": f"u{i}", "action": "LoginFlowDone", "occurred": str(at - i), "remoteAddress": f"1.1.1.{i % 3}"}
        for i in range(7)
    ]
    audits = landed(spark, tmp_path, "ea", S.AUDIT_PAGE, {"page": 0, "audits": logins})
    body = '{"success":true,"city":"C","country":"N","country_code":"K"}'
    responses = spark.createDataFrame([(f"1.1.1.{i}", "ipwho.is", body) for i in range(2)], S.GEO_RESPONSE)
    whole, steps = new_table("users_whole"), new_table("users_steps")
    result = jobs.run_daily(whole, pages, audits, responses, NOW)
    counts = [
        jobs.sync_users(steps, pages),
        jobs.update_logins(steps, audits, NOW),
        jobs.update_locations(steps, responses, jobs.E.SYNC_ORDER),
        jobs.update_activity(steps, NOW),
    ]
    keys = ["users_synced", "locations_updated", "ips_enriched", "activity_status_updated"]
    assert counts == [result[k] for k in keys] == [9, 7, 2, 9]
    assert len(whole.versions()) == 2  # the empty table and one rewrite
    columns = whole.read().columns
    assert sorted(columns) == sorted(steps.read().columns)
    assert rows(whole.read(), "user_id") == rows(steps.read().select(*columns), "user_id")


def test_modified_since_filters_the_sync(spark, new_table):
    users = new_table("users_modified")
    page = "page int, total bigint, users array<struct<modified_ms:bigint," + S.USER_RECORD.removeprefix("struct<") + ">"
    fields = [f.split(":")[0] for f in S.USER_RECORD.removeprefix("struct<").split(",")]

    def record(uid, modified):
        return tuple(
            [modified] + [uid if f == "userId" else 1700000000 if f == "createdTime" else None for f in fields]
        )

    first = spark.createDataFrame([(0, 1, [record("a", 1700000000000)])], page)
    assert jobs.sync_users(users, first, "modified_ms") == 1
    second = spark.createDataFrame([(0, 2, [record("a", 1699999999999), record("b", 1700000000000)])], page)
    assert jobs.sync_users(users, second, "modified_ms") == 1
    assert users.count() == 2


def test_attribution_jobs(spark, new_table, data_dir):
    events = ga_events(spark, data_dir)
    users = new_table("users_attr")
    users.replace(
        spark.range(0, 20).select(F.col("id").cast("string").alias("user_id"), F.lit(NOW).cast("timestamp").alias("created_time"))
    )
    enriched = jobs.run_attribution(users, events, NAMES)
    assert enriched == 15 and users.count() == 20
    assert users.read().where("is_activated").count() == 15
    assert len(users.read().columns) == 2 + 35
    sample = jobs.run_attribution_clean(users, events, NAMES, dry_run=True, limit=3)
    assert sample.sample.count() == 3 and sample.users == 0
    done = jobs.run_attribution_clean(users, events, NAMES, as_of=NOW)
    assert done.users == 15
    assert sum(r.users for r in done.summary.collect()) == users.read().where("first_touch_channel_group is not null").count()
    assert jobs.run_attribution(users, events.where("false"), NAMES) == 0


def test_social_job(spark, new_table, tmp_path):
    tables = jobs.SocialTables(new_table("tweets"), new_table("videos"), new_table("posts_social"), "short_videos")
    spark.sql("DROP TABLE IF EXISTS short_videos")
    tweets = [{"id": str(i), "created_at": f"2024-01-{i + 1:02d}T00:00:00Z"} for i in range(12)]
    landing = jobs.SocialLanding(
        tweets=landed(spark, tmp_path, "tw", S.TWEET_PAGE, {"data": tweets}),
        video_search=landed(spark, tmp_path, "vs", S.VIDEO_SEARCH_PAGE, {"items": [{"id": {"videoId": "v"}}, {"id": {}}]}),
        video_details=landed(
            spark, tmp_path, "vd", S.VIDEO_PAGE, {"items": [{"id": "v", "snippet": {"publishedAt": "2024-01-01T00:00:00Z"}}]}
        ),
        posts=landed(spark, tmp_path, "po", S.POST_PAGE, {"start": 0, "elements": []}),
        posts_v2=landed(spark, tmp_path, "p2", S.POST_PAGE, {"start": 0, "elements": [{"id": "9", "created": {"time": 5}}]}),
        metadata=landed(spark, tmp_path, "me", S.ddl(S.POST_METADATA), {"urn": "urn:li:share:9", "commentsState": "OPEN"}),
        short_videos=landed(spark, tmp_path, "sv", S.SHORT_VIDEO, {"id": "s", "createTime": 5}, {"id": "t"}),
    )
    first = jobs.run_social(tables, landing, NOW)
    assert first == {"tweets": 12, "videos": 1, "posts": 1, "short_videos": 1, "total": 15, "errors": {}}
    assert tables.posts.read().first().comments_state == "OPEN"
    second = jobs.run_social(tables, landing, NOW)
    assert second["errors"] == {}
    assert (tables.tweets.count(), tables.videos.count(), tables.posts.count()) == (12, 1, 1)
    assert spark.table("short_videos").count() == 2  # appended without de-duplication
    landing.video_details = landing.video_details.withColumn("items", F.raise_error(F.lit("down")).cast(f"array<{S.record(S.VIDEO)}>"))
    third = jobs.run_social(tables, landing, NOW)
    assert third["videos"] == 0 and "videos" in third["errors"] and third["tweets"] == 12


def test_social_posts_without_metadata_or_newer_source(spark, new_table, tmp_path):
    tables = jobs.SocialTables(new_table("tw2"), new_table("vi2"), new_table("posts_plain"), "short_videos2")
    older = landed(spark, tmp_path, "p2", S.POST_PAGE, {"start": 0, "elements": [{"id": "9", "created": {"time": 5}}]})
    newer = landed(spark, tmp_path, "p1", S.POST_PAGE, {"start": 0, "elements": [{"id": "urn:li:share:8", "createdAt": 7}]})
    done = jobs.run_social(tables, jobs.SocialLanding(posts_v2=older), NOW)
    assert (done["posts"], done["errors"]) == (1, {}) and tables.posts.read().first().total_reactions == 0
    done = jobs.run_social(tables, jobs.SocialLanding(posts=newer, posts_v2=older), NOW)
    assert (done["posts"], done["errors"]) == (1, {}) and tables.posts.count() == 2
    done = jobs.run_social(tables, jobs.SocialLanding(video_search=landed(spark, tmp_path, "vs2", S.VIDEO_SEARCH_PAGE, {"items": [{"id": {"videoId": "v"}}]})), NOW)
    assert done["videos"] == 0 and "video details" in done["errors"]["videos"]


def test_failed_full_reload_keeps_the_rows(spark, new_table, tmp_path):
    table = new_table("posts_reload")
    good = landed(spark, tmp_path, "g", S.POST_PAGE, {"start": 0, "elements": [{"id": "urn:li:share:1", "createdAt": 5}]})
    jobs.run_posts(table, good, None, as_of=NOW)
    bad = landed(spark, tmp_path, "b", S.POST_PAGE, {"start": 0, "elements": [{"createdAt": 6}]})
    with pytest.raises(Exception, match="post_id is required"):
        jobs.run_posts(table, bad, None, mode="full", as_of=NOW)
    assert table.count() == 1


def test_every_landed_page_and_address_counts(spark, new_table, tmp_path):
    users = new_table("users_all")
    first = {"page": 0, "total": 1, "users": [user("v0")]}
    more = [{"page": k, "total": 61, "users": [user(f"u{k}")]} for k in range(61)]
    pages = landed(spark, tmp_path, "ap", S.USER_PAGE, first, *more)
    at = int(dt.datetime(2024, 2, 14, tzinfo=dt.timezone.utc).timestamp() * 1000)
    audits = landed(
        spark, tmp_path, "aa", S.AUDIT_PAGE,
        *[{"page": k, "audits": [
            {"userId": f"u{k}", "action": "LoginSucceed", "occurred": str(at), "remoteAddress": f"1.1.1.{k:03d}"},
            {"userId": f"u{k}", "action": "LoginSucceed", "occurred": str(at), "remoteAddress": "later"},
        ]} for k in range(61)],
    )
    body = '{"status":"success","city":"B","country":"G","countryCode":"D"}'
    answers = spark.createDataFrame([(f"1.1.1.{k:03d}", "ip-api.com", body) for k in range(40, 61)], S.GEO_RESPONSE)
    done = jobs.run_daily(users, pages, audits, answers, NOW)
    assert (done["locations_updated"], done["ips_enriched"], users.count()) == (61, 21, 62)
    got = users.read().where("last_login_ip <> 'later'")
    assert got.count() == 61  # of equal times the record read first


def test_staged_copies_are_deleted(spark, new_table, tmp_path):
    import os

    users = new_table("users_scratch")
    root = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    jobs.sync_users(users, landed(spark, tmp_path, "sp", S.USER_PAGE, {"page": 0, "users": [user("a")]}))
    assert set(os.listdir(root)) == before and users.count() == 1


def test_snapshots_of_a_qualified_table(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS lake")
    table, other = SnapshotTable(spark, "lake.q"), SnapshotTable(spark, "lake.q__v2")
    for t in (table, other):
        t.drop()
        t.create("id int")
    for k in range(3):
        table.mutate(lambda old, k=k: old.unionByName(spark.createDataFrame([(k,)], "id int")))
    assert table.count() == 3 and len(table.versions()) == 2 and len(other.versions()) == 1
    state = table.read()
    shown = table.current()
    assert shown.startswith("lake.q__v")
    original = table.current
    table.current = iter([shown, "lake.q__v9_00000000"]).__next__
    with pytest.raises(RuntimeError, match="another writer"):
        table.replace(state)
    table.current = original
    assert table.current() == shown
    table.drop()
    assert table.versions() == [] and other.exists()
    other.drop()


def post_pages(records):
    return records.agg(F.collect_list(F.struct(*records.columns)).alias("elements")).select(
        F.lit(0).cast("bigint").alias("start"),
        F.struct(F.lit(0).cast("bigint").alias("start"), F.lit(0).cast("bigint").alias("count")).alias("paging"),
        "elements",
    )


def test_posts_job(spark, new_table, data_dir):
    table = new_table("posts_job")
    records = posts(spark, data_dir).drop("doc_id").where("id <> ''").orderBy("publishedAt").limit(40)
    records = records.persist()
    early = records.where("createdAt < 1704067200000 + 20 * 3600000")
    found = post_metadata(spark, data_dir)
    assert early.join(found, early["id"] == found["urn"]).count() > 1
    first = jobs.run_posts(table, post_pages(early), found, max_metadata_calls=1, as_of=NOW)
    assert first["posts_processed"] == first["total_rows"] == early.count()
    assert table.read().where("comments_state is not null").count() == 1
    dated = records.where("createdAt is not null")
    jobs.run_posts(table, post_pages(dated), found, as_of=NOW)
    newest = early.agg(F.max("createdAt")).first()[0]
    assert table.count() == early.count() + dated.where(F.col("createdAt") > newest).count()
    full = jobs.run_posts(table, post_pages(records), None, mode="full", max_posts=7, as_of=NOW)
    assert full == {"mode": "full", "posts_processed": 7, "total_rows": 7}
    assert jobs.run_backfill(table, found, as_of=NOW) == table.read().where("comments_state is not null").count()
    with pytest.raises(ValueError):
        jobs.run_posts(table, post_pages(records), None, mode="odd")
    records.unpersist()


def test_required_column(spark):
    with pytest.raises(Exception, match="post_id is required"):
        required(spark.createDataFrame([(None,)], "post_id string"), "post_id").collect()


def test_reports_job(spark):
    for name in ("r_daily", "r_playback", "r_traffic"):
        spark.sql(f"DROP TABLE IF EXISTS {name}")
    headers = [("day",), ("video",), ("views",), ("insightTrafficSourceType",)]
    report = spark.createDataFrame([(headers, [["2024-01-01", "v", "5", None]])], S.REPORT)
    broken = report.withColumn("rows", F.raise_error(F.lit("unsupported")).cast("array<array<string>>"))
    tables = {"daily": "r_daily", "playback": "r_playback", "traffic": "r_traffic"}
    result = jobs.run_reports(report, broken, report, tables)
    assert (result["daily"], result["playback"], result["traffic"]) == (1, 0, 1) and "playback" in result["errors"]
    jobs.run_reports(report, None, report, tables)
    assert rows(spark.table("r_traffic").select("traffic_source_type", "views")) == [("None", 5)]  # days are replaced
    jobs.run_reports(report, None, None, tables, only_append=True)
    assert spark.table("r_daily").count() == 2
    assert unpack_report(report).columns == S.names(S.VIDEO_DAILY)


def test_stream_reads_each_file_once_and_replays_safely(spark, new_table, tmp_path):
    table = new_table("streamed")
    table.create("id string, v bigint")
    schema = "id string, v bigint"
    folder = tmp_path / "in"
    landed(spark, tmp_path, "in", schema, {"id": "a", "v": 1}, {"id": "a", "v": 2}, {"id": "b", "v": 1})

    def run(checkpoint):
        query = merge_stream(
            landed_stream(spark, str(folder), schema, 1), table, "id", lambda: [F.col("v").desc()], str(tmp_path / checkpoint)
        )
        assert query.awaitTermination(120)
        return rows(table.read())

    assert run("cp") == [("a", 2), ("b", 1)]
    landed(spark, tmp_path, "in", schema, {"id": "b", "v": 7}, {"id": "c", "v": 3})
    assert run("cp") == [("a", 2), ("b", 7), ("c", 3)]
    assert run("cp") == [("a", 2), ("b", 7), ("c", 3)]
    assert run("another") == [("a", 2), ("b", 7), ("c", 3)]


def test_a_replayed_batch_with_null_keys_changes_nothing(spark, new_table):
    table = new_table("replayed")
    table.create("id string, v bigint")
    rows_ = spark.createDataFrame([("a", 1), (None, 2)], "id string, v bigint")
    table.mutate(lambda old: old.unionByName(rows_), note="s:4")
    assert table.note() == "s:4"
    table.mutate(lambda old: old)
    assert table.note() is None


def test_command_line(spark, new_table, tmp_path, data_dir, capsys):
    from engage.__main__ import main

    users = new_table("users_cli")
    landed(spark, tmp_path, "cu", S.USER_PAGE, {"page": 0, "total": 2, "users": [user("1"), user("2")]})
    at = int(dt.datetime(2024, 2, 14, tzinfo=dt.timezone.utc).timestamp() * 1000)
    audit = {"userId": "1", "action": "LoginSucceed", "occurred": str(at), "remoteAddress": "1.1.1.1"}
    landed(spark, tmp_path, "ca", S.AUDIT_PAGE, {"page": 0, "audits": [audit]})
    body = '{"status":"success","city":"Berlin","country":"Germany","countryCode":"D"}'
    landed(spark, tmp_path, "cg", S.GEO_RESPONSE, {"ip": "1.1.1.1", "provider": "ip-api.com", "body": body})
    paths = [f"--{n}={tmp_path}/{p}" for n, p in (("user-pages", "cu"), ("audit-pages", "ca"), ("responses", "cg"))]
    main(["--as-of", NOW, "sync", "--users", "users_cli", *paths])
    assert "'users_synced': 2" in capsys.readouterr().out
    main(["locations", "--users", "users_cli", "--force", paths[2]])
    assert "addresses located: 1" in capsys.readouterr().out
    networks = spark.createDataFrame([("1.1.0.0/16", "Bonn", "", "Germany", "D")], "network string, " + ", ".join(f"{c} string" for c in jobs.E.LOCATION))
    networks.createOrReplaceTempView("cli_networks")
    (tmp_path / "none").mkdir()
    main(["locations", "--users", "users_cli", "--force", f"--responses={tmp_path}/none", "--ranges", "cli_networks"])
    assert "addresses located: 1" in capsys.readouterr().out
    assert users.read().where("last_login_city = 'Bonn'").count() == 1
    events = str(tmp_path / "cli-events")
    shards = ga_events(spark, data_dir).withColumn("dt", F.to_date(F.timestamp_micros("event_timestamp")))
    shards.write.partitionBy("dt").parquet(events)
    main(["attribution", "--users", "users_cli", "--add-schema"])
    assert "first_page_title" in users.read().columns
    run = ["attribution", "--users", "users_cli", "--events", events, "--event-name", "view", "--start", "2024-01-02"]
    main([*run, "--clean", "--dry-run"])
    assert "first_touch_source" in capsys.readouterr().out
    main([*run, "--clean"])
    main(run)
    assert "users enriched: 15" in capsys.readouterr().out
    assert users.read().where("is_activated").count() == 2


# --- tables in buckets, and writers at the same time -----------------------------------------------------------------
def test_a_replacement_made_from_an_older_state_is_refused(spark, new_table):
    table = new_table("snap_race")
    row = lambda n: spark.createDataFrame([(n, "a")], "id int, v string")
    table.replace(row(1))
    state, computed = table.state(), table.read()
    table.mutate(lambda old: old.unionByName(row(2)))  # another writer, after the read
    with pytest.raises(RuntimeError, match="another writer"):
        table.replace(computed, base=state)
    state = table.state()
    table.append(row(3))
    with pytest.raises(RuntimeError, match="another writer"):
        table.replace(row(9), base=state)
    assert rows(table.read().select("id")) == [(1,), (2,), (3,)]
    table.mutate(lambda old: old.where("id > 1"))
    assert rows(table.read().select("id")) == [(2,), (3,)]


def test_staged_copies_belong_to_their_own_job(spark):
    import threading

    from engage.plans.steps import stage, staging

    started, ended = threading.Event(), threading.Event()
    counts = []

    def inner():
        with staging():
            rows = stage(spark.range(5).toDF("id"), "inner")
            started.set()
            ended.wait(60)
            counts.append(rows.count())

    worker = threading.Thread(target=inner)
    with staging():
        worker.start()
        started.wait(60)
    ended.set()  # the outer job has ended and deleted its own copies only
    worker.join()
    assert counts == [5]


@pytest.fixture()
def bucketed(spark, tmp_path):
    return BucketedTable(spark, str(tmp_path / "users"), buckets=16)


def test_daily_sync_in_buckets_costs_what_changed(spark, new_table, bucketed, tmp_path):
    people = [user(f"u{i}", name=f"n{i}") for i in range(200)]
    pages = landed(spark, tmp_path, "bu", S.USER_PAGE, {"page": 0, "total": 200, "users": people})
    at = int(dt.datetime(2024, 2, 14, tzinfo=dt.timezone.utc).timestamp() * 1000)
    logins = [{"userId": f"u{i}", "action": "LoginFlowDone", "occurred": str(at - i), "remoteAddress": f"1.1.1.{i % 3}"} for i in range(7)]
    audits = landed(spark, tmp_path, "ba", S.AUDIT_PAGE, {"page": 0, "audits": logins})
    body = '{"success":true,"city":"C","country":"N","country_code":"K"}'
    responses = spark.createDataFrame([(f"1.1.1.{i}", "ipwho.is", body) for i in range(2)], S.GEO_RESPONSE)
    whole = new_table("users_plain")
    want = jobs.run_daily(whole, pages, audits, responses, NOW)
    got = jobs.run_daily_buckets(bucketed, pages, audits, responses, NOW)
    assert {**got, "activity_status_updated": 200} == want and got["errors"] == {}
    columns = whole.read().columns
    assert rows(jobs.with_activity(bucketed.read(), NOW).select(*columns), "user_id") == rows(whole.read(), "user_id")

    before = bucketed.head()
    one = landed(spark, tmp_path, "bu2", S.USER_PAGE, {"page": 0, "total": 1, "users": [user("u5", name="renamed")]})
    result = jobs.run_daily_buckets(bucketed, one, audits.where("false"), responses.where("false"), NOW)
    assert (result["users_synced"], result["locations_updated"], result["ips_enriched"]) == (1, 0, 0)
    after = bucketed.head()
    assert len([b for b in after.folders if after.folders[b] != before.folders[b]]) == 1
    feed = bucketed.changes(before, after).collect()
    assert [(r.user_id, r._change, r.after.display_name, r.after.last_login_city) for r in feed] == [("u5", "update", "renamed", None)]


def test_attribution_of_new_shards_equals_that_of_all(spark, new_table, bucketed, tmp_path, data_dir):
    day = F.to_date(F.timestamp_micros("event_timestamp")).cast("string")
    events = ga_events(spark, data_dir).withColumn("dt", day)
    days = sorted(r[0] for r in events.select("dt").distinct().collect())
    start = spark.range(0, 20).select(F.col("id").cast("string").alias("user_id"), F.lit(NOW).cast("timestamp").alias("created_time"))
    whole, steps = new_table("users_at_once"), new_table("users_by_shard")
    whole.replace(start)
    steps.replace(start)
    jobs.run_attribution(whole, events, NAMES)
    for last in (days[0], days[len(days) // 2], days[-1], days[-1]):
        enriched = jobs.run_attribution_increment(steps, bucketed, events.where(F.col("dt") <= last), names=NAMES)
    assert enriched == 0 and bucketed.note() == days[-1]  # nothing new: no event is counted twice
    columns = whole.read().columns
    assert rows(steps.read().select(*columns), "user_id") == rows(whole.read(), "user_id")
    assert len(bucketed.versions()) == 1 + 3


def test_slices_of_events_combine_in_any_order(spark, data_dir):
    from engage.operators import attribution as A
    from engage.operators import attribution_state as AS

    flat = A.flatten_events(ga_events(spark, data_dir), NAMES)
    want = rows(A.attribution_full(flat), "user_id")
    states = [AS.slice_state(flat.where(F.pmod("event_id", F.lit(4)) == k)) for k in range(4)]
    one = AS.combine(AS.combine(states[3], states[1]), AS.combine(states[2], states[0]))
    other = AS.combine(states[0], AS.combine(states[2], AS.combine(states[1], states[3])))
    assert rows(AS.finish(one), "user_id") == rows(AS.finish(other), "user_id") == want
    assert AS.finish(AS.slice_state(flat.where("false"))).count() == 0


# --- landed lines and pages --------------------------------------------------------------------------------------------
def test_bad_lines_are_set_aside(spark, tmp_path):
    from engage.plans.steps import landed_rows, staging
    from engage.sources.landed import TooManyBadRecords

    folder, dead = tmp_path / "mixed", str(tmp_path / "dead")
    folder.mkdir()
    (folder / "a.json").write_text('{"id": 1, "v": "x"}\n{"id": 2, "v": \n\n{"id": "no number", "v": "y"}\n{"id": null}\n')
    (folder / "b.json").write_text('{"id": 3, "v": "z"}\n')
    with staging():
        good = landed_rows(spark, str(folder), "id int, v string", dead, most=0.5)
        assert rows(good) == [(None, None), (1, "x"), (3, "z")]
        letters = {(r.file.rsplit("/", 1)[1], r.line) for r in spark.read.parquet(dead).collect()}
        assert letters == {("a.json", '{"id": 2, "v": '), ("a.json", '{"id": "no number", "v": "y"}')}
        with pytest.raises(TooManyBadRecords, match="2 of 5"):
            landed_rows(spark, str(folder), "id int, v string", dead, most=0.3)


def test_a_missing_page_ends_a_scan(spark):
    from engage.sources.pages import islands, scan_pages, unbroken

    numbers = [(0, "a"), (1, "a"), (1, "a"), (3, "a"), (1, "b"), (2, "b"), (0, None), (1, None), (None, "a")]
    pages = spark.createDataFrame([(p, r, [1, 2]) for p, r in numbers], "page int, run string, body array<int>")
    assert {tuple(r) for r in islands(pages, "run").collect()} == {("a", 0, 1), ("a", 3, 3), ("b", 1, 2), (None, 0, 1)}
    assert sorted((r.page, r.run or "") for r in unbroken(pages, "run").collect()) == [(0, ""), (0, "a"), (1, ""), (1, "a"), (1, "a")]
    assert scan_pages(pages.where("run = 'a'"), "body", 2, gaps=False).count() == 3
    assert scan_pages(pages.where("run = 'b'"), "body", 2, gaps=False).count() == 0
    assert islands(pages.limit(0)).count() == 0


def test_command_line_of_tables_in_buckets(spark, tmp_path, data_dir, capsys):
    from engage.__main__ import main

    pages, audits, responses = (str(tmp_path / n) for n in ("pages", "audits", "responses"))
    for folder, lines in (
        (pages, ['{"page": 0, "total": 2, "users": [{"userId": "1"}, {"userId": "2"}]}', '{"page": 1, "users": [{"userId": "9"}]}', "{cut"]),
        (audits, ['{"page": 0, "audits": []}']),
        (responses, ['{"ip": "1.1.1.1", "provider": "ipwho.is", "body": "{}"}']),
    ):
        spark.createDataFrame([(line,) for line in lines], "value string").coalesce(1).write.text(folder)
    users = str(tmp_path / "users")
    main([
        "--dead-letters", str(tmp_path / "dead"), "--most-bad", "0.5", "sync", "--users-path", users, "--buckets", "4", "--page-rules",
        "--user-pages", pages, "--audit-pages", audits, "--responses", responses,
    ])
    assert "'users_synced': 2" in capsys.readouterr().out
    assert rows(BucketedTable(spark, users).read().select("user_id")) == [("1",), ("2",)]
    assert spark.read.parquet(str(tmp_path / "dead")).count() == 1

    shards = str(tmp_path / "shards")
    ga_events(spark, data_dir).withColumn("dt", F.to_date(F.timestamp_micros("event_timestamp"))).write.partitionBy("dt").parquet(shards)
    options = ["--event-name", "view", "--user-key", NAMES.user_key, "--users-path", users, "--events", shards, "--state", str(tmp_path / "state")]
    main(["attribution", *options])
    main(["attribution", *options])
    told = capsys.readouterr().out.split("users enriched:")[1:]
    assert int(told[0]) > 0 and int(told[1]) == 0
    assert BucketedTable(spark, users).read().where("total_events > 0").count() == 2
