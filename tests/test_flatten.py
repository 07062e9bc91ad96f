from __future__ import annotations

import datetime as dt
from urllib.parse import quote

import pytest
from conftest import rows
from pyspark.sql import functions as F

from engage import schemas as S
from engage.functions.posts import percent_encoded, urn_candidates
from engage.functions.times import iso_text
from engage.operators.flatten import flatten_posts, flatten_short_videos, flatten_tweets, flatten_users, flatten_videos
from engage.sources.landed import read_event_shards, read_named_shards, read_ndjson, write_ndjson
from engage.sources.pages import audit_records, post_records, scan_offset_pages, scan_pages, source_fallback, user_records


def json_rows(spark, schema, *texts):
    df = spark.createDataFrame([(t,) for t in texts], "j string")
    return df.select(F.from_json("j", schema, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def utc(*parts):
    return dt.datetime(*parts)


def test_users(spark):
    page = json_rows(
        spark,
        S.USER_PAGE,
        """{"page":0,"total":3,"users":[
          {"userId":"u1","loginIds":["a","b"],"name":"N","userTenants":[{"t":1}],"OAuth":{"g":true},"TOTP":true,
           "customAttributes":{"k":"v"},"createdTime":1700000000},
          {"userId":"u2","loginIds":null,"createdTime":0},
          {"userId":"u3"}]}""",
    )
    got = flatten_users(user_records(page))
    assert got.columns == S.names(S.USERS)
    one, two, three = got.orderBy("user_id").collect()
    assert one.login_ids == ["a", "b"] and one.user_tenants == '[{"t":1}]' and one.oauth == '{"g":true}'
    assert one.totp is True and one.created_time == utc(2023, 11, 14, 22, 13, 20)
    for row in (two, three):
        assert row.login_ids == [] and row.permissions == [] and row.user_tenants == "[]"
        assert row.oauth == "{}" and row.custom_attributes == "{}" and row.created_time is None


def pages_of(spark, sizes, total=None):
    data = [(i, total, list(range(n))) for i, n in enumerate(sizes)]
    return spark.createDataFrame(data, "page int, total bigint, users array<int>")


@pytest.mark.parametrize(
    "sizes,total,kept",
    [
        ([2, 2, 1, 2], 100, [0, 1, 2]),  # short page is the last
        ([2, 2, 0, 2], 100, [0, 1, 2]),  # empty page ends the scan
        ([2, 2, 2, 2], 4, [0, 1]),  # total reached
        ([2, 2, 2], 100, [0, 1, 2]),  # no stop page landed
    ],
)
def test_page_rule(spark, sizes, total, kept):
    got = scan_pages(pages_of(spark, sizes, total), "users", 2, total="total")
    assert [r[0] for r in rows(got.select("page"))] == kept


def test_page_rule_holds_for_each_run(spark):
    one, two = pages_of(spark, [1], 100), pages_of(spark, [2, 2, 1], 100)
    both = one.withColumn("run", F.lit("a")).unionByName(two.withColumn("run", F.lit("b")))
    got = scan_pages(both, "users", 2, total="total", run="run")
    assert rows(got.select("run", "page")) == [("a", 0), ("b", 0), ("b", 1), ("b", 2)]


def test_all_landed_audit_pages_are_read(spark):
    data = [(i, [("u", "LoginSucceed", "1", None, None)]) for i in range(60)]
    pages = spark.createDataFrame(data, S.AUDIT_PAGE)
    assert audit_records(pages).count() == 60
    assert scan_pages(pages, "audits", 1, last_page=50).count() == 51


def test_nested_free_form_fields_become_json(spark):
    schema = S.USER_RECORD.replace("userTenants:string", "userTenants:array<struct<t:int,n:string>>").replace("OAuth:string", "OAuth:struct<g:boolean>")
    page = json_rows(spark, f"page int, users array<{schema}>", '{"page":0,"users":[{"userId":"u","userTenants":[{"t":1}],"OAuth":{"g":true}},{"userId":"v"}]}')
    one, two = flatten_users(user_records(page)).orderBy("user_id").collect()
    assert (one.user_tenants, one.oauth) == ('[{"t":1,"n":null}]', '{"g":true}')
    assert (two.user_tenants, two.oauth) == ("[]", "{}")


def test_offset_pages(spark):
    pages = json_rows(
        spark,
        S.POST_PAGE,
        '{"start":0,"paging":{"start":0,"count":2},"elements":[{"id":"a"},{"id":"b"}]}',
        '{"start":2,"paging":{"start":0,"count":2},"elements":[{"id":"c"}]}',
        '{"start":4,"elements":[{"id":"d"}]}',
    )
    scanned = scan_offset_pages(pages)
    assert [r[0] for r in rows(post_records(scanned).select("id"))] == ["a", "b", "c"]
    far = pages.select(F.lit(3_000_000_000).cast("bigint").alias("start"), F.lit(None).cast("struct<start:bigint,count:bigint>").alias("paging"), "elements")
    assert scan_offset_pages(far.where("start > 0").limit(1)).count() <= 1 and post_records(pages).count() == 4


def test_fallback_takes_newest(spark):
    primary = spark.createDataFrame([("p", 1, "x")], "id string, t int, extra string")
    other = spark.createDataFrame([(f"f{i}", i) for i in range(20)], "id string, t int")
    assert rows(source_fallback(primary, other, F.col("t")).select("id")) == [("p",)]
    got = source_fallback(primary.limit(0), other, F.col("t"), 3)
    assert rows(got) == [("f17", 17, None), ("f18", 18, None), ("f19", 19, None)]


def test_tweets(spark):
    records = json_rows(
        spark,
        "id string, text string, created_at string, public_metrics struct<retweet_count:bigint,reply_count:bigint,"
        "like_count:bigint,quote_count:bigint>",
        '{"id":"1","text":"t","created_at":"2024-05-01T10:00:00.000Z","public_metrics":{"like_count":3}}',
        '{"id":"2","created_at":"2024-05-01T12:00:00+02:00"}',
        '{"id":"3","created_at":"2024"}',
        '{"id":"4","created_at":"soon"}',
        '{"id":"5"}',
    )
    assert rows(flatten_tweets(records)) == [
        ("1", "t", utc(2024, 5, 1, 10), 0, 0, 3, 0),
        ("2", "", utc(2024, 5, 1, 10), 0, 0, 0, 0),
    ]


def test_videos(spark):
    records = json_rows(
        spark,
        S.ddl(S.VIDEO),
        '{"id":"v","snippet":{"title":"T","publishedAt":"2024-01-02T03:04:05Z"},"statistics":{"viewCount":"12"}}',
        '{"id":"w","snippet":{"title":"T"}}',
    )
    assert rows(flatten_videos(records)) == [("v", "T", None, utc(2024, 1, 2, 3, 4, 5), 12, 0, 0)]


def test_short_videos_without_time_are_dropped(spark):
    records = json_rows(
        spark,
        S.SHORT_VIDEO,
        '{"id":"v","desc":"d","createTime":1700000000,"stats":{"diggCount":5}}',
        '{"id":"w"}',
    )
    assert rows(flatten_short_videos(records)) == [("v", "d", utc(2023, 11, 14, 22, 13, 20), 0, 5, 0, 0)]


POST = S.ddl(S.POST)


def test_posts(spark):
    records = json_rows(
        spark,
        POST,
        '{"id":"urn:li:ugcPost:1","commentary":"c","createdAt":1700000000000,"content":{"media":{"id":"urn:li:video:9"}},'
        '"reshareContext":{"parent":"urn:li:share:0"}}',
        '{"urn":"urn:li:share:2","created":{"time":1700000001000},"reshareContext":{},'
        '"specificContent":{"com.linkedin.ugc.ShareContent":{"shareCommentary":{"text":"old"}}},"content":{"article":{}}}',
        '{"id":"3","createdAt":0}',
    ).withColumn("metadata", F.lit(None).cast(S.record(S.POST_METADATA)))
    got = flatten_posts(records, as_of="2024-01-01 00:00:00")
    assert got.columns == S.names(S.POSTS)
    one, two = got.orderBy("post_id").collect()[::-1]
    assert (one.post_type, one.text, one.media_type, one.has_media) == ("ugcPost", "c", "video", True)
    assert (one.is_reshare, one.reshare_parent_urn) == (True, "urn:li:share:0")
    assert (two.post_id, two.post_type, two.text, two.media_type) == ("urn:li:share:2", "share", "old", "article")
    assert (two.is_reshare, two.created_at) == (False, utc(2023, 11, 14, 22, 13, 21))
    assert two.total_reactions == 0 and two.comments_state is None
    strict = flatten_posts(records, v2_fallback=False, as_of="2024-01-01 00:00:00").orderBy("post_id").collect()
    assert [(r.post_id, r.text, r.created_at) for r in strict] == [
        ("3", "", utc(1970, 1, 1)),
        ("urn:li:share:2", "", None),
        ("urn:li:ugcPost:1", "c", utc(2023, 11, 14, 22, 13, 20)),
    ]


def test_urn_candidates(spark):
    df = spark.createDataFrame([("12",), ("urn:li:share:5",), ("x7",), (None,)], "k string")
    got = [r[0] for r in df.select(urn_candidates(F.col("k"))).collect()]
    assert got == [["urn:li:ugcPost:12", "urn:li:share:12"], ["urn:li:share:5"], ["x7"], []]


def test_ndjson_is_strict(spark, tmp_path):
    path = str(tmp_path / "nd")
    write_ndjson(spark.createDataFrame([(1, "a")], "n bigint, s string"), path)
    assert rows(read_ndjson(spark, path, "n bigint, s string")) == [(1, "a")]
    (tmp_path / "nd" / "bad.json").write_text("{oops\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_ndjson(spark, path, "n bigint, s string").collect()


def test_event_shards_prune(spark, tmp_path):
    path = str(tmp_path / "events")
    days = [dt.date(2024, 1, d) for d in (1, 2, 3)]
    df = spark.createDataFrame([(i, d) for i, d in enumerate(days)], "event_id bigint, dt date")
    df.write.partitionBy("dt").parquet(path)
    got = read_event_shards(spark, path, days[1], days[2])
    assert rows(got.select("event_id")) == [(1,), (2,)]
    assert "PartitionFilters: [isnotnull(dt" in got._jdf.queryExecution().executedPlan().toString()
    for day in ("20240101", "20240102"):
        spark.range(2).write.parquet(str(tmp_path / f"events_{day}"))
    assert read_named_shards(spark, str(tmp_path / "events_*")).count() == 4


def test_percent_encoding(spark):
    texts = ["urn:li:share:5", "a b+c*d~e", "é/%-_."]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [r[0] for r in df.select(percent_encoded(F.col("t"))).collect()] == [quote(t, safe="") for t in texts]


def test_iso_text(spark):
    when = dt.datetime(2024, 1, 2, 3, 4, 5, 600000)
    df = spark.createDataFrame([(when,)], "t timestamp")
    assert dt.datetime.fromisoformat(df.select(iso_text(F.col("t"))).first()[0]) == when
