from __future__ import annotations

import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from engage import schemas as S
from engage.functions.posts import reaction_columns
from engage.operators import enrich as E
from engage.operators.reports import daily_report, report_range, unpack_report


def metadata(spark, *data):
    """(urn, count) pairs as metadata records."""
    rows_ = [(urn, "OPEN", (count, None), {"LIKE": (count,)}) for urn, count in data]
    return spark.createDataFrame(rows_, S.ddl(S.POST_METADATA))


def posts(spark, *data):
    return spark.createDataFrame(list(data), "id string, urn string, createdAt bigint")


def test_best_candidate(spark):
    found = metadata(
        spark,
        ("urn:li:ugcPost:1", 10),
        ("urn:li:share:1", 11),
        ("urn:li:share:2", 20),
        ("urn:li:share:3", 30),
        ("x4", 40),
        ("5", 50),
        ("x4", 99),  # a repeated record: the smaller counts win, once
    )
    wanted = posts(
        spark,
        ("1", None, 1),
        ("2", None, 2),
        ("urn:li:share:3", None, 3),
        ("x4", None, 4),
        ("5", None, 5),
        ("", "urn:li:share:1", 6),
        (None, None, 7),
    )
    got = E.attach_metadata(wanted, found).select("createdAt", "metadata.urn")
    assert rows(got) == [
        (1, "urn:li:ugcPost:1"),
        (2, "urn:li:share:2"),
        (3, "urn:li:share:3"),
        (4, "x4"),
        (5, None),
        (6, "urn:li:share:1"),
        (7, None),
    ]


def test_budget_counts_successes_only(spark):
    wanted = posts(spark, ("a", None, 5), ("b", None, 4), ("c", None, 3), ("d", None, 2), ("e", None, None))
    found = metadata(spark, ("b", 1), ("c", 1), ("d", 1), ("e", 1))
    for budget, served in ((2, ["b", "c"]), (None, ["b", "c", "d", "e"]), (9, ["b", "c", "d", "e"])):
        got = E.attach_metadata_budgeted(wanted, found, budget)
        assert got.count() == 5
        assert [r[0] for r in rows(got.where("metadata is not null").select("id"))] == served


def test_backfill(spark):
    when = dt.datetime(2024, 1, 1)
    data = [("p1", when, 0), ("p2", when + dt.timedelta(1), None), ("p3", when + dt.timedelta(2), 5), ("p4", when, 0)]
    stored = spark.createDataFrame(data, "post_id string, created_at timestamp, total_reactions bigint")
    columns = ["comments_state", "comment_count", "top_level_comment_count", "reaction_like"]
    stored = stored.withColumns({c: F.lit(None).cast("string" if c == "comments_state" else "bigint") for c in columns})
    stored = stored.withColumn("fetched_at", F.lit(when))
    found = metadata(spark, ("p1", 3), ("p2", 4), ("p3", 9))
    got = E.backfill_metadata(stored, found, max_calls=1, as_of="2024-02-01 00:00:00")
    assert rows(got.select("post_id", "total_reactions", "comment_count")) == [
        ("p1", 0, None),
        ("p2", 4, 4),
        ("p3", 5, None),
        ("p4", 0, None),
    ]


def test_reactions(spark):
    df = spark.createDataFrame([({"LIKE": (2,), "EMPATHY": (None,), "ODD": (7,)},), (None,), ({},)], "r map<string,struct<count:bigint>>")
    got = df.select(*[c.alias(n) for n, c in reaction_columns(F.col("r")).items()]).collect()
    assert [tuple(r) for r in got] == [(2, 0, 0, 0, 0, 0, 2), (0,) * 7, (0,) * 7]


def test_newest_details(spark):
    search = spark.createDataFrame(
        [(("a",), ("2024-01-03",)), (("b",), ("2024-01-02",)), ((None,), ("2024-01-05",)), (("",), ("2024-01-06",)), (("c",), ("2024-01-04",))],
        "id struct<videoId:string>, snippet struct<publishedAt:string>",
    )
    details = spark.createDataFrame([("a", 1), ("b", 2)], "id string, n int")
    assert rows(E.newest_details(search, details, F.col("snippet.publishedAt"), newest=2)) == [("a", 1)]


def test_report_cells(spark):
    headers = [("views",), ("video",), ("day",), ("playbackLocationType",), ("averageViewDuration",)]
    cells = [["3", "v1", "2024-01-01", None, "12.9"], ["4", "v2", "2024-01-02"], [None, "v3", "2024-01-03", "HOME", "x"]]
    reports = spark.createDataFrame([(headers, cells), (headers, [])], S.REPORT)
    assert rows(unpack_report(reports)) == [
        (dt.date(2024, 1, 1), "v1", 3, 0, 0, 0, 12),
        (dt.date(2024, 1, 2), "v2", 4, 0, 0, 0, 0),
        (dt.date(2024, 1, 3), "v3", 0, 0, 0, 0, 0),
    ]
    assert rows(unpack_report(reports, breakdown="playbackLocationType").select("playback_location_type", "views")) == [
        ("HOME", 0),
        ("None", 3),
        ("None", 4),
    ]


def test_report_range_is_closed(spark):
    start, end = report_range("2024-02-15 10:00:00")
    assert spark.range(1).select(start, end).first()[:] == (dt.date(2023, 2, 14), dt.date(2024, 2, 14))
    days = [dt.date(2023, 2, 13), dt.date(2023, 2, 14), dt.date(2024, 2, 14), dt.date(2024, 2, 15)]
    df = spark.createDataFrame([(d, "v") for d in days], "d date, v string")
    args = (F.col("d"), {"video_id": F.col("v")}, {"views": F.count("*")}, start, end)
    assert [r.date for r in daily_report(df, *args).collect()] == days[1:3]
