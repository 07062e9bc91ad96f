from __future__ import annotations

import datetime as dt

from conftest import rows
from pyspark.sql import functions as F

from engage import schemas as S
from engage.operators import enrich as E
from engage.operators.activity import activity_status
from engage.operators.latest import last_login, modified_since, newer_than, recent_logins, watermark

NOW = "2024-02-15 12:00:00"


def ms(*parts):
    return int(dt.datetime(*parts, tzinfo=dt.timezone.utc).timestamp() * 1000)


def test_last_login(spark):
    base = ms(2024, 2, 14)
    data = [
        (3, "u", "LoginSucceed", str(base), "DE", "1.1.1.1"),
        (2, "u", "LoginFlowDone", str(base), "FR", None),  # same time: the smaller id wins
        (1, "u", "LoginSucceed", str(base - 5), "IT", "1.1.1.2"),
        (4, "", "LoginSucceed", str(base), "X", "x"),
        (5, "v", "LoginSucceed", "0", "X", "x"),
        (6, "w", "LoginSucceed", str(ms(2024, 2, 1)), "X", "x"),  # older than the window
        (7, "y", "Other", str(base), "X", "x"),
        (8, "z", "LoginSucceed", str(base), None, None),
    ]
    audits = spark.createDataFrame(data, "aid int, userId string, action string, occurred string, geo string, remoteAddress string")
    got = last_login(recent_logins(audits, NOW), tie="aid")
    when = dt.datetime(2024, 2, 14)
    assert rows(got) == [("u", when, "FR", ""), ("z", when, "", "")]


def test_watermark_drops_fractions_and_bounds_inclusively(spark):
    table = spark.createDataFrame([(dt.datetime(2024, 1, 1, 0, 0, 1, 900000),)], "created_time timestamp")
    mark = watermark(table)
    at = ms(2024, 1, 1, 0, 0, 1)
    source = spark.createDataFrame([(at - 1,), (at,), (at + 1,)], "modified_ms bigint")
    assert rows(mark) == [(at // 1000,)]
    assert rows(modified_since(source, mark)) == [(at,), (at + 1,)]
    assert modified_since(source, watermark(table.limit(0))).count() == 3


def test_slices_equal_one_full_load(spark):
    source = spark.range(100).select(F.timestamp_seconds("id").alias("created"), "id")
    loaded = []
    for upto in (30, 70, 100):
        mark = F.lit(dt.datetime.fromtimestamp(loaded[-1], dt.timezone.utc).replace(tzinfo=None)) if loaded else None
        batch = newer_than(source.where(F.col("id") < upto), "created", mark)
        loaded += [r.id for r in batch.orderBy("id").collect()]
    assert loaded == list(range(100))


def test_newer_than_keeps_rows_without_time_and_takes_the_newest(spark):
    data = [("a", 1), ("b", 5), ("c", 9), ("d", None)]
    df = spark.createDataFrame(data, "id string, t int")
    assert rows(newer_than(df, "t", F.lit(5)), "id") == [("c", 9), ("d", None)]
    assert rows(newer_than(df.dropna(), "t", None, newest=2, tie="id"), "id") == [("b", 5), ("c", 9)]


def test_activity_bands(spark):
    days = [None, 0, 1, 3, 4, 7, 8, 14, 15, 30, 31, 60, 61, -1]
    today = dt.datetime(2024, 2, 15, 9)
    data = [
        (i, dt.datetime(2023, 1, 1), None if d is None else today - dt.timedelta(days=d)) for i, d in enumerate(days)
    ]
    users = spark.createDataFrame(data, "id int, created_time timestamp, last_login_time timestamp")
    got = activity_status(users, NOW).orderBy("id").collect()
    assert [r.user_activity_status.split(" ", 1)[1] for r in got] == [
        "Never Logged In",
        "Active Today",
        *["Active (1-3 days)"] * 2,
        *["Active (4-7 days)"] * 2,
        *["At Risk (7-14 days)"] * 2,
        *["Dormant (14-30 days)"] * 2,
        *["Inactive (30-60 days)"] * 2,
        "Very Inactive (60+ days)",
        "Active (1-3 days)",
    ]
    assert [r.simple_status for r in got] == [
        "Never Logged In", *["Active"] * 5, *["Dormant"] * 4, *["Inactive"] * 3, "Active"
    ]
    assert got[0].is_same_day_activation is False and got[0].signup_to_first_login_seconds is None


def test_activity_day_difference_crosses_midnight(spark):
    data = [(dt.datetime(2024, 2, 13, 23, 59), dt.datetime(2024, 2, 14, 0, 1))]
    row = activity_status(spark.createDataFrame(data, "created_time timestamp, last_login_time timestamp"), NOW).first()
    assert (row.days_since_signup, row.days_since_last_login) == (2, 1)
    assert (row.signup_to_first_login_seconds, row.signup_to_first_login_minutes) == (120, 2.0)
    assert row.is_same_day_activation is False


def test_locations(spark):
    data = [
        ("1", "ip-api.com", '{"status":"fail"}'),
        ("1", "freeipapi.com", '{"message":"x"}'),
        ("1", "ipwho.is", '{"success":true,"region":"R","country":"C","country_code":"CC"}'),
        ("1", "ipapi.co", '{"city":"late"}'),
        ("2", "ip-api.com", "<html>"),
        ("2", "ipapi.co", '{"error":null,"city":"x"}'),
        ("3", "ipapi.co", '{"city":"D","region":"R","country_name":"N","country_code":"K"}'),
        ("4", "freeipapi.com", '{"cityName":null,"countryName":"N"}'),
        ("4", "ipwho.is", '{"success":false,"city":"no"}'),
        ("5", "unknown", '{"status":"success"}'),
    ]
    found = E.normalize_locations(spark.createDataFrame(data, S.GEO_RESPONSE))
    assert rows(E.first_location(found)) == [
        ("1", "", "R", "C", "CC", "ipwho.is"),
        ("3", "D", "R", "N", "K", "ipapi.co"),
        ("4", "", "", "N", "", "freeipapi.com"),
    ]
    assert [r[0] for r in rows(E.first_location(found, E.SYNC_ORDER).select("ip"))] == ["1", "4"]


def test_fallback_order_is_respected(spark):
    data = [("1", p, "c", "r", "n", "k") for p in reversed(E.BULK_ORDER)]
    found = spark.createDataFrame(data, "ip string, source string, city string, region string, country_name string, country_code string")
    assert E.first_location(found).first().source == "ip-api.com"
    assert E.first_location(found, ["ipwho.is", "ip-api.com"]).first().source == "ipwho.is"


def test_addresses_to_enrich(spark):
    data = [("b", None), ("a", None), ("a", None), ("c", ""), ("d", "City"), (None, None)]
    users = spark.createDataFrame(data, "last_login_ip string, last_login_city string")
    assert rows(E.addresses_to_enrich(users)) == [("a",), ("b",)]
    assert rows(E.addresses_to_enrich(users, force=True)) == [("a",), ("b",), ("c",), ("d",)]
    assert rows(E.addresses_to_enrich(users, limit=1)) == [("a",)]


def test_coverage_of_nothing(spark):
    empty = spark.createDataFrame([], "last_login_city string, last_login_country_name string")
    assert rows(E.coverage(empty)) == [(0, 0, 0, 0)]


def test_supplied_lookups_are_tried_in_order(spark):
    def down(address):
        raise OSError("no route")

    def even(address):
        return {"city": f"even {address}", "country_code": "E"} if int(address) % 2 == 0 else None

    def small(address):
        return {"city": "small"} if int(address) < 5 else None

    addresses = spark.range(8).select(F.col("id").cast("string").alias("last_login_ip"))
    got = E.lookup_locations(addresses, {"down": down, "even": even, "small": small}, tasks=3)
    assert rows(got.select("ip", "city", "region", "country_code", "source")) == [
        ("0", "even 0", "", "E", "even"),
        ("1", "small", "", "", "small"),
        ("2", "even 2", "", "E", "even"),
        ("3", "small", "", "", "small"),
        ("4", "even 4", "", "E", "even"),
        ("6", "even 6", "", "E", "even"),
    ]
