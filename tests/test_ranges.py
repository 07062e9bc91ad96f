from __future__ import annotations

import random

import pytest
from conftest import plan, rows
from pyspark.sql import functions as F

from engage.operators import ranges as operator
from engage.operators.enrich import BULK_ORDER, LOCATION
from engage.operators.ranges import address_number, address_text, locate_by_ranges, network_bounds
from engage.plans.jobs import new_locations

TOP = 2**32 - 1


def text(number):
    return ".".join(str(number >> bits & 255) for bits in (24, 16, 8, 0))


def located(spark, numbers, ranges):
    addresses = spark.createDataFrame([(text(n),) for n in numbers], "last_login_ip string")
    table = spark.createDataFrame(ranges, "first long, last long, city string")
    return locate_by_ranges(addresses, table, ["city"])


@pytest.mark.parametrize("address", ["", "1.2.3", "1.2.3.4.5", "256.1.1.1", "01.2.3.4", "1.2.3.4\n", " 1.2.3.4", "::1", "a.b.c.d", None])
def test_other_texts_have_no_number(spark, address):
    df = spark.createDataFrame([(address,)], "a string")
    assert df.select(address_number(F.col("a"))).first()[0] is None


def test_numbers_and_texts(spark):
    numbers = [0, 1, 255, 256, 2**24, 2**31, TOP]
    df = spark.createDataFrame([(n,) for n in numbers], "n long").withColumn("a", address_text(F.col("n")))
    assert rows(df.select("n", "a", address_number(F.col("a")).alias("m")), "n") == [(n, text(n), n) for n in numbers]


def test_network_bounds(spark):
    networks = ["10.1.2.3/8", "0.0.0.0/0", "1.2.3.4", "1.2.3.4/32", "1.2.3.5/31", "1.2.3.4/33", "1.2.3/8", "1.2.3.4/", None]
    df = spark.createDataFrame([(n,) for n in networks], "n string")
    got = [tuple(r) for r in df.select(network_bounds(F.col("n")).alias("b")).select("b.first", "b.last").collect()]
    one = (1 << 24) + (2 << 16) + (3 << 8) + 4
    assert got == [(10 << 24, (11 << 24) - 1), (0, TOP), (one, one), (one, one), (one, one + 1), *[(None, None)] * 4]


@pytest.mark.parametrize("seed", range(3))
def test_against_brute_force(spark, seed):
    draw = random.Random(seed)
    bases = [0, TOP, *[draw.randrange(TOP) for _ in range(3)]]

    def near():
        return min(TOP, max(0, draw.choice(bases) + draw.randint(-1, 1) * draw.randrange(1 << draw.randrange(1, 22))))

    ranges = []
    for k in range(120):
        a, b = sorted((near(), near())) if k % 10 else sorted((draw.choice(bases), draw.choice(bases)))
        ranges.append((a, b if k % 10 == 0 or b - a < 1 << 22 else a, f"c{draw.randrange(60)}"))
    numbers = {near() for _ in range(300)} | {a for a, _, _ in ranges} | {min(TOP, b + 1) for _, b, _ in ranges}
    want = []
    for n in numbers:
        fits = [(b - a, a, c) for a, b, c in ranges if a <= n <= b]
        if fits:
            want.append((text(n), min(fits)[2], "ranges"))
    assert rows(located(spark, [*numbers, *numbers], ranges + ranges[:9])) == sorted(want)


def test_bounds_that_hold_nothing(spark):
    ranges = [(None, 9, "a"), (0, None, "b"), (9, 0, "c"), (-5, 9, "d"), (0, TOP + 1, "e")]
    assert rows(located(spark, range(12), ranges)) == []
    assert rows(located(spark, [0, TOP], [*ranges, (0, TOP, None)])) == [("0.0.0.0", None, "ranges"), (text(TOP), None, "ranges")]


def test_empty_tables_and_other_columns(spark):
    assert rows(located(spark, [], [(0, 9, "a")])) == rows(located(spark, [5], [])) == []
    names = ["ip", "number", "bucket", "bits", "block", "best", "source", "of_3"]
    addresses = spark.createDataFrame([("0.0.0.5", "1.1.1.1")], "last_login_ip string, ip string")
    addresses = addresses.withColumns({name: F.lit(7) for name in names[1:]})
    ranges = spark.createDataFrame([(0, 9, "a")], "first long, last long, city string").withColumns({name: F.lit(8) for name in names})
    assert rows(locate_by_ranges(addresses, ranges, ["city"])) == [("0.0.0.5", "a", "ranges")]


def test_no_join_in_the_plan(spark):
    assert "Join" not in plan(located(spark, [1], [(0, 9, "a")])) and "Cartesian" not in plan(located(spark, [1], [(0, 9, "a")]))


def test_ranges_locate_what_no_provider_located(spark):
    users = spark.createDataFrame(
        [("1.1.1.1", None), ("2.2.2.2", None), ("2.2.2.2", None), ("3.3.3.3", "x"), ("200.1.1.1", None), (None, None)],
        "last_login_ip string, last_login_city string",
    )
    body = '{"status":"success","city":"Berlin","country":"Germany","countryCode":"D"}'
    failed = '{"status":"fail"}'
    responses = [("1.1.1.1", "ip-api.com", body), ("2.2.2.2", "ip-api.com", failed)]
    responses = spark.createDataFrame(responses, "ip string, provider string, body string")
    fields = ", ".join(f"{name} string" for name in ["network", *LOCATION])
    networks = spark.createDataFrame([("0.0.0.0/1", "Wide", "r", "n", "c"), ("2.2.0.0/16", "Near", "r", "n", "c"), ("bad", "B", "", "", "")], fields)
    got = new_locations(users, responses, BULK_ORDER, ranges=networks)
    want = [("1.1.1.1", "Berlin", "ip-api.com"), ("2.2.2.2", "Near", "ranges")]
    assert rows(got.select("ip", "city", "source")) == want


def test_tasks_grow_with_the_tables(spark, monkeypatch):
    monkeypatch.setattr(operator, "TASK_ROWS", 100)
    ranges = [(k << 16, (k << 16) + 99, f"c{k}") for k in range(60)]
    got = located(spark, [(k << 16) + 50 for k in range(60)], ranges)
    assert rows(got, "city") == sorted((((text((k << 16) + 50)), f"c{k}", "ranges") for k in range(60)), key=lambda r: r[1])
    # 60 ranges of about 17 blocks and 60 addresses.
    assert "hashpartitioning(bucket" in plan(got) and ", 11), REPARTITION_BY_NUM" in plan(got)
