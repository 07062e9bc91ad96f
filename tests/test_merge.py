from __future__ import annotations

import pytest
from conftest import plan, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from engage.operators.merge import merge, merge_counts, merge_update_only, newest_per_key
from engage.sources.tables import evolve

T = "id bigint, a string, b bigint, kept string"
S = "id bigint, a string, b bigint"


@pytest.fixture(scope="module")
def target(spark):
    return spark.createDataFrame([(1, "a1", 1, "k1"), (2, "a2", 2, "k2"), (None, "n", 0, "kn")], T)


@pytest.fixture(scope="module")
def source(spark):
    return spark.createDataFrame([(2, None, 20), (3, "s3", 30), (None, "sn", 40)], S)


@pytest.mark.parametrize("small", [False, True])
def test_upsert_rules(target, source, small):
    got = merge(target, source, "id", small_source=small, action=True)
    assert sorted(rows(got), key=str) == sorted(
        [
            (1, "a1", 1, "k1", "keep"),
            (2, None, 20, "k2", "update"),  # a null source value wins
            (3, "s3", 30, None, "insert"),
            (None, "n", 0, "kn", "keep"),  # a null key matches nothing
            (None, "sn", 40, None, "insert"),
        ],
        key=str,
    )
    assert rows(merge_counts(got)) == [(2, 1, 2, 3)]


@pytest.mark.parametrize("small", [False, True])
def test_column_lists(target, source, small):
    got = merge(target, source, "id", update=["b"], insert=["id", "a"], small_source=small)
    assert sorted(rows(got.where("id is not null"))) == [(1, "a1", 1, "k1"), (2, "a2", 20, "k2"), (3, "s3", None, None)]


def test_update_only(spark, target, source):
    got = merge_update_only(target, source, "id")
    assert sorted(rows(got), key=str) == sorted(
        [(1, "a1", 1, "k1"), (2, None, 20, "k2"), (None, "n", 0, "kn")], key=str
    )


@pytest.mark.parametrize("small", [False, True])
def test_repeated_source_key_that_matches_is_an_error(spark, target, small):
    twice = spark.createDataFrame([(2, "x", 1), (2, "y", 2)], S)
    whole = merge(target, twice, "id", small_source=small, action=True)
    part = merge_update_only(target, twice, "id")
    for use in (whole.collect, whole.count, whole.select("b").collect, merge_counts(whole).collect, part.count, part.select("kept").collect):
        with pytest.raises(Exception, match="several source rows"):
            use()


@pytest.mark.parametrize("form", [{}, {"small_source": True}])
def test_unknown_columns_are_refused(target, source, form):
    with pytest.raises(ValueError, match="extra"):
        merge(target, source.withColumn("extra", F.lit(1)), "id", **form)
    with pytest.raises(ValueError, match="bb"):
        merge(target, source, "id", update=["bb"], **form)
    with pytest.raises(ValueError, match="a2"):
        merge(target, source, "id", insert=["id", "a2"], **form)
    with pytest.raises(ValueError, match="kept"):
        merge_update_only(target, source, "id", update=["kept"])


def test_the_source_moves_once(spark, target, source):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        shown = plan(merge(target, source, "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert shown.count("Exchange hashpartitioning") == 2


@pytest.mark.parametrize("small", [False, True])
def test_repeated_source_key_without_match_is_inserted_twice(spark, target, small):
    twice = spark.createDataFrame([(9, "x", 1), (9, "y", 2)], S)
    got = merge(target, twice, "id", small_source=small).where("id = 9")
    assert rows(got.select("a")) == [("x",), ("y",)]


def test_one_source_row_updates_many_target_rows(spark):
    target = spark.createDataFrame([(i, "hot" if i < 300 else None, "old") for i in range(400)], "u int, ip string, c string")
    source = spark.createDataFrame([("hot", "new"), ("other", "x")], "ip string, c string")
    got = merge_update_only(target, source, "ip", source_unique=True)
    assert rows(got.groupBy("c").count()) == [("new", 300), ("old", 100)]


def test_hot_and_null_keys_are_joined_whole(spark):
    """One key has half of the rows, the null key a third; the adaptive planner splits the hot one."""
    n = 200_000
    ip = F.when(F.col("id") % 2 == 0, "hot").when(F.col("id") % 3 != 0, F.concat(F.lit("ip"), (F.col("id") % 5000).cast("string")))
    target = spark.range(n).select(F.col("id"), ip.alias("ip"), F.lit("old").alias("c"))
    source = spark.range(6000).select(F.concat(F.lit("ip"), F.col("id").cast("string")).alias("ip"), F.lit("new").alias("c"))
    source = source.unionByName(spark.createDataFrame([("hot", "new")], "ip string, c string"))
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k",
    }
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        got = merge_update_only(target, source, "ip", source_unique=True)
        counts = {(r.c, r.hot): r["count"] for r in got.groupBy("c", (F.col("ip") == "hot").alias("hot")).count().collect()}
    finally:
        for key in settings:
            spark.conf.unset(key)
    nulls = sum(1 for i in range(n) if i % 2 and i % 3 == 0)
    assert counts == {("new", True): n // 2, ("old", None): nulls, ("new", False): n - n // 2 - nulls}


keys = st.one_of(st.none(), st.integers(0, 6))
target_rows = st.lists(st.tuples(keys, st.sampled_from("abc"), st.integers(0, 3), st.just("t")), max_size=8)
source_rows = st.lists(
    st.tuples(keys, st.one_of(st.none(), st.sampled_from("xyz")), st.integers(0, 3)), max_size=6, unique_by=lambda r: r[0]
)


def expected(target, source):
    by_key = {r[0]: r for r in source if r[0] is not None}
    out = [(k, by_key[k][1], by_key[k][2], t) if k in by_key else (k, a, b, t) for k, a, b, t in target]
    known = {r[0] for r in target}
    return out + [(k, a, b, None) for k, a, b in source if k is None or k not in known]


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(target_rows, source_rows)
def test_merge_matches_a_plain_model_and_is_idempotent(spark, target, source):
    t, s = spark.createDataFrame(target, T), spark.createDataFrame(source, S)
    want = sorted(expected(target, source), key=str)
    for form in ({}, {"small_source": True}):
        once = merge(t, s, "id", **form)
        assert sorted(rows(once), key=str) == want
    complete = s.dropna(subset=["id"])
    once = merge(t, complete, "id")
    assert sorted(rows(merge(once, complete, "id")), key=str) == sorted(rows(once), key=str)
    assert merge_update_only(t, s, "id").count() == len(target)


def test_newest_per_key_keeps_null_keys(spark):
    df = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (None, "c", 1), (None, "d", 2)], S)
    got = newest_per_key(df, "id", [F.col("b").desc()])
    assert sorted(rows(got), key=str) == sorted([(1, "b", 2), (None, "c", 1), (None, "d", 2)], key=str)


def test_evolve_is_idempotent(target):
    once = evolve(target, [("a", "string"), ("n", "bigint")])
    assert once.columns == ["id", "a", "b", "kept", "n"]
    assert evolve(once, [("n", "bigint")]).columns == once.columns
