"""Bucketed tables: what a mutation rewrites, commits under concurrency, change feeds."""

from __future__ import annotations

import glob
import random
from collections import Counter

import pytest
from conftest import rows
from pyspark.sql import functions as F

from engage.operators.diff import apply_changes, change_counts, row_changes
from engage.operators.merge import merge
from engage.sources import files
from engage.sources.bucketed import NO_KEY, BucketedTable, Conflict, Version

SCHEMA = "user_id string, v int, name string"


@pytest.fixture()
def table(spark, tmp_path):
    made = BucketedTable(spark, str(tmp_path / "users"), buckets=100)
    assert made.create(SCHEMA) is True and made.create(SCHEMA) is False
    return made


def made(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def users(spark, n):
    return spark.range(n).select(F.concat(F.lit("u"), "id").alias("user_id"), F.col("id").cast("int").alias("v"), F.lit("old").alias("name"))


def data_files(table):
    return set(glob.glob(f"{table.path}/data/**/*.parquet", recursive=True))


def test_a_record_round_trips():
    version = Version(3, "`a` int", "a", 8, {-1: ["data/x"], 7: ["data/y", "data/z"]}, "it's \"noted\"")
    assert Version.parse(version.text()) == version


def test_a_file_is_written_once(spark, tmp_path):
    path = str(tmp_path / "commits" / "1.json")
    assert files.write_new(spark, path, "first é") is True
    assert files.write_new(spark, path, "second") is False
    assert files.read_text(spark, path) == "first é" and files.names(spark, str(tmp_path / "commits")) == ["1.json"]
    assert files.names(spark, str(tmp_path / "none")) == []


def test_a_merge_rewrites_the_buckets_of_its_keys_alone(spark, table):
    table.append(users(spark, 5000))
    before, old = table.head(), data_files(table)
    one = before.folders.keys() - {NO_KEY}
    assert len(one) == 100
    keys = table.read(before, [17]).select("user_id").limit(20)
    increment = made(spark, [(r.user_id, -1, "new") for r in keys.collect()])
    table.merge(increment)
    after = table.head()
    assert {b for b in after.folders if after.folders[b] != before.folders.get(b)} == {17}
    fresh = data_files(table) - old
    assert fresh and all("__bucket=17/" in f for f in fresh)  # 1 % of the buckets, 1 % of the files
    assert table.count() == 5000 and table.read().where("v = -1").count() == increment.count()
    assert table.read(before).where("v = -1").count() == 0  # readers of the older version are not disturbed


@pytest.mark.parametrize("seed", range(3))
def test_merges_equal_those_of_whole_tables(spark, tmp_path, seed):
    r = random.Random(seed)
    key = lambda: r.choice([None, *(f"u{k}" for k in range(40))])
    target = {k: (k, r.randrange(9), "t") for k in (key() for _ in range(25)) if k}
    start = [*target.values(), (None, 1, "t"), (None, 1, "t")]
    source = [*{k: (k, r.randrange(9), "s") for k in (key() for _ in range(15)) if k}.values(), (None, 5, "s")]
    for n, (update, insert) in enumerate(((None, None), (["v"], ["user_id", "name"]), ([], None))):
        own = BucketedTable(spark, str(tmp_path / f"t{n}"), buckets=7)
        own.create(SCHEMA)
        own.append(made(spark, start))
        own.merge(made(spark, source), update, insert)
        want = merge(made(spark, start), made(spark, source), "user_id", update, insert)
        assert Counter(rows(own.read())) == Counter(rows(want))


def test_an_update_by_another_column_rewrites_the_buckets_where_it_matches(spark, table):
    table.append(users(spark, 300).withColumn("name", F.when(F.col("v") == 7, "ip7").otherwise("other")))
    before = table.head()
    table.merge_update_only(spark.createDataFrame([("ip7", 7000), ("ip8", 80)], "name string, v int"), on="name")
    after = table.head()
    assert len([b for b in after.folders if after.folders[b] != before.folders[b]]) == 1
    assert rows(table.read().where("v = 7000").select("user_id")) == [("u7",)] and table.count() == 300


def test_columns_are_added_and_old_folders_stay(spark, table):
    table.append(users(spark, 200))
    before = table.head()
    table.merge_update_only(spark.createDataFrame([("u5", "x")], "user_id string, extra string"))
    assert table.read().columns == ["user_id", "v", "name", "extra"]
    assert rows(table.read().where("extra IS NOT NULL").select("user_id", "extra")) == [("u5", "x")] and table.count() == 200
    assert len([b for b in before.folders if table.head().folders[b] != before.folders[b]]) == 1


def test_repeated_source_keys_are_refused_and_nothing_changes(spark, table):
    table.append(made(spark, [("a", 1, "x")]))
    before = table.head()
    with pytest.raises(Exception, match="several source rows"):
        table.merge(made(spark, [("a", 2, "y"), ("a", 3, "z")]))
    assert table.head() == before and rows(table.read()) == [("a", 1, "x")]


# --- writers at the same time ---------------------------------------------------------------------------------------
def test_a_replacement_made_from_an_older_version_is_refused(spark, table):
    table.append(made(spark, [("a", 1, "x")]))
    base = table.head()
    computed = table.read(base).withColumn("v", F.col("v") + 1)
    table.merge(made(spark, [("b", 5, "y")]))  # another writer, after the read
    with pytest.raises(Conflict):
        table.replace(computed, base)
    assert rows(table.read()) == [("a", 1, "x"), ("b", 5, "y")]


def test_an_append_during_a_replacement_is_not_lost(spark, table):
    table.append(made(spark, [("a", 1, "x")]))
    base = table.head()
    folders = table.write(base, table.read(base))
    table.append(made(spark, [("a", 2, "late")]))  # while the other one writes
    with pytest.raises(Conflict):
        table.commit(base, folders, set(base.folders), None)
    assert table.count() == 2


def test_two_writers_of_one_version_do_not_both_win(spark, table):
    table.append(made(spark, [("a", 1, "x")]))
    base = table.head()
    bucket = next(iter(base.folders))
    first, second = (table.write(base, made(spark, [("a", v, "w")])) for v in (2, 3))
    table.commit(base, first, [bucket])
    with pytest.raises(Conflict):
        table.commit(base, second, [bucket])
    assert rows(table.read()) == [("a", 2, "w")]


def test_writers_of_other_buckets_and_appends_go_on(spark, table):
    table.append(users(spark, 50))
    base = table.head()
    keys = {b: r.user_id for r in table.read().collect() for b in table.touched(base, made(spark, [tuple(r)]).select("user_id"))}
    (one, a), (two, b) = list(keys.items())[:2]
    first, second = table.write(base, table.read(base, [one]).withColumn("v", F.lit(-1))), table.write(base, table.read(base, [two]).withColumn("v", F.lit(-2)))
    table.commit(base, first, [one])
    table.commit(base, second, [two])
    table.append(made(spark, [(a, 9, "again")]), note="n")
    assert table.note() == "n" and table.count() == 51
    values = {r.user_id: r.v for r in table.read().where("name = 'old'").collect()}
    assert values[a] == -1 and values[b] == -2
    with pytest.raises(Conflict):
        table.append(made(spark, [("z", 1, "y")]), base=base)


def test_unused_folders_are_deleted_and_versions_kept_can_be_read(spark, table):
    for k in range(4):
        table.reload(made(spark, [("a", k, "x")]))
    table.write(table.head(), made(spark, [("b", 1, "died before its commit")]))
    assert table.vacuum(keep=2) == 3 + 2 + 1  # records of versions 0 to 2, folders of two of them, the unused one
    assert [rows(table.read(table.version(n)))[0][1] for n in table.versions()] == [2, 3]
    table.flush()
    assert table.count() == 0 and table.read().columns == ["user_id", "v", "name"]


# --- change feed ----------------------------------------------------------------------------------------------------
def test_changes_between_versions(spark, table):
    table.append(made(spark, [("a", 1, "x"), ("b", 2, "y"), ("c", 3, None)]))
    old = table.head()
    table.merge(made(spark, [("b", 2, "y"), ("c", 3, "now"), ("d", 4, "new"), (None, 5, "lost")]))
    feed = table.changes(old, table.head())
    got = {(r.user_id, r._change): (r.before and tuple(r.before), r.after and tuple(r.after)) for r in feed.collect()}
    assert got == {
        ("c", "update"): (("c", 3, None), ("c", 3, "now")),
        ("d", "insert"): (None, ("d", 4, "new")),
        (None, "insert"): (None, (None, 5, "lost")),
    }
    assert tuple(change_counts(feed).first()) == (2, 1, 0, 3)
    assert rows(apply_changes(table.read(old), feed)) == rows(table.read())


@pytest.mark.parametrize("seed", range(6))
def test_applying_changes_gives_the_newer_version(spark, seed):
    r = random.Random(seed)
    row = lambda: (r.choice([None, *"abcde"]), r.choice([None, 1, 2]), r.choice([None, "x", ""]))
    old, new = [row() for _ in range(r.choice([0, 5, 40]))], [row() for _ in range(30)]
    new += old[:20]
    before, after = made(spark, old), made(spark, new)
    feed = row_changes(before, after, "user_id")
    assert Counter(rows(apply_changes(before, feed))) == Counter(rows(after))
    gone, come = Counter(old) - Counter(new), Counter(new) - Counter(old)
    kinds = Counter(f._change for f in feed.collect())
    paired = sum(min(sum(n for k, n in gone.items() if k[0] == key), sum(n for k, n in come.items() if k[0] == key)) for key in "abcde")
    assert kinds == Counter({k: n for k, n in (("update", paired), ("delete", gone.total() - paired), ("insert", come.total() - paired)) if n})
    assert row_changes(after, after, "user_id").count() == 0
