from __future__ import annotations

import datetime as dt

from conftest import plan
from pyspark.sql import functions as F

from engage.operators import attribution as A
from engage.operators import attribution_state as AS
from engage.queries.inputs import NAMES, ga_events


def test_days_across_words_and_before_the_epoch(spark, data_dir):
    flat = A.flatten_events(ga_events(spark, data_dir), NAMES).limit(400)
    days = [-65, -64, -1, 0, 63, 64, 19723, 20500]
    shift = F.get(F.array(*[F.lit(d) for d in days]), F.pmod("event_id", F.lit(len(days))).cast("int")).cast("bigint")
    spread = flat.withColumn("event_timestamp", shift * 86_400_000_000 + F.col("event_id")).localCheckpoint()
    want = {
        r[0]: sorted(r[1])
        for r in spread.groupBy("user_id").agg(F.collect_set(F.to_date(F.timestamp_micros("event_timestamp")))).collect()
    }
    state = AS.combine(AS.slice_state(spread))
    got = {r.user_id: r.days for r in AS.users_of(state).collect()}
    assert got == want and dt.date(1969, 12, 31) in {d for found in got.values() for d in found}
    # A slice alone has a row for each word; finishing it gives one row per user all the same.
    assert sorted(AS.finish(AS.slice_state(spread)).collect()) == sorted(A.attribution_full(spread).collect())


def test_events_and_sessions_pass_through_no_object_aggregate(spark, data_dir):
    flat = A.flatten_events(ga_events(spark, data_dir), NAMES)
    assert "ObjectHashAggregate" not in plan(AS.slice_state(flat))
    sessions = AS.combine(AS.slice_state(flat)).where(F.col(AS.SESSION).isNotNull()).select(AS.KEY, AS.SESSION)
    assert "ObjectHashAggregate" not in plan(sessions) and "min_by" not in plan(sessions)


def test_shards_are_ordered_before_they_are_wide(spark, data_dir):
    events = ga_events(spark, data_dir, shard="dt")
    optimized = events._jdf.queryExecution().optimizedPlan()
    assert "dt#" in optimized.outputOrdering().toString()
    assert not any("event_params" in c.output().toString() for c in _sorts(optimized))


def _sorts(node):
    children = node.children()
    found = [node] if node.nodeName() == "Sort" else []
    return found + [s for i in range(children.size()) for s in _sorts(children.apply(i))]


def test_an_empty_table_in_buckets_needs_no_python(spark, tmp_path):
    from engage.sources.bucketed import BucketedTable

    table = BucketedTable(spark, str(tmp_path / "table"))
    table.create("user_id string, n bigint, days array<date>")
    assert "LocalTableScan" in plan(table.read()) and table.read().dtypes == [("user_id", "string"), ("n", "bigint"), ("days", "array<date>")]
