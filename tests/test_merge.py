"""Upserts, type-2 merges, change feeds, schema sync, incremental loads."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from strata.operators.cdc import cdc_apply
from strata.operators.incremental import high_water_mark, newer_than, newer_than_value
from strata.operators.merge import checked_keys, merge_counts, upsert
from strata.operators.scd2 import (
    out_of_order,
    scd2_bootstrap,
    scd2_changes,
    scd2_changes_small_batch,
    scd2_merge,
    scd2_metrics,
)
from strata.operators.schema_sync import conform, schema_changes, sync_append
from tests.test_silver import bag

DIM = "id INT, name STRING"


def frame(spark, rows, schema=DIM):
    return spark.createDataFrame(rows, schema)


def test_upsert_replaces_inserts_and_keeps(spark):
    target = frame(spark, [(1, "a"), (2, "b"), (None, "n")])
    source = frame(spark, [(2, "B"), (3, "C"), (None, "N")])
    assert bag(upsert(target, source, ["id"])) == bag(
        frame(spark, [(1, "a"), (2, "B"), (3, "C"), (None, "n"), (None, "N")])
    )
    assert tuple(merge_counts(target, source, ["id"]).first()) == (1, 2)


def test_upsert_of_named_columns_keeps_the_rest(spark):
    schema = "id INT, name STRING, born INT"
    target = frame(spark, [(1, "a", 1), (2, "b", 1), (None, "n", 1)], schema)
    source = frame(spark, [(2, None, 9), (3, "c", 9), (None, "N", 9)], schema)
    got = upsert(target, source, ["id"], ["name"])
    want = [(1, "a", 1), (2, None, 1), (3, "c", 9), (None, "n", 1), (None, "N", 9)]
    assert bag(got) == bag(frame(spark, want, schema))


def dimension(spark, rows, at="2024-01-01 00:00:00"):
    return scd2_bootstrap(frame(spark, rows), at)


def state(df):
    cols = ["id", "name", "_is_current", F.col("_valid_from").cast("date").cast("string"),
            F.col("_valid_to").cast("date").cast("string")]
    return bag(df.select(*cols))


@pytest.mark.parametrize("small", [False, True])
def test_scd2_closes_and_inserts_in_one_run(spark, small):
    dim = dimension(spark, [(1, "a"), (2, "b"), (4, None)])
    batch = frame(spark, [(1, "A"), (2, "b"), (3, "c"), (4, "d")])
    merged = scd2_merge(dim, batch, ["id"], "2024-02-01 00:00:00", small_batch=small)
    assert state(merged) == sorted(
        [
            (1, "a", False, "2024-01-01", "2024-02-01"),
            (1, "A", True, "2024-02-01", None),
            (2, "b", True, "2024-01-01", None),
            (3, "c", True, "2024-02-01", None),
            (4, None, False, "2024-01-01", "2024-02-01"),
            (4, "d", True, "2024-02-01", None),
        ],
        key=repr,
    )


def test_scd2_replay_changes_nothing(spark):
    dim = dimension(spark, [(1, "a"), (2, "b")])
    batch = frame(spark, [(1, "A"), (3, "c")])
    once = scd2_merge(dim, batch, ["id"], "2024-02-01 00:00:00")
    twice = scd2_merge(once, batch, ["id"], "2024-03-01 00:00:00")
    assert state(twice) == state(once)
    changes = scd2_changes(once.filter("_is_current"), batch, ["id"], "2024-03-01 00:00:00")
    assert tuple(scd2_metrics(changes).first()) == (0, 0)


def test_scd2_detects_batches_that_are_not_newer(spark):
    dim = dimension(spark, [(1, "a")], "2024-02-01 00:00:00")
    assert out_of_order(dim, "2024-01-15 00:00:00").count() == 1
    assert out_of_order(dim, "2024-02-02 00:00:00").count() == 0


batches = st.lists(
    st.dictionaries(st.integers(0, 5), st.sampled_from(["a", "b", None]), max_size=5), min_size=1, max_size=3
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(first=st.dictionaries(st.integers(0, 5), st.sampled_from(["a", "b", None]), max_size=5), later=batches)
def test_scd2_against_a_dictionary(spark, first, later):
    """One current row per key with the last value sent; intervals never overlap."""
    dim = dimension(spark, list(first.items()))
    latest, versions = dict(first), {k: 1 for k in first}
    for day, batch in enumerate(later, start=2):
        sent = frame(spark, list(batch.items()))
        at = f"2024-01-{day:02d} 00:00:00"
        small = scd2_changes_small_batch(dim.filter("_is_current"), sent, ["id"], at)
        wide = scd2_changes(dim.filter("_is_current"), sent, ["id"], at)
        assert bag(small.select(*wide.columns)) == bag(wide)
        dim = scd2_merge(dim, sent, ["id"], at)
        dim = spark.createDataFrame(dim.collect(), dim.schema)
        for key, value in batch.items():
            if key not in latest or latest[key] != value:
                versions[key] = versions.get(key, 0) + 1
            latest[key] = value
    rows = dim.collect()
    assert {r["id"]: r["name"] for r in rows if r["_is_current"]} == latest
    assert len([r for r in rows if r["_is_current"]]) == len(latest)
    for key, count in versions.items():
        spans = sorted((r for r in rows if r["id"] == key), key=lambda r: r["_valid_from"])
        assert len(spans) == count
        assert all(a["_valid_to"] == b["_valid_from"] for a, b in zip(spans, spans[1:]))


def test_change_feed_applies_the_newest_change(spark):
    target = frame(spark, [(1, "a"), (2, "b"), (3, "c")])
    feed = frame(
        spark,
        [(1, "x", "u", 1), (1, "y", "u", 2), (2, None, "d", 5), (4, "n", "c", 1), (5, "o", "c", 1), (5, None, "DELETE", 2)],
        "id INT, name STRING, op STRING, change_ts INT",
    )
    assert bag(cdc_apply(target, feed, ["id"])) == [(1, "y"), (3, "c"), (4, "n")]


def test_schema_sync_adds_drops_and_casts(spark):
    stored = frame(spark, [(1, "a", 5)], "id INT, old STRING, n INT")
    batch = frame(spark, [(2, 7, "new")], "id INT, n BIGINT, fresh STRING")
    assert schema_changes(stored.schema, batch.schema) == {"added": ["fresh"], "dropped": ["old"], "retyped": ["n"]}
    assert bag(sync_append(stored, batch)) == [(1, 5, None), (2, 7, "new")]


def test_conform_casts_fills_and_refuses_unknown_columns(spark):
    schema = frame(spark, [], "id BIGINT, name STRING").schema
    assert bag(conform(frame(spark, [(1,)], "id INT"), schema)) == [(1, None)]
    with pytest.raises(ValueError, match="extra"):
        conform(frame(spark, [(1, 2)], "id INT, extra INT"), schema)


def test_incremental_marks(spark):
    rows = frame(spark, [(1, "2024-01-01"), (2, "2024-01-03"), (3, "2024-01-05")], "id INT, d STRING")
    rows = rows.withColumn("d", F.to_date("d"))
    assert [r["id"] for r in newer_than(rows, "d", rows.filter("id = 2")).collect()] == [3]
    assert newer_than(rows, "d", rows.filter("false")).count() == 3
    old = rows.unionByName(frame(spark, [(4, None), (5, "1950-01-01")], "id INT, d STRING").withColumn("d", F.to_date("d")))
    assert newer_than(old, "d", old.filter("false")).count() == 5  # a first run takes every row
    assert newer_than(old, "id", old.filter("false")).count() == 5
    assert high_water_mark(old.filter("false"), "id").first()[0] is None
    assert sorted(r["id"] for r in newer_than(old, "id", old.filter("id < 4")).collect()) == [4, 5]
    late = newer_than(rows, "d", rows.filter("id = 3"), lookback="3 days")
    assert sorted(r["id"] for r in late.collect()) == [2, 3]
    assert str(high_water_mark(rows.filter("false"), "d").first()[0]) == "1970-01-01"
    assert newer_than_value(rows, "d", "2024-01-03").count() == 1


def test_the_mark_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).select("id", (F.col("id") % 4).alias("p")).write.partitionBy("p").parquet(path)
    df = spark.read.parquet(path)
    plan = newer_than(df, "id", df, partition_col=None)._jdf.queryExecution().executedPlan().toString()
    assert "DataFilters: [isnotnull(id" in plan and "subquery" in plan.lower()


def test_keys_that_cannot_be_merged_are_refused(spark):
    target = frame(spark, [(1, "a")], "id INT, v STRING")
    twice, none = (frame(spark, b, "id INT, v STRING") for b in ([(2, "x"), (2, "y")], [(None, "x")]))
    with pytest.raises(ValueError, match="repeated"):
        upsert(target, twice, ["id"])
    with pytest.raises(ValueError, match="null"):
        checked_keys(none, ["id"])
    current = scd2_bootstrap(target, "2024-01-01")
    with pytest.raises(Exception, match="null key id"):
        scd2_merge(current, frame(spark, [(None, "x")], "id INT, v STRING"), ["id"], "2024-01-02").collect()
    gone = upsert(target, frame(spark, [(3, "c")], "id INT, v STRING"), ["id"], deleted=frame(spark, [(1,)], "id INT"))
    assert bag(gone) == [(3, "c")]


def test_type_2_columns_come_and_go(spark):
    base = scd2_bootstrap(frame(spark, [(1, "a"), (2, "b")], "id INT, v STRING"), "2024-01-01")
    wider = frame(spark, [(1, "a", None), (2, "b", 5)], "id INT, v STRING, w INT")
    merged = scd2_merge(base, wider, ["id"], "2024-01-02")
    got = bag(merged.select("id", "v", "w", "_is_current"))
    assert set(got) == {(1, "a", None, True), (2, "b", None, False), (2, "b", 5, True)}
    for small in (False, True):
        again = scd2_merge(merged, wider, ["id"], "2024-01-03", small_batch=small)
        assert bag(again.select("id", "v", "w", "_is_current")) == got  # a replay changes nothing
        narrow = scd2_merge(merged, frame(spark, [(2, "b")], "id INT, v STRING"), ["id"], "2024-01-03", small_batch=small)
        assert (2, "b", None, True) in bag(narrow.select("id", "v", "w", "_is_current"))
