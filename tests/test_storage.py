"""Versioned and bucketed tables, bronze writers, gold store, pipeline."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from strata.operators import layout
from strata.operators.scd2 import scd2_bootstrap, scd2_changes
from strata.plans.gold import GoldStore
from strata.plans.lakehouse import Lakehouse
from strata.session import delete_path, scratch_dir, scratch_scope, settle
from strata.sources import bronze
from strata.sources.bucketed import BucketedTable
from strata.sources.tables import capped_query, page_of, register_external, register_views, source_table
from strata.sources.versions import VersionedTable, live_versions
from strata.tables import Layer, Registry, TableSpec, database_name, layer_path
from tests.test_silver import bag


def ids(df):
    return sorted(r["id"] for r in df.collect())


def rows(spark, *values):
    return spark.createDataFrame([(v, str(v)) for v in values], "id INT, name STRING")


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, str(tmp_path / "t"))


def folders(path):
    return sorted(d for d in os.listdir(f"{path}/data") if d.startswith("_version"))


def test_versions_of_append_overwrite_append_restore(spark, table):
    table.append(rows(spark, 1), committed_at="2024-01-01")
    table.append(rows(spark, 2), committed_at="2024-01-02")
    table.overwrite(rows(spark, 9), committed_at="2024-01-03")
    table.append(rows(spark, 10), committed_at="2024-01-04")
    table.restore(1, committed_at="2024-01-05")
    assert [ids(table.as_of_version(v)) for v in range(5)] == [[1], [1, 2], [9], [9, 10], [1, 2]]
    assert ids(table.as_of_timestamp("2024-01-03 12:00:00")) == [9]
    assert ids(table.current()) == [1, 2]
    snapshots = {r["version"]: r["snapshot_id"] for r in table.commits().collect()}
    assert ids(table.as_of_snapshot(snapshots[3])) == [9, 10]
    with pytest.raises(LookupError, match="version 7"):
        table.as_of_version(7)
    with pytest.raises(LookupError, match="no commit at or before"):
        table.as_of_timestamp("2023-12-31")


def test_a_batch_id_is_stored_once_even_after_expiry(spark, table):
    first = table.append(rows(spark, 1), batch_id="b1")
    assert table.append(rows(spark, 1), batch_id="b1") == first
    table.append(rows(spark, 2), batch_id="b2")
    table.expire_keep_last(1)
    table.append(rows(spark, 1), batch_id="b1")
    assert ids(table.current()) == [1, 2]


def test_data_without_a_commit_is_ignored_and_replaced(spark, table):
    table.append(rows(spark, 1))
    rows(spark, 99).write.parquet(f"{table.path}/data/_version=1")
    assert ids(table.current()) == [1]
    table.append(rows(spark, 2))
    assert ids(table.current()) == [1, 2]


def test_expiry_keeps_what_kept_commits_read(spark, table):
    for day in range(1, 5):
        table.append(rows(spark, day), committed_at=f"2024-01-0{day}")
    table.expire_keep_last(2)
    table.expire_keep_last(1)  # a second run must not drop folders of expired appends
    assert ids(table.current()) == [1, 2, 3, 4]
    assert folders(table.path) == [f"_version={v}" for v in range(4)]
    table.overwrite(rows(spark, 7), committed_at="2024-01-05")
    removed = table.expire_by_age(24, now="2024-01-20")
    assert sorted(r["version"] for r in removed.collect()) == [0, 1, 2, 3]
    assert ids(table.current()) == [7] and folders(table.path) == ["_version=4"]
    with pytest.raises(LookupError):
        table.as_of_version(0)


def test_schema_evolves_per_version(spark, table):
    table.append(rows(spark, 1))
    table.append(rows(spark, 2).withColumn("extra", F.lit("x")))
    table.append(rows(spark, 3).drop("name"), drop_missing=True)
    assert table.as_of_version(0).columns == ["id", "name"]
    assert bag(table.as_of_version(1).select("id", "extra")) == [(1, None), (2, "x")]
    assert table.current().columns == ["id"]
    with pytest.raises(ValueError, match="change type"):
        table.append(rows(spark, 4).withColumn("id", F.col("id").cast("string")))


def test_create_if_missing_is_empty_and_idempotent(spark, table):
    schema = rows(spark, 1).schema
    table.create_if_missing(schema)
    assert table.current().count() == 0
    table.append(rows(spark, 1))
    table.create_if_missing(schema)
    assert ids(table.current()) == [1]


def test_commit_counts_come_from_the_write(spark, table):
    assert table.append(rows(spark, 1, 2, 3))["rows_added"] == 3
    assert table.append(rows(spark, 1).filter("false"))["rows_added"] == 0


def test_scd2_table_never_rewrites_history(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "d"), ("_is_current",))
    first = scd2_bootstrap(rows(spark, 1, 2), "2024-01-01").withColumn("_change", F.lit("insert"))
    table.apply_scd2(first, committed_at="2024-01-01")
    for day in (2, 3):
        batch = spark.createDataFrame([(1, f"v{day}")], "id INT, name STRING")
        changes = scd2_changes(table.current_rows(), batch, ["id"], f"2024-01-0{day}")
        commit = table.apply_scd2(changes, committed_at=f"2024-01-0{day}")
        assert (commit["rows_added"], commit["rows_removed"]) == (1, 1)
    assert [table.as_of_version(v).count() for v in range(3)] == [2, 3, 4]
    assert table.current_rows().count() == 2
    with pytest.raises(ValueError, match="merges only"):
        table.append(rows(spark, 5))
    closed = spark.read.parquet(f"{table.path}/data/_version=2/_is_current=false")
    assert [r["name"] for r in closed.collect()] == ["v2"]


def bucketed(spark, tmp_path, **options):
    return BucketedTable(spark, str(tmp_path / "b"), keys=("id",), n_buckets=8, **options)


def test_bucketed_merge_rewrites_touched_buckets_only(spark, tmp_path):
    table = bucketed(spark, tmp_path)
    table.merge(rows(spark, *range(100)))
    table.merge(spark.createDataFrame([(5, "five"), (200, "new")], "id INT, name STRING"))
    written = os.listdir(f"{table.path}/data/_version=1")
    assert 1 <= len([d for d in written if d.startswith("_bucket")]) <= 2
    got = {r["id"]: r["name"] for r in table.current().collect()}
    assert got == {**{i: str(i) for i in range(100)}, 5: "five", 200: "new"}
    assert ids(table.as_of_version(0)) == list(range(100))
    table.merge(spark.createDataFrame([(5, "again")], "id INT, name STRING"))
    assert {r["id"]: r["name"] for r in table.current().collect()} == {**got, 5: "again"}
    table.expire_keep_last(1)
    assert table.current().count() == 101
    table.restore(3 - 1)
    assert table.current().count() == 101


def test_bucketed_merge_takes_new_columns_and_checks_its_layout(spark, tmp_path):
    table = bucketed(spark, tmp_path)
    table.merge(rows(spark, *range(20)))
    table.merge(spark.createDataFrame([(1, "x", 7)], "id INT, name STRING, score INT"))
    got = {r["id"]: r["score"] for r in table.current().collect()}
    assert len(got) == 20 and got[1] == 7 and got[2] is None
    other = BucketedTable(spark, table.path, keys=("id",), n_buckets=4)
    with pytest.raises(ValueError, match="8 buckets"):
        other.merge(rows(spark, 1))
    with pytest.raises(NotImplementedError):
        table.append(rows(spark, 1))


def test_bucketed_scd2_replay_writes_no_data(spark, tmp_path):
    table = bucketed(spark, tmp_path, partition_cols=("_is_current",))
    table.merge_scd2(rows(spark, *range(50)), "2024-01-01")
    batch = spark.createDataFrame([(1, "x"), (2, "2"), (60, "new")], "id INT, name STRING")
    commit = table.merge_scd2(batch, "2024-01-02")
    assert (commit["rows_added"], commit["rows_removed"]) == (2, 1)
    replay = table.merge_scd2(batch, "2024-01-03")
    assert (replay["rows_added"], replay["buckets"]) == (0, [])
    assert "_version=2" not in folders(table.path)
    assert table.current().count() == 52 and table.current_rows().count() == 51
    assert table.as_of_version(0).count() == 50


def test_bucketed_scd2_merges_again_after_a_rewrite(spark, tmp_path):
    table = bucketed(spark, tmp_path, partition_cols=("_is_current",))
    table.merge_scd2(rows(spark, *range(30)), "2024-01-01")
    table.merge_scd2(spark.createDataFrame([(1, "x")], "id INT, name STRING"), "2024-01-02")
    layout.optimize(table)
    assert (table.current().count(), table.current_rows().count()) == (31, 30)
    table.merge_scd2(spark.createDataFrame([(2, "y")], "id INT, name STRING"), "2024-01-03")
    assert (table.current().count(), table.current_rows().count()) == (32, 30)
    table.restore(0)
    table.merge_scd2(spark.createDataFrame([(3, "z")], "id INT, name STRING"), "2024-01-04")
    assert (table.current().count(), table.current_rows().count()) == (31, 30)
    with pytest.raises(ValueError, match="sort_cols"):
        layout.optimize(table, ["name"])


def test_zorder_of_a_partitioned_table_keeps_files_few(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), ("day",))
    df = spark.range(4000).select("id", (F.xxhash64("id") % 100).alias("a"), (F.col("id") % 10).alias("day"))
    table.append(df.repartition(4))
    size = layout.table_stats(layout.live_files(table)).first()["size_bytes"]
    record = layout.optimize(table, ["a", "id"], target_bytes=size // 8).first()
    # eight ranges over ten days: each range border adds at most one file
    assert record["files_before"] == 40 and record["files_after"] <= 19
    assert table.current().count() == 4000


def test_bronze_append_counts_and_partitions(spark, tmp_path):
    path = str(tmp_path / "bronze")
    wrote = bronze.append(rows(spark, 1, 2), path, "crm", "b1", "2024-01-02", sort_cols=["id"], even_files=True)
    bronze.append(rows(spark, 3).withColumn("extra", F.lit(1)), path, "crm", "b2", "2024-01-03")
    assert wrote == 2
    assert sorted(d for d in os.listdir(path) if "=" in d) == ["_ingestion_date=2024-01-02", "_ingestion_date=2024-01-03"]
    assert ids(bronze.read(spark, path)) == [1, 2, 3]
    assert "extra" in bronze.read(spark, path).columns


def test_hidden_days_prune_and_stay_hidden(spark, tmp_path):
    path = str(tmp_path / "days")
    df = spark.range(10).select("id", (F.lit("2024-01-01").cast("timestamp_ntz") + F.make_dt_interval("id")).alias("ts"))
    bronze.append_by_day(df, path, "ts")
    got = bronze.read_days(spark, path, "ts", "2024-01-03 00:00:00", "2024-01-05 00:00:00")
    assert got.columns == ["id", "ts"] and ids(got) == [2, 3]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(_day" in plan


def test_json_landing_folders_and_epoch_stamps(spark, tmp_path):
    path = str(tmp_path / "raw")
    stamped = rows(spark, 1).withColumn("_ingestion_ts", F.lit("2024-01-02 03:04:05.5").cast("timestamp_ntz"))
    assert bronze.land_json(stamped, path) == 1
    folder = f"{path}/y=2024/m=01/d=02/h=03"
    name = next(f for f in os.listdir(folder) if f.endswith(".json"))
    assert json.loads(open(f"{folder}/{name}").read())["_ingestion_ts"] == 1704164645.5
    back = bronze.read_json(spark, path, stamped.schema).first()
    assert back["_ingestion_ts"] == dt.datetime(2024, 1, 2, 3, 4, 5, 500000)


def test_gold_build_incremental_refresh(spark, tmp_path):
    store = GoldStore(spark, str(tmp_path / "gold"))
    register_views(spark, {"g_src": rows(spark, 1, 2)})
    query = ("g", "SELECT id, name FROM g_src;", "id", "id % 2", ["name"])
    assert store.build_incremental(*query) == 2  # first run loads everything
    register_views(spark, {"g_src": rows(spark, 1, 2, 3)})
    assert store.build_incremental(*query) == 1
    assert ids(store.read("g")) == [1, 2, 3] and store.read("g").columns == ["id", "name"]
    register_views(spark, {"g_src": rows(spark, 8)})
    assert GoldStore(spark, store.root).refresh("g") == 1
    assert ids(store.read("g")) == [8]


def test_external_tables_and_capped_queries(spark, tmp_path):
    path = str(tmp_path / "ext")
    rows(spark, *range(150)).write.parquet(path)
    register_external(spark, "ext_people", path)
    register_external(spark, "ext_people", path)
    assert source_table(spark, None, "ext_people").count() == 150
    assert capped_query(spark, "SELECT * FROM ext_people ;\n").count() == 100
    page = page_of(spark.table("ext_people").orderBy("id"), 5).collect()
    assert [r["id"] for r in page] == [0, 1, 2, 3, 4] and page[0]["row_count"] == 150
    spark.sql("DROP TABLE ext_people")
    assert os.path.isdir(path)
    rows(spark, 1, 2).write.saveAsTable("managed_people")
    try:
        with pytest.raises(ValueError, match="managed"):
            register_external(spark, "managed_people", path)
        assert spark.table("managed_people").count() == 2
    finally:
        spark.sql("DROP TABLE managed_people")


def test_registry_keys_by_layer_and_name():
    registry = Registry("/lake/")
    silver = registry.register(TableSpec("orders", Layer.SILVER, keys=("order_id",), scd_type=2))
    assert registry.get("silver", "orders") is silver
    assert registry.get("bronze", "orders").layer is Layer.BRONZE
    assert registry.get("gold", "new").scd_type == 1
    assert registry.path(silver) == "/lake/silver/orders" == layer_path("/lake", "silver", "orders")
    assert TableSpec("t", Layer.SILVER).dedupe_keys == ("id",)
    assert (database_name(None, "dev"), database_name(" gold ", "dev")) == ("dev", "gold")
    with pytest.raises(ValueError):
        TableSpec("t", Layer.SILVER, scd_type=3)
    with pytest.raises(ValueError):
        layer_path("/lake", "copper", "x")


def test_pipeline_reports_and_refuses_old_batches(spark, tmp_path):
    lake = Lakehouse(spark, str(tmp_path / "lake"), n_buckets=4)
    lake.register(TableSpec("people", Layer.SILVER, keys=("id",), scd_type=2))
    lake.register(TableSpec("people", Layer.BRONZE, schema=rows(spark, 1).schema))
    got = lake.ingest("people", rows(spark, 1, 1, 2), "crm", "b1", "2024-01-01")
    assert (got.rows_added, got.version, got.batch_id) == (3, 0, "b1")
    first = lake.promote("people", as_of="2024-01-01").first()
    assert (first.rows_in, first.rows_out, first.duplicates_dropped) == (3, 2, 1)
    assert (first.scd2_inserts, first.scd2_updates) == (2, 0)
    with pytest.raises(ValueError, match="not after"):
        lake.promote("people", as_of="2024-01-01")
    with pytest.raises(ValueError, match="declared schema"):
        lake.ingest("people", rows(spark, 1).withColumn("x", F.lit(1)), "crm")
    # a type-1 table is replaced whole
    result = lake.promote("plain", rows(spark, 1, 1, 3).withColumn("_ingestion_ts", F.lit(1))).first()
    assert (result.rows_out, result.scd2_inserts) == (2, 2)
    assert ids(lake.table("silver", "plain").current()) == [1, 3]


def test_materialize_strategies(spark, tmp_path):
    lake = Lakehouse(spark, str(tmp_path / "lake"), n_buckets=4)
    lake.register(TableSpec("facts", Layer.SILVER, keys=("id",)))
    lake.materialize("silver", "facts", rows(spark, 1, 2), "merge")
    lake.materialize("silver", "facts", rows(spark, 2, 3), "merge")
    assert ids(lake.table("silver", "facts").current()) == [1, 2, 3]
    lake.materialize("silver", "log", rows(spark, 1), "append")
    lake.materialize("silver", "log", rows(spark, 1), "append")
    assert ids(lake.table("silver", "log").current()) == [1, 1]
    lake.materialize("silver", "log", rows(spark, 5))
    assert ids(lake.table("silver", "log").current()) == [5]
    with pytest.raises(ValueError, match="strategy"):
        lake.materialize("silver", "log", rows(spark, 5), "other")
    report = lake.maintain([{"layer": "silver", "name": "log"}, {"layer": "silver", "name": "absent"}]).collect()
    assert [r["status"] for r in report] == ["OK", "ERR"]


def test_scratch_lives_under_the_shared_folder(spark):
    base = spark.conf.get("spark.checkpoint.dir", None)
    one, two = scratch_dir(spark, "x"), scratch_dir(spark, "x")
    assert one != two
    if base:
        assert one.startswith(base)
    assert settle(rows(spark, 1)).count() == 1


def test_marks_are_kept_with_the_write(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    rows = spark.createDataFrame([(9, "2024-01-01"), (10, None), (None, "2023-01-01")], "n LONG, d STRING")
    assert table.mark("n") is None
    table.append(rows, mark_col="n")
    table.append(rows.filter("n = 9"), mark_col="n")
    assert table.mark("n") == "10"
    table.append(rows.filter("n IS NULL"), mark_col="d")
    assert (table.mark("n"), table.mark("d")) == ("10", "2023-01-01")
    table.append(rows.limit(0), mark_col="n")
    assert table.mark("n") == "10"


def test_gold_mark_needs_no_column_scan(spark, tmp_path):
    store = GoldStore(spark, str(tmp_path / "g"))
    register_views(spark, {"mark_rows": spark.range(10).selectExpr("id AS n", "id * 2 AS v")})
    store.build_incremental("t", "SELECT * FROM mark_rows", "n")
    register_views(spark, {"mark_rows": spark.range(15).selectExpr("id AS n", "id * 3 AS v")})
    seen = []
    real = VersionedTable.current
    try:
        VersionedTable.current = lambda self: seen.append(self.path) or real(self)
        assert store.build_incremental("t", "SELECT * FROM mark_rows", "n") == 5
    finally:
        VersionedTable.current = real
    assert seen == []
    assert bag(store.read("t").select("n")) == bag(spark.range(15))


def test_gold_lookback_settles_and_takes_late_rows(spark, tmp_path):
    store = GoldStore(spark, str(tmp_path / "g"))
    rows = []

    def run(*more):
        rows.extend(more)
        register_views(spark, {"open_rows": spark.createDataFrame(rows, "n INT, d DATE")})
        store.build_incremental("t", "SELECT * FROM open_rows", "d", lookback="5 days")
        return sorted(r["n"] for r in store.read("t").collect())

    day = [dt.date(2024, 1, i) for i in range(1, 31)]
    assert run((1, day[0]), (2, day[9]), (3, None)) == [1, 2, 3]
    assert run((4, day[6]), (5, day[19]), (6, None)) == [1, 2, 3, 4, 5, 6]
    assert run((7, day[17]), (8, day[0])) == [1, 2, 3, 4, 5, 6, 7]  # the first day is settled
    assert store.read("t").columns == ["n", "d"]
    files = VersionedTable(spark, f"{tmp_path}/g/t")
    assert files.as_of_version(0).count() == 3 and files.as_of_version(1).count() == 6
    with pytest.raises(ValueError):
        store.build_incremental("t", "SELECT * FROM open_rows", "d")


def test_unfinished_batches_are_removed_and_written_whole(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "b")
    rows = spark.range(10)
    assert bronze.append(rows, path, "s", "old", "2024-01-01") == 10
    delete_path(spark, f"{path}/{bronze.LEDGER}")  # as a folder from before the ledger
    assert bronze.append(rows, path, "s", "b1", "2024-01-01") == 10
    assert bronze.append(rows, path, "s", "old", "2024-01-01") == 0
    real = bronze.BatchLedger.finish

    def dies(self, batch_id):
        raise RuntimeError("lost")

    monkeypatch.setattr(bronze.BatchLedger, "finish", dies)
    with pytest.raises(RuntimeError):
        bronze.append(rows, path, "s", "b 2/ü", "2024-01-02")
    monkeypatch.setattr(bronze.BatchLedger, "finish", real)
    assert bronze.append(rows, path, "s", "b 2/ü", "2024-01-02") == 10
    assert bronze.append(rows, path, "s", "b 2/ü", "2024-01-02") == 0
    assert spark.read.parquet(path).count() == 30


def test_liveness_of_versions(spark):
    commits = spark.createDataFrame([(v, b) for v, b in enumerate([0, 0, 0, 3, 3, 5, 5, 5])], "version LONG, base LONG")

    def live(*kept):
        keep = commits.filter(F.col("version").isin(*kept))
        return sorted(r["version"] for r in live_versions(commits, keep).collect())

    assert live(7) == [5, 6, 7] and live(4) == [3, 4] and live(1, 5) == [0, 1, 5] and live(2, 7) == [0, 1, 2, 5, 6, 7]


def test_scratch_of_finished_work_is_deleted(spark, tmp_path):
    made = []
    with scratch_scope(spark):
        made.append(scratch_dir(spark, "outer"))
        settle(spark.range(3), "outer").count()
        with scratch_scope(spark):
            made.append(scratch_dir(spark, "inner"))
            spark.range(3).write.parquet(made[-1])
        assert not os.path.exists(made[-1])
        spark.range(3).write.parquet(made[0])
    assert not os.path.exists(made[0])
    with pytest.raises(RuntimeError), scratch_scope(spark):
        made.append(scratch_dir(spark, "failed"))
        spark.range(3).write.parquet(made[-1])
        raise RuntimeError
    assert os.path.exists(made[-1])
    root = os.path.dirname(made[-1])
    before = set(os.listdir(root))
    table = BucketedTable(spark, str(tmp_path / "m"), keys=("id",), n_buckets=2)
    for i in range(2):
        table.merge(rows(spark, 1, 2, 3 + i))
    assert ids(table.current()) == [1, 2, 3, 4] and set(os.listdir(root)) == before
