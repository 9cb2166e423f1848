"""Writers, gold refreshes and versioned tables: written, then read back."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.checks import merging
from strata.checks.fixtures import (
    AS_OF,
    bronze_customers,
    bronze_orders,
    order_batches,
    round_of,
    table,
    with_inputs,
)
from strata.checks.merging import FIRST_LOAD, HASHED
from strata.checks.silver_gold import _LTV, _MODELS, customer_ltv, customers, facts
from strata.functions import epoch_batch_id, with_ingest_metadata
from strata.operators import layout
from strata.operators.dedupe import dedupe_latest, to_silver
from strata.operators.scd2 import scd2_bootstrap, scd2_changes
from strata.plans import models
from strata.plans.gold import GoldStore
from strata.plans.lakehouse import Lakehouse
from strata.session import scratch_dir, settle
from strata.sources import bronze
from strata.sources.bucketed import BucketedTable
from strata.sources.tables import capped_query, page_of, register_external, register_views
from strata.sources.versions import VersionedTable, latest_commit
from strata.tables import Layer, TableSpec, database_name, layer_path

DAYS = ["2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00"]


# -- bronze ----------------------------------------------------------------


def bronze_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two appends on two days, read back from their date partitions."""
    path = scratch_dir(spark, "bronze")
    orders = table(spark, sf_dir, "orders")
    for batch, day in enumerate(DAYS[:2]):
        bronze.append(orders, path, "orders_api", batch_id=f"b{batch}", as_of=day)
    return bronze.read(spark, path)


def day_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A range of one column, answered from the hidden day partitions."""
    path = scratch_dir(spark, "events")
    bronze.append_by_day(table(spark, sf_dir, "events"), path, "ts", sort_cols=["user_id", "ts"])
    return bronze.read_days(spark, path, "ts", "2024-01-05 06:00:00", "2024-01-12 18:00:00")


def json_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "landing")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    rows = with_ingest_metadata(orders, "api", epoch_batch_id("api", AS_OF), AS_OF, with_date=False)
    bronze.land_json(rows, path)
    return bronze.read_json(spark, path, rows.schema)


# -- silver and gold -------------------------------------------------------


def silver_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A full replace that also changes the schema; the newest version is read."""
    silver = VersionedTable(spark, scratch_dir(spark, "silver"), ("_silver_date",))
    incoming = bronze_customers(spark, sf_dir)
    silver.overwrite(to_silver(round_of(incoming, 0), ["customer_id"], as_of=DAYS[0]), committed_at=DAYS[0])
    replaced = to_silver(incoming, ["customer_id"], as_of=DAYS[1]).drop("created_at")
    silver.overwrite(replaced, committed_at=DAYS[1])
    return silver.current()


def _silver_views(spark: SparkSession, sf_dir: str) -> None:
    register_views(
        spark,
        {
            "silver_fct_orders": settle(facts(spark, sf_dir), "fct_orders"),
            "silver_dim_customers": settle(customers(spark, sf_dir), "dim_customers"),
        },
    )


DAILY_SQL = """
  SELECT order_date, region, count(*) AS orders, sum(amount) AS revenue
  FROM silver_fct_orders JOIN silver_dim_customers USING (customer_id)
  GROUP BY order_date, region"""


def gold_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    _silver_views(spark, sf_dir)
    store = GoldStore(spark, scratch_dir(spark, "gold"))
    store.build("daily", DAILY_SQL, "year(order_date)", ["region"])
    return store.read("daily")


def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A gold table built to 1997 takes the later days past its own mark."""
    _silver_views(spark, sf_dir)
    store = GoldStore(spark, scratch_dir(spark, "gold"))
    early = f"SELECT * FROM ({DAILY_SQL}) WHERE order_date <= DATE '1997-12-31'"
    store.build("daily", early, cluster_by=["region"])
    store.build_incremental("daily", DAILY_SQL, "order_date", cluster_by=["region"])
    return store.read("daily")


def _late_views(spark: SparkSession, sf_dir: str, arrivals: int) -> DataFrame:
    """Orders as they arrive: those of even keys at once up to 1997; later days,
    late orders of the last days and orders without a date with the second arrival."""
    orders = table(spark, sf_dir, "orders").withColumn(
        "day", F.when(F.col("o_orderkey") % 50 != 3, F.to_date("o_orderdate"))
    )
    split = F.lit("1997-12-31").cast("date")
    late = (F.col("o_orderkey") % 4 == 1) & (F.col("day") > F.date_sub(split, 20))
    second = (F.col("day") > split) | late | (F.col("day").isNull() & (F.col("o_orderkey") % 100 == 3))
    seen = orders if arrivals > 1 else orders.filter(~F.coalesce(second, F.lit(False)))
    register_views(spark, {"arrived_orders": seen})
    return seen


LATE_SQL = "SELECT day, count(*) AS orders, max(o_totalprice) AS dearest FROM arrived_orders GROUP BY day"


def gold_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three incremental builds with a lookback equal a full build, late days and undated rows included."""
    store = GoldStore(spark, scratch_dir(spark, "gold"))
    for arrivals in (1, 2, 2):
        _late_views(spark, sf_dir, arrivals)
        store.build_incremental("by_day", LATE_SQL, "day", lookback="30 days")
    return store.read("by_day")


def gold_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The mark of a second build comes from the commit of the first; both marks are shown."""
    _silver_views(spark, sf_dir)
    store = GoldStore(spark, scratch_dir(spark, "gold"))
    early = f"SELECT * FROM ({DAILY_SQL}) WHERE order_date <= DATE '1997-12-31'"
    store.build_incremental("daily", early, "order_date", cluster_by=["region"])
    store.build_incremental("daily", DAILY_SQL, "order_date", cluster_by=["region"])
    marks = store.table("daily", store.read("daily")).commits().select("version", F.col("marks")["order_date"].alias("mark"))
    return store.read("daily").withColumns(
        {f"mark_{v}": marks.filter(F.col("version") == v).select("mark").scalar() for v in (0, 1)}
    )


def bronze_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches sent again are looked up in the ledger; the counts are those of the second round."""
    path = scratch_dir(spark, "bronze")
    orders = table(spark, sf_dir, "orders")
    parts = [(f"b{i}", orders.filter(F.col("o_orderkey") % 3 == i), DAYS[i]) for i in range(3)]
    for batch, rows, day in parts[:2]:
        bronze.append(rows, path, "orders_api", batch, day)
    written = [bronze.append(rows, path, "orders_api", batch, day) for batch, rows, day in parts]
    again = F.element_at(F.lit(written), (F.col("o_orderkey") % 3 + 1).cast("int")).cast("bigint")
    return bronze.read(spark, path).withColumn("written_again", again)


def create_missing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Created once though asked twice, then filled; the first commit is the empty table's."""
    nation = table(spark, sf_dir, "nation")
    stored = VersionedTable(spark, scratch_dir(spark, "created"))
    stored.create_if_missing(nation.schema, committed_at=DAYS[0])
    stored.append(nation, committed_at=DAYS[1])
    stored.create_if_missing(nation.schema, committed_at=DAYS[2])
    commits = stored.commits()
    return stored.current().withColumns(
        {
            "n_commits": commits.agg(F.count(F.lit(1))).scalar(),
            "first_operation": commits.filter("version = 0").select("operation").scalar(),
        }
    )


def write_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows come in hash order and are stored in the write order: per file, how many precede a smaller one."""
    path = scratch_dir(spark, "ordered")
    shuffled = table(spark, sf_dir, "events").repartition(3, "event_id")
    bronze.append_by_day(shuffled, path, "ts", sort_cols=["user_id", "ts"])
    stored = bronze.read(spark, path).select("*", "_metadata.file_path", "_metadata.row_index")
    key = F.struct("user_id", "ts")
    before = F.lag(key).over(Window.partitionBy("file_path").orderBy("row_index"))
    misplaced = stored.select((before > key).alias("late")).agg(F.count_if("late"))
    return bronze.read(spark, path).drop(bronze.HIDDEN_DAY).withColumn("misplaced", misplaced.scalar())


def even_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sixty tasks hold a batch; the hint brings it together, so each day has one file."""
    path = scratch_dir(spark, "even")
    scattered = table(spark, sf_dir, "nation").repartition(60)
    for batch, day in enumerate(DAYS[:2]):
        bronze.append(scattered, path, "api", f"b{batch}", day, even_files=True)
    stored = bronze.read(spark, path)
    files = stored.select("_ingestion_date", "_metadata.file_name").distinct().groupBy("_ingestion_date").agg(
        F.count(F.lit(1)).alias("n_files")
    )
    return stored.join(files, "_ingestion_date").select("n_nationkey", "_batch_id", "_ingestion_date", "n_files")


def layer_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One name in three layers: each table is read back from the path that the layer gives it."""
    root = scratch_dir(spark, "named")
    people = table(spark, sf_dir, "customer")
    found = []
    for i, layer in enumerate(Layer):
        path = layer_path(f"{root}/", layer, "customers")
        people.filter(F.col("c_custkey") % 3 == i).write.parquet(path)
        place = F.lit(path.removeprefix(root))
        schema = database_name(f" {layer.value}_tables " if layer is Layer.GOLD else None, layer.value)
        found.append(spark.read.parquet(path).select("c_custkey", place.alias("place"), F.lit(schema).alias("database")))
    return reduce(DataFrame.unionByName, found)


def as_of_days_ago(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The table as it was one day before the last commit."""
    day_ago = F.lit(DAYS[2]).cast("timestamp_ntz") - F.make_dt_interval(F.lit(1))
    return _versioned(spark, sf_dir).as_of_timestamp(day_ago)


def own_batch_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Batches without an id get one each, the same in all their rows."""
    path = scratch_dir(spark, "unnamed")
    for part in (0, 1):
        bronze.append(table(spark, sf_dir, "orders").filter(F.col("o_orderkey") % 2 == part), path, "api", as_of=AS_OF)
    uuid = F.col("_batch_id").rlike("^[0-9a-f]{8}(-[0-9a-f]{4}){3}-[0-9a-f]{12}$")
    return (
        bronze.read(spark, path)
        .groupBy((F.col("o_orderkey") % 2).alias("part"))
        .agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("_batch_id").alias("n_ids"), F.bool_and(uuid).alias("uuids"))
    )


def gold_ltv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lifetime-value model stored clustered by tier and region."""
    store = GoldStore(spark, scratch_dir(spark, "gold"))
    store.write("agg_customer_ltv", customer_ltv(spark, sf_dir), cluster_by=("tier", "region"))
    return store.read("agg_customer_ltv")


def mv_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored query is rerun after its source view changed."""
    store = GoldStore(spark, scratch_dir(spark, "gold"))
    bronze_rows = bronze_customers(spark, sf_dir)
    register_views(spark, {"mv_customers": round_of(bronze_rows, 0)})
    sql = "SELECT tier, count(*) AS customers FROM mv_customers GROUP BY tier"
    store.build("by_tier", sql)
    register_views(spark, {"mv_customers": dedupe_latest(bronze_rows, ["customer_id"])})
    another = GoldStore(spark, store.root)  # as another session would
    another.refresh("by_tier")
    return another.read("by_tier")


def external_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_dir(spark, "external")
    table(spark, sf_dir, "supplier").join(
        table(spark, sf_dir, "nation"), F.col("s_nationkey") == F.col("n_nationkey")
    ).write.parquet(path)
    register_external(spark, "strata_external_supplier", path)
    return spark.table("strata_external_supplier").groupBy("n_name").agg(
        F.count(F.lit(1)).alias("suppliers"), F.max("s_acctbal").alias("top_balance")
    )


def capped(spark: SparkSession, sf_dir: str) -> DataFrame:
    register_views(spark, {"capped_orders": table(spark, sf_dir, "orders")})
    return capped_query(
        spark,
        "  SELECT o_orderkey, o_totalprice FROM capped_orders ORDER BY o_totalprice DESC, o_orderkey ; ",
    )


def page_with_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers_by_balance = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return page_of(customers_by_balance.orderBy(F.col("c_acctbal").desc(), "c_custkey"), 20)


# -- versions --------------------------------------------------------------


def _versioned(spark: SparkSession, sf_dir: str) -> VersionedTable:
    """Three appends of one third of the orders each."""
    stored = VersionedTable(spark, scratch_dir(spark, "versions"))
    for batch, day in enumerate(DAYS):
        stored.append(order_batches(spark, sf_dir, batch), batch_id=f"b{batch}", committed_at=day)
    return stored


def as_of_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _versioned(spark, sf_dir)
    snapshot = stored.commits().filter("batch_id = 'b1'").first()["snapshot_id"]
    return stored.as_of_snapshot(snapshot)


def restore_version(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _versioned(spark, sf_dir)
    stored.restore(0, committed_at=AS_OF)
    return stored.current()


def newest_commit(spark: SparkSession, sf_dir: str) -> DataFrame:
    stored = _versioned(spark, sf_dir)
    stored.restore(1, committed_at=AS_OF)
    return latest_commit(stored.commits()).select(
        "version", "base", "operation", "committed_at", "rows_added", "rows_removed"
    )


def replayed_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch id sent twice is stored once."""
    stored = _versioned(spark, sf_dir)
    stored.append(order_batches(spark, sf_dir, 2), batch_id="b2", committed_at=AS_OF)
    return stored.commits().select("version", "batch_id", "committed_at", "rows_added")


def expire_by_age(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Day 1 is too old on day 3; its rows live on in the kept versions."""
    stored = _versioned(spark, sf_dir)
    stored.expire_by_age(30, now="2024-01-03 06:00:00")
    kept = stored.commits().agg(F.count(F.lit(1)).alias("commits_left"))
    return stored.current().withColumn("commits_left", kept.scalar())


def expire_keep_last(spark: SparkSession, sf_dir: str) -> DataFrame:
    """After a restore the last version stands alone; all other folders go."""
    stored = _versioned(spark, sf_dir)
    stored.restore(1, committed_at=AS_OF)
    removed = stored.expire_keep_last(1).agg(F.count(F.lit(1)).alias("versions_removed"))
    return stored.current().withColumn("versions_removed", removed.scalar())


def scd2_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A stored dimension after a merge, next to its state before the merge."""
    stored = VersionedTable(spark, scratch_dir(spark, "dimension"), ("_is_current",))
    first, second = (
        dedupe_latest(round_of(bronze_customers(spark, sf_dir), r), ["customer_id"]).drop("_ingestion_ts")
        for r in (0, 1)
    )
    initial = scd2_bootstrap(first, FIRST_LOAD, HASHED).withColumn("_change", F.lit("insert"))
    stored.apply_scd2(initial, committed_at=FIRST_LOAD)
    stored.apply_scd2(
        scd2_changes(stored.current_rows(), second, ["customer_id"], AS_OF, HASHED), committed_at=AS_OF
    )
    states = [stored.as_of_version(v).withColumn("as_of", F.lit(v)) for v in (0, 1)]
    return states[0].unionByName(states[1]).groupBy("as_of", "_is_current", "tier").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("customer_id").alias("keys")
    )


def bucketed_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The order facts merged into their stored, bucketed table."""
    stored = BucketedTable(spark, scratch_dir(spark, "facts"), keys=("order_id",), n_buckets=8)
    bronze_rows = bronze_orders(spark, sf_dir)
    stored.merge(models.fct_orders(round_of(bronze_rows, 0), FIRST_LOAD))
    loaded = stored.current()
    gone = models.fct_orders(bronze_rows, AS_OF, loaded=loaded, invalid=True)
    stored.merge(models.fct_orders(bronze_rows, AS_OF, loaded=loaded), deleted=gone)
    return stored.current()


def bucketed_scd2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The customer dimension after a stored type-2 merge and its replay."""
    stored = BucketedTable(
        spark, scratch_dir(spark, "dimension"), ("_is_current",), keys=("customer_id",), n_buckets=8
    )
    first, second = (
        dedupe_latest(round_of(bronze_customers(spark, sf_dir), r), ["customer_id"]).drop("_ingestion_ts")
        for r in (0, 1)
    )
    for batch, at in ((first, FIRST_LOAD), (second, AS_OF), (second, "2024-02-02 00:00:00")):
        stored.merge_scd2(batch, at, HASHED)
    return stored.current()


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals through bronze and silver, with the promotion's numbers."""
    lake = Lakehouse(spark, scratch_dir(spark, "lake"), n_buckets=8)
    lake.register(
        TableSpec("customers", Layer.SILVER, keys=("customer_id",), scd_type=2, hash_cols=tuple(HASHED))
    )
    for ingest_round, day in enumerate(DAYS[:2]):
        rows = round_of(bronze_customers(spark, sf_dir), ingest_round).drop("_ingestion_ts")
        lake.ingest("customers", rows, "crm", f"b{ingest_round}", day)
        counts = lake.promote("customers", as_of=day)
    lake.build_gold("tiers", _tier_query(spark, lake), cluster_by=["tier"])
    return lake.gold.read("tiers").withColumns(
        {name: F.lit(n).cast("bigint") for name, n in counts.first().asDict().items()}
    )


def pipeline_increments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two arrivals, each promoted by itself: the numbers of the second are of its own rows.

    Silver is partitioned by region; the file counts show that its folders are.
    """
    lake = Lakehouse(spark, scratch_dir(spark, "lake"), n_buckets=4)
    lake.register(
        TableSpec(
            "customers", Layer.SILVER, keys=("customer_id",), scd_type=2, hash_cols=tuple(HASHED), partition_cols=("region",)
        )
    )
    for ingest_round, day in enumerate(DAYS[:2]):
        rows = round_of(bronze_customers(spark, sf_dir), ingest_round).drop("_ingestion_ts")
        lake.ingest("customers", rows, "crm", f"b{ingest_round}", day)
        counts = lake.promote("customers", as_of=day, only_new=True)
    silver = lake.table("silver", "customers")
    parted = layout.live_files(silver).filter(~F.col("path").contains("/region=")).agg(F.count(F.lit(1)).alias("n"))
    return (
        silver.current()
        .groupBy("region", "tier")
        .agg(F.count_if("_is_current").alias("current_rows"), F.count_if(~F.col("_is_current")).alias("closed_rows"))
        .withColumns({name: F.lit(n).cast("bigint") for name, n in counts.first().asDict().items()})
        .withColumn("files_elsewhere", parted.scalar())
    )


def _tier_query(spark: SparkSession, lake: Lakehouse) -> str:
    register_views(spark, {"lake_customers": lake.table("silver", "customers").current()})
    return """
      SELECT tier, count_if(_is_current) AS current_rows, count_if(NOT _is_current) AS closed_rows
      FROM lake_customers GROUP BY tier"""


QUERIES = {
    "bucketed_merge": bucketed_merge,
    "bucketed_scd2": bucketed_scd2,
    "lakehouse_pipeline": pipeline,
    "lakehouse_increments": pipeline_increments,
    "bronze_append": bronze_append,
    "day_partitioned": day_partitioned,
    "json_landing": json_landing,
    "silver_snapshot": silver_snapshot,
    "gold_build": gold_build,
    "gold_incremental": gold_incremental,
    "gold_lookback": gold_lookback,
    "gold_marks": gold_marks,
    "bronze_replay": bronze_replay,
    "create_missing": create_missing,
    "write_order": write_order,
    "even_files": even_files,
    "layer_names": layer_names,
    "as_of_days_ago": as_of_days_ago,
    "own_batch_ids": own_batch_ids,
    "gold_ltv_clustered": gold_ltv,
    "mv_refresh": mv_refresh,
    "external_table": external_table,
    "capped_query": capped,
    "capped_page_with_count": page_with_count,
    "as_of_version": lambda s, d: _versioned(s, d).as_of_version(1),
    "as_of_snapshot": as_of_snapshot,
    "as_of_timestamp": lambda s, d: _versioned(s, d).as_of_timestamp("2024-01-02 23:59:59"),
    "restore_version": restore_version,
    "latest_commit": newest_commit,
    "replayed_batch": replayed_batch,
    "expire_by_age": expire_by_age,
    "expire_keep_last": expire_keep_last,
    "scd2_versions": scd2_versions,
}

_BATCH = "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice{extra} FROM orders {where}"
_DAILY = """
  SELECT o.order_date, c.region, count(*) AS orders, sum(o.amount) AS revenue
  FROM fct_orders o JOIN dim_customers c ON o.customer_id = c.customer_id
  GROUP BY 1, 2"""
_HASH = "coalesce(email, '') || '|' || tier || '|' || region"

ORACLES = {
    "bucketed_merge": merging.ORACLES["fct_orders_merge"],
    "bucketed_scd2": merging.ORACLES["scd2_merge"],
    "lakehouse_pipeline": with_inputs(
        "bronze_customers customers_v0 customers_v1",
        f""",
        old AS (SELECT customer_id, tier, {_HASH} AS h FROM customers_v0),
        new AS (SELECT customer_id, tier, {_HASH} AS h FROM customers_v1),
        added AS (SELECT * FROM new n WHERE NOT EXISTS
                    (SELECT 1 FROM old o WHERE o.customer_id = n.customer_id AND o.h = n.h)),
        closed AS (SELECT o.* FROM old o JOIN new n ON o.customer_id = n.customer_id AND o.h <> n.h),
        states AS (
          SELECT tier, customer_id IN (SELECT customer_id FROM closed) AS was_closed FROM old
          UNION ALL SELECT tier, false FROM added)
        SELECT tier, count(*) FILTER (WHERE NOT was_closed) AS current_rows,
               count(*) FILTER (WHERE was_closed) AS closed_rows,
               (SELECT count(*) FROM bronze_customers) AS rows_in,
               (SELECT count(DISTINCT customer_id) FROM bronze_customers) AS rows_out,
               (SELECT count(*) - count(DISTINCT customer_id) FROM bronze_customers) AS duplicates_dropped,
               (SELECT count(*) FROM added) AS scd2_inserts,
               (SELECT count(*) FROM closed) AS scd2_updates
        FROM states GROUP BY tier""",
    ),
    "lakehouse_increments": with_inputs(
        "bronze_customers customers_v0 customers_v1",
        f""",
        old AS (SELECT customer_id, tier, region, {_HASH} AS h FROM customers_v0),
        new AS (SELECT customer_id, tier, region, {_HASH} AS h FROM customers_v1),
        added AS (SELECT * FROM new n WHERE NOT EXISTS
                    (SELECT 1 FROM old o WHERE o.customer_id = n.customer_id AND o.h = n.h)),
        closed AS (SELECT o.* FROM old o JOIN new n ON o.customer_id = n.customer_id AND o.h <> n.h),
        states AS (
          SELECT region, tier, customer_id IN (SELECT customer_id FROM closed) AS was_closed FROM old
          UNION ALL SELECT region, tier, false FROM added)
        SELECT region, tier, count(*) FILTER (WHERE NOT was_closed) AS current_rows,
               count(*) FILTER (WHERE was_closed) AS closed_rows,
               (SELECT count(*) FROM customers_v1) AS rows_in,
               (SELECT count(DISTINCT customer_id) FROM customers_v1) AS rows_out,
               (SELECT count(*) - count(DISTINCT customer_id) FROM customers_v1) AS duplicates_dropped,
               (SELECT count(*) FROM added) AS scd2_inserts,
               (SELECT count(*) FROM closed) AS scd2_updates,
               CAST(0 AS BIGINT) AS files_elsewhere
        FROM states GROUP BY region, tier""",
    ),
    "bronze_append": """
      SELECT * EXCLUDE (b), TIMESTAMP '2024-01-01 00:00:00' + to_days(b) AS _ingestion_ts, 'orders_api' AS _source,
             'b' || b AS _batch_id, DATE '2024-01-01' + b AS _ingestion_date
      FROM (SELECT *, 0 AS b FROM orders UNION ALL SELECT *, 1 FROM orders)""",
    "day_partitioned": """
      SELECT * FROM events
      WHERE ts >= TIMESTAMP '2024-01-05 06:00:00' AND ts < TIMESTAMP '2024-01-12 18:00:00'""",
    "json_landing": """
      SELECT o_orderkey, o_totalprice, o_orderstatus, TIMESTAMP '2024-02-01 00:00:00' AS _ingestion_ts,
             'api' AS _source, 'api_1706745600' AS _batch_id FROM orders""",
    "silver_snapshot": with_inputs(
        "bronze_customers",
        """
        SELECT customer_id, email, tier, region, _ingestion_ts, DATE '2024-01-02' AS _silver_date
        FROM bronze_customers
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY _ingestion_ts DESC) = 1""",
    ),
    "gold_build": with_inputs(_MODELS, _DAILY),
    "gold_incremental": with_inputs(_MODELS, _DAILY),
    "gold_lookback": """
      SELECT day, count(*) AS orders, max(o_totalprice) AS dearest
      FROM (SELECT *, CASE WHEN o_orderkey % 50 <> 3 THEN CAST(o_orderdate AS DATE) END AS day FROM orders)
      GROUP BY day""",
    "gold_marks": with_inputs(
        _MODELS,
        f"""
        SELECT *, CAST((SELECT max(order_date) FROM ({_DAILY}) WHERE order_date <= DATE '1997-12-31') AS VARCHAR) AS mark_0,
               CAST((SELECT max(order_date) FROM ({_DAILY})) AS VARCHAR) AS mark_1
        FROM ({_DAILY})""",
    ),
    "bronze_replay": """
      SELECT o.*, TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(b AS INTEGER)) AS _ingestion_ts,
             'orders_api' AS _source, 'b' || b AS _batch_id, DATE '2024-01-01' + CAST(b AS INTEGER) AS _ingestion_date,
             CASE WHEN b = 2 THEN n ELSE 0 END AS written_again
      FROM orders o JOIN (SELECT o_orderkey % 3 AS b, count(*) AS n FROM orders GROUP BY 1) ON o_orderkey % 3 = b""",
    "create_missing": "SELECT *, CAST(2 AS BIGINT) AS n_commits, 'create' AS first_operation FROM nation",
    "write_order": "SELECT *, CAST(0 AS BIGINT) AS misplaced FROM events",
    "even_files": """
      SELECT n_nationkey, 'b' || b AS _batch_id, DATE '2024-01-01' + CAST(b AS INTEGER) AS _ingestion_date,
             CAST(1 AS BIGINT) AS n_files
      FROM nation, range(2) t(b)""",
    "layer_names": """
      SELECT c_custkey, ['/bronze', '/silver', '/gold'][c_custkey % 3 + 1] || '/customers' AS place,
             ['bronze', 'silver', 'gold_tables'][c_custkey % 3 + 1] AS database
      FROM customer""",
    "as_of_days_ago": _BATCH.format(extra="", where="WHERE o_orderkey % 3 <= 1"),
    "own_batch_ids": """
      SELECT o_orderkey % 2 AS part, count(*) AS n_rows, CAST(1 AS BIGINT) AS n_ids, true AS uuids
      FROM orders GROUP BY 1""",
    "gold_ltv_clustered": with_inputs(_MODELS, _LTV),
    "mv_refresh": with_inputs(
        "bronze_customers",
        """
        SELECT tier, count(*) AS customers
        FROM (SELECT * FROM bronze_customers
              QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY _ingestion_ts DESC) = 1)
        GROUP BY tier""",
    ),
    "external_table": """
      SELECT n_name, count(*) AS suppliers, max(s_acctbal) AS top_balance
      FROM supplier JOIN nation ON s_nationkey = n_nationkey GROUP BY n_name""",
    "capped_query": """
      SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 100""",
    "capped_page_with_count": """
      SELECT c_custkey, c_acctbal, (SELECT count(*) FROM customer) AS row_count
      FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20""",
    "as_of_version": _BATCH.format(extra="", where="WHERE o_orderkey % 3 <= 1"),
    "as_of_snapshot": _BATCH.format(extra="", where="WHERE o_orderkey % 3 <= 1"),
    "as_of_timestamp": _BATCH.format(extra="", where="WHERE o_orderkey % 3 <= 1"),
    "restore_version": _BATCH.format(extra="", where="WHERE o_orderkey % 3 = 0"),
    "latest_commit": """
      SELECT CAST(3 AS BIGINT) AS version, CAST(3 AS BIGINT) AS base, 'restore' AS operation,
             TIMESTAMP '2024-02-01 00:00:00' AS committed_at, count(*) AS rows_added,
             CAST(0 AS BIGINT) AS rows_removed
      FROM orders WHERE o_orderkey % 3 <= 1""",
    "replayed_batch": """
      SELECT o_orderkey % 3 AS version, 'b' || (o_orderkey % 3) AS batch_id,
             TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(o_orderkey % 3 AS INTEGER)) AS committed_at,
             count(*) AS rows_added
      FROM orders GROUP BY 1, 2, 3""",
    "expire_by_age": _BATCH.format(extra=", CAST(2 AS BIGINT) AS commits_left", where=""),
    "expire_keep_last": _BATCH.format(
        extra=", CAST(3 AS BIGINT) AS versions_removed", where="WHERE o_orderkey % 3 <= 1"
    ),
    "scd2_versions": with_inputs(
        "bronze_customers customers_v0 customers_v1",
        f""",
        old AS (SELECT customer_id, tier, {_HASH} AS h FROM customers_v0),
        new AS (SELECT customer_id, tier, {_HASH} AS h FROM customers_v1),
        states AS (
          SELECT 0 AS as_of, true AS _is_current, tier, customer_id FROM old
          UNION ALL
          SELECT 1, n.h IS NULL OR n.h = o.h, o.tier, o.customer_id
          FROM old o LEFT JOIN new n ON o.customer_id = n.customer_id
          UNION ALL
          SELECT 1, true, n.tier, n.customer_id FROM new n
          WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.customer_id = n.customer_id AND o.h = n.h))
        SELECT as_of, _is_current, tier, count(*) AS n, count(DISTINCT customer_id) AS keys
        FROM states GROUP BY 1, 2, 3""",
    ),
}
