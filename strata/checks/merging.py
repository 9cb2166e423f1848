"""Upserts, type-2 dimensions, change feeds, incremental loads, schema sync."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.checks.fixtures import (
    AS_OF,
    bronze_customers,
    bronze_orders,
    raw_events,
    round_of,
    table,
    with_inputs,
)
from strata.operators.cdc import cdc_apply
from strata.operators.dedupe import dedupe_latest
from strata.operators.incremental import high_water_mark, newer_than, newer_than_value
from strata.operators.merge import merge_counts, upsert
from strata.operators.metrics import transform_metrics
from strata.operators.scd2 import scd2_bootstrap, scd2_changes, scd2_merge, scd2_metrics
from strata.operators.schema_sync import sync_append
from strata.plans import models
from strata.session import settle

FIRST_LOAD = "2024-01-01 12:00:00"
HASHED = ["email", "tier", "region"]


def _customers(spark: SparkSession, sf_dir: str, ingest_round: int) -> DataFrame:
    batch = round_of(bronze_customers(spark, sf_dir), ingest_round)
    return dedupe_latest(batch, ["customer_id"]).drop("_ingestion_ts")


def _dimension(spark: SparkSession, sf_dir: str, style: str = "null_as_empty") -> DataFrame:
    return scd2_bootstrap(_customers(spark, sf_dir, 0), FIRST_LOAD, HASHED, style)


def _changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_changes(
        _dimension(spark, sf_dir), _customers(spark, sf_dir, 1), ["customer_id"], AS_OF, HASHED
    )


def merged_dimension(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    style = options.get("style", "null_as_empty")
    return scd2_merge(
        _dimension(spark, sf_dir, style),
        _customers(spark, sf_dir, 1),
        ["customer_id"],
        AS_OF,
        HASHED,
        **options,
    )


def merge_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2_metrics(_changes(spark, sf_dir))


def promotion_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All five numbers of a promotion to silver."""
    merged = scd2_metrics(_changes(spark, sf_dir))
    return transform_metrics(bronze_customers(spark, sf_dir), ["customer_id"]).withColumns(
        {
            "scd2_inserts": merged.select("rows_inserted").scalar(),
            "scd2_updates": merged.select("rows_updated").scalar(),
        }
    )


def orders_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = bronze_orders(spark, sf_dir)
    target = settle(models.fct_orders(round_of(bronze, 0), FIRST_LOAD), "facts")
    changed, gone = models.order_changes(bronze, target, AS_OF)
    return upsert(target, changed, ["order_id"], deleted=gone, stored=True)


def merged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merged facts, without the stamp of their load: the facts of a full build."""
    return orders_merge(spark, sf_dir).drop("_silver_ts")


def composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A type-2 merge by two columns: every third line has another quantity."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.max("l_quantity").alias("quantity")
    )
    keys = ["l_orderkey", "l_linenumber"]
    changed = F.when(F.col("l_orderkey") % 3 == 0, F.col("quantity") + 1).otherwise(F.col("quantity"))
    target = scd2_bootstrap(lines, FIRST_LOAD)
    merged = scd2_merge(target, lines.withColumn("quantity", changed), keys, AS_OF)
    return merged.select(*keys, "quantity", "_valid_from", "_valid_to", "_is_current")


def new_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A batch with a column the dimension lacks; where it is null nothing changes."""
    people = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    phone = F.when(F.col("c_custkey") % 2 == 0, F.concat(F.lit("+"), F.col("c_custkey").cast("string")))
    merged = scd2_merge(scd2_bootstrap(people, FIRST_LOAD), people.withColumn("phone", phone), ["c_custkey"], AS_OF)
    return merged.select("c_custkey", "c_name", "phone", "_valid_from", "_is_current")


def orders_merge_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = bronze_orders(spark, sf_dir)
    target = models.fct_orders(round_of(bronze, 0), FIRST_LOAD)
    return merge_counts(target, models.fct_orders(round_of(bronze, 1), AS_OF), ["order_id"])


def customers_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = bronze_customers(spark, sf_dir)
    target = models.dim_customers(round_of(bronze, 0), FIRST_LOAD)
    source = models.dim_customers(bronze, AS_OF, loaded=target)
    return upsert(target, source, ["customer_id"], models.CUSTOMER_UPDATE_COLUMNS)


def events_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A staged table that holds the first half of January takes the rest."""
    raw = raw_events(spark, sf_dir)
    half = F.lit("2024-01-10 00:00:00").cast("timestamp_ntz")
    staged = models.stg_events(raw.filter(F.col("_ingestion_ts") < half))
    return staged.unionByName(models.stg_events(raw, loaded=staged))


def events_first_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_events(spark, sf_dir)
    return models.stg_events(raw, loaded=raw.filter(F.lit(False)))


def event_marks(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_events(spark, sf_dir)
    none = raw.filter(F.lit(False))
    return (
        high_water_mark(raw, "_ingestion_ts")
        .withColumn("of", F.lit("events"))
        .unionByName(high_water_mark(none, "_ingestion_ts").withColumn("of", F.lit("nothing")))
    )


def events_lookback(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = raw_events(spark, sf_dir)
    return newer_than(raw, "_ingestion_ts", raw, lookback="2 days")


def orders_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    return newer_than_value(bronze_orders(spark, sf_dir), "order_date", "1997-06-30")


def schema_sync(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch brings ``channel`` and lacks ``currency``."""
    bronze = bronze_orders(spark, sf_dir)
    stored = round_of(bronze, 0)
    batch = round_of(bronze, 1).drop("currency").withColumn("channel", F.lit("web"))
    return sync_append(stored, batch)


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders change by status: finished ones are deleted, open ones get a new
    price twice, and pending ones come back under new keys."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    steps = F.when(F.col("o_orderstatus") == "F", F.array(F.lit("u"), F.lit("d"))).when(
        F.col("o_orderstatus") == "O", F.array(F.lit("u"), F.lit("u"))
    ).otherwise(F.array(F.lit("c")))
    feed = orders.select("*", F.posexplode(steps).alias("step", "op"))
    return feed.select(
        (F.col("o_orderkey") + F.when(F.col("op") == "c", 100_000_000).otherwise(0)).alias("o_orderkey"),
        "o_orderstatus",
        (F.col("o_totalprice") + F.col("step") + 1).alias("o_totalprice"),
        "op",
        F.col("step").alias("change_ts"),
    )


def apply_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return cdc_apply(orders, change_feed(spark, sf_dir), ["o_orderkey"])


QUERIES = {
    "scd2_bootstrap": _dimension,
    "scd2_merge": merged_dimension,
    "scd2_merge_small_batch": lambda s, d: merged_dimension(s, d, small_batch=True),
    "scd2_merge_md5": lambda s, d: merged_dimension(s, d, style="json_md5"),
    "scd2_metrics": merge_metrics,
    "transform_metrics": promotion_metrics,
    "fct_orders_merge": orders_merge,
    "merge_counts": orders_merge_counts,
    "dim_customers_merge": customers_merge,
    "stg_events_incremental": events_incremental,
    "stg_events_first_run": events_first_run,
    "fct_orders_merge_is_full": merged_orders,
    "scd2_composite_key": composite_key,
    "scd2_new_column": new_column,
    "high_water_mark": event_marks,
    "incremental_lookback": events_lookback,
    "newer_than_value": orders_after,
    "schema_sync": schema_sync,
    "cdc_apply": apply_feed,
}

_HASH = "sha256(coalesce(email, '') || '|' || coalesce(tier, '') || '|' || coalesce(region, ''))"
_MD5 = """md5('{' || coalesce('"email":"' || email || '",', '') || '"tier":"' || tier
              || '","region":"' || region || '"}')"""
_SIDES = """,
  old AS (SELECT customer_id, email, tier, region, created_at, {hash} AS h FROM customers_v0),
  new AS (SELECT customer_id, email, tier, region, created_at, {hash} AS h FROM customers_v1)"""
_MERGED = """
  SELECT o.customer_id, o.email, o.tier, o.region, o.created_at, o.h AS _row_hash,
         TIMESTAMP '2024-01-01 12:00:00' AS _valid_from,
         CASE WHEN n.h <> o.h THEN TIMESTAMP '2024-02-01 00:00:00' END AS _valid_to,
         n.h IS NULL OR n.h = o.h AS _is_current
  FROM old o LEFT JOIN new n ON o.customer_id = n.customer_id
  UNION ALL
  SELECT n.customer_id, n.email, n.tier, n.region, n.created_at, n.h,
         TIMESTAMP '2024-02-01 00:00:00', NULL, true
  FROM new n WHERE NOT EXISTS (SELECT 1 FROM old o WHERE o.customer_id = n.customer_id AND o.h = n.h)"""
_CUSTOMERS = "bronze_customers customers_v0 customers_v1"
_SCD2 = with_inputs(_CUSTOMERS, _SIDES.format(hash=_HASH))
_METRICS = """
  (SELECT count(*) FROM new n WHERE NOT EXISTS
     (SELECT 1 FROM old o WHERE o.customer_id = n.customer_id AND o.h = n.h)) AS {ins},
  (SELECT count(*) FROM old o JOIN new n ON o.customer_id = n.customer_id AND o.h <> n.h) AS {upd}"""

_FACT = """
  SELECT order_id, customer_id, product_id, status, amount, currency, order_date, shipped_date,
         CAST(shipped_date - order_date AS INTEGER) AS fulfillment_days,
         TIMESTAMP '{at}' AS _silver_ts
  FROM {source} WHERE order_id IS NOT NULL AND amount >= 0"""
_FACTS = (
    ", old AS ("
    + _FACT.format(at="2024-01-01 12:00:00", source="orders_v0")
    + "), new AS ("
    + _FACT.format(at=AS_OF, source="orders_v1")
    + ")"
)
_EVENTS = "SELECT * FROM raw_events"

ORACLES = {
    "scd2_bootstrap": with_inputs(
        "bronze_customers customers_v0",
        f"""
        SELECT customer_id, email, tier, region, created_at, {_HASH} AS _row_hash,
               TIMESTAMP '2024-01-01 12:00:00' AS _valid_from, CAST(NULL AS TIMESTAMP) AS _valid_to,
               true AS _is_current
        FROM customers_v0""",
    ),
    "scd2_merge": _SCD2 + _MERGED,
    "scd2_merge_small_batch": _SCD2 + _MERGED,
    "scd2_merge_md5": with_inputs(_CUSTOMERS, _SIDES.format(hash=_MD5) + _MERGED),
    "scd2_metrics": _SCD2 + " SELECT " + _METRICS.format(ins="rows_inserted", upd="rows_updated"),
    "transform_metrics": _SCD2
    + """ SELECT (SELECT count(*) FROM bronze_customers) AS rows_in,
         (SELECT count(DISTINCT customer_id) FROM bronze_customers) AS rows_out,
         (SELECT count(*) - count(DISTINCT customer_id) FROM bronze_customers) AS duplicates_dropped, """
    + _METRICS.format(ins="scd2_inserts", upd="scd2_updates"),
    "fct_orders_merge": with_inputs(
        "bronze_orders orders_v0 orders_v1",
        _FACTS
        + """ SELECT * FROM old
              WHERE order_id NOT IN (SELECT order_id FROM orders_v1 WHERE order_id IS NOT NULL)
              UNION ALL SELECT * FROM new""",
    ),
    "fct_orders_merge_is_full": with_inputs("bronze_orders fct_orders", " SELECT * EXCLUDE (_silver_ts) FROM fct_orders"),
    "scd2_composite_key": """
      WITH lines AS (SELECT l_orderkey, l_linenumber, max(l_quantity) AS q FROM lineitem GROUP BY ALL)
      SELECT l_orderkey, l_linenumber, q AS quantity, TIMESTAMP '2024-01-01 12:00:00' AS _valid_from,
             CASE WHEN l_orderkey % 3 = 0 THEN TIMESTAMP '2024-02-01 00:00:00' END AS _valid_to,
             l_orderkey % 3 <> 0 AS _is_current FROM lines
      UNION ALL
      SELECT l_orderkey, l_linenumber, q + 1, TIMESTAMP '2024-02-01 00:00:00', NULL, true
      FROM lines WHERE l_orderkey % 3 = 0""",
    "scd2_new_column": """
      SELECT c_custkey, c_name, CAST(NULL AS VARCHAR) AS phone, TIMESTAMP '2024-01-01 12:00:00' AS _valid_from,
             c_custkey % 2 = 1 AS _is_current FROM customer
      UNION ALL
      SELECT c_custkey, c_name, '+' || c_custkey, TIMESTAMP '2024-02-01 00:00:00', true
      FROM customer WHERE c_custkey % 2 = 0""",
    "merge_counts": with_inputs(
        "bronze_orders orders_v0 orders_v1",
        _FACTS
        + """ SELECT count(*) FILTER (WHERE order_id IN (SELECT order_id FROM old)) AS rows_updated,
                     count(*) FILTER (WHERE order_id NOT IN (SELECT order_id FROM old)) AS rows_inserted
              FROM new""",
    ),
    "dim_customers_merge": with_inputs(
        _CUSTOMERS,
        _SIDES.format(hash=_HASH)
        + """
        SELECT coalesce(o.customer_id, n.customer_id) AS customer_id,
               CASE WHEN n.h IS NULL THEN o.email ELSE n.email END AS email,
               coalesce(n.tier, o.tier) AS tier, coalesce(n.region, o.region) AS region,
               coalesce(o.created_at, n.created_at) AS created_at,
               coalesce(n.h, o.h) AS _row_hash,
               CASE WHEN n.h IS NULL THEN TIMESTAMP '2024-01-01 12:00:00'
                    ELSE TIMESTAMP '2024-02-01 00:00:00' END AS _valid_from,
               CAST(NULL AS TIMESTAMP) AS _valid_to, true AS _is_current,
               CASE WHEN o.h IS NULL THEN TIMESTAMP '2024-02-01 00:00:00'
                    ELSE TIMESTAMP '2024-01-01 12:00:00' END AS _silver_ts
        FROM old o FULL JOIN new n ON o.customer_id = n.customer_id""",
    ),
    "stg_events_incremental": with_inputs("raw_events", " " + _EVENTS),
    "stg_events_first_run": with_inputs("raw_events", " " + _EVENTS),
    "high_water_mark": """
      SELECT max(ts) AS high_water_mark, 'events' AS of FROM events
      UNION ALL SELECT TIMESTAMP '1970-01-01 00:00:00', 'nothing'""",
    "incremental_lookback": with_inputs(
        "raw_events",
        " SELECT * FROM raw_events WHERE _ingestion_ts > (SELECT max(ts) - INTERVAL 2 DAY FROM events)",
    ),
    "newer_than_value": with_inputs(
        "bronze_orders", " SELECT * FROM bronze_orders WHERE order_date > DATE '1997-06-30'"
    ),
    "schema_sync": with_inputs(
        "bronze_orders",
        """
        SELECT order_id, customer_id, product_id, status, amount, order_date, shipped_date, _ingestion_ts,
               CASE WHEN _ingestion_ts = TIMESTAMP '2024-01-02 00:00:00' THEN 'web' END AS channel
        FROM bronze_orders""",
    ),
    "cdc_apply": """
      SELECT o_orderkey, o_orderstatus,
             CASE WHEN o_orderstatus = 'O' THEN o_totalprice + 2 ELSE o_totalprice END AS o_totalprice
      FROM orders WHERE o_orderstatus <> 'F'
      UNION ALL
      SELECT o_orderkey + 100000000, o_orderstatus, o_totalprice + 1
      FROM orders WHERE o_orderstatus = 'P'""",
}
