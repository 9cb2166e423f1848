"""Deduplication, hashing, enrichment, silver models and gold rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.checks.fixtures import AS_OF, bronze_customers, bronze_orders, table, with_inputs
from strata.functions import business_columns, epoch_batch_id, row_hash, with_ingest_metadata
from strata.operators.dedupe import dedupe_latest, replace_with_latest
from strata.plans import models
from strata.session import settle


def facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.fct_orders(bronze_orders(spark, sf_dir), AS_OF)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.dim_customers(bronze_customers(spark, sf_dir), AS_OF)


def dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    return dedupe_latest(lines, ["l_orderkey", "l_linenumber"], "l_shipdate")


def revenue_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver is stored first, as in a layered run; gold then scans it per part."""
    stored = settle(facts(spark, sf_dir), "fct_orders"), settle(customers(spark, sf_dir), "dim_customers")
    return models.agg_revenue_daily(*stored, orders_unique=True)


def customer_ltv(spark: SparkSession, sf_dir: str) -> DataFrame:
    return models.agg_customer_ltv(
        facts(spark, sf_dir), customers(spark, sf_dir), AS_OF, orders_unique=True
    )


def ltv_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    ltv = customer_ltv(spark, sf_dir)
    return ltv.groupBy("ltv_segment").agg(
        F.count(F.lit(1)).alias("customers"),
        F.sum("lifetime_orders").alias("orders"),
        F.sum("lifetime_revenue").alias("revenue"),
    )


def revenue_by_raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The daily rollup over bronze rows, where orders repeat: the distinct count matters."""
    rows = bronze_orders(spark, sf_dir).withColumn(
        "fulfillment_days", F.datediff("shipped_date", "order_date")
    )
    return models.agg_revenue_daily(rows, customers(spark, sf_dir))


def enrich(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_ingest_metadata(table(spark, sf_dir, "orders"), "orders_api", "batch-1", AS_OF)


def enrich_json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return with_ingest_metadata(
        orders, "api", epoch_batch_id("api", AS_OF), AS_OF, with_date=False
    )


def hashes(spark: SparkSession, sf_dir: str) -> DataFrame:
    bronze = bronze_customers(spark, sf_dir).withColumn("customer_id", F.col("customer_id").cast("string"))
    cols = business_columns(bronze, exclude=["created_at"])
    return bronze.select(
        "customer_id",
        "_ingestion_ts",
        row_hash(cols).alias("hash_default"),
        row_hash(cols, "skip_nulls").alias("hash_skip_nulls"),
        row_hash(["email", "tier", "region"], "json_md5").alias("hash_json_md5"),
    )


def silver_scd1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_with_latest(bronze_customers(spark, sf_dir), ["customer_id"])


QUERIES = {
    "dedupe_latest": dedupe,
    "fct_orders": facts,
    "dim_customers": customers,
    "agg_revenue_daily": revenue_daily,
    "agg_revenue_daily_distinct": revenue_by_raw_orders,
    "agg_customer_ltv": customer_ltv,
    "ltv_segments": ltv_segments,
    "bronze_enrich": enrich,
    "bronze_enrich_json": enrich_json_rows,
    "row_hash": hashes,
    "silver_scd1": silver_scd1,
}

_REVENUE = """
  SELECT o.order_date, c.region, c.tier AS customer_tier,
         count(DISTINCT o.order_id) AS order_count,
         count(DISTINCT o.customer_id) AS unique_customers,
         sum(o.amount) AS total_revenue, avg(o.amount) AS avg_order_value,
         quantile_disc(o.amount, 0.5) AS median_order_value,
         quantile_disc(o.amount, 0.95) AS p95_order_value,
         avg(o.fulfillment_days) AS avg_fulfillment_days,
         CAST(sum(CASE WHEN o.status = 'returned' THEN 1 END) AS BIGINT) AS returns,
         round(CAST(sum(CASE WHEN o.status = 'returned' THEN 1 END) AS DOUBLE) * 100.0
               / nullif(count(*), 0), 2) AS return_rate_pct
  FROM {facts} o JOIN dim_customers c ON o.customer_id = c.customer_id AND c._is_current
  WHERE o.status <> 'cancelled'
  GROUP BY 1, 2, 3"""

# Spark rounds the decimal text of a double half up; rounding a decimal does the same here.
_LTV = """
  SELECT c.customer_id, c.email, c.tier, c.region, lifetime_orders,
         round(revenue, 2) AS lifetime_revenue, 
         CAST(round(CAST(average AS DECIMAL(18, 6)), 2) AS DOUBLE) AS avg_order_value,
         first_order_date, last_order_date,
         CAST(last_order_date - first_order_date AS INTEGER) AS customer_tenure_days,
         CASE WHEN revenue > 10000 THEN 'Champion' WHEN revenue > 5000 THEN 'Loyal'
              WHEN revenue > 1000 THEN 'Promising' ELSE 'At Risk' END AS ltv_segment,
         CAST(DATE '2024-02-01' - last_order_date AS INTEGER) AS days_since_last_order
  FROM dim_customers c
  JOIN (SELECT customer_id, count(DISTINCT order_id) AS lifetime_orders, sum(amount) AS revenue,
               avg(amount) AS average, min(order_date) AS first_order_date,
               max(order_date) AS last_order_date
        FROM fct_orders WHERE status NOT IN ('cancelled', 'returned') GROUP BY customer_id) s
    ON c.customer_id = s.customer_id
  WHERE c._is_current"""

_MODELS = "bronze_customers bronze_orders fct_orders dim_customers"

ORACLES = {
    "dedupe_latest": """
      SELECT * FROM lineitem
      QUALIFY row_number() OVER (
        PARTITION BY l_orderkey, l_linenumber
        ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC, l_suppkey DESC, l_quantity DESC,
                 l_extendedprice DESC, l_discount DESC, l_tax DESC, l_returnflag DESC,
                 l_linestatus DESC) = 1""",
    "fct_orders": with_inputs("bronze_orders fct_orders", " SELECT * FROM fct_orders"),
    "dim_customers": with_inputs("bronze_customers dim_customers", " SELECT * FROM dim_customers"),
    "agg_revenue_daily": with_inputs(_MODELS, _REVENUE.format(facts="fct_orders")),
    "agg_revenue_daily_distinct": with_inputs(
        "bronze_customers bronze_orders dim_customers",
        _REVENUE.format(
            facts="(SELECT *, shipped_date - order_date AS fulfillment_days FROM bronze_orders)"
        ),
    ),
    "agg_customer_ltv": with_inputs(_MODELS, _LTV),
    "ltv_segments": with_inputs(
        _MODELS,
        f"""
        SELECT ltv_segment, count(*) AS customers, CAST(sum(lifetime_orders) AS BIGINT) AS orders,
               sum(lifetime_revenue) AS revenue
        FROM ({_LTV}) GROUP BY ltv_segment""",
    ),
    "bronze_enrich": """
      SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS _ingestion_ts, 'orders_api' AS _source,
             'batch-1' AS _batch_id, DATE '2024-02-01' AS _ingestion_date FROM orders""",
    "bronze_enrich_json": """
      SELECT *, TIMESTAMP '2024-02-01 00:00:00' AS _ingestion_ts, 'api' AS _source,
             'api_1706745600' AS _batch_id FROM orders""",
    "row_hash": with_inputs(
        "bronze_customers",
        """
        SELECT CAST(customer_id AS VARCHAR) AS customer_id, _ingestion_ts,
               sha256(CAST(customer_id AS VARCHAR) || '|' || coalesce(email, '') || '|' || tier || '|' || region)
                 AS hash_default,
               sha256(concat_ws('|', CAST(customer_id AS VARCHAR), email, tier, region)) AS hash_skip_nulls,
               md5('{' || coalesce('"email":"' || email || '",', '') || '"tier":"' || tier
                   || '","region":"' || region || '"}') AS hash_json_md5
        FROM bronze_customers""",
    ),
    "silver_scd1": with_inputs(
        "bronze_customers",
        """
        SELECT * FROM bronze_customers WHERE _ingestion_ts IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY _ingestion_ts DESC) = 1""",
    ),
}
