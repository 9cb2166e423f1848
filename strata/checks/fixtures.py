"""Bronze inputs derived from the driver tables, in Spark and as DuckDB CTEs.

Every input covers its whole driver table.  Later ingest rounds re-send some
keys on top of round 0, so deduplication and merges have work to do.  Amounts
are multiples of 0.25: exact in binary, so sums do not depend on order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2024-02-01 00:00:00"
FIRST_DAY = "2024-01-01 00:00:00"


# Declared schemas spare a job that reads file footers for every scan.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "supplier": "s_suppkey BIGINT, s_name STRING, s_nationkey INT, s_acctbal DOUBLE",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
    "embeddings": "vec_id BIGINT, embedding ARRAY<FLOAT>, label INT",
    "pages": "page_id BIGINT, url STRING, html STRING",
    "benchmark": "item_id BIGINT, text STRING",
    "labels": "doc_id BIGINT, quality INT, toxic INT",
    "conversations": "conv_id BIGINT, turn BIGINT, role STRING, text STRING",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def _stamp(ingest_round: Column) -> Column:
    start = F.lit(FIRST_DAY).cast("timestamp_ntz")
    return start + F.make_dt_interval(days=ingest_round)


def _rounds(*later: Column) -> Column:
    """Ingest rounds of a row, one output row each; one scan serves them all."""
    return F.explode(F.array_compact(F.array(F.lit(0), *later)))


def bronze_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Round 0 sends every customer; round 1 re-sends some, a few under new keys (code 2)."""
    nation = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey")
    )
    key = F.col("c_custkey")
    code = F.col("code")
    sent = table(spark, sf_dir, "customer").select(
        "*", _rounds(F.when(key % 3 == 0, 1), F.when(key % 50 == 7, 2)).alias("code")
    )
    vip = (code == 1) & (key % 2 == 0)
    email = F.concat(F.lower(F.translate("c_name", "#", "_")), F.lit("@example.com"))
    return sent.join(nation, F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.when(code == 2, key + 10_000_000).otherwise(key).alias("customer_id"),
        F.when(key % 17 != 0, email).alias("email"),
        F.when(vip, "VIP").otherwise(F.col("c_mktsegment")).alias("tier"),
        F.col("r_name").alias("region"),
        F.lit("2020-01-01").cast("date").alias("created_at"),
        _stamp(F.least(code, F.lit(1))).alias("_ingestion_ts"),
    )


def bronze_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Round 0 sends every order; round 1 re-sends some, a few without a key (code 2)."""
    key = F.col("o_orderkey")
    code = F.col("code")
    sent = table(spark, sf_dir, "orders").select(
        "*", _rounds(F.when(key % 10 == 2, 1), F.when(key % 500 == 7, 2)).alias("code")
    )
    base = F.floor(F.col("o_totalprice") / 125).cast("double") / 4
    resent = F.when(key % 97 == 0, -base * 2).otherwise(base * 2)
    order_date = F.col("o_orderdate").cast("date")
    return sent.select(
        F.when(code != 2, key).alias("order_id"),
        F.col("o_custkey").alias("customer_id"),
        (key % 200).alias("product_id"),
        F.when(key % 20 == 0, "cancelled")
        .when(key % 20 == 1, "returned")
        .when(key % 101 != 0, "completed")
        .alias("status"),
        F.when(code == 1, resent).otherwise(base).alias("amount"),
        F.lit("USD").alias("currency"),
        order_date.alias("order_date"),
        F.when(key % 13 != 0, F.date_add(order_date, (key % 10).cast("int"))).alias("shipped_date"),
        _stamp(F.least(code, F.lit(1))).alias("_ingestion_ts"),
    )


def round_of(bronze: DataFrame, ingest_round: int) -> DataFrame:
    """The rows of one ingest round, as an incremental batch would hold them."""
    return bronze.filter(F.col("_ingestion_ts") == _stamp(F.lit(ingest_round)))


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("ts").cast("date")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "event_type",
        "user_id",
        F.concat_ws("-", F.col("user_id").cast("string"), day.cast("string")).alias("session_id"),
        F.col("props").alias("properties"),
        F.col("ts").alias("server_ts"),
        F.col("ts").alias("_ingestion_ts"),
        F.lit("events").alias("_source"),
        day.cast("string").alias("_batch_id"),
        day.alias("_ingestion_date"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Topic rows ``(topic, partition, offset, key, value)`` with bad payloads mixed in.

    ``event_id`` is dense, so the position within a partition of four is its
    quotient by four.
    """
    key = F.col("event_id")
    payload = F.to_json(F.struct("event_id", "event_type", "user_id", "props", "value", F.col("ts").cast("string").alias("ts")))
    return table(spark, sf_dir, "events").select(
        F.lit("events").alias("topic"),
        (key % 4).cast("int").alias("partition"),
        F.floor(key / 4).alias("offset"),
        F.encode(key.cast("string"), "UTF-8").alias("key"),
        F.encode(
            F.when(key % 50 == 0, "not json")
            .when(key % 50 == 1, "5")
            .when(key % 50 == 3, "[1]")
            .when(key % 50 != 2, payload),
            "UTF-8",
        ).alias("value"),
    )


def order_batches(spark: SparkSession, sf_dir: str, batch: int | None = None) -> DataFrame:
    """Orders cut into three batches, committed on three consecutive days."""
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice"
    )
    return orders if batch is None else orders.filter(F.col("o_orderkey") % 3 == batch)


# DuckDB counterparts, by name; each may use the ones before it.
CTES = {
    "bronze_customers": """
      SELECT c_custkey + shift AS customer_id,
             CASE WHEN c_custkey % 17 <> 0
                  THEN lower(replace(c_name, '#', '_')) || '@example.com' END AS email,
             CASE WHEN v = 1 AND shift = 0 AND c_custkey % 2 = 0 THEN 'VIP'
                  ELSE c_mktsegment END AS tier,
             r_name AS region, DATE '2020-01-01' AS created_at,
             TIMESTAMP '2024-01-01 00:00:00' + to_days(v) AS _ingestion_ts
      FROM (SELECT *, 0 AS v, 0 AS shift FROM customer
            UNION ALL SELECT *, 1, 0 FROM customer WHERE c_custkey % 3 = 0
            UNION ALL SELECT *, 1, 10000000 FROM customer WHERE c_custkey % 50 = 7) c
      JOIN nation ON c_nationkey = n_nationkey
      JOIN region ON n_regionkey = r_regionkey""",
    "bronze_orders": """
      SELECT CASE WHEN keyed THEN o_orderkey END AS order_id,
             o_custkey AS customer_id, o_orderkey % 200 AS product_id,
             CASE WHEN o_orderkey % 20 = 0 THEN 'cancelled'
                  WHEN o_orderkey % 20 = 1 THEN 'returned'
                  WHEN o_orderkey % 101 = 0 THEN NULL
                  ELSE 'completed' END AS status,
             CAST(floor(o_totalprice / 125) AS DOUBLE) / 4
               * CASE WHEN v = 1 AND keyed THEN 2 ELSE 1 END
               * CASE WHEN v = 1 AND keyed AND o_orderkey % 97 = 0 THEN -1 ELSE 1 END AS amount,
             'USD' AS currency, CAST(o_orderdate AS DATE) AS order_date,
             CASE WHEN o_orderkey % 13 <> 0
                  THEN CAST(o_orderdate AS DATE) + CAST(o_orderkey % 10 AS INTEGER) END AS shipped_date,
             TIMESTAMP '2024-01-01 00:00:00' + to_days(v) AS _ingestion_ts
      FROM (SELECT *, 0 AS v, true AS keyed FROM orders
            UNION ALL SELECT *, 1, true FROM orders WHERE o_orderkey % 10 = 2
            UNION ALL SELECT *, 1, false FROM orders WHERE o_orderkey % 500 = 7)""",
    "raw_events": """
      SELECT event_id, event_type, user_id,
             CAST(user_id AS VARCHAR) || '-' || CAST(CAST(ts AS DATE) AS VARCHAR) AS session_id,
             props AS properties, ts AS server_ts, ts AS _ingestion_ts, 'events' AS _source,
             CAST(CAST(ts AS DATE) AS VARCHAR) AS _batch_id, CAST(ts AS DATE) AS _ingestion_date
      FROM events""",
    "fct_orders": """
      SELECT order_id, customer_id, product_id, status, amount, currency, order_date, shipped_date,
             CAST(shipped_date - order_date AS INTEGER) AS fulfillment_days,
             TIMESTAMP '2024-02-01 00:00:00' AS _silver_ts
      FROM (SELECT * FROM bronze_orders
            QUALIFY row_number() OVER (PARTITION BY order_id ORDER BY _ingestion_ts DESC) = 1)
      WHERE order_id IS NOT NULL AND amount >= 0""",
    "dim_customers": """
      SELECT customer_id, email, tier, region, created_at,
             sha256(coalesce(email, '') || '|' || coalesce(tier, '') || '|' || coalesce(region, '')) AS _row_hash,
             TIMESTAMP '2024-02-01 00:00:00' AS _valid_from,
             CAST(NULL AS TIMESTAMP) AS _valid_to, true AS _is_current,
             TIMESTAMP '2024-02-01 00:00:00' AS _silver_ts
      FROM bronze_customers
      QUALIFY row_number() OVER (PARTITION BY customer_id ORDER BY _ingestion_ts DESC) = 1""",
    "customers_v0": """
      SELECT * FROM bronze_customers WHERE _ingestion_ts = TIMESTAMP '2024-01-01 00:00:00'""",
    "customers_v1": """
      SELECT * FROM bronze_customers WHERE _ingestion_ts = TIMESTAMP '2024-01-02 00:00:00'""",
    "orders_v0": """
      SELECT * FROM bronze_orders WHERE _ingestion_ts = TIMESTAMP '2024-01-01 00:00:00'""",
    "orders_v1": """
      SELECT * FROM bronze_orders WHERE _ingestion_ts = TIMESTAMP '2024-01-02 00:00:00'""",
    "messages": """
      SELECT event_id, 'events' AS topic, CAST(event_id % 4 AS INTEGER) AS part,
             event_id // 4 AS pos, event_type, user_id, props, value, ts,
             CASE event_id % 50 WHEN 0 THEN 'not json' WHEN 1 THEN '5'
                                WHEN 3 THEN '[1]' WHEN 2 THEN NULL ELSE '{}' END AS kind
      FROM events""",
}


def with_inputs(names: str, body: str) -> str:
    """Prefix ``body`` with the named inputs (space separated, in order)."""
    return "WITH " + ", ".join(f"{n} AS ({CTES[n]})" for n in names.split()) + body
