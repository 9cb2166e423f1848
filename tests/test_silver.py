"""Deduplication, hashing, models: one small frame per ruling."""

import datetime as dt

from pyspark.sql import functions as F

from strata.functions import business_columns, ltv_segment, percent_of, query_params, row_hash
from strata.functions.ingest import epoch_batch_id, hour_path, with_ingest_metadata
from strata.functions.stamps import moment
from strata.operators.dedupe import dedupe_latest, replace_with_latest, to_silver
from strata.operators.metrics import transform_metrics
from strata.plans import models


def bag(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_dedupe_breaks_ties_the_same_way_for_any_input_order(spark):
    rows = [(1, 5, "b"), (1, 5, "c"), (1, 5, None), (1, 4, "z"), (2, None, "x"), (2, 1, "y")]
    schema = "id INT, at INT, v STRING"
    want = [(1, 5, "c"), (2, 1, "y")]
    for shuffled in (rows, rows[::-1], rows[3:] + rows[:3]):
        df = spark.createDataFrame(shuffled, schema).repartition(3)
        assert bag(dedupe_latest(df, ["id"], "at")) == want


def test_dedupe_keeps_one_row_per_map_task_of_a_hot_key(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), F.col("id").alias("at")
    )
    latest = dedupe_latest(df.repartition(6, "at"), ["k"], "at")
    plan = latest._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") == 2  # before and after the shuffle
    assert latest.filter("k = 0").first()["at"] == 29_997
    assert latest.count() == 20_001


def test_dedupe_accepts_columns_that_cannot_be_ordered(spark):
    df = spark.sql("SELECT 1 AS id, 1 AS at, map('a', 1) AS m UNION ALL SELECT 1, 2, map('b', 2)")
    assert dedupe_latest(df, ["id"], "at").first()["m"] == {"b": 2}


def test_type1_replace_drops_rows_without_arrival_and_defaults_to_id(spark):
    df = spark.createDataFrame([(1, None), (2, 1), (2, 3)], "id INT, _ingestion_ts INT")
    assert bag(replace_with_latest(df, [])) == [(2, 3)]


def test_promotion_day_is_the_given_instant(spark):
    df = spark.createDataFrame([(1, 1)], "id INT, _ingestion_ts INT")
    row = to_silver(df, ["id"], as_of="2024-05-06 23:00:00").first()
    assert row["_silver_date"] == dt.date(2024, 5, 6)


def test_hash_styles_differ_on_nulls(spark):
    df = spark.createDataFrame([("a", None, "b"), ("a", "b", None)], "x STRING, y STRING, z STRING")
    cols = ["x", "y", "z"]
    assert df.select(row_hash(cols)).distinct().count() == 2
    assert df.select(row_hash(cols, "skip_nulls")).distinct().count() == 1
    assert df.select(row_hash(cols, "json_md5")).distinct().count() == 2


def test_business_columns_leave_out_system_columns(spark):
    df = spark.createDataFrame([(1, 2, 3)], "id INT, _source INT, amount INT")
    assert business_columns(df) == ["id", "amount"]


def test_metadata_columns(spark):
    df = spark.createDataFrame([(1,)], "id INT")
    row = with_ingest_metadata(df, "crm", "b1", "2024-01-02 03:04:05").first()
    assert row["_ingestion_ts"] == dt.datetime(2024, 1, 2, 3, 4, 5)
    assert (row["_source"], row["_batch_id"], row["_ingestion_date"]) == ("crm", "b1", dt.date(2024, 1, 2))
    wide = with_ingest_metadata(df.union(df), "crm", with_date=False)
    assert wide.columns == ["id", "_ingestion_ts", "_source", "_batch_id"]
    assert wide.select("_batch_id", "_ingestion_ts").distinct().count() == 1
    assert spark.range(1).select(epoch_batch_id("api", "1970-01-02 00:00:00")).first()[0] == "api_86400"
    assert spark.range(1).select(hour_path(moment("2024-01-02 03:04:05"))).first()[0] == "2024/01/02/03"


def test_percent_is_null_safe_for_empty_groups(spark):
    row = spark.sql("SELECT 1 AS a, 3 AS b, 0 AS zero, CAST(NULL AS INT) AS n").select(
        percent_of(F.col("a"), F.col("b")), percent_of(F.col("a"), F.col("zero")), percent_of(F.col("n"), F.col("b"))
    )
    assert tuple(row.first()) == (33.33, None, None)


def test_value_bands_are_strict(spark):
    amounts = [(10000.01,), (10000.0,), (5000.0,), (1000.0,), (None,)]
    got = spark.createDataFrame(amounts, "x DOUBLE").select(ltv_segment(F.col("x"))).collect()
    assert [r[0] for r in got] == ["Champion", "Loyal", "Promising", "At Risk", "At Risk"]


def test_query_params_take_the_first_value_and_decode(spark):
    urls = ["https://x.io/a?cursor=ab%20c&limit=5&cursor=z&empty=#frag", "https://x.io/a"]
    df = spark.createDataFrame([(u,) for u in urls], "u STRING")
    got = [r[0] for r in df.select(query_params(F.col("u"))).collect()]
    assert got == [{"cursor": "ab c", "limit": "5"}, {}]


ORDER = (
    "order_id INT, customer_id INT, product_id INT, status STRING, amount DOUBLE, currency STRING, "
    "order_date DATE, shipped_date DATE, _ingestion_ts TIMESTAMP_NTZ"
)
DAY = dt.date(2024, 1, 1)


def order(key, amount, at, status="completed", customer=1, shipped=DAY):
    return (key, customer, 1, status, amount, "USD", DAY, shipped, dt.datetime(2024, 1, at))


def test_newest_invalid_order_hides_the_older_valid_one(spark):
    rows = [order(1, 5.0, 1), order(1, -1.0, 2), order(2, 5.0, 1), order(None, 9.0, 1), order(3, None, 1)]
    facts = models.fct_orders(spark.createDataFrame(rows, ORDER), "2024-02-01")
    assert [r["order_id"] for r in facts.collect()] == [2]


def customers(spark, regions=("EU", None)):
    rows = [(i + 1, f"{i}@x", "gold", region, True) for i, region in enumerate(regions)]
    return spark.createDataFrame(
        rows, "customer_id INT, email STRING, tier STRING, region STRING, _is_current BOOLEAN"
    )


def test_daily_revenue_rules(spark):
    rows = [
        order(1, 1.0, 1),
        order(2, 3.0, 1, "returned"),
        order(3, 9.0, 1, "cancelled"),
        order(4, 9.0, 1, None),
        order(5, 4.0, 1, customer=2),
    ]
    facts = models.fct_orders(spark.createDataFrame(rows, ORDER), "2024-02-01")
    for unique in (True, False):
        got = models.agg_revenue_daily(facts, customers(spark), unique).orderBy("region").collect()
        nowhere, eu = got
        assert (eu["order_count"], eu["unique_customers"], eu["total_revenue"]) == (2, 1, 4.0)
        assert (eu["returns"], eu["return_rate_pct"]) == (1, 50.0)
        # No return in the group: both stay null; a null region is a group.
        assert (nowhere["returns"], nowhere["return_rate_pct"]) == (None, None)
        assert nowhere["unique_customers"] == 1


def test_daily_revenue_counts_repeated_orders_once(spark):
    rows = [order(1, 1.0, 1), order(1, 1.0, 2), order(2, 1.0, 1)]
    df = spark.createDataFrame(rows, ORDER).withColumn("fulfillment_days", F.lit(0))
    row = models.agg_revenue_daily(df, customers(spark)).first()
    assert (row["order_count"], row["total_revenue"]) == (2, 3.0)


def test_lifetime_value_leaves_out_cancelled_and_returned(spark):
    rows = [order(1, 6000.0, 1), order(2, 1.0, 1, "returned"), order(3, 1.0, 1, "cancelled"), order(4, 1.0, 1, None)]
    facts = models.fct_orders(spark.createDataFrame(rows, ORDER), "2024-02-01")
    row = models.agg_customer_ltv(facts, customers(spark), "2024-01-11").first()
    assert (row["lifetime_orders"], row["lifetime_revenue"], row["ltv_segment"]) == (1, 6000.0, "Loyal")
    assert row["days_since_last_order"] == 10


def test_promotion_counts(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (None,), (None,)], "id INT")
    assert tuple(transform_metrics(df, ["id"]).first()) == (5, 3, 2)
    assert tuple(transform_metrics(df.filter("false"), ["id"]).first()) == (0, 0, 0)
