"""Plans that must hold at scale: pruning, pushdown, skew handling, no stray shuffles."""

import re

import pytest
from pyspark.sql import functions as F

from strata.operators.merge import upsert
from strata.operators.scd2 import scd2_bootstrap, scd2_changes_small_batch
from strata.plans import models
from strata.session import settle
from strata.sources.bucketed import BucketedTable
from strata.sources.versions import VersionedTable


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    """The adaptive plan after it ran."""
    df.write.format("noop").mode("overwrite").save()
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def conf(spark):
    """Set options for one test."""
    changed = {}

    def put(**options):
        for key, value in options.items():
            name = "spark.sql." + key.replace("__", ".")
            changed.setdefault(name, spark.conf.get(name, None))
            spark.conf.set(name, value)

    yield put
    for name, value in changed.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def hot_orders(spark, n=30_000):
    """One customer holds a third of the orders."""
    key = F.col("id")
    return spark.range(n).select(
        key.alias("order_id"),
        F.when(key % 3 == 0, 1).otherwise(key % 500).alias("customer_id"),
        F.lit("completed").alias("status"),
        (key % 100).cast("double").alias("amount"),
        F.date_add(F.lit("2024-01-01").cast("date"), (key % 30).cast("int")).alias("order_date"),
        F.lit(1).alias("fulfillment_days"),
        F.repeat(F.lit("x"), 50).alias("padding"),
    )


def customers(spark, n=500):
    return spark.range(n).select(
        F.col("id").alias("customer_id"),
        F.concat(F.col("id").cast("string"), F.lit("@x")).alias("email"),
        F.lit("gold").alias("tier"),
        F.lit("EU").alias("region"),
        F.lit(True).alias("_is_current"),
    )


def test_a_hot_customer_is_split_by_the_join(spark, conf):
    conf(
        autoBroadcastJoinThreshold="-1",
        adaptive__autoBroadcastJoinThreshold="-1",
        adaptive__skewJoin__skewedPartitionThresholdInBytes="4KB",
        adaptive__skewJoin__skewedPartitionFactor="1.5",
        adaptive__advisoryPartitionSizeInBytes="16KB",
    )
    facts = settle(hot_orders(spark).repartition(12, "order_id"))
    got = models.agg_revenue_daily(facts, settle(customers(spark)), orders_unique=True)
    assert "skew=true" in final_plan(got)
    total = got.agg(F.sum("order_count"), F.sum("total_revenue")).first()
    assert tuple(total) == (30_000, float(sum(i % 100 for i in range(30_000))))


def test_gold_reads_only_what_it_needs(spark):
    facts, dims = settle(hot_orders(spark)), settle(customers(spark))
    text = plan(models.agg_customer_ltv(facts, dims, "2024-03-01", orders_unique=True))
    assert "padding" not in text
    assert "EqualTo(_is_current,true)" in text or "PushedFilters: [IsNotNull(_is_current)" in text
    # partial aggregation comes before the only shuffle of the facts
    assert re.search(r"Exchange hashpartitioning\(customer_id.*\n.*HashAggregate\(keys=\[customer_id", text)


def test_versions_prune_folders(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"))
    for i in range(3):
        table.append(spark.range(10 * i, 10 * i + 10))
    read = table.as_of_version(1)
    assert re.search(r"PartitionFilters: \[isnotnull\(_version", plan(read))
    assert {re.search(r"_version=(\d)", f).group(1) for f in scanned(read)} == {"0", "1"}


def scanned(df):
    return [row[0] for row in df.select(F.input_file_name()).distinct().collect()]


def test_bucketed_merge_reads_touched_buckets_only(spark, tmp_path):
    table = BucketedTable(spark, str(tmp_path / "b"), keys=("id",), n_buckets=8)
    table.merge(spark.range(100).withColumn("v", F.lit(1)))
    wanted = table._touched(spark.range(1, 2))
    part = table._buckets_of(table.latest(), wanted)
    assert {int(re.search(r"_bucket=(\d+)", f).group(1)) for f in scanned(part)} == set(wanted)


def test_a_small_batch_does_not_shuffle_the_dimension(spark):
    dim = settle(scd2_bootstrap(customers(spark, 5000).drop("_is_current"), "2024-01-01"))
    batch = settle(customers(spark, 5).drop("_is_current").withColumn("tier", F.lit("vip")))
    text = final_plan(scd2_changes_small_batch(dim, batch, ["customer_id"], "2024-02-01"))
    shuffles = [line for line in text.split("== Initial Plan ==")[0].splitlines() if "Exchange hashpartitioning" in line]
    assert shuffles == []


def test_an_upsert_broadcasts_a_small_source_and_merges_a_large_one(spark, conf):
    target = settle(customers(spark, 5000))
    source = settle(customers(spark, 5))
    assert "BroadcastHashJoin" in plan(upsert(target, source, ["customer_id"]))
    conf(autoBroadcastJoinThreshold="10")
    assert "SortMergeJoin" in plan(upsert(target, source, ["customer_id"]))
