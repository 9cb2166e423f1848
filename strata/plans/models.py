"""The staging, silver and gold models as composed DataFrames."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.functions.hashing import row_hash
from strata.functions.measures import ltv_segment, percent_of
from strata.functions.stamps import Moment, moment
from strata.operators.dedupe import dedupe_latest
from strata.operators.incremental import newer_than
from strata.session import settle

#: Fixed columns of the models.
EVENT_COLUMNS = (
    "event_id",
    "event_type",
    "user_id",
    "session_id",
    "properties",
    "server_ts",
    "_ingestion_ts",
    "_source",
    "_batch_id",
    "_ingestion_date",
)
CUSTOMER_UPDATE_COLUMNS = (
    "email",
    "tier",
    "region",
    "_row_hash",
    "_valid_from",
    "_valid_to",
    "_is_current",
)


def stg_events(raw: DataFrame, loaded: DataFrame | None = None) -> DataFrame:
    """Staged events; with ``loaded`` only those newer than what it holds."""
    staged = raw.select(*EVENT_COLUMNS)
    if loaded is None:
        return staged
    return newer_than(staged, "_ingestion_ts", loaded, partition_col="_ingestion_date")


def fct_orders(
    bronze: DataFrame,
    as_of: Moment = None,
    loaded: DataFrame | None = None,
    lookback: str | None = None,
    invalid: bool = False,
) -> DataFrame:
    """Order facts: newest version per order, then the row checks.

    ``invalid`` gives instead the keys whose newest version fails the checks;
    a merge deletes their facts, so that merged facts equal a full build.
    ``lookback`` reads late arrivals again.

    The checks run after deduplication on purpose: an order whose newest
    version is invalid has no fact.  Null keys can never pass, so they are
    dropped before the window.
    """
    latest = _latest_orders(bronze, loaded, lookback)
    return _invalid_orders(latest) if invalid else _facts(latest, as_of)


def order_changes(
    bronze: DataFrame, loaded: DataFrame, as_of: Moment = None, lookback: str | None = None
) -> tuple[DataFrame, DataFrame]:
    """Facts to merge into ``loaded`` and the keys whose facts go, from one deduplication that is stored."""
    latest = settle(_latest_orders(bronze, loaded, lookback), "order-changes")
    return _facts(latest, as_of), _invalid_orders(latest)


def _latest_orders(bronze: DataFrame, loaded: DataFrame | None, lookback: str | None) -> DataFrame:
    rows = bronze.filter(F.col("order_id").isNotNull())
    if loaded is not None:
        rows = newer_than(rows, "_ingestion_ts", loaded, target_col="_silver_ts", lookback=lookback)
    return dedupe_latest(rows, ["order_id"])


def _invalid_orders(latest: DataFrame) -> DataFrame:
    return latest.filter(~F.coalesce(F.col("amount") >= 0, F.lit(False))).select("order_id")


def _facts(latest: DataFrame, as_of: Moment) -> DataFrame:
    return latest.filter(F.col("amount") >= 0).select(
        "order_id",
        "customer_id",
        "product_id",
        "status",
        "amount",
        "currency",
        "order_date",
        "shipped_date",
        F.datediff("shipped_date", "order_date").alias("fulfillment_days"),
        moment(as_of).alias("_silver_ts"),
    )


def dim_customers(bronze: DataFrame, as_of: Moment = None, loaded: DataFrame | None = None) -> DataFrame:
    """Customer dimension: newest version per customer with its row hash."""
    rows = bronze
    if loaded is not None:
        rows = newer_than(rows, "_ingestion_ts", loaded, target_col="_valid_from")
    stamp = moment(as_of)
    return dedupe_latest(rows, ["customer_id"]).select(
        "customer_id",
        "email",
        "tier",
        "region",
        "created_at",
        row_hash(["email", "tier", "region"]).alias("_row_hash"),
        stamp.alias("_valid_from"),
        F.lit(None).cast("timestamp_ntz").alias("_valid_to"),
        F.lit(True).alias("_is_current"),
        stamp.alias("_silver_ts"),
    )


def agg_revenue_daily(orders: DataFrame, customers: DataFrame, orders_unique: bool = False) -> DataFrame:
    """Revenue per day, region and tier over non-cancelled orders.

    A distinct count beside percentiles makes Spark build one percentile
    sketch per group *and* distinct value.  So measures and distinct counts
    are aggregated apart, each with its own map-side combine, and the small
    results are merged per group.  ``orders`` is scanned once per part: pass a
    stored table.  ``orders_unique`` says it holds one row per order, as
    :func:`fct_orders` guarantees, and saves the pass that counts orders.
    """
    groups = ["order_date", "region", "customer_tier"]
    current = customers.filter("_is_current").select(
        "customer_id", "region", F.col("tier").alias("customer_tier")
    )
    kept = orders.filter(F.col("status") != "cancelled")
    returned = F.sum(F.when(F.col("status") == "returned", 1))
    measures = {
        "total_revenue": F.sum("amount"),
        "avg_order_value": F.avg("amount"),
        "_percentiles": F.percentile_approx("amount", [0.5, 0.95]),
        "avg_fulfillment_days": F.avg("fulfillment_days"),
        "returns": returned,
        "return_rate_pct": percent_of(returned, F.count(F.lit(1))),
    }
    if orders_unique:
        measures["order_count"] = F.count("order_id")
    rollup = kept.join(current, "customer_id").groupBy(*groups)
    parts = [rollup.agg(*[m.alias(name) for name, m in measures.items()])]

    buyers = kept.select("order_date", "customer_id").distinct().join(current, "customer_id")
    parts.append(buyers.groupBy(*groups).agg(F.count_distinct("customer_id").alias("unique_customers")))
    if not orders_unique:
        bought = kept.join(current, "customer_id").select(*groups, "order_id").distinct()
        parts.append(bought.groupBy(*groups).agg(F.count("order_id").alias("order_count")))

    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return (
        merged.groupBy(*groups)
        .agg(*[F.max(c).alias(c) for c in merged.columns if c not in groups])
        .select(
            *groups,
            "order_count",
            "unique_customers",
            "total_revenue",
            "avg_order_value",
            F.col("_percentiles")[0].alias("median_order_value"),
            F.col("_percentiles")[1].alias("p95_order_value"),
            "avg_fulfillment_days",
            "returns",
            "return_rate_pct",
        )
    )


def order_stats(orders: DataFrame, orders_unique: bool = False) -> DataFrame:
    """Lifetime figures per customer over kept orders."""
    order_count = F.count("order_id") if orders_unique else F.count_distinct("order_id")
    return (
        orders.filter(~F.col("status").isin("cancelled", "returned"))
        .groupBy("customer_id")
        .agg(
            order_count.alias("lifetime_orders"),
            F.sum("amount").alias("lifetime_revenue"),
            F.avg("amount").alias("avg_order_value"),
            F.min("order_date").alias("first_order_date"),
            F.max("order_date").alias("last_order_date"),
            F.datediff(F.max("order_date"), F.min("order_date")).alias("customer_tenure_days"),
        )
    )


def agg_customer_ltv(
    orders: DataFrame, customers: DataFrame, as_of: Moment = None, orders_unique: bool = False
) -> DataFrame:
    """Customer lifetime value: aggregate first, then join one row per customer."""
    current = customers.filter("_is_current").select("customer_id", "email", "tier", "region")
    return current.join(order_stats(orders, orders_unique), "customer_id").select(
        "customer_id",
        "email",
        "tier",
        "region",
        "lifetime_orders",
        F.round("lifetime_revenue", 2).alias("lifetime_revenue"),
        F.round("avg_order_value", 2).alias("avg_order_value"),
        "first_order_date",
        "last_order_date",
        "customer_tenure_days",
        ltv_segment(F.col("lifetime_revenue")).alias("ltv_segment"),
        F.datediff(F.to_date(moment(as_of)), "last_order_date").alias("days_since_last_order"),
    )
