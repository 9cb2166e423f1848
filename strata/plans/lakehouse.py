"""The layered pipeline: ingest to bronze, promote to silver, build gold."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from strata.functions.ingest import with_ingest_metadata
from strata.functions.stamps import Moment
from strata.operators import layout
from strata.operators.dedupe import to_silver
from strata.operators.metrics import observed
from strata.operators.merge import upsert
from strata.operators.scd2 import out_of_order
from strata.operators.schema_sync import conform
from strata.plans.gold import GoldStore
from strata.session import scratch_dir, scratch_scope
from strata.sources.bucketed import BucketedTable
from strata.sources.tables import register_external
from strata.sources.versions import VersionedTable
from strata.tables import Layer, Registry, TableSpec, layer_path


PROMOTED = "rows_in LONG, rows_out LONG, duplicates_dropped LONG, scd2_inserts LONG, scd2_updates LONG"


#: Mark of a silver table: the bronze version up to which its rows were promoted.
PROMOTED_TO = "promoted_to"


class Lakehouse:
    """Tables of one root folder, addressed by layer and name."""

    def __init__(self, spark: SparkSession, root: str, n_buckets: int = 64) -> None:
        self.spark = spark
        self.registry = Registry(root)
        self.n_buckets = n_buckets
        self.gold = GoldStore(spark, layer_path(root, Layer.GOLD, ""))

    def register(self, spec: TableSpec) -> TableSpec:
        return self.registry.register(spec)

    def table(self, layer: Layer | str, name: str) -> VersionedTable:
        """Storage of a table.  Keyed silver tables are bucketed by their key,
        so merges rewrite the touched buckets only."""
        spec = self.registry.get(layer, name)
        path = self.registry.path(spec)
        if spec.layer is Layer.BRONZE:
            return VersionedTable(
                self.spark, path, spec.partition_cols or ("_ingestion_date",), spec.cluster_cols
            )
        if spec.layer is Layer.SILVER and spec.keys:
            parts = (*spec.partition_cols, *(("_is_current",) if spec.scd_type == 2 else ()))
            return BucketedTable(
                self.spark, path, parts, spec.cluster_cols, keys=spec.keys, n_buckets=self.n_buckets
            )
        return VersionedTable(self.spark, path, spec.partition_cols, spec.cluster_cols)

    def ingest(
        self, name: str, df: DataFrame, source: str, batch_id: str | None = None, as_of: Moment = None
    ) -> Row:
        """Append a batch to bronze with its arrival metadata; returns the commit.

        A batch is conformed to the declared schema if there is one.  A
        repeated batch id is not stored again.
        """
        spec = self.registry.get(Layer.BRONZE, name)
        rows = df if spec.schema is None else conform(df, spec.schema)
        stored = self.table(Layer.BRONZE, name)
        enriched = with_ingest_metadata(rows, source, batch_id, as_of)
        return stored.append(enriched, batch_id, as_of)

    def promote(
        self, name: str, bronze: DataFrame | None = None, as_of: Moment = None, only_new: bool = False
    ) -> DataFrame:
        """Deduplicate bronze rows into silver: a type-2 merge, or a full
        replace for type 1.

        The bronze rows are read once: the deduplicated batch is written to
        scratch while both sides are counted, and every later step reads that.
        A type-2 batch that does not lie after the current rows is refused.
        ``only_new`` takes the bronze rows that came since the last promotion
        into a type-2 table: silver's commit keeps the bronze version it has
        seen, and later folders alone are read.
        Returns one row of counts in the shape of ``transform_metrics``.
        """
        with scratch_scope(self.spark):
            return self._promote(self.registry.get(Layer.SILVER, name), bronze, as_of, only_new)

    def _promote(self, spec: TableSpec, bronze: DataFrame | None, as_of: Moment, only_new: bool) -> DataFrame:
        name = spec.name
        marks = None
        if bronze is not None:
            rows = bronze
        elif only_new:
            if spec.scd_type != 2:
                raise ValueError(f"{name}: a full replace needs all rows")
            arrived = self.table(Layer.BRONZE, name)
            seen_to = self.table(Layer.SILVER, name).mark(PROMOTED_TO)
            marks = {PROMOTED_TO: str(arrived.latest()["version"])}
            rows = arrived.since(None if seen_to is None else int(seen_to))
        else:
            rows = self.table(Layer.BRONZE, name).current()
        if spec.scd_type == 1:
            rows = rows.filter(F.col(spec.order_col).isNotNull())
        seen, rows_in = observed(rows)
        latest, rows_out = observed(to_silver(seen, spec.dedupe_keys, spec.order_col, as_of))
        path = scratch_dir(self.spark, f"promote-{name}")
        latest.write.parquet(path)
        batch = self.spark.read.schema(latest.schema).parquet(path)

        stored = self.table(Layer.SILVER, name)
        if spec.scd_type == 2:
            inserted, closed = self._merge_scd2(stored, spec, batch, as_of, marks)
        else:
            stored.overwrite(batch, committed_at=as_of)
            inserted, closed = rows_out(), 0
        counts = [(rows_in(), rows_out(), rows_in() - rows_out(), inserted, closed)]
        return self.spark.createDataFrame(counts, PROMOTED)

    def _merge_scd2(
        self,
        stored: VersionedTable,
        spec: TableSpec,
        batch: DataFrame,
        as_of: Moment,
        marks: dict[str, str] | None,
    ) -> tuple[int, int]:
        if not isinstance(stored, BucketedTable):
            raise ValueError(f"{spec.name}: a type-2 table needs keys")
        if stored.latest() is not None and as_of is not None:
            late = out_of_order(stored.current_rows(), as_of)
            if not late.isEmpty():
                raise ValueError(f"{spec.name}: batch as of {as_of} is not after the current rows")
        commit = stored.merge_scd2(batch, as_of, spec.hash_cols or None, marks=marks)
        return commit["rows_added"], commit["rows_removed"]

    def materialize(
        self,
        layer: Layer | str,
        name: str,
        rows: DataFrame,
        strategy: str = "table",
        update_cols: Sequence[str] | None = None,
        committed_at: Moment = None,
    ) -> int:
        """Store a model's rows: ``table`` replaces, ``append`` adds, ``merge``
        upserts by the table's keys.  Returns the rows written."""
        stored = self.table(layer, name)
        if strategy == "append":
            return stored.append(rows, committed_at=committed_at)["rows_added"]
        if strategy == "merge" and isinstance(stored, BucketedTable):
            return stored.merge(rows, update_cols, committed_at=committed_at)["rows_added"]
        if strategy == "merge":
            spec = self.registry.get(layer, name)
            if stored.latest() is not None:
                target = conform(stored.current(), rows.schema, drop_unknown=True)
                rows = upsert(target, rows, spec.keys, update_cols)
            return stored.overwrite(rows, "merge", committed_at=committed_at)["rows_added"]
        if strategy != "table":
            raise ValueError(f"unknown strategy {strategy!r}")
        return stored.overwrite(rows, committed_at=committed_at)["rows_added"]

    def build_gold(
        self, name: str, sql: str, partition_by: str | None = None, cluster_by: Sequence[str] = ()
    ) -> int:
        return self.gold.build(name, sql, partition_by, cluster_by)

    def register_external(self, name: str, path: str) -> DataFrame:
        return register_external(self.spark, name, path)

    def maintain(self, manifest: Sequence[Mapping[str, Any]]) -> DataFrame:
        """Optimise and expire the listed tables; one report row each."""
        return layout.run_maintenance(
            self.spark,
            manifest,
            lambda entry: layout.optimize_and_expire(self.table(entry["layer"], entry["name"]), entry),
        )

