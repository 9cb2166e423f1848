"""Table descriptors, layer paths and the registry."""

from __future__ import annotations

from dataclasses import dataclass, field
from enum import StrEnum

from pyspark.sql import types as T


class Layer(StrEnum):
    BRONZE = "bronze"
    SILVER = "silver"
    GOLD = "gold"


@dataclass(frozen=True)
class TableSpec:
    """What the engine needs to know about one table of one layer."""

    name: str
    layer: Layer
    keys: tuple[str, ...] = ()
    partition_cols: tuple[str, ...] = ()
    cluster_cols: tuple[str, ...] = ()
    scd_type: int = 1
    order_col: str = "_ingestion_ts"
    hash_cols: tuple[str, ...] = ()
    schema: T.StructType | None = None
    path: str | None = None

    def __post_init__(self) -> None:
        if self.scd_type not in (1, 2):
            raise ValueError(f"scd_type must be 1 or 2, got {self.scd_type}")

    @property
    def dedupe_keys(self) -> tuple[str, ...]:
        return self.keys or ("id",)


def layer_path(root: str, layer: Layer | str, name: str) -> str:
    return f"{root.rstrip('/')}/{Layer(layer).value}/{name}"


def database_name(custom: str | None, default: str) -> str:
    """Database of a model: the configured one, trimmed, else the default."""
    return default if custom is None else custom.strip()


@dataclass
class Registry:
    """Descriptors by (layer, name), so one name may live in several layers."""

    root: str
    tables: dict[tuple[Layer, str], TableSpec] = field(default_factory=dict)

    def register(self, spec: TableSpec) -> TableSpec:
        self.tables[(spec.layer, spec.name)] = spec
        return spec

    def get(self, layer: Layer | str, name: str) -> TableSpec:
        """The registered descriptor; an unknown name gets a default one."""
        key = (Layer(layer), name)
        if key not in self.tables:
            self.tables[key] = TableSpec(name=name, layer=key[0])
        return self.tables[key]

    def path(self, spec: TableSpec) -> str:
        return spec.path or layer_path(self.root, spec.layer, spec.name)
