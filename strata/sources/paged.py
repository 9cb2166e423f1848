"""Paged APIs as a Spark data source.

The caller injects ``fetch(params) -> body`` (an HTTP call, say); Spark calls
it from its tasks.  The source returns one row per page, so it should be landed
once before the records are taken out of it.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from typing import Any
from urllib.parse import parse_qs, urlparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from strata.session import ship_package, struct

Fetch = Callable[[dict[str, Any]], Any]

PAGE = struct(
    page=T.LongType(), n_records=T.LongType(), has_next=T.BooleanType(), body=T.StringType()
)


@dataclass(frozen=True)
class PagedApi:
    fetch: Fetch
    page_size: int = 500
    page_param: str = "page"
    limit_param: str = "limit"
    results_key: str = "results"
    next_key: str | None = "next"
    extra_params: dict[str, Any] = field(default_factory=dict)

    def get(self, page: int, cursor: dict[str, str] | None = None) -> dict[str, Any]:
        """One page as a row of :data:`PAGE`, without the column names."""
        body = self.fetch(
            {self.limit_param: self.page_size, **self.extra_params, **(cursor or {}), self.page_param: page}
        )
        records = body.get(self.results_key, body) if isinstance(body, dict) else body
        link = body.get(self.next_key) if self.next_key and isinstance(body, dict) else None
        return {"n": len(records or []), "next": link, "body": json.dumps(body)}

    def is_last(self, page: dict[str, Any]) -> bool:
        return page["n"] == 0 or (not page["next"] and page["n"] < self.page_size)


@dataclass
class PageRange(InputPartition):
    first: int
    last: int | None


class PagedReader(DataSourceReader):
    def __init__(self, api: PagedApi, pages_per_task: int, follow_cursor: bool) -> None:
        self.api = api
        self.pages_per_task = pages_per_task
        self.follow_cursor = follow_cursor

    def partitions(self) -> list[PageRange]:
        """Page ranges up to a page at or past the end, found by doubling.

        A cursor can only be followed page by page, so it is one partition.
        """
        if self.follow_cursor:
            return [PageRange(1, None)]
        bound = 1
        while not self.api.is_last(self.api.get(bound)):
            bound *= 2
        step = self.pages_per_task
        return [PageRange(p, min(p + step - 1, bound)) for p in range(1, bound + 1, step)]

    def read(self, partition: PageRange) -> Iterator[tuple]:
        page, cursor = partition.first, {}
        while partition.last is None or page <= partition.last:
            got = self.api.get(page, cursor)
            yield page, got["n"], bool(got["next"]), got["body"]
            if self.api.is_last(got):
                return
            if self.follow_cursor and got["next"]:
                query = parse_qs(urlparse(got["next"]).query)
                cursor = cursor | {name: values[0] for name, values in query.items()}
            page += 1


def paged_source(
    api: PagedApi, name: str = "paged", pages_per_task: int = 16, follow_cursor: bool = False
) -> type[DataSource]:
    """A data source class over ``api``; register it, then ``format(name)``."""

    class Paged(DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> T.StructType:
            return PAGE

        def reader(self, schema: T.StructType) -> DataSourceReader:
            return PagedReader(api, pages_per_task, follow_cursor)

    return Paged


def read_pages(spark: SparkSession, api: PagedApi, name: str = "paged", **options: Any) -> DataFrame:
    """All fetched pages, one row each.  Every action on it fetches again."""
    ship_package(spark)
    spark.dataSource.register(paged_source(api, name, **options))
    return spark.read.format(name).load()


def until_last_page(pages: DataFrame, page_size: int) -> DataFrame:
    """Cut landed pages after the first that ends the scan.

    A page ends it when it is empty, or short without a next link; an empty
    page gives no rows anyway.
    """
    ends = (F.col("n_records") == 0) | (~F.col("has_next") & (F.col("n_records") < page_size))
    last = pages.filter(ends).agg(F.min("page").alias("last_page"))
    return pages.filter(F.col("page") <= F.coalesce(last.scalar(), F.col("page")))


def page_records(
    pages: DataFrame, record_schema: T.StructType, results_key: str = "results", body_col: str = "body"
) -> DataFrame:
    """The records of page bodies: the envelope's list, or the body itself when
    it is a bare list or has no such key."""
    element = record_schema.simpleString()
    body = F.col(body_col)
    enveloped = F.array_contains(F.json_object_keys(body), results_key)
    envelope = F.from_json(body, f"STRUCT<`{results_key}`: ARRAY<{element}>>")[results_key]
    records = F.when(enveloped, envelope).otherwise(F.from_json(body, f"ARRAY<{element}>"))
    return pages.select(F.explode(records).alias("r")).select("r.*")
