"""Registry of proof queries: a Spark plan and, where SQL can state it, the same in DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession

Query = Callable[["Tables"], DataFrame]

PLANS: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The driver's tables under one scale-factor directory, opened on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self("lineitem")

    @cached_property
    def orders(self) -> DataFrame:
        return self("orders")

    @cached_property
    def part(self) -> DataFrame:
        return self("part")

    @cached_property
    def customer(self) -> DataFrame:
        return self("customer")

    @cached_property
    def supplier(self) -> DataFrame:
        return self("supplier")

    @cached_property
    def nation(self) -> DataFrame:
        return self("nation")

    @cached_property
    def region(self) -> DataFrame:
        return self("region")

    @cached_property
    def events(self) -> DataFrame:
        return self("events")

    @cached_property
    def documents(self) -> DataFrame:
        return self("documents")

    @cached_property
    def conversations(self) -> DataFrame:
        return self("conversations")


def proof(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        if name in PLANS:
            raise ValueError(f"duplicate proof query {name}")
        PLANS[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return add
