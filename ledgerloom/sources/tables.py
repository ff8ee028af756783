"""Loading the star-schema tables."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession


class StarTables:
    """The Parquet tables of one data directory, read lazily."""

    def __init__(self, spark: SparkSession, data_dir: str):
        self.spark = spark
        self.data_dir = data_dir.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.data_dir}/{name}.parquet")

    @cached_property
    def orders(self) -> DataFrame:
        return self.table("orders")

    @cached_property
    def lineitem(self) -> DataFrame:
        return self.table("lineitem")

    @cached_property
    def customer(self) -> DataFrame:
        return self.table("customer")

    @cached_property
    def nation(self) -> DataFrame:
        return self.table("nation")

    @cached_property
    def supplier(self) -> DataFrame:
        return self.table("supplier")

    @cached_property
    def events(self) -> DataFrame:
        return self.table("events")
