"""Registered queries: a DataFrame function and, where SQL can say the same, its SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.queries.ctes import compose
from ledgerloom.session import CODEGEN, SEMANTICS
from ledgerloom.sources.roles import Roles


@dataclass(frozen=True)
class Query:
    key: str
    build: Callable[[Roles], DataFrame]
    sql: str | None
    money: tuple[str, ...]
    dates: tuple[str, ...]

    def run(self, spark: SparkSession, data_dir: str) -> DataFrame:
        for name, value in {**SEMANTICS, **CODEGEN}.items():
            spark.conf.set(name, value)
        out = self.build(Roles(spark, data_dir))
        shown = {c: F.col(c).cast("double") for c in self.money}
        shown.update({c: F.date_format(c, "yyyy-MM-dd") for c in self.dates})
        return out.withColumns(shown) if shown else out

    def oracle(self) -> str | None:
        """The SQL with the same display types: money as double, dates as text."""
        if self.sql is None:
            return None
        shown = [f"CAST({c} AS DOUBLE) AS {c}" for c in self.money]
        shown += [f"strftime({c}, '%Y-%m-%d') AS {c}" for c in self.dates]
        body = f"SELECT * REPLACE ({', '.join(shown)}) FROM ({self.sql}) AS q" if shown else self.sql
        return compose(body)


REGISTRY: dict[str, Query] = {}


def query(key: str, sql: str | None = None, money: str = "", dates: str = ""):
    def register(build: Callable[[Roles], DataFrame]):
        if key in REGISTRY:
            raise ValueError(f"duplicate query {key}")
        REGISTRY[key] = Query(key, build, sql, tuple(money.split()), tuple(dates.split()))
        return build

    return register
