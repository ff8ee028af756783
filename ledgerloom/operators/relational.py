"""Projections, filters, sorting and set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DataType

from ledgerloom.functions.keys import ci_equals


# --- projections -----------------------------------------------------------

def derive(df: DataFrame, columns: Mapping[str, tuple[Column, DataType | str]]) -> DataFrame:
    """Add typed columns computed from the existing ones."""
    return df.withColumns({name: expr.cast(dtype) for name, (expr, dtype) in columns.items()})


def rename(df: DataFrame, names: Mapping[str, str]) -> DataFrame:
    return df.withColumnsRenamed(dict(names))


def literals(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    return df.withColumns({name: F.lit(v) for name, v in values.items()})


def prefixed(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    """Every column renamed with a side prefix, so two sides can be shown after a join."""
    return df.select(*[F.col(c).alias(c if c in keep else f"{prefix}{c}") for c in df.columns])


def row_identity(
    df: DataFrame, within: Sequence[str], spread: Sequence[str], label: str,
    number: str = "exception_num", text: str = "exception_id", order: Sequence[str] | None = None,
) -> DataFrame:
    """Number rows inside each ``within`` group and build a text id from the number.

    A group may hold a large share of all rows, so it is never numbered by one
    task: its rows are dealt to 256 ordered buckets by a hash of the ``spread``
    columns, numbered inside their bucket, and shifted by the row count of the
    buckets before. Inside a bucket rows are ordered by ``order``, then by all
    their other columns, so equal input gets equal numbers in every run. The
    rows are exchanged once; the counting side reads the same exchange and
    neither sorts nor numbers.
    """
    seed = F.concat_ws("|", *[F.coalesce(F.col(c), F.lit("")) for c in spread])
    bucket = [*within, "__bucket"]
    dealt = df.withColumn("__bucket", F.left(F.md5(seed), F.lit(2))).repartition(*bucket)
    sizes = dealt.groupBy(*bucket).agg(F.count("*").alias("__size"))
    before = Window.partitionBy(*within).orderBy("__bucket").rowsBetween(Window.unboundedPreceding, -1)
    shifts = sizes.select(*bucket, F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__shift"))
    # rows without a company or date are the ones an exception report must keep, so groups meet NULL-safely
    shifts = shifts.select(*[F.col(c).alias(f"__of_{c}") for c in bucket], "__shift")
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"__of_{c}")) for c in bucket])
    sorted_by = list(dict.fromkeys([*(order or ()), *df.columns]))
    inside = F.row_number().over(Window.partitionBy(*bucket).orderBy(*sorted_by))
    out = dealt.withColumn("__n", inside).join(shifts, same).withColumn(number, F.col("__shift") + F.col("__n"))
    out = out.withColumn(text, F.concat(F.lit(label), F.col(number).cast("string")))
    return out.drop("__bucket", "__n", "__shift", *[f"__of_{c}" for c in bucket])


# --- filters ---------------------------------------------------------------

def filter_not_zero(df: DataFrame, amount: str) -> DataFrame:
    return df.filter(F.abs(amount) > 0)


def filter_column_greater(df: DataFrame, left: str, right: str) -> DataFrame:
    return df.filter(F.col(left) > F.col(right))


def filter_ci_equals(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.filter(ci_equals(column, value))


# --- sort, limit, sets -----------------------------------------------------

def sort(df: DataFrame, *order: Column) -> DataFrame:
    return df.orderBy(*order)


def top_n(df: DataFrame, order: Sequence[Column], n: int) -> DataFrame:
    """The first ``n`` rows; runs as a per-partition top-n, not as a full sort."""
    return df.orderBy(*order).limit(n)


def union(frames: Sequence[DataFrame], distinct: bool = False) -> DataFrame:
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return out.distinct() if distinct else out
