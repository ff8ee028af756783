"""Joins used by lookups and reconciliation.

No join carries a broadcast hint: a dimension is broadcast only when Spark
finds its size below ``spark.sql.autoBroadcastJoinThreshold``; a larger one is
shuffled, and adaptive execution splits its skewed partitions.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions.keys import LEDGER_RATE, ci_key, col


def unique_lookup(dim: DataFrame, keys: Mapping[str, Column], values: Sequence[str]) -> DataFrame:
    """One row per key, so a lookup never multiplies the looked-up side.

    Where a key has several candidate rows the largest value wins, which makes
    the choice repeatable.
    """
    keyed = dim.select(*[c.alias(name) for name, c in keys.items()], *values)
    return keyed.groupBy(*keys).agg(*[F.max(v).alias(v) for v in values])


def left_lookup(
    df: DataFrame,
    dim: DataFrame,
    on: Mapping[str, Column | str] | Sequence[tuple[Column, Column]],
    value: str,
    default=None,
    alias: str | None = None,
) -> DataFrame:
    """Add ``alias`` from ``dim.value``; ``default`` where no key matches or the value is NULL.

    ``on`` is a list of (left expression, right expression) pairs, or a mapping
    of left column to right column compared without case.
    """
    pairs = on if not isinstance(on, Mapping) else [(ci_key(l), ci_key(r)) for l, r in on.items()]
    right = unique_lookup(dim, {f"__k{i}": r for i, (_, r) in enumerate(pairs)}, [value])
    right = right.withColumnRenamed(value, "__value")
    condition = reduce(lambda a, b: a & b, [l == F.col(f"__k{i}") for i, (l, _) in enumerate(pairs)])
    found = F.col("__value") if default is None else F.coalesce(F.col("__value"), F.lit(default))
    joined = df.join(right, condition, "left").withColumn(alias or value, found)
    return joined.drop("__value", *[f"__k{i}" for i in range(len(pairs))])


def fx_lookup(
    df: DataFrame,
    rates: DataFrame,
    currency: Column | str = "currency",
    date: Column | str = "date",
    alias: str = "fx_rate",
    rate_type=LEDGER_RATE,
) -> DataFrame:
    """Rate of exactly this currency and day, 1 where there is none."""
    pairs = [(ci_key(currency), ci_key("rate_currency")), (F.to_date(col(date)), F.col("rate_date"))]
    out = left_lookup(df, rates, pairs, "rate", default=1, alias=alias)
    return out.withColumn(alias, F.col(alias).cast(rate_type))


def account_lookup(
    df: DataFrame,
    matrix: DataFrame,
    on: Sequence[str] = ("company", "txn_type", "business_line"),
    constant_line: str | None = None,
    default: str = "",
    alias: str = "account",
) -> DataFrame:
    """Account of a line by company, type and product line, by fewer of those keys,
    or by the keys given plus one constant product line."""
    names = {"company": "matrix_company", "txn_type": "matrix_type", "business_line": "matrix_line"}
    pairs = [(ci_key(k), ci_key(names[k])) for k in on]
    if constant_line is not None:
        pairs.append((F.upper(F.lit(constant_line)), ci_key("matrix_line")))
    return left_lookup(df, matrix, pairs, "account_number", default=default, alias=alias)


def processor_id_lookup(
    ledger: DataFrame, report: DataFrame, ledger_id: str, report_id: str, alias: str = "processor_txn_id"
) -> DataFrame:
    """The processor's id for a ledger row, compared as text; '' where it has none."""
    pairs = [(ci_key(F.col(ledger_id).cast("string")), ci_key(F.col(report_id).cast("string")))]
    # spellings first, by hash; the largest of them, a text, is only sought among few rows a key
    return left_lookup(ledger, report.select(report_id).distinct(), pairs, report_id, default="", alias=alias)


def inner_join(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    return left.join(right, list(on), "inner")


def full_outer(
    left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], condition: Column | None = None
) -> DataFrame:
    """Full outer join keeping both sides' columns.

    ``condition`` is an extra, possibly one-sided test that belongs to the
    match itself: a row that fails it still appears, unmatched.
    """
    match = reduce(lambda a, b: a & b, [F.col(l) == F.col(r) for l, r in on])
    if condition is not None:
        match = match & condition
    return left.join(right, match, "full")


def full_coalesce(
    left: DataFrame, right: DataFrame, keys: Sequence[str], zero_fill: Sequence[str]
) -> DataFrame:
    """Full outer join with merged keys and zero-filled measures."""
    joined = left.join(right, list(keys), "full")
    return joined.withColumns({m: F.coalesce(F.col(m), F.lit(0)) for m in zero_fill})


def chain_by_key(anchor: DataFrame, others: Sequence[DataFrame], key: str, how: str, zero_fill: Sequence[str] = ()):
    """A chain of left or full joins of small per-day frames on one key."""
    out = reduce(lambda a, b: a.join(b, [key], how), others, anchor)
    return out.withColumns({m: F.coalesce(F.col(m), F.lit(0)) for m in zero_fill}) if zero_fill else out
